import hashlib
import random
import re
import zlib

import brute
import pytest
from pyspark.sql import functions as F

from tagloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, n long"


def plain_trie(paths):
    """``paths``: turns (role, text) of each conversation id."""
    nodes = {}
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            nodes.setdefault(tuple(paths[c][:d]), []).append(c)
    under = {}
    for p in nodes:
        for d in range(len(p)):
            under.setdefault(p[:d], []).append(p)
    count = {p: sum(len(q) == len(p) + 1 for q in under.get(p, [])) for p in nodes}
    out = []
    for p, members in nodes.items():
        sub = [p, *under.get(p, [])]
        words = lambda q: len(re.findall(brute.SPACES, q[-1][1])) if q else 0
        ends = ",".join(str(c) for c in members if len(paths[c]) == len(p))
        out.append((
            members[0], len(p), nodes[p[:-1]][0] if p else None, len(members), count[p], sum(not count[q] for q in sub),
            sum((len(nodes[q]) - 1) * words(q) for q in sub), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rebuilt(rows):
    turns = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in turns.items()}
    head = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    base = {c: c - (abs(c) % 20) * (1 if c >= 0 else -1) for c in own}
    return {c: own.get(base[c], [])[: head[c]] + own[c][head[c] :] for c in own}


def found(spark, rows, parts=3, **settings):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in prefix_trie.shared_prefixes(df, **settings).collect()), key=repr)


def conversations(seed, convs, longest, kinds):
    rng = random.Random(seed)
    return [
        (c, t if t else None, rng.choice(["user", None]), rng.choice(["", None, "a b", "é\x0bc  d", "x"][:kinds]), 0, 0)
        for c in convs for t in range(rng.randrange(1, longest))
    ]


CASES = [
    conversations(1, range(60), 7, 2),
    conversations(2, [*range(-45, 45, 3), 1 << 40], 6, 5),
    [(c, t, "r", "same words here", 0, 0) for c in range(90) for t in range(4)],  # one group of copies, but for the heads
    [(c, t, None, "w", 0, 0) for c in [0, 5, 21, 40] for t in range(1 + 30 * (c in (5, 21)))] + [(7, 1, "r", "only", 0, 0)],
    [(None, 1, "r", "no conversation", 0, 0), (3, 1, "r", "long " * 9000, 0, 0), (23, 1, "r", "long " * 9000, 0, 0)],
]


@pytest.mark.parametrize("rows", CASES)
@pytest.mark.parametrize("segment,shard_turns", [(64, 1 << 18), (2, 25), (1, 9)])
def test_equals_plain_trie(spark, rows, segment, shard_turns):
    assert found(spark, rows, segment=segment, shard_turns=shard_turns) == plain_trie(rebuilt(rows))


def test_repeated_rows_and_ties_do_not_depend_on_their_order(spark):
    rows = [(c, 1, "r", t, 0, 0) for c in (0, 1, 2) for t in ("b", "a", "b", "c")]
    a = found(spark, rows)
    assert a == found(spark, list(reversed(rows)), parts=2)
    assert max(r[1] for r in a) == 4 and a.count(a[0]) == 1


def test_empty_and_turnless(spark):
    assert found(spark, []) == []
    lonely = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)  # its head is missing
    empty = hashlib.sha256(str(lonely).encode()).hexdigest()
    assert found(spark, [(lonely, 1, "r", "gone", 0, 0)]) == [(lonely, 0, None, 1, 0, 1, 0, empty)]


def test_hot_conversation_is_numbered_in_ranges(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("conv_id"), (F.col("id") * 7919 % 5003).alias("turn"),
        F.lit("r").alias("role"), F.col("id").cast("string").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows, sizes = prefix_trie.numbered_turns(df)
        assert sizes.filter("conv = 7").count() > 1
        places = rows.join(sizes, ["part", "conv"]).filter("conv = 7").selectExpr("start + rank AS at").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["at"] for r in places) == list(range(len(places)))
