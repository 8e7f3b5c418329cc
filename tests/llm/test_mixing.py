import hashlib
import re

import brute
import pytest

from tagloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, target string"


def plain_targets(sizes, weights, share, most):
    """Targets by repeated sharing, source by source; ``sizes`` in order."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    target, full = dict.fromkeys(sizes, 0.0), set()
    wanted = min(share, most) * sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in full]
        left = wanted - sum(target[s] for s in full)
        for s in open_:
            target[s] = left * weight[s] / sum(weight[o] for o in open_)
        over = {s for s in open_ if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        for s in over:
            target[s] = most * sizes[s]
        full |= over


def plain_copies(doc_id, text, rate, seed=42):
    digest = hashlib.md5((text or "").encode()).hexdigest()
    key = f"{seed}:{'' if doc_id is None else doc_id}:{digest}"
    coin = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 16**13
    return int(rate) + (coin < rate - int(rate))


def mixed(spark, rows, **settings):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return mixing.repetitions(docs, keep=("doc_id", "target"), **settings).collect()


ODD = [
    (1, "one two three", "b", 0, "x"), (2, None, "b", 0, None), (3, "", None, 0, "y"), (None, "no id\x0bhere x", None, 0, "z"),
    (5, "word " * 5000, "a", 0, ""), (5, "word " * 5000, "a", 0, ""), (6, "a", "", 0, ""), (7, None, "empty", 0, ""),
    (8, "é ü 中", "Z", 0, ""), (9, "x y", "é", 0, ""), (10, "x y", "z\U0001f600", 0, ""),
]


@pytest.mark.parametrize("rows", [ODD, [(i, "w " * (i % 7), f"s{i % 5}", 0, "") for i in range(400)]])
@pytest.mark.parametrize("weights,share,most", [((3, 1, 2), 1.5, 2.0), ((1,), 0.4, 3.0), ((5, 1), 4.0, 2.0)])
def test_equals_plain_sharing(spark, rows, weights, share, most):
    sizes = {}
    for s in sorted({r[2] for r in rows}, key=lambda s: (s is None, s or "")):
        sizes[s] = sum(len(re.findall(brute.SPACES, r[1] or "")) for r in rows if r[2] == s)
    targets = plain_targets(sizes, weights, share, most)
    expected = []
    for doc_id, text, source, _, kept in rows:
        rate = targets[source] / sizes[source] if sizes[source] else 0.0
        n = len(re.findall(brute.SPACES, text or ""))
        expected.append((doc_id, kept, n, sizes[source], round(targets[source], 6), plain_copies(doc_id, text, round(rate, 9))))
    found = [
        (r.kept.doc_id, r.kept.target, r["size"], r.source_size, round(r.target, 6), r.copies)
        for r in mixed(spark, rows, weights=weights, share=share, most=most)
    ]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_hot_source_comes_near_its_target_and_reruns_agree(skewed):
    rows = [(i, "w " * (1 + i * i % 23), "hot" if i % 3 else f"s{i % 30}", 0, "") for i in range(6000)]
    found = mixed(skewed, rows)
    assert len(found) == len(rows)
    taken = sum(r["size"] * r.copies for r in found if r.kept.doc_id % 3)
    target = next(r.target for r in found if r.kept.doc_id % 3)
    assert abs(taken / target - 1) < 0.05
    assert all(r.copies <= 2 for r in found)
    again = mixed(skewed, list(reversed(rows)))
    assert sorted(found, key=repr) == sorted(again, key=repr)


def test_corpus_holds_each_row_as_often_as_counted(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    counted = {(r.kept.doc_id, r.kept.text): r.copies for r in mixing.repetitions(docs, keep=docs.columns).collect()}
    corpus = mixing.mix(docs, copy="copy")
    assert corpus.columns == [*docs.columns, "copy"]
    found = {}
    for r in corpus.collect():
        found.setdefault((r.doc_id, r.text), []).append(r.copy)
    repeated = {k: ODD.count(next(r for r in ODD if r[:2] == k)) for k in counted}
    assert {k: sorted(v) for k, v in found.items()} == {
        k: sorted([*range(1, n + 1)] * repeated[k]) for k, n in counted.items() if n}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.repetitions(docs).collect() == [] and mixing.mix(docs).collect() == []
    blank = spark.createDataFrame([(1, None, "a", 0, "")], SCHEMA)
    assert [(r["size"], r.source_size, r.target, r.copies) for r in mixing.repetitions(blank).collect()] == [(0, 0, 0.0, 0)]


def test_many_sources_are_numbered_in_order(spark):
    sizes = spark.createDataFrame([(f"s{i:05d}", 10) for i in range(3000)], "source string, size long").repartition(7)
    targets = mixing.source_targets(sizes, "source", "size", (1, 2, 3), 0.5, 2.0).collect()
    unit = 0.5 * 30000 / 6000
    assert {r.source: r.target for r in targets} == {f"s{i:05d}": unit * (i % 3 + 1) for i in range(3000)}
