"""Prefix trie of conversations.

Every distinct sequence of a conversation's first turns is a node. Turns become
128-bit ids, conversations paths of ids. Paths are cut into segments of
``SEGMENT`` turns, so that a conversation may have any length; a segment knows
its place and the key of all that comes before it (ids are combined by exclusive
or, which Spark sums up over parts of any size).

Segments are range-partitioned into shards in the order of their paths. A task
ranks the ids of its shard, pads them to a matrix of turn ids and sorts it
(``numpy.lexsort``). Where a column changes from one row to the next, or any
column left of it, a node starts; these change masks are accumulated from left to
right, and each depth is aggregated over the rows between its node starts
(``reduceat``), from the deepest up.

Nodes that hold a shard's first or last row, or conversations that go on in the
next segment, are open: they come out as parts, without each other's share.
Parts are added up by key, and the sums over subtrees of open nodes are found by
doubling: each node passes what it has to an ancestor twice as far away each
time. Members that end in an open node leave the shards as compressed lists, which
one pass in their order hashes piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.sources.sinks import materialise

WORD = r"[^\x20\x09-\x0D]+"
SEGMENT = 64  # turns in a row of a matrix
SHARD_TURNS = 1 << 18  # turns and rows of a shard, about
_SUPER = 1024  # segments whose prefixes are combined by one window

KEY = ["depth", "k1", "k2"]
NODES = (
    "shard int, open boolean, part boolean, depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, parent bigint, first bigint, "
    "n bigint, words bigint, children bigint, leaves bigint, saved bigint, sha string, ends binary"
)


def numbered_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Turns ``(part, conv, rank, m, words)`` and sizes ``(part, conv, start, n)``: a turn's place is start + rank.

    ``m`` is the MD5 of role and text; turns with one number come in its order,
    turns without number come first. Turns are sorted into ranges by all of this,
    so that a conversation with most of all turns spreads over many tasks. Only
    the digests move, not the texts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), digest.alias("m"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    ).filter(F.col("conv").isNotNull())
    order = [F.col("turn").asc_nulls_first(), F.col("m")]
    ranged = materialise(rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()))
    rank = F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order)).cast("long") - 1
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part", "conv").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return ranged.select("part", "conv", rank.alias("rank"), "m", "words"), sizes


def shared_head(conv: Column, every: int = 20, most: int = 4) -> tuple[Column, Column]:
    """Conversation whose first turns are taken, and how many: CRC-32 of the decimal id modulo ``most``."""
    return conv - conv % every, F.crc32(conv.cast("string").cast("binary")) % most


def rebuilt_turns(turns: DataFrame, every: int = 20, most: int = 4, **columns: str) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from another one (``shared_head``): turns ``(conv, pos, m, words)`` and
    conversations ``(conv, size)``, also those without turns. Rows without conversation id take no part.
    """
    rows, sizes = numbered_turns(turns, **columns)
    sizes = materialise(sizes)
    base, head = shared_head(F.col("conv"), every, most)
    convs = sizes.groupBy("conv").agg(F.sum("n").alias("n"))
    given = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    known = convs.select("conv", "n", base.alias("base"), head.alias("head")).join(given, "base", "left").select(
        "conv", "n", "base", "head", F.least("head", F.coalesce("base_n", F.lit(0))).alias("taken"))
    known = materialise(known)
    starts = sizes.select("part", "conv", "start").join(known.select("conv", "head", "taken"), "conv")
    placed = materialise(rows.join(starts, ["part", "conv"]).select(
        "conv", (F.col("start") + F.col("rank")).alias("at"), "head", "taken", "m", "words"))
    own = placed.filter(F.col("at") >= F.col("head")).select(
        "conv", (F.col("at") - F.col("head") + F.col("taken")).alias("pos"), "m", "words")
    heads = placed.filter(F.col("at") < most - 1).select(F.col("conv").alias("base"), F.col("at").alias("pos"), "m", "words")
    taken = known.filter("taken > 0").join(heads, "base").filter(F.col("pos") < F.col("taken")).select("conv", "pos", "m", "words")
    size = (F.greatest(F.col("n") - F.col("head"), F.lit(0)) + F.col("taken")).alias("size")
    return own.union(taken), known.select("conv", size)


def segments(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Paths cut into segments: ``seg``, the key ``k1, k2`` of what is before, ``path`` (two numbers a turn), ``words``,
    ``conv``, ``more`` (whether the conversation goes on in the next segment).
    """
    ids = turns.select(
        "conv", F.floor(F.col("pos") / segment).alias("seg"), "pos", F.xxhash64("m", "pos").alias("x"),
        F.xxhash64("pos", F.reverse("m")).alias("y"), "words",
    )
    rows = ids.groupBy("conv", "seg").agg(
        F.sort_array(F.collect_list(F.struct("pos", "x", "y", "words"))).alias("turns"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
    ).withColumn("super", F.floor(F.col("seg") / _SUPER))
    rows = materialise(rows)
    up_to = Window.partitionBy("conv").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    above = rows.groupBy("conv", "super").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.max("seg").alias("last")).select(
        "conv", "super", F.coalesce(F.bit_xor("x").over(up_to), F.lit(0)).alias("s1"), F.coalesce(F.bit_xor("y").over(up_to), F.lit(0)).alias("s2"),
        F.max("last").over(Window.partitionBy("conv")).alias("last"),
    )
    near = Window.partitionBy("conv", "super").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    keyed = rows.withColumns({
        "k1": F.coalesce(F.bit_xor("x").over(near), F.lit(0)), "k2": F.coalesce(F.bit_xor("y").over(near), F.lit(0)),
    }).join(above, ["conv", "super"])
    path = F.flatten(F.transform("turns", lambda t: F.array(t["x"], t["y"])))
    found = keyed.select(
        "seg", F.col("k1").bitwiseXOR(F.col("s1")).alias("k1"), F.col("k2").bitwiseXOR(F.col("s2")).alias("k2"), path.alias("path"),
        F.col("turns.words").alias("words"), "conv", (F.col("seg") < F.col("last")).alias("more"),
    )
    nothing = F.array().cast("array<bigint>")
    zero = F.lit(0).cast("long")
    bare = convs.filter("size = 0").select(zero, zero, zero, nothing, nothing, "conv", F.lit(False))
    return found.union(bare)


def _dense(a: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Rank of each row of the columns given, equal rows alike."""
    columns = (a, *others)
    order = np.lexsort(columns[::-1])
    change = np.zeros(len(a), bool)
    for c in columns:
        change[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(a), np.int32)
    out[order] = np.cumsum(change)
    return out


def _over(ufunc, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``ufunc`` over values[start:end] for each node; ``values`` has one place more than there are rows."""
    return ufunc.reduceat(values, np.stack([start, end], axis=1).ravel())[::2] if len(start) else values[:0]


def shard_nodes(seg, k1, k2, sizes, path, words, conv, more, segment: int, shard: int) -> Iterator[pa.RecordBatch]:
    """Nodes (``NODES``) of the rows of one shard, in any order; ``path`` and ``words`` are all rows' lists joined."""
    from hashlib import sha256

    n, width = len(conv), int(sizes.max(initial=0))
    group = _dense(seg, k1, k2)
    row = np.repeat(np.arange(n), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    matrix = np.full((width, n), -1, np.int32)  # a row for each depth
    x, y = path[::2], path[1::2]
    matrix[at, row] = _dense(x, y)
    order = np.lexsort([conv, *matrix[::-1], group])
    matrix, group, seg, conv, more, lens = matrix[:, order], group[order], seg[order], conv[order], more[order], sizes[order]
    first_at = (np.cumsum(sizes) - sizes)[order]  # where a row's turns lie in path and words
    k1, k2 = k1[order], k2[order]

    change = np.ones(n, bool)
    change[1:] = group[1:] != group[:-1]
    levels = []
    for d in range(width + 1):
        if d:
            change[1:] |= matrix[d - 1, 1:] != matrix[d - 1, :-1]
            deep = np.flatnonzero(lens >= d)
            k1[deep] ^= x[first_at[deep] + d - 1]
            k2[deep] ^= y[first_at[deep] + d - 1]
        start = np.flatnonzero(change)
        end = np.append(start[1:], n)
        node = lens[start] >= d
        levels.append((start[node], end[node], k1[start[node]], k2[start[node]]))

    padded = lambda a: np.append(a, a[:1])
    conv_, goes_on = padded(conv), padded(more.astype(np.int64))
    leaves, saved = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    children = np.zeros(n + 1, np.int64)
    for d in range(width, -1, -1):
        start, end, key1, key2 = levels[d]
        if not len(start):
            continue
        deep = seg[start] * segment + d
        count = end - start
        part = (seg[start] > 0) & (d == 0)  # the node itself belongs to the segment before
        is_open = (start == 0) | (end == n) | (_over(np.add, goes_on, start, end) > 0) | (d == 0)
        own_words = words[first_at[start] + d - 1] if d else np.zeros(len(start), np.int64)
        below = _over(np.add, children, start, end)
        closed = start[~is_open]
        leaves[closed] += below[~is_open] == 0
        saved[closed] += ((count - 1) * own_words)[~is_open]
        first = _over(np.minimum, conv_, start, end)
        ended = padded(((lens == d) & ~more).astype(np.int64))
        ending = np.where(part, 0, _over(np.add, ended, start, end))
        shas, lists = [], []
        for s, e, k, o in zip(start.tolist(), end.tolist(), ending.tolist(), is_open.tolist()):
            text = b""
            if k:
                some = conv[s : s + k] if not o else conv[s:e][ended[s:e] > 0]
                text = ",".join(map(str, some.tolist())).encode()
            shas.append(None if o else sha256(text).hexdigest())
            lists.append(pa.compress(text, codec="zstd", asbytes=True) if o and k else None)
        if d:
            up = levels[d - 1]
            own = np.searchsorted(up[0], start, "right") - 1
            above1, above2, top, bottom = up[2][own], up[3][own], up[0][own], up[1][own]
            hidden = (top == 0) | (bottom == n) | (d == 1) | (_over(np.add, goes_on, top, bottom) > 0)
            above = np.minimum.reduceat(conv_, np.stack([top, bottom], 1).ravel())[::2] if len(top) else top
        else:
            above1 = above2 = above = np.zeros(len(start), np.int64)
            hidden = np.ones(len(start), bool)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(start), shard, np.int32)), pa.array(is_open), pa.array(part), pa.array(deep, pa.int64()),
            pa.array(key1), pa.array(key2), pa.array(above1), pa.array(above2), pa.array(above, pa.int64(), mask=hidden),
            pa.array(first, pa.int64(), mask=part), pa.array(np.where(part, 0, count), pa.int64()), pa.array(own_words, pa.int64()),
            pa.array(below), pa.array(_over(np.add, leaves, start, end)), pa.array(_over(np.add, saved, start, end)),
            pa.array(shas, pa.string()), pa.array(lists, pa.binary()),
        ], [c.split()[0] for c in NODES.split(", ")])
        children[:] = 0
        children[closed] = 1
        for s, e in zip(start[is_open].tolist(), end[is_open].tolist()):  # counted in the open node, which passes it on
            leaves[s:e] = saved[s:e] = 0


def _shards(rows: DataFrame, segment: int, shards: int) -> DataFrame:
    """``NODES`` of each shard; a task holds one shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        number = lambda c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False)
        joined = lambda c: pc.list_flatten(table.column(c)).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = pc.list_value_length(table.column("words")).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
        yield from shard_nodes(
            number("seg"), number("k1").copy(), number("k2").copy(), sizes, joined("path"), joined("words"), number("conv"),
            number("more"), segment, TaskContext.get().partitionId())

    order = ["seg", "k1", "k2", "path", "conv"]
    return rows.repartitionByRange(shards, *order).mapInArrow(run, NODES)


def _ends(parts: DataFrame) -> DataFrame:
    """SHA-256 of the lists of each open node, joined in the order of the shards; a pass over sorted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        import zstandard

        key, digest, unpacker = None, None, zstandard.ZstdDecompressor()
        names = [*KEY, "sha"]

        def done():
            return pa.RecordBatch.from_pylist([dict(zip(names, [*key, digest.hexdigest()]))], schema=schema)

        schema = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("sha", pa.string())])
        for batch in batches:
            for depth, k1, k2, ends in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ends"))):
                if key != (depth, k1, k2):
                    if key is not None:
                        yield done()
                    key, digest = (depth, k1, k2), sha256()
                else:
                    digest.update(b",")
                digest.update(unpacker.decompressobj().decompress(ends))
        if key is not None:
            yield done()

    rows = parts.filter(F.col("ends").isNotNull()).select(*KEY, "shard", "ends")
    return rows.repartition(*KEY).sortWithinPartitions(*KEY, "shard").select(*KEY, "ends").mapInArrow(
        run, "depth bigint, k1 bigint, k2 bigint, sha string")


def _subtrees(nodes: DataFrame) -> DataFrame:
    """Sums of ``leaves`` and ``saved`` over the subtrees of open nodes; every node's parent is open too.

    After i rounds a node has the sums of its descendants less than 2**i away, and passes them 2**i up.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    state = nodes.select(
        *KEY, (F.col("depth") - 1).alias("a0"), F.col("p1").alias("a1"), F.col("p2").alias("a2"), "leaves", "saved")
    up = ["a0", "a1", "a2"]
    for i in range(deepest.bit_length()):
        passed = state.filter("a0 >= 0").groupBy(*up).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        target = state.select(*[F.col(c).alias(u) for c, u in zip(KEY, up)], *[F.col(u).alias(f"next_{u}") for u in up])
        sums = passed.select(*[F.col(u).alias(c) for u, c in zip(up, KEY)], "l", "s")
        moved = state.join(sums, KEY, "left").join(target, up, "left").select(
            *KEY, *[F.coalesce(f"next_{u}", F.lit(-1)).alias(u) for u in up],
            (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
        )
        state = materialise(moved)
    return state.select(*KEY, "leaves", "saved")


def trie(
    turns: DataFrame, convs: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """All nodes of the trie of conversations.

    ``turns`` has ``conv``, ``pos`` (from 0, without gaps), ``m`` (digest of the turn) and ``words``; ``convs`` has each
    ``conv`` once and its ``size`` in turns. Returns ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null
    for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256`` (of the ids of members
    that end here, in order, joined by commas). Turns are equal if their 128-bit ids are. Without conversations there
    is no root either.
    """
    rows = materialise(segments(turns, convs, segment))
    total = rows.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    found = materialise(_shards(rows, segment, max(1, -(-int(total) // shard_turns))))
    parts = found.filter("open")
    merged = materialise(parts.groupBy(*KEY).agg(
        F.max(F.when(~F.col("part"), F.col("p1"))).alias("p1"), F.max(F.when(~F.col("part"), F.col("p2"))).alias("p2"),
        F.min("first").alias("first"), F.sum("n").alias("n"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")],
    ))
    more = merged.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("more"))
    counted = merged.join(more, KEY, "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    whole = materialise(counted.withColumns({
        "leaves": F.col("leaves") + F.when(F.col("children") == 0, 1).otherwise(0),
        "saved": F.col("saved") + (F.col("n") - 1) * F.col("words"),
    }))
    above = whole.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("first").alias("parent"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    opened = whole.drop("leaves", "saved").join(_subtrees(whole), KEY).join(_ends(parts), KEY, "left").join(
        above, ["depth", "p1", "p2"], "left").withColumn("sha", F.coalesce("sha", nothing))
    # closed nodes under open ones: at most a shard's rows for each open part
    closed = found.filter(~F.col("open"))
    per_shard = parts.select("shard", *KEY).distinct().join(whole.select(*KEY, F.col("first").alias("up")), KEY).select(
        "shard", (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), "up")
    hidden = closed.filter(F.col("parent").isNull()).join(per_shard, ["shard", "depth", "p1", "p2"]).withColumn("parent", F.col("up"))
    out = [
        F.col("first").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("sha").alias("ends_sha256"),
    ]
    return reduce(DataFrame.union, [df.select(*out) for df in (closed.filter(F.col("parent").isNotNull()), hidden, opened)])


def shared_prefixes(conversations: DataFrame, every: int = 20, most: int = 4, **settings: int) -> DataFrame:
    """The trie of conversations rebuilt by ``rebuilt_turns``.

    Turns of a conversation come in the order of ``turn``, without number first; turns with one number in the order of a
    digest of role and text, and repeated rows are turns of their own. Null roles and texts are empty. Rows without
    ``conv_id`` take no part, further columns are not read, and an empty table gives no rows.
    """
    return trie(*rebuilt_turns(conversations, every, most), **settings)
