"""Repeated byte strings, found by a logarithmic family of suffix arrays.

Suffixes are sampled by winnowing, so that every string of ``width`` bytes holds
a sampled one, and dealt to tasks by the fingerprint of their first bytes. A task
takes its suffixes in batches. A batch is sorted into a suffix array (by
fingerprint of the first half and of all that the suffix stands for, which puts
equal stretches side by side), merge-scanned against the arrays of the existing
levels for long matches, and what is new becomes a level of its own; levels of
about equal size are merged, so there are only logarithmically many. Of two
equal stretches the later is repeated, whichever came first.

Where suffixes agree in their first bytes only, the strings around them are
compared in a second family that holds each string by itself.

``add_documents`` keeps the family between runs: its levels are tables, and a new
batch of documents is scanned against them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.repeats import resolve, unpack
from tagloom.llm.winnow import OTHER, SCHEMA, Powers, Records, Rolling, byte_tokens, mix, numbered, sample, settle, union
from tagloom.sources.sinks import materialise
from tagloom.sources.versions import publish, published_version, read_published

BATCH = 1 << 17
MOST_CLASSES = 1000  # a fingerprint with more different surroundings is compared string by string over all tasks


class IndexFamily:
    """Levels of sorted records, each holding the first place of its stretches."""

    def __init__(self):
        self.levels: list[Records] = []

    def add(self, batch: Records) -> Records:
        """Take a batch in; returns the places found to be repeated."""
        new, late = _suffix_array(batch)
        repeated = [late]
        for level in self.levels:
            new, late = _merge_scan(new, level)
            repeated.append(late)
        self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2].doc) <= 2 * len(self.levels[-1].doc):
            last = self.levels.pop()
            self.levels[-1] = _sorted(Records.join([self.levels[-1], last]))
        return Records.join(repeated)

    def whole(self) -> Records:
        return _sorted(Records.join(self.levels)) if self.levels else _none()


def _none() -> Records:
    return Records(np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))


def _sorted(records: Records) -> Records:
    return records.take(np.lexsort((records.start, records.doc, records.context, records.anchor)))


def _suffix_array(batch: Records) -> tuple[Records, Records]:
    """The first record of each class, in order, and the later ones."""
    batch = _sorted(batch)
    fresh = np.ones(len(batch.doc), bool)
    fresh[1:] = (batch.anchor[1:] != batch.anchor[:-1]) | (batch.context[1:] != batch.context[:-1])
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(fresh) else np.zeros(0, np.int64)
    late = (batch.doc != batch.doc[first]) | (batch.start != batch.start[first])
    return batch.take(fresh), batch.take(late)


def _ordered_keys(records: Records) -> np.ndarray:
    both = np.stack([records.anchor, records.context], axis=1).astype(">u8")
    return both.view("S16").ravel()


def _merge_scan(batch: Records, level: Records) -> tuple[Records, Records]:
    """What the level does not have, and the later place of each match; the level keeps the earlier one."""
    if not len(level.doc) or not len(batch.doc):
        return batch, batch.take(np.zeros(0, np.int64))
    near = np.minimum(np.searchsorted(_ordered_keys(level), _ordered_keys(batch)), len(level.doc) - 1)
    same = (level.anchor[near] == batch.anchor) & (level.context[near] == batch.context)
    mine, theirs = np.flatnonzero(same), near[same]
    a, b = batch.take(mine), level.take(theirs)
    earlier = (a.doc < b.doc) | ((a.doc == b.doc) & (a.start < b.start))
    later = (b.doc < a.doc) | ((a.doc == b.doc) & (b.start < a.start))
    level.doc[theirs[earlier]], level.start[theirs[earlier]] = a.doc[earlier], a.start[earlier]
    return batch.take(~same), Records.join([a.take(later), b.take(earlier)])


def _stretches(found: Records, width: int, key: np.ndarray | None = None) -> pa.RecordBatch:
    if key is None:
        doc, start, stop = union(found.doc, found.start, found.start + found.windows + width - 1)
        keys = pa.nulls(len(doc), pa.int64())
    else:
        doc, start, stop, keys = found.doc, found.start, found.windows, pa.array(key.view(np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), keys],
        ["doc", "start", "stop", "key"],
    )


STRETCHES = "doc bigint, start bigint, stop bigint, key bigint"


def match_suffixes(sampled: DataFrame, width: int) -> DataFrame:
    """``STRETCHES`` (see ``resolve``) from records (``SCHEMA``); runs of windows to be compared one by one have key 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, held, size = IndexFamily(), [], 0
        for batch in batches:
            key, context, doc, start, n, done = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield _stretches(Records(key[done], context[done], doc[done], start[done], n[done] - start[done] - width + 1), width)
            some = ~done
            held.append(Records(key[some].view(np.uint64), context[some].view(np.uint64), doc[some], start[some], n[some]))
            size += len(held[-1].doc)
            if size >= BATCH:
                yield _stretches(family.add(Records.join(held)), width)
                held, size = [], 0
        if size:
            yield _stretches(family.add(Records.join(held)), width)
        index = family.whole()
        if len(index.doc):
            group = np.cumsum(np.concatenate([[0], index.anchor[1:] != index.anchor[:-1]]))
            classes = np.bincount(group)[group]
            open_ = classes > 1
            key = np.where(classes > MOST_CLASSES, np.uint64(0), index.anchor)
            yield _stretches(index.take(open_), width, key[open_])

    return sampled.repartition("key").mapInArrow(run, STRETCHES)


def _surroundings(width: int):
    """The bytes of each run of windows of the documents given; runs with key 0 as single windows under their own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                docs = part.column(0).to_numpy(zero_copy_only=False)
                rows: list[tuple] = []
                single: list[Records] = []
                for doc, z, size, runs in zip(docs.tolist(), part.column(1), part.column(2), part.column(3)):
                    text = unpack(z, size.as_py())
                    open_ = [m for m in runs.as_py() if m["key"] is not None]
                    rows += [
                        (m["key"], doc, m["start"], m["stop"], text[m["start"] : m["start"] + m["stop"] - 1 + width])
                        for m in open_ if m["key"]
                    ]
                    first = np.array([m["start"] for m in open_ if not m["key"]], np.int64)
                    if len(first):
                        count = np.array([m["stop"] for m in open_ if not m["key"]], np.int64)
                        places = np.unique(np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum()))
                        single.append(_strings(byte_tokens([text], powers)[0], places, doc, 0, width, powers))
                for done in settle(Records.join(single), width) if single else ():
                    key, context, doc, start, n, flag = (c.to_pylist() for c in done.columns)
                    # a string under its own hash needs no bytes: both hashes are the record
                    rows += [
                        (k, d, s, w, None if f else c.to_bytes(8, "little", signed=True))
                        for k, c, d, s, w, f in zip(key, context, doc, start, n, flag)
                    ]
                columns = list(zip(*rows)) if rows else [()] * 5
                types = [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["key", "doc", "start", "n", "bytes"]
                )

    return run


def _strings(tokens: np.ndarray, places: np.ndarray, doc, shift, width: int, powers: Powers) -> Records:
    """A record for each string of ``width`` bytes from ``places``."""
    one, two = Rolling(tokens, powers), Rolling(mix(tokens ^ OTHER), powers)
    return Records(
        mix(one.some(places, places + width)), mix(two.some(places, places + width)),
        np.broadcast_to(np.asarray(doc, np.int64), places.shape).copy(), places + shift, np.ones(len(places), np.int64),
    )


def compare_strings(waiting: DataFrame, width: int) -> DataFrame:
    """The repeated stretches among the open runs of the documents given, by a family of single strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, powers = IndexFamily(), Powers()
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                key, doc, start, n = (part.column(c).to_numpy(zero_copy_only=False) for c in range(4))
                texts = part.column(4).to_pylist()
                size = np.array([-1 if t is None else len(t) for t in texts])
                known, own = size < 0, size == 8
                found = []
                if known.any():
                    yield _stretches(
                        Records(key[known], key[known], doc[known], start[known], n[known] - start[known] - width + 1), width
                    )
                if own.any():
                    context = np.frombuffer(b"".join(t for t, o in zip(texts, own) if o), np.uint64)
                    found.append(Records(key[own].view(np.uint64), context, doc[own], start[own], n[own]))
                runs = np.flatnonzero(size > 8)
                if len(runs):
                    tokens = byte_tokens([b"".join(texts[i] for i in runs)], powers)[0]
                    count = n[runs]
                    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    began = np.repeat(np.cumsum(size[runs]) - size[runs], count)
                    places = began + inside
                    shift = np.repeat(start[runs], count) - began
                    found.append(_strings(tokens, places, np.repeat(doc[runs], count), shift, width, powers))
                if found:
                    yield _stretches(family.add(Records.join(found)), width)

    schema = "key bigint, doc bigint, start bigint, n bigint, bytes binary"
    rows = waiting.select("doc", "z", "size", "marks").mapInArrow(_surroundings(width), schema)
    return rows.repartition("key").mapInArrow(run, STRETCHES)


def _cut(text: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[int, bytes]:
    if not len(start):
        return len(text), text
    edges = [0, *np.stack([start, stop], axis=1).ravel().tolist(), len(text)]
    return len(text), b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 100, keep: tuple[str, ...] = (),
    digest: bool = False,
) -> DataFrame:
    """Remove each byte covered by ``width`` bytes that also start earlier, in UTF-8.

    Earlier is in a smaller id, or before in the same document; strings are judged
    on the input. ``width`` is at least 16. Returns, for each row of ``docs``, ``id``, the columns
    ``keep``, ``n_bytes``, ``n_removed``, ``spans`` (removed runs, as byte places
    from and up to) and ``kept``: the remaining bytes, or with ``digest`` their
    SHA-256 in hexadecimal digits.

    A null text is empty. Rows that repeat an id are ordered by a hash of their
    text after rows without id; rows that repeat id and text count once and get
    equal results. Matches never cross rows. An empty table gives no rows.
    """
    if width < 16:
        raise ValueError("width must be at least 16")
    rows = numbered(docs, id, text, (id, *keep))
    known = materialise(match_suffixes(sample(rows, byte_tokens, width, width // 2), width))
    done = resolve(rows, known, _cut, digest, lambda waiting: compare_strings(waiting, width))
    return done.select(
        F.col("c0").alias(id), *[F.col(f"c{i + 1}").alias(k) for i, k in enumerate(keep)], F.col("n").alias("n_bytes"),
        F.col("removed").alias("n_removed"), "spans", "kept",
    )


LEVEL = "key bigint, context bigint, doc bigint, start bigint, n bigint"


def _manifest(spark: SparkSession, root: str) -> list:
    """Folders of the levels (the oldest first, with their rows) and of the texts: some dozens of rows at any size."""
    if published_version(spark, root) is None:
        return []
    return read_published(spark, root, "manifest").orderBy("place").collect()


def _store_level(records: DataFrame, root: str) -> tuple[str, int]:
    """Write a level, sorted by fingerprints; its folder and its number of rows."""
    path = f"{root}/levels/{uuid.uuid4()}"
    records.repartitionByRange("key", "context").sortWithinPartitions("key", "context").write.parquet(path)
    return path, records.sparkSession.read.parquet(path).count()


def add_documents(
    docs: DataFrame, root: str, id: str = "doc_id", text: str = "text", width: int = 100, keep: tuple[str, ...] = (),
    digest: bool = False,
) -> DataFrame:
    """``remove_repeats`` for a new batch of documents against all batches added to the index in ``root`` before.

    Returns the rows of the batch, as if it had been judged together with the earlier
    ones, and adds it to the index. Ids are whole numbers, distinct, and larger than
    those of earlier batches. Of the stored levels only records whose first half the
    batch has as well are read on; texts of earlier documents are compared where the
    halves agree and the surroundings do not. The batch's new records become a level
    of their own, and levels of about equal size are merged, so that there are only
    logarithmically many. Levels and texts count from the moment the new version of
    the index is published: a failed batch changes nothing.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id).cast("long").alias("doc"), F.col(text).alias("text"), *[F.col(k).alias(f"c{i}") for i, k in enumerate((id, *keep))])
    base, stored = published_version(spark, root), _manifest(spark, root)
    ids = rows.agg(F.min("doc").alias("first"), F.count("doc").alias("n"), F.count_distinct("doc").alias("distinct"),
                   F.count(F.lit(1)).alias("all"), F.max("doc").alias("last")).first()
    newest = max((r["last"] for r in stored), default=None)
    if not ids["n"] == ids["distinct"] == ids["all"] or (ids["n"] and newest is not None and ids["first"] <= newest):
        raise ValueError("ids must be distinct and larger than those of earlier batches")
    levels = [(r["path"], r["rows"]) for r in stored if r["kind"] == "level"]
    texts = [r["path"] for r in stored if r["kind"] == "texts"]

    found = materialise(sample(rows, byte_tokens, width, width // 2))
    own = found.filter("NOT done").drop("done")
    index = spark.read.schema(LEVEL).parquet(*[p for p, _ in levels]) if levels else spark.createDataFrame([], LEVEL)
    met = index.join(own.select("key").distinct(), "key", "left_semi").withColumn("done", F.lit(False))
    known = match_suffixes(found.unionByName(met.select(*found.columns)), width)
    is_new = F.lit(True) if newest is None else F.col("doc") > newest
    known = materialise(known.filter(is_new | F.col("key").isNotNull()))
    asked = rows
    if texts:
        waiting = known.filter(~is_new).select("doc").distinct()
        asked = rows.unionByName(
            spark.read.schema("doc bigint, text string").parquet(*texts).join(waiting, "doc", "left_semi"), allowMissingColumns=True)
    done = resolve(asked, known, _cut, digest, lambda open_: compare_strings(open_, width)).filter(is_new)

    classes = own.groupBy("key", "context").agg(F.min(F.struct("doc", "start", "n")).alias("first")).select("key", "context", "first.*")
    levels.append(_store_level(classes.join(index, ["key", "context"], "left_anti"), root))
    while len(levels) > 1 and levels[-2][1] <= 2 * levels[-1][1]:
        (a, _), (b, _) = levels.pop(), levels.pop()
        levels.append(_store_level(spark.read.schema(LEVEL).parquet(a, b), root))
    path = f"{root}/texts/{uuid.uuid4()}"
    rows.select("doc", "text").write.parquet(path)
    result = materialise(done.select(
        F.col("c0").alias(id), *[F.col(f"c{i + 1}").alias(k) for i, k in enumerate(keep)], F.col("n").alias("n_bytes"),
        F.col("removed").alias("n_removed"), "spans", "kept"))
    last = max((x for x in (newest, ids["last"]) if x is not None), default=None)
    entries = [("level", p, n) for p, n in levels] + [("texts", p, 0) for p in [*texts, path]]
    manifest = spark.createDataFrame(
        [(k, *e, last) for k, e in enumerate(entries)], "place int, kind string, path string, rows bigint, last bigint")
    publish({"manifest": manifest.coalesce(1)}, root, based_on=base)
    return result
