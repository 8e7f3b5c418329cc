"""Labelled documents: held-out split, all of them in blocks, and bounded training samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import settings
from tagloom.sources.sinks import materialise

#: A few megabytes go to a Python worker at once, and a shuffle's files go when its job has ended.
LEAN = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: For jobs that read blocks only: a few megabytes are read at once, and a file, which holds whole blocks, is never split.
OVER_BLOCKS = LEAN | {
    "spark.sql.parquet.columnarReaderBatchSize": "8",
    "spark.sql.files.maxPartitionBytes": "1t", "spark.sql.files.openCostInBytes": "1t",
}
_PIECE = 1 << 18


def held_out(id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


@dataclass
class Sample:
    """Texts, or what they were cut to, with labels 0/1, languages, and weights that restore the shares of the classes."""

    texts: list[str] | list[tuple[bytes, bytes]]
    labels: np.ndarray
    weights: np.ndarray
    langs: list[str | None]


def training_blocks(
    docs: DataFrame, labels: DataFrame, label: str, cut: Callable[[str], tuple[bytes, bytes]], id: str = "doc_id", text: str = "text",
    lang: str | None = None, size: int = 4096, most_bytes: int = 1 << 24,
) -> DataFrame:
    """Every labelled document, in blocks of about ``size`` by a hash of its id: ``block``, ``docs`` and ``last``.

    A block is several rows of a file, one after the other, the last of them marked: rows of up to a quarter of a
    megabyte, or one document, keep buffers small. ``block_rows`` puts them together.
    ``docs`` has ``y``, ``l`` (language), ``held`` (set apart for thresholds: a fifth by
    another hash) and ``a``, ``b``, what ``cut`` makes of the whole text. Blocks end before they
    exceed ``most_bytes``, unless one document does. Repeated and null labels, ids and
    texts count as in ``training_sample``. Texts and labels meet in one shuffle, in which each
    hash has a partition of its own; the blocks are a table in the shared folder.
    """
    known = _known(labels, label, id)
    blocks = max(1, -(-known.count() // size))
    y = known.select("_id", F.lit(None).cast("string").alias("_t"), F.lit(None).cast("string").alias("_l"), "_y")
    both = _texts(docs, id, text, lang).filter(F.col("_id").isNotNull()).withColumn("_y", F.lit(None).cast("int")).unionByName(y)
    both = both.withColumn("_h", F.xxhash64("_id")).withColumn("_s", F.pmod("_h", F.lit(blocks)).cast("int")).repartitionById(blocks, "_s")
    text_of = F.min(F.when(F.col("_t").isNotNull(), F.struct("_t", "_l"))).alias("_d")
    taken = both.groupBy("_s", "_h", "_id").agg(text_of, F.max("_y").alias("_y")).filter("_d IS NOT NULL AND _y IS NOT NULL")
    held = F.pmod(F.xxhash64("_id", F.lit("held")), F.lit(5)) == 0
    ordered = taken.sortWithinPartitions("_s", "_h", "_id").select(
        "_s", F.col("_y").alias("y"), F.col("_d._l").alias("l"), held.alias("held"), F.col("_d._t").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, part, found, total, piece = None, 0, [], 0, 0

        def close(last: bool = True) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"block": block << 8 | min(part, 255), "docs": found, "last": last}], schema)

        for batch in batches:
            for row in batch.to_pylist():
                own = row.pop("_s")
                row["a"], row["b"] = cut(row.pop("t"))
                n = len(row["a"]) + len(row["b"])
                if found and (own != block or total + n > most_bytes):
                    yield close()
                    part, found, total, piece = part + 1 if own == block else 0, [], 0, 0
                elif own != block:
                    part = 0
                elif piece + n > _PIECE:
                    yield close(last=False)
                    found, piece = [], 0
                block, total, piece = own, total + n, piece + n
                found.append(row)
        if found:
            yield close()

    doc = pa.struct([("y", pa.int32()), ("l", pa.string()), ("held", pa.bool_()), ("a", pa.binary()), ("b", pa.binary())])
    schema = pa.schema([("block", pa.int64()), ("docs", pa.list_(doc)), ("last", pa.bool_())])
    with settings(docs.sparkSession, LEAN):
        return materialise(ordered.mapInArrow(
            run, "block bigint, docs array<struct<y: int, l: string, held: boolean, a: binary, b: binary>>, last boolean"))


def block_rows(
    batches: Iterator[pa.RecordBatch], held: bool,
) -> Iterator[tuple[int, np.ndarray, list[str | None], list[tuple[bytes, bytes]]]]:
    """One block of ``training_blocks`` after the other: its number, and labels, languages and texts of the documents set apart, or of the others."""
    y, langs, texts = [], [], []
    for batch in batches:
        for block, docs, last in zip(batch.column("block").to_pylist(), batch.column("docs"), batch.column("last").to_pylist()):
            own = pa.RecordBatch.from_struct_array(docs.values)
            own = own.filter(pc.equal(own.column("held"), held)).to_pydict()
            y += own["y"]
            langs += own["l"]
            texts += zip(own["a"], own["b"])
            if last:
                yield block, np.array(y, np.int64), langs, texts
                y, langs, texts = [], [], []


def _known(labels: DataFrame, label: str, id: str) -> DataFrame:
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull())
    return known.groupBy(F.col(id).alias("_id")).agg(F.max(label).cast("int").alias("_y"))


def _texts(docs: DataFrame, id: str, text: str, lang: str | None) -> DataFrame:
    return docs.select(
        F.col(id).alias("_id"), F.col(text).alias("_t"), (F.col(lang) if lang else F.lit(None)).cast("string").alias("_l")
    ).filter(F.col("_t").isNotNull())


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, id: str = "doc_id", text: str = "text",
    lang: str | None = None, cut: Callable[[str], tuple[bytes, bytes]] | None = None, most_bytes: int = 1 << 26,
) -> Sample:
    """At most ``per_class`` labelled documents of each class, those with the smallest hashes of their ids.

    The bound holds at every size; only the ids taken are sent to the scan of the
    documents. Of repeated labels the larger counts, of documents with one id the
    smallest text; null labels and ids and null texts are left out. Whole texts are
    taken; with ``cut`` they stay in the tasks, and only what it makes of them is collected.
    What is collected of a class, in the order of the hashes, ends before it exceeds
    ``most_bytes`` (the first document always counts), so very long texts do not fill the driver.
    """
    known = _known(labels, label, id)
    sizes = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    picked = None
    for y in sorted(sizes):
        some = known.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        return Sample([], np.zeros(0, np.int64), np.zeros(0), [])
    texts = _texts(docs, id, text, lang)
    taken = texts.join(F.broadcast(picked), "_id").groupBy("_id", "_y").agg(F.min(F.struct("_t", "_l")).alias("_d"))
    taken = taken.select("_id", "_y", "_d.*")
    if cut is not None:

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for some in batches:
                a, b = zip(*map(cut, some["_t"])) if len(some) else ((), ())
                yield some[["_id", "_y", "_l"]].assign(_a=list(a), _b=list(b))

        taken = taken.mapInPandas(run, taken.drop("_t").schema.add("_a", "binary").add("_b", "binary"))
    parts = [F.col(c) for c in ("_t", "_a", "_b") if c in taken.columns]
    taken = materialise(taken.withColumn("_n", sum((F.octet_length(c) for c in parts), F.lit(0)).cast("long")))
    in_order = Window.partitionBy("_y").orderBy(F.xxhash64("_id"), "_id")  # at most per_class ids and sizes
    total, place = F.sum("_n").over(in_order), F.row_number().over(in_order)
    fits = taken.select("_id", "_y", total.alias("_total"), place.alias("_place")).filter(
        (F.col("_total") <= most_bytes) | (F.col("_place") == 1)).select("_id")
    rows = taken.drop("_n").join(fits, "_id").toPandas()  # bounded in rows and in bytes, whatever the size
    rows = rows.sort_values("_id", kind="stable", ignore_index=True)
    y = rows["_y"].to_numpy(np.int64)
    taken = np.bincount(y, minlength=2)
    rate = np.array([sizes.get(c, 0) / max(1, taken[c]) for c in (0, 1)])
    weights = rate[y] / max(1e-9, (rate * taken).sum() / max(1, len(y)))
    found = rows["_t"].tolist() if cut is None else list(zip(rows["_a"], rows["_b"]))
    return Sample(found, y, weights, [x if isinstance(x, str) else None for x in rows["_l"]])
