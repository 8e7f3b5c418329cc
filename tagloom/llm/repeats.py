"""What the two operators that remove repeated text share: from repeated stretches back to texts.

Texts travel compressed. Documents without open windows are finished at the
first join with their stretches; only the others are kept for a second one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.winnow import union
from tagloom.sources.sinks import materialise

MARKS = "array<struct<start: bigint, stop: bigint, key: bigint>>"
_CODEC = "zstd"


def packed(docs: DataFrame) -> DataFrame:
    """``text`` (a string or null) replaced by ``z``, its compressed bytes, and ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [t.as_buffer() if t.is_valid else pa.py_buffer(b"") for t in batch.column(at)]
            z = pa.array([pa.compress(t, codec=_CODEC, asbytes=True) for t in texts], pa.binary())
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), z, pa.array([t.size for t in texts], pa.int64())],
                [*(batch.schema.names[i] for i in rest), "z", "size"],
            )

    return docs.mapInArrow(run, docs.drop("text").schema.add("z", "binary").add("size", "long"))


def unpack(z: pa.BinaryScalar, size: int) -> bytes:
    return pa.decompress(z.as_buffer(), decompressed_size=size, codec=_CODEC, asbytes=True) if size else b""


def marks(rows: DataFrame) -> DataFrame:
    """One row for each ``doc`` with its stretches; at most as many as the document has tokens."""
    return rows.groupBy("doc").agg(F.collect_list(F.struct("start", "stop", "key")).alias("marks"))


def joined(docs: DataFrame, rows: DataFrame) -> DataFrame:
    return docs.join(marks(rows), "doc", "left").select(*docs.columns, F.col("marks").cast(MARKS).alias("marks"))


def finish(docs: DataFrame, cut: Callable, digest: bool, more: DataFrame | None = None) -> DataFrame:
    """Apply the stretches in ``marks`` to each text.

    Documents with open windows (marks with a key) are passed on with kind 1 and
    all their columns, the others get kind 0 and the results of ``cut``: number
    of tokens, removed ones, removed runs (pairs of places), and what is kept, or
    its SHA-256 with ``digest``. ``docs`` has ``doc``, c0, c1, ..., ``z``, ``size``, ``marks``.
    """
    from hashlib import sha256

    extra = [c for c in docs.columns if c not in ("doc", "z", "size", "marks")]
    pair = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    schema = docs.select("doc", *extra, "z", "size", "marks").schema
    for name, kind in (("kind", T.IntegerType()), ("n", T.LongType()), ("removed", T.LongType()), ("spans", pair),
                       ("kept", T.BinaryType())):
        schema = schema.add(name, kind)
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                z, sizes, found = (part.column(part.schema.get_field_index(c)) for c in ("z", "size", "marks"))
                lists = found.fill_null([]) if found.null_count else found
                flat = lists.flatten()
                owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                starts, stops = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                is_open = np.asarray(flat.field(2).is_valid())
                waits = np.zeros(len(lists), bool)
                waits[owner[is_open]] = True
                doc, start, stop = union(owner[~is_open], starts[~is_open], stops[~is_open])
                cuts = np.searchsorted(doc, np.arange(len(lists) + 1))
                kinds, counts, gone, spans, kept, left, size = [], [], [], [], [], [], []
                for i in range(len(lists)):
                    kinds.append(int(waits[i]))
                    if waits[i]:
                        left.append(z[i].as_py())
                        size.append(sizes[i].as_py())
                        for column in (counts, gone, spans, kept):
                            column.append(None)
                        continue
                    own = slice(cuts[i], cuts[i + 1])
                    n, rest = cut(unpack(z[i], sizes[i].as_py()), start[own], stop[own])
                    counts.append(n)
                    gone.append(int((stop[own] - start[own]).sum()))
                    spans.append([{"start": a, "stop": b} for a, b in zip(start[own].tolist(), stop[own].tolist())])
                    kept.append(sha256(rest).hexdigest().encode() if digest else rest)
                    left.append(None)
                    size.append(None)
                open_marks = found.take(pa.array(np.arange(len(lists)), mask=~waits))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(part.schema.get_field_index(c)) for c in ("doc", *extra)),
                        pa.array(left, pa.binary()), pa.array(size, pa.int64()), open_marks, pa.array(kinds, pa.int32()),
                        pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pairs),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc", *extra, "z", "size", "marks", "kind", "n", "removed", "spans", "kept"],
                )

    return docs.select("doc", *extra, "z", "size", "marks").mapInArrow(run, schema)


def resolve(docs: DataFrame, known: DataFrame, cut: Callable, digest: bool, compare: Callable) -> DataFrame:
    """From stretches and open windows to results, one row for each of ``docs``.

    ``known`` has ``doc``, ``start``, ``stop`` and ``key``: null for a repeated
    stretch, else the key of a run of windows that starts at ``start`` and has
    ``stop`` windows. ``compare`` takes the documents that have such runs and
    returns their repeated stretches.
    """
    first = materialise(finish(joined(packed(docs), known), cut, digest))
    waiting = first.filter("kind = 1").drop("kind", "n", "removed", "spans", "kept")
    decided = compare(waiting).select("doc", "start", "stop", F.lit(None).cast("long").alias("key"))
    before = waiting.select("doc", F.explode(F.filter("marks", lambda m: m["key"].isNull())).alias("m"))
    decided = decided.unionByName(before.select("doc", "m.*"))
    second = finish(joined(waiting.drop("marks"), decided), cut, digest)
    return first.filter("kind = 0").unionByName(second).drop("z", "size", "marks", "kind")
