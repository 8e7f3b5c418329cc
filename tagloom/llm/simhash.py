"""SimHash near-duplicates found by covering locality-sensitive hashing.

Each of the 64 bits is given a non-zero vector of ``radius + 1`` bits; each
non-zero vector v of that length makes a table whose mask holds the bits with an
odd inner product with v. Up to ``radius`` differing bits always leave some v
orthogonal to all of their vectors, so that pair has equal masked fingerprints
in v's table: no pair within the radius is missed.

Buckets are not expanded into pairs. Within a bucket a fingerprint is written
next to every point half the radius away in the bits outside the mask; two
fingerprints within the radius meet at such a point, and everything that meets
at a point is within the radius. A point has at most as many neighbours as its
ball has points, so groups stay small however large the bucket is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.graph import components
from tagloom.sources.sinks import materialise

BITS = 64
SEED = 42
_SHINGLES_AT_ONCE = 1 << 18


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a text; zero for null or no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    total = len(words) - width + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, total, _SHINGLES_AT_ONCE):
        part = words[at : at + _SHINGLES_AT_ONCE + width - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(width)))) if width > 1 else part
        digests = b"".join([xxhash.xxh64_digest(g, SEED) for g in grams])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep`` and ``simhash`` (long). Reads no other column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found, pa.int64())], [*batch.schema.names[1:], "simhash"]
            )

    schema = docs.select(*keep).schema.add("simhash", "long")
    return docs.select(F.col(text).alias("_text"), *keep).mapInArrow(run, schema)


def masks(radius: int) -> list[int]:
    """The 2^(radius+1) - 1 covering masks."""
    size = (1 << (radius + 1)) - 1
    vectors = [1 + bit % size for bit in range(BITS)]
    return [sum(1 << b for b in range(BITS) if (vectors[b] & v).bit_count() % 2) for v in range(1, size + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(points: DataFrame, radius: int) -> DataFrame:
    """Edges ``a``, ``b`` that connect exactly the distinct fingerprints ``simhash`` within ``radius`` bits.

    They form stars instead of all pairs; their connected components are those of
    the full graph of pairs.
    """
    tables = masks(radius)
    keys = F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("simhash").bitwiseAND(F.lit(_signed(m))).alias("k"))
        for i, m in enumerate(tables)
    ])
    buckets = points.select("simhash", F.explode(keys).alias("e")).select("simhash", "e.t", "e.k")
    shared = buckets.groupBy("t", "k").agg(F.min("simhash").alias("lo"), F.max("simhash").alias("hi"))
    shared = shared.filter(F.col("lo") < F.col("hi")).select("t", "k")
    found = buckets.join(shared, ["t", "k"], "left_semi")
    inner = radius // 2
    outer = radius - inner
    flips = F.lit(None)
    for i, m in enumerate(tables):
        free = [b for b in range(BITS) if not m >> b & 1]
        ball = [
            F.struct(F.lit(_signed(sum(1 << b for b in c))).alias("x"), F.lit(n <= inner).alias("near"))
            for n in range(outer + 1) for c in combinations(free, n)
        ]
        flips = F.when(F.col("t") == i, F.array(*ball)).otherwise(flips)
    spots = found.select("simhash", F.explode(flips).alias("f")).select(
        "simhash", F.col("simhash").bitwiseXOR(F.col("f.x")).alias("spot"), "f.near"
    )
    met = spots.groupBy("spot").agg(
        F.min(F.when(F.col("near"), F.col("simhash"))).alias("a"), F.collect_set("simhash").alias("all")
    )
    star = met.filter(F.col("a").isNotNull() & (F.size("all") > 1))
    return star.select("a", F.explode("all").alias("b")).filter(F.col("a") != F.col("b"))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``simhash`` (long), ``component`` (smallest id reachable over links).

    Null and wordless texts have fingerprint zero and link like others; repeated
    rows are linked as any equal texts. Rows without an id take part; a
    component without any id has component null. An empty table gives no rows.
    """
    prints = materialise(
        with_fingerprints(docs.select(F.col(id).alias("_id"), F.col(text).alias("_t")), "_t", shingle, ("_id",))
    )
    points = materialise(prints.groupBy("simhash").agg(F.min("_id").alias("first")))
    roots = components(links(points.select("simhash"), radius))
    placed = points.join(roots.withColumnRenamed("node", "simhash"), "simhash", "left")
    placed = placed.select("simhash", "first", F.coalesce("root", "simhash").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component"))
    labels = placed.select("simhash", "root").join(smallest, "root").select("simhash", "component")
    return prints.join(labels, "simhash").select(F.col("_id").alias(id), "simhash", "component")


def hex_digits(value):
    """Sixteen lowercase hexadecimal digits of a long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates: that of the smallest id.

    Rows that repeat that id are told apart by a hash of their columns and equal
    ones count once; rows without an id stay only if their component has no id
    at all, again one of them.
    """
    found = materialise(near_duplicates(docs, id, text, shingle, radius))
    found = found.select(F.col(id).alias("id"), "simhash", "component")
    rows = docs.select(F.struct("*").alias("row"))  # one column, so that no name of theirs can clash
    key = F.col("row").getField(id)
    first = found.filter(F.col("id") == F.col("component")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    named = rows.join(first, key == F.col("id"), "left_semi")
    several = first.filter("n > 1").select("id")
    nameless = found.filter(F.col("component").isNull()).select("simhash").distinct()
    if several.isEmpty() and nameless.isEmpty():
        return named.select("row.*")
    once = named.join(several, key == F.col("id"), "left_anti")
    rest = _one(named.join(several, key == F.col("id"), "left_semi").withColumn("group", key))
    texts = rows.filter(key.isNull()).withColumn("text", F.col("row").getField(text))
    alone = with_fingerprints(texts, "text", shingle, ("row",)).join(nameless, "simhash", "left_semi")
    roots = components(links(nameless, radius)).withColumnRenamed("node", "simhash")
    alone = _one(alone.join(roots, "simhash", "left").withColumn("group", F.coalesce("root", "simhash")))
    return once.unionByName(rest).unionByName(alone).select("row.*")


def _one(rows: DataFrame) -> DataFrame:
    """The row of the smallest hash of each ``group``."""
    return rows.groupBy("group").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
