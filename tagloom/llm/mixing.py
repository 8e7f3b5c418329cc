"""Mixing sources to target weights.

Words are summed per source, which combines before the shuffle. Each source gets
a target: its weight's part of the words wanted, but no more than ``most`` times
its own; what is above is shared again by weight until none is above. Target by
size is the source's repetition rate. A document is emitted floor(rate) times,
and once more if a hash of its id, its text and a seed, read as a number from 0
to 1, is below the fraction of the rate.

No document moves for this: a source's rate joins its documents, split where a
source has more rows than one task should take. Built from Spark SQL functions
only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.operators.keyed import hot_key_join
from tagloom.sources.sinks import materialise

WORD = r"[^\x20\x09-\x0D]+"
_DIGITS = 13  # hexadecimal digits of a hash that are read as a number


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[int], share: float, most: float
) -> DataFrame:
    """Add ``target`` to a table of distinct sources and their sizes (not null).

    Weights repeat over the sources in the order of their code points, a null
    source last. Together the targets make ``share`` times all sizes, or ``most``
    times if that is less. Sources are ordered in ranges, so their number is not
    bounded by a task; each round of sharing is one sum over them.
    """
    order = [F.col(source).isNull(), F.col(source)]
    ranged = materialise(
        sizes.select(source, F.col(size).alias("size")).repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weighed = materialise(ranged.join(starts, "part").withColumn("place", place).select(
        source, "size", F.get(cycle, (F.col("place") % len(weights)).cast("int")).alias("weight")))
    level, above = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("size") * F.lit(float(most))
        row = weighed.agg(
            F.sum("size").alias("size"), F.sum(F.when(full, F.col("size"))).alias("full"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"), F.count_if(full).alias("above"),
        ).first()
        if row["above"] == above or not row["weight"]:
            break
        above = row["above"]
        level = (share * row["size"] - most * (row["full"] or 0)) / row["weight"]
    cap = F.col("size") * F.lit(float(most))
    target = F.when(full, cap).otherwise(F.col("weight") * F.lit(level)) if level is not None else F.lit(0.0)
    return weighed.select(source, F.col("size").alias(size), target.alias("target"))


def coin(id: Column, text: Column, seed: int) -> Column:
    """A number from 0 up to 1 that depends on the id, the text and the seed only."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    digits = F.substring(F.md5(key.cast("binary")), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**_DIGITS))


def repetitions(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5, most: float = 2.0, seed: int = 42, keep: Sequence[str] = (),
) -> DataFrame:
    """How often the mix takes each document: columns ``keep``, then ``size`` (words), ``source_size``, ``target``, ``copies``.

    ``keep`` names columns of ``docs``; they come first and may have any name, as
    they lie in a struct ``kept``. A null text has no words; a null source is a
    source of its own, the last in order. A null id is like an empty one. Rows
    that repeat id and text fall on the same side of the coin. Documents without
    words are taken as often as others of their source; in a source without any
    words they are not taken. An empty table gives no rows. The result does not
    depend on how rows are split over tasks.
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit(""))
    kept = F.struct(F.lit(0).alias("_"), *keep).alias("kept")
    sized = docs.select(
        kept, key.alias("source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        coin(F.col(id), F.col(text), seed).alias("coin"),
    )
    # a key without its leading letter is the source, an empty key a null source
    named = sized.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        F.when(F.col("source") != "", F.substring("source", 2, 1 << 30)).alias("source"), "source_size")
    targets = source_targets(named, "source", "source_size", weights, share, most)
    rates = targets.select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )
    more = (F.col("coin") < F.col("rate") - F.floor("rate")).cast("long")
    return hot_key_join(sized, rates, ["source"]).select(
        "kept", "size", "source_size", "target", (F.floor("rate") + more).alias("copies"))


def mix(docs: DataFrame, copy: str | None = None, **settings) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as ``repetitions`` says, in all its columns.

    ``copy`` names a further column that numbers the copies of a row from 1.
    """
    counted = repetitions(docs, keep=docs.columns, **settings)
    copies = counted.filter(F.col("copies") > 0).select("kept", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("n"))
    columns = [F.col("kept").getField(c).alias(c) for c in docs.columns]
    return copies.select(*columns, *([F.col("n").alias(copy)] if copy else []))
