"""Per-key building blocks.

Raw facts may put a third of all rows on one key, so nothing here sorts or
gathers raw rows of a key in one task: extremes are aggregates with map-side
combine, top-k filters are rank limits that Spark applies before the shuffle,
and row-level joins split the hot keys over salts. Inputs of any size take the
same path; a key is split by its own number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000  # of one key; ``tagloom.rowsPerTask`` sets another
MOST_HOT = 10_000
MOST_BROADCAST = 100_000  # rows of a dimension; larger ones are sorted whatever the planner's estimate of their size


def salted_join(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner", condition=None, salts: int | None = None
) -> DataFrame:
    """Join to a dimension whose rows are bounded by the calendar, the tenants or a fixed code table (day, week, code).

    Dimensions that grow with the input go through ``dimension_join``: here the
    dimension is repeated per salt, and the planner, which does not see the
    repeats, may broadcast it. The fact rows of one value spread over
    the salts, one for each shuffle partition unless given; as the output is
    partitioned by the salt, nothing later relies on it and adaptive execution is
    free to split partitions further. Small dimensions are broadcast by Spark's
    own size check.

    ``condition(dim_column)`` adds a non-equality test; it gets a function
    returning the dim side of a column and may use fact columns by plain name.
    """
    salts = salts or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = fact.withColumn("_salt", _salt(fact, F.lit(salts)))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return _join(left, right, [*keys, "_salt"], how, condition).drop("_salt")


def _salt(fact: DataFrame, salts: Column) -> Column:
    """Salt from the row and the partition it is read in.

    Copies of one row spread as well, and a re-run of a lost task, which has the
    same partition and rows in whatever order, places them as before.
    """
    return F.pmod(F.xxhash64(*fact.columns, F.spark_partition_id()), salts).cast("int")


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, condition) -> DataFrame:
    if condition is None:
        return left.join(right, list(keys), how)
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = condition(lambda c: F.col(f"_r_{c}") if c in keys else F.col(c))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def hot_keys(fact: DataFrame, keys: Sequence[str], rows_per_task: int | None = None) -> DataFrame | None:
    """Keys with more rows than one task should take, with the number of salts each needs.

    None when there are none. Counting reads only the key columns and combines
    before the shuffle. The list that the driver takes and later broadcasts has
    at most ``MOST_HOT`` keys, the hottest; others are left to adaptive
    execution. The list decides how rows are spread, never which rows there are.
    """
    most = rows_per_task or int(fact.sparkSession.conf.get("tagloom.rowsPerTask", str(ROWS_PER_TASK)))
    counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    hot = [(*row[:-1], -(-row["_n"] // most)) for row in counts.orderBy(F.desc("_n")).limit(MOST_HOT).collect()]
    if not hot:
        return None
    schema = fact.select(*keys).withColumn("_salts", F.lit(0).cast("long")).schema
    return fact.sparkSession.createDataFrame(hot, schema)


def _with_salts(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    renamed = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_salts")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_h_{k}"))
    return df.join(F.broadcast(renamed), on, "left").drop(*[f"_h_{k}" for k in keys])


def spread_hot(fact: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Add ``_salt``: rows of hot keys are spread, others get 0."""
    return _with_salts(fact, keys, hot).withColumn("_salt", _salt(fact, F.coalesce("_salts", F.lit(1)))).drop("_salts")


def repeat_hot(dim: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Repeat the rows of hot keys once per salt."""
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)).cast("int") - 1)
    return _with_salts(dim, keys, hot).withColumn("_salt", F.explode(salts)).drop("_salts")


def hot_key_join(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner", condition=None, counted: DataFrame | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Join row-level ``fact`` to a large ``dim`` with few rows per key.

    Only keys found hot are salted, so the large side is not repeated as a
    whole; without hot keys it is a plain join. ``counted`` has the rows whose keys
    are counted, if those of ``fact`` are dear to compute: more rows of a key than
    ``fact`` has only mean more salts. ``condition`` is that of ``salted_join``.
    """
    hot = hot_keys(fact if counted is None else counted, keys)
    on, left, right = list(keys), fact, dim
    if hot is not None:
        on, left, right = [*keys, "_salt"], spread_hot(fact, keys, hot), repeat_hot(dim, keys, hot)
    return _join(left, right.hint(hint) if hint else right, on, how, condition).drop("_salt")


def dimension_join(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner", condition=None, counted: DataFrame | None = None
) -> DataFrame:
    """Join to a dimension that may grow with the input (games, vendors, promotions, tag names).

    It is repeated for hot keys only. The planner compares the compressed size of
    its files with the limit of broadcasts, so a dimension of more than
    ``MOST_BROADCAST`` rows is never sent through the driver.
    """
    large = dim.limit(MOST_BROADCAST + 1).count() > MOST_BROADCAST
    return hot_key_join(fact, dim, keys, how, condition, counted, "merge" if large else None)


def best_by_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Sequence[str], smallest: bool = False
) -> DataFrame:
    """One row per key: the one with the largest (or smallest) ``order`` tuple; NULL is smallest."""
    ranks = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    pick = F.min if smallest else F.max
    best = pick(F.struct(*ranks, *[F.col(c) for c in keep])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in keep])


def last_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The k first rows per key in ``order``.

    ``rank <= k`` directly over the window lets Spark drop rows beyond local
    rank k before the shuffle.
    """
    return _ranked(df, keys, order, F.row_number(), k)


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: Column, k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", rank.over(w)).filter(F.col("_rank") <= k).drop("_rank")


def latest_with_ties(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """All rows carrying their key's largest ``column``.

    Rows beyond the first place are dropped before the shuffle. Keys with more
    rows than a task should take (a third of all rows may be copies of the latest
    row) are ranked per salt and then compared with their exact maximum, which is
    repeated for those keys only. Rows with a null key are kept as the window
    keeps them, by a null-safe comparison.
    """
    newest = [F.col(column).desc()]
    hot = hot_keys(df, keys)
    if hot is None:
        return _ranked(df, keys, newest, F.rank(), 1)
    limited = _ranked(spread_hot(df, keys, hot), [*keys, "_salt"], newest, F.rank(), 1)
    largest = repeat_hot(df.groupBy(*keys).agg(F.max(column).alias(column)), keys, hot)
    names = [*keys, column, "_salt"]
    largest = largest.select(*[F.col(c).alias(f"_r_{c}") for c in names])
    on = F.lit(True)
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return limited.join(largest, on, "left_semi").drop("_salt")


def in_ranges(
    points: DataFrame, point: str, ranges: DataFrame, low: str, high: str, materialise: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Distinct points with the other columns of the range ``low`` to ``high`` that holds them; points in none are left out.

    Ranges do not overlap. Range starts and points are sorted together into
    partitions; within one, the last start before a point is its only candidate,
    and where a partition begins inside a range, that range is carried in from the
    partitions before (one row each). A range is one row however long it is.
    """
    values = [c for c in ranges.columns if c not in (low, high)]
    starts = ranges.select(
        F.col(low).cast("long").alias("at"), F.lit(0).alias("kind"), F.struct(F.col(high).cast("long").alias("high"), *values).alias("range"))
    wanted = points.select(F.col(point).cast("long").alias("at")).filter(F.col("at").isNotNull()).distinct()
    both = starts.unionByName(wanted.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    cut = materialise(both.repartitionByRange("at").withColumn("part", F.spark_partition_id()))
    so_far = Window.partitionBy("part").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_start = cut.filter("kind = 0").groupBy("part").agg(F.max_by("range", "at").alias("ends_with"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut.select("part").distinct().join(last_start, "part", "left").select(
        "part", F.last("ends_with", ignorenulls=True).over(before).alias("carried"))
    found = cut.withColumn("own", F.last("range", ignorenulls=True).over(so_far)).filter("kind = 1").join(carried, "part").select(
        "at", F.coalesce("own", "carried").alias("range"))
    return found.filter(F.col("at") <= F.col("range.high")).select(
        F.col("at").alias(point), *[F.col(f"range.{v}").alias(v) for v in values])


def run_length_dedup(df: DataFrame, keys: Sequence[str], order: str, column: str) -> DataFrame:
    """Keep the last row of every run of equal ``column`` values."""
    w = Window.partitionBy(*keys).orderBy(order)
    following = F.lead(F.struct(column)).over(w)
    return (
        df.withColumn("_next", following)
        .filter(F.col("_next").isNull() | ~F.col(f"_next.{column}").eqNullSafe(F.col(column)))
        .drop("_next")
    )


def set_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).distinct().join(b.select(*keys).distinct(), list(keys), "left_anti")


def set_intersection(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).distinct().join(b.select(*keys), list(keys), "left_semi")


def hash_places(df: DataFrame, keys: Sequence[str], on: str, seed: int = 0) -> tuple[DataFrame, Column]:
    """Distinct keys with their 1-based ``place`` in the order of a seeded hash of ``on``, and their number.

    The hash order is cut into 65,536 ranges by its leading digits. Their counts
    (a table of fixed size) give each range its start, so places are counted
    within ranges and no task sees the whole list.
    """
    hashed = df.select(*keys).distinct().withColumn(
        "_h", F.md5(F.concat_ws(":", F.col(on).cast("string"), F.lit(str(seed))))
    ).withColumn("_range", F.substring("_h", 1, 4))
    counts = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    so_far = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select("_range", (F.sum("_n").over(so_far) - F.col("_n")).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy("_h", *keys))
    placed = hashed.withColumn("_within", within).join(F.broadcast(starts), "_range")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    return placed.select(*keys, (F.col("_start") + F.col("_within")).alias("place")), total


def hash_places_by(df: DataFrame, by: Sequence[str], keys: Sequence[str], on: str, seed: int = 0) -> DataFrame:
    """As ``hash_places``, for each group of ``by`` on its own: distinct rows with ``place`` and ``total``.

    A group is cut into ranges of its hashes, so that one holding most rows spreads as well.
    """
    names = list(dict.fromkeys([*by, *keys]))
    hashed = df.select(*names).distinct().withColumn(
        "_h", F.md5(F.concat_ws(":", F.col(on).cast("string"), F.lit(str(seed))))
    ).withColumn("_range", F.substring("_h", 1, 4))
    counts = hashed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)
    so_far = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select(
        *by, "_range", (F.sum("_n").over(so_far) - F.col("_n")).alias("_start"), F.sum("_n").over(group).alias("total"))
    within = F.row_number().over(Window.partitionBy(*by, "_range").orderBy("_h", *keys))
    return hashed.withColumn("_within", within).join(starts, [*by, "_range"]).select(
        *names, (F.col("_start") + F.col("_within")).alias("place"), "total")


def equal_parts(df: DataFrame, keys: Sequence[str], on: str, parts: int, seed: int = 0) -> DataFrame:
    """Distinct keys split into ``parts`` whose sizes differ by one at most."""
    placed, total = hash_places(df, keys, on, seed)
    return placed.select(*keys, F.floor((F.col("place") * parts - 1) / total).cast("int").alias("part"))
