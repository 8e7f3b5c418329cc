"""Writing tables. A path being read is never written: new versions go to new paths."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def truncate_load(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_days(df: DataFrame, path: str, column: str = "data_date") -> None:
    """Overwrite only the days present in ``df``.

    Rebalancing writes few files per day and still splits a day holding most of
    the data.
    """
    balanced = df.hint("rebalance", F.col(column))
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def merge_partitions(
    source: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str],
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame],
) -> int:
    """Merge into a table laid out by ``partitions`` (part of the keys): only those that ``source`` has are read and written.

    The partitions' names are all the driver takes. Returns how many were written;
    a partition that the merge leaves empty keeps its rows, so ``merge`` must not delete.
    """
    spark = source.sparkSession
    values = source.select(*partitions).distinct().collect()
    if not values:
        return 0
    touched = reduce(or_, [reduce(and_, [F.col(c).eqNullSafe(v[c]) for c in partitions]) for v in values])
    target = spark.read.parquet(path)
    merged = materialise(merge(target.filter(touched), source, keys).select(*target.columns))
    balanced = merged.hint("rebalance", *[F.col(c) for c in partitions])
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    return len(values)


def write_jdbc(df: DataFrame, url: str, table: str, truncate: bool = False, parts: int = 8, **options: str) -> None:
    """Append to a database table, or with ``truncate`` empty and fill it, keeping its definition.

    Each of at most ``parts`` connections commits its own rows; for all or nothing,
    write to a staging table and let the database rename or insert from it.
    """
    writer = df.coalesce(parts).write.format("jdbc").options(url=url, dbtable=table, truncate=str(truncate).lower(), **options)
    writer.mode("overwrite" if truncate else "append").save()


def append_checked(df: DataFrame, path: str) -> int:
    """Append and compare the growth of the table with the rows given."""
    spark = df.sparkSession
    before, given = _rows(spark, path), df.count()
    append(df, path)
    grown = _rows(spark, path) - before
    if grown != given:
        raise RuntimeError(f"{given} rows were given to {path} but it grew by {grown}")
    return grown


def _rows(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:  # no table there yet
        return 0


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder all executors share; only a local session gets one of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder; it is deleted by ``drop_scratch``, or when the driver's session ends."""
    path = f"{checkpoint_folder(spark)}/{uuid.uuid4()}"
    _SCRATCH.append(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables made so far, once the results that read them are written or collected; returns their number."""
    paths, _SCRATCH[:] = list(_SCRATCH), []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage by writing a table in the shared checkpoint folder.

    Compared with a checkpoint the rows are computed once, later readers take
    only the columns they need, and sizes are known to the planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
