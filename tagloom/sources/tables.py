"""Reading stored tables, shards, uploads and databases."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.columns import day

UPLOAD_SCHEMA = "user_name STRING, data_date STRING, enable INT"


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_matching(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Tables of one family (for example one per vendor) as one; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(p) for p in paths])


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """Uploaded tag file: a header line, then name, date, enable by position."""
    return spark.read.schema(UPLOAD_SCHEMA).csv(path, header=True, enforceSchema=True)


def read_jdbc(
    spark: SparkSession, url: str, table: str, split_on: str, low: int, high: int, parts: int, **options: str
) -> DataFrame:
    """Database table in parallel ranges of a numeric column."""
    return (
        spark.read.format("jdbc").options(url=url, dbtable=table, **options)
        .options(partitionColumn=split_on, lowerBound=low, upperBound=high, numPartitions=parts).load()
    )


def latest_shard(df: DataFrame, shard: str, on: date) -> DataFrame:
    """The latest date shard on or before a day, however far back it lies.

    The shard is a scalar subquery over the partition column, so only one
    partition is read.
    """
    latest = df.filter(F.col(shard) <= day(on)).agg(F.max(shard)).scalar()
    return df.filter(F.col(shard) == latest)
