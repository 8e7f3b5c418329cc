"""Ledger of processed date shards: which are new, which have grown since, and their days done again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import moment

LEDGER_SCHEMA = "shard DATE, row_count BIGINT, state STRING, done_at TIMESTAMP_NTZ"


@dataclass
class ShardRun:
    rows: DataFrame
    ledger: DataFrame


def shard_states(source: DataFrame, shard: str, ledger: DataFrame) -> DataFrame:
    """Each shard with its rows now and then: ``new``, ``late`` (other rows than when it was done), ``done`` or ``gone``.

    Only the shard column is read, and counts combine before they move.
    """
    now = source.groupBy(F.col(shard).alias("shard")).agg(F.count(F.lit(1)).alias("row_count"))
    known = ledger.select("shard", F.col("row_count").alias("done_count"))
    state = (
        F.when(F.col("done_count").isNull(), "new").when(F.col("row_count").isNull(), "gone")
        .when(F.col("row_count") != F.col("done_count"), "late").otherwise("done")
    )
    return now.join(known, "shard", "full_outer").withColumn("state", state)


def run_shards(
    source: DataFrame, shard: str, ledger: DataFrame, stored: DataFrame, build: Callable[[DataFrame], DataFrame], now,
    materialise: Callable[[DataFrame], DataFrame],
) -> ShardRun:
    """``stored`` rows with the days of new and late shards built again, and the ledger after it.

    ``build`` gets the rows of the due shards, whole, and returns rows with the
    column ``shard``; days of other shards stay as stored, also those of shards
    that are gone. The list of due shards has a row a day.
    """
    due = materialise(shard_states(source, shard, ledger).filter("state IN ('new', 'late')"))
    days = due.select(F.col("shard").alias(shard))
    built = build(source.join(days, shard, "left_semi"))
    kept = stored.join(days, shard, "left_anti")
    done = due.select("shard", "row_count", F.lit("done").alias("state"), moment(now).alias("done_at"))
    rest = ledger.join(due.select("shard"), "shard", "left_anti")
    return ShardRun(kept.unionByName(built), rest.unionByName(done))
