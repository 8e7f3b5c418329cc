"""Incremental runs: stored state plus the rows that arrived since."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.functions.codes import KEYS
from tagloom.operators.activity import ACTIVE_DAYS, advance_active_days, last_n_active_days
from tagloom.sources.sinks import truncate_load


def next_state(state: DataFrame | None, fact: DataFrame, keys: list[str] = KEYS, n: int = ACTIVE_DAYS) -> DataFrame:
    """First state from the whole fact, later ones from the state and newer rows."""
    return last_n_active_days(fact, keys, n) if state is None else advance_active_days(state, fact, keys, n)


def store_next_state(
    spark: SparkSession, current: str | None, following: str, fact: DataFrame, keys: list[str] = KEYS, n: int = ACTIVE_DAYS
) -> None:
    """Write the state after ``fact`` to the path ``following``; ``current`` stays as it is for a re-run."""
    state = spark.read.parquet(current) if current else None
    truncate_load(next_state(state, fact, keys, n), following)
