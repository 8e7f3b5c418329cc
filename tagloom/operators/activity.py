"""Rolling "last N active days" state per member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.codes import KEYS, TENANT_KEYS, WHO
from tagloom.functions.columns import days_before
from tagloom.operators.keyed import hot_key_join, salted_join

ACTIVE_DAYS = 15


def named_members(members: DataFrame) -> DataFrame:
    return members.filter(F.col("user_name").isNotNull()).select(*WHO)


def bet_days(bets: DataFrame, members: DataFrame) -> DataFrame:
    """Turnover rows of named members per game and day."""
    return (
        bets.filter(F.col("commissionable") > 0)
        .groupBy(*KEYS, "lobby_group", "lobby", "game_type", "data_date")
        .agg(*[F.sum(c).alias(c) for c in ("wagers_total", "bet_amount", "commissionable", "payoff")])
        .join(named_members(members), KEYS)
    )


def deposit_days(deposits: DataFrame, members: DataFrame) -> DataFrame:
    return (
        deposits.filter(F.col("deposit_amount") > 0)
        .select(*KEYS, "deposit_amount", "deposit_count", "data_date")
        .join(named_members(members), KEYS)
    )


def bet_state(bets: DataFrame, members: DataFrame, n: int = ACTIVE_DAYS) -> DataFrame:
    """First state of the turnover rows."""
    return active_sums(
        bets.filter(F.col("commissionable") > 0), ["lobby_group", "lobby", "game_type"],
        {c: c for c in ("wagers_total", "bet_amount", "commissionable", "payoff")}, n=n,
    ).join(named_members(members), KEYS)


def deposit_state(deposits: DataFrame, members: DataFrame, n: int = ACTIVE_DAYS) -> DataFrame:
    """Rows of the deposit record, one for each member and day."""
    paid = deposits.filter(F.col("deposit_amount") > 0).select(*KEYS, "deposit_amount", "deposit_count", "data_date")
    return newest_days(paid, n=n).join(named_members(members), KEYS)


def newest_days(sums: DataFrame, keys: list[str] = KEYS, n: int = ACTIVE_DAYS) -> DataFrame:
    """Rows dated on one of the member's n latest dates, for rows whose number per member and day is bounded by dimensions.

    Spark drops rows beyond the n latest dates of a task before the shuffle.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col("data_date").desc())
    kept = sums.withColumn("_place", F.dense_rank().over(newest)).filter(F.col("_place") <= n)
    return kept.withColumn("top_activate_date", F.min("data_date").over(Window.partitionBy(*keys))).drop("_place")


def active_sums(
    fact: DataFrame, dims: Sequence[str], sums: Mapping[str, str], keys: list[str] = KEYS, n: int = ACTIVE_DAYS
) -> DataFrame:
    """State of the n latest active days: sums per member, dimensions and day.

    Rows combine to that grain before they move, so a member with most of all rows
    is as small as any other when the days are compared. ``sums`` maps columns to names.
    """
    daily = fact.groupBy(*keys, *dims, "data_date").agg(*[F.sum(c).alias(name) for c, name in sums.items()])
    return newest_days(daily, keys, n)


def merge_active_sums(
    a: DataFrame, b: DataFrame, dims: Sequence[str], sums: Sequence[str], keys: list[str] = KEYS, n: int = ACTIVE_DAYS
) -> DataFrame:
    """State of the rows of two states together, in whatever order their days lie.

    A day among the n latest of both together is among the n latest of each that
    has it, so nothing a state has dropped is missing.
    """
    columns = [*keys, *dims, "data_date", *sums]
    return active_sums(a.select(*columns).unionByName(b.select(*columns)), dims, {c: c for c in sums}, keys, n)


def last_n_active_days(fact: DataFrame, keys: list[str] = KEYS, n: int = ACTIVE_DAYS) -> DataFrame:
    """Rows dated on one of the member's n latest active dates.

    The cut-off comes from the distinct dates, which combine before the shuffle
    to one row per member and day, whatever part of all rows a member holds.
    Rows then join their member's cut-off, split by hot members.
    """
    dates = fact.select(*keys, "data_date").distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("data_date").desc()))
    newest = dates.withColumn("_place", place).filter(F.col("_place") <= n)
    cutoff = newest.groupBy(*keys).agg(F.min("data_date").alias("top_activate_date"))
    return hot_key_join(fact, cutoff, keys).filter(F.col("data_date") >= F.col("top_activate_date"))


def advance_active_days(state: DataFrame, new_fact: DataFrame, keys: list[str] = KEYS, n: int = ACTIVE_DAYS) -> DataFrame:
    """State after the rows newer than the latest date of their tenant.

    Rows dated on or before that date are not taken up again; a tenant without
    state takes up all of its rows. Both are sums per member, dimensions and day.
    """
    latest = state.groupBy(*TENANT_KEYS).agg(F.max("data_date").alias("_latest"))
    dated = salted_join(new_fact, latest, TENANT_KEYS, "left")
    fresh = dated.filter(F.col("_latest").isNull() | (F.col("data_date") > F.col("_latest"))).drop("_latest")
    return newest_days(state.drop("top_activate_date").unionByName(fresh), keys, n)


def min_active_days(fact: DataFrame, k: int = 3) -> DataFrame:
    """Rows of users with at least k distinct active days (matched by user_id alone).

    ``fact`` is a state of few days per member, so the join needs no salting
    and later groupings by member keep its partitioning.
    """
    busy = (
        fact.select(*KEYS, "data_date").distinct()
        .groupBy(*KEYS).agg(F.count(F.lit(1)).alias("days")).filter(F.col("days") >= k)
    )
    return fact.join(busy.select("user_id").distinct(), "user_id", "left_semi")


def deposit_page_visits(ga_page: DataFrame, members: DataFrame, as_of: date, days: int = 14) -> DataFrame:
    """Distinct deposit pages per named member and day, recent days only."""
    return (
        ga_page.filter(F.col("page_path").contains("deposit") & (F.col("data_date") >= days_before(as_of, days)))
        .select(*KEYS, "page_path", "data_date")
        .distinct()
        .join(named_members(members), KEYS)
    )
