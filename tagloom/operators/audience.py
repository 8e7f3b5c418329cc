"""Audience matching, campaign groups and their stored state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import codes as C
from tagloom.functions.codes import KEYS, TENANT_KEYS
from tagloom.functions.columns import all_of, any_of, day, days_before, moment, of_tenant, tenant_date
from tagloom.operators.keyed import hash_places, last_k_per_group, set_difference, set_intersection
from tagloom.operators.merge import delete_keys, update_where, upsert

GROUP_KEY = ["hall_id", "domain_id", "batch_id", "tag_id", "user_id"]
CAMPAIGN_MEMBER_KEY = ["activity_id", "hall_id", "domain_id", "user_name"]


def active_batches(batches: DataFrame, now, edited_within: int | None = None) -> DataFrame:
    """Enabled batches that are permanent (type 2) or in their date range (type 1).

    ``edited_within`` seconds keeps only recently edited ones.
    """
    stamp = moment(now)
    today = tenant_date(stamp)
    open_now = (F.col("sync_date_type") == 2) | (
        (F.col("sync_date_type") == 1) & today.between(F.col("sync_date_begin"), F.col("sync_date_end")))
    found = batches.filter(F.col("tag_enabled") & open_now)
    if edited_within is not None:
        found = found.filter(F.timestamp_diff("SECOND", F.col("operator_time"), stamp) <= edited_within)
    return found


def batch_condition(batch: Mapping) -> Column:
    """Filter over the wide tag table described by a batch row.

    Levels: ``;`` any of, exclusions ``,`` none of. Tags: ``;`` any group, all
    codes of a ``,`` group; exclusions: none of all codes. A batch that names its
    tenant matches only that tenant's members.
    """
    parts = [F.col(k) == batch[k] for k in TENANT_KEYS if batch.get(k) is not None]
    if batch.get("ag_name") is not None:
        parts.append(F.col("ag_name") == batch["ag_name"])
    if batch.get("user_level_id"):
        parts.append(any_of(F.col("user_level_id") == int(x) for x in batch["user_level_id"].split(";")))
    if batch.get("user_level_exclude"):
        parts.append(all_of(F.col("user_level_id") != int(x) for x in batch["user_level_exclude"].split(",")))
    if batch.get("activated_date_begin") is not None:
        parts.append(F.col("last_activated_date").between(
            day(batch["activated_date_begin"]), day(batch["activated_date_end"])))
    if batch.get("tag_str"):
        parts.append(any_of(
            all_of(F.col("tag_str").contains(x) for x in group.split(",")) for group in batch["tag_str"].split(";")))
    if batch.get("tag_str_exclude"):
        parts.append(all_of(
            ~F.col("tag_str").contains(x) for x in batch["tag_str_exclude"].replace(";", ",").split(",")))
    return all_of(parts)


def match_users(dw: DataFrame, batch: Mapping) -> DataFrame:
    return dw.filter(batch_condition(batch)).select(*KEYS)


def match_uploaded_names(names: DataFrame, members: DataFrame, tenant: Mapping) -> DataFrame:
    """Members of the tenant that uploaded the names; other tenants may use the same ones."""
    wanted = names.select(F.col(names.columns[0]).alias("user_name")).distinct()
    return members.filter(of_tenant(tenant)).join(wanted, "user_name", "left_semi").select(*KEYS)


def match_by_step(users: DataFrame, dw_day: DataFrame, step: int, on: date) -> DataFrame:
    in_step = dw_day.filter((F.col("this_day_step") == step) & (F.col("data_date") == day(on)))
    return set_intersection(users, in_step, KEYS)


def match_by_activity(users: DataFrame, activity: DataFrame, levels: Sequence[int], today: date) -> DataFrame:
    """Average score of the week up to two days ago within any of the levels' closed bands."""
    scores = (
        activity.filter(F.col("data_date").between(days_before(today, 8), days_before(today, 2)))
        .groupBy(*KEYS).agg(F.avg("action_score").alias("score"))
        .filter(any_of(F.col("score").between(*C.ACTIVITY_BANDS[level]) for level in levels))
    )
    return set_intersection(users, scores, KEYS)


def match_by_prediction(users: DataFrame, meta: DataFrame, low: int, high: int, start: date, end: date) -> DataFrame:
    likely = (
        meta.filter((F.col("recommend_code") == C.DEPOSIT_PREDICTION_CODE) & F.col("data_date").between(day(start), day(end)))
        .groupBy(*KEYS).agg((F.avg("action_score") * 100).alias("score"))
        .filter(F.col("score").between(low, high))
    )
    return set_intersection(users, likely, KEYS)


def match_top_spenders(users: DataFrame, bets: DataFrame, n: int, start: date, end: date) -> DataFrame:
    """Those among their tenant's n largest bettors of the range (tie: smaller user id)."""
    sums = (
        bets.filter(F.col("data_date").between(day(start), day(end)))
        .groupBy(*KEYS).agg(F.sum("bet_amount").alias("bet"))
    )
    return set_intersection(users, last_k_per_group(sums, TENANT_KEYS, [F.desc("bet"), F.col("user_id")], n), KEYS)


def audience_diff(matched: DataFrame, tagged: DataFrame) -> DataFrame:
    """Members to keep, to delete and to add, by ``change``."""
    label = lambda df, name: df.withColumn("change", F.lit(name))
    return (
        label(set_intersection(matched, tagged, KEYS), "repeat")
        .unionByName(label(set_difference(tagged, matched, KEYS), "delete"))
        .unionByName(label(set_difference(matched, tagged, KEYS), "new"))
    )


def ab_split(users: DataFrame, existing: DataFrame, test_percent: int = 20, seed: int = 0) -> DataFrame:
    """Split new members into groups 1 and 2.

    With five or more members, or no earlier groups, exactly ceil(20 %) become
    group 2, in the order of a seeded hash of the member id. Otherwise all go to
    group 2 when it lags 60 points behind group 1, else to group 1.
    """
    placed, total = hash_places(users, KEYS, "user_id", seed)
    in_test = F.col("place") <= F.ceil(total * test_percent / 100)

    share = lambda g: F.sum(F.when(F.col("group_id") == g, F.col("group_count")).otherwise(0))
    lead = existing.agg(((share(1) - share(2)) * 100 / F.sum("group_count")).alias("lead")).scalar()
    group = F.when((total >= 5) | lead.isNull(), F.when(in_test, 2).otherwise(1)).otherwise(
        F.when(lead >= 60, 2).otherwise(1))
    return placed.select(*KEYS, group.alias("group_id"))


def sync_group_state(group: DataFrame, new: DataFrame, matched: DataFrame, batch: Mapping, mode: int) -> DataFrame:
    """Stored campaign group after one sync: stale members out (mode 2), older rows no longer latest, new ones in.

    A batch that names its tenant touches that tenant's rows only.
    """
    same_batch = all_of(F.col(k) == batch[k] for k in ["batch_id", *TENANT_KEYS] if batch.get(k) is not None)
    if mode == 2:
        stale = set_difference(group.filter(same_batch), matched, KEYS).select(
            *KEYS, F.lit(batch["batch_id"]).alias("batch_id"), F.lit(batch["tag_id"]).alias("tag_id"))
        group = delete_keys(group, stale, GROUP_KEY)
    aged = update_where(
        group, same_batch & (F.col("tag_id") == batch["tag_id"]) & F.col("latest_tag"), {"latest_tag": F.lit(False)})
    added = new.select(
        *KEYS, F.lit(batch["batch_id"]).alias("batch_id"), F.lit(batch["tag_id"]).alias("tag_id"),
        F.lit(batch["tag_name"]).alias("tag_name"), "group_id", F.lit(True).alias("latest_tag"))
    return upsert(aged, added, GROUP_KEY)


def campaign_header(campaigns: DataFrame, campaign: Mapping) -> DataFrame:
    """Insert the campaign under the next free id, or update the one it names."""
    spark = campaigns.sparkSession
    fields = {k: v for k, v in campaign.items() if k != "activity_id"}
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in fields.items()])
    given = campaign.get("activity_id")
    number = F.lit(given) if given is not None else campaigns.agg(F.coalesce(F.max("activity_id"), F.lit(0)) + 1).scalar()
    row = row.withColumn("activity_id", number.cast(campaigns.schema["activity_id"].dataType))
    return upsert(campaigns, row, ["hall_id", "domain_id", "activity_id"])


def campaign_members(
    stored: DataFrame, activity_id: int, matched: DataFrame, removed: DataFrame, members: DataFrame
) -> DataFrame:
    """Campaign member names after removing and adding members."""
    def named(users: DataFrame) -> DataFrame:
        return members.join(users.select(*KEYS).distinct(), KEYS, "left_semi").select(
            F.lit(activity_id).cast(stored.schema["activity_id"].dataType).alias("activity_id"),
            "hall_id", "domain_id", "user_name")

    return upsert(delete_keys(stored, named(removed), CAMPAIGN_MEMBER_KEY), named(matched), CAMPAIGN_MEMBER_KEY)


def batch_match_counts(dw: DataFrame, batches: Sequence[Mapping]) -> DataFrame:
    """Members matched by each batch, all batches counted in one pass over the table."""
    counts = dw.agg(*[F.count_if(batch_condition(b)).alias(f"b{i}") for i, b in enumerate(batches)])
    pairs = F.array(*[
        F.struct(F.lit(b["batch_id"]).alias("batch_id"), F.col(f"b{i}").alias("match_user_count"))
        for i, b in enumerate(batches)])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def tagged_user_counts(memberships: DataFrame) -> DataFrame:
    return memberships.groupBy("hall_id", "domain_id", "tag_id").agg(F.count(F.lit(1)).alias("user_count"))


PLAYER_SCHEMA = """
    id BIGINT, parent_id BIGINT, username STRING, upper STRUCT<id: BIGINT, username: STRING>, enable BOOLEAN,
    bankrupt BOOLEAN, locked BOOLEAN, tied BOOLEAN, blacklist_modified_at STRING, last_login STRING, last_ip STRING,
    last_country STRING, last_city_id BIGINT, last_online STRING, created_at STRING, created_ip STRING,
    created_country STRING, created_city STRING, created_by BIGINT, user_id BIGINT, alias STRING, birthday STRING,
    gender INT, image BIGINT, custom_image STRING, custom BOOLEAN, content_rating INT, promotion_code STRING,
    vip_level_id BIGINT, ingroup_transfer STRUCT<domain: STRING, user: STRING>, parent STRUCT<username: STRING>,
    blacklist ARRAY<STRING>, cash STRUCT<balance: DOUBLE, currency: STRING>, level STRUCT<name: STRING>
"""


def parse_player_list(responses: DataFrame, column: str = "json") -> DataFrame:
    """Flatten player profiles: defaults for missing fields, clocks back 12 hours, no astral-plane characters."""
    p = lambda name: F.col(f"p.{name}")
    number = lambda name: F.coalesce(p(name), F.lit(0)).alias(name)
    text = lambda name, out=None: F.coalesce(p(name), F.lit("")).alias(out or name)

    def shifted(name):
        wall = F.replace(F.substring(p(name), 1, 19), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")
        return (wall - F.expr("INTERVAL 12 HOURS")).cast("string").alias(name)

    parsed = responses.select(F.from_json(column, PLAYER_SCHEMA).alias("p"))
    return parsed.select(
        number("id"), number("parent_id"), text("username"), F.coalesce(p("upper.id"), F.lit(0)).alias("upper_id"),
        *[p(c).alias(c) for c in ("enable", "bankrupt", "locked", "tied")],
        *[shifted(c) for c in ("blacklist_modified_at", "last_login", "last_online", "created_at")],
        text("last_ip"), text("last_country"), number("last_city_id"), text("created_ip"), text("created_country"),
        text("created_city"), number("created_by"), number("user_id"),
        F.regexp_replace(F.coalesce(p("alias"), F.lit("")), r"[\x{10000}-\x{10FFFF}]+", "").alias("alias"),
        text("birthday"), number("gender"), number("image"), text("custom_image"), p("custom").alias("custom"),
        number("content_rating"), text("promotion_code"), number("vip_level_id"),
        p("ingroup_transfer.domain").alias("ingroup_transfer_domain"),
        p("ingroup_transfer.user").alias("ingroup_transfer_user"),
        text("parent.username", "parent_username"), p("upper.username").alias("upper_username"),
        F.coalesce(F.array_join(p("blacklist"), ","), F.lit("")).alias("blacklist"),
        F.coalesce(p("cash.balance"), F.lit(0.0)).alias("balance"), text("cash.currency", "currency"),
        text("level.name", "level_name"))
