"""Syncing all open audience batches in one plan.

A batch is a row of conditions. Conditions become keys (a tag, a level, an agent,
everyone) that meet the members' own keys in one join; what else a batch asks is
a test on the joined row. Everything after that is keyed by tenant, batch and
member, so the plan is the same for any number of batches. All batches see the
tables as they were before the run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import codes as C
from tagloom.functions.codes import KEYS, TENANT_KEYS
from tagloom.functions.columns import any_of, day, days_before, holds, moment
from tagloom.operators.audience import CAMPAIGN_MEMBER_KEY, GROUP_KEY, active_batches
from tagloom.operators.keyed import hash_places_by
from tagloom.operators.merge import delete_keys, update, upsert

BATCH = [*TENANT_KEYS, "batch_id"]
MEMBER = [*BATCH, "user_id"]
TAG = [*TENANT_KEYS, "tag_id"]
OPTIONAL = {
    "ag_name": "string", "user_level_id": "string", "user_level_exclude": "string", "activated_date_begin": "date",
    "activated_date_end": "date", "tag_str": "string", "tag_str_exclude": "string", "file_name": "string", "user_step": "int",
    "user_activity": "string", "deposit_predict_rate": "string", "bet_amount_rank": "int", "ab_test": "boolean",
    "activity": "boolean", "activity_id": "int",
}
EVERYONE = "*"


@dataclass
class SyncTables:
    """Wide tag table, members, uploaded names by file, steps, activity, predictions, bets, and what the sync changes."""

    dw: DataFrame
    members: DataFrame
    uploads: DataFrame
    steps: DataFrame
    activity: DataFrame
    predictions: DataFrame
    bets: DataFrame
    groups: DataFrame
    tagged: DataFrame
    campaigns: DataFrame
    campaign_members: DataFrame


@dataclass
class Synced:
    batches: DataFrame
    groups: DataFrame
    tagged: DataFrame
    campaigns: DataFrame
    campaign_members: DataFrame


def with_options(batches: DataFrame) -> DataFrame:
    """Batches with every condition column; those they lack are NULL, which asks nothing."""
    return batches.withColumns({c: F.lit(None).cast(t) for c, t in OPTIONAL.items() if c not in batches.columns})


def _words(column: str, pattern: str) -> Column:
    return F.when(F.col(column) != "", F.split(column, pattern))


def batch_keys(batches: DataFrame) -> DataFrame:
    """One row for each batch and key under which its members are looked up, with the parsed conditions."""
    groups = F.transform(_words("tag_str", ";"), lambda g: F.split(g, ","))
    parsed = batches.select(
        *BATCH, F.col("ag_name").alias("b_agent"), _words("user_level_id", ";").cast("array<int>").alias("levels"),
        _words("user_level_exclude", ",").cast("array<int>").alias("not_levels"), F.col("activated_date_begin").alias("first_day"),
        F.col("activated_date_end").alias("last_day"), groups.alias("tag_groups"), _words("tag_str_exclude", "[;,]").alias("not_tags"))
    keys = (
        F.when(F.col("tag_groups").isNotNull(), F.transform("tag_groups", lambda g: F.concat(F.lit("tag "), g[0])))
        .when(F.col("levels").isNotNull(), F.transform("levels", lambda x: F.concat(F.lit("level "), x.cast("string"))))
        .when(F.col("b_agent").isNotNull(), F.array(F.concat(F.lit("agent "), "b_agent")))
        .otherwise(F.array(F.lit(EVERYONE)))
    )
    return parsed.withColumn("key", F.explode(F.array_distinct(keys)))


def member_keys(dw: DataFrame) -> DataFrame:
    """One row for each member and key: each tag, the level, the agent, and one for everyone."""
    tags = F.split("tag_str", ",")
    own = F.array(
        F.concat(F.lit("level "), F.col("user_level_id").cast("string")), F.concat(F.lit("agent "), "ag_name"), F.lit(EVERYONE))
    of_tags = F.coalesce(F.transform(tags, lambda t: F.concat(F.lit("tag "), t)), F.array().cast("array<string>"))
    return dw.select(
        *KEYS, "ag_name", "user_level_id", "last_activated_date", tags.alias("tags"), F.explode(F.array_compact(F.concat(of_tags, own))).alias("key"))


def _fits() -> Column:
    """Conditions of a batch on a member; a comparison with NULL does not hold."""
    asked = lambda name, condition: F.col(name).isNull() | holds(condition)
    return (
        asked("b_agent", F.col("ag_name") == F.col("b_agent"))
        & asked("levels", F.array_contains("levels", F.col("user_level_id")))
        & asked("not_levels", ~F.array_contains("not_levels", F.col("user_level_id")))
        & asked("first_day", F.col("last_activated_date").between(F.col("first_day"), F.col("last_day")))
        & asked("tag_groups", F.exists("tag_groups", lambda g: F.size(F.array_except(g, F.col("tags"))) == 0))
        & asked("not_tags", ~F.arrays_overlap("not_tags", F.col("tags")))
    )


def _narrowed(matched: DataFrame, batches: DataFrame, t: SyncTables, today: date, materialise) -> DataFrame:
    """Members that also meet their batch's step, activity, prediction and betting rank.

    A table is read only if some batch asks for it; the driver learns this and the
    largest rank, one row.
    """
    asks = ["user_step", "user_activity", "deposit_predict_rate", "bet_amount_rank"]
    used = batches.agg(*[F.count(c).alias(c) for c in asks], F.max("bet_amount_rank").alias("most")).first()
    if not any(used[c] for c in asks):
        return matched
    options = batches.select(*BATCH, *asks, F.col("activated_date_begin").alias("first_day"), F.col("activated_date_end").alias("last_day"))
    found = matched.join(options, BATCH)
    if used["user_step"]:
        steps = t.steps.filter(F.col("data_date") == days_before(today, 2)).select(*KEYS, F.col("this_day_step").cast("int").alias("user_step"))
        found = found.join(steps.distinct().withColumn("in_step", F.lit(True)), [*KEYS, "user_step"], "left").filter(
            F.col("user_step").isNull() | F.col("in_step")).drop("in_step")
    if used["user_activity"]:
        scores = t.activity.filter(F.col("data_date").between(days_before(today, 8), days_before(today, 2))).groupBy(*KEYS).agg(
            F.avg("action_score").alias("score"))
        in_band = any_of(
            F.array_contains(F.split("user_activity", ","), str(n)) & F.col("score").between(*band)
            for n, band in enumerate(C.ACTIVITY_BANDS))
        found = found.join(scores, KEYS, "left").filter(F.col("user_activity").isNull() | holds(in_band)).drop("score")
    in_range = F.col("data_date").between(F.col("first_day"), F.col("last_day"))
    if used["deposit_predict_rate"]:
        found = materialise(found)
        daily = t.predictions.filter(F.col("recommend_code") == C.DEPOSIT_PREDICTION_CODE).groupBy(*KEYS, "data_date").agg(
            F.sum("action_score").alias("s"), F.count("action_score").alias("n"))
        limit = lambda i: F.get(F.split("deposit_predict_rate", ";"), F.lit(i)).cast("int")
        likely = found.filter(F.col("deposit_predict_rate").isNotNull()).join(daily, KEYS).filter(in_range).groupBy(
            *MEMBER, "deposit_predict_rate").agg((F.sum("s") / F.sum("n") * 100).alias("rate"))
        likely = likely.filter(F.col("rate").between(limit(0), limit(1))).select(*MEMBER, F.lit(True).alias("likely"))
        found = found.join(likely, MEMBER, "left").filter(F.col("deposit_predict_rate").isNull() | F.col("likely")).drop("likely")
    if used["bet_amount_rank"]:
        ranked = options.filter(F.col("bet_amount_rank").isNotNull())
        daily = t.bets.groupBy(*KEYS, "data_date").agg(F.sum("bet_amount").alias("bet"))
        sums = daily.join(ranked, TENANT_KEYS).filter(in_range).groupBy(*MEMBER, "bet_amount_rank").agg(F.sum("bet").alias("bet"))
        place = F.row_number().over(Window.partitionBy(*BATCH).orderBy(F.desc("bet"), "user_id"))
        # the bound by the largest rank lets Spark drop rows before the shuffle
        top = sums.withColumn("place", place).filter(F.col("place") <= used["most"]).filter(
            F.col("place") <= F.col("bet_amount_rank")).select(*MEMBER, F.lit(True).alias("top"))
        found = found.join(top, MEMBER, "left").filter(F.col("bet_amount_rank").isNull() | F.col("top")).drop("top")
    return found.select(*MEMBER)


def match_batches(batches: DataFrame, t: SyncTables, today: date, materialise: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Members (``MEMBER``) of each batch of its tenant.

    A batch with a file has the members whose names the file holds, and nothing
    else is asked. Any other has the members of the wide table that fit its
    conditions: one of its levels, none of the excluded ones, all tags of one of
    its tag groups, none of the excluded tags (tags are whole codes), last active
    in its range, and then step, activity, prediction and betting rank.
    """
    given = with_options(batches)
    by_file = F.coalesce(F.col("file_name"), F.lit("")) != ""
    plain = given.filter(~by_file)
    fitting = member_keys(t.dw).join(batch_keys(plain), [*TENANT_KEYS, "key"]).filter(_fits()).select(*MEMBER).distinct()
    named = given.filter(by_file).select(*BATCH, "file_name").join(t.uploads, "file_name").select(*BATCH, "user_name").distinct()
    uploaded = t.members.select(*KEYS, "user_name").join(named, [*TENANT_KEYS, "user_name"]).select(*MEMBER)
    return _narrowed(fitting, plain, t, today, materialise).unionByName(uploaded)


def _numbered(batches: DataFrame, taken: DataFrame, column: str, wanted: Column) -> DataFrame:
    """Give the batches that lack ``column`` the next free numbers, in the order of their keys."""
    kind = batches.schema[column].dataType
    # a list of batches, one row each
    place = F.sum(wanted.cast("int")).over(Window.orderBy(*BATCH).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    highest = taken.agg(F.coalesce(F.max(column), F.lit(0))).scalar()
    return batches.withColumn(column, F.when(wanted, (highest + place).cast(kind)).otherwise(F.col(column)))


def sync_batches(
    batches: DataFrame, t: SyncTables, now, today: date, materialise: Callable[[DataFrame], DataFrame], seed: int = 0
) -> Synced:
    """All tables after one sync of the open batches. Batches that match nobody change nothing.

    With ``ab_test`` members are new if the batch's stored group lacks them, and
    are split (group 1, or 2 for the test part, which is not tagged); else they
    are new if the tag lacks them, and get group 0. Mode 2 also takes out members
    that match no longer. New tags and campaigns get the next free number.
    """
    matched = materialise(match_batches(active_batches(batches, now), t, today, materialise))
    counts = matched.groupBy(*BATCH).agg(F.count(F.lit(1)).alias("matched"))
    share = lambda g: F.count_if(F.col("group_id") == g)
    sizes = t.groups.groupBy(*BATCH).agg(((share(1) - share(2)) * 100 / F.count(F.lit(1))).alias("lead"))
    opened = with_options(batches).join(counts, BATCH).join(sizes, BATCH, "left").withColumns({
        "ab_test": F.coalesce("ab_test", F.lit(False)), "activity": F.coalesce("activity", F.lit(False))})
    known_tags = t.tagged.select("tag_id").union(batches.select("tag_id"))
    opened = _numbered(opened, known_tags, "tag_id", F.col("tag_id").isNull())
    opened = opened.withColumn("new_campaign", F.col("activity") & F.col("activity_id").isNull())
    opened = materialise(_numbered(opened, t.campaigns, "activity_id", F.col("new_campaign")))

    head = opened.select(*BATCH, "tag_id", "tag_name", "mode", "ab_test", "lead")
    grouped = t.groups.select(*MEMBER).distinct()
    in_group, in_tag = grouped.withColumn("in_group", F.lit(True)), t.tagged.select(*TAG, "user_id").distinct().withColumn("in_tag", F.lit(True))
    here = matched.join(head, BATCH).join(in_group, MEMBER, "left").join(in_tag, [*TAG, "user_id"], "left")
    known = F.when(F.col("ab_test"), F.col("in_group")).otherwise(F.col("in_tag"))
    fresh = materialise(here.filter(known.isNull()).select(*MEMBER, "tag_id", "tag_name", "ab_test", "lead"))
    placed = hash_places_by(fresh.filter("ab_test"), BATCH, KEYS, "user_id", seed)
    by_place = F.when(F.col("place") <= F.ceil(F.col("total") * 20 / 100), 2).otherwise(1)
    group = F.when(~F.col("ab_test"), 0).when(F.col("lead").isNull() | (F.col("total") >= 5), by_place).otherwise(
        F.when(F.col("lead") >= 60, 2).otherwise(1))
    added = materialise(fresh.join(placed, MEMBER, "left").select(
        *MEMBER, "tag_id", "tag_name", group.cast(t.groups.schema["group_id"].dataType).alias("group_id"), F.lit(True).alias("latest_tag")))
    to_tag = added.filter(F.col("group_id") != 2)

    # stored members of synced batches that match no longer
    gone = grouped.join(opened.filter("mode = 2").select(*BATCH, "tag_id", "activity_id", "activity", "ab_test"), BATCH).join(
        matched, MEMBER, "left_anti")
    stale_tags = t.tagged.select(*TAG, "user_id").join(opened.filter("mode = 2 AND NOT ab_test").select(*BATCH, "tag_id"), TAG).join(
        matched, MEMBER, "left_anti")
    untagged = gone.filter("ab_test").select(*TAG, "user_id").unionByName(stale_tags.select(*TAG, "user_id"))

    aged = t.groups.join(opened.select(*BATCH, "tag_id", F.lit(True).alias("own")), [*BATCH, "tag_id"], "left").select(*[
        (F.col(c) & F.col("own").isNull()).alias(c) if c == "latest_tag" else F.col(c) for c in t.groups.columns])
    groups = upsert(delete_keys(aged, gone, GROUP_KEY), added, GROUP_KEY)
    tagged = delete_keys(t.tagged.select(*TAG, "user_id"), untagged, [*TAG, "user_id"]).unionByName(to_tag.select(*TAG, "user_id")).distinct()

    text = [c for c in batches.columns if c.startswith("activity_") and c != "activity_id" and c in t.campaigns.columns]
    header = opened.filter("activity").select(*TENANT_KEYS, "activity_id", *text, "new_campaign")
    status = F.lit(2).cast(t.campaigns.schema["status"].dataType).alias("status")
    campaign = [*TENANT_KEYS, "activity_id"]
    campaigns = upsert(t.campaigns, header.filter("new_campaign").select(*campaign, *text, status), campaign)
    campaigns = upsert(campaigns, header.filter("NOT new_campaign").select(*campaign, *text), campaign)

    names = t.members.filter(F.col("user_name").isNotNull()).select(*KEYS, "user_name")
    of_campaign = lambda df: df.select(*KEYS, "activity_id").join(names, KEYS).select(*CAMPAIGN_MEMBER_KEY).distinct()
    joined = to_tag.join(opened.filter("activity").select(*BATCH, "activity_id"), BATCH)
    campaign_members = upsert(
        delete_keys(t.campaign_members, of_campaign(gone.filter("activity")), CAMPAIGN_MEMBER_KEY), of_campaign(joined), CAMPAIGN_MEMBER_KEY)

    actual = tagged.groupBy(*TAG).agg(F.count(F.lit(1)).alias("actual"))
    results = opened.join(actual, TAG, "left").select(
        *BATCH, "tag_id", F.col("matched").alias("match_user_count"), F.coalesce("actual", F.lit(0)).alias("actual_user_count"),
        F.coalesce("activity_id", F.lit(0)).alias("activity_id"), moment(now).alias("updated_time"))
    changed = update(batches, results.select(*BATCH, *[c for c in results.columns if c in batches.columns and c not in BATCH]), BATCH)
    return Synced(changed, groups, tagged, campaigns, campaign_members)


def update_match_counts(
    batches: DataFrame, t: SyncTables, now, today: date, materialise: Callable[[DataFrame], DataFrame], edited_within: int = 86400
) -> DataFrame:
    """Batch rows in which those open and edited within so many seconds carry how many members they match, also none.

    This preview asks for files, tags, levels, agents, dates, step and activity, not for predictions and ranks.
    """
    edited = with_options(active_batches(batches, now, edited_within)).withColumns({
        c: F.lit(None).cast(OPTIONAL[c]) for c in ("deposit_predict_rate", "bet_amount_rank")})
    counts = match_batches(edited, t, today, materialise).groupBy(*BATCH).agg(F.count(F.lit(1)).alias("match_user_count"))
    found = edited.select(*BATCH).join(counts, BATCH, "left").select(
        *BATCH, F.coalesce("match_user_count", F.lit(0)).alias("match_user_count"), moment(now).alias("updated_time"))
    return update(batches, found.select(*[c for c in found.columns if c in batches.columns]), BATCH)
