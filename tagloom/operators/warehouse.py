"""Tag warehouse: applying tag batches, the wide per-member table, counts and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import codes as C
from tagloom.functions.codes import KEYS, NEVER, TENANT_KEYS
from tagloom.functions.columns import between_zones, moment, tenant_date
from tagloom.operators.keyed import dimension_join, salted_join
from tagloom.operators.merge import delete_keys, upsert

ODS_KEY = [*KEYS, "tag_code"]
ENVIRONMENTS = {"local": "local", "demo": "dev", "prod": "prod"}
LANGUAGES = {"": "tag_name", "_cn": "tag_name_cn", "_en": "tag_name_en"}


def apply_tag_batch(ods: DataFrame, new_tags: DataFrame, reset_codes: list[int], now) -> DataFrame:
    """Disable every stored row of the reset codes, then replace by key, in one join."""
    stamp = moment(now)
    reset = F.col("tag_code").isin(reset_codes)
    base = ods.withColumns({
        "tag_enabled": F.when(reset, F.lit(False)).otherwise(F.col("tag_enabled")),
        "updated_time": F.when(reset, stamp).otherwise(F.col("updated_time")),
    })
    return upsert(base, new_tags.withColumn("updated_time", stamp), ODS_KEY)


def tag_name_columns() -> list[tuple[str, str, str]]:
    """(output column, environment word, name column) of the nine name lists."""
    return [
        (f"{env}_tag_name_str{suffix}", word, column)
        for suffix, column in LANGUAGES.items() for env, word in ENVIRONMENTS.items()
    ]


def tag_dim_names(tag_dim: DataFrame) -> DataFrame:
    """Enabled tags with the name visible per environment and language."""
    return tag_dim.filter("tag_enabled").select(
        "hall_id", "domain_id", "tag_code",
        *[F.when(F.col("can_access_env").contains(word), F.col(name)).alias(out) for out, word, name in tag_name_columns()])


def comma_list(items, field: str):
    """One field of a member's tags joined by commas; NULL when all are NULL."""
    values = F.transform(items, lambda t: t[field].cast("string"))
    return F.when(F.exists(values, lambda v: v.isNotNull()), F.array_join(values, ","))


def ods_to_dw(
    ods: DataFrame, members: DataFrame, tag_dim: DataFrame, tag_code: int | None = None, bets: DataFrame | None = None
) -> DataFrame:
    """Wide row of every member with a recently updated enabled tag.

    Recent means on or after the day before the tenant's latest update (tenant days).
    With ``tag_code`` only that tag counts as the trigger and the last bet date
    is attached. Lists are ordered by code.

    A member's tags are gathered once, with the date of the latest trigger; they
    are bounded by the tag dictionary.
    """
    last_update = ods.groupBy(*TENANT_KEYS).agg(
        F.date_sub(F.max(tenant_date(F.col("updated_time"))), 1).alias("last_update"))
    outputs = [out for out, _, _ in tag_name_columns()]
    trigger = F.lit(True) if tag_code is None else F.col("tag_code") == tag_code
    named = dimension_join(
        ods.filter("tag_enabled").select(*KEYS, "tag_code", F.when(trigger, tenant_date(F.col("updated_time"))).alias("day")),
        tag_dim_names(tag_dim), ["hall_id", "domain_id", "tag_code"], "left")
    gathered = named.groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.struct("tag_code", *outputs))).alias("tags"), F.max("day").alias("day"))
    lists = salted_join(gathered, last_update, TENANT_KEYS).filter(F.col("day") >= F.col("last_update")).select(
        *KEYS, comma_list(F.col("tags"), "tag_code").alias("tag_str"),
        *[comma_list(F.col("tags"), out).alias(out) for out in outputs])
    wide = lists.join(
        members.select(*KEYS, "user_name", "ag_name", "user_level_id", "user_level", "register_date"), KEYS)
    if tag_code is not None and bets is not None:
        last_bet = bets.groupBy(*KEYS).agg(F.max("data_date").alias("last_activated_date"))
        wide = wide.join(last_bet, KEYS, "left")
    return wide


def dw_stale_users(ods: DataFrame, dw: DataFrame) -> DataFrame:
    """Members of the wide table left without any enabled tag."""
    counts = ods.groupBy(*KEYS).agg(F.count_if("tag_enabled").alias("enabled"))
    return counts.filter(F.col("enabled") == 0).select(*KEYS).join(dw.select(*KEYS), KEYS, "left_semi")


def dw_last_dates(bets: DataFrame, login: DataFrame, dw: DataFrame) -> DataFrame:
    """Last bet and login date of wide-table members, over the 60 days before the table's own maxima of their tenant."""
    def recent(df: DataFrame, name: str, other: str) -> DataFrame:
        floor = dw.groupBy(*TENANT_KEYS).agg(
            F.coalesce(F.date_sub(F.max(name), 60), F.lit(NEVER).cast("date")).alias("floor"))
        last = df.groupBy(*KEYS).agg(F.max("data_date").alias(name), F.lit(None).cast("date").alias(other))
        return salted_join(last, floor, TENANT_KEYS).filter(F.col(name) >= F.col("floor")).drop("floor")

    both = recent(bets, "last_activated_date", "last_login_date").unionByName(
        recent(login, "last_login_date", "last_activated_date"))
    return (
        both.groupBy(*KEYS)
        .agg(F.max("last_activated_date").alias("last_activated_date"), F.max("last_login_date").alias("last_login_date"))
        .join(dw.select(*KEYS), KEYS, "left_semi")
    )


def refresh_wide(
    ods: DataFrame, dw: DataFrame, members: DataFrame, tag_dim: DataFrame, bets: DataFrame, login: DataFrame
) -> DataFrame:
    """The wide table after a rule run: members without enabled tags out, changed members in, last dates moved on.

    A date that is not found in the days looked at stays as stored.
    """
    kept = delete_keys(dw, dw_stale_users(ods, dw), KEYS)
    merged = upsert(kept, ods_to_dw(ods, members, tag_dim), KEYS)
    names = ["last_activated_date", "last_login_date"]
    dates = dw_last_dates(bets, login, merged).withColumnsRenamed({c: f"_{c}" for c in names})
    return merged.join(dates, KEYS, "left").select(*[
        F.coalesce(f"_{c}", c).alias(c) if c in names else F.col(c) for c in merged.columns])


def seed_tag_dim(tag_dim: DataFrame, tenants: DataFrame, definitions: list[dict]) -> DataFrame:
    """Give every tenant all tag definitions (an expansion of each tenant row), upserted."""
    rows = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in d.items()]) for d in definitions])
    seeded = tenants.select("hall_id", "hall_name", "domain_id", "domain_name", F.explode(rows).alias("d")).select(
        "hall_id", "hall_name", "domain_id", "domain_name", "d.*")
    return upsert(tag_dim, seeded, ["hall_id", "domain_id", "tag_code"])


def _active_counts(bets: DataFrame, ods: DataFrame, period: Column, name: str) -> DataFrame:
    active = bets.select(*KEYS, period.alias(name)).distinct()
    tags = ods.filter("tag_enabled").select(*KEYS, "tag_type", "tag_code")
    return active.join(tags, KEYS).groupBy("hall_id", "domain_id", name, "tag_type", "tag_code").agg(
        F.count(F.lit(1)).alias("total_count"))


def tag_daily_counts(bets: DataFrame, ods: DataFrame) -> DataFrame:
    return _active_counts(bets, ods, F.col("data_date"), "data_date")


def tag_monthly_counts(bets: DataFrame, ods: DataFrame) -> DataFrame:
    return _active_counts(bets, ods, F.trunc("data_date", "month"), "data_month")


def export_rule_tags(ods: DataFrame, tenant: dict, start, end) -> DataFrame:
    """Rule tags (and the two exported hedge codes) updated in the range."""
    updated = F.col("updated_time").between(moment(start), moment(end))
    wanted = (F.col("tag_type") == C.RULE_TAG_TYPE) | F.col("tag_code").isin(C.EXPORTED_EXTRA_CODES)
    return ods.filter(
        (F.col("hall_id") == tenant["hall_id"]) & (F.col("domain_id") == tenant["domain_id"]) & wanted & updated
    ).select(*KEYS, "user_name", "tag_code", "tag_type", F.col("tag_enabled").cast("int").alias("tag_enabled"), "register_date")


def snapshot_table(src: DataFrame, timestamps: list[str] = (), zone: str = "Asia/Taipei") -> DataFrame:
    """Whole-table copy: domain 0 becomes NULL, local times become UTC."""
    def copied(c: str) -> Column:
        if c == "domain_id":
            return F.nullif(F.col(c), F.lit(0)).alias(c)
        if c in timestamps:
            return between_zones(F.col(c), zone, "UTC").alias(c)
        return F.col(c)

    return src.select(*[copied(c) for c in src.columns])
