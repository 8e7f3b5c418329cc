"""Masked demo copies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.columns import days_before, day, mask_prefix, moment, of_tenant, tenant_date

STARS = "*****"
# column -> (characters kept, suffix)
MASKS = {
    "ag_name": (3, STARS),
    "user_name": (3, STARS),
    "name_real": (1, STARS),
    "user_phone": (5, STARS),
    "user_mail": (3, "****@*****"),
    "last_ip": (3, ".***.***.***"),
    "qq_num": (3, STARS),
    "wechat": (3, STARS),
}
AMOUNTS = [
    "balance", "bet_amount", "commissionable", "payoff", "deposit_amount", "withdraw_amount", "premium_amount",
    "profit_loss",
]
# table -> what its date range applies to; a trailing ! marks a UTC time read as a tenant day, None a full copy
DATED_BY = {
    "member_info": "register_date!",
    "login_log": "data_date",
    "game_type_dict": None,
    "bet_analysis": "data_date",
    "deposit_withdraw_record": "data_date",
    "offer_info": "data_date",
    "profit_loss": "data_date",
    "vip_login": "data_date",
    "login_location": None,
    "user_healthy_score": None,
    "user_tag_ods_data": "updated_time!",
    "user_tag_dw_data": "updated_time!",
    "activated_tag_day": "updated_time!",
    "activated_tag_dw_day": "updated_time!",
    "user_active_data": "updated_time!",
    "user_recommend_meta_data": "update_date!",
    "smart_message_notification_data": "updated_time!",
    "member_journey": "data_date",
    "member_journey_detail": "data_date",
    "ga_data_set": "data_date",
    "ga_page_path": "data_date",
}


def mask_columns(df: DataFrame, masks: Mapping[str, tuple[int, str]] = MASKS) -> DataFrame:
    return df.select(*[mask_prefix(c, *masks[c]) if c in masks else F.col(c) for c in df.columns])


def scale_amounts(df: DataFrame, columns: Sequence[str] = tuple(AMOUNTS), divisor: int = 100) -> DataFrame:
    """NULL counts as 0. Exact numbers keep their digits and two more; floating ones are divided as such."""
    def scaled(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return (F.coalesce(F.col(c), F.lit(0.0)) / divisor).cast(kind).alias(c)
        digits = max(2, kind.scale) if isinstance(kind, T.DecimalType) else 2
        amount = F.coalesce(F.col(c).cast(f"decimal({20 + digits},{digits})"), F.lit(0))
        return (amount * F.lit(Decimal(1) / divisor)).cast(f"decimal({22 + digits},{digits + 2})").alias(c)

    return df.select(*[scaled(c) if c in columns else F.col(c) for c in df.columns])


def mask_message_text(df: DataFrame, column: str = "content") -> DataFrame:
    """Shorten the member name (the pattern is a fixed value of the message format), swap the currency sign and divide the amount by 100.

    The amount loses its separators and is replaced wherever it occurs.
    """
    shortened = F.regexp_replace(
        F.col(column), r"(會員 #)(.{3})(.*)(@.*#)(.*)(¥)([0-9|,]+)(.*)", "$1$2*****$4$5℗$7$8")
    rest = F.pmod(F.col("_cents"), F.lit(100))
    digits = F.when(rest % 10 == 0, F.floor(rest / 10).cast("string")).otherwise(F.lpad(rest.cast("string"), 2, "0"))
    divided = F.concat(F.floor(F.col("_cents") / 100).cast("string"), F.lit("."), digits)
    # one column per stage, so that the patterns are matched once per row
    return (
        df.withColumn(column, shortened)
        .withColumn("_shown", F.regexp_extract(column, "℗([0-9|,]+)", 1))
        .withColumn("_cents", F.replace(F.col("_shown"), F.lit(","), F.lit("")).try_cast("long"))
        .withColumn(column, F.when(F.col("_cents").isNotNull(), F.replace(F.col(column), F.col("_shown"), divided))
                    .otherwise(F.col(column)))
        .drop("_shown", "_cents")
    )


def demo_copy(table: str, df: DataFrame, tenant: Mapping, start: date, end: date) -> DataFrame:
    """Masked, scaled copy of one table's rows of a tenant and date range."""
    rows = df.filter(of_tenant(tenant))
    dated = DATED_BY[table]
    if dated is not None:
        first = days_before(start, 2) if table == "member_info" else day(start)
        if dated.endswith("!"):  # bounds on the stored column as well, which the scan can use
            stored = F.col(dated[:-1])
            early, late = (moment(f"{d} 00:00:00") for d in (start - timedelta(days=4), end + timedelta(days=2)))
            rows = rows.filter((stored >= early) & (stored < late) & tenant_date(stored).between(first, day(end)))
        else:
            rows = rows.filter(F.col(dated).between(first, day(end)))
    if table == "user_tag_ods_data":
        rows = rows.filter(F.col("tag_type") != 1)
    if table == "smart_message_notification_data":
        rows = mask_message_text(rows)
    return scale_amounts(mask_columns(rows))
