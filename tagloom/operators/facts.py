"""Daily facts from raw member, login, wager, cash and promotion rows.

Every builder reduces the raw rows to its output grain first and attaches
member attributes afterwards, so raw rows shuffle once, already combined.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import codes as C
from tagloom.functions.columns import (
    any_of, code_for, contains_any, day, days_before, ingest_timestamp, ip_to_long, zero_if_null,
)
from tagloom.operators.keyed import dimension_join, hot_key_join, in_ranges, latest_with_ties, salted_join

FISCAL = ["financial_year", "financial_month", "financial_week"]
USER_DAY = ["user_id", "data_date", *FISCAL]
PLAYER_ROLE = 1


def in_range(column: str | Column, start: date, end: date) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.between(day(start), day(end))


def players(users: DataFrame) -> DataFrame:
    return users.filter(F.col("role") == PLAYER_ROLE)


def member_levels(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        F.col("parent_username").alias("ag_name"),
        F.coalesce("level_id", F.lit(0)).alias("user_level_id"),
        F.col("level_name").alias("user_level"),
    )


def changed_between(start: date, end: date) -> Column:
    """Created, or recreated, in the range."""
    return any_of(in_range(F.col(c).cast("date"), start, end) for c in ("created_at", "created_time"))


def member_info(users: DataFrame, start: date, end: date) -> DataFrame:
    """Players created in the range. Missing times stay NULL (no sentinel)."""
    return players(users).filter(changed_between(start, end)).select(
        "user_id",
        F.col("parent_username").alias("ag_name"),
        F.col("username").alias("user_name"),
        F.col("name").alias("name_real"),
        ingest_timestamp(F.col("created_at")).alias("register_date"),
        F.col("created_ip").alias("register_ip"),
        F.col("created_country").alias("register_country"),
        F.col("created_city").alias("register_city"),
        F.coalesce("created_by", F.lit(0)).alias("register_by"),
        F.col("phone").alias("user_phone"),
        F.col("email").alias("user_mail"),
        "balance",
        ingest_timestamp(F.col("last_login")).alias("last_login"),
        "last_ip",
        "last_country",
        zero_if_null("last_city_id"),
        ingest_timestamp(F.col("last_online")).alias("last_online"),
        "zalo",
        "facebook",
        F.lit(0).alias("arbitrage_flag"),
        F.coalesce("level_id", F.lit(0)).alias("user_level_id"),
        F.col("level_name").alias("user_level"),
        zero_if_null("email_confirm"),
        zero_if_null("phone_confirm"),
    )


def member_contacts(users: DataFrame, start: date, end: date) -> DataFrame:
    """Member rows of the family without roles and confirmations but other contacts."""
    return users.filter(changed_between(start, end)).select(
        "user_id",
        F.col("parent_username").alias("ag_name"),
        F.col("username").alias("user_name"),
        F.col("name").alias("name_real"),
        ingest_timestamp(F.col("created_at")).alias("register_date"),
        F.col("phone").alias("user_phone"),
        F.col("email").alias("user_mail"),
        "balance",
        ingest_timestamp(F.col("last_login")).alias("last_login"),
        "last_ip",
        "qq_num",
        "wechat",
        F.coalesce("level_id", F.lit(0)).alias("user_level_id"),
        F.col("level_name").alias("user_level"),
    )


def new_members(users: DataFrame, created: DataFrame, start: date, end: date) -> DataFrame:
    """Players created in the range by the profile or by the creation log."""
    logged = created.filter(in_range(F.col("created_time").cast("date"), start, end)).select(
        "user_id", F.lit(True).alias("logged")).distinct()
    return (
        players(users).join(logged, "user_id", "left")
        .filter(in_range(F.col("created_at").cast("date"), start, end) | F.col("logged"))
        .select("user_id", F.col("username").alias("user_name"))
    )


def login_log_app_flag(login: DataFrame, users: DataFrame, start: date, end: date) -> DataFrame:
    """Logins per player-day; the day is 'App' when any of its logins was."""
    daily = (
        login.filter(in_range("data_date", start, end))
        .groupBy(*USER_DAY)
        .agg(
            F.count("user_id").alias("login_count"),
            F.coalesce(F.bool_or(F.lower("host") == "app"), F.lit(False)).alias("any_app"),
        )
        .withColumn("host", F.when(F.col("any_app"), "App").otherwise("Web"))
    )
    return daily.join(players(users).select("user_id"), "user_id", "left_semi").select(
        "user_id", "login_count", "host", "data_date", *FISCAL
    )


def login_log_ingress(login: DataFrame, start: date, end: date) -> DataFrame:
    """Logins per member-day and host; counts of ingresses sharing a host add up."""
    ingress = F.col("ingress")
    host = (
        F.when(ingress.isin(C.INGRESS_APP), "App")
        .when(ingress.isin(C.INGRESS_PC), "PC")
        .when(ingress.isin(C.INGRESS_UB), "UB")
        .otherwise("Web")
    )
    return (
        login.filter(in_range("data_date", start, end))
        .groupBy("user_id", F.col("parent_username").alias("ag_name"), host.alias("host"), "data_date", *FISCAL)
        .agg(F.count("user_id").alias("login_count"))
    )


def vendor_kind(name: Column) -> Column:
    """Game kind named by a vendor; NULL when the name mentions none."""
    kind = F.lit(None).cast("int")
    for word, code in reversed(list(C.VENDOR_KIND_WORDS.items())):
        kind = F.when(name.contains(word), code).otherwise(kind)
    return kind


def vendors_by_kind(vendors: DataFrame) -> DataFrame:
    return vendors.select(
        F.col("id").alias("lobby"),
        F.col("tc_name").alias("lobby_name"),
        F.col("sc_name").alias("lobby_name_cn"),
        F.col("en_name").alias("lobby_name_en"),
        vendor_kind(F.col("tc_name")).alias("vendor_kind"),
    )


def fits_vendor(kind: Column) -> Column:
    return kind == F.coalesce("vendor_kind", kind)


def game_flags(name: str) -> list[Column]:
    flag = lambda words: F.coalesce(contains_any(F.col(name), words), F.lit(False))
    return [flag(C.PVP_WORDS).alias("is_pvp"), flag(C.PVE_WORDS).alias("is_pve")]


def game_dict(games: DataFrame, vendors: DataFrame) -> DataFrame:
    """Games with their vendor, where the vendor's kind does not contradict."""
    return (
        dimension_join(games.withColumn("lobby", F.col("vendor_id")), vendors_by_kind(vendors), ["lobby"])
        .filter(fits_vendor(F.col("kind")))
        .select(
            "lobby", "lobby_name", "lobby_name_cn", "lobby_name_en",
            F.col("game_code").alias("game_type"),
            F.col("zh_tw_name").alias("game_type_name"),
            F.col("zh_cn_name").alias("game_type_name_cn"),
            F.col("game_name").alias("game_type_name_en"),
            F.col("kind").alias("game_kind"),
            *game_flags("zh_tw_name"),
        )
    )


def game_dict_by_lobby(games: DataFrame, lobbies: DataFrame) -> DataFrame:
    """Same dictionary for the family keyed by lobby and lobby group."""
    names = lobbies.select(
        "lobby", F.col("tc_name").alias("lobby_name"), F.col("sc_name").alias("lobby_name_cn"),
        F.col("en_name").alias("lobby_name_en"))
    return dimension_join(games, names, ["lobby"]).select(
        "lobby", "lobby_name", "lobby_name_cn", "lobby_name_en", "lobby_group",
        code_for(F.col("lobby_group"), C.LOBBY_GROUP_NAMES, None).alias("lobby_group_name"),
        F.col("game_code").alias("game_type"),
        F.col("tc_name").alias("game_type_name"),
        F.col("sc_name").alias("game_type_name_cn"),
        F.col("en_name").alias("game_type_name_en"),
        *game_flags("tc_name"),
    )


def bet_totals(wager: DataFrame, dims: list[str]) -> DataFrame:
    """Sums per dimension tuple, with what an average needs to be merged later."""
    return wager.groupBy(*dims).agg(
        F.sum("wagers_total").alias("wagers_total"),
        F.sum("bet").alias("bet_amount"),
        F.sum("valid_bet").alias("commissionable"),
        F.sum("payoff").alias("payoff"),
        F.avg("win_rate").alias("win_rate"),
    )


def bet_analysis(
    wager: DataFrame, users: DataFrame, vendors: DataFrame, games: DataFrame, platforms: dict, start: date, end: date
) -> DataFrame:
    """Daily turnover per player, game and platform with vendor and game names.

    Member, vendor and game attributes hang on the grouping keys, so the wagers
    are aggregated before any of the three joins. The game dictionary has one
    row per (vendor, code).
    """
    dims = ["user_id", "parent_username", "lobby", "game_code", "kind", "device", "data_date", *FISCAL]
    wanted = wager.filter(in_range("data_date", start, end) & (F.col("game_code") != C.SETTLEMENT_GAME))
    totals = bet_totals(wanted, dims)
    members = member_levels(players(users)).drop("ag_name")
    game_names = games.select(
        F.col("vendor_id").alias("lobby"), "game_code", F.col("zh_tw_name").alias("game_name"),
        F.col("zh_cn_name").alias("game_name_cn"), F.col("game_name").alias("game_name_en"),
    )
    named = dimension_join(
        totals.join(members, "user_id"), vendors_by_kind(vendors), ["lobby"], "left",
        condition=lambda d: fits_vendor(F.col("kind")), counted=wanted,
    )
    return dimension_join(named, game_names, ["lobby", "game_code"], "left", counted=wanted).select(
        "user_id", F.col("parent_username").alias("ag_name"),
        "lobby", "lobby_name", "lobby_name_cn", "lobby_name_en",
        F.col("game_code").alias("game_type"), F.col("kind").alias("game_kind"),
        code_for(F.col("kind"), C.KIND_NAMES, None).alias("game_kind_name"),
        "game_name", "game_name_cn", "game_name_en",
        "wagers_total", "bet_amount", "commissionable", "payoff", "win_rate",
        F.col("device").alias("platform"), code_for(F.col("device"), platforms, "").alias("platform_name"),
        "data_date", *FISCAL, "user_level_id", "user_level",
    )


def bet_analysis_by_lobby(
    wager: DataFrame, lobbies: DataFrame, games: DataFrame, platforms: dict, start: date, end: date
) -> DataFrame:
    """Turnover of the lobby-group family: no member join, group NULL counts as 0."""
    dims = ["user_id", "parent_username", "lobby", "lobby_name", "lobby_group", "lobby_group_name", "game_code", "game_name",
            "platform", "data_date", *FISCAL, "level_id", "level_name"]
    wanted = wager.filter(in_range("data_date", start, end))
    totals = bet_totals(wanted, dims)
    names = games.select("lobby", "game_code", F.col("sc_name").alias("game_name_cn"), F.col("en_name").alias("game_name_en"))
    vendor = lobbies.select("lobby", F.col("sc_name").alias("lobby_name_cn"), F.col("en_name").alias("lobby_name_en"))
    # the vendor hangs on the matched game, so unmatched games have no vendor names
    dictionary = dimension_join(names, vendor, ["lobby"], "left")
    return dimension_join(totals, dictionary, ["lobby", "game_code"], "left", counted=wanted).select(
        "user_id", F.col("parent_username").alias("ag_name"), "lobby", "lobby_name", "lobby_name_cn", "lobby_name_en",
        zero_if_null("lobby_group"), "lobby_group_name", F.col("game_code").alias("game_type"),
        "game_name", "game_name_cn", "game_name_en",
        "wagers_total", "bet_amount", "commissionable", "payoff", "win_rate",
        "platform", code_for(F.col("platform"), platforms, "").alias("platform_name"),
        "data_date", *FISCAL, F.coalesce("level_id", F.lit(0)).alias("user_level_id"),
        F.col("level_name").alias("user_level"),
    )


def deposit_withdraw(deposits: DataFrame, withdrawals: DataFrame, users: DataFrame, start: date, end: date) -> DataFrame:
    """Deposits and withdrawals per member-day, either side alone kept.

    A member-day is one row even if the fiscal columns are missing on one side.
    """
    def side(df, **columns):
        settled = df.filter((F.col("status") != 0) & in_range("data_date", start, end))
        return settled.select(*USER_DAY, *[F.col(c).alias(name) for name, c in columns.items()])

    both = side(deposits, deposit_amount="amount", deposit_fee="fee", deposit_count="deposit_count").unionByName(
        side(withdrawals, withdraw_amount="real_amount", withdraw_fee="fee", withdraw_count="withdraw_count"),
        allowMissingColumns=True)
    members = member_levels(users).filter(F.col("ag_name").isNotNull())
    amounts = ["deposit_amount", "deposit_fee", "deposit_count", "withdraw_amount", "withdraw_fee", "withdraw_count"]
    per_day = both.groupBy("user_id", "data_date").agg(
        *[F.max(c).alias(c) for c in FISCAL], *[F.sum(c).alias(c) for c in amounts])
    return per_day.join(members, "user_id").select(
        "user_id", "ag_name", *[zero_if_null(c) for c in amounts], "data_date", *FISCAL, "user_level_id", "user_level"
    )


def offer_info(offers: DataFrame, users: DataFrame, start: date, end: date) -> DataFrame:
    """Granted offers with the member's agent and level, one row per offer."""
    wanted = offers.filter(in_range("data_date", start, end)).select(
        "user_id", "opcode", "opcode_name", "premium_total", "premium_amount", "data_date", *FISCAL)
    return hot_key_join(wanted, member_levels(users), ["user_id"])


def offer_dispatch(dispatch: DataFrame, start: date, end: date) -> DataFrame:
    return dispatch.filter(in_range("data_date", start, end)).select(
        "user_id", "promotion_id", "promotion_name", "premium_total", "premium_amount", "data_date", *FISCAL)


def offer_applicant(
    applicants: DataFrame, promotions: DataFrame, dispatch: DataFrame, start: date, end: date
) -> DataFrame:
    """Applications per member, promotion and day, split by the premium granted.

    Both sides are counted per key first; every application pairs with every
    grant of its key, hence the product of the counts.
    """
    wanted = applicants.filter(in_range("data_date", start, end))
    applied = wanted.groupBy("promotion_id", *USER_DAY).agg(F.count("user_id").alias("applications"))
    granted = dispatch.filter(in_range("data_date", start, end)).groupBy("promotion_id", "user_id", "data_date", "premium_total", "premium_amount").agg(
        F.count(F.lit(1)).alias("grants"))
    names = promotions.select("promotion_id", F.col("name").alias("promotion_name"))
    named = dimension_join(applied, names, ["promotion_id"], counted=wanted)
    key = ["promotion_id", "user_id", "data_date"]
    # an outer join could not split a key with very many different premiums
    paid = hot_key_join(granted, named, key)
    unpaid = named.join(granted.select(*key).distinct(), key, "left_anti").select(
        "*", F.lit(None).alias("premium_total"), F.lit(None).alias("premium_amount"), F.lit(1).alias("grants"))
    return (
        paid.unionByName(unpaid)
        .groupBy("user_id", "promotion_id", "promotion_name", "data_date", *FISCAL, zero_if_null("premium_total"),
                 zero_if_null("premium_amount"))
        .agg(F.sum(F.col("applications") * F.col("grants")).alias("application_count"))
    )


def offer_promotion(promotions: DataFrame, start: date) -> DataFrame:
    begin = F.col("start_time").cast("date")
    return promotions.filter(begin >= day(start)).select(
        "promotion_id", F.col("name").alias("promotion_name"), F.col("status").alias("promotion_status"),
        begin.alias("begin_date"), F.col("end_time").cast("date").alias("end_date"))


def profit_loss(offers: DataFrame, wagers: DataFrame, start: date, end: date) -> DataFrame:
    """House result per member-day: minus premiums, minus customer winnings."""
    both = wagers.filter(in_range("data_date", start, end)).select(*USER_DAY, "payoff").unionByName(
        offers.filter(in_range("data_date", start, end)).select(*USER_DAY, "premium_amount"), allowMissingColumns=True)
    sums = both.groupBy(*USER_DAY).agg(F.sum("payoff").alias("payoff"), F.sum("premium_amount").alias("premium_amount"))
    return sums.select(*USER_DAY, zero_if_null("payoff"), zero_if_null("premium_amount")).withColumn(
        "profit_loss", -F.col("premium_amount") - F.col("payoff"))


def vip_level(users: DataFrame, user_vip: DataFrame, vip_dim: DataFrame) -> DataFrame:
    levels = user_vip.filter(F.col("vip_level") != 0).select("user_id", "vip_id", "vip_level")
    named = salted_join(levels, vip_dim.select("vip_id", F.col("name").alias("vip_name")), ["vip_id"])
    return named.join(players(users).select("user_id", F.col("username").alias("user_name")), "user_id").select(
        "user_id", "user_name", "vip_id", "vip_name", "vip_level")


def with_calendar(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Attach the fiscal year, month and week of ``data_date``."""
    dates = calendar.select(F.col("date").alias("data_date"), "fin_year", "fin_month", "fin_week")
    return salted_join(df, dates, ["data_date"], "left")


def hourly_logins(login: DataFrame, start: date, end: date) -> DataFrame:
    data_date = F.col("at_ts").cast("date")
    return (
        login.filter(in_range(data_date, start, end))
        .groupBy("user_id", F.hour("at_ts").alias("login_hour"), data_date.alias("data_date"))
        .agg(F.count("user_id").alias("login_count"))
        .withColumn("weekday", F.weekday("data_date") + 1)
    )


def vip_login(
    login: DataFrame, users: DataFrame, vip: DataFrame, calendar: DataFrame, start: date, end: date
) -> DataFrame:
    """Hourly logins of customers with a VIP level."""
    names = users.select("user_id", F.col("username").alias("user_name"))
    vips = vip.filter(F.col("vip_level") >= 1)
    counted = hourly_logins(login, start, end).join(vips, "user_id", "left_semi").join(names, "user_id")
    return with_calendar(counted, calendar)


def vip_login_tagged(
    login: DataFrame, users: DataFrame, ods: DataFrame, calendar: DataFrame, start: date, end: date, vip_code: int = 10001
) -> DataFrame:
    """Same, where a customer is VIP by carrying an enabled tag."""
    tagged = ods.filter((F.col("tag_code") == vip_code) & F.col("tag_enabled"))
    names = users.select("user_id", F.col("username").alias("user_name"))
    counted = hourly_logins(login, start, end).join(tagged, "user_id", "left_semi").join(names, "user_id")
    return with_calendar(counted, calendar)


def latest_login(login: DataFrame, start: date, end: date, role: int | None = PLAYER_ROLE) -> DataFrame:
    """The successful login(s) of a role (None: any) at the latest time of each day; ties stay."""
    data_date = F.col("at_ts").cast("date")
    wanted = login.filter(
        in_range(data_date, start, end) & (F.col("result") == 1) & F.col("user_id").isNotNull()
        & (F.lit(True) if role is None else F.col("role") == role)
    ).select("user_id", data_date.alias("data_date"), "at_ts", "ip", "country_code", "city", "client_os", "client_browser")
    return latest_with_ties(wanted, ["user_id", "data_date"], "at_ts").drop("at_ts")


def login_location(logins: DataFrame, ip_ranges: DataFrame, materialise: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Attach the geography of the address range holding each login's IP; every distinct address is looked up once."""
    addresses = logins.select("ip").distinct().withColumn("ip_number", ip_to_long(F.col("ip")))
    held = in_ranges(addresses, "ip_number", ip_ranges.select("ip_from", "ip_to", "geo_country", "geo_city"), "ip_from", "ip_to", materialise)
    located = hot_key_join(addresses, held, ["ip_number"]).select("ip", "geo_country", "geo_city")
    return hot_key_join(logins, located, ["ip"], "left")


def member_names(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id", F.col("username").alias("user_name"),
        (F.col("created_at") + F.expr("INTERVAL 12 HOURS")).alias("register_date"))


def bet_time(wager: DataFrame, users: DataFrame, as_of: date, settled: DataFrame | None = None) -> DataFrame:
    """Turnover per member, hour, day and weekday (Sunday = 1).

    With ``settled`` the own-result wagers placed and settled are both counted.
    """
    def hours(df: DataFrame, ts: str) -> DataFrame:
        return df.filter(F.col(ts).cast("date") <= day(as_of)).select(
            "user_id", F.hour(ts).alias("bet_hour"), F.col(ts).cast("date").alias("data_date"),
            F.dayofweek(ts).alias("data_weekday"), F.col("valid_bet"))

    rows = hours(wager, "at_ts") if settled is None else hours(wager.filter("self_result = 1"), "at_ts").unionByName(
        hours(settled.filter("self_result = 1"), "settle_ts"))
    return (
        rows.groupBy("user_id", "bet_hour", "data_date", "data_weekday")
        .agg(F.sum("valid_bet").alias("commissionable"))
        .join(member_names(users), "user_id")
    )


def bet_time_of_vendors(vendor_tables: list[DataFrame], users: DataFrame, as_of: date, hours: int = -12) -> DataFrame:
    """Same over one wager table per vendor, whose clocks are shifted; weekday 0 is Monday."""
    moved = F.col("at_ts") + F.make_dt_interval(hours=F.lit(hours))
    every = reduce(DataFrame.unionByName, [
        t.select("user_id", "valid_bet", moved.alias("at_ts")) for t in vendor_tables])
    return bet_time(every, users, as_of).withColumn("data_weekday", F.weekday("data_date"))


def cash_by_opcode(cash: DataFrame, users: DataFrame, as_of: date) -> DataFrame:
    data_date = F.col("created_at").cast("date")
    return (
        cash.filter(data_date <= day(as_of))
        .groupBy("user_id", "opcode", data_date.alias("data_date"))
        .agg(F.sum("amount").alias("amount"))
        .join(member_names(users), "user_id")
    )


def online_month_games(games: DataFrame, today: date) -> DataFrame:
    return games.filter(
        (F.col("enable") == 1) & (F.col("online_at").cast("date") <= days_before(today, 30))
    ).select("vendor_id", "kind", "game_code", "enable")


def promotion_types(promotion: DataFrame, types: DataFrame) -> DataFrame:
    kinds = types.select(F.col("type").alias("promotion_type"), "name").distinct()
    named = promotion.select("domain_id", "promotion_id", "promotion_type").distinct()
    return salted_join(named, kinds, ["promotion_type"]).select(
        "domain_id", "promotion_id", F.col("promotion_type").alias("type"), "name")


def opcode_types(opcodes: DataFrame) -> DataFrame:
    return opcodes.select("opcode", "type")
