"""Rule tags. Every rule returns rows of ``ODS_COLUMNS``.

``bets15`` and ``deposits15`` are the last-15-active-days states of
``activity``; their groups are bounded by days and games, not by raw volume.
Thresholds are exact decimals, so sums kept as integers or decimals compare
without rounding.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import codes as C
from tagloom.functions.codes import KEYS, ODS_COLUMNS, WHO
from tagloom.functions.columns import (
    band_by_threshold, code_for, day, days_before, holds, iso_date, mask_prefix, of_tenant,
)
from tagloom.operators.keyed import best_by_group, dimension_join, hot_key_join, salted_join


def exact(number: str) -> Column:
    return F.lit(Decimal(number))


def ods_rows(df: DataFrame, code=None, tag_type: int = C.RULE_TAG_TYPE, enabled: Column | bool | None = True) -> DataFrame:
    """Complete ``df`` to tag rows; columns it already carries are kept."""
    if code is not None:
        df = df.withColumn("tag_code", F.lit(code) if isinstance(code, int) else code)
    if enabled is not None:
        df = df.withColumn("tag_enabled", F.lit(enabled) if isinstance(enabled, bool) else enabled)
    return df.withColumn("tag_type", F.lit(tag_type)).select(*ODS_COLUMNS)


def per_member(df: DataFrame, *extra: str):
    """Group by member; rows without a registration date form no group."""
    return df.filter(F.col("register_date").isNotNull()).groupBy(*WHO, *extra)


def with_agent(members: DataFrame) -> DataFrame:
    return members.filter(F.col("ag_name").isNotNull()).select(*WHO)


# -- logins -------------------------------------------------------------------
def tag_churned(
    login: DataFrame, members: DataFrame, as_of: date, days: int = 30, look: int = 31, code: int = C.CHURNED
) -> DataFrame:
    """Last login at least ``days`` ago; members seen since get a FALSE row."""
    last = (
        login.filter(F.col("data_date").between(days_before(as_of, look), day(as_of)))
        .groupBy(*KEYS)
        .agg((F.date_diff(F.max("data_date"), day(as_of)) <= -days).alias("tag_enabled"))
    )
    return ods_rows(last.join(with_agent(members), KEYS), code, enabled=None)


def tag_login_host(login: DataFrame, members: DataFrame, as_of: date, host: str, code: int) -> DataFrame:
    """Logged in from ``host`` on the day."""
    seen = login.filter((F.col("host") == host) & (F.col("data_date") == day(as_of))).select(*KEYS).distinct()
    return ods_rows(seen.join(members.filter(F.col("user_id") > 0).select(*WHO), KEYS), code)


def tag_app_user(login, members, as_of):
    return tag_login_host(login, members, as_of, "App", C.APP_USER)


def tag_login_ub(login, members, as_of):
    return tag_login_host(login, members, as_of, "UB", C.LOGIN_UB)


def tag_login_pc(login, members, as_of):
    return tag_login_host(login, members, as_of, "PC", C.LOGIN_PC)


# -- winning and losing -------------------------------------------------------
# these rules need members with three active days: the days are counted in the
# grouping that sums them, per member of a tenant
ACTIVE_DAYS_NEEDED = 3


def _sums() -> list[Column]:
    return [F.sum("commissionable").alias("commissionable"), F.sum("payoff").alias("payoff")]


def _daily(bets15: DataFrame) -> DataFrame:
    return per_member(bets15, "data_date").agg(*_sums())


def _result(bets15: DataFrame) -> DataFrame:
    """Totals of members with enough active days, and their winning and losing days."""
    return (
        _daily(bets15).groupBy(*WHO)
        .agg(*_sums(), F.count(F.lit(1)).alias("days"), F.count_if(F.col("payoff") >= 0).alias("wins"),
             F.count_if(F.col("payoff") < 0).alias("losses"))
        .filter(F.col("days") >= ACTIVE_DAYS_NEEDED)
    )


def tag_huge_winner(bets15: DataFrame) -> DataFrame:
    return ods_rows(_result(bets15).filter(F.col("payoff") > F.col("commissionable") * exact("0.5")), C.HUGE_WINNER)


def tag_huge_loser(bets15: DataFrame) -> DataFrame:
    lost = (F.col("payoff") < 0) & (F.col("payoff") < F.col("commissionable") * exact("-0.5"))
    return ods_rows(_result(bets15).filter(lost), C.HUGE_LOSER)


def tag_frequent_loser(bets15: DataFrame) -> DataFrame:
    """More losing than winning days (zero wins) and over 5 % of turnover lost."""
    often = (F.col("wins") < F.col("losses")) & (F.col("payoff") < F.col("commissionable") * exact("-0.05"))
    return ods_rows(_result(bets15).filter(often), C.FREQUENT_LOSER)


def tag_win_lose_reaction(bets15: DataFrame) -> DataFrame:
    """How turnover moved after winning and losing days: the most frequent class.

    Ties go to the class seen last.
    """
    member = Window.partitionBy(*KEYS)
    by_day = member.orderBy("data_date")
    moves = _daily(bets15).withColumns({
        "days": F.count(F.lit(1)).over(member),
        "before": F.lag("payoff").over(by_day),
        "change": F.col("commissionable") - F.lag("commissionable").over(by_day),
    }).filter(F.col("days") >= ACTIVE_DAYS_NEEDED)
    b, c = F.col("before"), F.col("change")
    reaction = (
        F.when((b > 0) & (c > 0), C.WIN_ADD).when((b > 0) & (c < 0), C.WIN_LEAVE)
        .when((b < 0) & (c > 0), C.LOSE_ADD).when((b < 0) & (c < 0), C.LOSE_LEAVE)
    )
    counted = (
        moves.withColumn("tag_code", reaction).filter(F.col("tag_code").isNotNull())
        .groupBy(*WHO, "tag_code").agg(F.count(F.lit(1)).alias("times"), F.max("data_date").alias("latest"))
    )
    return ods_rows(best_by_group(counted, WHO, [F.col("times"), F.col("latest")], ["tag_code"]))


# -- favourites ---------------------------------------------------------------
def tag_game_lover(bets15: DataFrame, codes: dict = C.GAME_LOVER) -> DataFrame:
    """Lobby group with most turnover (tie: larger group); unlisted groups get code 0."""
    groups = per_member(bets15, "lobby_group").agg(
        F.sum("commissionable").alias("commissionable"), F.collect_set("data_date").alias("dates"))
    favourite = groups.groupBy(*WHO).agg(
        F.max(F.struct("commissionable", "lobby_group")).alias("top"),
        F.size(F.array_distinct(F.flatten(F.collect_list("dates")))).alias("days"))
    return ods_rows(
        favourite.filter(F.col("days") >= ACTIVE_DAYS_NEEDED), code_for(F.col("top.lobby_group"), codes, 0))


def _favourite_time(bet_time15: DataFrame, column: str) -> DataFrame:
    total = per_member(bet_time15, column).agg(F.sum("commissionable").alias("commissionable"))
    return best_by_group(total, KEYS, [F.col("commissionable"), F.col(column)], ["user_name", "register_date", column])


def tag_bet_weekday(bet_time15: DataFrame) -> DataFrame:
    return ods_rows(_favourite_time(bet_time15, "data_weekday"), code_for(F.col("data_weekday"), C.BET_WEEKDAY, 0))


def tag_bet_hour(bet_time15: DataFrame) -> DataFrame:
    return ods_rows(_favourite_time(bet_time15, "bet_hour"), F.lit(C.BET_HOUR_BASE) + F.col("bet_hour"))


def tag_bet_period(bet_time15: DataFrame) -> DataFrame:
    return tag_bet_hour(bet_time15).unionByName(tag_bet_weekday(bet_time15))


def method_sums(sums: DataFrame, opcode_types: DataFrame, who: list[str], methods: dict = C.DEPOSIT_METHODS) -> DataFrame:
    """Sums per member and method, from sums per member and operation code."""
    types = opcode_types.groupBy("opcode").agg(F.collect_set("type").alias("types"))

    def belongs(method):
        return F.col("opcode").isin(method) if isinstance(method, list) else holds(F.array_contains("types", method))

    methods_of = F.array_compact(F.array(*[F.when(belongs(m), F.lit(code)) for code, m in methods.items()]))
    return (
        salted_join(sums, types, ["opcode"], "left")
        .select(*who, "amount", F.explode(methods_of).alias("tag_code"))
        .groupBy(*who, "tag_code").agg(F.sum("amount").alias("amount"))
    )


def tag_deposit_method(cash15: DataFrame, opcode_types: DataFrame, methods: dict = C.DEPOSIT_METHODS) -> DataFrame:
    """Deposit method with the largest sum (tie: larger code), if above zero."""
    per_method = method_sums(per_member(cash15, "opcode").agg(F.sum("amount").alias("amount")), opcode_types, WHO, methods)
    top = best_by_group(
        per_method, KEYS, [F.col("amount"), F.col("tag_code")], ["user_name", "register_date", "tag_code", "amount"])
    return ods_rows(top.filter(F.col("amount") > 0))


# -- good customers -----------------------------------------------------------
def bite_games(bets15: DataFrame, max_rate: str = "-0.2") -> DataFrame:
    """Games in the busier half of their lobby group whose payoff rate (%) is low enough.

    Windows run over one row per game. Ties in wagers: larger lobby, then game.
    """
    games = (
        bets15.filter(F.col("lobby_group").between(1, 6))
        .groupBy("hall_id", "domain_id", "lobby", "lobby_group", "game_type")
        .agg(*[F.sum(c).alias(c) for c in ("wagers_total", "commissionable", "payoff")])
    )
    group = Window.partitionBy("hall_id", "domain_id", "lobby_group")
    busiest = group.orderBy(F.desc("wagers_total"), F.desc("lobby"), F.desc("game_type"))
    return (
        games.withColumns({"place": F.row_number().over(busiest), "games": F.count(F.lit(1)).over(group)})
        .filter(F.col("place") <= F.ceil(F.col("games") / 2))
        .filter(F.col("payoff") * 100 <= F.col("commissionable") * exact(max_rate))
        .select("hall_id", "domain_id", "lobby", "lobby_group", "game_type")
    )


def deposit_history(dep_all: DataFrame, as_of: date) -> DataFrame:
    return (
        dep_all.filter(F.col("data_date") <= day(as_of)).groupBy(*KEYS)
        .agg(F.sum("deposit_count").alias("deposit_count"), F.sum("deposit_amount").alias("deposit_amount"),
             (F.sum("deposit_amount") - F.sum("withdraw_amount")).alias("kept"))
    )


def good_depositor(threshold) -> Column:
    return holds((F.col("deposit_count") >= 2) & (F.col("deposit_amount") >= threshold) & (F.col("kept") > 0))


def tag_good_customer(bets15: DataFrame, dep_all: DataFrame, threshold, as_of: date) -> DataFrame:
    """Depositors playing mostly house-favourable games, or members losing on most days and lobbies."""
    game = ["hall_id", "domain_id", "lobby", "lobby_group", "game_type"]
    bitten = hot_key_join(bets15, bite_games(bets15).withColumn("bite", F.lit(True)), game, "left")
    share = per_member(bitten).agg(
        F.sum("commissionable").alias("commissionable"),
        F.sum(F.when(F.col("bite"), F.col("commissionable")).otherwise(0)).alias("bite_commissionable"),
        F.size(F.collect_set("data_date")).alias("days")).filter(F.col("days") >= ACTIVE_DAYS_NEEDED)
    players = share.join(deposit_history(dep_all, as_of), KEYS, "left").filter(
        (F.col("bite_commissionable") * 2 > F.col("commissionable")) & good_depositor(threshold)).select(*WHO)

    losing_days = _result(bets15).filter(F.col("losses") * 10 >= F.col("days") * 6).select(*WHO)
    lobbies = per_member(bets15, "lobby").agg(F.sum("payoff").alias("payoff"))
    losing_lobbies = lobbies.groupBy(*WHO).agg(
        F.count_if(F.col("payoff") > 0).alias("won"), F.count_if(F.col("payoff") <= 0).alias("lost")
    ).filter(F.col("won") < F.col("lost")).select(*WHO)

    return ods_rows(players.unionByName(losing_days.join(losing_lobbies, WHO, "left_semi")).distinct(), C.GOOD_CUSTOMER)


def tag_good_customer_v1(
    bets15: DataFrame, game_flags: DataFrame, dep_all: DataFrame, threshold, as_of: date, code: int = C.GOOD_CUSTOMER
) -> DataFrame:
    """Older rule: less than half of the turnover each in pvp and pve games."""
    flagged = dimension_join(
        bets15, game_flags.filter(F.col("is_pvp") | F.col("is_pve")).select("hall_id", "domain_id", "lobby", "game_type", "is_pvp", "is_pve"),
        ["hall_id", "domain_id", "lobby", "game_type"], "left")
    part = lambda flag: F.sum(F.when(F.col(flag), F.col("commissionable")).otherwise(0))
    share = per_member(flagged).agg(
        F.sum("commissionable").alias("commissionable"), part("is_pvp").alias("pvp"), part("is_pve").alias("pve"))
    good = (
        (F.col("pvp") * 2 < F.col("commissionable")) & (F.col("pve") * 2 < F.col("commissionable"))
        & good_depositor(threshold)
    )
    return ods_rows(share.join(deposit_history(dep_all, as_of), KEYS, "left").filter(good), code)


# -- deposits -----------------------------------------------------------------
def tag_repeat_deposit(dep: DataFrame, members: DataFrame, as_of: date, minimum: int = 2) -> DataFrame:
    repeated = (
        dep.filter(F.col("data_date") <= day(as_of)).groupBy(*KEYS)
        .agg(F.sum("deposit_count").alias("deposits")).filter(F.col("deposits") >= minimum)
    )
    return ods_rows(repeated.join(with_agent(members), KEYS), C.REPEAT_DEPOSIT)


def tag_arbitrage_suspect(bets15: DataFrame, deposits15: DataFrame) -> DataFrame:
    """Turnover below twice the deposits; both must exist."""
    bet = per_member(bets15).agg(F.sum("commissionable").alias("commissionable"))
    deposit = per_member(deposits15).agg(F.sum("deposit_amount").alias("deposit_amount"))
    both = bet.join(deposit, WHO, "full_outer")
    return ods_rows(both.filter(holds(F.col("commissionable") < F.col("deposit_amount") * 2)), C.ARBITRAGE_SUSPECT)


def hedge_flags(
    arbitrage: DataFrame, as_of: date, likely: int, certain: int, vendor: int = 19, rounds: int = 50, stored: DataFrame | None = None
) -> DataFrame:
    """Per member: ``likely``, ``certain`` (hedged rounds of the day), ``was_likely``, ``was_certain`` (enabled stored tags)."""
    code = F.when(F.col("hedge_round_count") < rounds, likely).otherwise(certain)
    today = arbitrage.filter((F.col("external_game_code") == vendor) & (F.col("data_date") == day(as_of))).select(
        *KEYS, (code == likely).alias("likely"), (code == certain).alias("certain"), F.lit(False).alias("was_likely"), F.lit(False).alias("was_certain"))
    flags = ["likely", "certain", "was_likely", "was_certain"]
    if stored is not None:
        enabled = stored.filter(F.col("tag_enabled") & F.col("tag_code").isin(likely, certain))
        today = today.unionByName(enabled.select(
            *KEYS, F.lit(False).alias("likely"), F.lit(False).alias("certain"), (F.col("tag_code") == likely).alias("was_likely"),
            (F.col("tag_code") == certain).alias("was_certain")))
    return today.groupBy(*KEYS).agg(*[F.bool_or(f).alias(f) for f in flags])


def tag_hedge_arbitrage(
    arbitrage: DataFrame, members: DataFrame, as_of: date, likely: int, certain: int, vendor: int = 19, rounds: int = 50,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Hedged rounds of one vendor: certain from ``rounds`` up, else likely.

    A likely tag is disabled where the certain one is enabled as well, today or
    among the ``stored`` tag rows; a stored likely one goes when the certain one
    comes, or was stored beside it, also without rounds today. Only ``members`` get rows.
    """
    flagged = hedge_flags(arbitrage, as_of, likely, certain, vendor, rounds, stored)
    off = F.col("certain") | F.col("was_certain")
    tags = flagged.select(
        *KEYS,
        F.explode(F.array_compact(F.array(
            F.when(F.col("likely") | (off & F.col("was_likely")),
                   F.struct(F.lit(likely).alias("tag_code"), (~off).alias("tag_enabled"))),
            F.when(F.col("certain"), F.struct(F.lit(certain).alias("tag_code"), F.lit(True).alias("tag_enabled"))),
        ))).alias("tag"),
    ).select(*KEYS, "tag.*")
    return ods_rows(tags.join(members.select(*WHO), KEYS), tag_type=C.HEDGE_TAG_TYPE, enabled=None)


def tag_continuous_deposit(deposits15: DataFrame, as_of: date, days: int = 3) -> DataFrame:
    recent = deposits15.filter(F.col("data_date").between(days_before(as_of, days - 1), day(as_of)))
    return ods_rows(
        per_member(recent).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") == days), C.CONTINUOUS_DEPOSIT)


def _banded(df: DataFrame, reaches, bands: dict) -> DataFrame:
    return ods_rows(df.withColumn("tag_code", band_by_threshold(reaches, bands)).filter(F.col("tag_code") != 0))


def tag_avg_deposit_band(deposits15: DataFrame, bands: dict = C.AVG_DEPOSIT_BANDS) -> DataFrame:
    """Average single deposit of the latest deposit day (tie: larger amount)."""
    last = best_by_group(
        deposits15, KEYS, [F.col("data_date"), F.col("deposit_amount")],
        ["user_name", "register_date", "deposit_amount", "deposit_count"])
    return _banded(last, lambda t: holds(F.col("deposit_amount") >= F.col("deposit_count") * t), bands)


def tag_max_bet_band(bets15: DataFrame, bands: dict = C.MAX_BET_BANDS) -> DataFrame:
    """Largest turnover in one game on one day."""
    top = bets15.groupBy(*WHO).agg(F.max("commissionable").alias("top"))
    return _banded(top, lambda t: F.col("top") >= t, bands)


def tag_turnover_drop_band(bets15: DataFrame, as_of: date, bands: dict = C.TURNOVER_DROP_BANDS) -> DataFrame:
    """Last week's turnover minus this week's; no bets this week means no tag."""
    def week(first, last):
        inside = F.col("data_date").between(days_before(as_of, first), days_before(as_of, last))
        return F.sum(F.when(inside, F.col("commissionable")))

    weeks = per_member(bets15.filter(F.col("data_date") >= days_before(as_of, 13))).agg(
        week(13, 7).alias("last_week"), week(6, 0).alias("this_week"))
    drop = F.col("last_week") - F.col("this_week")
    return _banded(weeks, lambda t: holds(drop >= t), bands)


# -- hesitation, membership ---------------------------------------------------
def tag_hesitate(
    login: DataFrame, login_raw: DataFrame, deposits15: DataFrame, bets15: DataFrame, ga_page: DataFrame,
    members: DataFrame, as_of: date, days: int = 14, visits: int = 3, recent_logins: int = 5,
) -> DataFrame:
    """Interested without acting.

    Never deposited but logged in, or looked at deposit pages, three times in
    two weeks; or no bet and no deposit after the fifth-last login day. All signs
    of a member are one list of rows and one grouping.
    """
    nothing = {
        "logins": F.lit(None).cast("long"), "visits": F.lit(None).cast("long"), "login_day": F.lit(None).cast("date"),
        "deposits": F.lit(None).cast("long"), "paid_on": F.lit(None).cast("date"), "bet_on": F.lit(None).cast("date"),
    }
    signs = lambda df, **given: df.select(*KEYS, *[c.alias(n) for n, c in {**nothing, **given}.items()])
    pages = ga_page.filter(F.col("page_path").contains("deposit") & (F.col("data_date") >= days_before(as_of, days)))
    rows = reduce(DataFrame.unionByName, [
        signs(login.filter(F.col("data_date") >= days_before(as_of, days)), logins=F.col("login_count")),
        signs(pages.select(*KEYS, "page_path", "data_date").distinct(), visits=F.lit(1).cast("long")),
        signs(login_raw.filter(F.col("result") == 1), login_day=F.col("data_date")),
        signs(deposits15, deposits=F.col("deposit_count"), paid_on=F.col("data_date")),
        signs(bets15, bet_on=F.col("data_date")),
    ])
    latest_days = F.slice(F.sort_array(F.collect_set("login_day"), asc=False), 1, recent_logins)
    found = rows.groupBy(*KEYS).agg(
        F.sum("logins").alias("logins"), F.sum("visits").alias("visits"), F.array_min(latest_days).alias("oldest"),
        F.sum("deposits").alias("deposits"), F.max("paid_on").alias("paid_on"), F.max("bet_on").alias("bet_on"))
    known = found.join(members.select(*WHO), KEYS)
    interested = holds(F.col("logins") >= visits) | holds((F.col("visits") >= visits) & F.col("user_name").isNotNull())
    idle = holds((F.col("oldest") >= F.col("paid_on")) & (F.col("oldest") >= F.col("bet_on")))
    return ods_rows(known.filter((interested & (F.coalesce("deposits", F.lit(0)) == 0)) | idle), C.HESITATE)


def tag_term(bets15: DataFrame, today: date, terms: list = C.TERM) -> DataFrame:
    """Membership age of members with turnover."""
    registered = F.col("register_date").cast("timestamp_ntz")
    code = F.lit(None).cast("int")
    for limit, tag in reversed(terms):
        code = F.lit(tag) if limit is None else F.when(registered > days_before(today, limit).cast("timestamp_ntz"), tag).otherwise(code)
    active = per_member(bets15).agg(F.sum("commissionable").alias("commissionable")).filter(F.col("commissionable") > 0)
    return ods_rows(active, code)


def tag_certified(members: DataFrame) -> DataFrame:
    confirmed = (F.col("phone_confirm") == 1) | (F.col("email_confirm") == 1)
    return ods_rows(members.filter(holds(confirmed)).select(*WHO), C.CERTIFIED)


# -- corrections --------------------------------------------------------------
def tag_disjoint(ods: DataFrame, bad: list = C.BAD_CODES, good: list = C.GOOD_CODES) -> DataFrame:
    """Good tags to disable because the member carries a bad one: key, FALSE."""
    enabled = ods.filter("tag_enabled")
    bad_users = enabled.filter(F.col("tag_code").isin(bad)).select(*KEYS).distinct()
    return (
        enabled.filter(F.col("tag_code").isin(good)).join(bad_users, KEYS, "left_semi")
        .select(*KEYS, "tag_code", F.lit(False).alias("tag_enabled"))
    )


def tag_manual_edits(edits: DataFrame, codes: list[int]) -> DataFrame:
    """Latest manual decision per member and code (tie: larger edit type)."""
    latest = best_by_group(
        edits.filter(F.col("tag_code").isin(codes)), [*KEYS, "tag_code"],
        [F.col("updated_time"), F.col("edit_type")], ["edit_type"])
    decision = F.when(F.col("edit_type") == 1, True).when(F.col("edit_type") == 2, False)
    return latest.select(*KEYS, "tag_code", decision.alias("tag_enabled"))


def rule_codes() -> list[int]:
    """All codes the rules own: edited, reset and replaced together."""
    return [
        C.WIN_ADD, C.WIN_LEAVE, C.LOSE_ADD, C.LOSE_LEAVE, *C.GAME_LOVER.values(), C.GOOD_CUSTOMER, C.REPEAT_DEPOSIT,
        C.CHURNED, C.HUGE_WINNER, C.FREQUENT_LOSER, C.APP_USER, C.HUGE_LOSER, *C.BET_WEEKDAY.values(),
        *range(C.BET_HOUR_BASE, C.BET_HOUR_BASE + 24), C.ARBITRAGE_SUSPECT, C.LOGIN_UB, C.LOGIN_PC,
        C.CONTINUOUS_DEPOSIT, *C.AVG_DEPOSIT_BANDS.values(), *C.MAX_BET_BANDS.values(),
        *C.TURNOVER_DROP_BANDS.values(), *C.DEPOSIT_METHODS, C.HESITATE, C.CERTIFIED, *[code for _, code in C.TERM],
    ]


# -- uploads ------------------------------------------------------------------
def _upload_lines(upload: DataFrame) -> DataFrame:
    return upload.select(
        F.col(upload.columns[0]).alias("user_name"),
        iso_date(F.col(upload.columns[1])).alias("data_date"),
        (F.col(upload.columns[2]) != 0).alias("enable"))


def custom_upload_tags(
    upload: DataFrame, members: DataFrame, tag_code: int, tenant: Mapping, masked: bool = False
) -> DataFrame:
    """Tag rows of an uploaded (name, date, enable) file for the tenant's members so named.

    Of the lines of one name the latest date decides (tie: enabled). With
    ``masked`` the members carry masked names, and names are matched masked.
    """
    lines = _upload_lines(upload)
    if masked:
        lines = lines.withColumn("user_name", mask_prefix("user_name", 3))
    latest = best_by_group(lines, ["user_name"], [F.col("data_date"), F.col("enable")], ["enable"])
    matched = hot_key_join(members.filter(of_tenant(tenant)).select(*WHO), latest, ["user_name"])
    return ods_rows(matched, tag_code, int(str(tag_code)[0]), F.col("enable"))


def custom_upload_dates(upload: DataFrame, members: DataFrame, tag_code: int, tenant: Mapping) -> DataFrame:
    """Log of the uploaded lines of the tenant's known members."""
    known = members.filter(of_tenant(tenant)).select(*KEYS, "user_name")
    matched = hot_key_join(_upload_lines(upload), known, ["user_name"])
    return matched.select(*KEYS, F.lit(tag_code).alias("tag_code"), "data_date", "enable").distinct()


def custom_upload_counts(upload: DataFrame) -> DataFrame:
    enable = F.col(upload.columns[2])
    return upload.agg(F.count_if(enable == 1).alias("add_count"), F.count_if(enable == 0).alias("remove_count"))


def union_tags(tags: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tags)
