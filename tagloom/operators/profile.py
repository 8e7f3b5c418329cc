"""All rule tags from one profile row per member.

Each state or log is shuffled once, by member, and grouped to what the rules need
of it; the groupings by day, lobby or hour below it find their rows together. The
results meet the member table in joins on the same key, rules are conditions on
the joined row, and the codes that hold are exploded from one array.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import codes as C
from tagloom.functions.codes import KEYS, ODS_COLUMNS, WHO
from tagloom.functions.columns import day, days_before
from tagloom.operators import tags as T
from tagloom.operators.keyed import hot_key_join


def _by_dimension(rows: DataFrame, dims: Sequence[str], sums: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    """Sums per member, dimension and its value; rows arrive partitioned by member, so nothing moves again."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])
    spread = rows.repartition(*KEYS).withColumn("_d", F.explode(pairs)).select("*", "_d.dim", "_d.value")
    return spread.groupBy(*KEYS, "dim", "value").agg(*[F.sum(c).alias(c) for c in sums], *more)


def _of(dim: str, value: Column) -> Column:
    return F.when(F.col("dim") == dim, value)


def bet_profile(bets15: DataFrame, as_of: date) -> DataFrame:
    """Totals, days in order, lobbies, favourite group, largest turnover and weekly sums of the last active days."""
    game = ["hall_id", "domain_id", "lobby", "lobby_group", "game_type"]
    bitten = hot_key_join(bets15, T.bite_games(bets15).withColumn("bite", F.lit(True)), game, "left")
    rows = bitten.select(
        *KEYS, "data_date", "lobby", "lobby_group", "commissionable", "payoff",
        F.when(F.col("bite"), F.col("commissionable")).otherwise(0).alias("bitten"))
    parts = _by_dimension(
        rows, ["data_date", "lobby", "lobby_group"], ["commissionable", "payoff", "bitten"], [F.max("commissionable").alias("top")])
    on = F.col("value").cast("date")
    won, c = F.col("payoff"), F.col("commissionable")
    week = lambda first, last: F.sum(_of("data_date", F.when(
        on.between(days_before(as_of, first), days_before(as_of, last)), c)))
    count = lambda dim, condition: F.count_if((F.col("dim") == dim) & condition)
    return parts.groupBy(*KEYS).agg(
        F.sum(_of("data_date", c)).alias("b_turnover"), F.sum(_of("data_date", won)).alias("b_payoff"),
        F.sum(_of("data_date", F.col("bitten"))).alias("b_bitten"), F.max(_of("data_date", F.col("top"))).alias("b_top"),
        count("data_date", F.lit(True)).alias("b_days"), count("data_date", won >= 0).alias("b_wins"), count("data_date", won < 0).alias("b_losses"),
        F.max(_of("data_date", on)).alias("b_last"), week(13, 7).alias("b_last_week"), week(6, 0).alias("b_this_week"),
        count("lobby", won > 0).alias("b_lobbies_won"), count("lobby", won <= 0).alias("b_lobbies_lost"),
        F.max(_of("lobby_group", F.struct(c, F.col("value").cast("int").alias("group")))).alias("b_group"),
        F.array_sort(F.collect_list(_of("data_date", F.struct(on.alias("on"), c.alias("c"), won.alias("p"))))).alias("b_by_day"),
    ).withColumn("b_reaction", _reaction(F.col("b_by_day"))).drop("b_by_day")


def deposit_profile(deposits15: DataFrame, as_of: date, days: int = 3) -> DataFrame:
    recent = F.col("data_date").between(days_before(as_of, days - 1), day(as_of))
    return deposits15.groupBy(*KEYS).agg(
        F.sum("deposit_amount").alias("d_amount"), F.sum("deposit_count").alias("d_count"), F.max("data_date").alias("d_last"),
        F.count_if(recent).alias("d_recent"), F.max(F.struct("data_date", "deposit_amount", "deposit_count")).alias("d_latest"))


def time_profile(bet_time15: DataFrame) -> DataFrame:
    """Hour and weekday with most turnover (tie: the later one)."""
    parts = _by_dimension(bet_time15.select(*KEYS, "bet_hour", "data_weekday", "commissionable"), ["bet_hour", "data_weekday"], ["commissionable"])
    best = lambda dim: F.max(_of(dim, F.struct("commissionable", F.col("value").cast("int").alias("at"))))["at"]
    return parts.groupBy(*KEYS).agg(best("bet_hour").alias("t_hour"), best("data_weekday").alias("t_weekday"))


def method_profile(cash15: DataFrame, opcode_types: DataFrame) -> DataFrame:
    sums = cash15.groupBy(*KEYS, "opcode").agg(F.sum("amount").alias("amount"))
    per_method = T.method_sums(sums, opcode_types, KEYS)
    return per_method.groupBy(*KEYS).agg(F.max(F.struct("amount", "tag_code")).alias("m_best"))


def login_profile(login: DataFrame, as_of: date, look: int = 31, days: int = 14) -> DataFrame:
    """Last login of the days looked at, hosts of the day, logins of the last two weeks."""
    on = F.col("data_date")
    host = lambda name: F.bool_or((F.col("host") == name) & (on == day(as_of)))
    return login.filter(on >= days_before(as_of, max(look, days))).groupBy(*KEYS).agg(
        F.max(F.when(on.between(days_before(as_of, look), day(as_of)), on)).alias("l_last"),
        host("App").alias("l_app"), host("UB").alias("l_ub"), host("PC").alias("l_pc"),
        F.sum(F.when(on >= days_before(as_of, days), F.col("login_count"))).alias("l_recent"))


def login_day_profile(login_raw: DataFrame, recent_logins: int = 5) -> DataFrame:
    """The oldest of a member's latest login days; days combine before the shuffle."""
    days = F.sort_array(F.collect_set("data_date"), asc=False)
    latest = login_raw.filter(F.col("result") == 1).groupBy(*KEYS).agg(days.alias("days"))
    return latest.select(*KEYS, F.array_min(F.slice("days", 1, recent_logins)).alias("r_oldest"))


def page_profile(ga_page: DataFrame, as_of: date, days: int = 14) -> DataFrame:
    seen = ga_page.filter(F.col("page_path").contains("deposit") & (F.col("data_date") >= days_before(as_of, days)))
    distinct = seen.select(*KEYS, "page_path", "data_date").distinct()
    return distinct.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("p_visits"))


def _reaction(by_day: Column) -> Column:
    """Most frequent move of turnover after a winning or losing day (tie: the one seen last); NULL without any."""
    pairs = F.zip_with(F.slice(by_day, 1, F.size(by_day) - 1), F.slice(by_day, 2, F.size(by_day)), lambda a, b: F.struct(
        b["on"].alias("on"),
        F.when((a["p"] > 0) & (b["c"] > a["c"]), C.WIN_ADD).when((a["p"] > 0) & (b["c"] < a["c"]), C.WIN_LEAVE)
        .when((a["p"] < 0) & (b["c"] > a["c"]), C.LOSE_ADD).when((a["p"] < 0) & (b["c"] < a["c"]), C.LOSE_LEAVE).alias("code")))

    def seen(code: int) -> Column:
        own = F.filter(pairs, lambda m: m["code"] == code)
        latest = F.array_max(F.transform(own, lambda m: m["on"]))
        return F.when(F.size(own) > 0, F.struct(F.size(own).alias("times"), latest.alias("latest"), F.lit(code).alias("code")))

    best = F.array_max(F.array_compact(F.array(*[seen(k) for k in (C.WIN_ADD, C.WIN_LEAVE, C.LOSE_ADD, C.LOSE_LEAVE)])))
    return F.when(F.size(by_day) > 1, best["code"])


def member_profiles(inputs, settings) -> DataFrame:
    """Members with what every rule needs; columns of states a member is not in are NULL."""
    i, s = inputs, settings
    frames = [
        bet_profile(i.bets15, s.as_of), deposit_profile(i.deposits15, s.as_of), time_profile(i.bet_time15),
        method_profile(i.cash15, i.opcode_types), login_profile(i.login, s.as_of), login_day_profile(i.login_raw),
        page_profile(i.ga_page, s.as_of), T.deposit_history(i.deposits, s.as_of),
    ]
    if i.arbitrage is not None:
        frames.append(T.hedge_flags(i.arbitrage, s.as_of, *C.EXPORTED_EXTRA_CODES, stored=i.stored_tags))
    found = i.members.select(*WHO, "ag_name", "phone_confirm", "email_confirm")
    for frame in frames:
        found = found.join(frame, KEYS, "left")
    return found


def _band(value: str, bands: dict, times: str = "") -> str:
    """Code of the highest threshold that ``value`` reaches; NULL below all."""
    return "CASE " + " ".join(f"WHEN {value} >= {times}{t} THEN {bands[t]}" for t in sorted(bands, reverse=True)) + " END"


def _code(value: str, codes: dict) -> str:
    return f"CASE {value} " + " ".join(f"WHEN {k} THEN {v}" for k, v in codes.items()) + " ELSE 0 END"


def rule_book(settings) -> list[str]:
    """A code for each rule as an expression over the profile; NULL where the rule does not hold."""
    s = settings
    named, agent = "register_date IS NOT NULL", "ag_name IS NOT NULL"
    busy = f"{named} AND b_days >= {T.ACTIVE_DAYS_NEEDED}"
    player = f"b_bitten * 2 > b_turnover AND deposit_count >= 2 AND deposit_amount >= {s.good_customer_deposit} AND kept > 0"
    loser = "b_losses * 10 >= b_days * 6 AND b_lobbies_won < b_lobbies_lost"
    never_paid = "COALESCE(d_count, 0) = 0"
    interested = "l_recent >= 3 OR (p_visits >= 3 AND user_name IS NOT NULL)"
    idle = "r_oldest >= d_last AND r_oldest >= b_last"
    since = lambda days: f"register_date > DATE '{s.today}' - {days}"
    term = "CASE " + " ".join(f"WHEN {since(d)} THEN {code}" for d, code in C.TERM if d is not None) + f" ELSE {C.TERM[-1][1]} END"
    rules = [
        (f"{busy} AND (({player}) OR ({loser}))", C.GOOD_CUSTOMER),
        (f"{agent} AND deposit_count >= 2", C.REPEAT_DEPOSIT),
        (f"{busy} AND b_payoff > b_turnover * 0.5", C.HUGE_WINNER),
        (f"{busy} AND b_payoff < 0 AND b_payoff < b_turnover * -0.5", C.HUGE_LOSER),
        (f"{busy} AND b_wins < b_losses AND b_payoff < b_turnover * -0.05", C.FREQUENT_LOSER),
        (f"{busy} AND b_group IS NOT NULL", _code("b_group.group", C.GAME_LOVER)),
        (busy, "b_reaction"),
        ("user_id > 0 AND l_app", C.APP_USER),
        ("user_id > 0 AND l_ub", C.LOGIN_UB),
        ("user_id > 0 AND l_pc", C.LOGIN_PC),
        (named, f"{C.BET_HOUR_BASE} + t_hour"),
        (f"{named} AND t_weekday IS NOT NULL", _code("t_weekday", C.BET_WEEKDAY)),
        (f"{named} AND b_turnover < d_amount * 2", C.ARBITRAGE_SUSPECT),
        (f"{named} AND d_recent = 3", C.CONTINUOUS_DEPOSIT),
        ("TRUE", _band("d_latest.deposit_amount", s.avg_deposit_bands, "d_latest.deposit_count * ")),
        ("TRUE", _band("b_top", s.max_bet_bands)),
        (named, _band("(b_last_week - b_this_week)", s.turnover_drop_bands)),
        (f"{named} AND m_best.amount > 0", "m_best.tag_code"),
        (f"(({interested}) AND {never_paid}) OR ({idle})", C.HESITATE),
        ("phone_confirm = 1 OR email_confirm = 1", C.CERTIFIED),
        (f"{named} AND b_turnover > 0", term),
    ]
    return [f"CASE WHEN {condition} THEN {code} END" for condition, code in rules]


def special_tags(inputs, settings) -> list[str]:
    """Tags that a rule may also disable, as structs of code, type and enabled; the code is NULL where it does not hold."""
    tags = [(f"CASE WHEN ag_name IS NOT NULL AND l_last IS NOT NULL THEN {C.CHURNED} END", C.RULE_TAG_TYPE, f"l_last <= DATE '{settings.as_of}' - 30")]
    if inputs.arbitrage is not None:
        likely, certain = C.EXPORTED_EXTRA_CODES
        off = "(COALESCE(certain, FALSE) OR COALESCE(was_certain, FALSE))"
        tags += [
            (f"CASE WHEN likely OR ({off} AND was_likely) THEN {likely} END", C.HEDGE_TAG_TYPE, f"NOT {off}"),
            (f"CASE WHEN certain THEN {certain} END", C.HEDGE_TAG_TYPE, "TRUE"),
        ]
    return [f"STRUCT({code} AS tag_code, {kind} AS tag_type, {enabled} AS tag_enabled)" for code, kind, enabled in tags]


def rule_tags(inputs, settings) -> DataFrame:
    """Tag rows of every rule; one row per member and code."""
    plain = ", ".join(f"STRUCT({code} AS tag_code, {C.RULE_TAG_TYPE} AS tag_type, TRUE AS tag_enabled)" for code in rule_book(settings))
    held = f"EXPLODE(ARRAY({plain}, {', '.join(special_tags(inputs, settings))})) AS tag"
    found = member_profiles(inputs, settings).select(*WHO, F.expr(held)).filter("tag.tag_code IS NOT NULL")
    return found.select(*WHO, "tag.*").select(*ODS_COLUMNS)
