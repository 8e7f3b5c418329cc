"""Active-day states and rule tags."""

from pyspark.sql import functions as F

from tagloom.functions import codes as C
from tagloom.operators import activity, rules, tags
from tagloom.operators.masking import MASKS, mask_columns
from tagloom.plans.inputs import with_inputs
from tagloom.plans.registry import AS_OF, NAMED, NOW, REGISTRY, TENANT, TODAY, USER, query
from tagloom.sources.sinks import materialise
from tagloom.streaming.incremental import next_state

# the rule book's thresholds lie above the amounts in the inputs, so bands are scaled
DEPOSIT_BANDS = {100000: 30069, 200000: 30070, 300000: 30071, 400000: 30072, 450000: 30073}
BET_BANDS = {100000: 30074, 250000: 30075, 400000: 30076, 470000: 30077, 900000: 30078}
DROP_BANDS = {10000: 30079, 200000: 30080, 500000: 30081, 1000000: 30082}
GOOD_DEPOSIT = 500000

# -- states -------------------------------------------------------------------
BETS_NAMED = f"""SELECT {NAMED}, lobby_group, lobby, game_type, data_date, CAST(SUM(wagers_total) AS BIGINT) AS wagers_total,
 CAST(SUM(bet_amount) AS BIGINT) AS bet_amount, CAST(SUM(commissionable) AS BIGINT) AS commissionable, CAST(SUM(payoff) AS BIGINT) AS payoff
 FROM bet_analysis JOIN member_info USING ({USER}) WHERE user_name IS NOT NULL AND commissionable > 0 GROUP BY ALL"""
DEPOSITS_NAMED = f"""SELECT {NAMED}, deposit_amount, deposit_count, data_date
 FROM deposit_withdraw_record JOIN member_info USING ({USER}) WHERE user_name IS NOT NULL AND deposit_amount > 0"""
BET_TIME = f"""SELECT {NAMED}, bet_hour, data_date, CAST(dayofweek(data_date) + 1 AS INT) AS data_weekday,
 CAST(SUM(valid_bet) AS BIGINT) AS commissionable FROM wager JOIN member_info USING ({USER})
 WHERE user_name IS NOT NULL GROUP BY ALL"""
CASH = f"""SELECT {NAMED}, opcode, data_date, CAST(SUM(amount) AS BIGINT) AS amount
 FROM cash_entry JOIN member_info USING ({USER}) WHERE user_name IS NOT NULL GROUP BY ALL"""


def last15(table: str) -> str:
    return f"""SELECT * EXCLUDE (place), MIN(data_date) OVER (PARTITION BY {USER}) AS top_activate_date
 FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY {USER} ORDER BY data_date DESC) AS place FROM {table}) r WHERE place <= 15"""


BETS15 = {"bets_named": BETS_NAMED, "bets15": last15("bets_named")}
DEPOSITS15 = {"deposits_named": DEPOSITS_NAMED, "deposits15": last15("deposits_named")}
TIME15 = {"time_named": BET_TIME, "time15": last15("time_named")}
CASH15 = {"cash_named": CASH, "cash15": last15("cash_named")}
BUSY = {"busy": f"""SELECT * FROM bets15 WHERE user_id IN
 (SELECT user_id FROM bets15 GROUP BY {USER} HAVING COUNT(DISTINCT data_date) >= 3)"""}
BETS = {**BETS15, **BUSY}


def bets15(i):
    return activity.bet_state(i["bet_analysis"], i["member_info"])


def deposits15(i):
    return activity.deposit_state(i["deposit_withdraw_record"], i["member_info"])


def bet_time15(i):
    sums = activity.active_sums(i["wager"], ["bet_hour"], {"valid_bet": "commissionable"})
    return sums.join(activity.named_members(i["member_info"]), C.KEYS).withColumn("data_weekday", F.dayofweek("data_date"))


def cash15(i):
    sums = activity.active_sums(i["cash_entry"], ["opcode"], {"amount": "amount"})
    return sums.join(activity.named_members(i["member_info"]), C.KEYS)


query("last_active_bets", "SELECT * FROM bets15", BETS15)(bets15)
query("last_active_deposits", "SELECT * FROM deposits15", DEPOSITS15)(deposits15)
query("last_active_bet_time", "SELECT * FROM time15", TIME15)(bet_time15)
query("last_active_cash", "SELECT * FROM cash15", CASH15)(cash15)


@query("advance_active_days", "SELECT * FROM bets15", BETS15)
def _(i):
    fact = activity.bet_days(i["bet_analysis"], i["member_info"])
    earlier = i["bet_analysis"].filter(F.col("data_date") <= F.lit("2024-01-20").cast("date"))
    state = materialise(activity.bet_state(earlier, i["member_info"]))
    return next_state(state, fact)


@query("min_active_days", """
SELECT * FROM deposits_named WHERE user_id IN (SELECT user_id FROM deposits_named GROUP BY user_id
 HAVING COUNT(DISTINCT data_date) >= 9)""", DEPOSITS15)
def _(i):
    return activity.min_active_days(activity.deposit_days(i["deposit_withdraw_record"], i["member_info"]), 9)


VISITS = f"""SELECT DISTINCT {NAMED}, page_path, data_date FROM ga_page JOIN member_info USING ({USER})
 WHERE user_name IS NOT NULL AND page_path LIKE '%deposit%' AND data_date >= DATE '2024-01-16'"""


@query("deposit_page_visits", VISITS)
def _(i):
    return activity.deposit_page_visits(i["ga_page"], i["member_info"], AS_OF)


# -- tags ---------------------------------------------------------------------
def tag_row(code, enabled="TRUE", tag_type=3) -> str:
    return f"SELECT DISTINCT {NAMED}, {code} AS tag_code, {tag_type} AS tag_type, {enabled} AS tag_enabled"


def churned_sql(days: int) -> str:
    return f"""
{tag_row(30017, f"last <= DATE '2024-01-30' - {days}")}
FROM (SELECT {USER}, MAX(data_date) AS last FROM login_log WHERE data_date BETWEEN DATE '2024-01-30' - 31 AND DATE '2024-01-30'
      GROUP BY {USER}) l JOIN member_info USING ({USER}) WHERE ag_name IS NOT NULL"""


@query("tag_churned", churned_sql(5))
def _(i):
    return tags.tag_churned(i["login_log"], i["member_info"], AS_OF, days=5)


RESULT = f"SELECT {NAMED}, SUM(commissionable) AS c, SUM(payoff) AS p FROM busy GROUP BY {NAMED}"
query("tag_huge_winner", f"{tag_row(30019)} FROM r WHERE 2 * p > c", {**BETS, "r": RESULT})(
    lambda i: tags.tag_huge_winner(bets15(i)))
query("tag_huge_loser", f"{tag_row(30022)} FROM r WHERE p < 0 AND 2 * p < -c", {**BETS, "r": RESULT})(
    lambda i: tags.tag_huge_loser(bets15(i)))

DAILY = f"SELECT {NAMED}, data_date, SUM(commissionable) AS c, SUM(payoff) AS p FROM busy GROUP BY {NAMED}, data_date"
query("tag_frequent_loser", f"""
{tag_row(30020)} FROM (SELECT {NAMED}, SUM(c) AS c, SUM(p) AS p, COUNT(*) FILTER (p >= 0) AS w, COUNT(*) FILTER (p < 0) AS l
 FROM daily GROUP BY {NAMED}) t WHERE w < l AND 20 * p < -c""", {**BETS, "daily": DAILY})(
    lambda i: tags.tag_frequent_loser(bets15(i)))

query("tag_game_lover", f"""
{tag_row("CASE lobby_group WHEN 1 THEN 30012 WHEN 2 THEN 30013 WHEN 3 THEN 30009 WHEN 5 THEN 30010 WHEN 6 THEN 30011 ELSE 0 END")}
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {NAMED} ORDER BY c DESC, lobby_group DESC) AS place
      FROM (SELECT {NAMED}, lobby_group, SUM(commissionable) AS c FROM busy GROUP BY {NAMED}, lobby_group) g) t WHERE place = 1""",
      BETS)(lambda i: tags.tag_game_lover(bets15(i)))

query("tag_win_lose_reaction", f"""
{tag_row("code")} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {NAMED} ORDER BY times DESC, data_date DESC) AS place
 FROM (SELECT *, COUNT(*) OVER (PARTITION BY {NAMED}, code) AS times
       FROM (SELECT *, CASE WHEN b > 0 AND d > 0 THEN 30004 WHEN b > 0 AND d < 0 THEN 30005
                            WHEN b < 0 AND d > 0 THEN 30006 WHEN b < 0 AND d < 0 THEN 30007 END AS code
             FROM (SELECT *, LAG(p) OVER w AS b, c - LAG(c) OVER w AS d FROM daily
                   WINDOW w AS (PARTITION BY {USER} ORDER BY data_date)) x) y WHERE code IS NOT NULL) z) t
WHERE place = 1""", {**BETS, "daily": DAILY})(lambda i: tags.tag_win_lose_reaction(bets15(i)))

for name, host, code, rule in [("tag_app_user", "App", 30021, tags.tag_app_user), ("tag_login_ub", "UB", 30055, tags.tag_login_ub),
                               ("tag_login_pc", "PC", 30056, tags.tag_login_pc)]:
    query(name, f"""{tag_row(code)} FROM login_log JOIN member_info USING ({USER})
 WHERE user_id > 0 AND host = '{host}' AND data_date = DATE '2024-01-30'""")(
        lambda i, rule=rule: rule(i["login_log"], i["member_info"], AS_OF))


def favourite(column: str, code: str) -> str:
    return f"""{tag_row(code)} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {USER} ORDER BY c DESC, {column} DESC) AS place
 FROM (SELECT {NAMED}, {column}, SUM(commissionable) AS c FROM time15 GROUP BY {NAMED}, {column}) g) t WHERE place = 1"""


WEEKDAY = favourite("data_weekday", "CASE data_weekday WHEN 1 THEN 30029 ELSE 30021 + data_weekday END")
HOUR = favourite("bet_hour", "30030 + bet_hour")
query("tag_bet_weekday", WEEKDAY, TIME15)(lambda i: tags.tag_bet_weekday(bet_time15(i)))
query("tag_bet_hour", HOUR, TIME15)(lambda i: tags.tag_bet_hour(bet_time15(i)))
query("tag_bet_period", f"{HOUR} UNION ALL {WEEKDAY}", TIME15)(lambda i: tags.tag_bet_period(bet_time15(i)))

METHODS = """SELECT 30200 AS code, opcode FROM opcodes WHERE type = 'CD' UNION ALL SELECT 30201, opcode FROM opcodes WHERE type = 'CryptoD'
 UNION ALL SELECT 30202, opcode FROM opcodes WHERE type = 'MD'
 UNION ALL SELECT * FROM (VALUES (30203, 2096), (30203, 2097), (30204, 2099), (30204, 2100), (30205, 1039), (30205, 1040),
  (30206, 2508), (30206, 2509), (30207, 2525), (30207, 2526), (30208, 2514), (30208, 2515)) v(code, opcode)"""
query("tag_deposit_method", f"""
{tag_row("code")} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {USER} ORDER BY amount DESC, code DESC) AS place
 FROM (SELECT {NAMED}, code, SUM(amount) AS amount FROM cash15 JOIN methods USING (opcode) GROUP BY {NAMED}, code) g) t
WHERE place = 1 AND amount > 0""", {**CASH15, "methods": METHODS})(
    lambda i: tags.tag_deposit_method(cash15(i), i["opcodes"]))

HISTORY = f"""SELECT {USER}, SUM(deposit_count) AS n, SUM(deposit_amount) AS amount, SUM(deposit_amount) - SUM(withdraw_amount) AS kept
 FROM deposit_withdraw_record WHERE data_date <= DATE '2024-01-30' GROUP BY {USER}"""
GAME = "hall_id, domain_id, lobby, lobby_group, game_type"
GOOD = {
    **BETS, "history": HISTORY,
    "games_sum": f"""SELECT {GAME}, SUM(wagers_total) AS w, SUM(commissionable) AS c, SUM(payoff) AS p FROM bets15
                     WHERE lobby_group BETWEEN 1 AND 6 GROUP BY {GAME}""",
    "bite": f"""SELECT {GAME} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY hall_id, domain_id, lobby_group
                  ORDER BY w DESC, lobby DESC, game_type DESC) AS place, COUNT(*) OVER (PARTITION BY hall_id, domain_id, lobby_group) AS games
                FROM games_sum) t WHERE place <= CEIL(games / 2) AND 500 * p <= -c""",
    "share": f"""SELECT {NAMED}, SUM(commissionable) AS c, SUM(CASE WHEN b.lobby IS NOT NULL THEN commissionable ELSE 0 END) AS bitten
                 FROM busy LEFT JOIN bite b USING ({GAME}) GROUP BY {NAMED}""",
    "days": f"SELECT {NAMED}, data_date, SUM(payoff) AS p FROM busy GROUP BY {NAMED}, data_date",
    "halls": f"SELECT {NAMED}, lobby, SUM(payoff) AS p FROM busy GROUP BY {NAMED}, lobby",
}
query("tag_good_customer", f"""
{tag_row(30015)} FROM (
 SELECT {NAMED} FROM share JOIN history USING ({USER}) WHERE 2 * bitten > c AND n >= 2 AND amount >= {GOOD_DEPOSIT} AND kept > 0
 UNION
 SELECT {NAMED} FROM (SELECT {NAMED} FROM days GROUP BY {NAMED} HAVING COUNT(*) FILTER (p < 0) / COUNT(*) >= 0.6) a
 JOIN (SELECT {NAMED} FROM halls GROUP BY {NAMED} HAVING COUNT(*) FILTER (p > 0) < COUNT(*) FILTER (p <= 0)) b
 USING ({NAMED})) t""", GOOD)(
    lambda i: tags.tag_good_customer(materialise(bets15(i)), i["deposit_withdraw_record"], GOOD_DEPOSIT, AS_OF))

query("tag_good_customer_v1", f"""
{tag_row(30015)} FROM (SELECT {NAMED}, SUM(commissionable) AS c, SUM(CASE WHEN is_pvp THEN commissionable ELSE 0 END) AS pvp,
  SUM(CASE WHEN is_pve THEN commissionable ELSE 0 END) AS pve
  FROM bets15 LEFT JOIN game_flags USING (hall_id, domain_id, lobby, game_type) GROUP BY {NAMED}) s JOIN history USING ({USER})
WHERE 2 * pvp < c AND 2 * pve < c AND n >= 2 AND amount >= {GOOD_DEPOSIT} AND kept > 0""", {**BETS15, "history": HISTORY})(
    lambda i: tags.tag_good_customer_v1(materialise(bets15(i)), i["game_flags"], i["deposit_withdraw_record"], GOOD_DEPOSIT, AS_OF))

query("tag_repeat_deposit", f"""
{tag_row(30016)} FROM (SELECT {USER} FROM deposit_withdraw_record WHERE data_date <= DATE '2024-01-30' GROUP BY {USER}
 HAVING SUM(deposit_count) >= 2) d JOIN member_info USING ({USER}) WHERE ag_name IS NOT NULL""")(
    lambda i: tags.tag_repeat_deposit(i["deposit_withdraw_record"], i["member_info"], AS_OF))

query("tag_arbitrage_suspect", f"""
{tag_row(30054)} FROM (SELECT {NAMED}, SUM(commissionable) AS c FROM bets15 GROUP BY {NAMED}) b
FULL OUTER JOIN (SELECT {NAMED}, SUM(deposit_amount) AS d FROM deposits15 GROUP BY {NAMED}) x USING ({NAMED}) WHERE c < 2 * d""",
      {**BETS15, **DEPOSITS15})(lambda i: tags.tag_arbitrage_suspect(bets15(i), deposits15(i)))

HEDGED = f"""SELECT DISTINCT {NAMED}, CASE WHEN hedge_round_count < 50 THEN 40006 ELSE 40007 END AS code
 FROM arbitrage_info JOIN member_info USING ({USER}) WHERE external_game_code = 19 AND data_date = DATE '2024-01-30'"""

def hedge_parts(stored: str) -> dict[str, str]:
    return {
        "hedged": HEDGED,
        "hedge_state": f"SELECT {USER}, code FROM hedged UNION SELECT {USER}, tag_code AS code FROM {stored} WHERE tag_enabled",
        "hedge_both": f"SELECT {USER} FROM hedge_state WHERE code IN (40006, 40007) GROUP BY {USER} HAVING COUNT(DISTINCT code) = 2",
    }


HEDGE_SQL = f"""
{tag_row("code", f"NOT (code = 40006 AND ({USER}) IN (SELECT ({USER}) FROM hedge_both))", 4)}
FROM (SELECT {NAMED}, code FROM hedged UNION SELECT {NAMED}, 40006 AS code FROM hedge_both JOIN member_info USING ({USER})) t"""
# against all stored tags as in the daily job, and against stored hedge tags of more kinds
for name, table in [("tag_hedge_arbitrage", "ods"), ("tag_hedge_arbitrage_stored", "hedge_stored")]:
    query(name, HEDGE_SQL, hedge_parts(table))(
        lambda i, table=table: tags.tag_hedge_arbitrage(
            i["arbitrage_info"], i["member_info"], AS_OF, *C.EXPORTED_EXTRA_CODES, stored=i[table]))

query("tag_continuous_deposit", f"""
{tag_row(30057)} FROM (SELECT {NAMED} FROM deposits15 WHERE data_date BETWEEN DATE '2024-01-28' AND DATE '2024-01-30'
 GROUP BY {NAMED} HAVING COUNT(*) = 3) t""", DEPOSITS15)(lambda i: tags.tag_continuous_deposit(deposits15(i), AS_OF))


def band(value: str, bands: dict) -> str:
    return "CASE " + " ".join(f"WHEN {value} >= {t} THEN {bands[t]}" for t in sorted(bands, reverse=True)) + " ELSE 0 END"


def banded(source: str) -> str:
    return f"{tag_row('code')} FROM ({source}) t WHERE code <> 0"


query("tag_avg_deposit_band", banded(f"""SELECT *, {band('deposit_amount / deposit_count', DEPOSIT_BANDS)} AS code FROM deposits15
 QUALIFY ROW_NUMBER() OVER (PARTITION BY {USER} ORDER BY data_date DESC, deposit_amount DESC) = 1"""), DEPOSITS15)(
    lambda i: tags.tag_avg_deposit_band(deposits15(i), DEPOSIT_BANDS))
query("tag_max_bet_band", banded(f"""SELECT {NAMED}, {band('MAX(commissionable)', BET_BANDS)} AS code FROM bets15 GROUP BY {NAMED}"""),
      BETS15)(lambda i: tags.tag_max_bet_band(bets15(i), BET_BANDS))
query("tag_turnover_drop_band", banded(f"""
SELECT *, {band('a.c - b.c', DROP_BANDS)} AS code
FROM (SELECT {NAMED}, SUM(commissionable) AS c FROM bets15 WHERE data_date BETWEEN DATE '2024-01-17' AND DATE '2024-01-23' GROUP BY {NAMED}) a
JOIN (SELECT {NAMED}, SUM(commissionable) AS c FROM bets15 WHERE data_date BETWEEN DATE '2024-01-24' AND DATE '2024-01-30' GROUP BY {NAMED}) b
USING ({NAMED})"""), BETS15)(lambda i: tags.tag_turnover_drop_band(bets15(i), AS_OF, DROP_BANDS))

HESITATE = {
    **BETS15, **DEPOSITS15, "visits": VISITS,
    "depositors": "SELECT user_id FROM deposits15 GROUP BY user_id HAVING SUM(deposit_count) <> 0",
    "oldest": f"""SELECT user_id, MIN(data_date) AS day FROM (SELECT user_id, data_date, ROW_NUMBER() OVER (PARTITION BY user_id
                    ORDER BY data_date DESC) AS place FROM (SELECT DISTINCT user_id, data_date FROM login_raw WHERE result = 1) d) r
                  WHERE place <= 5 GROUP BY user_id""",
}
query("tag_hesitate", f"""
{tag_row(30091)} FROM member_info WHERE user_id IN (
 SELECT user_id FROM login_log WHERE data_date >= DATE '2024-01-16' GROUP BY user_id HAVING SUM(login_count) >= 3
   AND user_id NOT IN (SELECT user_id FROM depositors)
 UNION SELECT user_id FROM visits GROUP BY user_id HAVING COUNT(*) >= 3 AND user_id NOT IN (SELECT user_id FROM depositors)
 UNION SELECT o.user_id FROM oldest o JOIN (SELECT user_id, MAX(data_date) AS day FROM deposits15 GROUP BY user_id) d ON o.user_id = d.user_id
   JOIN (SELECT user_id, MAX(data_date) AS day FROM bets15 GROUP BY user_id) b ON o.user_id = b.user_id
   WHERE o.day >= d.day AND o.day >= b.day)""", HESITATE)(
    lambda i: tags.tag_hesitate(i["login_log"], i["login_raw"], deposits15(i), bets15(i), i["ga_page"], i["member_info"], AS_OF))

query("tag_term", f"""
{tag_row("CASE WHEN age < 30 THEN 30093 WHEN age < 90 THEN 30094 WHEN age < 180 THEN 30095 ELSE 30096 END")}
FROM (SELECT *, DATE '2024-01-31' - register_date AS age FROM bets15 WHERE commissionable > 0) t""", BETS15)(
    lambda i: tags.tag_term(bets15(i), TODAY))
query("tag_certified", f"{tag_row(30092)} FROM member_info WHERE phone_confirm = 1 OR email_confirm = 1")(
    lambda i: tags.tag_certified(i["member_info"]))

BAD = ", ".join(map(str, C.BAD_CODES))
query("tag_disjoint", f"""
SELECT {USER}, tag_code, FALSE AS tag_enabled FROM ods WHERE tag_code = 30015 AND tag_enabled
 AND user_id IN (SELECT user_id FROM ods WHERE tag_code IN ({BAD}) AND tag_enabled)""")(lambda i: tags.tag_disjoint(i["ods"]))

EDIT_CODES = [30015, 30019]
LATEST_EDITS = f"""SELECT {USER}, tag_code, CASE edit_type WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS tag_enabled
 FROM edits WHERE tag_code IN ({{0}}) QUALIFY ROW_NUMBER() OVER (PARTITION BY {USER}, tag_code ORDER BY updated_time DESC, edit_type DESC) = 1"""
query("tag_manual_edits", LATEST_EDITS.format("30015, 30019"))(lambda i: tags.tag_manual_edits(i["edits"], EDIT_CODES))

UPLOADED = f"""SELECT {NAMED}, enable <> 0 AS enable, make_date(CAST(split_part(d, '-', 1) AS INT), CAST(split_part(d, '-', 2) AS INT),
 CAST(split_part(d, '-', 3) AS INT)) AS data_date
 FROM (SELECT *, replace(data_date, '/', '-') AS d FROM upload) u JOIN member_info m USING (user_name)
WHERE hall_id = 1 AND domain_id = 1"""
query("tag_custom_upload", f"""
SELECT {NAMED}, 40032 AS tag_code, 4 AS tag_type, enable AS tag_enabled FROM uploaded
QUALIFY ROW_NUMBER() OVER (PARTITION BY {USER} ORDER BY data_date DESC, enable DESC) = 1""", {"uploaded": UPLOADED})(
    lambda i: tags.custom_upload_tags(i["upload"], i["member_info"], 40032, TENANT))
MASKED = "SELECT * REPLACE (substr(user_name, 1, 3) || '*****' AS user_name) FROM member_info WHERE hall_id = 1 AND domain_id = 1"
query("tag_custom_upload_masked", f"""
SELECT {NAMED}, 40032 AS tag_code, 4 AS tag_type, enable <> 0 AS tag_enabled
FROM masked JOIN (SELECT substr(user_name, 1, 3) || '*****' AS user_name, enable, make_date(CAST(split_part(d, '-', 1) AS INT),
   CAST(split_part(d, '-', 2) AS INT), CAST(split_part(d, '-', 3) AS INT)) AS day
  FROM (SELECT *, replace(data_date, '/', '-') AS d FROM upload) u
  QUALIFY ROW_NUMBER() OVER (PARTITION BY substr(user_name, 1, 3) ORDER BY day DESC, enable DESC) = 1) l USING (user_name)""",
      {"masked": MASKED})(
    lambda i: tags.custom_upload_tags(i["upload"], mask_columns(i["member_info"], {"user_name": MASKS["user_name"]}), 40032, TENANT, masked=True))
query("tag_custom_upload_dates", f"SELECT DISTINCT {USER}, 40032 AS tag_code, data_date, enable FROM uploaded",
      {"uploaded": UPLOADED})(lambda i: tags.custom_upload_dates(i["upload"], i["member_info"], 40032, TENANT))
query("tag_custom_upload_counts", """
SELECT COUNT(*) FILTER (enable = 1) AS add_count, COUNT(*) FILTER (enable = 0) AS remove_count FROM upload""")(
    lambda i: tags.custom_upload_counts(i["upload"]))


# -- the whole run -------------------------------------------------------------
def rule_inputs(i, hedge: bool = False) -> rules.RuleInputs:
    return rules.RuleInputs(
        members=i["member_info"], login=i["login_log"], login_raw=i["login_raw"], deposits=i["deposit_withdraw_record"],
        ga_page=i["ga_page"], edits=i["edits"], opcode_types=i["opcodes"],
        bets15=materialise(bets15(i)), deposits15=deposits15(i), bet_time15=bet_time15(i), cash15=cash15(i),
        arbitrage=i["arbitrage_info"] if hedge else None, stored_tags=i["ods"] if hedge else None)


def rule_settings() -> rules.RuleSettings:
    return rules.RuleSettings(
        as_of=AS_OF, today=TODAY, now=NOW, good_customer_deposit=GOOD_DEPOSIT, avg_deposit_bands=DEPOSIT_BANDS,
        max_bet_bands=BET_BANDS, turnover_drop_bands=DROP_BANDS)


RULE_QUERIES = [
    "tag_good_customer", "tag_repeat_deposit", "tag_huge_winner", "tag_huge_loser", "tag_frequent_loser", "tag_game_lover",
    "tag_win_lose_reaction", "tag_app_user", "tag_bet_period", "tag_arbitrage_suspect", "tag_login_ub", "tag_login_pc",
    "tag_continuous_deposit", "tag_avg_deposit_band", "tag_max_bet_band", "tag_turnover_drop_band", "tag_deposit_method",
    "tag_hesitate", "tag_certified", "tag_term",
]


def run_parts(hedge: bool = False) -> dict[str, str]:
    """All rule statements, each with its own parts, and the stored tags after them (``tags_after``)."""
    rule_sql = [with_inputs(churned_sql(30), "TIMESTAMP"), *[REGISTRY[q].sql for q in RULE_QUERIES]]
    if hedge:
        rule_sql.append(with_inputs(HEDGE_SQL, "TIMESTAMP", hedge_parts("ods")))
    reset = ", ".join(str(c) for c in tags.rule_codes() if c not in rules.NOT_RESET)
    return {
        "new_tags": " UNION ALL ".join(f"SELECT {', '.join(C.ODS_COLUMNS)} FROM ({sql}) q{n}" for n, sql in enumerate(rule_sql)),
        "edited": LATEST_EDITS.format(", ".join(map(str, tags.rule_codes()))),
        "after_rules": f"""SELECT {USER}, CASE WHEN n.tag_type IS NOT NULL THEN n.user_name ELSE o.user_name END AS user_name, tag_code,
        COALESCE(n.tag_type, o.tag_type) AS tag_type,
        COALESCE(n.tag_enabled, CASE WHEN tag_code IN ({reset}) THEN FALSE ELSE o.tag_enabled END) AS tag_enabled,
        COALESCE(n.register_date, o.register_date) AS register_date,
        CASE WHEN n.tag_type IS NOT NULL OR tag_code IN ({reset}) THEN TIMESTAMP '2024-01-31 06:00:00' ELSE o.updated_time END AS updated_time
 FROM ods o FULL OUTER JOIN new_tags n USING ({USER}, tag_code)""",
        "changed": f"""SELECT m.* REPLACE (CASE WHEN e.user_id IS NOT NULL THEN e.tag_enabled ELSE m.tag_enabled END AS tag_enabled)
             FROM after_rules m LEFT JOIN edited e USING ({USER}, tag_code)""",
        "tags_after": f"""SELECT {USER}, user_name, tag_code, tag_type, register_date, updated_time,
       CASE WHEN tag_code = 30015 AND tag_enabled AND ({USER}) IN (SELECT ({USER}) FROM changed WHERE tag_code IN ({BAD}) AND tag_enabled)
            THEN FALSE ELSE tag_enabled END AS tag_enabled FROM changed""",
    }


def tag_day(i) -> rules.TagDay:
    return rules.run_tag_day(
        i["ods"], i["dw"], i["tag_dim"], i["bet_analysis"], rule_inputs(i, hedge=True), rule_settings(), materialise)


query("run_tag_rules", "SELECT * FROM tags_after", run_parts())(
    lambda i: rules.run_tag_rules(i["ods"], rule_inputs(i), rule_settings()))
query("run_tag_day", "SELECT * FROM tags_after", run_parts(hedge=True))(lambda i: tag_day(i).ods)
