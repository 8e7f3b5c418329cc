"""Customer lifecycle."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators import lifecycle
from tagloom.plans.inputs import with_inputs
from tagloom.plans.registry import AS_OF, REGISTRY, USER, query
from tagloom.sources.sinks import materialise

START, END = date(2024, 1, 10), date(2024, 4, 15)

OPERATE = f"""SELECT {USER}, COALESCE(MAX(login), DATE '1990-01-01') AS last_login_date,
 COALESCE(MAX(act), DATE '1990-01-01') AS activated_date, CAST(SUM(dep) AS BIGINT) AS deposit_count, CAST(SUM(wag) AS BIGINT) AS wagers_total
 FROM (SELECT {USER}, data_date AS login, NULL AS act, 0 AS dep, 0 AS wag, data_date FROM login_log
       UNION ALL SELECT {USER}, NULL, data_date, deposit_count, 0, data_date FROM deposit_withdraw_record
                 WHERE deposit_count <> 0 OR deposit_amount <> 0
       UNION ALL SELECT {USER}, NULL, data_date, 0, wagers_total, data_date FROM bet_analysis) a
 WHERE data_date BETWEEN DATE '1990-01-01' AND DATE '{{0}}' GROUP BY {USER}"""


def facts_of(i):
    return i["login_log"], i["deposit_withdraw_record"], i["bet_analysis"]


query("user_operate", OPERATE.format("2024-01-30"))(
    lambda i: lifecycle.user_operate(*facts_of(i), date(1990, 1, 1), AS_OF))

REGISTERED = """SELECT 1 AS hall_id, 1 AS domain_id, user_id, username AS user_name, created_at + INTERVAL 12 HOUR AS register_date FROM users"""
query("lifecycle_members", """
SELECT hall_id, domain_id, user_id, user_name, CAST((register_date AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS register_day
FROM registered WHERE CAST((register_date AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE)
  BETWEEN DATE '2023-09-01' AND DATE '2023-12-15'""", {"registered": REGISTERED})(
    lambda i: lifecycle.lifecycle_members(i.sql(REGISTERED), date(2023, 9, 1), date(2023, 12, 15)))


def code_sql(on: str) -> str:
    """Later assignments override earlier ones: written from the last to the first."""
    return f"""CASE WHEN activated_date = DATE '1990-01-01' AND visited_date < {on} - 60 THEN 50108
 WHEN activated_date = DATE '1990-01-01' AND visited_date >= {on} - 60 THEN 50107
 WHEN activated_date < {on} - 60 AND (deposit_count > 0 OR wagers_total > 0) THEN 50106
 WHEN activated_date < {on} - 14 AND deposit_count >= 3 AND wagers_total > 0 THEN 50103
 WHEN activated_date < {on} - 14 AND deposit_count > 0 AND wagers_total > 0 THEN 50104
 WHEN activated_date < {on} - 14 THEN 50105
 WHEN deposit_count >= 3 AND wagers_total > 0 THEN 50102
 WHEN deposit_count > 0 AND wagers_total > 0 THEN 50101 ELSE 50100 END"""


# registration dates are calendar days already: a New York day of midnight UTC is the day before
REGISTER_DAY = "register_date - 1"
STATE = f"""SELECT {USER}, user_name, GREATEST({REGISTER_DAY}, COALESCE(last_login_date, DATE '1990-01-01')) AS visited_date,
 COALESCE(activated_date, DATE '1990-01-01') AS activated_date, COALESCE(deposit_count, 0) AS deposit_count,
 COALESCE(wagers_total, 0) AS wagers_total
 FROM member_info LEFT JOIN operate USING ({USER}) WHERE {REGISTER_DAY} <= DATE '{{0}}'"""


@query("lifecycle_tag", f"SELECT *, {code_sql('DATE ' + chr(39) + '2024-02-20' + chr(39))} AS tag_code FROM state",
       {"operate": OPERATE.format("2024-02-20"), "state": STATE.format("2024-02-20")})
def _(i):
    on = date(2024, 2, 20)
    members = lifecycle.lifecycle_members(i["member_info"], date(1990, 1, 1), on)
    return lifecycle.lifecycle_tag(members, lifecycle.user_operate(*facts_of(i), date(1990, 1, 1), on), on)


# the check replays every member and day; the job visits only days that can change a code
CHANGES = {
    "per_day": f"""SELECT {USER}, data_date, MAX(login) AS login, MAX(act) AS act, SUM(dep) AS dep, SUM(wag) AS wag
 FROM (SELECT {USER}, data_date AS login, NULL AS act, 0 AS dep, 0 AS wag, data_date FROM login_log
       UNION ALL SELECT {USER}, NULL, data_date, deposit_count, 0, data_date FROM deposit_withdraw_record
                 WHERE deposit_count <> 0 OR deposit_amount <> 0
       UNION ALL SELECT {USER}, NULL, data_date, 0, wagers_total, data_date FROM bet_analysis) a GROUP BY {USER}, data_date""",
    "entering": f"""SELECT {USER}, user_name, {REGISTER_DAY} AS reg, GREATEST({REGISTER_DAY}, DATE '2024-01-10') AS entry FROM member_info
 WHERE {REGISTER_DAY} <= DATE '2024-04-15'""",
    "early": f"""SELECT {USER}, MAX(login) AS login, MAX(act) AS act, SUM(dep) AS dep, SUM(wag) AS wag
 FROM per_day JOIN entering USING ({USER}) WHERE data_date < entry AND (data_date >= reg OR reg <= DATE '2024-01-10') GROUP BY {USER}""",
    "grid": f"""SELECT {USER}, user_name, reg, entry, CAST(unnest(generate_series(entry, DATE '2024-04-15', INTERVAL 1 DAY)) AS DATE) AS data_date
 FROM entering""",
    "running": f"""SELECT {USER}, user_name, data_date,
  GREATEST(reg, COALESCE(MAX(p.login) OVER w, DATE '1990-01-01'), COALESCE(e.login, DATE '1990-01-01')) AS visited_date,
  GREATEST(COALESCE(MAX(p.act) OVER w, DATE '1990-01-01'), COALESCE(e.act, DATE '1990-01-01')) AS activated_date,
  COALESCE(SUM(p.dep) OVER w, 0) + COALESCE(e.dep, 0) AS deposit_count, COALESCE(SUM(p.wag) OVER w, 0) + COALESCE(e.wag, 0) AS wagers_total
 FROM grid LEFT JOIN per_day p USING ({USER}, data_date) LEFT JOIN early e USING ({USER})
 WINDOW w AS (PARTITION BY {USER} ORDER BY data_date ROWS UNBOUNDED PRECEDING)""",
    "coded": f"SELECT *, {code_sql('data_date')} AS tag_code FROM running",
}


@query("lifecycle_changes", f"""
SELECT {USER}, user_name, data_date, tag_code FROM (
  SELECT *, LAG(tag_code) OVER (PARTITION BY {USER} ORDER BY data_date) AS known FROM coded) t
WHERE tag_code IS DISTINCT FROM known AND (visited_date >= DATE '2021-01-01' OR activated_date >= DATE '2021-01-01')""", CHANGES)
def _(i):
    return lifecycle.lifecycle_changes(*facts_of(i), i["member_info"], START, END)

CHANGE_SQL = REGISTRY["lifecycle_changes"].sql
STEPS = [date(2024, 1, 20), date(2024, 1, 21), date(2024, 1, 21), END]


@query("lifecycle_advance", f"SELECT * FROM ({CHANGE_SQL}) changes")
def _(i):
    """The same changes from a carried state; a day asked for twice is done once."""
    state, log = None, []
    for end in STEPS:
        changes, state = lifecycle.advance_lifecycle(*facts_of(i), i["member_info"], START, end, state, materialise)
        log += [] if changes is None else [changes]
    return reduce(DataFrame.unionByName, log)


def step_sql(before: str, now: str) -> str:
    return f"""CASE WHEN {before} IN (50103, 50104, 50105) AND {now} = 50106 THEN 7
 WHEN {before} IN (50100, 50101, 50102) AND {now} IN (50103, 50104, 50105) THEN 6
 WHEN {before} IN (50105, 50106) AND {now} IN (50100, 50101, 50102) THEN 5
 WHEN {before} IN (50103, 50104, 50105) AND {now} IN (50100, 50101, 50102) THEN 4
 WHEN {before} IN (50100, 50101) AND {now} = 50102 THEN 3
 WHEN {before} = 50100 AND {now} = 50101 THEN 2
 WHEN ({before} IS NULL OR {before} IN (50107, 50108)) AND {now} IN (50100, 50101, 50102) THEN 2
 WHEN {before} = 50102 AND {now} = 50102 THEN 1 ELSE 0 END"""


PAIRS = f"""SELECT {USER}, data_date, tag_code, LAG(tag_code) OVER (PARTITION BY {USER} ORDER BY data_date) AS before FROM activated_tag_day"""
query("lifecycle_step", f"SELECT *, {step_sql('before', 'tag_code')} AS step FROM pairs", {"pairs": PAIRS})(
    lambda i: i.sql(PAIRS).withColumn("step", lifecycle.lifecycle_step(F.col("before"), F.col("tag_code"))))

# history fill: each assignment reads the values left by the one before
FILLS = [
    ("t1 = 50102 AND this_date - d3 > 3", "t3 = 50102"),
    ("t1 = 50102 AND this_date - d2 > 2", "t2 = 50102"),
    ("t2 = 50102 AND this_date - d3 > 3", "t3 = 50102"),
    ("t1 = 50102 AND t2 IS NULL", "t2 = 50102"),
    ("t2 = 50102 AND t3 IS NULL", "t3 = 50102"),
    ("this_date = {day} - 1 AND t0 = 50102", "t3 = t2"),
    ("this_date = {day} - 1 AND t0 = 50102", "t2 = t1"),
    ("this_date = {day} - 1 AND t0 = 50102", "t1 = 50102"),
    ("this_date = {day} - 2 AND t0 = 50102", "t3 = t1"),
    ("this_date = {day} - 2 AND t0 = 50102", "t2 = t0"),
    ("this_date = {day} - 2 AND t0 = 50102", "t1 = 50102"),
    ("this_date <= {day} - 3 AND t0 = 50102", "t3 = t0"),
    ("this_date <= {day} - 3 AND t0 = 50102", "t2 = 50102"),
    ("this_date <= {day} - 3 AND t0 = 50102", "t1 = 50102"),
]


def day_parts(on: str) -> dict[str, str]:
    parts = {
        "runs": f"""SELECT * FROM (SELECT *, LEAD(tag_code) OVER (PARTITION BY {USER} ORDER BY data_date) AS following
 FROM activated_tag_day WHERE data_date <= {on}) r WHERE following IS DISTINCT FROM tag_code""",
        "placed": f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {USER} ORDER BY data_date DESC) AS place FROM runs",
        "f0": f"""SELECT {USER}, MAX(user_name) FILTER (place = 1) AS user_name, {', '.join(
            f"MAX(tag_code) FILTER (place = {k + 1}) AS t{k}, MAX(data_date) FILTER (place = {k + 1}) AS {'this_date' if k == 0 else f'd{k}'}"
            for k in range(4))} FROM placed WHERE place <= 4 GROUP BY {USER}""",
    }
    for n, (condition, assignment) in enumerate(FILLS):
        column, value = assignment.split(" = ")
        parts[f"f{n + 1}"] = f"SELECT * REPLACE (CASE WHEN {condition.format(day=on)} THEN {value} ELSE {column} END AS {column}) FROM f{n}"
    return parts


DAY = "DATE '2024-01-25'"


def day_sql(on: str) -> str:
    return f"""
SELECT {USER}, ag_name, s.user_name, {on} AS data_date, COALESCE(t0, 0) AS this_tag_code, COALESCE(t1, 0) AS last_tag_code,
       COALESCE(t2, 0) AS last_two_tag_code, COALESCE(t3, 0) AS last_three_tag_code, s0 AS this_day_step, s1 AS last_day_step,
       s2 AS last_two_day_step, this_date = {on} OR (s0 = 1 AND s1 <> 1) AS init_flag, fin_year, fin_month, fin_week
FROM (SELECT *, {step_sql('t1', 't0')} AS s0, {step_sql('t2', 't1')} AS s1, {step_sql('t3', 't2')} AS s2 FROM f{len(FILLS)}) s
JOIN member_info USING ({USER}) LEFT JOIN calendar ON date = {on} WHERE s0 <> 0"""


query("lifecycle_day", day_sql(DAY), day_parts(DAY))(
    lambda i: lifecycle.lifecycle_day(i["activated_tag_day"], i["member_info"], i["calendar"], date(2024, 1, 25)))
DAYS = [f"DATE '2024-01-{d}'" for d in range(19, 26)]
query("lifecycle_days", " UNION ALL ".join(
    f"SELECT * FROM ({with_inputs(day_sql(d), 'TIMESTAMP', day_parts(d))}) d{n}" for n, d in enumerate(DAYS)))(
    lambda i: lifecycle.lifecycle_days(
        i["activated_tag_day"], i["member_info"], i["calendar"], date(2024, 1, 19), date(2024, 1, 25)))

query("lifecycle_week_snapshot", f"""
SELECT {USER}, user_name, tag_code, fin_year, fin_month, fin_week FROM (
 SELECT a.*, w.*, ROW_NUMBER() OVER (PARTITION BY {USER}, fin_week_end, fin_year, fin_month, fin_week ORDER BY data_date DESC) AS place
 FROM activated_tag_day a JOIN (SELECT DISTINCT fin_year, fin_month, fin_week, fin_week_end FROM calendar) w
   ON a.data_date <= w.fin_week_end) t WHERE place = 1""")(
    lambda i: lifecycle.lifecycle_week_snapshot(i["activated_tag_day"], i["calendar"]))

# (step, codes before, codes now); a missing code before fits every rule
WEEK_RULES = [
    (1, "50102", "50102"), (2, "50107, 50108", "50100, 50101, 50102"), (3, "50100, 50101", "50102"),
    (4, "50103, 50104, 50105", "50101, 50102"), (5, "50105, 50106", "50101, 50102"),
    (6, "50100, 50101, 50102", "50103, 50104, 50105"), (7, "50103, 50104, 50105", "50106"),
]


def week_step(before: str, now: str, rules: list) -> str:
    return "CASE " + " ".join(
        f"WHEN ({before} IS NULL OR {before} IN ({b})) AND {now} IN ({n}) THEN {s}" for s, b, n in rules) + " ELSE 0 END"


CARRIED = "last_week_step, this_week_step, two_weeks_tag_code, one_weeks_tag_code, week_tag_code".split(", ")
FIN_WEEK = 4


def week_sql(rules: list) -> str:
    first = f"(SELECT MIN(date) FROM calendar WHERE fin_year = 2024 AND fin_month = 1 AND fin_week = {FIN_WEEK})"

    def of(table: str, back: int) -> str:
        return f"""SELECT * FROM {table} WHERE (fin_year, fin_month, fin_week) = (SELECT (fin_year, fin_month, fin_week) FROM calendar WHERE date = {first} - {back})
 QUALIFY ROW_NUMBER() OVER (PARTITION BY {USER} ORDER BY created_time) = 1"""

    zero = ", ".join([f"COALESCE({c}, 0) AS {c}" for c in CARRIED] + [f"COALESCE(p_{c}, 0) AS p_{c}" for c in CARRIED])
    return f"""SELECT {USER}, user_name, CASE WHEN opened THEN p_this_week_step ELSE last_week_step END AS last_week_step, this_week_step,
 CASE WHEN opened THEN p_one_weeks_tag_code ELSE two_weeks_tag_code END AS two_weeks_tag_code, one_weeks_tag_code, week_tag_code,
 2024 AS fin_year, 1 AS fin_month, {FIN_WEEK} AS fin_week
FROM (SELECT *, last_week_step = 0 AND this_week_step <> 0 AS opened FROM (
 SELECT {USER}, user_name, {', '.join(f'CASE WHEN this_week_step = 0 THEN p_{c} ELSE {c} END AS {c}' for c in CARRIED)},
        p_this_week_step, p_one_weeks_tag_code
 FROM (SELECT {USER}, user_name, {zero} FROM (
   SELECT {USER}, w0.user_name, w0.tag_code AS week_tag_code, w1.tag_code AS one_weeks_tag_code, w2.tag_code AS two_weeks_tag_code,
          {week_step('w2.tag_code', 'w1.tag_code', rules)} AS last_week_step, {week_step('w1.tag_code', 'w0.tag_code', rules)} AS this_week_step,
          {', '.join(f'p.{c} AS p_{c}' for c in CARRIED)}
   FROM ({of('activated_tag_ods_week', 0)}) w0 LEFT JOIN ({of('activated_tag_ods_week', 7)}) w1 USING ({USER})
   LEFT JOIN ({of('activated_tag_ods_week', 14)}) w2 USING ({USER}) LEFT JOIN ({of('activated_tag_dw_week', 7)}) p USING ({USER})) j) z
 WHERE p_last_week_step <> 0 OR p_this_week_step <> 0 OR last_week_step <> 0 OR this_week_step <> 0) y) x"""


for name, rules, first_match in [("lifecycle_week", WEEK_RULES[::-1], False), ("lifecycle_week_first_match", WEEK_RULES, True)]:
    query(name, week_sql(rules))(
        lambda i, first_match=first_match: lifecycle.lifecycle_week(
            i["activated_tag_ods_week"], i["activated_tag_dw_week"], i["calendar"], 2024, 1, FIN_WEEK, first_match))
