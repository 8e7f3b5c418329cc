"""Keyed writes and the tag warehouse."""

from datetime import datetime

from pyspark.sql import functions as F

from tagloom.operators import merge, warehouse
from tagloom.plans.registry import NOW, TENANT, USER, query
from tagloom.plans.tag_queries import run_parts, tag_day
from tagloom.sources import ledger
from tagloom.sources.sinks import materialise

ODS_KEY = ["hall_id", "domain_id", "user_id", "tag_code"]
MEMBER_KEY = ["hall_id", "domain_id", "user_id"]
MEMBER_COLUMNS = "hall_id, domain_id, user_id, user_name, ag_name, balance"

# -- keyed writes: members as stored, and a changed batch ----------------------
STORED = f"SELECT {MEMBER_COLUMNS} FROM member_info WHERE user_id % 3 <> 0"
CHANGED = "SELECT hall_id, domain_id, user_id, concat('new ', user_level) AS user_name, balance + 1 AS balance FROM member_info WHERE user_id % 4 <> 0"
TABLES = {"stored": STORED, "changed": CHANGED}


def stored(i):
    return i.sql(STORED)


def changed(i):
    return i.sql(CHANGED)


GIVEN = "c.user_id IS NOT NULL"
MERGED = f"""SELECT COALESCE(s.hall_id, c.hall_id) AS hall_id, COALESCE(s.domain_id, c.domain_id) AS domain_id,
 COALESCE(s.user_id, c.user_id) AS user_id, CASE WHEN {GIVEN} THEN c.user_name ELSE s.user_name END AS user_name, s.ag_name,
 CASE WHEN {GIVEN} THEN c.balance ELSE s.balance END AS balance FROM stored s {{0}} JOIN changed c ON s.user_id = c.user_id"""
query("upsert", MERGED.format("FULL"), TABLES)(lambda i: merge.upsert(stored(i), changed(i), MEMBER_KEY))
query("update_keys", MERGED.format("LEFT"), TABLES)(lambda i: merge.update(stored(i), changed(i), MEMBER_KEY))
query("replace_keys", f"""
SELECT hall_id, domain_id, user_id, user_name, NULL::VARCHAR AS ag_name, balance FROM changed
UNION ALL SELECT {MEMBER_COLUMNS} FROM stored WHERE user_id NOT IN (SELECT user_id FROM changed)""", TABLES)(
    lambda i: merge.replace(stored(i), changed(i), MEMBER_KEY))
query("insert_rows", f"""
SELECT {MEMBER_COLUMNS} FROM stored UNION ALL SELECT hall_id, domain_id, user_id, user_name, NULL, balance FROM changed""", TABLES)(
    lambda i: merge.insert(stored(i), changed(i)))
query("insert_ignore", f"""
SELECT {MEMBER_COLUMNS} FROM stored UNION ALL SELECT hall_id, domain_id, user_id, user_name, NULL, balance FROM changed
WHERE user_id NOT IN (SELECT user_id FROM stored)""", TABLES)(
    lambda i: merge.insert_ignore(stored(i), changed(i), MEMBER_KEY))
query("delete_keys", f"SELECT {MEMBER_COLUMNS} FROM stored WHERE user_id NOT IN (SELECT user_id FROM changed)", TABLES)(
    lambda i: merge.delete_keys(stored(i), changed(i), MEMBER_KEY))
query("delete_key_range", """
SELECT * FROM ods WHERE NOT ((hall_id, domain_id, user_id, tag_code) >= (1, 1, 20, 30015)
                         AND (hall_id, domain_id, user_id, tag_code) <= (1, 1, 90, 30019))""")(
    lambda i: merge.delete_key_range(i["ods"], ODS_KEY, [1, 1, 20, 30015], [1, 1, 90, 30019]))
query("update_where", """
SELECT * REPLACE (CASE WHEN tag_code = 30019 AND user_id < 75 THEN FALSE ELSE tag_enabled END AS tag_enabled) FROM ods""")(
    lambda i: merge.update_where(i["ods"], F.expr("tag_code = 30019 AND user_id < 75"), {"tag_enabled": F.lit(False)}))
query("delete_where", "SELECT * FROM ods WHERE user_name IS NULL OR NOT (tag_code = 40006 AND user_name LIKE '%5')")(
    lambda i: merge.delete_where(i["ods"], F.expr("tag_code = 40006 AND user_name LIKE '%5'")))

# -- warehouse -----------------------------------------------------------------
FRESH = """SELECT hall_id, domain_id, user_id, user_name, CAST(CASE WHEN user_id % 2 = 0 THEN 30019 ELSE 30022 END AS INT) AS tag_code,
 3 AS tag_type, TRUE AS tag_enabled, register_date FROM member_info WHERE user_id % 7 < 4"""
BATCH = f"""SELECT {USER}, CASE WHEN n.tag_type IS NOT NULL THEN n.user_name ELSE o.user_name END AS user_name, tag_code,
 COALESCE(n.tag_type, o.tag_type) AS tag_type,
 CASE WHEN n.tag_type IS NOT NULL THEN TRUE WHEN tag_code IN (30015, 30019) THEN FALSE ELSE o.tag_enabled END AS tag_enabled,
 COALESCE(n.register_date, o.register_date) AS register_date,
 CASE WHEN n.tag_type IS NOT NULL OR tag_code IN (30015, 30019) THEN TIMESTAMP '2024-01-31 06:00:00' ELSE o.updated_time END AS updated_time
 FROM ods o FULL OUTER JOIN fresh n USING ({USER}, tag_code)"""


@query("apply_tag_batch", BATCH, {"fresh": FRESH})
def _(i):
    return warehouse.apply_tag_batch(i["ods"], i.sql(FRESH), [30015, 30019], NOW)


ENVIRONMENTS = [("local", "local"), ("demo", "dev"), ("prod", "prod")]
LANGUAGES = [("", "tag_name"), ("_cn", "tag_name_cn"), ("_en", "tag_name_en")]
NAMES = ", ".join(
    f"CASE WHEN can_access_env LIKE '%{word}%' THEN {column} END AS {env}_tag_name_str{suffix}"
    for suffix, column in LANGUAGES for env, word in ENVIRONMENTS)
NAME_COLUMNS = [f"{env}_tag_name_str{suffix}" for suffix, _ in LANGUAGES for env, _ in ENVIRONMENTS]
TAG_NAMES = f"SELECT hall_id, domain_id, tag_code, {NAMES} FROM tag_dim WHERE tag_enabled"
query("tag_dim_names", TAG_NAMES)(lambda i: warehouse.tag_dim_names(i["tag_dim"]))

NY = "CAST({0} - INTERVAL 5 HOUR AS DATE)"  # New York in January
LISTS = ", ".join(f"STRING_AGG({c}, ',' ORDER BY tag_code) AS {c}" for c in NAME_COLUMNS)


def wide(ods: str = "ods", more: str = "", trigger: str = "") -> str:
    return f"""SELECT {USER}, m.user_name, ag_name, tag_str, {', '.join(NAME_COLUMNS)}, user_level_id, user_level, m.register_date{more}
FROM (SELECT {USER}, STRING_AGG(CAST(tag_code AS VARCHAR), ',' ORDER BY tag_code) AS tag_str, {LISTS}
      FROM {ods} LEFT JOIN names USING (hall_id, domain_id, tag_code)
      WHERE tag_enabled AND user_id IN (SELECT user_id FROM {ods} JOIN (SELECT hall_id, domain_id,
          MAX({NY.format('updated_time')}) - 1 AS last_update FROM {ods} GROUP BY hall_id, domain_id) l USING (hall_id, domain_id)
        WHERE tag_enabled {trigger} AND {NY.format('updated_time')} >= last_update) GROUP BY {USER}) t
JOIN member_info m USING ({USER})"""


query("ods_to_dw", wide(), {"names": TAG_NAMES})(
    lambda i: warehouse.ods_to_dw(i["ods"], i["member_info"], i["tag_dim"]))
query("ods_to_dw_one_tag", wide(more=", last_activated_date", trigger="AND tag_code = 10001")
      + f" LEFT JOIN (SELECT {USER}, MAX(data_date) AS last_activated_date FROM bet_analysis GROUP BY {USER}) b USING ({USER})",
      {"names": TAG_NAMES})(
    lambda i: warehouse.ods_to_dw(i["ods"], i["member_info"], i["tag_dim"], 10001, i["bet_analysis"]))

query("dw_stale_users", f"""
SELECT {USER} FROM ods WHERE user_id IN (SELECT user_id FROM dw) GROUP BY {USER} HAVING COUNT(*) FILTER (tag_enabled) = 0""")(
    lambda i: warehouse.dw_stale_users(i["ods"], i["dw"]))


def recent(table: str, column: str, wide: str = "dw") -> str:
    return f"""SELECT {USER}, MAX(data_date) AS day FROM {table} JOIN (SELECT hall_id, domain_id,
  COALESCE(MAX({column}) - 60, DATE '1990-01-01') AS earliest FROM {wide} GROUP BY hall_id, domain_id) f USING (hall_id, domain_id)
 WHERE data_date >= earliest GROUP BY {USER}"""


query("dw_last_dates", f"""
SELECT {USER}, b.day AS last_activated_date, l.day AS last_login_date
FROM ({recent('bet_analysis', 'last_activated_date')}) b FULL OUTER JOIN ({recent('login_log', 'last_login_date')}) l USING ({USER})
WHERE user_id IN (SELECT user_id FROM dw)""")(lambda i: warehouse.dw_last_dates(i["bet_analysis"], i["login_log"], i["dw"]))

FROM_WIDE = ", ".join(
    f"CASE WHEN w.tag_str IS NOT NULL THEN w.{c} ELSE k.{c} END AS {c}" for c in ("user_name", "ag_name", "user_level_id", "user_level", "tag_str"))


def refresh(ods: str = "ods") -> dict[str, str]:
    return {
        "names": TAG_NAMES, "wide": wide(ods),
        "kept": f"""SELECT * FROM dw WHERE user_id NOT IN (
 SELECT user_id FROM {ods} GROUP BY {USER} HAVING COUNT(*) FILTER (tag_enabled) = 0)""",
        "merged": f"SELECT {USER}, {FROM_WIDE}, last_activated_date, last_login_date FROM kept k FULL OUTER JOIN wide w USING ({USER})",
    }


REFRESHED = f"""
SELECT {USER}, user_name, ag_name, user_level_id, user_level, tag_str, COALESCE(b.day, last_activated_date) AS last_activated_date,
       COALESCE(l.day, last_login_date) AS last_login_date
FROM merged LEFT JOIN ({recent('bet_analysis', 'last_activated_date', 'merged')}) b USING ({USER})
LEFT JOIN ({recent('login_log', 'last_login_date', 'merged')}) l USING ({USER})"""
query("refresh_wide", REFRESHED, refresh())(
    lambda i: warehouse.refresh_wide(
        i["ods"], i["dw"], i["member_info"], i["tag_dim"], i["bet_analysis"], i["login_log"]))
query("run_tag_day_wide", REFRESHED, {**run_parts(hedge=True), **refresh("tags_after")})(lambda i: tag_day(i).dw)

DEFINITIONS = [
    {"tag_code": 30091, "tag_type": 3, "tag_name": "hesitating", "sort_index": 1, "can_access_env": "local,dev,prod"},
    {"tag_code": 30093, "tag_type": 3, "tag_name": "new member", "sort_index": 2, "can_access_env": "local,dev"},
    {"tag_code": 30096, "tag_type": 3, "tag_name": "long member", "sort_index": 3, "can_access_env": "prod"},
]
OLD_DIM = """SELECT hall_id, hall_name, domain_id, domain_name, 30093 AS tag_code, 2 AS tag_type, 'old name' AS tag_name,
 0 AS sort_index, 'local' AS can_access_env FROM tenants WHERE hall_id % 2 = 0
 UNION ALL SELECT hall_id, hall_name, domain_id, domain_name, 10001, 1, 'vip', 9, 'prod' FROM tenants"""
DEFINED = " UNION ALL ".join(
    "SELECT " + ", ".join(f"{v!r} AS {k}" for k, v in d.items()) for d in DEFINITIONS)
query("seed_tag_dim", """
SELECT hall_id, hall_name, domain_id, domain_name, tag_code, tag_type, tag_name, sort_index, can_access_env
FROM tenants CROSS JOIN defined UNION ALL SELECT * FROM old_dim WHERE tag_code = 10001""",
      {"old_dim": OLD_DIM, "defined": DEFINED})(
    lambda i: warehouse.seed_tag_dim(i.sql(OLD_DIM), i["tenants"], DEFINITIONS))

COUNTS = f"""SELECT hall_id, domain_id, {{0}}, tag_type, tag_code, COUNT(*) AS total_count
FROM (SELECT DISTINCT {USER}, {{1}} AS {{0}} FROM bet_analysis) b JOIN ods USING ({USER}) WHERE tag_enabled GROUP BY ALL"""
query("tag_daily_counts", COUNTS.format("data_date", "data_date"))(
    lambda i: warehouse.tag_daily_counts(i["bet_analysis"], i["ods"]))
query("tag_monthly_counts", COUNTS.format("data_month", "CAST(date_trunc('month', data_date) AS DATE)"))(
    lambda i: warehouse.tag_monthly_counts(i["bet_analysis"], i["ods"]))

query("export_rule_tags", f"""
SELECT {USER}, user_name, tag_code, tag_type, CAST(tag_enabled AS INT) AS tag_enabled, register_date FROM ods
WHERE hall_id = 1 AND domain_id = 1 AND (tag_type = 3 OR tag_code IN (40006, 40007))
  AND updated_time BETWEEN TIMESTAMP '2024-01-28 00:00:00' AND TIMESTAMP '2024-01-30 23:59:59'""")(
    lambda i: warehouse.export_rule_tags(i["ods"], TENANT, datetime(2024, 1, 28), datetime(2024, 1, 30, 23, 59, 59)))
query("snapshot_table", """
SELECT hall_id, NULLIF(domain_id, 0) AS domain_id, name, created_time - INTERVAL 8 HOUR AS created_time FROM config_rows""")(
    lambda i: warehouse.snapshot_table(i["config_rows"], ["created_time"]))

# -- shards: wager days of which some were done when a part of their rows had not come yet --------
EARLY = "CASE WHEN day(data_date) % 4 = 1 THEN event_id % 5 <> 0 ELSE day(data_date) % 7 <> 3 END"
WAGER_DAYS = f"""SELECT {USER}, data_date, CAST(COUNT(*) AS BIGINT) AS wagers_total, CAST(SUM(valid_bet) AS BIGINT) AS commissionable
 FROM {{0}} GROUP BY {USER}, data_date"""
SHARDS = {
    "early": f"SELECT * FROM wager WHERE {EARLY}",
    "ledger": f"""SELECT data_date AS shard, COUNT(*) AS row_count, 'done' AS state, CAST(DATE '2024-01-30' AS {{NTZ}}) AS done_at
 FROM early GROUP BY data_date""",
    "stored_days": WAGER_DAYS.format("early"),
}
STATES = """SELECT shard, n.row_count, l.row_count AS done_count, CASE WHEN l.row_count IS NULL THEN 'new' WHEN n.row_count IS NULL THEN 'gone'
 WHEN n.row_count <> l.row_count THEN 'late' ELSE 'done' END AS state
 FROM (SELECT data_date AS shard, COUNT(*) AS row_count FROM wager GROUP BY data_date) n FULL OUTER JOIN ledger l USING (shard)"""


def wager_days(rows):
    return rows.groupBy("hall_id", "domain_id", "user_id", "data_date").agg(
        F.count(F.lit(1)).alias("wagers_total"), F.sum("valid_bet").alias("commissionable"))


def shard_run(i):
    early = i.sql(f"SELECT * FROM wager WHERE {EARLY}")
    ledger_then = early.groupBy(F.col("data_date").alias("shard")).agg(F.count(F.lit(1)).alias("row_count")).withColumns(
        {"state": F.lit("done"), "done_at": F.lit("2024-01-30").cast("timestamp_ntz")})
    return ledger.run_shards(i["wager"], "data_date", ledger_then, wager_days(early), wager_days, NOW, materialise)


query("shard_rows", WAGER_DAYS.format("wager"), SHARDS)(lambda i: shard_run(i).rows)
query("shard_ledger", f"""
SELECT shard, COALESCE(row_count, done_count) AS row_count, 'done' AS state,
 CASE WHEN state = 'done' THEN TIMESTAMP '2024-01-30 00:00:00' ELSE TIMESTAMP '2024-01-31 06:00:00' END AS done_at FROM ({STATES}) s""", SHARDS)(
    lambda i: shard_run(i).ledger)
