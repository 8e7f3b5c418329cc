"""Audience matching, campaign groups and masked copies."""

from datetime import date

from pyspark.sql import functions as F

from tagloom.functions.codes import KEYS
from tagloom.operators import audience, masking, sync
from tagloom.operators.keyed import equal_parts
from tagloom.plans.inputs import MEMBER_TENANT
from tagloom.plans.registry import NOW, TENANT, TODAY, USER, query
from tagloom.sources.sinks import materialise

FIRST = "hall_id = 1 AND domain_id = 1"
OPEN = "tag_enabled AND (sync_date_type = 2 OR (sync_date_type = 1 AND DATE '2024-01-31' BETWEEN sync_date_begin AND sync_date_end))"
query("active_batches", f"SELECT * FROM batches WHERE {OPEN}")(lambda i: audience.active_batches(i["batches"], NOW))
query("active_batches_edited", f"SELECT * FROM batches WHERE {OPEN} AND operator_time >= TIMESTAMP '2024-01-30 06:00:00'")(
    lambda i: audience.active_batches(i["batches"], NOW, edited_within=86400))

BATCH = {
    "batch_id": 1, "tag_id": 11, "tag_name": "spring", "ag_name": None, "user_level_id": "1;2;3;5;7;11;13;17;19",
    "user_level_exclude": "7,13", "activated_date_begin": date(2024, 1, 5), "activated_date_end": date(2024, 1, 28),
    "tag_str": "30011,30021;30012;40003", "tag_str_exclude": "30020,30014;40001",
}
BATCHES = [
    BATCH,
    {"batch_id": 2, "ag_name": "NATION_3"},
    {"batch_id": 3, "tag_str": "30010"},
    {"batch_id": 4, "user_level_exclude": "1,2,3", "activated_date_begin": date(2024, 1, 10), "activated_date_end": date(2024, 1, 20)},
    {"batch_id": 5, "tag_str_exclude": "30010;30011"},
]
CONDITIONS = [
    """user_level_id IN (1, 2, 3, 5, 7, 11, 13, 17, 19) AND user_level_id <> 7 AND user_level_id <> 13
 AND last_activated_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-28'
 AND ((tag_str LIKE '%30011%' AND tag_str LIKE '%30021%') OR tag_str LIKE '%30012%' OR tag_str LIKE '%40003%')
 AND tag_str NOT LIKE '%30020%' AND tag_str NOT LIKE '%30014%' AND tag_str NOT LIKE '%40001%'""",
    "ag_name = 'NATION_3'",
    "tag_str LIKE '%30010%'",
    "user_level_id NOT IN (1, 2, 3) AND last_activated_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
    "tag_str NOT LIKE '%30010%' AND tag_str NOT LIKE '%30011%'",
]
MATCHED = f"SELECT {USER} FROM dw WHERE {CONDITIONS[0]}"
ALL_USERS = f"SELECT {USER} FROM dw"
query("match_users", MATCHED)(lambda i: audience.match_users(i["dw"], BATCH))
query("batch_match_counts", " UNION ALL ".join(
    f"SELECT {n + 1} AS batch_id, COUNT(*) AS match_user_count FROM dw WHERE {c}" for n, c in enumerate(CONDITIONS)))(
    lambda i: audience.batch_match_counts(i["dw"], BATCHES))

query("match_uploaded_names", f"SELECT {USER} FROM member_info WHERE {FIRST} AND user_name IN (SELECT user_name FROM upload)")(
    lambda i: audience.match_uploaded_names(i["upload"], i["member_info"], TENANT))
query("match_by_step", f"""{ALL_USERS} WHERE user_id IN (SELECT user_id FROM dw_day WHERE this_day_step = 3 AND data_date = DATE '2024-01-29')""")(
    lambda i: audience.match_by_step(i["dw"], i["dw_day"], 3, date(2024, 1, 29)))
query("match_by_activity", f"""{ALL_USERS} WHERE user_id IN (SELECT user_id FROM user_active
 WHERE data_date BETWEEN DATE '2024-01-23' AND DATE '2024-01-29' GROUP BY user_id
 HAVING AVG(action_score) BETWEEN 0.34 AND 0.51 OR AVG(action_score) BETWEEN 0.85 AND 1)""")(
    lambda i: audience.match_by_activity(i["dw"], i["user_active"], [2, 5], TODAY))
query("match_by_prediction", f"""{ALL_USERS} WHERE user_id IN (SELECT user_id FROM recommend_meta
 WHERE recommend_code = 50001 AND data_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-28' GROUP BY user_id
 HAVING AVG(action_score) * 100 BETWEEN 45 AND 55)""")(
    lambda i: audience.match_by_prediction(i["dw"], i["recommend_meta"], 45, 55, date(2024, 1, 5), date(2024, 1, 28)))
query("match_top_spenders", f"""{ALL_USERS} WHERE user_id IN (SELECT user_id FROM bet_analysis
 WHERE data_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-28' GROUP BY {USER} QUALIFY ROW_NUMBER() OVER (PARTITION BY hall_id, domain_id ORDER BY SUM(bet_amount) DESC, user_id) <= 15)""")(
    lambda i: audience.match_top_spenders(i["dw"], i["bet_analysis"], 15, date(2024, 1, 5), date(2024, 1, 28)))

DIFF = f"""SELECT {USER}, CASE WHEN m.user_id IS NOT NULL AND t.user_id IS NOT NULL THEN 'repeat'
 WHEN t.user_id IS NOT NULL THEN 'delete' ELSE 'new' END AS change
 FROM (SELECT * FROM ({MATCHED}) x) m FULL OUTER JOIN tagged t USING ({USER})"""
query("audience_diff", DIFF)(lambda i: audience.audience_diff(audience.match_users(i["dw"], BATCH), i["tagged"]))

GROUPS = "SELECT group_id, COUNT(*) AS group_count FROM sync_group WHERE batch_id = 1 GROUP BY group_id"
query("ab_split", f"""
SELECT {USER}, CASE WHEN ROW_NUMBER() OVER (ORDER BY md5(concat(CAST(user_id AS VARCHAR), ':7')), user_id) <= CEIL(COUNT(*) OVER () / 5)
 THEN 2 ELSE 1 END AS group_id FROM tagged""")(
    lambda i: audience.ab_split(i["tagged"], i.sql(GROUPS), seed=7))

query("equal_parts", f"""
SELECT {USER}, CAST((place * 3 - 1) // n AS INT) AS part FROM (
 SELECT {USER}, ROW_NUMBER() OVER (ORDER BY md5(concat(CAST(user_id AS VARCHAR), ':0')), user_id) AS place, COUNT(*) OVER () AS n FROM tagged) t""")(
    lambda i: equal_parts(i["tagged"], KEYS, "user_id", 3))

NEW_GROUP = f"SELECT {USER}, CASE WHEN user_id % 5 = 0 THEN 2 ELSE 1 END AS group_id FROM tagged WHERE user_id % 2 = 0"
SYNC = {
    "matched": f"SELECT {USER} FROM tagged WHERE user_id % 4 <> 3",
    "new_group": NEW_GROUP,
    "kept": """SELECT * FROM sync_group g WHERE NOT (batch_id = 1 AND tag_id = 11 AND user_id NOT IN (SELECT user_id FROM matched))""",
}
GROUP_KEY = "hall_id, domain_id, batch_id, tag_id, user_id"


def sync_sql(table: str) -> str:
    return f"""SELECT {GROUP_KEY}, COALESCE(n.tag_name, g.tag_name) AS tag_name, COALESCE(n.group_id, g.group_id) AS group_id,
 CASE WHEN n.user_id IS NOT NULL THEN TRUE WHEN batch_id = 1 AND tag_id = 11 THEN FALSE ELSE g.latest_tag END AS latest_tag
FROM {table} g FULL OUTER JOIN (SELECT {USER}, 1 AS batch_id, 11 AS tag_id, 'spring' AS tag_name, group_id FROM new_group) n USING ({GROUP_KEY})"""


for mode, table in [(1, "sync_group"), (2, "kept")]:
    query("sync_group_state" if mode == 2 else "sync_group_append", sync_sql(table), SYNC)(
        lambda i, mode=mode: audience.sync_group_state(i["sync_group"], i.sql(NEW_GROUP), i.sql(SYNC["matched"]), BATCH, mode))

# -- all batches in one plan --------------------------------------------------------
TENANT_OF = "hall_id, domain_id"
BATCH_KEY = "hall_id, domain_id, batch_id"
OF_BATCH = f"{BATCH_KEY}, user_id"
RANGE = "data_date BETWEEN activated_date_begin AND activated_date_end"
SYNC_RUN = {
    "open_batches": f"SELECT * FROM sync_batches WHERE {OPEN}",
    "fitting": f"""SELECT b.*, d.user_id FROM open_batches b JOIN dw d USING ({TENANT_OF}) WHERE file_name = ''
 AND (b.ag_name IS NULL OR d.ag_name = b.ag_name)
 AND (b.user_level_id IS NULL OR list_contains(string_split(b.user_level_id, ';'), CAST(d.user_level_id AS VARCHAR)))
 AND (b.user_level_exclude IS NULL OR NOT list_contains(string_split(b.user_level_exclude, ','), CAST(d.user_level_id AS VARCHAR)))
 AND (activated_date_begin IS NULL OR last_activated_date BETWEEN activated_date_begin AND activated_date_end)
 AND (b.tag_str IS NULL OR len(list_filter(string_split(b.tag_str, ';'),
      lambda g: len(list_filter(string_split(g, ','), lambda c: NOT contains(d.tag_str, c))) = 0)) > 0)
 AND (b.tag_str_exclude IS NULL OR len(list_filter(string_split(replace(b.tag_str_exclude, ';', ','), ','), lambda c: contains(d.tag_str, c))) = 0)""",
    "stepped": f"""SELECT * FROM fitting f WHERE user_step IS NULL OR EXISTS (SELECT 1 FROM dw_day s WHERE s.hall_id = f.hall_id
 AND s.domain_id = f.domain_id AND s.user_id = f.user_id AND s.this_day_step = f.user_step AND s.data_date = DATE '2024-01-29')""",
    "scores": f"""SELECT {USER}, AVG(action_score) AS score FROM user_active
 WHERE data_date BETWEEN DATE '2024-01-23' AND DATE '2024-01-29' GROUP BY {USER}""",
    "lively": f"""SELECT s.* FROM stepped s LEFT JOIN scores USING ({USER}) WHERE user_activity IS NULL OR score BETWEEN 0.34 AND 0.51
 OR score BETWEEN 0.51 AND 0.68 OR score BETWEEN 0.85 AND 1""",
    "likely": f"""SELECT {OF_BATCH} FROM lively JOIN recommend_meta USING ({USER})
 WHERE deposit_predict_rate IS NOT NULL AND recommend_code = 50001 AND {RANGE} GROUP BY {OF_BATCH} HAVING AVG(action_score) * 100 BETWEEN 40 AND 60""",
    "top_bets": f"""SELECT {OF_BATCH} FROM (SELECT {OF_BATCH}, bet_amount_rank, ROW_NUMBER() OVER (PARTITION BY {BATCH_KEY}
   ORDER BY SUM(bet_amount) DESC, user_id) AS place FROM open_batches JOIN bet_analysis USING ({TENANT_OF}) WHERE {RANGE}
   GROUP BY {OF_BATCH}, bet_amount_rank) t
 WHERE place <= bet_amount_rank""",
    "matched": f"""SELECT {OF_BATCH} FROM lively WHERE (deposit_predict_rate IS NULL OR ({OF_BATCH}) IN (SELECT ({OF_BATCH}) FROM likely))
  AND (bet_amount_rank IS NULL OR ({OF_BATCH}) IN (SELECT ({OF_BATCH}) FROM top_bets))
 UNION SELECT {OF_BATCH} FROM open_batches JOIN sync_uploads USING (file_name) JOIN (SELECT {USER}, user_name FROM member_info) m
 USING ({TENANT_OF}, user_name)""",
    "numbered": f"""SELECT * REPLACE (
   COALESCE(tag_id, CAST((SELECT MAX(tag_id) FROM (SELECT tag_id FROM sync_tagged UNION SELECT tag_id FROM sync_batches) t)
    + COUNT(*) FILTER (tag_id IS NULL) OVER so_far AS INT)) AS tag_id,
   COALESCE(activity_id, CASE WHEN activity THEN CAST((SELECT MAX(activity_id) FROM campaigns)
    + COUNT(*) FILTER (activity AND activity_id IS NULL) OVER so_far AS INT) END) AS activity_id), activity AND activity_id IS NULL AS new_campaign
 FROM open_batches JOIN (SELECT {BATCH_KEY}, COUNT(*) AS matched FROM matched GROUP BY ALL) c USING ({BATCH_KEY})
 WINDOW so_far AS (ORDER BY {BATCH_KEY})""",
    "known": f"""SELECT {OF_BATCH} FROM numbered JOIN sync_group g USING ({BATCH_KEY}) WHERE ab_test
 UNION SELECT {OF_BATCH} FROM numbered JOIN sync_tagged t USING ({TENANT_OF}, tag_id) WHERE NOT ab_test""",
    "fresh": f"SELECT * FROM matched WHERE ({OF_BATCH}) NOT IN (SELECT ({OF_BATCH}) FROM known)",
    "leads": f"""SELECT {BATCH_KEY}, (COUNT(*) FILTER (group_id = 1) - COUNT(*) FILTER (group_id = 2)) * 100.0 / COUNT(*) AS lead
 FROM sync_group GROUP BY ALL""",
    "added": f"""SELECT {OF_BATCH}, tag_id, tag_name, CASE WHEN NOT ab_test THEN 0 WHEN n >= 5 OR lead IS NULL THEN
   CASE WHEN place <= CEIL(n * 20 / 100.0) THEN 2 ELSE 1 END WHEN lead >= 60 THEN 2 ELSE 1 END AS group_id
 FROM (SELECT *, COUNT(*) OVER (PARTITION BY {BATCH_KEY}) AS n,
        ROW_NUMBER() OVER (PARTITION BY {BATCH_KEY} ORDER BY md5(concat(CAST(user_id AS VARCHAR), ':3')), user_id) AS place FROM fresh) p
 JOIN numbered USING ({BATCH_KEY}) LEFT JOIN leads USING ({BATCH_KEY})""",
    "gone": f"""SELECT DISTINCT {OF_BATCH}, n.tag_id, ab_test, activity, activity_id FROM numbered n JOIN
 (SELECT {OF_BATCH} FROM sync_group) g USING ({BATCH_KEY}) WHERE mode = 2 AND ({OF_BATCH}) NOT IN (SELECT ({OF_BATCH}) FROM matched)""",
    "groups_after": f"""SELECT {GROUP_KEY}, COALESCE(a.tag_name, g.tag_name) AS tag_name, COALESCE(a.group_id, g.group_id) AS group_id,
  a.user_id IS NOT NULL OR (latest_tag AND ({BATCH_KEY}, tag_id) NOT IN (SELECT ({BATCH_KEY}, tag_id) FROM numbered)) AS latest_tag
 FROM (SELECT * FROM sync_group WHERE ({GROUP_KEY}) NOT IN (SELECT ({GROUP_KEY}) FROM gone)) g FULL OUTER JOIN added a USING ({GROUP_KEY})""",
    "untagged": f"""SELECT {TENANT_OF}, tag_id, user_id FROM gone WHERE ab_test
 UNION SELECT {TENANT_OF}, tag_id, user_id FROM numbered JOIN sync_tagged USING ({TENANT_OF}, tag_id)
 WHERE mode = 2 AND NOT ab_test AND ({OF_BATCH}) NOT IN (SELECT ({OF_BATCH}) FROM matched)""",
    "tagged_after": f"""SELECT {TENANT_OF}, tag_id, user_id FROM sync_tagged EXCEPT SELECT * FROM untagged
 UNION SELECT {TENANT_OF}, tag_id, user_id FROM added WHERE group_id <> 2""",
    "sizes_after": f"SELECT {TENANT_OF}, tag_id, COUNT(*) AS actual FROM tagged_after GROUP BY ALL",
    "campaign_of": f"""SELECT activity_id, hall_id, domain_id, user_name FROM (SELECT {USER}, batch_id FROM added WHERE group_id <> 2) a
 JOIN (SELECT {BATCH_KEY}, activity_id FROM numbered WHERE activity) n USING ({BATCH_KEY}) JOIN (SELECT {USER}, user_name FROM member_info) m
 USING ({USER}) WHERE user_name IS NOT NULL""",
    "campaign_gone": f"""SELECT activity_id, hall_id, domain_id, user_name FROM (SELECT {USER}, activity_id FROM gone WHERE activity) g
 JOIN (SELECT {USER}, user_name FROM member_info) m USING ({USER}) WHERE user_name IS NOT NULL""",
}


def sync_tables(i) -> sync.SyncTables:
    return sync.SyncTables(
        dw=i["dw"], members=i["member_info"], uploads=i["sync_uploads"], steps=i["dw_day"], activity=i["user_active"],
        predictions=i["recommend_meta"], bets=i["bet_analysis"], groups=i["sync_group"], tagged=i["sync_tagged"],
        campaigns=i["campaigns"], campaign_members=i["activity_member"])


def synced(i) -> sync.Synced:
    return sync.sync_batches(i["sync_batches"], sync_tables(i), NOW, TODAY, materialise, seed=3)


query("match_batches", "SELECT * FROM matched", SYNC_RUN)(
    lambda i: sync.match_batches(audience.active_batches(i["sync_batches"], NOW), sync_tables(i), TODAY, materialise))
query("tag_sync", "SELECT * FROM groups_after", SYNC_RUN)(lambda i: synced(i).groups)
query("tag_sync_batches", f"""
SELECT b.* REPLACE (COALESCE(n.tag_id, b.tag_id) AS tag_id, COALESCE(n.matched, b.match_user_count) AS match_user_count,
  CASE WHEN n.batch_id IS NULL THEN b.actual_user_count ELSE COALESCE(actual, 0) END AS actual_user_count,
  CASE WHEN n.batch_id IS NULL THEN b.activity_id ELSE COALESCE(n.activity_id, 0) END AS activity_id,
  CASE WHEN n.batch_id IS NULL THEN b.updated_time ELSE TIMESTAMP '2024-01-31 06:00:00' END AS updated_time)
FROM sync_batches b LEFT JOIN numbered n ON b.hall_id = n.hall_id AND b.domain_id = n.domain_id AND b.batch_id = n.batch_id
LEFT JOIN sizes_after s ON n.hall_id = s.hall_id AND n.domain_id = s.domain_id AND n.tag_id = s.tag_id""", SYNC_RUN)(
    lambda i: synced(i).batches)
query("tag_sync_tagged", "SELECT * FROM tagged_after", SYNC_RUN)(lambda i: synced(i).tagged)
query("tag_sync_campaigns", f"""
SELECT {TENANT_OF}, activity_id, COALESCE(n.activity_name, c.activity_name) AS activity_name,
 CASE WHEN new_campaign THEN CAST(2 AS INT) ELSE status END AS status
FROM campaigns c FULL OUTER JOIN (SELECT DISTINCT {TENANT_OF}, activity_id, activity_name, new_campaign FROM numbered WHERE activity) n
USING ({TENANT_OF}, activity_id)""", SYNC_RUN)(lambda i: synced(i).campaigns)
query("tag_sync_campaign_members", """
SELECT * FROM activity_member EXCEPT SELECT * FROM campaign_gone UNION SELECT * FROM campaign_of""", SYNC_RUN)(
    lambda i: synced(i).campaign_members)

EDITED = {name: SYNC_RUN[name] for name in ("fitting", "stepped", "scores", "lively")}
EDITED = {"open_batches": f"SELECT * FROM sync_batches WHERE {OPEN} AND operator_time >= TIMESTAMP '2024-01-30 06:00:00'", **EDITED, "counted": f"""
SELECT {BATCH_KEY}, COUNT(*) AS n FROM (SELECT {OF_BATCH} FROM lively UNION SELECT {OF_BATCH} FROM open_batches JOIN sync_uploads USING (file_name)
 JOIN (SELECT {USER}, user_name FROM member_info) m USING ({TENANT_OF}, user_name)) t GROUP BY ALL"""}
query("sync_match_counts", f"""
SELECT b.* REPLACE (CASE WHEN o.batch_id IS NULL THEN b.match_user_count ELSE COALESCE(n, 0) END AS match_user_count,
  CASE WHEN o.batch_id IS NULL THEN b.updated_time ELSE TIMESTAMP '2024-01-31 06:00:00' END AS updated_time)
FROM sync_batches b LEFT JOIN (SELECT {BATCH_KEY}, n FROM open_batches LEFT JOIN counted USING ({BATCH_KEY})) o
ON b.hall_id = o.hall_id AND b.domain_id = o.domain_id AND b.batch_id = o.batch_id""", EDITED)(
    lambda i: sync.update_match_counts(i["sync_batches"], sync_tables(i), NOW, TODAY, materialise))

query("campaign_header", """
SELECT * FROM campaigns UNION ALL SELECT 1, 1, MAX(activity_id) + 1, 'spring campaign', 2 FROM campaigns""")(
    lambda i: audience.campaign_header(
        i["campaigns"], {"hall_id": 1, "domain_id": 1, "activity_name": "spring campaign", "status": 2}))
query("campaign_members", """
SELECT * FROM activity_member WHERE user_name NOT IN (SELECT user_name FROM member_info WHERE user_id % 5 = 0 AND user_name IS NOT NULL)
   OR user_name IN (SELECT user_name FROM member_info JOIN tagged USING (user_id) WHERE user_name IS NOT NULL)
UNION SELECT 7, hall_id, domain_id, user_name FROM member_info WHERE user_name IS NOT NULL AND user_id IN (SELECT user_id FROM tagged)""")(
    lambda i: audience.campaign_members(
        i["activity_member"], 7, i["tagged"], i.sql(f"SELECT {USER} FROM member_info WHERE user_id % 5 = 0"),
        i["member_info"].filter("user_name IS NOT NULL")))
query("tagged_user_counts", "SELECT hall_id, domain_id, tag_id, COUNT(*) AS user_count FROM sync_group GROUP BY ALL")(
    lambda i: audience.tagged_user_counts(i["sync_group"]))

# profile JSON is built from the user rows; the check reads the same columns directly
PLAYER = """to_json(named_struct('id', user_id, 'username', username, 'upper', IF(user_id % 3 = 0, NULL, named_struct('id', user_id + 1, 'username', 'up')),
 'enable', user_id % 2 = 0, 'last_login', date_format(last_login, "yyyy-MM-dd'T'HH:mm:ss+0800"), 'last_ip', last_ip,
 'created_at', date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss+0800"), 'alias', concat('a😀b', user_id),
 'gender', CAST(user_id % 3 AS INT), 'parent', IF(parent_username IS NULL, NULL, named_struct('username', parent_username)),
 'blacklist', IF(user_id % 4 = 0, array(1, 2, 3), NULL),
 'cash', IF(user_id % 5 = 0, NULL, named_struct('balance', CAST(balance AS DOUBLE), 'currency', 'TWD')),
 'level', IF(level_name IS NULL, NULL, named_struct('name', level_name))))"""
query("parse_player_list", """
SELECT user_id AS id, CAST(0 AS BIGINT) AS parent_id, COALESCE(username, '') AS username,
 CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id + 1 END AS upper_id, user_id % 2 = 0 AS enable, NULL::BOOLEAN AS bankrupt, NULL::BOOLEAN AS locked,
 NULL::BOOLEAN AS tied, NULL::VARCHAR AS blacklist_modified_at, strftime(last_login - INTERVAL 12 HOUR, '%Y-%m-%d %H:%M:%S') AS last_login,
 NULL::VARCHAR AS last_online, strftime(created_at - INTERVAL 12 HOUR, '%Y-%m-%d %H:%M:%S') AS created_at, last_ip, '' AS last_country,
 CAST(0 AS BIGINT) AS last_city_id, '' AS created_ip, '' AS created_country, '' AS created_city, CAST(0 AS BIGINT) AS created_by,
 CAST(0 AS BIGINT) AS user_id, concat('ab', user_id) AS alias, '' AS birthday, CAST(user_id % 3 AS INT) AS gender, CAST(0 AS BIGINT) AS image,
 '' AS custom_image, NULL::BOOLEAN AS custom, 0 AS content_rating, '' AS promotion_code, CAST(0 AS BIGINT) AS vip_level_id,
 NULL::VARCHAR AS ingroup_transfer_domain, NULL::VARCHAR AS ingroup_transfer_user, COALESCE(parent_username, '') AS parent_username,
 CASE WHEN user_id % 3 <> 0 THEN 'up' END AS upper_username, CASE WHEN user_id % 4 = 0 THEN '1,2,3' ELSE '' END AS blacklist,
 CASE WHEN user_id % 5 = 0 THEN 0.0 ELSE CAST(balance AS DOUBLE) END AS balance, CASE WHEN user_id % 5 = 0 THEN '' ELSE 'TWD' END AS currency,
 COALESCE(level_name, '') AS level_name FROM users""")(
    lambda i: audience.parse_player_list(i["users"].select(F.expr(PLAYER).alias("json"))))


# -- masked copies ----------------------------------------------------------------
def masked(column: str, keep: int, suffix: str = "*****") -> str:
    return f"substr({column}, 1, {keep}) || '{suffix}' AS {column}"


MASKED_USER = f"""user_id, {masked('user_name', 3)}, {masked('ag_name', 3)}, {masked('name_real', 1)}, {masked('user_phone', 5)},
 {masked('user_mail', 3, '****@*****')}, {masked('last_ip', 3, '.***.***.***')}"""
PERSON = """SELECT user_id, username AS user_name, parent_username AS ag_name, name AS name_real, phone AS user_phone, email AS user_mail, last_ip
 FROM users"""
query("mask_columns", f"SELECT {MASKED_USER} FROM person", {"person": PERSON})(lambda i: masking.mask_columns(i.sql(PERSON)))


def scaled(column: str) -> str:
    return f"CAST(CAST(COALESCE({column}, 0) AS DECIMAL(22, 2)) * 0.01 AS DECIMAL(24, 4)) AS {column}"


AMOUNTS = "SELECT user_id, data_date, commissionable, payoff, CASE WHEN lobby = 1 THEN NULL ELSE bet_amount END AS bet_amount FROM bet_analysis"
query("scale_amounts", f"SELECT user_id, data_date, {scaled('commissionable')}, {scaled('payoff')}, {scaled('bet_amount')} FROM amounts",
      {"amounts": AMOUNTS})(lambda i: masking.scale_amounts(i.sql(AMOUNTS)))

MESSAGE = """CASE WHEN n IS NULL THEN masked ELSE replace(masked, shown, concat(CAST(n // 100 AS VARCHAR), '.',
 CASE WHEN n % 10 = 0 THEN CAST(n % 100 // 10 AS VARCHAR) ELSE lpad(CAST(n % 100 AS VARCHAR), 2, '0') END)) END"""
MESSAGES = f"""SELECT hall_id, domain_id, message_id, kind, updated_time, {MESSAGE} AS content FROM (
 SELECT *, TRY_CAST(replace(shown, ',', '') AS BIGINT) AS n FROM (
  SELECT *, regexp_extract(masked, '℗([0-9|,]+)', 1) AS shown FROM (
   SELECT *, regexp_replace(content, '(會員 #)(.{{3}})(.*)(@.*#)(.*)(¥)([0-9|,]+)(.*)', '\\1\\2*****\\4\\5℗\\7\\8') AS masked
   FROM messages) a) b) c"""
query("mask_message_text", MESSAGES)(lambda i: masking.mask_message_text(i["messages"]))

NY_DAY = "CAST(({0} AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE)"
COPY_START, COPY_END = date(2024, 1, 5), date(2024, 1, 28)
IN_DAYS = "BETWEEN DATE '2024-01-05' AND DATE '2024-01-28'"
SPAN = "BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"


def copy(table: str, sql: str, source=None, start=COPY_START, end=COPY_END):
    """Register the masked copy of a table; ``source`` is its text or input name."""
    source = source or table

    def build(i):
        rows = i[source] if " " not in source else i.sql(source)
        return masking.demo_copy(table, rows, TENANT, start, end)

    query(f"demo_copy_{table}", f"SELECT * FROM ({sql}) copied WHERE {FIRST}", {"source": source} if " " in source else None)(build)


MEMBER_ROWS = f"""SELECT 1 AS hall_id, 1 AS domain_id, user_id, parent_username AS ag_name, username AS user_name, name AS name_real,
 created_at AS register_date, phone AS user_phone, email AS user_mail, balance, last_ip, level_id AS user_level_id FROM users"""
copy("member_info", f"""SELECT hall_id, domain_id, {MASKED_USER}, register_date, {scaled('balance')}, user_level_id FROM source
 WHERE {NY_DAY.format('register_date')} BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'""", MEMBER_ROWS)
copy("login_log", f"SELECT * FROM login_log WHERE data_date {IN_DAYS}")
copy("bet_analysis", f"""SELECT * REPLACE ({scaled('bet_amount')}, {scaled('commissionable')}, {scaled('payoff')}) FROM bet_analysis
 WHERE data_date {IN_DAYS}""")
copy("game_type_dict", "SELECT * FROM game_flags", "game_flags")
copy("deposit_withdraw_record", f"""SELECT * REPLACE ({scaled('deposit_amount')}, {scaled('withdraw_amount')}) FROM deposit_withdraw_record
 WHERE data_date {IN_DAYS}""")
OFFER_ROWS = "SELECT 1 AS hall_id, 1 AS domain_id, o.* FROM offers o"
copy("offer_info", f"SELECT * REPLACE ({scaled('premium_amount')}) FROM source WHERE data_date {IN_DAYS}", OFFER_ROWS)
copy("user_tag_ods_data", f"""SELECT * REPLACE ({masked('user_name', 3)}) FROM ods WHERE tag_type <> 1
 AND {NY_DAY.format('updated_time')} {IN_DAYS}""", "ods")
DW_ROWS = "SELECT d.*, CAST(last_login_date AS {NTZ}) + INTERVAL 2 HOUR AS updated_time FROM dw d"
copy("user_tag_dw_data", f"""SELECT * REPLACE ({masked('user_name', 3)}, {masked('ag_name', 3)}) FROM source
 WHERE {NY_DAY.format('updated_time')} {IN_DAYS}""", DW_ROWS)
copy("activated_tag_day", f"SELECT * REPLACE ({masked('user_name', 3)}) FROM activated_tag_day WHERE {NY_DAY.format('updated_time')} {IN_DAYS}")
ACTIVE_ROWS = "SELECT a.*, CAST(data_date AS {NTZ}) + INTERVAL 3 HOUR AS updated_time FROM user_active a"
copy("user_active_data", f"SELECT * FROM source WHERE {NY_DAY.format('updated_time')} {IN_DAYS}", ACTIVE_ROWS)
META_ROWS = "SELECT m.*, CAST(data_date AS {NTZ}) + INTERVAL 6 HOUR AS update_date FROM recommend_meta m"
copy("user_recommend_meta_data", f"SELECT * FROM source WHERE {NY_DAY.format('update_date')} {IN_DAYS}", META_ROWS)
copy("smart_message_notification_data", f"{MESSAGES} WHERE {NY_DAY.format('updated_time')} {SPAN}", "messages",
     date(1997, 1, 1), date(1998, 12, 31))
copy("ga_page_path", f"SELECT * FROM ga_page WHERE data_date {IN_DAYS}", "ga_page")
RESULT_ROWS = """SELECT m.hall_id, m.domain_id, t.user_id, data_date, CAST(SUM(payoff) AS BIGINT) AS payoff,
 CAST(SUM(premium) AS BIGINT) AS premium_amount, CAST(-SUM(premium) - SUM(payoff) AS BIGINT) AS profit_loss
 FROM (SELECT user_id, data_date, payoff, 0 AS premium FROM wager_raw
       UNION ALL SELECT user_id, data_date, 0, premium_amount FROM offers) t JOIN member_info m ON t.user_id = m.user_id
 GROUP BY m.hall_id, m.domain_id, t.user_id, data_date"""
copy("profit_loss", f"""SELECT * REPLACE ({scaled('payoff')}, {scaled('premium_amount')}, {scaled('profit_loss')}) FROM source
 WHERE data_date {IN_DAYS}""", RESULT_ROWS)
LOGIN_ROWS = """SELECT l.hall_id, l.domain_id, l.user_id, m.user_name, {0} FROM login_raw l JOIN member_info m ON l.user_id = m.user_id"""
copy("vip_login", f"SELECT * REPLACE ({masked('user_name', 3)}) FROM source WHERE data_date {IN_DAYS}",
     LOGIN_ROWS.format("l.data_date, CAST(hour(l.at_ts) AS INT) AS login_hour, l.ingress"))
copy("login_location", f"SELECT * REPLACE ({masked('user_name', 3)}, {masked('last_ip', 3, '.***.***.***')}) FROM source",
     LOGIN_ROWS.format("l.ip AS last_ip, l.country_code, l.city"))
STEP_ROWS = """SELECT d.*, m.ag_name, m.user_name, CAST(data_date AS {NTZ}) + INTERVAL 3 HOUR AS updated_time
 FROM dw_day d JOIN member_info m ON d.user_id = m.user_id"""
copy("activated_tag_dw_day", f"""SELECT * REPLACE ({masked('ag_name', 3)}, {masked('user_name', 3)}) FROM source
 WHERE {NY_DAY.format('updated_time')} {IN_DAYS}""", STEP_ROWS)
WEB_ROWS = f"""SELECT {MEMBER_TENANT}, user_id, CAST(ts AS DATE) AS data_date, CAST(SUM(pageviews) AS BIGINT) AS page_views
 FROM web_session GROUP BY user_id, CAST(ts AS DATE)"""
copy("ga_data_set", f"SELECT * FROM source WHERE data_date {IN_DAYS}", WEB_ROWS)
SCORE_ROWS = "SELECT hall_id, domain_id, user_id, CAST(COUNT(*) AS BIGINT) AS score FROM user_active GROUP BY hall_id, domain_id, user_id"
copy("user_healthy_score", "SELECT * FROM source", SCORE_ROWS)
JOURNEY_ROWS = f"""SELECT {MEMBER_TENANT}, user_id, CAST(ts AS DATE) AS data_date, CAST(COUNT(*) AS BIGINT) AS steps
 FROM events GROUP BY user_id, CAST(ts AS DATE)"""
copy("member_journey", f"SELECT * FROM source WHERE data_date {IN_DAYS}", JOURNEY_ROWS)
DETAIL_ROWS = f"SELECT {MEMBER_TENANT}, user_id, event_id, event_type, CAST(ts AS DATE) AS data_date FROM events"
copy("member_journey_detail", f"SELECT * FROM source WHERE data_date {IN_DAYS}", DETAIL_ROWS)
