"""Input tables of the jobs, derived from the given tables.

The text is portable: the same statements give the same rows in Spark and in
the checking engine, where ``{NTZ}`` is the zone-less timestamp type. Amounts
are whole mills. Names found in a statement are its dependencies.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

FISCAL = """CAST(year(ts) AS INT) AS financial_year, CAST(month(ts) AS INT) AS financial_month,
       CAST(weekofyear(ts) AS INT) AS financial_week"""
TENANT = "1 AS hall_id, 1 AS domain_id"  # tables without members belong to the first tenant


def tenant_of(member: str) -> str:
    """Members of three halls; the first has two domains."""
    return (f"CAST({member} % 4 % 3 + 1 AS INT) AS hall_id, CAST(CASE WHEN {member} % 4 = 3 THEN 2 ELSE 1 END AS INT) AS domain_id")


MEMBER_TENANT = tenant_of("user_id")
# a member who stops: what falls into the later days is dated three weeks earlier
STOPPED_AT = "CASE WHEN user_id % 11 = 0 AND ts >= DATE '2024-01-10' THEN ts - INTERVAL 21 DAY ELSE ts END"

INPUTS: dict[str, str] = {}

INPUTS["member_info"] = f"""
SELECT {tenant_of('c.c_custkey')}, c.c_custkey AS user_id,
       CASE WHEN c.c_custkey % 29 = 7 THEN NULL ELSE c.c_name END AS user_name,
       CASE WHEN c.c_custkey % 23 = 5 THEN NULL ELSE n.n_name END AS ag_name,
       c.c_nationkey AS user_level_id, c.c_mktsegment AS user_level,
       CAST(ROUND(c.c_acctbal * 100) AS BIGINT) AS balance,
       DATE '2023-06-01' + CAST(c.c_custkey % 230 AS INT) AS register_date,
       CAST(CASE WHEN c.c_custkey % 3 = 0 THEN 1 WHEN c.c_custkey % 3 = 1 THEN 0 END AS INT) AS phone_confirm,
       CAST(c.c_custkey % 2 AS INT) AS email_confirm
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""

INPUTS["users"] = """
SELECT c.c_custkey AS user_id,
       CASE WHEN c.c_custkey % 23 = 5 THEN NULL ELSE n.n_name END AS parent_username,
       CASE WHEN c.c_custkey % 29 = 7 THEN NULL ELSE c.c_name END AS username,
       concat('Name ', CAST(c.c_custkey AS STRING)) AS name,
       CAST(DATE '2023-06-01' + CAST(c.c_custkey % 230 AS INT) AS {NTZ}) + INTERVAL 17 HOUR AS created_at,
       CASE WHEN c.c_custkey % 4 = 0 THEN NULL
            ELSE CAST(DATE '2023-07-01' + CAST(c.c_custkey % 90 AS INT) AS {NTZ}) END AS created_time,
       CASE WHEN c.c_custkey % 6 = 0 THEN NULL ELSE CAST(c.c_custkey % 6 AS INT) END AS created_by,
       concat('0912', CAST(c.c_custkey AS STRING)) AS phone,
       concat('mail', CAST(c.c_custkey AS STRING), '@example.com') AS email,
       CAST(ROUND(c.c_acctbal * 100) AS BIGINT) AS balance,
       CASE WHEN c.c_custkey % 8 = 0 THEN NULL
            ELSE CAST(DATE '2024-01-01' + CAST(c.c_custkey % 30 AS INT) AS {NTZ}) + INTERVAL 5 HOUR END AS last_login,
       CASE WHEN c.c_custkey % 9 = 0 THEN NULL
            ELSE CAST(DATE '2024-01-02' + CAST(c.c_custkey % 30 AS INT) AS {NTZ}) + INTERVAL 21 HOUR END AS last_online,
       concat('10.', CAST(c.c_custkey % 256 AS STRING), '.0.1') AS last_ip,
       concat('10.0.', CAST(c.c_custkey % 256 AS STRING), '.2') AS created_ip,
       concat('C', CAST(c.c_custkey % 6 AS STRING)) AS created_country, concat('city ', CAST(c.c_custkey % 9 AS STRING)) AS created_city,
       concat('C', CAST(c.c_custkey % 5 AS STRING)) AS last_country, concat('z', CAST(c.c_custkey AS STRING)) AS zalo,
       CASE WHEN c.c_custkey % 3 = 1 THEN NULL ELSE concat('f', CAST(c.c_custkey AS STRING)) END AS facebook,
       concat('88', CAST(c.c_custkey AS STRING)) AS qq_num, concat('wx', CAST(c.c_custkey AS STRING)) AS wechat,
       CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE CAST(c.c_custkey % 50 AS INT) END AS last_city_id,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE c.c_nationkey END AS level_id, c.c_mktsegment AS level_name,
       CASE WHEN c.c_custkey % 4 = 1 THEN NULL ELSE CAST(c.c_custkey % 2 AS INT) END AS email_confirm,
       CASE WHEN c.c_custkey % 4 = 2 THEN NULL ELSE CAST(c.c_custkey % 3 AS INT) END AS phone_confirm,
       CAST(CASE WHEN c.c_custkey % 10 = 3 THEN 2 ELSE 1 END AS INT) AS role
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""

INPUTS["created_log"] = """
SELECT o_custkey AS user_id, CAST(DATE '2023-07-01' + CAST(o_orderkey % 300 AS INT) AS {NTZ}) AS created_time
FROM orders"""

INPUTS["wager"] = f"""
SELECT {MEMBER_TENANT}, event_id, user_id, ts AS at_ts, CAST(ts AS DATE) AS data_date,
       CAST(hour(ts) AS INT) AS bet_hour, CAST(event_id % 7 + 1 AS INT) AS lobby,
       CAST(event_id % 6 + 1 AS INT) AS lobby_group, concat('G', CAST(event_id % 20 AS STRING)) AS game_type,
       CAST(event_id % 4 AS INT) AS platform, CAST(ROUND(value * 100) AS BIGINT) * 10 AS valid_bet,
       CAST(ROUND(value * 100) AS BIGINT) * (event_id * 7919 % 21 - 11 + (user_id % 5 - 2) * 4) AS payoff,
       CAST(CASE WHEN event_id % 9 = 0 THEN 0 ELSE 1 END AS INT) AS self_result,
       ts + INTERVAL 30 HOUR AS settle_ts
FROM (SELECT event_id, user_id, value, {STOPPED_AT} AS ts FROM events WHERE event_type IN ('click', 'view')) dated"""

INPUTS["wager_raw"] = f"""
SELECT user_id, concat('AG', CAST(user_id % 5 AS STRING)) AS parent_username, CAST(event_id % 7 + 1 AS INT) AS lobby,
       CASE WHEN event_id % 31 = 0 THEN 'settlement01' ELSE concat('G', CAST(event_id % 20 AS STRING)) END AS game_code,
       CAST(event_id % 6 + 1 AS INT) AS kind,
       CASE WHEN event_id % 12 = 0 THEN NULL ELSE CAST(event_id % 6 + 1 AS INT) END AS lobby_group,
       concat('lobby ', CAST(event_id % 7 + 1 AS STRING)) AS lobby_name,
       CASE WHEN event_id % 12 = 0 THEN NULL ELSE concat('group ', CAST(event_id % 6 + 1 AS STRING)) END AS lobby_group_name,
       concat('game ', CAST(event_id % 20 AS STRING)) AS game_name,
       CAST(1 AS BIGINT) AS wagers_total, CAST(ROUND(value * 100) AS BIGINT) * 11 AS bet,
       CAST(ROUND(value * 100) AS BIGINT) * 10 AS valid_bet,
       CAST(ROUND(value * 100) AS BIGINT) * (event_id * 7919 % 21 - 11) AS payoff,
       CAST(event_id % 100 AS DOUBLE) AS win_rate, CAST(event_id % 4 AS INT) AS device, CAST(event_id % 4 AS INT) AS platform,
       CAST(ts AS DATE) AS data_date, {FISCAL},
       CASE WHEN user_id % 13 = 0 THEN NULL ELSE CAST(user_id % 25 AS INT) END AS level_id,
       concat('L', CAST(user_id % 25 AS STRING)) AS level_name
FROM events WHERE event_type IN ('click', 'view')"""

INPUTS["bet_analysis"] = """
SELECT hall_id, domain_id, user_id, lobby, lobby_group, game_type, platform, data_date,
       CAST(COUNT(*) AS BIGINT) AS wagers_total, CAST(SUM(valid_bet + 10) AS BIGINT) AS bet_amount,
       CAST(SUM(valid_bet) AS BIGINT) AS commissionable, CAST(SUM(payoff) AS BIGINT) AS payoff
FROM wager GROUP BY hall_id, domain_id, user_id, lobby, lobby_group, game_type, platform, data_date"""

INPUTS["vendors"] = """
SELECT s_suppkey AS id,
       concat(CASE s_suppkey % 8 WHEN 0 THEN '體育' WHEN 1 THEN '視訊' WHEN 2 THEN '電子' WHEN 3 THEN '彩票'
                                 WHEN 4 THEN '棋牌' WHEN 5 THEN '麻將' ELSE '' END, s_name) AS tc_name,
       concat('CN ', s_name) AS sc_name, concat('EN ', s_name) AS en_name
FROM supplier"""

INPUTS["lobbies"] = "SELECT id AS lobby, tc_name, sc_name, en_name FROM vendors"

INPUTS["games"] = """
SELECT p_partkey % 7 + 1 AS vendor_id, concat('G', CAST(p_partkey AS STRING)) AS game_code,
       CASE WHEN p_partkey % 50 = 49 THEN NULL
            ELSE concat(CASE p_size % 5 WHEN 0 THEN '百家' WHEN 1 THEN '輪盤' WHEN 2 THEN '21點' WHEN 3 THEN '二十一'
                                        ELSE '' END, p_name) END AS zh_tw_name,
       concat('cn ', p_name) AS zh_cn_name, p_name AS game_name, CAST(p_size % 6 + 1 AS INT) AS kind,
       CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1 END AS INT) AS enable,
       CAST(DATE '2023-12-01' + CAST(p_partkey % 60 AS INT) AS {NTZ}) + INTERVAL 8 HOUR AS online_at
FROM part"""

INPUTS["lobby_games"] = """
SELECT vendor_id AS lobby, game_code, kind AS lobby_group, zh_tw_name AS tc_name, zh_cn_name AS sc_name,
       game_name AS en_name FROM games"""

INPUTS["game_flags"] = """
SELECT 1 AS hall_id, 1 AS domain_id, CAST(vendor_id AS INT) AS lobby, game_code AS game_type,
       kind % 3 = 0 AS is_pvp, kind % 4 = 1 AS is_pve FROM games"""

INPUTS["deposit_record"] = f"""
SELECT {MEMBER_TENANT}, user_id, CAST(ts AS DATE) AS data_date, {FISCAL},
       CAST(CASE WHEN user_id % 7 = 0 THEN 0 ELSE event_id % 3 END AS INT) AS status,
       CAST(ROUND(value * 100) AS BIGINT) * 10 AS amount, CAST(ROUND(value) AS BIGINT) AS fee, CAST(1 AS BIGINT) AS deposit_count
FROM (SELECT event_id, user_id, value, {STOPPED_AT} AS ts FROM events WHERE event_type = 'purchase') dated"""

INPUTS["withdraw_record"] = f"""
SELECT {MEMBER_TENANT}, user_id, CAST(ts AS DATE) AS data_date, {FISCAL}, CAST(event_id % 3 AS INT) AS status,
       CAST(ROUND(value * 100) AS BIGINT) * 8 AS real_amount, CAST(ROUND(value) AS BIGINT) AS fee,
       CAST(1 AS BIGINT) AS withdraw_count
FROM events WHERE event_type = 'error'"""

INPUTS["deposit_withdraw_record"] = """
SELECT hall_id, domain_id, user_id, data_date,
       CAST(SUM(amount) AS BIGINT) AS deposit_amount, CAST(SUM(deposit_count) AS BIGINT) AS deposit_count,
       CAST(SUM(real_amount) AS BIGINT) AS withdraw_amount, CAST(SUM(withdraw_count) AS BIGINT) AS withdraw_count
FROM (SELECT hall_id, domain_id, user_id, data_date, amount, deposit_count, CAST(0 AS BIGINT) AS real_amount,
             CAST(0 AS BIGINT) AS withdraw_count FROM deposit_record WHERE status <> 0
      UNION ALL
      SELECT hall_id, domain_id, user_id, data_date, CAST(0 AS BIGINT), CAST(0 AS BIGINT), real_amount, withdraw_count
      FROM withdraw_record WHERE status <> 0) both_sides
GROUP BY hall_id, domain_id, user_id, data_date"""

INPUTS["login_raw"] = f"""
SELECT {MEMBER_TENANT}, user_id, concat('AG', CAST(user_id % 5 AS STRING)) AS parent_username, ts AS at_ts,
       CAST(ts AS DATE) AS data_date, {FISCAL}, CAST(event_id % 17 AS INT) AS ingress,
       CASE event_id % 5 WHEN 0 THEN 'App' WHEN 1 THEN 'APP' WHEN 2 THEN NULL ELSE 'www' END AS host,
       CAST(CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END AS INT) AS result,
       CAST(CASE WHEN user_id % 10 = 3 THEN 2 ELSE 1 END AS INT) AS role,
       concat('10.', CAST(event_id % 40 AS STRING), '.', CAST(event_id % 7 AS STRING), '.', CAST(event_id % 251 AS STRING)) AS ip,
       concat('C', CAST(event_id % 6 AS STRING)) AS country_code, concat('city ', CAST(event_id % 9 AS STRING)) AS city,
       concat('os', CAST(event_id % 3 AS STRING)) AS client_os, concat('browser', CAST(event_id % 4 AS STRING)) AS client_browser
FROM events WHERE event_type = 'signup'"""

INPUTS["login_log"] = """
SELECT hall_id, domain_id, user_id, host, data_date, CAST(COUNT(*) AS BIGINT) AS login_count
FROM (SELECT hall_id, domain_id, user_id, data_date,
             CASE WHEN ingress BETWEEN 11 AND 16 THEN 'App' WHEN ingress = 1 THEN 'PC' WHEN ingress IN (7, 8) THEN 'UB'
                  ELSE 'Web' END AS host FROM login_raw) logins
GROUP BY hall_id, domain_id, user_id, host, data_date"""

INPUTS["ip_ranges"] = """
SELECT 167772160 + s_suppkey * 131072 AS ip_from, 167772160 + s_suppkey * 131072 + 131071 AS ip_to,
       concat('geo ', CAST(s_nationkey AS STRING)) AS geo_country, s_name AS geo_city FROM supplier"""

INPUTS["ga_page"] = f"""
SELECT {MEMBER_TENANT}, user_id, CAST(ts AS DATE) AS data_date,
       CASE event_id % 5 WHEN 0 THEN '/deposit/step1' WHEN 1 THEN '/withdraw' WHEN 2 THEN '/'
                         WHEN 3 THEN concat('/my/deposit/', CAST(event_id % 3 AS STRING)) ELSE '/about' END AS page_path
FROM events WHERE event_type = 'view'"""

INPUTS["calendar"] = """
SELECT DISTINCT CAST(ts AS DATE) AS date, CAST(year(ts) AS INT) AS fin_year, CAST(month(ts) AS INT) AS fin_month,
       CAST(weekofyear(ts) AS INT) AS fin_week, CAST(date_trunc('week', ts) AS DATE) + 6 AS fin_week_end
FROM events"""

INPUTS["offers"] = f"""
SELECT user_id, CAST(event_id % 9 AS INT) AS opcode, concat('op', CAST(event_id % 9 AS STRING)) AS opcode_name,
       CAST(1 AS BIGINT) AS premium_total, CAST(ROUND(value * 100) AS BIGINT) AS premium_amount,
       CAST(ts AS DATE) AS data_date, {FISCAL}
FROM events WHERE event_type = 'purchase'"""

INPUTS["dispatch"] = f"""
SELECT user_id, event_id % 10 AS promotion_id, concat('promo', CAST(event_id % 10 AS STRING)) AS promotion_name,
       CAST(1 AS BIGINT) AS premium_total, CAST(event_id % 3 AS BIGINT) * 100 AS premium_amount, CAST(ts AS DATE) AS data_date, {FISCAL}
FROM events WHERE event_type IN ('purchase', 'click')"""

INPUTS["applicants"] = f"""
SELECT user_id, event_id % 10 AS promotion_id, CAST(ts AS DATE) AS data_date, {FISCAL}
FROM events WHERE event_type IN ('signup', 'view')"""

INPUTS["promotions"] = """
SELECT 1 AS domain_id, p_partkey AS promotion_id, p_name AS name, p_size AS status,
       CAST(DATE '2024-01-01' + CAST(p_partkey % 40 AS INT) AS {NTZ}) + INTERVAL 9 HOUR AS start_time,
       CAST(DATE '2024-01-15' + CAST(p_partkey % 40 AS INT) AS {NTZ}) + INTERVAL 9 HOUR AS end_time,
       CAST(p_size % 7 AS INT) AS promotion_type
FROM part"""

INPUTS["promotion_kinds"] = """
SELECT CAST(p_size % 5 AS INT) AS type, concat('kind ', CAST(p_size % 5 AS STRING)) AS name FROM part"""

INPUTS["user_vip"] = """
SELECT c_custkey AS user_id, CAST(c_custkey % 10 AS INT) AS vip_id, CAST(c_custkey % 10 AS INT) AS vip_level FROM customer"""

INPUTS["vip_dim"] = "SELECT n_nationkey AS vip_id, concat('VIP ', n_name) AS name FROM nation"

INPUTS["cash_entry"] = f"""
SELECT {MEMBER_TENANT}, user_id, CAST(CASE event_id % 9 WHEN 0 THEN 1039 WHEN 1 THEN 1040 WHEN 2 THEN 2096 WHEN 3 THEN 2100
       WHEN 4 THEN 2508 WHEN 5 THEN 2525 WHEN 6 THEN 2514 WHEN 7 THEN 7001 ELSE 7002 END AS INT) AS opcode,
       ts AS created_at, CAST(ts AS DATE) AS data_date,
       CAST(ROUND(value * 100) AS BIGINT) * CASE WHEN event_id % 13 = 0 THEN -10 ELSE 10 END AS amount
FROM events WHERE event_type IN ('purchase', 'error')"""

INPUTS["opcodes"] = """
SELECT CAST(7000 + n_nationkey AS INT) AS opcode,
       CASE n_nationkey % 3 WHEN 0 THEN 'MD' WHEN 1 THEN 'CD' ELSE 'CryptoD' END AS type FROM nation"""

INPUTS["ods"] = "\nUNION ALL".join(
    f"""
SELECT hall_id, domain_id, user_id, user_name, {code} AS tag_code, {str(code)[0]} AS tag_type,
       user_id % {mod} <> 0 AS tag_enabled, register_date,
       CAST(DATE '2024-01-27' + CAST(user_id % {days} AS INT) AS {{NTZ}}) + INTERVAL 3 HOUR AS updated_time
FROM member_info WHERE user_id % {keep} <> 1"""
    for code, mod, days, keep in [(30015, 3, 4, 5), (40006, 4, 3, 3), (10001, 2, 4, 4), (30019, 3, 2, 6), (30017, 2, 5, 7)])

INPUTS["hedge_stored"] = "\nUNION ALL".join(
    f"""
SELECT hall_id, domain_id, user_id, {code} AS tag_code, user_id % {mod} <> 0 AS tag_enabled FROM member_info WHERE user_id % {keep} <> 1"""
    for code, mod, keep in [(40006, 4, 3), (40007, 5, 2)])

INPUTS["tag_dim"] = f"""
SELECT {TENANT}, CAST(30000 + p_partkey AS INT) AS tag_code, p_name AS tag_name, concat('cn ', p_name) AS tag_name_cn,
       concat('en ', p_name) AS tag_name_en, p_partkey % 9 <> 0 AS tag_enabled,
       CASE p_size % 4 WHEN 0 THEN 'local,dev,prod' WHEN 1 THEN 'dev,prod' WHEN 2 THEN 'prod' ELSE 'local' END AS can_access_env
FROM part"""

INPUTS["dw"] = f"""
SELECT {MEMBER_TENANT}, user_id, user_name, ag_name, user_level_id, user_level,
       concat('3001', CAST(user_id % 7 AS STRING), ',3002', CAST(user_id % 3 AS STRING), ',4000', CAST(user_id % 5 AS STRING)) AS tag_str,
       CASE WHEN user_id % 6 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(user_id % 30 AS INT) END AS last_activated_date,
       DATE '2024-01-01' + CAST(user_id % 28 AS INT) AS last_login_date
FROM member_info WHERE user_id % 5 <> 4"""

INPUTS["edits"] = f"""
SELECT {MEMBER_TENANT}, user_id, CAST(CASE event_id % 3 WHEN 0 THEN 30015 WHEN 1 THEN 30019 ELSE 50100 END AS INT) AS tag_code,
       CAST(event_id % 4 AS INT) AS edit_type, ts AS updated_time
FROM events WHERE event_type = 'error'"""

INPUTS["upload"] = """
SELECT c_name AS user_name,
       CASE c_custkey % 4 WHEN 0 THEN '2024/1/5' WHEN 1 THEN '2024-01-15' WHEN 2 THEN '2024/12/3' ELSE '2024-1-25' END AS data_date,
       CAST(c_custkey % 2 AS INT) AS enable
FROM customer WHERE c_custkey % 3 <> 0"""

INPUTS["arbitrage_info"] = f"""
SELECT {MEMBER_TENANT}, user_id, CAST(CASE WHEN event_id % 3 = 0 THEN 20 ELSE 19 END AS INT) AS external_game_code,
       CAST(event_id % 100 AS INT) AS hedge_round_count, CAST(ts AS DATE) AS data_date
FROM events"""

INPUTS["tenants"] = """
SELECT CAST(s_suppkey AS INT) AS hall_id, s_name AS hall_name, CAST(s_nationkey AS INT) AS domain_id,
       concat('domain ', CAST(s_nationkey AS STRING)) AS domain_name FROM supplier"""

INPUTS["config_rows"] = """
SELECT CAST(o_orderkey AS BIGINT) AS hall_id, CAST(o_custkey % 4 AS BIGINT) AS domain_id, o_orderpriority AS name,
       o_orderdate AS created_time FROM orders"""

INPUTS["activated_tag_day"] = f"""
SELECT m.hall_id, m.domain_id, e.user_id, m.user_name, data_date,
       CAST(50100 + (e.user_id + day(data_date) - day(data_date) % 4) * 5 % 9 AS INT) AS tag_code,
       CAST(data_date AS {{NTZ}}) + INTERVAL 2 HOUR AS updated_time
FROM (SELECT DISTINCT user_id,
             CAST(CASE WHEN user_id % 6 = 0 AND ts >= DATE '2024-01-23' THEN ts - INTERVAL 14 DAY ELSE ts END AS DATE) AS data_date
      FROM events WHERE event_type = 'view') e
JOIN member_info m ON e.user_id = m.user_id"""

INPUTS["activated_tag_ods_week"] = f"""
SELECT {MEMBER_TENANT}, user_id, concat('Customer#', lpad(CAST(user_id AS STRING), 9, '0')) AS user_name, CAST(50100 + event_id % 9 AS INT) AS tag_code, CAST(year(ts) AS INT) AS fin_year,
       CAST(month(ts) AS INT) AS fin_month, CAST(weekofyear(ts) AS INT) AS fin_week, ts AS created_time
FROM events WHERE event_type = 'view'"""

INPUTS["activated_tag_dw_week"] = f"""
SELECT {MEMBER_TENANT}, user_id, concat('Customer#', lpad(CAST(user_id AS STRING), 9, '0')) AS user_name, CAST(event_id % 4 AS INT) AS last_week_step, CAST(event_id % 3 AS INT) AS this_week_step,
       CAST(50100 + event_id % 7 AS INT) AS two_weeks_tag_code, CAST(50100 + event_id % 6 AS INT) AS one_weeks_tag_code,
       CAST(50100 + event_id % 5 AS INT) AS week_tag_code, CAST(year(ts) AS INT) AS fin_year,
       CAST(month(ts) AS INT) AS fin_month, CAST(weekofyear(ts) AS INT) AS fin_week, ts AS created_time
FROM events WHERE event_type = 'click'"""

INPUTS["batches"] = """
SELECT o_orderkey AS batch_id, CAST(o_orderkey % 3 AS INT) AS sync_date_type, o_orderkey % 5 <> 0 AS tag_enabled,
       DATE '2024-01-01' + CAST(o_orderkey % 40 AS INT) AS sync_date_begin,
       DATE '2024-01-01' + CAST(o_orderkey % 40 + o_orderkey % 20 AS INT) AS sync_date_end,
       CAST(DATE '2024-01-29' + CAST(o_orderkey % 2 AS INT) AS {NTZ}) + INTERVAL 22 HOUR AS operator_time
FROM orders"""

# batch numbers repeat over the tenants; the last batch matches nobody
INPUTS["sync_batches"] = f"""
SELECT {tenant_of('n_nationkey')}, CAST((n_nationkey - n_nationkey % 4) / 4 AS INT) AS batch_id,
       CASE WHEN n_nationkey % 12 = 5 THEN NULL ELSE CAST(11 + (n_nationkey - n_nationkey % 4) / 4 AS INT) END AS tag_id,
       concat('batch ', CAST(n_nationkey AS STRING)) AS tag_name,
       CASE WHEN n_nationkey = 8 THEN 'NATION_3' END AS ag_name,
       CASE WHEN n_nationkey % 3 = 0 AND n_nationkey < 24 THEN '1;2;3;5;7;8;11;13;17;19' END AS user_level_id,
       CASE WHEN n_nationkey % 6 = 0 THEN '7,13' END AS user_level_exclude,
       CASE WHEN n_nationkey % 10 <> 9 THEN DATE '2024-01-05' END AS activated_date_begin,
       CASE WHEN n_nationkey % 10 <> 9 THEN DATE '2024-01-28' END AS activated_date_end,
       CASE WHEN n_nationkey = 24 THEN '99999' WHEN n_nationkey % 5 = 1 THEN '30011,30021;30012;30013' END AS tag_str,
       CASE WHEN n_nationkey % 9 = 2 THEN '30010;30020,40001' END AS tag_str_exclude,
       CASE WHEN n_nationkey % 7 = 3 THEN 'odd' WHEN n_nationkey % 7 = 4 THEN 'even' ELSE '' END AS file_name,
       CAST(CASE WHEN n_nationkey % 8 = 5 THEN 3 END AS INT) AS user_step,
       CASE WHEN n_nationkey % 6 = 4 THEN '2,3,5' END AS user_activity,
       CASE WHEN n_nationkey % 9 = 7 THEN '40;60' END AS deposit_predict_rate,
       CAST(CASE WHEN n_nationkey % 11 = 2 THEN 9 END AS INT) AS bet_amount_rank,
       n_nationkey % 2 = 0 AS ab_test, n_nationkey % 4 < 2 AS activity,
       CAST(CASE WHEN n_nationkey % 8 = 0 THEN 7 END AS INT) AS activity_id, concat('campaign ', n_name) AS activity_name,
       CAST(n_nationkey % 3 % 2 + 1 AS INT) AS mode, CAST(CASE WHEN n_nationkey % 10 = 4 THEN 1 ELSE 2 END AS INT) AS sync_date_type,
       n_nationkey % 8 <> 7 AS tag_enabled, DATE '2024-01-01' AS sync_date_begin, DATE '2024-02-01' AS sync_date_end,
       CAST(0 AS BIGINT) AS match_user_count, CAST(3 AS BIGINT) AS actual_user_count,
       CAST(DATE '2024-01-02' AS {{NTZ}}) AS updated_time,
       CAST(DATE '2024-01-30' - CAST(n_nationkey % 2 AS INT) AS {{NTZ}}) + INTERVAL 22 HOUR AS operator_time
FROM nation"""

INPUTS["sync_uploads"] = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS file_name, c_name AS user_name FROM customer WHERE c_custkey % 5 <> 3"""

INPUTS["sync_tagged"] = f"""
SELECT {tenant_of('c_custkey')}, CAST(11 + c_custkey % 7 AS INT) AS tag_id, c_custkey AS user_id FROM customer WHERE c_custkey % 3 <> 1"""

INPUTS["dw_day"] = f"""
SELECT {tenant_of('c_custkey')}, c_custkey AS user_id, CAST(c_custkey % 8 AS INT) AS this_day_step,
       DATE '2024-01-28' + CAST(c_custkey % 3 AS INT) AS data_date FROM customer"""

INPUTS["user_active"] = f"""
SELECT {MEMBER_TENANT}, user_id, CAST(ts AS DATE) AS data_date, CAST(event_id % 9 AS DOUBLE) / 8 AS action_score FROM events"""

INPUTS["recommend_meta"] = f"""
SELECT {MEMBER_TENANT}, user_id, CAST(ts AS DATE) AS data_date, CAST(50001 + event_id % 2 AS INT) AS recommend_code,
       CAST(event_id % 9 AS DOUBLE) / 8 AS action_score FROM events"""

INPUTS["tagged"] = f"SELECT {tenant_of('c_custkey')}, c_custkey AS user_id FROM customer WHERE c_custkey % 3 <> 1"

INPUTS["sync_group"] = f"""
SELECT {tenant_of('c_custkey')}, CAST(c_custkey % 3 AS INT) AS batch_id, CAST(11 + c_custkey % 2 AS INT) AS tag_id, 'old' AS tag_name,
       c_custkey AS user_id, CAST(c_custkey % 3 AS INT) AS group_id, c_custkey % 4 <> 0 AS latest_tag FROM customer"""

INPUTS["campaigns"] = f"""
SELECT {TENANT}, CAST(p_partkey AS INT) AS activity_id, p_name AS activity_name, CAST(p_size AS INT) AS status FROM part"""

INPUTS["activity_member"] = f"""
SELECT CAST(7 AS INT) AS activity_id, {tenant_of('c_custkey')}, c_name AS user_name FROM customer WHERE c_custkey % 4 = 0"""

INPUTS["messages"] = f"""
SELECT {TENANT}, message_id, kind, updated_time,
       CASE WHEN message_id % 5 = 0 THEN concat('note ', CAST(n AS STRING))
            ELSE concat('會員 #', who, '@shop#存款 ¥', amount, ' 完成 (', amount, ')') END AS content
FROM (SELECT o_orderkey AS message_id, o_orderstatus AS kind, o_orderdate AS updated_time, n,
             concat('abc', CAST(o_custkey AS STRING), 'xyz') AS who,
             CASE WHEN n < 1000 THEN CAST(n AS STRING)
                  ELSE concat(CAST(CAST((n - n % 1000) / 1000 AS BIGINT) AS STRING), ',',
                              lpad(CAST(n % 1000 AS STRING), 3, '0')) END AS amount
      FROM (SELECT *, CAST(ROUND(o_totalprice) AS BIGINT) * 5 AS n FROM orders) priced) texts"""

INPUTS["web_session"] = f"""
SELECT event_id, user_id, ts, CAST(event_id % 9 AS BIGINT) AS pageviews,
       CASE WHEN event_id % 4 = 0 THEN CAST(1 AS BIGINT) END AS bounces,
       CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 300 AS BIGINT) END AS time_on_site,
       CASE WHEN event_id % 17 <> 0 THEN event_id END AS visit_number, CAST(event_id % 3 + 1 AS INT) AS n_hits,
       event_id % 37 = 0 OR event_id % 41 = 0 AS unknown_client
FROM events WHERE event_type IN ('view', 'click')"""

NAMES = re.compile(r"\b[a-z_0-9]+\b")


@lru_cache(None)
def needed(sql: str) -> tuple[str, ...]:
    """Inputs a statement refers to, dependencies first."""
    order: list[str] = []
    for name in NAMES.findall(sql):
        if name in INPUTS and name not in order:
            order += [n for n in (*needed(INPUTS[name]), name) if n not in order]
    return tuple(order)


def with_inputs(sql: str, ntz: str, ctes: dict[str, str] | None = None) -> str:
    """Statement preceded by the inputs (and further named parts) it refers to."""
    ctes = ctes or {}
    wanted = [c for c in ctes]
    text = " ".join([sql, *ctes.values()])
    names = [n for n in needed(text) if n not in ctes]
    parts = [f"{n} AS ({INPUTS[n]})" for n in names] + [f"{n} AS ({ctes[n]})" for n in wanted]
    if not parts:
        return sql.replace("{NTZ}", ntz)
    return ("WITH " + ",\n".join(parts) + "\n" + sql).replace("{NTZ}", ntz)


class Inputs:
    """Input tables of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self.sql(f"SELECT * FROM {name}") if name in INPUTS else self.spark.read.parquet(
                f"{self.folder}/{name}.parquet")
        return self._made[name]

    def sql(self, text: str) -> DataFrame:
        full = with_inputs(text, "TIMESTAMP_NTZ")
        for name in BASE:
            if re.search(rf"\b(FROM|JOIN) {name}\b", full):
                self[name].createOrReplaceTempView(name)
        return self.spark.sql(full)
