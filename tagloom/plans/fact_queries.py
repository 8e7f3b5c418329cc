"""Fact builders."""

from datetime import date

from pyspark.sql import functions as F

from tagloom.functions.columns import conform_types, tenant_columns
from tagloom.operators import facts, web
from tagloom.plans.registry import AS_OF, END, START, TENANT, TODAY, query
from tagloom.sources.sinks import materialise

RANGE = "BETWEEN DATE '2024-01-03' AND DATE '2024-01-27'"
FISCAL = "financial_year, financial_month, financial_week"
PLATFORMS = {0: "web", 1: "ios", 2: "android"}
PLATFORM_NAME = "CASE {0} WHEN 0 THEN 'web' WHEN 1 THEN 'ios' WHEN 2 THEN 'android' ELSE '' END"
LEVELS = "parent_username AS ag_name, COALESCE(level_id, 0) AS user_level_id, level_name AS user_level"
MEMBER_RANGE = "BETWEEN DATE '2023-07-01' AND DATE '2023-09-30'"
MEMBER_START, MEMBER_END = date(2023, 7, 1), date(2023, 9, 30)


@query("member_info", f"""
SELECT 1 AS hall_id, 'hall' AS hall_name, 1 AS domain_id, 'domain' AS domain_name,
       user_id, parent_username AS ag_name, username AS user_name, name AS name_real,
       created_at + INTERVAL 4 HOUR AS register_date, created_ip AS register_ip, created_country AS register_country,
       created_city AS register_city, COALESCE(created_by, 0) AS register_by, phone AS user_phone,
       email AS user_mail, balance, last_login + INTERVAL 4 HOUR AS last_login, last_ip, last_country,
       COALESCE(last_city_id, 0) AS last_city_id, last_online + INTERVAL 4 HOUR AS last_online, zalo, facebook, 0 AS arbitrage_flag,
       COALESCE(level_id, 0) AS user_level_id, level_name AS user_level, COALESCE(email_confirm, 0) AS email_confirm,
       COALESCE(phone_confirm, 0) AS phone_confirm
FROM users WHERE role = 1 AND (CAST(created_at AS DATE) {MEMBER_RANGE} OR CAST(created_time AS DATE) {MEMBER_RANGE})""")
def _(i):
    return tenant_columns(facts.member_info(i["users"], MEMBER_START, MEMBER_END), TENANT)


@query("member_contacts", f"""
SELECT user_id, parent_username AS ag_name, username AS user_name, name AS name_real, created_at + INTERVAL 4 HOUR AS register_date,
       phone AS user_phone, email AS user_mail, balance, last_login + INTERVAL 4 HOUR AS last_login, last_ip, qq_num, wechat,
       COALESCE(level_id, 0) AS user_level_id, level_name AS user_level
FROM users WHERE CAST(created_at AS DATE) {MEMBER_RANGE} OR CAST(created_time AS DATE) {MEMBER_RANGE}""")
def _(i):
    return facts.member_contacts(i["users"], MEMBER_START, MEMBER_END)


@query("conform_types", """
SELECT CAST(user_id AS BIGINT) AS user_id, user_name, CAST(COALESCE(user_level_id, 0) AS BIGINT) AS user_level_id,
       CAST(balance AS DECIMAL(18, 2)) AS balance, CAST(register_date AS TIMESTAMP) AS register_date
FROM (SELECT user_id, username AS user_name, level_id AS user_level_id, balance / 100 AS balance, CAST(created_at AS DATE) AS register_date
      FROM users) u""")
def _(i):
    loaded = i.sql("""SELECT CAST(user_id AS STRING) AS user_id, username AS user_name, level_id AS user_level_id,
        CAST(balance / 100 AS STRING) AS balance, CAST(CAST(created_at AS DATE) AS STRING) AS register_date FROM users""")
    return conform_types(loaded)


@query("new_members", f"""
SELECT DISTINCT u.user_id, u.username AS user_name FROM users u LEFT JOIN created_log l ON u.user_id = l.user_id
WHERE role = 1 AND (CAST(u.created_at AS DATE) {MEMBER_RANGE} OR CAST(l.created_time AS DATE) {MEMBER_RANGE})""")
def _(i):
    return facts.new_members(i["users"], i["created_log"], MEMBER_START, MEMBER_END)


@query("login_log_app_flag", f"""
SELECT l.user_id, COUNT(*) AS login_count, CASE WHEN a.user_id IS NOT NULL THEN 'App' ELSE 'Web' END AS host,
       l.data_date, {FISCAL}
FROM login_raw l JOIN users u ON l.user_id = u.user_id AND u.role = 1
LEFT JOIN (SELECT DISTINCT user_id, data_date FROM login_raw WHERE lower(host) = 'app') a
       ON l.user_id = a.user_id AND l.data_date = a.data_date
WHERE l.data_date {RANGE} GROUP BY l.user_id, a.user_id, l.data_date, {FISCAL}""")
def _(i):
    return facts.login_log_app_flag(i["login_raw"], i["users"], START, END)


@query("login_log_ingress", f"""
SELECT user_id, parent_username AS ag_name, COUNT(*) AS login_count,
       CASE WHEN ingress IN (11, 12, 13, 14, 15, 16) THEN 'App' WHEN ingress = 1 THEN 'PC'
            WHEN ingress IN (7, 8) THEN 'UB' ELSE 'Web' END AS host, data_date, {FISCAL}
FROM login_raw WHERE data_date {RANGE} GROUP BY ALL""")
def _(i):
    return facts.login_log_ingress(i["login_raw"], START, END)


KIND_OF_VENDOR = """CASE WHEN v.tc_name LIKE '%體育%' THEN 1 WHEN v.tc_name LIKE '%視訊%' THEN 2 WHEN v.tc_name LIKE '%電子%' THEN 3
 WHEN v.tc_name LIKE '%彩票%' THEN 4 WHEN v.tc_name LIKE '%棋牌%' THEN 5 WHEN v.tc_name LIKE '%麻將%' THEN 6 ELSE {0} END"""
FLAGS = """COALESCE({0} LIKE '%百家%' OR {0} LIKE '%輪盤%', FALSE) AS is_pvp,
 COALESCE({0} LIKE '%百家%' OR {0} LIKE '%21%' OR {0} LIKE '%二十一%', FALSE) AS is_pve"""


@query("game_dict", f"""
SELECT vendor_id AS lobby, v.tc_name AS lobby_name, v.sc_name AS lobby_name_cn, v.en_name AS lobby_name_en,
       game_code AS game_type, zh_tw_name AS game_type_name, zh_cn_name AS game_type_name_cn, game_name AS game_type_name_en,
       kind AS game_kind, {FLAGS.format('zh_tw_name')}
FROM games g JOIN vendors v ON g.vendor_id = v.id AND g.kind = {KIND_OF_VENDOR.format('g.kind')}""")
def _(i):
    return facts.game_dict(i["games"], i["vendors"])


@query("game_dict_by_lobby", f"""
SELECT g.lobby, v.tc_name AS lobby_name, v.sc_name AS lobby_name_cn, v.en_name AS lobby_name_en, lobby_group,
       CASE lobby_group WHEN 1 THEN 'sport' WHEN 2 THEN 'lottery' WHEN 3 THEN 'live' WHEN 5 THEN 'prob' WHEN 6 THEN 'card' END
         AS lobby_group_name, game_code AS game_type, g.tc_name AS game_type_name, g.sc_name AS game_type_name_cn,
       g.en_name AS game_type_name_en, {FLAGS.format('g.tc_name')}
FROM lobby_games g JOIN lobbies v ON g.lobby = v.lobby""")
def _(i):
    return facts.game_dict_by_lobby(i["lobby_games"], i["lobbies"])


SUMS = """CAST(SUM(wagers_total) AS BIGINT) AS wagers_total, CAST(SUM(bet) AS BIGINT) AS bet_amount,
 CAST(SUM(valid_bet) AS BIGINT) AS commissionable, CAST(SUM(payoff) AS BIGINT) AS payoff, AVG(win_rate) AS win_rate"""


@query("bet_analysis", f"""
SELECT b.user_id, b.parent_username AS ag_name, b.lobby, v.tc_name AS lobby_name, v.sc_name AS lobby_name_cn,
       v.en_name AS lobby_name_en, b.game_code AS game_type, b.kind AS game_kind,
       CASE b.kind WHEN 1 THEN 'sport' WHEN 2 THEN 'live' WHEN 3 THEN 'prob' WHEN 4 THEN 'lottery' WHEN 5 THEN 'card'
                   WHEN 6 THEN 'mahjong' END AS game_kind_name,
       g.zh_tw_name AS game_name, g.zh_cn_name AS game_name_cn, g.game_name AS game_name_en, {SUMS},
       device AS platform, {PLATFORM_NAME.format('device')} AS platform_name, data_date, {FISCAL},
       COALESCE(m.level_id, 0) AS user_level_id, m.level_name AS user_level
FROM wager_raw b JOIN users m ON m.user_id = b.user_id
LEFT JOIN vendors v ON b.lobby = v.id AND b.kind = {KIND_OF_VENDOR.format('b.kind')}
LEFT JOIN games g ON b.lobby = g.vendor_id AND b.game_code = g.game_code
WHERE m.role = 1 AND b.game_code <> 'settlement01' AND data_date {RANGE} GROUP BY ALL""")
def _(i):
    return facts.bet_analysis(i["wager_raw"], i["users"], i["vendors"], i["games"], PLATFORMS, START, END)


@query("bet_analysis_by_lobby", f"""
SELECT b.user_id, b.parent_username AS ag_name, b.lobby, b.lobby_name, v.sc_name AS lobby_name_cn, v.en_name AS lobby_name_en,
       COALESCE(b.lobby_group, 0) AS lobby_group, b.lobby_group_name, b.game_name, b.game_code AS game_type, g.sc_name AS game_name_cn, g.en_name AS game_name_en,
       {SUMS}, platform, {PLATFORM_NAME.format('platform')} AS platform_name, data_date, {FISCAL},
       COALESCE(level_id, 0) AS user_level_id, level_name AS user_level
FROM wager_raw b LEFT JOIN lobby_games g ON b.lobby = g.lobby AND b.game_code = g.game_code
LEFT JOIN lobbies v ON g.lobby = v.lobby WHERE data_date {RANGE}
GROUP BY b.user_id, b.parent_username, b.lobby, b.lobby_name, b.lobby_group_name, b.game_name, v.sc_name, v.en_name, b.lobby_group, b.game_code, g.sc_name, g.en_name,
         platform, data_date, {FISCAL}, level_id, level_name""")
def _(i):
    return facts.bet_analysis_by_lobby(i["wager_raw"], i["lobbies"], i["lobby_games"], PLATFORMS, START, END)


DEPOSITS = f"""SELECT user_id, data_date, {FISCAL}, SUM(amount) AS amount, SUM(fee) AS fee, SUM(deposit_count) AS n
 FROM deposit_record WHERE status <> 0 GROUP BY ALL"""
WITHDRAWALS = f"""SELECT user_id, data_date, {FISCAL}, SUM(real_amount) AS amount, SUM(fee) AS fee, SUM(withdraw_count) AS n
 FROM withdraw_record WHERE status <> 0 GROUP BY ALL"""
SIDES = ", ".join(
    f"CAST(COALESCE({side}.{c}, 0) AS BIGINT) AS {name}" for side, c, name in [
        ("d", "amount", "deposit_amount"), ("d", "fee", "deposit_fee"), ("d", "n", "deposit_count"),
        ("w", "amount", "withdraw_amount"), ("w", "fee", "withdraw_fee"), ("w", "n", "withdraw_count")])


def _side(first: str) -> str:
    return f"""SELECT {first}.user_id, parent_username AS ag_name, {SIDES}, {first}.data_date,
 {first}.financial_year, {first}.financial_month, {first}.financial_week, COALESCE(level_id, 0) AS user_level_id, level_name AS user_level"""


@query("deposit_withdraw", f"""
{_side('d')} FROM d LEFT JOIN w ON d.user_id = w.user_id AND d.data_date = w.data_date JOIN users m ON d.user_id = m.user_id
WHERE d.data_date {RANGE} AND parent_username IS NOT NULL
UNION
{_side('w')} FROM d RIGHT JOIN w ON d.user_id = w.user_id AND d.data_date = w.data_date JOIN users m ON w.user_id = m.user_id
WHERE w.data_date {RANGE} AND parent_username IS NOT NULL""", {"d": DEPOSITS, "w": WITHDRAWALS})
def _(i):
    return facts.deposit_withdraw(i["deposit_record"], i["withdraw_record"], i["users"], START, END)


@query("offer_info", f"""
SELECT o.user_id, {LEVELS}, opcode, opcode_name, premium_total, premium_amount, data_date, {FISCAL}
FROM offers o JOIN users m ON m.user_id = o.user_id WHERE data_date {RANGE}""")
def _(i):
    return facts.offer_info(i["offers"], i["users"], START, END)


@query("offer_dispatch", f"""
SELECT user_id, promotion_id, promotion_name, premium_total, premium_amount, data_date, {FISCAL}
FROM dispatch WHERE data_date {RANGE}""")
def _(i):
    return facts.offer_dispatch(i["dispatch"], START, END)


@query("offer_applicant", f"""
SELECT a.user_id, a.promotion_id, p.name AS promotion_name, COUNT(a.user_id) AS application_count,
       COALESCE(d.premium_total, 0) AS premium_total, COALESCE(d.premium_amount, 0) AS premium_amount, a.data_date,
       a.financial_year, a.financial_month, a.financial_week
FROM applicants a JOIN promotions p ON a.promotion_id = p.promotion_id
LEFT JOIN dispatch d ON p.promotion_id = d.promotion_id AND a.user_id = d.user_id AND a.data_date = d.data_date
WHERE a.data_date {RANGE} GROUP BY ALL""")
def _(i):
    return facts.offer_applicant(i["applicants"], i["promotions"], i["dispatch"], START, END)


@query("offer_promotion", """
SELECT promotion_id, name AS promotion_name, status AS promotion_status, CAST(start_time AS DATE) AS begin_date,
       CAST(end_time AS DATE) AS end_date FROM promotions WHERE CAST(start_time AS DATE) >= DATE '2024-01-03'""")
def _(i):
    return facts.offer_promotion(i["promotions"], START)


@query("profit_loss", f"""
SELECT user_id, data_date, {FISCAL}, CAST(SUM(payoff) AS BIGINT) AS payoff, CAST(SUM(premium) AS BIGINT) AS premium_amount,
       CAST(-SUM(premium) - SUM(payoff) AS BIGINT) AS profit_loss
FROM (SELECT user_id, data_date, {FISCAL}, payoff, 0 AS premium FROM wager_raw WHERE data_date {RANGE}
      UNION ALL SELECT user_id, data_date, {FISCAL}, 0, premium_amount FROM offers WHERE data_date {RANGE}) t
GROUP BY user_id, data_date, {FISCAL}""")
def _(i):
    return facts.profit_loss(i["offers"], i["wager_raw"], START, END)


@query("vip_level", """
SELECT u.user_id, u.username AS user_name, v.vip_id, d.name AS vip_name, v.vip_level
FROM users u JOIN user_vip v ON u.user_id = v.user_id JOIN vip_dim d ON v.vip_id = d.vip_id
WHERE u.role = 1 AND v.vip_level <> 0""")
def _(i):
    return facts.vip_level(i["users"], i["user_vip"], i["vip_dim"])


VIP_LOGIN = """
SELECT l.user_id, u.username AS user_name, CAST(hour(at_ts) AS INT) AS login_hour, COUNT(*) AS login_count, data_date,
       CAST(isodow(data_date) AS INT) AS weekday, fin_year, fin_month, fin_week
FROM login_raw l JOIN users u ON l.user_id = u.user_id LEFT JOIN calendar c ON l.data_date = c.date
WHERE data_date {0} AND l.user_id IN ({1}) GROUP BY ALL"""


@query("vip_login", VIP_LOGIN.format(RANGE, "SELECT user_id FROM user_vip WHERE vip_level >= 1"))
def _(i):
    return facts.vip_login(i["login_raw"], i["users"], i["user_vip"], i["calendar"], START, END)


@query("vip_login_tagged", VIP_LOGIN.format(RANGE, "SELECT user_id FROM ods WHERE tag_code = 10001 AND tag_enabled"))
def _(i):
    return facts.vip_login_tagged(i["login_raw"], i["users"], i["ods"], i["calendar"], START, END)


LATEST_ANY = f"""SELECT user_id, data_date, ip, country_code, city, client_os, client_browser FROM (
 SELECT *, MAX(at_ts) OVER (PARTITION BY user_id, data_date) AS latest FROM login_raw
 WHERE data_date {RANGE} AND result = 1) t WHERE at_ts = latest"""
query("latest_login_any_role", LATEST_ANY)(lambda i: facts.latest_login(i["login_raw"], START, END, role=None))

LATEST = f"""SELECT user_id, data_date, ip, country_code, city, client_os, client_browser FROM (
 SELECT *, MAX(at_ts) OVER (PARTITION BY user_id, data_date) AS latest FROM login_raw
 WHERE data_date {RANGE} AND result = 1 AND role = 1) t WHERE at_ts = latest"""


@query("latest_login", LATEST)
def _(i):
    return facts.latest_login(i["login_raw"], START, END)


@query("login_location", """
SELECT l.*, geo_country, geo_city FROM (SELECT *, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216
   + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536 + CAST(split_part(ip, '.', 3) AS BIGINT) * 256
   + CAST(split_part(ip, '.', 4) AS BIGINT) AS num FROM latest) n
JOIN latest l USING (user_id, data_date, ip) LEFT JOIN ip_ranges r ON num BETWEEN ip_from AND ip_to""", {"latest": LATEST})
def _(i):
    return facts.login_location(facts.latest_login(i["login_raw"], START, END), i["ip_ranges"], materialise)


HOURLY = """SELECT t.user_id, bet_hour, data_date, CAST(dayofweek(data_date) + 1 AS INT) AS data_weekday,
 CAST(SUM(valid_bet) AS BIGINT) AS commissionable, username AS user_name, created_at + INTERVAL 12 HOUR AS register_date
FROM ({0}) t JOIN users u ON t.user_id = u.user_id WHERE data_date <= DATE '2024-01-30'
GROUP BY t.user_id, bet_hour, data_date, username, created_at"""


@query("bet_time", HOURLY.format("SELECT user_id, bet_hour, data_date, valid_bet FROM wager"))
def _(i):
    return facts.bet_time(i["wager"], i["users"], AS_OF)


@query("bet_time_placed_and_settled", HOURLY.format("""
SELECT user_id, bet_hour, data_date, valid_bet FROM wager WHERE self_result = 1 UNION ALL
SELECT user_id, CAST(hour(settle_ts) AS INT), CAST(settle_ts AS DATE), valid_bet FROM wager WHERE self_result = 1"""))
def _(i):
    return facts.bet_time(i["wager"], i["users"], AS_OF, settled=i["wager"])


@query("bet_time_of_vendors", """
SELECT t.user_id, bet_hour, data_date, CAST(isodow(data_date) - 1 AS INT) AS data_weekday, CAST(SUM(valid_bet) AS BIGINT) AS commissionable,
       username AS user_name, created_at + INTERVAL 12 HOUR AS register_date
FROM (SELECT user_id, valid_bet, CAST(hour(at_ts - INTERVAL 12 HOUR) AS INT) AS bet_hour, CAST(at_ts - INTERVAL 12 HOUR AS DATE) AS data_date
      FROM wager) t JOIN users u ON t.user_id = u.user_id WHERE data_date <= DATE '2024-01-30'
GROUP BY t.user_id, bet_hour, data_date, username, created_at""")
def _(i):
    wager = i["wager"]
    per_vendor = [wager.filter(F.col("lobby") == lobby) for lobby in range(1, 8)]
    return facts.bet_time_of_vendors(per_vendor, i["users"], AS_OF)


@query("cash_by_opcode", """
SELECT c.user_id, opcode, data_date, CAST(SUM(amount) AS BIGINT) AS amount, username AS user_name,
       u.created_at + INTERVAL 12 HOUR AS register_date
FROM cash_entry c JOIN users u ON c.user_id = u.user_id WHERE data_date <= DATE '2024-01-30'
GROUP BY c.user_id, opcode, data_date, username, u.created_at""")
def _(i):
    return facts.cash_by_opcode(i["cash_entry"], i["users"], AS_OF)


@query("online_month_games", """
SELECT vendor_id, kind, game_code, enable FROM games
WHERE enable = 1 AND CAST(online_at AS DATE) <= DATE '2024-01-31' - 30""")
def _(i):
    return facts.online_month_games(i["games"], TODAY)


@query("promotion_types", """
SELECT DISTINCT domain_id, promotion_id, t.type, t.name
FROM promotions p JOIN (SELECT DISTINCT type, name FROM promotion_kinds) t ON p.promotion_type = t.type""")
def _(i):
    return facts.promotion_types(i["promotions"], i["promotion_kinds"])


@query("opcode_types", "SELECT opcode, type FROM opcodes")
def _(i):
    return facts.opcode_types(i["opcodes"])


# -- web sessions: nested in Spark, flat (one row per hit) in the check --------
# k numbers the hits: three per session at most
HIT_FIELDS = {
    "kind": "CASE WHEN k % 3 <> 0 THEN 'EVENT' ELSE 'PAGE' END",
    "category": "CASE WHEN k % 4 < 2 THEN 'enhanced_ecommerce' WHEN k % 4 = 2 THEN 'online_service' END",
    "action": "CASE WHEN k % 5 <> 0 THEN 'click' ELSE 'view' END",
    "label": """CASE WHEN k % 4 = 0 THEN 'productClick' WHEN k % 4 = 1 THEN 'promotionClick'
                     WHEN k % 8 = 2 THEN 'online_service_contact' WHEN k % 8 = 6 THEN 'online_service_contact_mobile' END""",
    "host": "concat('www', CAST(k % 3 AS STRING), '.example.com')",
    "path": """CASE k % 7 WHEN 0 THEN '/' WHEN 1 THEN '/Member/Deposit/step' WHEN 2 THEN '/casino' WHEN 3 THEN '/about'
                      WHEN 4 THEN '/gameLobby/x' WHEN 6 THEN '/mobile/iframe/game/12' END""",
    "title": "concat('T', CAST(k % 4 AS STRING))",
    "hall": "CASE WHEN k % 6 = 0 THEN '2' ELSE '1' END",
    "domain": "CASE WHEN k % 11 <> 0 THEN '1' END",
}
FLAT = ", ".join(f"{sql} AS {name}" for name, sql in HIT_FIELDS.items())
HITS = f"""SELECT event_id, user_id, day, {FLAT} FROM (
 SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_id * 3 + unnest(range(n_hits)) AS k
 FROM web_session WHERE NOT unknown_client) s"""
TENANT_HIT = "hall = '1' AND domain = '1'"
CLIENT = "lower(to_base(user_id, 24))"


def hit_sql() -> str:
    """Struct of hit ``k``; the domain dimension is absent for some hits."""
    v = {name: f"({sql})" for name, sql in HIT_FIELDS.items()}
    hall = f"named_struct('index', 4, 'value', {v['hall']})"
    domain = f"named_struct('index', 15, 'value', {v['domain']})"
    return f"""named_struct('type', {v['kind']},
      'eventInfo', named_struct('eventCategory', {v['category']}, 'eventAction', {v['action']}, 'eventLabel', {v['label']}),
      'page', named_struct('hostname', {v['host']}, 'pagePath', {v['path']}, 'pageTitle', {v['title']}),
      'customDimensions', IF({v['domain']} IS NULL, array({hall}), array({hall}, {domain})))"""


def sessions(i):
    hits = f"transform(sequence(event_id * 3, event_id * 3 + n_hits - 1), k -> {hit_sql()})"
    return i["web_session"].select(
        F.expr("""CASE WHEN event_id % 37 = 0 THEN 'undefined' WHEN event_id % 41 = 0 THEN 'zzzzzzzzzzzz'
                       ELSE lower(conv(user_id, 10, 24)) END""").alias("clientId"),
        F.date_format("ts", "yyyyMMdd").alias("date"), F.col("visit_number").alias("visitNumber"),
        F.struct("pageviews", "bounces", F.col("time_on_site").alias("timeOnSite")).alias("totals"),
        F.expr(hits).alias("hits"))


GA_DATA = f"""
SELECT {{id}} AS user_id, day AS data_date, product_clicks, promotion_clicks, service_contact, service_contact_mobile,
       CAST(page_views AS BIGINT) AS page_views, total_sessions, CAST(total_bounces AS BIGINT) AS total_bounces,
       CAST(time_on_site AS BIGINT) AS time_on_site{{more}}
FROM (SELECT user_id, day,
        COUNT(*) FILTER (kind = 'EVENT' AND category = 'enhanced_ecommerce' AND action = 'click' AND label = 'productClick') AS product_clicks,
        COUNT(*) FILTER (kind = 'EVENT' AND category = 'enhanced_ecommerce' AND action = 'click' AND label = 'promotionClick') AS promotion_clicks,
        COUNT(*) FILTER (category = 'online_service' AND label = 'online_service_contact') AS service_contact,
        COUNT(*) FILTER (category = 'online_service' AND label = 'online_service_contact_mobile') AS service_contact_mobile
      FROM hits WHERE {TENANT_HIT} GROUP BY user_id, day) c
JOIN (SELECT user_id, CAST(ts AS DATE) AS day, SUM(pageviews) AS page_views, COUNT(visit_number) AS total_sessions,
             SUM(COALESCE(bounces, 0)) AS total_bounces, SUM(COALESCE(time_on_site, 0)) AS time_on_site
      FROM web_session WHERE NOT unknown_client GROUP BY user_id, day) t USING (user_id, day)"""


@query("ga_data_set", GA_DATA.format(id=CLIENT, more=""), {"hits": HITS})
def _(i):
    return web.ga_data_set(sessions(i), 1, 1)


@query("ga_user_id_decode", GA_DATA.format(id="user_id", more=", fin_year, fin_month, fin_week")
       + " LEFT JOIN calendar ON day = date WHERE user_id <> 0", {"hits": HITS})
def _(i):
    return web.ga_user_id_decode(web.ga_data_set(sessions(i), 1, 1), i["calendar"])


@query("ga_page_path", f"""
SELECT {CLIENT} AS user_id, host AS hostname, path AS page_path, title AS page_title, COUNT(*) AS hits_count, day AS data_date
FROM hits WHERE {TENANT_HIT} AND path IS NOT NULL AND path <> '/about' GROUP BY user_id, host, path, title, day""", {"hits": HITS})
def _(i):
    return web.ga_page_path(sessions(i), 1, 1)


@query("ga_firebase_page", """
SELECT DISTINCT user_id, concat('Screen', event_id % 6) AS page_title, CAST(ts AS DATE) AS data_date
FROM events WHERE event_id % 10 <> 0""")
def _(i):
    param = "named_struct('key', '{0}', 'value', named_struct('string_value', {1}))"
    params = f"array({param.format('firebase_screen_class', 'concat(\"Screen\", event_id % 6)')}, {param.format('other', '\"x\"')})"
    events = i["events"].select(
        F.expr("CASE WHEN event_id % 10 = 0 THEN 'anon' ELSE CAST(user_id AS STRING) END").alias("user_id"),
        F.date_format("ts", "yyyyMMdd").alias("event_date"), F.expr(params).alias("event_params"))
    return web.ga_firebase_page(events)
