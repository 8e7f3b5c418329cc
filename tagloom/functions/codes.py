"""Tag codes, bands and name lists of the rule set.

Fixed values: results are only comparable when these match the rule book, so
they are kept as plain text, in their natural order.
"""

TENANT_KEYS = ["hall_id", "domain_id"]
KEYS = [*TENANT_KEYS, "user_id"]
WHO = KEYS + ["user_name", "register_date"]
ODS_COLUMNS = KEYS + ["user_name", "tag_code", "tag_type", "tag_enabled", "register_date"]

RULE_TAG_TYPE = 3
HEDGE_TAG_TYPE = 4
NEVER = "1990-01-01"

# -- rule tag codes ---------------------------------------------------------
WIN_ADD, WIN_LEAVE, LOSE_ADD, LOSE_LEAVE = 30004, 30005, 30006, 30007
GAME_LOVER = {1: 30012, 2: 30013, 3: 30009, 5: 30010, 6: 30011}
GOOD_CUSTOMER = 30015
REPEAT_DEPOSIT = 30016
CHURNED = 30017
HUGE_WINNER = 30019
FREQUENT_LOSER = 30020
APP_USER = 30021
HUGE_LOSER = 30022
# weekday 1 = Sunday
BET_WEEKDAY = {1: 30029, 2: 30023, 3: 30024, 4: 30025, 5: 30026, 6: 30027, 7: 30028}
# hour h -> 30030 + h
BET_HOUR_BASE = 30030
ARBITRAGE_SUSPECT = 30054
LOGIN_UB = 30055
LOGIN_PC = 30056
CONTINUOUS_DEPOSIT = 30057
AVG_DEPOSIT_BANDS = {10000: 30069, 50000: 30070, 100000: 30071, 150000: 30072, 200000: 30073}
MAX_BET_BANDS = {10000: 30074, 50000: 30075, 100000: 30076, 500000: 30077, 1000000: 30078}
TURNOVER_DROP_BANDS = {
    1000000: 30079, 2000000: 30080, 3000000: 30081, 5000000: 30082,
    7000000: 30083, 9000000: 30084, 12000000: 30085, 15000000: 30086,
    20000000: 30087, 30000000: 30088, 40000000: 30089, 50000000: 30090,
}
HESITATE = 30091
CERTIFIED = 30092
# member age in days below which the code applies; None = everyone older
TERM = [(30, 30093), (90, 30094), (180, 30095), (None, 30096)]
# method code -> operation codes, or the name of an operation type
DEPOSIT_METHODS = {
    30200: "CD",
    30201: "CryptoD",
    30202: "MD",
    30203: [2096, 2097],
    30204: [2099, 2100],
    30205: [1039, 1040],
    30206: [2508, 2509],
    30207: [2525, 2526],
    30208: [2514, 2515],
}
BAD_CODES = [40001, 40006, 40007, 40008, 40009, 40010, 40011, 40012, 40013]
GOOD_CODES = [30015]
EXPORTED_EXTRA_CODES = [40006, 40007]

# -- lifecycle codes --------------------------------------------------------
ADDICT, NEW, ACTIVE = 50100, 50101, 50102
POTENTIAL, LEAVING, LOST, ARCHIVED = 50103, 50104, 50105, 50106
VISITOR, DORMANT_VISITOR = 50107, 50108

# -- game dictionary --------------------------------------------------------
VENDOR_KIND_WORDS = {"體育": 1, "視訊": 2, "電子": 3, "彩票": 4, "棋牌": 5, "麻將": 6}
KIND_NAMES = {1: "sport", 2: "live", 3: "prob", 4: "lottery", 5: "card", 6: "mahjong"}
LOBBY_GROUP_NAMES = {1: "sport", 2: "lottery", 3: "live", 5: "prob", 6: "card"}
PVP_WORDS = ["百家", "輪盤"]
PVE_WORDS = ["百家", "21", "二十一"]
SETTLEMENT_GAME = "settlement01"

# -- login ingress ----------------------------------------------------------
INGRESS_APP = [11, 12, 13, 14, 15, 16]
INGRESS_PC = [1]
INGRESS_UB = [7, 8]

# -- web sessions -----------------------------------------------------------
HALL_DIMENSION, DOMAIN_DIMENSION = 4, 15
PATH_WORDS_ANY_CASE = ["withdraw", "deposit", "login", "promotion"]
PATH_WORDS = ["gameLobby", "gameEntrance"]
PATHS = ["/", "/casino", "/card", "/lottery", "/live", "/sport"]
PATH_PREFIX = "/mobile/iframe/game"

# -- audience ---------------------------------------------------------------
ACTIVITY_BANDS = [(0.0, 0.17), (0.17, 0.34), (0.34, 0.51), (0.51, 0.68), (0.68, 0.85), (0.85, 1.0)]
DEPOSIT_PREDICTION_CODE = 50001

# -- column types of loaded tables --------------------------------------------
WHOLE_COLUMNS = [
    "hall_id", "domain_id", "user_id", "lobby", "lobby_group", "game_kind", "wagers_total", "user_level_id", "login_count",
    "deposit_count", "this_tag_code", "last_tag_code", "last_two_tag_code", "last_three_tag_code", "this_day_step",
    "last_day_step", "last_two_day_step", "id", "promotion_id",
]
TEXT_COLUMNS = ["user_name", "game_type", "ag_name", "host"]
AMOUNT_COLUMNS = ["balance", "deposit_amount", "bet_amount", "commissionable", "payoff", "amount"]
