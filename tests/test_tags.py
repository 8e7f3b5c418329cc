from datetime import date, datetime, timedelta

import pytest

from tagloom.operators import tags

AS_OF = date(2024, 1, 30)
REGISTERED = date(2023, 1, 1)
BET = "hall_id int, domain_id int, user_id long, user_name string, register_date date, lobby_group int, lobby int, game_type string, data_date date, wagers_total long, commissionable long, payoff long"
DEPOSIT = "hall_id int, domain_id int, user_id long, user_name string, register_date date, deposit_amount long, deposit_count long, data_date date"


def bets(spark, rows):
    """(user, days before the date, turnover, payoff[, lobby group[, lobby]])"""
    full = []
    for r in rows:
        user, ago, turnover, payoff, group, lobby = (*r, 1, 1)[:6] if len(r) < 6 else r
        full.append((1, 1, user, f"u{user}", REGISTERED, group, lobby, "G1", AS_OF - timedelta(days=ago), 1, turnover, payoff))
    return spark.createDataFrame(full, BET)


def deposits(spark, rows):
    return spark.createDataFrame(
        [(1, 1, u, f"u{u}", REGISTERED, amount, count, AS_OF - timedelta(days=ago)) for u, ago, amount, count in rows], DEPOSIT)


def members(spark, ids, registered=REGISTERED, agent="ag", kind="date"):
    return spark.createDataFrame(
        [(1, 1, u, f"u{u}", agent, registered) for u in ids],
        f"hall_id int, domain_id int, user_id long, user_name string, ag_name string, register_date {kind}")


def codes(df):
    return {r.user_id: r.tag_code for r in df.collect()}


def users(df):
    return sorted(r.user_id for r in df.collect())


def test_churned_boundaries(spark):
    login = spark.createDataFrame(
        [(1, 1, u, AS_OF - timedelta(days=ago)) for u, ago in [(1, 29), (2, 30), (3, 31), (4, 32), (5, 31), (5, 2)]],
        "hall_id int, domain_id int, user_id long, data_date date")
    got = {r.user_id: r.tag_enabled for r in tags.tag_churned(login, members(spark, range(1, 6)), AS_OF).collect()}
    assert got == {1: False, 2: True, 3: True, 5: False}


def test_churned_needs_an_agent(spark):
    login = spark.createDataFrame([(1, 1, 1, AS_OF)], "hall_id int, domain_id int, user_id long, data_date date")
    assert users(tags.tag_churned(login, members(spark, [1], agent=None), AS_OF)) == []


def days3(user, turnover, payoff):
    return [(user, 0, turnover, payoff), (user, 1, 0, 0), (user, 2, 0, 0)]


def test_huge_winner_and_loser_are_strict(spark):
    df = bets(spark, days3(1, 100, 50) + days3(2, 100, 51) + days3(3, 100, -50) + days3(4, 100, -51) + [(5, 0, 100, 99), (5, 1, 1, 1)])
    assert users(tags.tag_huge_winner(df)) == [2]
    assert users(tags.tag_huge_loser(df)) == [4]


def test_frequent_loser_counts_zero_as_win(spark):
    df = bets(spark, [(1, 0, 100, -9), (1, 1, 100, -9), (1, 2, 100, 0)] + [(2, 0, 100, -90), (2, 1, 100, 0), (2, 2, 100, 0)]
              + [(3, 0, 100, -5), (3, 1, 100, -5), (3, 2, 100, -5)])
    assert users(tags.tag_frequent_loser(df)) == [1]


def test_game_lover_tie_and_unlisted_group(spark):
    df = bets(spark, [(1, d, 10, 0, g, 1) for d in range(3) for g in (2, 5)] + [(2, d, 10, 0, 4, 1) for d in range(3)])
    assert codes(tags.tag_game_lover(df)) == {1: 30010, 2: 0}


def test_reaction_tie_takes_the_latest_class(spark):
    # won, then more; then lost, then less: one of each, the latter last
    df = bets(spark, [(1, 4, 100, 10), (1, 3, 200, -10), (1, 2, 100, 0), (1, 1, 100, 5)])
    assert codes(tags.tag_win_lose_reaction(df)) == {1: 30007}


def test_members_without_registration_form_no_group(spark):
    from pyspark.sql import functions as F
    df = bets(spark, days3(1, 100, 90)).withColumn("register_date", F.lit(None).cast("date"))
    assert users(tags.tag_huge_winner(df)) == []


def test_continuous_deposit_needs_exactly_three_rows(spark):
    df = deposits(spark, [(1, d, 10, 1) for d in range(3)] + [(2, 0, 10, 1), (2, 1, 10, 1)]
                  + [(3, d, 10, 1) for d in range(1, 4)] + [(4, 0, 10, 1), (4, 1, 10, 1), (4, 2, 10, 1), (4, 2, 20, 1)])
    assert users(tags.tag_continuous_deposit(df, AS_OF)) == [1]


def test_average_deposit_band(spark):
    df = deposits(spark, [(1, 0, 20000, 2), (1, 5, 900000, 1), (2, 0, 19999, 2), (3, 0, 600000, 3), (4, 0, 1, 0)])
    assert codes(tags.tag_avg_deposit_band(df)) == {1: 30069, 3: 30073, 4: 30073}


def test_max_bet_band_is_per_row(spark):
    df = bets(spark, [(1, 0, 9999, 0), (1, 1, 9999, 0), (2, 0, 50000, 0), (3, 0, 2000000, 0)])
    assert codes(tags.tag_max_bet_band(df)) == {2: 30075, 3: 30078}


def test_turnover_drop_ignores_members_without_bets_this_week(spark):
    df = bets(spark, [(1, 13, 3000000, 0), (1, 6, 1000000, 0), (2, 7, 5000000, 0), (3, 14, 5000000, 0), (3, 0, 1, 0)])
    assert codes(tags.tag_turnover_drop_band(df, AS_OF)) == {1: 30080}


def test_arbitrage_needs_both_sides(spark):
    df = bets(spark, [(1, 0, 19, 0), (2, 0, 20, 0), (3, 0, 1, 0)])
    paid = deposits(spark, [(1, 0, 10, 1), (2, 0, 10, 1), (4, 0, 10, 1)])
    assert users(tags.tag_arbitrage_suspect(df, paid)) == [1]


@pytest.mark.parametrize("age, code", [(29, 30093), (30, 30094), (89, 30094), (90, 30095), (179, 30095), (180, 30096)])
def test_term_boundaries(spark, age, code):
    from pyspark.sql import functions as F
    today = date(2024, 1, 31)
    df = bets(spark, [(1, 0, 5, 0)]).withColumn("register_date", F.lit(today - timedelta(days=age)))
    assert codes(tags.tag_term(df, today)) == {1: code}


def test_term_counts_part_days(spark):
    from pyspark.sql import functions as F
    registered = datetime(2024, 1, 1, 10)
    df = bets(spark, [(1, 0, 5, 0)]).withColumn("register_date", F.lit(registered).cast("timestamp_ntz"))
    assert codes(tags.tag_term(df, date(2024, 1, 31))) == {1: 30093}


def test_good_customer_takes_busier_half_rounded_up(spark):
    from pyspark.sql import functions as F
    rows = [(1, 0, 100, -50, 1, lobby) for lobby in (1, 2, 3)]
    df = bets(spark, rows).withColumn("wagers_total", F.col("lobby").cast("long"))
    assert sorted(r.lobby for r in tags.bite_games(df).collect()) == [2, 3]


def test_bite_rate_boundary(spark):
    df = bets(spark, [(1, 0, 1000, -2, 1, 1), (1, 0, 1000, -1, 2, 1)])
    assert [r.lobby_group for r in tags.bite_games(df).collect()] == [1]


def test_hedge_disables_likely_where_certain(spark):
    info = spark.createDataFrame(
        [(1, 1, 1, 19, 49, AS_OF), (1, 1, 2, 19, 50, AS_OF), (1, 1, 3, 19, 10, AS_OF), (1, 1, 3, 19, 70, AS_OF), (1, 1, 4, 20, 70, AS_OF)],
        "hall_id int, domain_id int, user_id long, external_game_code int, hedge_round_count int, data_date date")
    got = {(r.user_id, r.tag_code): r.tag_enabled
           for r in tags.tag_hedge_arbitrage(info, members(spark, range(1, 5)), AS_OF, 40006, 40007).collect()}
    assert got == {(1, 40006): True, (2, 40007): True, (3, 40006): False, (3, 40007): True}


def test_hesitate_last_logins_after_last_action(spark):
    login_raw = spark.createDataFrame(
        [(1, 1, u, AS_OF - timedelta(days=d), 1) for u in (1, 2) for d in range(7)],
        "hall_id int, domain_id int, user_id long, data_date date, result int")
    login = spark.createDataFrame([], "hall_id int, domain_id int, user_id long, data_date date, login_count long")
    page = spark.createDataFrame([], "hall_id int, domain_id int, user_id long, data_date date, page_path string")
    paid = deposits(spark, [(1, 4, 10, 1), (2, 3, 10, 1)])
    bet = bets(spark, [(1, 4, 10, 0), (2, 9, 10, 0)])
    got = tags.tag_hesitate(login, login_raw, paid, bet, page, members(spark, [1, 2]), AS_OF)
    assert users(got) == [1]


def test_manual_edit_tie_takes_larger_type(spark):
    at = datetime(2024, 1, 1)
    edits = spark.createDataFrame(
        [(1, 1, 1, 30015, 1, at), (1, 1, 1, 30015, 2, at), (1, 1, 2, 30015, 2, at), (1, 1, 2, 30015, 1, at + timedelta(1)),
         (1, 1, 3, 30015, 7, at)],
        "hall_id int, domain_id int, user_id long, tag_code int, edit_type int, updated_time timestamp_ntz")
    assert {r.user_id: r.tag_enabled for r in tags.tag_manual_edits(edits, [30015]).collect()} == {1: False, 2: True, 3: None}


def test_upload_of_masked_members_uses_latest_line(spark):
    upload = spark.createDataFrame(
        [("anna", "2024/1/5", 1), ("anne", "2024-1-6", 0), ("bob", "2024/01/01", 1), ("bob", "2024/01/01", 0)],
        "n string, d string, e int")
    masked = spark.createDataFrame(
        [(1, 1, 1, "ann*****", REGISTERED), (1, 1, 2, "ann*****", REGISTERED), (1, 1, 3, "bob*****", REGISTERED), (1, 1, 4, None, REGISTERED)],
        "hall_id int, domain_id int, user_id long, user_name string, register_date date")
    got = tags.custom_upload_tags(upload, masked, 40032, {"hall_id": 1, "domain_id": 1}, masked=True).collect()
    assert {(r.user_id, r.tag_type): r.tag_enabled for r in got} == {(1, 4): False, (2, 4): False, (3, 4): True}
    assert tuple(tags.custom_upload_counts(upload).first()) == (2, 2)
