"""Mergeable active-day states, and the profile against the single rules on odd members."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tables import rows

from tagloom.operators import activity, profile, rules
from tagloom.operators import tags as T
from tagloom.sources.sinks import materialise

DAY = date(2024, 1, 30)
KEY = "hall_id int, domain_id int, user_id long"


def facts(spark, seed, late):
    rng = random.Random(seed)
    data = [
        (1, 1, rng.randrange(5), rng.randrange(3), DAY - timedelta(days=rng.randrange(60 if late else 25)), rng.randrange(9))
        for _ in range(400)]
    return spark.createDataFrame(data, f"{KEY}, lobby int, data_date date, amount long")


def state(df):
    return activity.active_sums(df, ["lobby"], {"amount": "amount"}, n=6)


@pytest.mark.parametrize("seed", range(4))
def test_merged_states_equal_the_state_of_all_rows(spark, seed):
    a, b = facts(spark, seed, False), facts(spark, seed + 50, True)
    both = rows(state(a.union(b)))
    for x, y in ((a, b), (b, a)):
        assert rows(activity.merge_active_sums(state(x), state(y), ["lobby"], ["amount"], n=6)) == both
    assert len({r[4] for r in both}) <= 12


def test_rows_combine_below_the_first_exchange(spark):
    plan = state(facts(spark, 1, False))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "partial_sum" in below


def inputs(spark, bets, deposits, members):
    empty = lambda schema: spark.createDataFrame([], f"{KEY}, {schema}")
    return rules.RuleInputs(
        members=members, login=empty("host string, data_date date, login_count long"), login_raw=empty("result int, data_date date"),
        deposits=empty("data_date date, deposit_amount long, deposit_count long, withdraw_amount long, withdraw_count long"),
        ga_page=empty("page_path string, data_date date"), edits=empty("tag_code int, edit_type int, updated_time timestamp_ntz"),
        opcode_types=spark.createDataFrame([(7, "CD")], "opcode int, type string"),
        bets15=activity.bet_state(bets, members), deposits15=activity.deposit_state(deposits, members),
        bet_time15=empty("bet_hour int, data_date date, data_weekday int, commissionable long"),
        cash15=empty("opcode int, data_date date, amount long"))


def test_rules_of_the_profile_equal_the_single_rules(spark):
    rng = random.Random(9)
    bets = [
        (1 + u % 2, 1, u, rng.randrange(1, 7), rng.randrange(1, 4), f"g{rng.randrange(3)}", DAY - timedelta(days=rng.randrange(20)),
         rng.randrange(1, 5), 10, rng.choice([50, 100, 100, 700]), rng.choice([-400, -60, 0, 60, 400]))
        for u in range(60) for _ in range(rng.choice([1, 3, 12]))]
    bets = spark.createDataFrame(
        bets, f"{KEY}, lobby_group int, lobby int, game_type string, data_date date, wagers_total long, bet_amount long, commissionable long, payoff long")
    deposits = spark.createDataFrame(
        [(1 + u % 2, 1, u, DAY - timedelta(days=d), rng.choice([0, 90, 800]), 1 + d % 2) for u in range(0, 60, 2) for d in range(4)],
        f"{KEY}, data_date date, deposit_amount long, deposit_count long")
    members = spark.createDataFrame(
        [(1 + u % 2, 1, u, f"n{u}", None if u % 11 == 3 else DAY - timedelta(days=5 * u), None, u % 3, None) for u in range(60)],
        f"{KEY}, user_name string, register_date date, ag_name string, phone_confirm int, email_confirm int")
    i = inputs(spark, bets, deposits, members)
    bands = {100: 30069, 300: 30070}
    s = rules.RuleSettings(as_of=DAY, today=DAY, now=datetime(2024, 1, 31), good_customer_deposit=10, avg_deposit_bands=bands,
                           max_bet_bands={100: 30074, 500: 30075}, turnover_drop_bands={50: 30079, 400: 30080})
    single = T.union_tags([
        T.tag_good_customer(i.bets15, i.deposits, 10, DAY), T.tag_huge_winner(i.bets15), T.tag_huge_loser(i.bets15),
        T.tag_frequent_loser(i.bets15), T.tag_game_lover(i.bets15), T.tag_win_lose_reaction(i.bets15),
        T.tag_arbitrage_suspect(i.bets15, i.deposits15), T.tag_continuous_deposit(i.deposits15, DAY),
        T.tag_avg_deposit_band(i.deposits15, bands), T.tag_max_bet_band(i.bets15, s.max_bet_bands),
        T.tag_turnover_drop_band(i.bets15, DAY, s.turnover_drop_bands), T.tag_certified(members), T.tag_term(i.bets15, DAY)])
    found = materialise(profile.rule_tags(i, s))
    assert rows(found) == rows(single)
    assert found.select("tag_code").distinct().count() > 12 and found.filter("register_date IS NULL").count() > 0


def test_each_state_is_shuffled_once_and_members_join_once(spark):
    members = spark.createDataFrame([(1, 1, 1, "n", DAY, "a", 1, 1)], f"{KEY}, user_name string, register_date date, ag_name string, phone_confirm int, email_confirm int")
    bets = spark.createDataFrame(
        [(1, 1, 1, 1, 1, "g", DAY, 1, 1, 1, 1)],
        f"{KEY}, lobby_group int, lobby int, game_type string, data_date date, wagers_total long, bet_amount long, commissionable long, payoff long")
    deposits = spark.createDataFrame([(1, 1, 1, DAY, 5, 1)], f"{KEY}, data_date date, deposit_amount long, deposit_count long")
    i = inputs(spark, bets, deposits, members)
    stored = {"bets15": materialise(i.bets15), "deposits15": materialise(i.deposits15)}
    i = rules.RuleInputs(**{**i.__dict__, **stored})
    plan = profile.bet_profile(i.bets15, DAY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("hashpartitioning(hall_id") <= 3  # rows once, games twice
    assert profile.deposit_profile(i.deposits15, DAY)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
