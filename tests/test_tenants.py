"""Several tenants with different last dates and the same names, and rows that single-tenant inputs do not have."""

from datetime import date, datetime, timedelta
from decimal import Decimal

from tables import rows

from tagloom.operators import activity, audience, facts, lifecycle, masking, tags, warehouse, web

ONE, TWO = {"hall_id": 1, "domain_id": 1}, {"hall_id": 2, "domain_id": 1}
DAY = date(2024, 1, 20)


def test_lagging_tenant_keeps_its_rows(spark):
    schema = "hall_id int, domain_id int, user_id long, data_date date"
    state = spark.createDataFrame([(1, 1, 7, DAY), (2, 1, 8, DAY - timedelta(days=10))], schema).withColumn(
        "top_activate_date", activity.F.col("data_date"))
    new = spark.createDataFrame([
        (1, 1, 7, DAY), (1, 1, 7, DAY + timedelta(days=1)), (2, 1, 8, DAY - timedelta(days=5)),
        (2, 1, 8, DAY - timedelta(days=12)), (3, 1, 9, DAY - timedelta(days=40))], schema)
    found = rows(activity.advance_active_days(state, new), "hall_id", "data_date")
    assert found == sorted([
        (1, DAY), (1, DAY + timedelta(days=1)), (2, DAY - timedelta(days=10)), (2, DAY - timedelta(days=5)),
        (3, DAY - timedelta(days=40))], key=repr)


def test_wide_table_keeps_every_tenant(spark):
    def at(d):
        return datetime(2024, 1, d, 12)

    ods = spark.createDataFrame(
        [(1, 1, 7, 10, True, at(20)), (1, 1, 6, 10, True, at(10)), (2, 1, 7, 10, True, at(9)), (2, 1, 8, 10, True, at(2))],
        "hall_id int, domain_id int, user_id long, tag_code int, tag_enabled boolean, updated_time timestamp_ntz")
    members = spark.createDataFrame(
        [(h, 1, u, "n", "a", 1, "l", DAY) for h, u in ((1, 7), (1, 6), (2, 7), (2, 8))],
        "hall_id int, domain_id int, user_id long, user_name string, ag_name string, user_level_id int, user_level string, register_date date")
    dim = spark.createDataFrame(
        [(h, 1, 10, "t", "c", "e", True, "local,dev,prod") for h in (1, 2)],
        "hall_id int, domain_id int, tag_code int, tag_name string, tag_name_cn string, tag_name_en string, tag_enabled boolean, can_access_env string")
    assert rows(warehouse.ods_to_dw(ods, members, dim), "hall_id", "user_id") == [(1, 7), (2, 7)]


def test_last_dates_count_from_each_tenants_own_maximum(spark):
    dw = spark.createDataFrame(
        [(1, 1, 7, DAY, DAY), (2, 1, 8, date(2023, 6, 1), date(2023, 6, 1))],
        "hall_id int, domain_id int, user_id long, last_activated_date date, last_login_date date")
    facts_ = spark.createDataFrame(
        [(1, 1, 7, DAY), (1, 1, 7, date(2023, 5, 1)), (2, 1, 8, date(2023, 5, 1))],
        "hall_id int, domain_id int, user_id long, data_date date")
    found = rows(warehouse.dw_last_dates(facts_, facts_.limit(0), dw), "hall_id", "last_activated_date")
    assert found == sorted([(1, DAY), (2, date(2023, 5, 1))], key=repr)


def test_top_spenders_and_names_of_each_tenant(spark):
    users = spark.createDataFrame([(1, 1, 7), (1, 1, 6), (2, 1, 8)], "hall_id int, domain_id int, user_id long")
    bets = spark.createDataFrame(
        [(1, 1, 7, 50, DAY), (1, 1, 6, 40, DAY), (2, 1, 8, 1, DAY)],
        "hall_id int, domain_id int, user_id long, bet_amount long, data_date date")
    assert rows(audience.match_top_spenders(users, bets, 1, DAY, DAY)) == [(1, 1, 7), (2, 1, 8)]
    members = spark.createDataFrame(
        [(1, 1, 7, "ann", DAY), (2, 1, 8, "ann", DAY)],
        "hall_id int, domain_id int, user_id long, user_name string, register_date date")
    names = spark.createDataFrame([("ann", "2024-01-05", 1)], "user_name string, data_date string, enable int")
    assert rows(audience.match_uploaded_names(names, members, TWO)) == [(2, 1, 8)]
    assert rows(tags.custom_upload_tags(names, members, 40032, ONE), "user_id") == [(7,)]
    assert rows(tags.custom_upload_dates(names, members, 40032, TWO), "user_id") == [(8,)]
    wide = members.selectExpr("*", "'a' AS ag_name")
    assert rows(audience.match_users(wide, {"ag_name": "a", **TWO})) == [(2, 1, 8)]
    assert rows(audience.match_users(wide, {"ag_name": "a"})) == [(1, 1, 7), (2, 1, 8)]


FISCAL = "financial_year int, financial_month int, financial_week int"


def test_a_missing_fiscal_week_does_not_split_a_day(spark):
    offers = spark.createDataFrame([(7, DAY, 2024, 1, None, 10)], f"user_id long, data_date date, {FISCAL}, premium_amount long")
    wagers = spark.createDataFrame([(7, DAY, 2024, 1, None, 30)], f"user_id long, data_date date, {FISCAL}, payoff long")
    assert rows(facts.profit_loss(offers, wagers, DAY, DAY), "payoff", "premium_amount", "profit_loss") == [(30, 10, -40)]
    paid = spark.createDataFrame(
        [(7, DAY, 2024, 1, None, 1, 10, 1, 1)], f"user_id long, data_date date, {FISCAL}, status int, amount long, fee long, deposit_count long")
    out = spark.createDataFrame(
        [(7, DAY, 2024, 1, 3, 1, 4, 1, 1)], f"user_id long, data_date date, {FISCAL}, status int, real_amount long, fee long, withdraw_count long")
    users = spark.createDataFrame([(7, "ag", 1, "l")], "user_id long, parent_username string, level_id int, level_name string")
    found = facts.deposit_withdraw(paid, out, users, DAY, DAY)
    assert rows(found, "deposit_amount", "withdraw_amount", "financial_week") == [(10, 4, 3)]


def test_week_of_a_renamed_and_of_an_unnamed_member(spark):
    weeks = [(date(2024, 1, 8) + timedelta(days=d), 2024, 1, 2 + d // 7, date(2024, 1, 14) + timedelta(days=d // 7 * 7)) for d in range(14)]
    calendar = spark.createDataFrame(weeks, "date date, fin_year int, fin_month int, fin_week int, fin_week_end date")
    log = spark.createDataFrame(
        [(1, 1, 7, "old", 50102, 2024, 1, 3, datetime(2024, 1, 16)), (1, 1, 7, "new", 50106, 2024, 1, 3, datetime(2024, 1, 17)),
         (1, 1, 8, None, 50102, 2024, 1, 3, datetime(2024, 1, 16))],
        "hall_id int, domain_id int, user_id long, user_name string, tag_code int, fin_year int, fin_month int, fin_week int, created_time timestamp_ntz")
    before = spark.createDataFrame(
        [(1, 1, u, n, 1, 3, 50102, 50102, 50102, 2024, 1, 2, datetime(2024, 1, 9)) for u, n in ((7, "older"), (8, None))],
        "hall_id int, domain_id int, user_id long, user_name string, last_week_step int, this_week_step int, two_weeks_tag_code int, "
        "one_weeks_tag_code int, week_tag_code int, fin_year int, fin_month int, fin_week int, created_time timestamp_ntz")
    found = lifecycle.lifecycle_week(log, before, calendar, 2024, 1, 3).collect()
    assert sorted((r.user_id, r.user_name) for r in found) == [(7, "old"), (8, None)]
    alone = lifecycle.lifecycle_week(log, before.limit(0), calendar, 2024, 1, 3)
    assert alone.count() == len(found)


def test_amounts_keep_their_digits(spark):
    df = spark.createDataFrame([(Decimal("1.239"), 1.5, 7)], "balance decimal(10,3), payoff double, bet_amount long")
    got = masking.scale_amounts(df).first()
    assert (str(got.balance), got.payoff, str(got.bet_amount)) == ("0.01239", 0.015, "0.0700")


def test_a_certain_tag_stored_earlier_disables_a_likely_one(spark):
    members = spark.createDataFrame(
        [(1, 1, u, f"n{u}", DAY) for u in (7, 8, 9)], "hall_id int, domain_id int, user_id long, user_name string, register_date date")
    today = spark.createDataFrame(
        [(1, 1, 7, 19, 10, DAY), (1, 1, 8, 19, 10, DAY), (1, 1, 9, 19, 60, DAY)],
        "hall_id int, domain_id int, user_id long, external_game_code int, hedge_round_count int, data_date date")
    stored = spark.createDataFrame(
        [(1, 1, 7, 40007, True), (1, 1, 8, 40007, False), (1, 1, 9, 40006, True)],
        "hall_id int, domain_id int, user_id long, tag_code int, tag_enabled boolean")
    found = tags.tag_hedge_arbitrage(today, members, DAY, 40006, 40007, stored=stored)
    assert rows(found, "user_id", "tag_code", "tag_enabled") == [
        (7, 40006, False), (8, 40006, True), (9, 40006, False), (9, 40007, True)]


def test_totals_of_two_days_stay_apart(spark):
    hit = "named_struct('type', 'EVENT', 'eventInfo', named_struct('eventCategory', 'c', 'eventAction', 'a', 'eventLabel', 'l')," \
          " 'page', named_struct('hostname', 'h', 'pagePath', '/', 'pageTitle', 't')," \
          " 'customDimensions', array(named_struct('index', 4, 'value', '1'), named_struct('index', 15, 'value', '1')))"
    sessions = spark.sql(f"""
        SELECT 'abc' AS clientId, d AS date, CAST(1 AS BIGINT) AS visitNumber,
               named_struct('pageviews', CAST(v AS BIGINT), 'bounces', CAST(NULL AS BIGINT), 'timeOnSite', CAST(3 AS BIGINT)) AS totals,
               array({hit}, {hit}) AS hits FROM VALUES ('20240101', 5), ('20240102', 7) AS t(d, v)""")
    found = rows(web.ga_data_set(sessions, 1, 1), "data_date", "page_views", "total_sessions")
    assert found == [(date(2024, 1, 1), 5, 1), (date(2024, 1, 2), 7, 1)]
