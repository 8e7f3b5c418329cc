"""The hedge rule against stored tags, also of members without rounds on the day."""

from datetime import date

from tables import rows

from tagloom.operators import tags
from tagloom.plans import REGISTRY, run
from tagloom.plans.inputs import Inputs
from tagloom.plans.registry import AS_OF

DAY = date(2024, 1, 20)


def test_both_tags_stored_disable_the_likely_one_without_rounds_today(spark):
    members = spark.createDataFrame(
        [(h, 1, u, f"n{u}", DAY) for h, u in ((1, 7), (1, 8), (1, 9), (1, 10), (2, 8))],
        "hall_id int, domain_id int, user_id long, user_name string, register_date date")
    today = spark.createDataFrame(
        [(1, 1, 7, 19, 10, DAY)],
        "hall_id int, domain_id int, user_id long, external_game_code int, hedge_round_count int, data_date date")
    stored = spark.createDataFrame(
        [(1, 1, 7, 40006, False), (1, 1, 8, 40006, True), (1, 1, 8, 40007, True), (1, 1, 9, 40006, True), (1, 1, 9, 40007, False),
         (1, 1, 10, 40007, True), (2, 1, 8, 40006, True), (1, 1, 99, 40006, True), (1, 1, 99, 40007, True)],
        "hall_id int, domain_id int, user_id long, tag_code int, tag_enabled boolean")
    found = tags.tag_hedge_arbitrage(today, members, DAY, 40006, 40007, stored=stored)
    assert rows(found, "hall_id", "user_id", "tag_code", "tag_enabled") == [(1, 7, 40006, True), (1, 8, 40006, False)]


def test_registered_query_reads_stored_rows(spark):
    assert "hedge_stored" in REGISTRY["tag_hedge_arbitrage_stored"].sql
    folder = "/root/testdata/sf0.01"
    key = ["user_id", "tag_code"]
    i = Inputs(spark, folder)
    day_alone = tags.tag_hedge_arbitrage(i["arbitrage_info"], i["member_info"], AS_OF, 40006, 40007)
    today = {r[:2]: r[2] for r in rows(day_alone, *key, "tag_enabled")}
    whole = {r[:2]: r[2] for r in rows(run("tag_hedge_arbitrage_stored")(spark, folder), *key, "tag_enabled")}
    assert set(today) < set(whole)
    assert [k for k in today if today[k] and not whole[k]]  # a certain tag of an earlier day
    users = {u for u, _ in today}
    assert [k for k in whole if k not in today and k[0] in users]  # a stored likely one, a certain one today
    assert [k for k in whole if k[0] not in users]
