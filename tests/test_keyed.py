from datetime import date

from pyspark.sql import functions as F

from tagloom.operators import facts, keyed, tags, warehouse
from tagloom.sources.sinks import materialise
from tables import rows


def skewed_facts(spark, n=3000):
    """A third of the rows on key 1, a third without key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"),
        F.col("id").alias("v"))


def test_no_key_is_hot_below_the_rows_of_a_task(spark):
    assert keyed.hot_keys(skewed_facts(spark), ["k"]) is None


def test_hot_keys_are_found_and_spread(skewed):
    hot = keyed.hot_keys(skewed_facts(skewed), ["k"], 30)
    assert rows(hot) == sorted([(1, 34), (None, 34)], key=repr)
    spread = keyed.spread_hot(skewed_facts(skewed), ["k"], hot).groupBy("k").agg(F.countDistinct("_salt").alias("s"))
    assert {r.k: r.s for r in spread.collect() if r.s > 1} == {1: 34, None: 34}


def test_hot_list_is_bounded(skewed):
    even = skewed.range(200).select(F.col("id").alias("k"))
    assert keyed.hot_keys(even, ["k"], 1) is None
    assert keyed.hot_keys(even.unionAll(even), ["k"], 1).count() == 200


def test_hot_key_join_equals_plain_join(skewed):
    facts = skewed_facts(skewed)
    dim = skewed.range(2500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(keyed.hot_key_join(facts, dim, ["k"], how)) == rows(facts.join(dim, ["k"], how))


def test_salted_join_equals_plain_join(skewed):
    facts = skewed_facts(skewed)
    dim = skewed.range(2500).select(F.col("id").alias("k"), (F.col("id") % 5).alias("x"))
    for how in ("inner", "left", "left_semi"):
        assert rows(keyed.salted_join(facts, dim, ["k"], how)) == rows(facts.join(dim, ["k"], how))
    near = keyed.salted_join(facts, dim, ["k"], "left", condition=lambda d: (F.col("v") % 5) == d("x"))
    joined = facts.join(dim.withColumnRenamed("k", "dk"), (F.col("k") == F.col("dk")) & (F.col("v") % 5 == F.col("x")), "left")
    assert rows(near) == rows(joined.drop("dk"))


def test_best_by_group_breaks_ties_by_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, None, "z"), (2, None, "n")], "k int, v int, s string")
    assert rows(keyed.best_by_group(df, ["k"], [F.col("v"), F.col("s")], ["s"])) == [(1, "b"), (2, "n")]


def test_top_k_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 4).alias("k"), F.col("id").alias("v"))
    top = keyed.latest_with_ties(df, ["k"], "v")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert rows(top) == [(0, 96), (1, 97), (2, 98), (3, 99)]


def test_run_length_dedup_keeps_last_of_run(spark):
    data = [(1, 1, 7), (1, 2, 7), (1, 3, None), (1, 4, None), (1, 5, 7), (2, 1, 7)]
    df = spark.createDataFrame(data, "k int, t int, c int")
    assert rows(keyed.run_length_dedup(df, ["k"], "t", "c")) == sorted([(1, 2, 7), (1, 4, None), (1, 5, 7), (2, 1, 7)], key=repr)


def test_latest_with_ties_keeps_all_copies(skewed):
    rows_in = [(1, 5, "x")] * 40 + [(1, 4, "y")] * 40 + [(2, 1, "z"), (None, 3, "n"), (None, 3, "n")]
    df = skewed.createDataFrame(rows_in, "k int, v int, s string").repartition(6)
    got = keyed.latest_with_ties(df, ["k"], "v").groupBy("k", "v", "s").count()
    assert {(r.k, r.v, r.s): r["count"] for r in got.collect()} == {(1, 5, "x"): 40, (2, 1, "z"): 1, (None, 3, "n"): 2}


def test_copies_of_one_row_are_spread(skewed):
    copies = skewed.range(4000, numPartitions=40).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    spread = keyed.spread_hot(copies, ["k"], keyed.hot_keys(copies, ["k"], 500))
    sizes = [r["count"] for r in spread.groupBy("_salt").count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 1600
    dim = skewed.createDataFrame([(1, "d")], "k int, d string")
    assert keyed.hot_key_join(copies, dim, ["k"]).count() == 4000


def test_salts_repeat_on_recomputation(skewed):
    facts = skewed_facts(skewed).repartition(8, "v")
    spread = keyed.spread_hot(facts, ["k"], keyed.hot_keys(facts, ["k"], 30))
    assert rows(spread) == rows(spread)


def test_latest_rows_are_not_repeated_without_hot_keys(spark):
    df = spark.range(50).select((F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    plan = keyed.latest_with_ties(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_points_find_the_range_that_holds_them(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that a range spans partitions
    try:
        ranges = [(0, 9, "a"), (20, 1 << 24, "b"), ((1 << 24) + 5, (1 << 24) + 5, "c")]
        points = [-3, 0, 9, 10, 19, 20, 21, 21, *range(30, 400), 1 << 23, 1 << 24, (1 << 24) + 1, (1 << 24) + 5, 1 << 40, None]
        df = spark.createDataFrame([(p,) for p in points], "p long").repartition(5)
        held = keyed.in_ranges(df, "p", spark.createDataFrame(ranges, "f long, t long, name string"), "f", "t", materialise)
        expected = sorted({(p, n) for p in points if p is not None for f, t, n in ranges if f <= p <= t})
        assert rows(held) == sorted(expected, key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows(keyed.in_ranges(df, "p", spark.createDataFrame([], "f long, t long, name string"), "f", "t", materialise)) == []


def test_growing_dimension_is_repeated_for_hot_keys_only(skewed, monkeypatch):
    facts = skewed_facts(skewed)
    dim = skewed.range(2500).select(F.col("id").alias("k"), (F.col("id") % 5).alias("x"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for most, broadcast in ((100_000, True), (2000, False)):
        monkeypatch.setattr(keyed, "MOST_BROADCAST", most)
        for how in ("inner", "left"):
            joined = keyed.dimension_join(facts, dim, ["k"], how)
            assert rows(joined) == rows(facts.join(dim, ["k"], how))
            assert ("strategy=merge" in plan(joined)) != broadcast
        near = keyed.dimension_join(facts, dim, ["k"], "left", lambda d: (F.col("v") % 5) == d("x"), counted=facts.unionAll(facts))
        joined = facts.join(dim.withColumnRenamed("k", "dk"), (F.col("k") == F.col("dk")) & (F.col("v") % 5 == F.col("x")), "left")
        assert rows(near) == rows(joined.drop("dk"))
    hot = keyed.hot_keys(facts, ["k"])
    assert keyed.repeat_hot(dim, ["k"], hot).count() == 2499 + 50


def test_dictionaries_are_not_repeated_over_the_shuffle_partitions(spark):
    """Vendors, games, promotions and tag names grow with the input; repeats are unseen by the size check of broadcasts."""
    users = spark.createDataFrame([(1, "a", 1, "l", 1)], "user_id long, parent_username string, level_id int, level_name string, role int")
    vendors = spark.createDataFrame([(1, "v", "v", "v")], "id long, tc_name string, sc_name string, en_name string")
    games = spark.createDataFrame(
        [(1, "G1", "a", "b", "c", 1)], "vendor_id long, game_code string, zh_tw_name string, zh_cn_name string, game_name string, kind int")
    wager = spark.createDataFrame([], """user_id long, parent_username string, lobby int, lobby_name string, lobby_group int,
        lobby_group_name string, game_code string, game_name string, kind int, device int, platform int, data_date date,
        financial_year int, financial_month int, financial_week int, level_id int, level_name string, wagers_total long, bet long,
        valid_bet long, payoff long, win_rate double""")
    lobbies = vendors.withColumnRenamed("id", "lobby")
    lobby_games = games.selectExpr(
        "vendor_id AS lobby", "game_code", "kind AS lobby_group", "zh_tw_name AS tc_name", "zh_cn_name AS sc_name", "game_name AS en_name")
    asked = spark.createDataFrame([], "user_id long, promotion_id long, data_date date, financial_year int, financial_month int, financial_week int")
    granted = spark.createDataFrame([], "user_id long, promotion_id long, premium_total long, premium_amount long, data_date date")
    promotions = spark.createDataFrame([(1, "p")], "promotion_id long, name string")
    bets = spark.createDataFrame([], """hall_id int, domain_id int, user_id long, user_name string, register_date date, lobby int,
        lobby_group int, game_type string, data_date date, wagers_total long, commissionable long, payoff long""")
    flags = spark.createDataFrame([], "hall_id int, domain_id int, lobby int, game_type string, is_pvp boolean, is_pve boolean")
    money = spark.createDataFrame([], """hall_id int, domain_id int, user_id long, data_date date, deposit_amount long,
        deposit_count long, withdraw_amount long""")
    stored = spark.createDataFrame([], "hall_id int, domain_id int, user_id long, tag_code int, tag_enabled boolean, updated_time timestamp_ntz")
    members = spark.createDataFrame([], """hall_id int, domain_id int, user_id long, user_name string, ag_name string,
        user_level_id int, user_level string, register_date date""")
    names = spark.createDataFrame([(1, 1, 1, "n", "n", "n", True, "prod")], """hall_id int, domain_id int, tag_code int, tag_name string,
        tag_name_cn string, tag_name_en string, tag_enabled boolean, can_access_env string""")
    on = date(2024, 1, 30)
    repeated = "explode(sequence(0, 7"
    for found in (
        facts.game_dict(games, vendors), facts.game_dict_by_lobby(lobby_games, lobbies),
        facts.bet_analysis(wager, users, vendors, games, {0: "web"}, on, on),
        facts.bet_analysis_by_lobby(wager, lobbies, lobby_games, {0: "web"}, on, on),
        facts.offer_applicant(asked, promotions, granted, on, on),
        tags.tag_good_customer_v1(bets, flags, money, 1, on), tags.tag_good_customer(bets, money, 1, on),
    ):
        assert repeated not in found._jdf.queryExecution().logical().toString().lower()
    wide = warehouse.ods_to_dw(stored, members, names)._jdf.queryExecution().logical().toString().lower()
    assert wide.count(repeated) == 1  # the day of each tenant's latest update
