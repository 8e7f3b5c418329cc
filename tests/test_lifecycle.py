import itertools
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tagloom.operators import lifecycle
from tagloom.sources.sinks import materialise
from tables import rows

CODES = [None, *range(50100, 50109)]


def day_step(last, this):
    """The rules as plain assignments, a later one overriding an earlier one."""
    step = 0
    if last == 50102 and this == 50102: step = 1
    if last in (None, 50107, 50108) and this in (50100, 50101, 50102): step = 2
    if last == 50100 and this == 50101: step = 2
    if last in (50100, 50101) and this == 50102: step = 3
    if last in (50103, 50104, 50105) and this in (50100, 50101, 50102): step = 4
    if last in (50105, 50106) and this in (50100, 50101, 50102): step = 5
    if last in (50100, 50101, 50102) and this in (50103, 50104, 50105): step = 6
    if last in (50103, 50104, 50105) and this == 50106: step = 7
    return step


def test_step_truth_table(spark):
    pairs = spark.createDataFrame(list(itertools.product(CODES, CODES)), "last int, this int")
    for r in pairs.withColumn("step", lifecycle.lifecycle_step(F.col("last"), F.col("this"))).collect():
        assert r.step == day_step(r.last, r.this), (r.last, r.this)


def test_week_rules_let_missing_history_match(spark):
    step = lambda first: spark.range(1).select(
        lifecycle.step_of(F.lit(None).cast("int"), F.lit(50102), lifecycle.WEEK_RULES, first)).first()[0]
    assert step(False) == 5 and step(True) == 1


ON = date(2024, 3, 31)


@pytest.mark.parametrize("activated_ago, deposits, wagers, visited_ago, code", [
    (14, 0, 0, 0, 50100), (14, 1, 1, 0, 50101), (14, 3, 1, 0, 50102), (14, 3, 0, 0, 50100),
    (15, 0, 0, 0, 50105), (15, 1, 1, 0, 50104), (15, 3, 1, 0, 50103), (15, 5, 0, 0, 50105),
    (60, 3, 1, 0, 50103), (61, 3, 1, 0, 50106), (61, 0, 1, 0, 50106), (61, 0, 0, 0, 50105),
    (None, 0, 0, 60, 50107), (None, 0, 0, 61, 50108),
])
def test_code_boundaries(spark, activated_ago, deposits, wagers, visited_ago, code):
    activated = date(1990, 1, 1) if activated_ago is None else ON - timedelta(days=activated_ago)
    got = spark.range(1).select(lifecycle.lifecycle_code(
        F.lit(ON), F.lit(activated), F.lit(ON - timedelta(days=visited_ago)), F.lit(deposits), F.lit(wagers))).first()[0]
    assert got == code


KEY = "hall_id int, domain_id int, user_id long"


def random_activity(spark, seed, users=25, first=date(2023, 11, 1), span=200):
    rng = random.Random(seed)
    login, paid, bet = [], [], []
    for u in range(users):
        for _ in range(rng.randrange(0, 7)):
            d = first + timedelta(days=rng.randrange(span))
            rng.choice([login.append, lambda r: paid.append((*r, 1, 10)), lambda r: bet.append((*r, 2))])((1, 1, u, d))
    members = [(1, 1, u, f"u{u}", first + timedelta(days=rng.randrange(120))) for u in range(users)]
    return (
        spark.createDataFrame(login, f"{KEY}, data_date date"),
        spark.createDataFrame(paid, f"{KEY}, data_date date, deposit_count long, deposit_amount long"),
        spark.createDataFrame(bet, f"{KEY}, data_date date, wagers_total long"),
        spark.createDataFrame(members, f"{KEY}, user_name string, register_date date"),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_change_log_replays_to_the_daily_codes(spark, seed):
    login, paid, bet, members = random_activity(spark, seed)
    start, end = date(2024, 3, 5), date(2024, 7, 20)  # everyone is registered by the start
    log = lifecycle.lifecycle_changes(login, paid, bet, members, start, end).collect()
    for on in (start, date(2024, 4, 1), date(2024, 5, 17), end):
        operate = lifecycle.user_operate(login, paid, bet, date(1990, 1, 1), on)
        snapshot = lifecycle.lifecycle_tag(lifecycle.lifecycle_members(members, date(1990, 1, 1), on), operate, on)
        replayed = {}
        for r in sorted(log, key=lambda r: r.data_date):
            if r.data_date <= on:
                replayed[r.user_id] = r.tag_code
        assert replayed == {r.user_id: r.tag_code for r in snapshot.collect()}


def test_split_range_continues_from_known_codes(spark):
    login, paid, bet, members = random_activity(spark, 3)
    start, middle, end = date(2024, 3, 5), date(2024, 5, 1), date(2024, 7, 1)
    whole = rows(lifecycle.lifecycle_changes(login, paid, bet, members, start, end))
    first = lifecycle.lifecycle_changes(login, paid, bet, members, start, middle)
    known = first.groupBy("hall_id", "domain_id", "user_id").agg(F.max_by("tag_code", "data_date").alias("tag_code"))
    second = lifecycle.lifecycle_changes(login, paid, bet, members, middle + timedelta(days=1), end, previous=known)
    assert sorted(rows(first) + rows(second), key=repr) == whole


def test_user_without_logins_gives_one_row(spark):
    login, paid, bet, _ = random_activity(spark, 4)
    operate = lifecycle.user_operate(login, paid, bet, date(1990, 1, 1), date(2024, 12, 31))
    assert operate.count() == operate.select("user_id").distinct().count()


def day_row(spark, history, on):
    log = spark.createDataFrame([(1, 1, 1, "u", on - timedelta(days=ago), code) for ago, code in history],
                                f"{KEY}, user_name string, data_date date, tag_code int")
    members = spark.createDataFrame([(1, 1, 1, "ag")], f"{KEY}, ag_name string")
    calendar = spark.createDataFrame([(on, 2024, 1, 2)], "date date, fin_year int, fin_month int, fin_week int")
    found = lifecycle.lifecycle_day(log, members, calendar, on).collect()
    return found[0] if found else None


def test_day_steps(spark):
    on = date(2024, 1, 20)
    fresh = day_row(spark, [(0, 50101)], on)
    assert (fresh.this_day_step, fresh.last_tag_code, fresh.init_flag, fresh.fin_week) == (2, 0, True, 2)
    # active since long ago: the looked-at days are all active, nothing starts
    steady = day_row(spark, [(30, 50101), (9, 50102)], on)
    assert (steady.this_day_step, steady.last_day_step, steady.last_two_day_step, steady.init_flag) == (1, 1, 1, False)
    # active since yesterday: first day of staying active
    second = day_row(spark, [(9, 50101), (1, 50102)], on)
    assert (second.this_day_step, second.last_day_step, second.init_flag) == (1, 3, True)
    # repeated codes form one run and unordered input does not matter
    repeated = day_row(spark, [(3, 50102), (9, 50101), (5, 50101)], on)
    assert (repeated.last_three_tag_code, repeated.this_day_step) == (50102, 1)
    assert day_row(spark, [(4, 50107)], on) is None


@pytest.mark.parametrize("seed", [3, 4])
def test_advancing_in_parts_equals_one_run(spark, seed):
    login, paid, bet, members = random_activity(spark, seed)
    start, end = date(2024, 1, 5), date(2024, 7, 20)
    facts = (login, paid, bet)
    whole = rows(lifecycle.lifecycle_changes(*facts, members, start, end))
    rng = random.Random(seed)
    cuts = sorted({start + timedelta(days=rng.randrange(190)) for _ in range(4)}) + [end]
    state, log, began = None, [], start
    for to in cuts:
        # rows of days that are done are gone, and rows of later days are there already
        new = facts if state is None else [df.filter(F.col("data_date") >= F.lit(began)) for df in facts]
        changes, state = lifecycle.advance_lifecycle(*new, members, start, to, state, materialise)
        log += rows(changes)
        again, same = lifecycle.advance_lifecycle(*facts, members, start, to, state, materialise)
        assert again is None and same is state
        began = to + timedelta(days=1)
    assert sorted(log, key=repr) == whole
    replayed = {r[2]: r[5] for r in sorted(whole, key=lambda r: r[4])}
    assert {r.user_id: r.tag_code for r in state.collect()} == replayed and len(replayed) == 25


def plain_last_codes(log, on):
    """Four latest runs of equal codes up to a day, each by its last row."""
    runs = []
    for d, code in sorted(log):
        if d <= on:
            if runs and runs[-1][1] == code:
                runs[-1] = (d, code)
            else:
                runs.append((d, code))
    runs = runs[::-1][:4]
    return [*runs, *[(None, None)] * (4 - len(runs))]


def test_intervals_replay_to_the_last_codes_of_each_day(spark):
    rng = random.Random(8)
    first, end = date(2024, 1, 1), date(2024, 2, 10)
    logs = {u: sorted({first + timedelta(days=rng.randrange(40)): rng.choice([50100, 50101, 50102]) for _ in range(rng.randrange(1, 14))}.items())
            for u in range(30)}
    df = spark.createDataFrame([(1, 1, u, f"n{u}", d, c) for u, log in logs.items() for d, c in log],
                               f"{KEY}, user_name string, data_date date, tag_code int")
    found = {}
    for r in lifecycle.change_intervals(df, end).collect():
        d = r.this_date
        while d <= r.until:
            assert (r.user_id, d) not in found
            found[r.user_id, d] = [(r[f"{n}_date"], r[f"{n}_tag_code"]) for n in lifecycle.NAMES]
            d += timedelta(days=1)
    expected = {(u, first + timedelta(days=k)): plain_last_codes(log, first + timedelta(days=k))
                for u, log in logs.items() for k in range(41) if first + timedelta(days=k) >= log[0][0]}
    assert found == expected


def test_days_of_a_range_equal_the_single_days(spark):
    rng = random.Random(5)
    log = spark.createDataFrame(
        [(1, 1, u, f"n{u}", date(2024, 1, 1) + timedelta(days=d), rng.choice([50102, 50102, 50101, 50104]))
         for u in range(25) for d in sorted(rng.sample(range(40), rng.randrange(1, 8)))],
        f"{KEY}, user_name string, data_date date, tag_code int")
    members = spark.createDataFrame([(1, 1, u, "a") for u in range(25)], f"{KEY}, ag_name string")
    calendar = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=d), 2024, 1, d // 7) for d in range(60)],
                                     "date date, fin_year int, fin_month int, fin_week int")
    days = [date(2024, 1, 28) + timedelta(days=k) for k in range(8)]
    single = [r for d in days for r in rows(lifecycle.lifecycle_day(log, members, calendar, d))]
    assert rows(lifecycle.lifecycle_days(log, members, calendar, days[0], days[-1])) == sorted(single, key=repr)
    assert len(single) > 20


def test_advancing_reads_the_facts_once(spark, tmp_path):
    login, paid, bet, members = random_activity(spark, 3)
    login.write.parquet(f"{tmp_path}/login")
    read, state = [], None

    def noted(df):
        read.append(any(f"{tmp_path}/login" in f for f in df.inputFiles()))
        return materialise(df)

    for end in (date(2024, 3, 1), date(2024, 7, 20)):
        _, state = lifecycle.advance_lifecycle(
            spark.read.parquet(f"{tmp_path}/login"), paid, bet, members, date(2024, 1, 5), end, state, noted)
    assert sum(read) == 2
