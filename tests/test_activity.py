import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tagloom.operators import activity
from tagloom.streaming.incremental import next_state, store_next_state
from tables import rows

FIRST = date(2024, 1, 1)


def facts(spark, seed=1, users=12, days=40, hot=False):
    rng = random.Random(seed)
    data = [(1, 1, u, FIRST + timedelta(days=d), rng.randrange(9)) for u in range(users) for d in range(days) if rng.random() < 0.6
            for _ in range(rng.randrange(1, 4))]
    if hot:
        data += [(1, 1, 99, FIRST + timedelta(days=rng.randrange(days)), rng.randrange(9)) for _ in range(len(data) // 2)]
    return spark.createDataFrame(data, "hall_id int, domain_id int, user_id long, data_date date, x int"), data


def brute(data, n):
    found = []
    for user in {r[2] for r in data}:
        mine = [r for r in data if r[2] == user]
        kept = sorted({r[3] for r in mine})[-n:]
        found += [(*r, kept[0]) for r in mine if r[3] >= kept[0]]
    return sorted(found, key=repr)


COLUMNS = ["hall_id", "domain_id", "user_id", "data_date", "x", "top_activate_date"]


def test_last_active_days(spark):
    df, data = facts(spark)
    assert rows(activity.last_n_active_days(df), *COLUMNS) == brute(data, 15)


def test_last_active_days_with_a_hot_member(skewed):
    df, data = facts(skewed, seed=2, hot=True)
    assert rows(activity.last_n_active_days(df), *COLUMNS) == brute(data, 15)


def test_advancing_day_by_day_equals_whole_history(spark, tmp_path):
    df, data = facts(spark, seed=3, days=24)
    current = None
    for step, day in enumerate([10, 17, 23]):
        seen = df.filter(F.col("data_date") <= F.lit(FIRST + timedelta(days=day)))
        following = f"{tmp_path}/state-{step}"
        store_next_state(spark, current, following, seen, n=5)
        current = following
    assert rows(spark.read.parquet(current), *COLUMNS) == brute(data, 5)


def test_late_rows_are_not_taken_up(spark):
    df, _ = facts(spark, seed=4)
    state = next_state(None, df)
    late = df.limit(5).withColumn("x", F.lit(1000))
    assert next_state(state, late).filter("x = 1000").count() == 0


def test_empty_state_takes_everything(spark):
    df, data = facts(spark, seed=5)
    empty = next_state(None, df.limit(0))
    assert rows(next_state(empty, df), *COLUMNS) == brute(data, 15)


def test_min_active_days_matches_user_id_only(spark):
    data = [(1, 1, 7, FIRST + timedelta(days=i)) for i in range(3)] + [(2, 1, 7, FIRST), (1, 1, 8, FIRST)]
    df = spark.createDataFrame(data, "hall_id int, domain_id int, user_id long, data_date date")
    assert sorted(r.user_id for r in activity.min_active_days(df).collect()) == [7, 7, 7, 7]
