from datetime import datetime

from pyspark.sql import functions as F

from tagloom.operators import merge
from tagloom.operators.warehouse import apply_tag_batch
from tables import rows

TARGET = [(1, "a", 10), (2, "b", 20), (3, None, 30)]


def tables(spark):
    target = spark.createDataFrame(TARGET, "k int, s string, v int")
    source = spark.createDataFrame([(2, None), (4, 44)], "k int, v int")
    return target, source


def test_write_modes(spark):
    target, source = tables(spark)
    assert rows(merge.upsert(target, source, ["k"])) == sorted([(1, "a", 10), (2, "b", None), (3, None, 30), (4, None, 44)], key=repr)
    assert rows(merge.update(target, source, ["k"])) == sorted([(1, "a", 10), (2, "b", None), (3, None, 30)], key=repr)
    assert rows(merge.replace(target, source, ["k"])) == sorted([(1, "a", 10), (2, None, None), (3, None, 30), (4, None, 44)], key=repr)
    assert rows(merge.insert_ignore(target, source, ["k"])) == sorted([*TARGET, (4, None, 44)], key=repr)
    assert merge.insert(target, source).count() == 5
    assert rows(merge.delete_keys(target, source, ["k"])) == sorted([TARGET[0], TARGET[2]], key=repr)


def test_delete_range_is_closed_and_composite(spark):
    df = spark.createDataFrame([(a, b) for a in range(3) for b in range(3)], "a int, b int")
    left = merge.delete_key_range(df, ["a", "b"], [0, 2], [2, 0])
    assert rows(left) == [(0, 0), (0, 1), (2, 1), (2, 2)]


def test_conditions_with_null_do_not_match(spark):
    target, _ = tables(spark)
    assert rows(merge.update_where(target, F.col("s") == "a", {"v": F.lit(0)})) == sorted([(1, "a", 0), *TARGET[1:]], key=repr)
    assert rows(merge.delete_where(target, F.col("s") == "a")) == sorted(TARGET[1:], key=repr)


def test_tag_batch_is_idempotent(spark):
    schema = "hall_id int, domain_id int, user_id long, user_name string, tag_code int, tag_type int, tag_enabled boolean, register_date date, updated_time timestamp_ntz"
    old = datetime(2024, 1, 1)
    ods = spark.createDataFrame([
        (1, 1, 1, "a", 30019, 3, True, None, old), (1, 1, 2, "b", 30019, 3, True, None, old),
        (1, 1, 2, "b", 30017, 3, True, None, old)], schema)
    new = spark.createDataFrame([(1, 1, 1, "a", 30019, 3, True, None), (1, 1, 3, "c", 30019, 3, True, None)], schema.rsplit(",", 1)[0])
    now = datetime(2024, 1, 2)
    once = apply_tag_batch(ods, new, [30019], now)
    assert {(r.user_id, r.tag_code): r.tag_enabled for r in once.collect()} == {
        (1, 30019): True, (2, 30019): False, (2, 30017): True, (3, 30019): True}
    assert rows(apply_tag_batch(once, new, [30019], now)) == rows(once)


def test_batch_time_does_not_follow_the_session_zone(spark):
    schema = "hall_id int, domain_id int, user_id long, user_name string, tag_code int, tag_type int, tag_enabled boolean, register_date date"
    new = spark.createDataFrame([(1, 1, 1, "a", 30019, 3, True, None)], schema)
    ods = new.limit(0).withColumn("updated_time", F.lit(None).cast("timestamp_ntz"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert apply_tag_batch(ods, new, [], datetime(2024, 1, 2, 3)).first().updated_time == datetime(2024, 1, 2, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
