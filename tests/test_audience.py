import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tagloom.operators import audience
from tagloom.operators.keyed import equal_parts
from tables import rows

KEY = "hall_id int, domain_id int, user_id long"


def people(spark, ids):
    return spark.createDataFrame([(1, 1, i) for i in ids], KEY)


def groups(spark, counts):
    return spark.createDataFrame(list(counts.items()), "group_id int, group_count long")


@pytest.mark.parametrize("n", [1, 4, 5, 6, 99, 1000])
def test_split_sizes_are_exact_and_stable(spark, n):
    users = people(spark, range(n))
    split = audience.ab_split(users, groups(spark, {}), seed=3)
    sizes = {r.group_id: r["count"] for r in split.groupBy("group_id").count().collect()}
    assert sizes.get(2, 0) == math.ceil(0.2 * n) and sum(sizes.values()) == n
    assert rows(split) == rows(audience.ab_split(users.repartition(7), groups(spark, {}), seed=3))


def test_few_new_members_follow_the_balance(spark):
    users = people(spark, range(4))
    only = lambda counts: {r.group_id for r in audience.ab_split(users, groups(spark, counts)).collect()}
    assert only({1: 80, 2: 20}) == {2}
    assert only({1: 79, 2: 21}) == {1}
    assert only({1: 10}) == {2}


def test_diff_partitions_the_union(spark):
    matched, tagged = people(spark, [1, 2, 2, 3]), people(spark, [3, 4, 4])
    got = {(r.user_id, r.change) for r in audience.audience_diff(matched, tagged).collect()}
    assert got == {(1, "new"), (2, "new"), (3, "repeat"), (4, "delete")}
    assert audience.audience_diff(matched, tagged).count() == 4


def test_batch_grammar(spark):
    dw = spark.createDataFrame(
        [(1, 1, 1, "a", 5, "30011,30021", date(2024, 1, 5)), (1, 1, 2, "a", 6, "30011", date(2024, 1, 6)),
         (1, 1, 3, "b", 5, "30012,40001", date(2024, 1, 7)), (1, 1, 4, "b", 7, None, None)],
        f"{KEY}, ag_name string, user_level_id int, tag_str string, last_activated_date date")
    match = lambda **b: sorted(r.user_id for r in audience.match_users(dw, b).collect())
    assert match() == [1, 2, 3, 4]
    assert match(ag_name="a") == [1, 2]
    assert match(user_level_id="5;7") == [1, 3, 4]
    assert match(user_level_exclude="5,7") == [2]
    assert match(tag_str="30011,30021;30012") == [1, 3]
    assert match(tag_str_exclude="30021;40001,30999") == [2]
    assert match(activated_date_begin=date(2024, 1, 5), activated_date_end=date(2024, 1, 6)) == [1, 2]
    counts = audience.batch_match_counts(dw, [{"batch_id": 1, "tag_str": "30011"}, {"batch_id": 2}])
    assert rows(counts) == [(1, 2), (2, 4)]


def test_activity_bands_are_closed_and_do_not_repeat_members(spark):
    scores = spark.createDataFrame([(1, 1, 1, date(2024, 1, 25), 0.17), (1, 1, 2, date(2024, 1, 25), 0.99)],
                                   f"{KEY}, data_date date, action_score double")
    got = audience.match_by_activity(people(spark, [1, 2]), scores, [0, 1], date(2024, 1, 31))
    assert [r.user_id for r in got.collect()] == [1]


def test_type_one_batches_follow_the_tenant_day(spark):
    batches = spark.createDataFrame(
        [(1, 2, True, None, None), (2, 1, True, date(2024, 1, 30), date(2024, 1, 30)), (3, 1, True, date(2024, 1, 31), None),
         (4, 2, False, None, None)],
        "batch_id int, sync_date_type int, tag_enabled boolean, sync_date_begin date, sync_date_end date")
    # 03:00 UTC is still the 30th in New York
    assert [r.batch_id for r in audience.active_batches(batches, datetime(2024, 1, 31, 3)).collect()] == [1, 2]


def test_campaign_update_keeps_its_id(spark):
    stored = spark.createDataFrame([(1, 1, 7, "old")], "hall_id int, domain_id int, activity_id int, activity_name string")
    given = {"hall_id": 1, "domain_id": 1, "activity_name": "new"}
    assert rows(audience.campaign_header(stored, {**given, "activity_id": 7})) == [(1, 1, 7, "new")]
    assert rows(audience.campaign_header(stored, given)) == [(1, 1, 7, "old"), (1, 1, 8, "new")]


def test_player_defaults_and_astral_characters(spark):
    text = '{"id": 5, "alias": "a\\ud83d\\ude00b", "last_login": "2024-01-01T10:00:00+0800", "blacklist": [1, 2]}'
    row = audience.parse_player_list(spark.createDataFrame([(text,)], "json string")).first()
    assert (row.id, row.alias, row.last_login, row.blacklist, row.username, row.gender, row.balance) == (
        5, "ab", "2023-12-31 22:00:00", "1,2", "", 0, 0.0)
    assert row.created_at is None and row.upper_username is None


def test_group_state_mode_two_removes_stale(spark):
    schema = "hall_id int, domain_id int, batch_id int, tag_id int, tag_name string, user_id long, group_id int, latest_tag boolean"
    group = spark.createDataFrame([(1, 1, 9, 3, "t", u, 1, True) for u in (1, 2)] + [(1, 1, 8, 3, "t", 1, 1, True)], schema)
    new = people(spark, [3]).withColumn("group_id", F.lit(2))
    batch = {"batch_id": 9, "tag_id": 3, "tag_name": "t"}
    after = audience.sync_group_state(group, new, people(spark, [2, 3]), batch, 2)
    assert {(r.batch_id, r.user_id): r.latest_tag for r in after.collect()} == {(9, 2): False, (9, 3): True, (8, 1): True}


@pytest.mark.parametrize("n, parts", [(10, 3), (7, 7), (3, 5), (1000, 6)])
def test_equal_parts_differ_by_one_at_most(spark, n, parts):
    split = equal_parts(people(spark, range(n)), ["hall_id", "domain_id", "user_id"], "user_id", parts)
    sizes = [r["count"] for r in split.groupBy("part").count().collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and max(sizes) == math.ceil(n / parts)
