"""Expectations written by hand for syncs of several batches at once."""

from datetime import date, datetime

import pytest
from tables import rows

from tagloom.operators import sync
from tagloom.sources.sinks import materialise

KEY = "hall_id int, domain_id int, user_id long"
NOW, TODAY = datetime(2024, 1, 31, 6), date(2024, 1, 31)
BATCHES = (
    "hall_id int, domain_id int, batch_id int, tag_id int, tag_name string, mode int, ab_test boolean, ag_name string, tag_str string, "
    "file_name string, user_step int, user_activity string, deposit_predict_rate string, bet_amount_rank int, activated_date_begin date, "
    "activated_date_end date, activity boolean, activity_id int, sync_date_type int, sync_date_begin date, sync_date_end date, tag_enabled boolean, match_user_count long, "
    "actual_user_count long")
GROUPS = "hall_id int, domain_id int, batch_id int, tag_id int, tag_name string, user_id long, group_id int, latest_tag boolean"


def batch(hall, number, tag, mode=1, ab=True, **given):
    row = dict.fromkeys((c.split()[0] for c in BATCHES.split(", ")), None)
    return row | {
        "hall_id": hall, "domain_id": 1, "batch_id": number, "tag_id": tag, "tag_name": f"t{hall}{number}", "mode": mode, "ab_test": ab,
        "activity": False, "sync_date_type": 2, "tag_enabled": True, "match_user_count": 0, "actual_user_count": 0} | given


def tables(spark, groups=(), tagged=(), **other):
    """Members 10 to 15 of hall 1 and 20 to 25 of hall 2, named n10 ..., agent a, tags 30011 and, if odd, 30021."""
    ids = [(h, 1, 10 * h + k) for h in (1, 2) for k in range(6)]
    wide = [(*m, "a", 5, "30011,30021" if m[2] % 2 else "30011", date(2024, 1, 10)) for m in ids]
    made = {
        "dw": spark.createDataFrame(wide, f"{KEY}, ag_name string, user_level_id int, tag_str string, last_activated_date date"),
        "members": spark.createDataFrame([(*m, f"n{m[2]}") for m in ids], f"{KEY}, user_name string"),
        "uploads": spark.createDataFrame([], "file_name string, user_name string"),
        "steps": spark.createDataFrame([], f"{KEY}, this_day_step int, data_date date"),
        "activity": spark.createDataFrame([], f"{KEY}, data_date date, action_score double"),
        "predictions": spark.createDataFrame([], f"{KEY}, data_date date, recommend_code int, action_score double"),
        "bets": spark.createDataFrame([], f"{KEY}, data_date date, bet_amount long"),
        "groups": spark.createDataFrame(list(groups), GROUPS),
        "tagged": spark.createDataFrame(list(tagged), "hall_id int, domain_id int, tag_id int, user_id long"),
        "campaigns": spark.createDataFrame([(1, 1, 7, "old", 1)], "hall_id int, domain_id int, activity_id int, activity_name string, status int"),
        "campaign_members": spark.createDataFrame([(7, 1, 1, "n10"), (7, 1, 1, "n99")], "activity_id int, hall_id int, domain_id int, user_name string"),
    }
    return sync.SyncTables(**{**made, **other})


def run(spark, batches, t):
    return sync.sync_batches(spark.createDataFrame(batches, BATCHES), t, NOW, TODAY, materialise)


def matched(spark, t, *batches):
    found = sync.match_batches(spark.createDataFrame(list(batches), BATCHES), t, TODAY, materialise)
    return sorted((r.hall_id, r.batch_id, r.user_id) for r in found.collect())


def test_two_tenants_with_one_batch_number(spark):
    stored = [(1, 1, 1, 5, "x", 10, 1, True), (1, 1, 1, 5, "x", 99, 1, True), (2, 1, 1, 5, "x", 99, 1, True), (1, 1, 3, 5, "z", 99, 1, True)]
    done = run(spark, [batch(1, 1, 5, mode=2, ag_name="a"), batch(2, 1, 5, ag_name="a"), batch(1, 3, 5, mode=2, tag_enabled=False)],
               tables(spark, stored))
    assert rows(done.batches, "hall_id", "batch_id", "match_user_count") == [(1, 1, 6), (1, 3, 0), (2, 1, 6)]
    members = rows(done.groups, "hall_id", "batch_id", "user_id")
    assert members == sorted([(1, 1, u) for u in range(10, 16)] + [(1, 3, 99)] + [(2, 1, u) for u in [*range(20, 26), 99]], key=repr)
    sizes = {(r.hall_id, r.batch_id, r.group_id): r["count"] for r in done.groups.groupBy("hall_id", "batch_id", "group_id").count().collect()}
    assert sizes == {(1, 1, 1): 5, (1, 1, 2): 1, (1, 3, 1): 1, (2, 1, 1): 5, (2, 1, 2): 2}
    assert rows(done.groups.filter("user_id IN (10, 99)"), "hall_id", "batch_id", "latest_tag") == [(1, 1, False), (1, 3, True), (2, 1, False)]


@pytest.mark.parametrize("mode", [1, 2])
@pytest.mark.parametrize("ab", [True, False])
def test_a_batch_that_matches_nobody_changes_nothing(spark, mode, ab):
    stored, tagged = [(1, 1, 1, 5, "x", 10, 1, True)], [(1, 1, 5, 10)]
    given = batch(1, 1, 5, mode, ab, ag_name="nobody", activity=True, activity_id=7)
    t = tables(spark, stored, tagged)
    done = run(spark, [given], t)
    assert rows(done.groups, *t.groups.columns) == stored and rows(done.tagged) == tagged
    assert rows(done.batches) == [tuple(given.values())]
    assert rows(done.campaigns) == rows(t.campaigns) and rows(done.campaign_members) == rows(t.campaign_members)


def test_without_split_members_are_compared_with_the_tag(spark):
    stored = [(1, 1, 1, 5, "x", 10, 0, True), (1, 1, 1, 5, "x", 98, 0, True)]
    done = run(spark, [batch(1, 1, 5, 2, ab=False, tag_str="30011,30021")], tables(spark, stored, [(1, 1, 5, 11), (1, 1, 5, 97), (1, 1, 6, 97)]))
    assert rows(done.groups, "user_id", "group_id", "latest_tag") == [(13, 0, True), (15, 0, True)]  # 11 has the tag already
    assert rows(done.tagged, "tag_id", "user_id") == [(5, 11), (5, 13), (5, 15), (6, 97)]
    assert rows(done.batches, "match_user_count", "actual_user_count") == [(3, 3)]


def test_few_new_members_follow_the_balance_of_the_stored_groups(spark):
    stored = [(1, 1, 1, 5, "x", 100 + k, 1, True) for k in range(9)] + [(1, 1, 2, 5, "x", 100 + k, 1 + k % 2, True) for k in range(9)]
    done = run(spark, [batch(1, n, 5, ab=True, tag_str="30021") for n in (1, 2)], tables(spark, stored))
    new = done.groups.filter("user_id < 100")
    assert rows(new, "batch_id", "user_id", "group_id") == [(1, u, 2) for u in (11, 13, 15)] + [(2, u, 1) for u in (11, 13, 15)]
    assert rows(done.tagged, "user_id") == [(11,), (13,), (15,)]  # the test part is not tagged


def test_campaigns_follow_the_tagged_members(spark):
    new = [batch(1, 1, 5, 2, ab=False, tag_str="30021", activity=True, activity_id=7), batch(2, 1, None, ab=False, tag_str="30021", activity=True),
           batch(1, 2, None, ab=False, tag_str="30021", activity=True)]
    done = run(spark, new, tables(spark, [(1, 1, 1, 5, "x", 10, 0, True)]))
    assert rows(done.campaigns, "activity_id", "hall_id", "status") == [(7, 1, 1), (8, 1, 2), (9, 2, 2)]
    assert rows(done.campaign_members, "activity_id", "user_name") == (
        [(7, "n11"), (7, "n13"), (7, "n15"), (7, "n99")] + [(8, f"n{u}") for u in (11, 13, 15)] + [(9, f"n{u}") for u in (21, 23, 25)])
    assert rows(done.batches, "hall_id", "batch_id", "tag_id", "activity_id") == [(1, 1, 5, 7), (1, 2, 6, 8), (2, 1, 7, 9)]


def test_a_file_replaces_all_other_conditions(spark):
    names = spark.createDataFrame([("f", "n10"), ("f", "n20"), ("f", "n10"), ("g", "n11")], "file_name string, user_name string")
    t = tables(spark, uploads=names)
    assert matched(spark, t, batch(1, 1, 5, file_name="f", ag_name="nobody", user_step=4), batch(2, 1, 5, file_name="f")) == [(1, 1, 10), (2, 1, 20)]


def test_narrowing(spark):
    days = {"activated_date_begin": date(2024, 1, 5), "activated_date_end": date(2024, 1, 20)}
    t = tables(
        spark,
        steps=spark.createDataFrame([(1, 1, 10, 3, date(2024, 1, 29)), (1, 1, 11, 3, date(2024, 1, 28)), (2, 1, 20, 3, date(2024, 1, 29))],
                                    f"{KEY}, this_day_step int, data_date date"),
        activity=spark.createDataFrame(
            [(1, 1, 10, date(2024, 1, 25), 0.34), (1, 1, 11, date(2024, 1, 25), 0.2), (1, 1, 12, date(2024, 1, 25), 0.4),
             (1, 1, 13, date(2024, 1, 30), 0.4)], f"{KEY}, data_date date, action_score double"),
        predictions=spark.createDataFrame(
            [(1, 1, 10, date(2024, 1, 6), 50001, 0.4), (1, 1, 10, date(2024, 1, 7), 50001, 0.6), (1, 1, 11, date(2024, 1, 6), 50002, 0.5),
             (1, 1, 12, date(2024, 1, 21), 50001, 0.5)], f"{KEY}, data_date date, recommend_code int, action_score double"),
        bets=spark.createDataFrame([(1, 1, u, date(2024, 1, 6), 100 - u) for u in range(8, 16)] + [(2, 1, 21, date(2024, 1, 6), 1)],
                                   f"{KEY}, data_date date, bet_amount long"))
    assert matched(spark, t, batch(1, 1, 5, user_step=3), batch(2, 1, 5, user_step=4)) == [(1, 1, 10)]
    assert matched(spark, t, batch(1, 1, 5, user_activity="2,5"), batch(1, 2, 5, user_activity="1")) == [(1, 1, 10), (1, 1, 12), (1, 2, 10), (1, 2, 11)]
    assert matched(spark, t, batch(1, 1, 5, deposit_predict_rate="45;55", **days)) == [(1, 1, 10)]
    # 8 and 9 bet most but are not in the wide table
    assert matched(spark, t, batch(1, 1, 5, bet_amount_rank=4, **days), batch(2, 4, 5, bet_amount_rank=1, **days)) == [(1, 1, 10), (1, 1, 11), (2, 4, 21)]
    assert len(matched(spark, t, batch(1, 1, 5), batch(1, 2, 5, user_step=3))) == 7


def test_plan_does_not_grow_with_the_batches(spark):
    t = tables(spark)
    plan = lambda n: sync.match_batches(
        spark.createDataFrame([batch(1, k, 5, tag_str="30021") for k in range(n)], BATCHES), t, TODAY, materialise
    )._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert plan(1) == plan(40)


def test_counts_of_edited_batches_include_none(spark):
    given = [batch(1, 1, 5, tag_str="30021"), batch(1, 2, 5, tag_str="99999", match_user_count=4), batch(2, 1, 5, match_user_count=4),
             batch(2, 3, 5, tag_str="30021", bet_amount_rank=1)]
    times = {(1, 1): 30, (1, 2): 30, (2, 1): 20, (2, 3): 30}
    df = spark.createDataFrame(
        [(*b.values(), datetime(2024, 1, times[b["hall_id"], b["batch_id"]], 12), None) for b in given],
        f"{BATCHES}, operator_time timestamp_ntz, updated_time timestamp_ntz")
    found = sync.update_match_counts(df, tables(spark), NOW, TODAY, materialise)
    assert found.columns == df.columns
    assert rows(found, "hall_id", "batch_id", "match_user_count", "updated_time") == sorted(
        [(1, 1, 3, NOW), (1, 2, 0, NOW), (2, 1, 4, None), (2, 3, 3, NOW)], key=repr)
