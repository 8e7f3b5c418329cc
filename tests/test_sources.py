import glob
import os
from datetime import date, datetime
from unittest.mock import Mock

import pytest
from pyspark.sql import functions as F

from tagloom.operators.merge import upsert
from tagloom.sources import ledger, sinks, tables, versions
from tables import rows


def test_append_checked_counts(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert sinks.append_checked(spark.range(5), path) == 5
    assert sinks.append_checked(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 8


def test_replace_days_keeps_other_days(spark, tmp_path):
    path = f"{tmp_path}/t"
    days = lambda d, n: spark.range(n).withColumn("data_date", F.lit(d).cast("date"))
    sinks.replace_days(days("2024-01-01", 4).union(days("2024-01-02", 5)), path)
    sinks.replace_days(days("2024-01-02", 1), path)
    got = spark.read.parquet(path).groupBy("data_date").count()
    assert rows(got) == [(date(2024, 1, 1), 4), (date(2024, 1, 2), 1)]


def test_latest_shard_steps_back(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.replace_days(spark.range(6).withColumn("data_date", F.expr("date_add(DATE'2024-01-01', CAST(id % 3 AS INT) * 10)")), path)
    shards = spark.read.parquet(path)
    assert {r.data_date for r in tables.latest_shard(shards, "data_date", date(2024, 1, 20)).collect()} == {date(2024, 1, 11)}


def test_upload_columns_are_positional(spark, tmp_path):
    (tmp_path / "u.csv").write_text("會員,日期,是否\nann,2024/1/5,1\nbob,2024-01-06,0\n", encoding="utf-8")
    assert rows(tables.read_upload(spark, str(tmp_path / "u.csv"))) == [("ann", "2024/1/5", 1), ("bob", "2024-01-06", 0)]


def test_family_of_tables_reads_as_one(spark, tmp_path):
    sinks.truncate_load(spark.range(2), f"{tmp_path}/a")
    sinks.truncate_load(spark.range(1).withColumn("x", F.lit("y")), f"{tmp_path}/b")
    assert rows(tables.read_matching(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])) == sorted([(0, None), (0, "y"), (1, None)], key=repr)


def test_materialise_reads_back_from_the_checkpoint_folder(spark):
    made = spark.range(3).withColumn("day", F.lit("2024-01-01").cast("date"))
    cut = sinks.materialise(made)
    assert cut.schema.simpleString() == made.schema.simpleString() and rows(cut) == rows(made)
    folder = spark.sparkContext.getCheckpointDir().split(":")[-1]
    assert all(folder in f for f in cut.inputFiles())


def test_scratch_tables_can_be_dropped_within_a_session(spark):
    sinks.drop_scratch(spark)
    cut = sinks.materialise(spark.range(3))
    files = [f.split(":")[-1] for f in cut.inputFiles()]
    assert all(os.path.exists(f) for f in files) and sinks.drop_scratch(spark) == 1
    assert not any(os.path.exists(f) for f in files) and sinks.drop_scratch(spark) == 0


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    session = Mock()
    session.sparkContext.master = "yarn"
    session.sparkContext.getCheckpointDir.return_value = None
    session.conf.get.return_value = None
    with pytest.raises(RuntimeError):
        sinks.checkpoint_folder(session)
    session.conf.get.return_value = "/shared/checkpoints"
    sinks.checkpoint_folder(session)
    session.sparkContext.setCheckpointDir.assert_called_once_with("/shared/checkpoints")


def test_a_failed_version_is_not_seen(spark, tmp_path):
    root = f"{tmp_path}/group"
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, root, "a")
    assert versions.publish({"a": spark.range(3), "b": spark.range(1)}, root) == 1
    broken = spark.range(100, numPartitions=8).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        versions.publish({"a": spark.range(50), "b": broken}, root)  # the first table is whole on disk
    assert versions.published_version(spark, root) == 1
    assert (versions.read_published(spark, root, "a").count(), versions.read_published(spark, root, "b").count()) == (3, 1)
    grown = versions.read_published(spark, root, "a").union(spark.range(4))  # computed from the version it replaces
    assert versions.publish({"a": grown, "b": spark.range(2)}, root) == 2
    assert (versions.read_published(spark, root, "a").count(), versions.read_published(spark, root, "a", 1).count()) == (7, 3)
    assert len(versions.drop_versions(spark, root, keep=1)) == 2  # the old version and the broken one
    assert versions.read_published(spark, root, "a").count() == 7


def test_of_two_writers_the_second_fails(spark, tmp_path):
    root = f"{tmp_path}/group"
    first = versions.publish({"a": spark.range(1)}, root)
    versions.publish({"a": spark.range(2)}, root, based_on=first)
    with pytest.raises(RuntimeError, match="another writer"):
        versions.publish({"a": spark.range(9)}, root, based_on=first)
    assert versions.read_published(spark, root, "a").count() == 2


def test_an_unfinished_marker_does_not_count(spark, tmp_path):
    root = f"{tmp_path}/group"
    versions.publish({"a": spark.range(1)}, root)
    (tmp_path / "group/_done/000000000002").touch()
    assert versions.published_version(spark, root) == 1
    versions.drop_versions(spark, root)
    assert versions.publish({"a": spark.range(5)}, root) == 2 and versions.read_published(spark, root, "a").count() == 5


def test_merge_reads_and_writes_the_partitions_of_its_source(spark, tmp_path):
    path = f"{tmp_path}/t"
    target = spark.range(60).select((F.col("id") % 6).cast("int").alias("hall_id"), F.col("id").alias("user_id"), F.lit("old").alias("name"))
    target.write.partitionBy("hall_id").parquet(path)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/hall_id=*/*.parquet")}
    new = spark.createDataFrame([(2, 2, "new"), (2, 999, "new"), (7, 1000, "new")], "hall_id int, user_id long, name string")
    scans = []

    def merge(old, source, keys):
        scans.append(old._jdf.queryExecution().executedPlan().toString())
        return upsert(old, source, keys)

    assert sinks.merge_partitions(new, path, ["hall_id", "user_id"], ["hall_id"], merge) == 2
    assert "PartitionFilters: [(" in scans[0] and "hall_id" in scans[0].split("PartitionFilters: [")[1].split("]")[0]
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/hall_id=*/*.parquet")}
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if "hall_id=2/" in f}
    got = spark.read.parquet(path)
    assert got.count() == 62 and rows(got.filter("name = 'new'"), "hall_id", "user_id") == [(2, 2), (2, 999), (7, 1000)]
    assert sinks.merge_partitions(new.limit(0), path, ["hall_id", "user_id"], ["hall_id"], merge) == 0


def test_a_late_shard_changes_exactly_its_days(spark):
    day = lambda d: date(2024, 1, d)
    rows_of = lambda *days: spark.createDataFrame([(day(d), v) for d, v in days], "data_date date, v long")
    built = []

    def build(df):
        built.append(sorted({r.data_date.day for r in df.collect()}))
        return df.groupBy("data_date").agg(F.sum("v").alias("v"))

    ledger_ = spark.createDataFrame([], ledger.LEDGER_SCHEMA)
    stored = spark.createDataFrame([], "data_date date, v long")
    runs = [rows_of((1, 1), (1, 2), (2, 5)), rows_of((1, 1), (1, 2), (2, 5), (3, 7)), rows_of((1, 1), (1, 2), (1, 10), (2, 5), (3, 7)), rows_of((3, 7), (3, 1))]
    for source in runs:
        done = ledger.run_shards(source, "data_date", ledger_, stored, build, datetime(2024, 2, 1), sinks.materialise)
        ledger_, stored = sinks.materialise(done.ledger), sinks.materialise(done.rows)
    assert built == [[1, 2], [3], [1], [3]]
    assert rows(stored) == [(day(1), 13), (day(2), 5), (day(3), 8)]  # shards that are gone stay as stored
    assert rows(ledger_, "shard", "row_count") == [(day(1), 3), (day(2), 1), (day(3), 2)]
    assert rows(ledger.shard_states(runs[-1], "data_date", ledger_), "shard", "state") == [(day(1), "gone"), (day(2), "gone"), (day(3), "done")]


def test_database_writes_keep_the_table(spark):
    df = Mock()
    sinks.write_jdbc(df, "jdbc:x", "t", truncate=True, user="u")
    writer = df.coalesce.return_value.write.format.return_value.options
    writer.assert_called_once_with(url="jdbc:x", dbtable="t", truncate="true", user="u")
    writer.return_value.mode.assert_called_once_with("overwrite")
