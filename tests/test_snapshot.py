import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from slicewright.session import FREE_SHUFFLES
from slicewright.sources import snapshot


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="snap-")


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, DivisionId int")


def now(spark, root, **how):
    return sorted(tuple(r) for r in snapshot.read_current(spark, root, **how).collect())


def test_untouched_divisions_are_not_rewritten(spark, root):
    first = snapshot.publish(spark, rows(spark, (1, 12), (2, 1), (3, None)), root)
    second = snapshot.publish(spark, rows(spark, (5, 12)), root, touched=(12,))
    assert (first.number, second.number) == (1, 2)
    assert second.folders["DivisionId=1"] == first.folders["DivisionId=1"]
    assert second.folders["DivisionId=12"] != first.folders["DivisionId=12"]
    assert now(spark, root, only=(1, 12)) == [(2, 1), (5, 12)]
    assert now(spark, root, without=(1, 12)) == [(3, None)]
    folder = f"{root}/{second.folders['DivisionId=12']}"
    assert not os.path.exists(os.path.join(os.path.dirname(folder), "DivisionId=1"))
    plan = snapshot.read_current(spark, root).filter("DivisionId = 12")._jdf.queryExecution().executedPlan().toString()
    assert "DivisionId" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_rows_outside_the_touched_divisions_are_refused(spark, root):
    snapshot.publish(spark, rows(spark, (1, 12), (2, 1)), root)
    with pytest.raises(ValueError):
        snapshot.publish(spark, rows(spark, (9, 1)), root, touched=(12,))
    assert now(spark, root) == [(1, 12), (2, 1)]


def test_a_stop_before_the_pointer_leaves_the_old_version(spark, root, monkeypatch):
    snapshot.publish(spark, rows(spark, (1, 12), (2, 1)), root)

    def stop(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(snapshot, "_point_to", stop)
        for _ in range(2):  # two dead attempts
            with pytest.raises(KeyboardInterrupt):
                snapshot.publish(spark, rows(spark, (7, 1), (8, 5)), root)
    assert now(spark, root) == [(1, 12), (2, 1)]
    snapshot.publish(spark, rows(spark, (3, 12)), root, touched=(12,))
    assert now(spark, root) == [(2, 1), (3, 12)]  # nothing of the dead attempts


def test_a_lost_pointer_is_an_error(spark, root):
    assert snapshot.read_current(spark, root) is None
    snapshot.publish(spark, rows(spark, (1, 12)), root)
    os.remove(f"{root}/_CURRENT")
    with pytest.raises(snapshot.LostPointerError):
        snapshot.read_current(spark, root)
    with pytest.raises(snapshot.LostPointerError):
        snapshot.publish(spark, rows(spark, (2, 12)), root)


def test_an_empty_version_keeps_its_schema(spark, root):
    snapshot.publish(spark, rows(spark, (1, 12)).limit(0), root)
    assert snapshot.read_current(spark, root).dtypes == [("k", "int"), ("DivisionId", "int")] and now(spark, root) == []
    snapshot.publish(spark, rows(spark, (1, 12)), root, touched=(12,))
    assert now(spark, root) == [(1, 12)]


def test_retention_removes_what_the_latest_versions_do_not_use(spark, root):
    snapshot.publish(spark, rows(spark, (1, 12), (2, 1)), root)
    for k in range(3):
        snapshot.publish(spark, rows(spark, (k, 12)), root, touched=(12,))
    assert len(os.listdir(f"{root}/data")) == 4
    gone = snapshot.retain(spark, root, versions=1)
    assert len(gone) == 2 and now(spark, root) == [(2, 1), (2, 12)]  # the first version's division 1 is still in use
    names = os.listdir(f"{root}/manifests")
    assert len([n for n in names if n.endswith(".json")]) == 1
    assert json.load(open(f"{root}/manifests/{[n for n in names if n.endswith('.json')][0]}"))["number"] == 4


def test_columns_may_be_called_like_a_folder(spark, tmp_path):
    rows = spark.createDataFrame([(12, "a"), (1, "b")], "DivisionId int, v string")
    snapshot.publish(spark, rows, f"{tmp_path}/t")
    assert sorted(map(tuple, snapshot.read_current(spark, f"{tmp_path}/t").collect())) == [(1, "b"), (12, "a")]


def test_folders_of_earlier_writes_are_read_beside_new_ones(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(12, "a"), (1, "b")], "DivisionId int, w string")
    with monkeypatch.context() as m:
        m.setattr(snapshot, "WRITE", "v")
        snapshot.publish(spark, rows, f"{tmp_path}/t")
    snapshot.publish(spark, rows.filter("DivisionId = 12").replace("a", "c"), f"{tmp_path}/t", touched=[12])
    assert sorted(map(tuple, snapshot.read_current(spark, f"{tmp_path}/t").collect())) == [(1, "b"), (12, "c")]


def test_rows_read_from_files_are_published_without_a_shuffle(spark, root):
    made = spark.range(4000).selectExpr("id as k", "cast(if(id % 2 = 0, 12, 1) as int) as DivisionId", "cast(id % 5 as int) as DPT_AUTO_KEY")
    made.repartition(40).write.parquet(f"{root}/stored")
    stored = spark.read.parquet(f"{root}/stored").filter("k >= 100")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("publish", "publish")
    try:
        version = snapshot.publish(spark, stored, f"{root}/t", from_files=True)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("publish")) == 1
    assert len(version.folders) == 10
    for folder in version.folders.values():  # one task's bytes: one file a folder, of the smaller kind
        files = [f for f in os.listdir(f"{root}/t/{folder}") if f.endswith(".parquet")]
        assert len(files) == 1 and files[0].endswith(".zstd.parquet")
    assert now(spark, f"{root}/t") == sorted(tuple(r) for r in stored.collect())


def test_large_files_are_published_by_several_tasks(spark, root, monkeypatch):
    spark.range(3000).selectExpr("id as k", "12 as DivisionId", "106 as DPT_AUTO_KEY").repartition(6).write.parquet(f"{root}/stored")
    monkeypatch.setattr(snapshot, "BYTES_A_TASK", 8_000)
    version = snapshot.publish(spark, spark.read.parquet(f"{root}/stored"), f"{root}/t", from_files=True)
    (folder,) = version.folders.values()
    assert len([f for f in os.listdir(f"{root}/t/{folder}") if f.endswith(".parquet")]) > 1
    assert snapshot.read_current(spark, f"{root}/t").count() == 3000


def test_computed_rows_are_published_without_a_shuffle(spark, root):
    made = spark.range(0, 4000, 1, 6).selectExpr("id as k", "cast(if(id % 2 = 0, 12, 1) as int) as DivisionId", "cast(id % 5 as int) as DPT_AUTO_KEY")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("computed", "computed")
    try:
        version = snapshot.publish(spark, made, f"{root}/t")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("computed")) == 1
    for folder in version.folders.values():  # few rows: one file a folder, though six tasks had them
        assert len([f for f in os.listdir(f"{root}/t/{folder}") if f.endswith(".parquet")]) == 1
    assert {n.split("=")[0] for n in os.listdir(f"{root}/t/data")} == {snapshot.WRITE}  # nothing else is left
    assert now(spark, f"{root}/t") == sorted(tuple(r) for r in made.collect())


def shuffle_blocks(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString("|")
    return {b for b in found.split("|") if b.startswith("shuffle_")}


def test_a_step_leaves_no_shuffle_files(spark, root):
    before, kept = shuffle_blocks(spark), spark.conf.get(FREE_SHUFFLES)
    rows = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).agg(F.lit(12).alias("DivisionId"), F.count("*").alias("n"))
    snapshot.publish(spark, rows, f"{root}/t")
    for _ in range(50):  # they are removed in the background
        if not shuffle_blocks(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_blocks(spark) - before
    assert spark.conf.get(FREE_SHUFFLES) == kept  # as the session had it
    assert rows.count() == snapshot.read_current(spark, f"{root}/t").count() == 100
