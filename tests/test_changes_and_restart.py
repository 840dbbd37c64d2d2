"""Change feed and restart of loads."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from slicewright.config import RunContext
from slicewright.operators.merge import ACTION, AFTER, BEFORE, replay
from slicewright.plans import runner
from slicewright.plans.loads import SPECS, seed_target
from slicewright.plans.runner import RESUMED, run_load
from slicewright.registry import JOBS
from slicewright.sources import snapshot

CTX = RunContext(run_ts=dt.datetime(2002, 1, 1), unique_run_id="t1")


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="wh-")


@pytest.fixture(scope="module")
def invoice(spark, tables):
    path = tempfile.mkdtemp(prefix="slice-") + "/invoice"
    JOBS["invoice_slice_split"](spark, tables).write.parquet(path)
    rows = spark.read.parquet(path)
    return rows, seed_target(SPECS["invoice"], rows, tables)


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def load(spark, root, rows, **options):
    return run_load(spark, "invoice", rows, f"{root}/f", f"{root}/log", CTX, **options)


def poisoned(rows):
    """The same columns, but reading a row is an error."""
    first = rows.columns[0]
    return rows.withColumn(first, F.raise_error(F.lit("evaluated again")).cast(rows.schema[first].dataType))


def stop(*args, **kwargs):
    raise RuntimeError("stopped")


# --- change feed ---------------------------------------------------------------------------

def test_replaying_the_changes_gives_the_new_version(spark, root, invoice):
    rows, seed = invoice
    snapshot.publish(spark, seed, f"{root}/f")
    old = snapshot.read_current(spark, f"{root}/f")
    done = load(spark, root, rows, changes=True)
    feed = snapshot.read_changes(spark, f"{root}/f")
    n = {r[ACTION]: r["count"] for r in feed.groupBy(ACTION).count().collect()}
    assert n == {a: v for a, v in (("INSERT", done["RowsWritten"]), ("UPDATE", done["TargetRowsUpdated"]), ("DELETE", done["RowsDeleted"])) if v}
    assert "DELETE" in n and "INSERT" in n
    assert rows_of(replay(old, feed)) == rows_of(snapshot.read_current(spark, f"{root}/f"))


def test_the_feed_does_not_change_what_is_loaded(spark, invoice):
    rows, seed = invoice
    results = []
    for changes in (False, True):
        root = tempfile.mkdtemp(prefix="wh-")
        snapshot.publish(spark, seed, f"{root}/f")
        results.append((load(spark, root, rows, changes=changes), rows_of(snapshot.read_current(spark, f"{root}/f"))))
    assert results[0] == results[1]


def test_first_load_and_versions_without_a_feed(spark, root, invoice):
    rows, _ = invoice
    load(spark, root, rows)
    assert snapshot.read_changes(spark, f"{root}/f") is None
    load(spark, root, rows, changes=True)
    feed = snapshot.read_changes(spark, f"{root}/f")
    assert feed.filter(F.col(AFTER).isNull() & F.col(BEFORE).isNull()).count() == 0


def test_retain_removes_feeds_of_dropped_versions(spark, root, invoice):
    rows, seed = invoice
    snapshot.publish(spark, seed, f"{root}/f")
    for _ in range(3):
        load(spark, root, rows, changes=True)
    kept = snapshot.current(spark, f"{root}/f").changes.split("/")[1]
    assert len(snapshot._names(spark, f"{root}/f/changes")) == 3
    snapshot.retain(spark, f"{root}/f", versions=1)
    assert snapshot._names(spark, f"{root}/f/changes") == [kept]
    assert snapshot.read_changes(spark, f"{root}/f").count() > 0


# --- restart -------------------------------------------------------------------------------

def test_restart_after_staging_does_not_evaluate_the_slice(spark, root, invoice):
    rows, seed = invoice
    snapshot.publish(spark, seed, f"{root}/f")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(runner, "merge_load", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            load(spark, root, rows, run_id="r1")
    assert snapshot.current(spark, f"{root}/f").number == 1
    done = load(spark, root, poisoned(rows), run_id="r1")
    assert done["Status"] == "PASS" and snapshot.current(spark, f"{root}/f").number == 2


def test_restart_after_the_merge_does_not_merge(spark, root, invoice):
    rows, seed = invoice
    plain_root = tempfile.mkdtemp(prefix="wh-")
    for r in (root, plain_root):
        snapshot.publish(spark, seed, f"{r}/f")
    want = load(spark, plain_root, rows)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(snapshot, "publish", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            load(spark, root, rows, run_id="r2")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(runner, "merge_load", stop)
        done = load(spark, root, poisoned(rows), run_id="r2")
    assert done == want
    assert rows_of(snapshot.read_current(spark, f"{root}/f")) == rows_of(snapshot.read_current(spark, f"{plain_root}/f"))


def test_another_version_in_between_is_merged_with(spark, root, invoice):
    rows, seed = invoice
    snapshot.publish(spark, seed, f"{root}/f")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(snapshot, "publish", stop)
        with pytest.raises(RuntimeError):
            load(spark, root, rows, run_id="r3")
    snapshot.publish(spark, seed.limit(0), f"{root}/f")  # all rows go
    done = load(spark, root, poisoned(rows), run_id="r3")
    assert done["RowsWritten"] == done["RowsRead"] and done["RowsDeleted"] == 0


def test_a_run_that_had_published_changes_nothing(spark, root, invoice):
    rows, seed = invoice
    snapshot.publish(spark, seed, f"{root}/f")
    first = load(spark, root, rows, run_id="r4")
    load(spark, root, rows, run_id="later")
    again = load(spark, root, poisoned(rows), run_id="r4")
    assert again["Resumed"] and again["Message"] == RESUMED and again["RowsWritten"] == first["RowsWritten"]
    assert snapshot.current(spark, f"{root}/f").number == 3
    log = spark.read.parquet(f"{root}/log").groupBy("Status").count().collect()
    assert {r["Status"]: r["count"] for r in log} == {"RUNNING": 3, "PASS": 3}


def test_a_lost_pointer_move_is_published_again(spark, root, invoice):
    rows, seed = invoice
    snapshot.publish(spark, seed, f"{root}/f")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(snapshot, "_point_to", stop)
        with pytest.raises(RuntimeError):
            load(spark, root, rows, run_id="r5")
    assert snapshot.published_by(spark, f"{root}/f", "r5") is None
    assert load(spark, root, poisoned(rows), run_id="r5")["Status"] == "PASS"
    assert snapshot.published_by(spark, f"{root}/f", "r5").number == 2
