"""Facts by division and department bucket: a job leaves the folders alone whose rows it doesn't change."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from slicewright.config import RunContext
from slicewright.plans.loads import LoadScope
from slicewright.plans.reclassify import with_split_flag
from slicewright.plans.runner import run_load, run_reclassify
from slicewright.sources import snapshot
from tests.test_loads import receipt, receipts, seeded

CTX = RunContext(run_ts=dt.datetime(2002, 1, 1), unique_run_id="t2")


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="layout-")


def folders(spark, root):
    return snapshot.current(spark, f"{root}/f").folders


def test_deleting_one_department_leaves_the_other_folders(spark, root):
    seeded(spark, root, [
        receipt(1, dept=106, division=1), receipt(2, dept=107, division=1), receipt(3, dept=120, division=1), receipt(4, dept=None, division=1),
        receipt(5, dept=106), receipt(6, dept=107), receipt(7, dept=108), receipt(8, dept=109), receipt(9, dept=106, division=25),
    ])
    before = folders(spark, root)
    assert len(before) == 9
    # the source has departments 106 and 108; its part 6 matches a row of department 107
    source = receipts(spark, receipt(5, dept=106, quantity=2.0), receipt(6, dept=108, quantity=2.0), receipt(10, dept=108), receipt(11, dept=106), receipt(12, dept=106))
    got = run_load(spark, "receipts", source, f"{root}/f", f"{root}/run_log", CTX)
    assert (got["RowsDeleted"], got["RowsWritten"], got["RowsUpdated"]) == (2, 4, 1)
    after = folders(spark, root)
    same = {n for n, f in before.items() if after.get(n) == f}
    name = lambda division, dept: snapshot.folder_name(division, snapshot.bucket_of(dept))
    assert same == {name(1, 107), name(1, 120), name(1, None), name(12, 109), name(25, 106)}
    rows = {(r["PartId"], r["DivisionId"], r["DPT_AUTO_KEY"]) for r in snapshot.read_current(spark, f"{root}/f").collect()}
    assert rows == {(2, 1, 107), (3, 1, 120), (4, 1, None), (5, 12, 106), (6, 12, 108), (7, 12, 108), (8, 12, 109), (9, 25, 106),
                    (10, 12, 108), (11, 12, 106), (12, 12, 106)}
    assert name(1, 106) not in after and name(12, 107) not in after  # their only rows went, or moved


def test_all_departments_touch_all_their_folders_only(spark, root):
    seeded(spark, root, [receipt(1, dept=106, division=1), receipt(2, dept=120, division=1), receipt(3, dept=114)])
    before = folders(spark, root)
    run_load(spark, "receipts", receipts(spark, *[receipt(i) for i in (3, 4)]), f"{root}/f", f"{root}/run_log", CTX, LoadScope(tuple(range(106, 115))))
    kept = {n for n, f in folders(spark, root).items() if before.get(n) == f}
    assert kept == {snapshot.folder_name(1, snapshot.bucket_of(120))}


def test_a_reclassification_that_moves_nothing_writes_nothing(spark, tables, root):
    fact = with_split_flag(tables["f_invoice"])
    snapshot.publish(spark, fact, f"{root}/f")
    before = folders(spark, root)
    done = run_reclassify(spark, "invoice", tables, f"{root}/f", f"{root}/run_log", CTX)
    after = folders(spark, root)
    assert done["RowsUpdated"] > 0
    unit = {snapshot.bucket_of(d) for d in range(106, 115)}
    changed = {n for n in {*before, *after} if before.get(n) != after.get(n)}
    # of the base division the unit's buckets; of the split division only folders that are added
    base = {n for n in changed if n.startswith("DivisionId=1/")}
    assert base and {int(n.split("=")[-1]) for n in base} <= unit
    assert all("+" in n or n not in before for n in changed - base) and all(after.get(n) == f for n, f in before.items() if n not in base)
    again = run_reclassify(spark, "invoice", tables, f"{root}/f", f"{root}/run_log", CTX)
    assert again["RowsUpdated"] == 0 and again["RowsByPassed"] == again["RowsRead"] == done["RowsRead"]
    assert snapshot.current(spark, f"{root}/f").number == 2
    rows = snapshot.read_current(spark, f"{root}/f")
    assert rows.count() == fact.count() and rows.filter("IsSplit = 1 AND DivisionId <> 12").count() == 0


def test_rows_beside_a_folder_are_read_and_replaced_with_it(spark, root):
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "k int, DPT_AUTO_KEY int, DivisionId int")
    now = lambda **how: sorted(r["k"] for r in snapshot.read_current(spark, root, **how).collect())
    snapshot.publish(spark, rows((1, 106, 1), (2, 106, 12)), root)
    base = snapshot.folders_in(snapshot.current(spark, root), 1, [106])
    with pytest.raises(ValueError):
        snapshot.publish(spark, rows((1, 106, 12)), root, names=base)
    snapshot.publish(spark, rows((3, 106, 12), (4, 106, 1)), root, names=base, beside=True)
    assert now() == [2, 3, 4] and now(only=(12,)) == [2, 3] and now(without=(12,)) == [4]
    version = snapshot.current(spark, root)
    assert len(snapshot.folders_in(version, 12, [106])) == 2 and snapshot.folders_in(version, 12, [107]) == set()
    snapshot.publish(spark, rows((5, 106, 12)), root, names=snapshot.folders_in(version, 12, [106]))
    assert now() == [4, 5]


def test_tables_published_before_the_layout_are_read_and_replaced(spark, root, monkeypatch):
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "k int, DPT_AUTO_KEY int, DivisionId int")
    with monkeypatch.context() as m:
        m.setattr(snapshot, "DEPARTMENT", "none")  # as before: folders of divisions only
        snapshot.publish(spark, rows((1, 106, 1), (2, 120, 1), (3, 106, 12)), root)
    snapshot.publish(spark, rows((4, 106, 12)), root, touched=(12,))
    version = snapshot.current(spark, root)
    assert snapshot.folders_in(version, 1, [120]) == {"DivisionId=1"}  # could be anywhere in it
    assert sorted(r["k"] for r in snapshot.read_current(spark, root).collect()) == [1, 2, 4]
    assert snapshot.read_current(spark, root).filter(F.col("DivisionId") == 12).count() == 1
