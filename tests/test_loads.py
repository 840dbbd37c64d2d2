import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from slicewright.config import RunContext
from slicewright.plans.loads import SPECS, LoadScope
from slicewright.plans.runner import run_all, run_load
from slicewright.registry import JOBS
from slicewright.sources import snapshot

CTX = RunContext(run_ts=dt.datetime(2002, 1, 1), unique_run_id="t1")


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="wh-")


def log_of(spark, root):
    return spark.read.parquet(f"{root}/run_log")


def test_run_load_publishes_logs_and_is_idempotent(spark, tables, root):
    slice_df = JOBS["shipment_slice_split"](spark, tables)
    first = run_load(spark, "shipment", slice_df, f"{root}/f", f"{root}/run_log", CTX)
    assert first["RowsWritten"] == first["RowsRead"] > 0 and first["RowsUpdated"] == 0
    second = run_load(spark, "shipment", slice_df, f"{root}/f", f"{root}/run_log", CTX)
    assert second["RowsWritten"] == 0 and second["RowsUpdated"] == second["RowsRead"] == second["TargetRowsUpdated"]
    assert snapshot.current(spark, f"{root}/f").number == 2
    log = log_of(spark, root).groupBy("Status").count().collect()
    assert {r["Status"]: r["count"] for r in log} == {"RUNNING": 2, "PASS": 2}


def test_failed_load_keeps_the_version_and_the_whole_error(spark, tables, root):
    slice_df = JOBS["shipment_slice_split"](spark, tables)
    run_load(spark, "shipment", slice_df, f"{root}/f", f"{root}/run_log")
    bad = slice_df.drop("CustomerId")  # a source without a loaded column fails the load
    with pytest.raises(Exception) as caught:
        run_load(spark, "shipment", bad, f"{root}/f", f"{root}/run_log")
    assert snapshot.current(spark, f"{root}/f").number == 1
    (failed,) = log_of(spark, root).filter("Status = 'FAIL'").collect()
    assert failed["ErrorDescription"] == str(caught.value) and failed["RowsRead"] == 0


# --- hand-computed loads -------------------------------------------------------------------

RECEIPT = ("VendorId bigint, PartId bigint, PONumber string, LineNumber int, QuantityReceived double, Complete string, "
           "ReceivedDate timestamp_ntz, UnitCost decimal(19,4), CalculatedValue double, ETLImportDate timestamp_ntz, "
           "DPT_AUTO_KEY int, DivisionId int")
DAY = dt.datetime(1998, 5, 1)


def receipt(part, line=1, day=DAY, quantity=1.0, dept=107, division=12, cost="2.0000"):
    return (7, part, "PO-1", line, quantity, "U", day, Decimal(cost), 2.0, DAY, dept, division)


def receipts(spark, *rows):
    return spark.createDataFrame(list(rows), RECEIPT)


def seeded(spark, root, rows, schema=RECEIPT):
    seed = spark.createDataFrame(rows, schema).withColumn("ETLModifiedDate", F.lit(None).cast("timestamp_ntz"))
    snapshot.publish(spark, seed.withColumn("IsSplit", F.lit(None).cast("int")), f"{root}/f")


def test_receipts_delete_one_department_and_update_the_rest(spark, root):
    seeded(spark, root, [
        receipt(1, dept=106), receipt(2, dept=106, division=1),       # the scope's department: deleted, in both divisions
        receipt(3), receipt(4, line=None), receipt(5, line=0), receipt(6, day=None), receipt(7, day=dt.datetime(1990, 1, 1)),
        receipt(8), receipt(9, dept=120, division=1), receipt(10, dept=106, division=25),
    ])
    source = receipts(
        spark, receipt(1, dept=106, quantity=5.0), receipt(3, quantity=5.0), receipt(4, line=0, quantity=5.0), receipt(5, line=None, quantity=5.0),
        receipt(6, day=dt.datetime(1990, 1, 1), quantity=5.0), receipt(7, day=None, quantity=5.0), receipt(11, quantity=5.0),
        receipt(9, quantity=5.0),
    )
    got = run_load(spark, "receipts", source, f"{root}/f", f"{root}/run_log", CTX, audit_path=f"{root}/audit")
    actions = {(r["PartId"], r["DivisionId"], r["MergeAction"]) for r in spark.read.parquet(f"{root}/audit").collect()}
    assert actions == {
        (1, 12, "DELETE"), (1, 12, "INSERT"), (2, 1, "DELETE"), (3, 12, "UPDATE"), (4, 12, "UPDATE"), (5, 12, "UPDATE"),
        (6, 12, "UPDATE"), (7, 12, "UPDATE"), (8, 12, "KEEP"), (9, 1, "KEEP"), (9, 12, "INSERT"), (11, 12, "INSERT"),
    }
    assert {k: got[k] for k in ("RowsRead", "RowsWritten", "RowsUpdated", "RowsDeleted", "RowsByPassed")} == {
        "RowsRead": 8, "RowsWritten": 3, "RowsUpdated": 5, "RowsDeleted": 2, "RowsByPassed": 0,
    }
    after = {(r["PartId"], r["DivisionId"]): r for r in snapshot.read_current(spark, f"{root}/f").collect()}
    assert after[(4, 12)]["LineNumber"] == 0 and after[(6, 12)]["ReceivedDate"] == dt.datetime(1990, 1, 1)
    assert after[(3, 12)]["QuantityReceived"] == 5.0 and after[(3, 12)]["ETLImportDate"] == CTX.run_ts
    assert after[(10, 25)]["QuantityReceived"] == 1.0 and len(after) == 10 - 2 + 3  # another division isn't even read


def test_receipts_with_all_departments_in_scope(spark, root):
    seeded(spark, root, [receipt(1, dept=106), receipt(3, dept=107), receipt(9, dept=120, division=1)])
    scope = LoadScope(tuple(range(106, 115)))
    got = run_load(spark, "receipts", receipts(spark, receipt(3), receipt(4), receipt(5)), f"{root}/f", f"{root}/run_log", CTX, scope)
    assert (got["RowsDeleted"], got["RowsWritten"], got["RowsUpdated"]) == (2, 3, 0)


def test_blocked_receipts_change_nothing(spark, root):
    seeded(spark, root, [receipt(i) for i in range(10)])
    got = run_load(spark, "receipts", receipts(spark, *[receipt(i) for i in range(8)]), f"{root}/f", f"{root}/run_log", CTX)
    assert got["Blocked"] and got["RowsByPassed"] == 8 and snapshot.current(spark, f"{root}/f").number == 1
    (row,) = log_of(spark, root).filter("Status = 'PASS'").collect()
    assert row["Message"] == "Not enough staged records" and row["RowsByPassed"] == 8


def test_uniqueness_is_judged_as_the_match_compares(spark, root):
    twice = receipts(spark, receipt(1, day=None), receipt(1, day=dt.datetime(1990, 1, 1)))
    with pytest.raises(ValueError):
        run_load(spark, "receipts", twice, f"{root}/f", f"{root}/run_log", CTX)
    no_vendor = receipts(spark, *[(None, *receipt(1)[1:])] * 2)  # null keys can't match: they insert on every run
    for n in (1, 2):
        got = run_load(spark, "receipts", no_vendor, f"{root}/g", f"{root}/run_log", CTX)
        assert got["RowsWritten"] == 2 and snapshot.read_current(spark, f"{root}/g").count() == 2 * n or n == 2 and got["Blocked"]


def test_inventory_matches_in_its_division_and_as_written_by_department(spark, tables, root):
    slice_df = JOBS["inventory_slice_split"](spark, tables).limit(50).cache()
    ids = [r["NativeId"] for r in slice_df.select("NativeId").collect()]
    run_load(spark, "inventory", slice_df, f"{root}/f", f"{root}/run_log", CTX)
    again = run_load(spark, "inventory", slice_df, f"{root}/f", f"{root}/run_log", CTX)
    assert (again["RowsWritten"], again["RowsUpdated"], again["RowsByPassed"]) == (0, len(ids), 0)
    of_106 = slice_df.filter("DPT_AUTO_KEY = 106").count()
    written = run_load(spark, "inventory", slice_df, f"{root}/f", f"{root}/run_log", CTX, LoadScope(as_written=True))
    assert written["RowsUpdated"] == of_106 and written["RowsWritten"] == len(ids) - of_106


def test_a_load_reads_slice_and_target_once(spark, tables, root):
    from slicewright.plans.loads import merge_load

    slice_df = JOBS["sales_order_slice_split"](spark, tables)
    slice_df.write.parquet(f"{root}/slice")
    source = spark.read.parquet(f"{root}/slice")
    run_load(spark, "sales_order", source, f"{root}/f", f"{root}/run_log", CTX)
    target = snapshot.read_current(spark, f"{root}/f", only=(12,))
    plan = merge_load(SPECS["sales_order"], target, source, CTX)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_run_all_moves_loads_and_repeats(spark, tables, root):
    first = run_all(spark, tables, root)
    loads = ("inventory", "invoice", "purchase_order", "sales_order", "shipment", "receipts")
    for kind in loads:
        assert first[kind]["Status"] == "PASS" and first[kind]["RowsWritten"] == first[kind]["RowsRead"] > 0, kind
    second = run_all(spark, tables, root)
    for kind in loads:
        c = second[kind]
        assert c["RowsRead"] == c["RowsWritten"] + c["RowsUpdated"] and c["RowsByPassed"] == 0, kind
        if kind in ("invoice", "receipts"):  # one department is replaced, the others are updated
            assert c["RowsDeleted"] == c["RowsWritten"] > 0 and c["RowsUpdated"] > 0, kind
        else:
            assert c["RowsWritten"] == 0, kind
    log = log_of(spark, root)
    assert log.filter("Status = 'PASS'").count() == 26 and log.filter("Status = 'FAIL'").count() == 0
    assert os.path.exists(f"{root}/f_SalesOrder/_CURRENT")


def test_reclassified_rows_are_published(spark, tables, root):
    from slicewright.plans.reclassify import with_split_flag
    from slicewright.plans.runner import run_reclassify

    fact = with_split_flag(tables["f_invoice"])
    snapshot.publish(spark, fact, f"{root}/f_Invoice")
    done = run_reclassify(spark, "invoice", tables, f"{root}/f_Invoice", f"{root}/run_log", CTX)
    expected = fact.filter("DivisionId = 1 AND DPT_AUTO_KEY BETWEEN 106 AND 114").count()
    assert done["RowsUpdated"] == expected > 0 and done["RowsRead"] == fact.count()
    after = snapshot.read_current(spark, f"{root}/f_Invoice")
    assert after.filter("IsSplit = 1 AND DivisionId = 12").count() == expected and after.count() == fact.count()
