"""All entities in one pass: same rows as the slices, one detail scan, a folder for each division."""

import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from slicewright.config import SLICES
from slicewright.plans.invoice import invoice_all, invoice_slice
from slicewright.plans.refresh import run_refresh
from slicewright.plans.sales_order import sales_order_all, sales_order_slice
from slicewright.sources import snapshot
from slicewright.sources.staging import stage_fixtures
from tests.conftest import SF_SMALL

ONE = {"sales_order": (sales_order_all, sales_order_slice), "invoice": (invoice_all, invoice_slice)}


@pytest.fixture(scope="module")
def staged(spark):
    return stage_fixtures(spark, SF_SMALL)


def counted(df, columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_sales_orders_are_the_union_of_the_slices(spark, staged):
    whole = sales_order_all(staged).cache()
    for key, sl in SLICES.items():
        one = sales_order_slice(staged, key)
        assert counted(whole.filter(F.col("DivisionId") == sl.division_id), one.columns) == counted(one, one.columns), key
    assert whole.filter(~F.col("DivisionId").isin(*[sl.division_id for sl in SLICES.values()])).count() == 0
    whole.unpersist()


def test_invoices_of_lines_that_several_entities_have(spark, staged):
    """Lines repeated under other departments: the base entity competes with all, the others don't."""
    inv = staged["stg_invc_detail"]
    departments = [r[0] for r in staged["stg_department"].select("DPT_AUTO_KEY").orderBy("DPT_AUTO_KEY").collect()]
    other = F.element_at(F.array(*map(F.lit, departments)), F.pmod(F.xxhash64("INH_AUTO_KEY", "IND_AUTO_KEY"), F.lit(len(departments))).cast("int") + 1)
    again = inv.filter("IND_AUTO_KEY % 3 = 0").withColumn("DPT_AUTO_KEY", other.cast(inv.schema["DPT_AUTO_KEY"].dataType))
    tables = staged.with_table("stg_invc_detail", inv.unionByName(again).unionByName(again.limit(50)))
    whole = invoice_all(tables).cache()
    for key, sl in SLICES.items():
        one = invoice_slice(tables, key)
        assert counted(whole.filter(F.col("DivisionId") == sl.division_id), one.columns) == counted(one, one.columns), key
    whole.unpersist()


@pytest.mark.parametrize("family", ["sales_order", "invoice"])
def test_the_detail_is_read_once(spark, staged, family):
    detail = {"sales_order": "stg_so_detail", "invoice": "stg_invc_detail"}[family]
    plan = ONE[family][0](staged)._jdf.queryExecution().executedPlan().toString()
    scans = [x.split("ReadSchema: struct<")[1].split(">")[0] for x in plan.split("FileScan parquet")[1:] if f"/{detail}]" in x.split("ReadSchema")[0]]
    wide = [x for x in scans if x.count(":") > 2]
    assert len(wide) == 1 and len(scans) <= 2  # beside it at most the two columns that tax lines are counted on
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan and "WindowGroupLimit" in plan


def test_a_refresh_has_a_folder_for_each_division(spark, staged):
    root = tempfile.mkdtemp(prefix="refresh-")
    done = run_refresh(spark, "invoice", staged, f"{root}/inv", f"{root}/run_log")
    version = snapshot.current(spark, f"{root}/inv")
    assert {snapshot.plain(n).split("/")[0] for n in version.folders} == {f"DivisionId={sl.division_id}" for sl in SLICES.values()}
    uk = snapshot.read_current(spark, f"{root}/inv", only=(23,))
    one = invoice_slice(staged, "uk")
    assert counted(uk, one.columns) == counted(one, one.columns)
    assert all("DivisionId=23" in f for f in uk.inputFiles())
    assert done["RowsWritten"] == snapshot.read_current(spark, f"{root}/inv").count() > 0
    assert spark.read.parquet(f"{root}/run_log").filter("Status = 'PASS'").count() == 1
