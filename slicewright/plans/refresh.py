"""Refresh of all entities at once.

The slices of a family (sales orders, invoices) are evaluated in one pass over their staging
tables and published as one version, whose rows the write routes to a folder for each
division.  A reader of one entity reads its folder only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slicewright.config import RunContext
from slicewright.plans.invoice import invoice_all
from slicewright.plans.runner import COUNTS, Logged
from slicewright.plans.sales_order import sales_order_all
from slicewright.session import frees_shuffles
from slicewright.sources import snapshot

FAMILIES: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "sales_order": sales_order_all,
    "invoice": invoice_all,
}


@frees_shuffles
def run_refresh(
    spark: SparkSession, family: str, tables: Mapping[str, DataFrame], target_root: str, log_path: str,
    ctx: RunContext = RunContext(),
) -> dict:
    """Publish the slices of ``family`` by division, with run-log rows.  Divisions that have no
    rows any more are left out of the new version."""
    with Logged(spark, log_path, ctx, f"refresh_{family}", f"{family}_all", target_root.rsplit("/", 1)[-1]) as log:
        seen = Observation(f"refresh_{family}")
        rows = FAMILIES[family](tables).observe(seen, F.count(F.lit(1)).alias("n"))
        snapshot.publish(spark, rows, target_root)
        n = int(seen.get["n"] or 0)
        return log.passed(dict.fromkeys(COUNTS, 0) | {"RowsRead": n, "RowsWritten": n})
