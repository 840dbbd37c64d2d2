"""Registry: query key → DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from slicewright.config import SLICES
from slicewright.oracle.common import entity_ctes, with_fixtures
from slicewright.oracle.loads import (
    ALL_DEPARTMENTS,
    guard_blocked_sql,
    load_changes_sql,
    load_counts_sql,
    load_sql,
    reclassify_counts_sql,
    reclassify_sql,
    run_log_failed_sql,
    run_log_sql,
)
from slicewright.oracle.purchasing import purchase_order_sql, receipt_sql, zero_factors_sql
from slicewright.oracle.sales_order import sales_order_sql
from slicewright.oracle.units import unit_sql
from slicewright.plans.units import UNITS
from slicewright.oracle.slices import invoice_sql, inventory_sql, quote_sql, shipment_sql

ORACLES: dict[str, Callable[[], str]] = {
    "entity_dim": lambda: with_fixtures(
        entity_ctes(),
        "SELECT dept_name, division_name, company_name, DPT_AUTO_KEY, DEPT_Definition, DivisionId FROM entity",
    ),
}

for _k in SLICES:
    ORACLES[f"sales_order_slice_{_k}"] = (lambda k=_k: sales_order_sql(k))
for _k in SLICES:
    ORACLES[f"invoice_slice_{_k}"] = (lambda k=_k: invoice_sql(k))


def _all_sql(slice_sql) -> str:
    """The rows of all seven slices; columns that only some have are null in the others."""
    def one(key: str) -> str:
        ctes, final = slice_sql(key, parts=True)
        return "SELECT * FROM (WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in ctes) + f" {final})"

    return " UNION ALL BY NAME ".join(map(one, SLICES))


def _refreshed_sql(slice_sql) -> str:
    """Rows and line prices of each division, and the total."""
    return with_fixtures([], f"""
      SELECT DivisionId, COUNT(*) AS RowsAfter, CAST(SUM(LinePrice) AS DECIMAL(38,4)) AS LinePrice,
             CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS RowsRead, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS RowsWritten
      FROM ({_all_sql(slice_sql)}) every_slice GROUP BY DivisionId""")


ORACLES["sales_order_all"] = lambda: with_fixtures([], _all_sql(sales_order_sql))
ORACLES["invoice_all"] = lambda: with_fixtures([], _all_sql(invoice_sql))
ORACLES["refresh_sales_order"] = lambda: _refreshed_sql(sales_order_sql)
ORACLES["refresh_invoice"] = lambda: _refreshed_sql(invoice_sql)
ORACLES["inventory_slice_split"] = inventory_sql
ORACLES["quote_slice_split"] = quote_sql
ORACLES["shipment_slice_split"] = shipment_sql
ORACLES["purchase_order_slice_split"] = purchase_order_sql
ORACLES["receipt_slice_split"] = receipt_sql
ORACLES["receipt_slice_by_order"] = lambda: receipt_sql(by_order=True)
ORACLES["sales_order_slice_bucketed"] = lambda: sales_order_sql("split")
ORACLES["receipt_slice_bucketed"] = receipt_sql
ORACLES["zero_factors"] = zero_factors_sql
for _k in ("sales_order", "invoice", "inventory", "purchase_order", "shipment", "receipts"):
    ORACLES[f"load_{_k}"] = (lambda k=_k: load_sql(k))
    ORACLES[f"load_changes_{_k}"] = (lambda k=_k: load_changes_sql(k))
    ORACLES[f"load_counts_{_k}"] = (lambda k=_k: load_counts_sql(k))
ORACLES["load_purchase_order_as_written"] = lambda: load_sql("purchase_order", as_written=True)
ORACLES["load_inventory_as_written"] = lambda: load_sql("inventory", as_written=True)
ORACLES["load_invoice_all_departments"] = lambda: load_sql("invoice", ALL_DEPARTMENTS)
ORACLES["load_receipts_all_departments"] = lambda: load_sql("receipts", ALL_DEPARTMENTS)
ORACLES["load_receipts_guard_blocked"] = guard_blocked_sql
ORACLES["run_log"] = run_log_sql
ORACLES["run_log_failed"] = run_log_failed_sql
for _k in ("sales_order", "invoice", "inventory", "purchase_order", "receipts", "quote", "shipment"):
    ORACLES[f"reclassify_{_k}"] = (lambda k=_k: reclassify_sql(k))
    ORACLES[f"reclassify_counts_{_k}"] = (lambda k=_k: reclassify_counts_sql(k))

for _k in UNITS:
    ORACLES[_k] = (lambda k=_k: unit_sql(k))


ORACLES["latest_incremental"] = lambda: unit_sql("latest_per_line").replace(", rownum FROM", " FROM", 1)


def oracle_sql() -> dict[str, str]:
    return {k: f() for k, f in ORACLES.items()}
