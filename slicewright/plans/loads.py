"""Load jobs: what each load matches, deletes, updates and inserts.

Each load is a DataFrame transform ``(target, source) → target rows with MergeAction``;
:mod:`slicewright.plans.runner` runs it with guard, uniqueness check, run log and
publishing.  Per fact (insert list; on a match every insert column except the keys, the
division and the import stamp is overwritten, and ``ETLModifiedDate`` gets the run clock):

* sales order, purchase order: (NativeId, NativeLineId), target division 12
  (the purchase-order key as first written demanded target division 1 and source
  division 12 at once and could never match; ``as_written`` keeps that);
* invoice: delete the scope's departments, then (NativeId, NativeLineId), target
  division 12;
* inventory: NativeId, target division 12 (``as_written``: target in the scope's
  departments, whatever its division);
* shipment: newest modification per (NativeId, DivisionId), then that key;
* receipts: only when the slice has more than 0.8 × the target's division-12 rows:
  delete the scope's departments, then match on vendor, part, PO number, line (null =
  0), division, receipt date (null = 1990-01-01) and unit cost; all 12 columns update
  and the import stamp is the run clock.

The scope is a parameter: by default the one department that the loads were written for.
Rows of the unit's other departments stay, and match.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.config import BASE_DIVISION, NULL_RECEIVED_DATE, SPLIT_DIVISION, RunContext
from slicewright.functions.exprs import ts_literal
from slicewright.operators.dedupe import first_per_key
from slicewright.operators.merge import MergeKey, merge_rows

STAMP = "ETLModifiedDate"
FLAG = "IsSplit"


@dataclass(frozen=True)
class LoadSpec:
    kind: str
    slice_job: str
    insert_cols: tuple[str, ...]
    keys: tuple[str, ...]
    insert_only: tuple[str, ...]
    amount_col: str
    seed_fact: str | None = None
    target_name: str = ""

    @property
    def update_cols(self) -> tuple[str, ...]:
        return tuple(c for c in self.insert_cols if c not in self.insert_only)


def _cols(text: str) -> tuple[str, ...]:
    return tuple(c.strip() for c in text.split(",") if c.strip())


SPECS: dict[str, LoadSpec] = {
    "sales_order": LoadSpec(
        "sales_order", "sales_order_slice_split",
        _cols("NativeId, NativeLineId, CustomerId, SalesRepId, PartId, AltPartId, EmployeeId, WarehouseId, "
              "RouteId, DivisionId, SONumber, LineNumber, NativeQuoteLineId, OrderDate, OrderDateId, ShipDate, "
              "ShipDateId, DueDate, DeliveryDate, UnitPrice, UnitCost, LinePrice, LineCost, Discount, QtyOrdered, "
              "QtyShipped, QtyInvoiced, QtyOpen, QtyAllocated, ExchangeRate, IsOpen, NativeModifiedDate, "
              "NativeModifiedDateLine, BillingZipCode, BillingCountry, ETLImportDate, IsLTA, ProductClass, Status, "
              "CONTRACT_NUMBER, DPT_AUTO_KEY"),
        ("NativeId", "NativeLineId"), ("NativeId", "NativeLineId", "DivisionId", "ETLImportDate"),
        "UnitPrice", "f_sales_order", "f_SalesOrder",
    ),
    "invoice": LoadSpec(
        "invoice", "invoice_slice_split",
        _cols("NativeId, NativeLineId, EmployeeId, CustomerId, PartId, SalesRepId, RouteId, DivisionId, "
              "InvoiceNumber, LineNumber, NativeSOLineId, InvoiceDate, InvoiceDateId, OrderDate, OrderDateId, "
              "ShipDate, PostDate, PostStatus, InvoiceType, ExchangeRate, QtyShipped, QtyBackOrdered, UnitCost, "
              "UnitPrice, LinePrice, LineCost, TaxAmount, IsLTA, DPT_AUTO_KEY, BillingZipCode, BillingCountry, "
              "ETLImportDate"),
        ("NativeId", "NativeLineId"), ("NativeId", "NativeLineId", "DivisionId", "ETLImportDate"),
        "UnitPrice", "f_invoice", "f_Invoice",
    ),
    "inventory": LoadSpec(
        "inventory", "inventory_slice_split",
        _cols("NativeId, PartId, LotNumber, VendorId, LocationId, OriginalLocationId, WarehouseId, "
              "OriginalWarehouseId, EmployeeId, DivisionId, AgeId, NativeInvoiceLineId, NativePOLineId, PONumber, "
              "ReceivedDate, QtyReceived, QtyOnHand, QtyReserved, QtyAvailable, UnitCost, UnitPrice, CurrentCost, "
              "CurrentValue, OriginalCost, OriginalValue, IsHistorical, NativeModifiedDate, ETLImportDate, "
              "ManufacturerId, PartConditionId, TestRptCode, CertNumber, Revision, DPT_AUTO_KEY"),
        ("NativeId",), ("NativeId", "DivisionId", "ETLImportDate"),
        "UnitCost", "f_inventory", "f_Inventory",
    ),
    "purchase_order": LoadSpec(
        "purchase_order", "purchase_order_slice_split",
        _cols("NativeId, NativeLineId, VendorId, EmployeeId, CustomerId, WarehouseId, PartId, AltPartId, RouteId, "
              "DPT_AUTO_KEY, DivisionId, PONumber, LineNumber, PODate, PODateId, ShipDate, ETADate, DeliveryDate, "
              "QtyBackOrdered, QtyOrdered, QtyReceived, QtyOpen, UnitCost, LineCost, VendorPrice, IsOpen, IsResale, "
              "IsDropShip, SO_DEPT_NAME, PO_DEPT_NAME, ACCOUNT_TYPE_DESC, DESCRIPTION, warehouse, "
              "NativeModifiedDate, NativeModifiedDateLine, ETLImportDate, UOM"),
        ("NativeId", "NativeLineId"), ("NativeId", "NativeLineId", "DivisionId", "ETLImportDate"),
        "VendorPrice", "f_purchase_order", "f_PurchaseOrder",
    ),
    "shipment": LoadSpec(
        "shipment", "shipment_slice_split",
        _cols("NativeId, CustomerId, CurrencyId, EmployeeId, DivisionId, NativeSOId, NativeInvoiceId, "
              "NativeSvcAutoKey, ShipmentNumber, TrackingNumber, IsOpen, ShipDate, ShipDateId, EntryDate, "
              "EntryDateId, InvoiceDate, InvoicePrice, InvoiceNumber, PackerName, WarehouseLocation, "
              "ShipmentPriority, NativeModifiedDate, NativeCreatedDate, ETLImportDate, NativeSODId, SMS_AUTO_KEY, "
              "SM_UDF_002, WHS_TO, DPT_AUTO_KEY"),
        ("NativeId", "DivisionId"), ("NativeId", "DivisionId", "ETLImportDate"),
        "InvoicePrice", None, "f_Shipment",
    ),
    "receipts": LoadSpec(
        "receipts", "receipt_slice_split",
        _cols("VendorId, PartId, PONumber, LineNumber, QuantityReceived, Complete, ReceivedDate, UnitCost, "
              "CalculatedValue, ETLImportDate, DPT_AUTO_KEY, DivisionId"),
        ("VendorId", "PartId", "PONumber", "LineNumber", "DivisionId", "ReceivedDate", "UnitCost"), (),
        "QuantityReceived", None, "f_PurchaseOrderDetail",
    ),
}


def target_columns(spec: LoadSpec) -> tuple[str, ...]:
    return (*spec.insert_cols, STAMP, FLAG)


def shape_target(spec: LoadSpec, rows: DataFrame, schema_of: DataFrame) -> DataFrame:
    """``rows`` as target rows: insert columns (typed as in ``schema_of``, missing →
    null), modification stamp and split flag null."""
    have = set(rows.columns)
    out = []
    for c in spec.insert_cols:
        t = schema_of.schema[c].dataType
        out.append((F.col(c) if c in have else F.lit(None)).cast(t).alias(c))
    out.append(F.lit(None).cast("timestamp_ntz").alias(STAMP))
    out.append(F.lit(None).cast("int").alias(FLAG))
    return rows.select(*out)


def seed_target(spec: LoadSpec, source: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Test target: the slice's rows with an even key and one amount + 1, plus
    bystanders (seed-fact rows of other divisions, or the same rows in division 1)."""
    key = "PartId" if spec.kind == "receipts" else "NativeId"
    even = source.filter(F.col(key) % 2 == 0).withColumn(spec.amount_col, F.col(spec.amount_col) + 1)
    rows = shape_target(spec, even, source)
    if spec.seed_fact is not None:
        seed = tables[spec.seed_fact].filter(F.col("DivisionId") != SPLIT_DIVISION)
        others = shape_target(spec, seed, source)
    else:
        others = rows.withColumn("DivisionId", F.lit(1).cast(source.schema["DivisionId"].dataType))
    return rows.unionByName(others)


def prepare_source(spec: LoadSpec, slice_df: DataFrame) -> DataFrame:
    src = slice_df
    if spec.kind in ("sales_order", "purchase_order", "shipment", "receipts"):
        src = src.filter(F.col("DivisionId") == SPLIT_DIVISION)
    if spec.kind == "shipment":
        src = first_per_key(
            src, ["NativeId", "DivisionId"], order=[F.col("NativeModifiedDate").desc_nulls_last()],
            tiebreak=[c for c in src.columns if c not in ("NativeId", "DivisionId", "NativeModifiedDate")],
            rn_name=None,
        )
    return src


#: The department that the replace loads delete (fixed value).
LOAD_DEPARTMENT = 106


@dataclass(frozen=True)
class LoadScope:
    """Departments that a load deletes or matches in, and whether the match conditions are
    those first written."""

    departments: tuple[int, ...] = (LOAD_DEPARTMENT,)
    as_written: bool = False


@dataclass(frozen=True)
class MergePlan:
    """How a load matches: keys, which rows may match, which target rows go first, and the
    divisions whose rows it can change.  ``matches`` and ``deletes`` say in which divisions, and
    in which of their departments (None: all), the target rows for that can be."""

    keys: tuple[MergeKey, ...]
    target_where: Column | None
    source_where: Column | None
    delete: Column | None
    touched: tuple[int, ...]
    matches: tuple[tuple[int, tuple[int, ...] | None], ...] = ((SPLIT_DIVISION, None),)
    deletes: tuple[tuple[int, tuple[int, ...]], ...] = ()


def merge_plan(spec: LoadSpec, scope: LoadScope = LoadScope()) -> MergePlan:
    in_split = F.col("DivisionId") == SPLIT_DIVISION
    in_departments = F.col("DPT_AUTO_KEY").isin(*scope.departments)
    keys = tuple(MergeKey(k) for k in spec.keys)
    both = (BASE_DIVISION, SPLIT_DIVISION)
    of_departments = tuple((d, scope.departments) for d in both)
    if spec.kind == "receipts":
        stand_ins = {"LineNumber": F.lit(0), "ReceivedDate": ts_literal(NULL_RECEIVED_DATE)}
        keys = tuple(MergeKey(k, stand_ins.get(k)) for k in spec.keys)
        # (the division is a key, and the source has the split unit's only)
        return MergePlan(keys, None, None, in_departments, both, deletes=of_departments)
    if spec.kind == "invoice":
        return MergePlan(keys, in_split, None, in_departments, both, deletes=of_departments)
    if spec.kind == "inventory" and scope.as_written:
        return MergePlan(keys, in_departments, None, None, both, matches=of_departments)
    if spec.kind == "purchase_order" and scope.as_written:
        never = (F.col("DivisionId") == BASE_DIVISION) & in_split
        return MergePlan(keys, never, in_split, None, (SPLIT_DIVISION,), matches=())
    return MergePlan(keys, in_split, in_split, None, (SPLIT_DIVISION,))


def merge_load(
    spec: LoadSpec, target: DataFrame, source: DataFrame, run: RunContext = RunContext(), scope: LoadScope = LoadScope(),
    before: bool = False,
) -> DataFrame:
    """Target rows with ``MergeAction`` (and ``Before``), deleted rows included.  ``target`` has the divisions
    that the load can touch; the receipt guard is applied by the caller."""
    plan = merge_plan(spec, scope)
    src = source.select(*spec.insert_cols)
    stamp: dict[str, Column] = {STAMP: ts_literal(run.run_ts)}
    update = spec.update_cols
    if spec.kind == "receipts":
        src = src.withColumn("ETLImportDate", ts_literal(run.run_ts))
        stamp, update = {}, spec.insert_cols
    return merge_rows(
        target, src, plan.keys, update, spec.insert_cols, stamp, plan.target_where, plan.source_where, plan.delete,
        before,
    )


# --- test targets ------------------------------------------------------------------

def blocked_receipt_target(source: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Receipt target holding every slice row twice more in division 12: the guard
    must block (slice rows ≤ 0.8 × target rows)."""
    spec = SPECS["receipts"]
    full = shape_target(spec, source, source)
    return seed_target(spec, source, tables).unionByName(full).unionByName(full)
