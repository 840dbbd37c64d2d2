"""Purchase-order slice: PO lines of one division with receipts, account and places.

* ``rn`` keeps one row per (PO, line) with a total tie-break, computed over every
  division (the division is not in the window key), then the division filter;
* last receipt date per (PO number, line number): receipts ⋈ headers ⋈ PO lines,
  grouped max — pre-aggregated, so it joins without fan-out;
* account: AP detail ⟕ AP account ⟕ GL account, one row per PO header;
* SO department by document number, PO department by key; region label ladder.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright.config import SPLIT_DIVISION, EntityConfig
from slicewright.functions import exprs as X
from slicewright.operators.dedupe import first_per_key, one_per_key
from slicewright.operators.entity import classify, entity_by_department
from slicewright.operators.lookups import Lookups, lookup, scoped

KEYS = ("POH_AUTO_KEY", "POD_AUTO_KEY")


def last_receipt_dates(tables: Mapping[str, DataFrame]) -> DataFrame:
    rc = tables["stg_rc_detail"].select("RCH_AUTO_KEY", "POD_AUTO_KEY", "ENTRY_DATE")
    hdr = tables["stg_rc_header"].select("RCH_AUTO_KEY")
    pod = tables["stg_po_detail"].select("POD_AUTO_KEY", "PO_NUMBER", "ITEM_NUMBER")
    j = rc.join(hdr, "RCH_AUTO_KEY").join(pod, "POD_AUTO_KEY")
    return j.groupBy(F.col("PO_NUMBER").alias("__rd_po"), F.col("ITEM_NUMBER").alias("__rd_item")).agg(
        F.max("ENTRY_DATE").alias("last_rec_date")
    )


def account_by_po_header(tables: Mapping[str, DataFrame]) -> DataFrame:
    ap = tables["stg_ap_detail"].select("POH_AUTO_KEY", "APA_AUTO_KEY")
    apc = one_per_key(tables["stg_ap_account"], "APA_AUTO_KEY", ["GLA_AUTO_KEY"])
    gl = one_per_key(tables["stg_gl_account"], "GLA_AUTO_KEY", ["ACCOUNT_TYPE_DESC", "DESCRIPTION"])
    j = ap.join(apc, "APA_AUTO_KEY", "left").join(gl, "GLA_AUTO_KEY", "left")
    return one_per_key(j, "POH_AUTO_KEY", ["ACCOUNT_TYPE_DESC", "DESCRIPTION"])


def purchase_order_slice(
    tables: Mapping[str, DataFrame],
    cfg: EntityConfig = EntityConfig(),
    division_id: int = SPLIT_DIVISION,
    strict: bool = False,
) -> DataFrame:
    """The slice; with ``strict`` a zero factor fails it, else its unit cost is null (see
    :func:`zero_factors` for their number)."""
    entity = entity_by_department(tables, cfg)
    raw = tables["stg_po_detail"]
    po = first_per_key(raw, list(KEYS), tiebreak=[c for c in raw.columns if c not in KEYS], rn_name="rn")
    po = classify(po, entity, "DPT_AUTO_KEY", "DivisionId").filter(F.col("DivisionId") == division_id)

    dept = tables["stg_department"]
    so_hdr = one_per_key(tables["stg_so_header"], "SO_NUMBER", ["DPT_AUTO_KEY"])
    so_dept = lookup(so_hdr, dept, "DPT_AUTO_KEY", "DPT_AUTO_KEY", {"__so_dept": "dept_name"})
    acct = account_by_po_header(tables).withColumnRenamed("POH_AUTO_KEY", "__ap_poh")
    rd = last_receipt_dates(tables)

    lk = Lookups(po, KEYS)
    lk.add(tables["stg_warehouse"], "WHS_AUTO_KEY", "WHS_AUTO_KEY", {"__wh_code": "warehouse_code"})
    lk.join(acct, F.col("POH_AUTO_KEY") == acct["__ap_poh"])
    lk.add(so_dept, "PO_NUMBER", "SO_NUMBER", {"SO_DEPT_NAME": "__so_dept"})
    lk.add(dept, "DPT_AUTO_KEY", "DPT_AUTO_KEY", {"PO_DEPT_NAME": "dept_name"})
    lk.join(rd, (F.col("PO_NUMBER") == rd["__rd_po"]) & (F.col("ITEM_NUMBER") == rd["__rd_item"]))
    lk.key(tables["d_vendor"], "CMP_AUTO_KEY", "VendorId")
    lk.key(tables["d_employee"], "SYSUR_AUTO_KEY", "EmployeeId")
    lk.key(tables["d_customer"], "CMP_BUYER", "CustomerId")
    lk.key(tables["d_warehouse"], "WHS_AUTO_KEY", "WarehouseId")
    lk.add(scoped(tables["d_part"]), "PNM_AUTO_KEY", "NativeId", {"PartId": "PartId", "UOM": "UoM"},
           default_unknown=("PartId",))
    lk.add(scoped(tables["d_part"]), "ALT_PNM_AUTO_KEY", "NativeId", {"AltPartId": "PartId", "__alt_uom": "UoM"},
           default_unknown=("AltPartId",))
    lk.key(tables["d_route"], "ROUTE_CODE", "RouteId", native="RouteCode", Source="Purchasing")
    po = lk.done()

    return po.select(
        F.col("POH_AUTO_KEY").alias("NativeId"),
        F.col("POD_AUTO_KEY").alias("NativeLineId"),
        "VendorId", "EmployeeId", "CustomerId", "WarehouseId", "PartId", "AltPartId", "RouteId",
        "DPT_AUTO_KEY",
        F.col("DivisionId").cast("int").alias("DivisionId"),
        F.col("PO_NUMBER").alias("PONumber"),
        F.col("ITEM_NUMBER").alias("LineNumber"),
        X.date_floor("ENTRY_DATE").alias("PODate"),
        X.floored_date_key("ENTRY_DATE").alias("PODateId"),
        X.date_floor("last_rec_date").alias("ShipDate"),
        F.col("COMMIT_SHIP_DATE2").try_cast("date").alias("ETADate"),
        F.col("last_rec_date").alias("DeliveryDate"),
        F.col("QTY_BACK_ORDER").alias("QtyBackOrdered"),
        F.col("QTY_ORDERED").alias("QtyOrdered"),
        F.col("QTY_REC").alias("QtyReceived"),
        X.as_float(F.col("QTY_ORDERED") * F.col("FACTOR") - F.col("QTY_REC")).alias("QtyOpen"),
        X.money_quotient("UNIT_COST", X.checked_divisor("FACTOR", strict)).alias("UnitCost"),
        X.money_product("UNIT_COST", "QTY_ORDERED").alias("LineCost"),
        X.money("VENDOR_PRICE").alias("VendorPrice"),
        X.letter_flag("OPEN_FLAG").alias("IsOpen"),
        X.letter_flag("RESALE_FLAG").alias("IsResale"),
        X.letter_flag("DROP_SHIP").alias("IsDropShip"),
        F.col("LAST_MODIFIED").alias("NativeModifiedDate"),
        F.col("LAST_MODIFIEDLINE").alias("NativeModifiedDateLine"),
        "ETLImportDate", "UOM", "Remarks", "CNC_AUTO_KEY", "COMMIT_SHIP_DATE2",
        "SO_DEPT_NAME", "PO_DEPT_NAME", "ACCOUNT_TYPE_DESC", "DESCRIPTION",
        X.region_label("__wh_code").alias("warehouse"),
        F.col("rn").cast("int").alias("rn"),
    )


def zero_factors(tables: Mapping[str, DataFrame], cfg: EntityConfig = EntityConfig()) -> DataFrame:
    """Order lines per division whose factor is zero: their unit cost can't be computed."""
    lines = classify(tables["stg_po_detail"], entity_by_department(tables, cfg), "DPT_AUTO_KEY", "DivisionId")
    zero = F.sum(F.when(F.col("FACTOR") == 0, 1).otherwise(0))
    return lines.groupBy("DivisionId").agg(F.count(F.lit(1)).alias("Lines"), zero.cast("bigint").alias("ZeroFactors"))
