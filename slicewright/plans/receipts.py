"""Receipt slice (purchase-order detail fact): received quantity and value per
vendor, part, PO number, line, receipt date and unit cost.

* receipts ⋈ receipt headers ⋈ stock lots ⋈ PO lines (PO number present, cost ≠ 0),
  parts master and owning company as existence joins, vendor through the company
  master, part through the part dimension;
* quantity outliers (≥ 290000 received with a factor other than 1) are divided by
  the factor; unit cost is divided by the factor for unit of measure 4;
* sums are exact decimals (order-independent), turned into floats at the end;
* ``rn`` keeps one group per (vendor, part, line number) across *all* divisions and
  PO numbers, as the view does, then the entity join keeps the division.  The view
  also groups by the company's division (a fan-out by company); every copy of a
  group has the same values, so that join is left out without changing the result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.config import QTY_OUTLIER_THRESHOLD, SPLIT_DIVISION, EntityConfig, RunContext
from slicewright.functions import exprs as X
from slicewright.operators.dedupe import first_per_key
from slicewright.operators.entity import entity_by_department
from slicewright.operators.lookups import key_lookup, lookup_side, scoped

UOM_BY_FACTOR = 4
SUM_TYPE = "decimal(38,8)"
TIEBREAK = ("PONumber", "QuantityReceived", "Complete", "ReceivedDate", "UnitCost", "CalculatedValue",
            "ETLImportDate", "DPT_AUTO_KEY")


def exact_float(c: Column) -> Column:
    """Decimal → float through its decimal text: correctly rounded in any engine."""
    return c.cast("string").cast("double")


def receipt_totals(
    tables: Mapping[str, DataFrame], run: RunContext = RunContext(), strict: bool = False
) -> DataFrame:
    """Received quantity and value per group, every division (before the dedupe).  With
    ``strict`` an outlier with factor zero raises, else its quantity is null."""
    rc = tables["stg_rc_detail"].select("RCD_AUTO_KEY", "RCH_AUTO_KEY", "POD_AUTO_KEY", "ITEM_NUMBER")
    hdr = tables["stg_rc_header"].select("RCH_AUTO_KEY", "SYSCM_AUTO_KEY", F.col("CMP_AUTO_KEY").alias("__rc_cmp"))
    stock = tables["stg_stock"].select(
        F.col("RCD_AUTO_KEY").alias("__st_rcd"), F.col("PNM_AUTO_KEY").alias("__st_pnm"), "QTY_REC", "REC_DATE"
    )
    pod = (
        tables["stg_po_detail"]
        .filter(F.col("PO_NUMBER").isNotNull() & (F.col("UNIT_COST") != 0))
        .select(
            F.col("POD_AUTO_KEY").alias("__po_pod"), "PO_NUMBER", "UNIT_COST", "FACTOR", "UOM_AUTO_KEY",
            F.col("DPT_AUTO_KEY").alias("DPT_AUTO_KEY"),
        )
    )
    pm = tables["stg_parts_master"].select(F.col("PNM_AUTO_KEY").alias("__pm"))
    sc = tables["stg_sys_companies"].select(F.col("SYSCM_AUTO_KEY").alias("__sc"))
    co = tables["stg_companies"].select(F.col("CMP_AUTO_KEY").alias("__co"))

    # the lots meet their parts before the receipts: narrow rows, shuffled by part once for both joins
    # (lots without a part are gone after the first, so no nulls meet in the second)
    part = lookup_side(scoped(tables["d_part"]), "NativeId", ["PartId"]).toDF("__pt", "__part")
    stock = stock.join(pm, F.col("__st_pnm") == F.col("__pm")).join(part, F.col("__st_pnm") == F.col("__pt"), "left")
    stock = stock.select("__st_rcd", "QTY_REC", "REC_DATE", "__part")
    # so do the headers their companies and vendors
    hdr = hdr.join(sc, F.col("SYSCM_AUTO_KEY") == F.col("__sc")).join(co, F.col("__rc_cmp") == F.col("__co"), "left")
    hdr = key_lookup(hdr, tables["d_vendor"], "__co", "VendorId", out="__vendor", default=False)
    hdr = hdr.select("RCH_AUTO_KEY", "SYSCM_AUTO_KEY", "__vendor")
    j = (
        rc.join(hdr, "RCH_AUTO_KEY")
        .join(stock, F.col("RCD_AUTO_KEY") == F.col("__st_rcd"))
        .join(pod, F.col("POD_AUTO_KEY") == F.col("__po_pod"))
    )

    by_factor = (F.col("UOM_AUTO_KEY") == UOM_BY_FACTOR) & (F.col("FACTOR") != 0)
    unit_cost = F.when(by_factor, X.money_quotient("UNIT_COST", "FACTOR")).otherwise(X.money("UNIT_COST"))
    outlier = (F.col("QTY_REC") >= QTY_OUTLIER_THRESHOLD) & (F.col("FACTOR") != 1)
    qty = F.when(outlier, F.try_divide(F.col("QTY_REC"), X.checked_divisor("FACTOR", strict)).cast("decimal(38,6)")).otherwise(F.col("QTY_REC"))
    value = F.when(
        by_factor, F.try_divide(F.col("QTY_REC") * F.col("UNIT_COST"), F.col("FACTOR")).cast("decimal(38,6)")
    ).otherwise(F.col("QTY_REC") * F.col("UNIT_COST"))

    g = j.groupBy(
        "__vendor", "__part", "PO_NUMBER", "ITEM_NUMBER", "REC_DATE", unit_cost.alias("UnitCost"),
        "DPT_AUTO_KEY", "SYSCM_AUTO_KEY",
    ).agg(
        F.sum(qty.cast(SUM_TYPE)).alias("__qty"),
        F.sum(value.cast(SUM_TYPE)).alias("__value"),
    )
    overall = g.select(
        X.key_or_unknown("__vendor").alias("VendorId"),
        X.key_or_unknown("__part").alias("PartId"),
        X.fixed_width("PO_NUMBER", 30).alias("PONumber"),
        F.col("ITEM_NUMBER").alias("LineNumber"),
        exact_float(F.col("__qty")).alias("QuantityReceived"),
        F.lit("U").alias("Complete"),
        F.col("REC_DATE").alias("ReceivedDate"),
        "UnitCost",
        exact_float(F.col("__value")).alias("CalculatedValue"),
        X.ts_literal(run.run_ts).alias("ETLImportDate"),
        "DPT_AUTO_KEY",
    )
    return overall


def receipt_slice(
    tables: Mapping[str, DataFrame],
    cfg: EntityConfig = EntityConfig(),
    run: RunContext = RunContext(),
    division_id: int = SPLIT_DIVISION,
    by_order: bool = False,
    strict: bool = False,
) -> DataFrame:
    """One receipt per vendor, part and line; with ``by_order`` per PO number too, so that
    two orders with one line number keep a receipt each."""
    overall = receipt_totals(tables, run, strict)
    keys = ["VendorId", "PartId", "LineNumber", *(["PONumber"] if by_order else [])]
    ranked = first_per_key(overall, keys, tiebreak=[c for c in TIEBREAK if c not in keys], rn_name="rn")
    entity = entity_by_department(tables, cfg).select(
        F.col("DPT_AUTO_KEY").alias("__e_dpt"), F.col("DivisionId").alias("DivisionId")
    )
    out = ranked.join(entity, ranked["DPT_AUTO_KEY"] == entity["__e_dpt"], "inner").drop("__e_dpt")
    out = out.filter(F.col("DivisionId") == division_id)
    return out.select(*overall.columns, F.col("rn").cast("int").alias("rn"), F.col("DivisionId").cast("int"))
