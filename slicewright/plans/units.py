"""Operator-level jobs: each runs one operator of the slice and load jobs on its own,
over whole input tables, so every operator can be checked against its SQL oracle.

They call the same functions the slice jobs use; nothing here is a separate path.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright.config import BASE_DIVISION, QTY_OUTLIER_THRESHOLD, SLICES, EntityConfig, RunContext
from slicewright.functions import exprs as X
from slicewright.operators.addresses import default_rules, split_address
from slicewright.operators.dedupe import first_per_key
from slicewright.operators.entity import classify, entity_by_department, entity_dim
from slicewright.operators.lookups import key_lookup, lookup, scoped
from slicewright.operators.merge import delete_where
from slicewright.operators.ranges import range_lookup
from slicewright.plans import invoice as INV
from slicewright.plans import sales_order as SO
from slicewright.plans.common import (
    latest_po_cost,
    part_classes,
    part_native_by_id,
    with_billing_address,
)
from slicewright.plans.inventory import age_band_by_month, manufacturers
from slicewright.plans.purchase_order import account_by_po_header, last_receipt_dates
from slicewright.plans.quote import parts_with_stock, with_stock_flag
from slicewright.plans.receipts import receipt_totals
from slicewright.plans.shipment import invoice_rollup
from slicewright.sources.collation import collated, plain

T = Mapping[str, DataFrame]
UNITS: dict[str, Callable[[T], DataFrame]] = {}


def unit(key: str):
    def deco(fn):
        UNITS[key] = fn
        return fn

    return deco


SO_KEYS = ("SOH_AUTO_KEY", "SOD_AUTO_KEY")


# --- scalar expressions over one staging table -----------------------------------

@unit("date_floor")
def _date_floor(t: T) -> DataFrame:
    return t["stg_so_detail"].select(*SO_KEYS, "ENTRY_DATE", X.date_floor("ENTRY_DATE").alias("OrderDate"))


@unit("date_key")
def _date_key(t: T) -> DataFrame:
    return t["stg_so_detail"].select(
        *SO_KEYS, X.floored_date_key("ENTRY_DATE").alias("OrderDateId"),
        X.floored_date_key("SHIP_DATE").alias("ShipDateId"), X.date_key("ENTRY_DATE").alias("RawDateId"),
    )


@unit("letter_flag")
def _letter_flag(t: T) -> DataFrame:
    return t["stg_po_detail"].select(
        "POH_AUTO_KEY", "POD_AUTO_KEY", X.letter_flag("OPEN_FLAG").alias("IsOpen"),
        X.letter_flag("RESALE_FLAG").alias("IsResale"), X.letter_flag("DROP_SHIP").alias("IsDropShip"),
    )


@unit("open_flag")
def _open_flag(t: T) -> DataFrame:
    return t["stg_so_detail"].select(*SO_KEYS, X.open_flag("OPEN_FLAG", "QTY_ORDERED", "QTY_DELIVERED").alias("IsOpen"))


@unit("long_term_flag")
def _long_term_flag(t: T) -> DataFrame:
    return t["stg_so_detail"].select(*SO_KEYS, "SO_NUMBER", X.long_term_flag("SO_NUMBER").alias("IsLTA"))


@unit("null_default")
def _null_default(t: T) -> DataFrame:
    return t["stg_stock"].select(
        "STM_AUTO_KEY", F.coalesce("PART_CERT_NUMBER", F.lit("N/A")).alias("CertNumber"),
        F.coalesce("REVISION", F.lit("N/A")).alias("Revision"),
    )


@unit("money_cast")
def _money_cast(t: T) -> DataFrame:
    return t["stg_invc_detail"].select(
        "INH_AUTO_KEY", "IND_AUTO_KEY", X.money("UNIT_COST").alias("UnitCost"), X.money("UNIT_PRICE").alias("UnitPrice"),
        X.as_float("QTY_SHIP").alias("QtyShipped"),
    )


@unit("fixed_width_cast")
def _fixed_width(t: T) -> DataFrame:
    return t["stg_sm_header"].select(
        F.col("SMH_AUTO_KEY").cast("int").alias("NativeId"), X.fixed_width("SM_NUMBER", 75).alias("ShipmentNumber"),
        X.fixed_width("TRACKING_NUMBER", 100).alias("TrackingNumber"), X.fixed_width("PACKER_NAME", 50).alias("PackerName"),
        X.fixed_width("SM_UDF_002", 10).alias("WarehouseLocation"), F.col("SHIP_PRIORITY").cast("int").alias("ShipmentPriority"),
    )


@unit("safe_date")
def _safe_date(t: T) -> DataFrame:
    return t["stg_po_detail"].select("POH_AUTO_KEY", "POD_AUTO_KEY", "COMMIT_SHIP_DATE2",
                                     F.col("COMMIT_SHIP_DATE2").try_cast("date").alias("ETADate"))


@unit("extended_amounts")
def _extended(t: T) -> DataFrame:
    return t["stg_stock"].select(
        "STM_AUTO_KEY", X.money_product("UNIT_COST", "QTY_OH").alias("CurrentCost"),
        X.money_product("UNIT_PRICE", "QTY_OH").alias("CurrentValue"),
        X.money_product("UNIT_COST", "QTY_REC").alias("OriginalCost"),
        X.money_product("UNIT_PRICE", "QTY_REC").alias("OriginalValue"),
    )


@unit("open_quantity")
def _open_quantity(t: T) -> DataFrame:
    return t["stg_po_detail"].select(
        "POH_AUTO_KEY", "POD_AUTO_KEY", X.as_float(F.col("QTY_ORDERED") * F.col("FACTOR") - F.col("QTY_REC")).alias("QtyOpen"),
    )


@unit("uom_unit_cost")
def _uom_unit_cost(t: T) -> DataFrame:
    by_factor = (F.col("UOM_AUTO_KEY") == 4) & (F.col("FACTOR") != 0)
    return t["stg_po_detail"].select(
        "POH_AUTO_KEY", "POD_AUTO_KEY", X.money_quotient("UNIT_COST", "FACTOR").alias("POUnitCost"),
        F.when(by_factor, X.money_quotient("UNIT_COST", "FACTOR")).otherwise(X.money("UNIT_COST")).alias("ReceiptUnitCost"),
    )


@unit("warehouse_region_label")
def _region(t: T) -> DataFrame:
    po = lookup(t["stg_po_detail"].select("POH_AUTO_KEY", "POD_AUTO_KEY", "WHS_AUTO_KEY"), t["stg_warehouse"],
                "WHS_AUTO_KEY", "WHS_AUTO_KEY", {"warehouse_code": "warehouse_code"})
    return po.select("POH_AUTO_KEY", "POD_AUTO_KEY", "warehouse_code", X.region_label("warehouse_code").alias("warehouse"))


@unit("billing_address")
def _address(t: T) -> DataFrame:
    return with_billing_address(t["stg_so_detail"]).select(*SO_KEYS, "BillingCountry", "BillingZipCode")


@unit("qty_outlier_fix")
def _outlier(t: T) -> DataFrame:
    rc = t["stg_rc_detail"].select("RCD_AUTO_KEY", "POD_AUTO_KEY")
    st = t["stg_stock"].select(F.col("RCD_AUTO_KEY").alias("__rcd"), "QTY_REC")
    po = t["stg_po_detail"].select(F.col("POD_AUTO_KEY").alias("__pod"), "FACTOR")
    j = rc.join(st, F.col("RCD_AUTO_KEY") == F.col("__rcd")).join(po, F.col("POD_AUTO_KEY") == F.col("__pod"))
    out = (F.col("QTY_REC") >= QTY_OUTLIER_THRESHOLD) & (F.col("FACTOR") != 1)
    return j.select(
        "RCD_AUTO_KEY", "POD_AUTO_KEY", "QTY_REC", "FACTOR",
        F.when(out, F.try_divide("QTY_REC", "FACTOR").cast("decimal(38,6)")).otherwise(F.col("QTY_REC"))
        .cast("decimal(38,6)").alias("QtyRepaired"),
    )


# --- lookups -------------------------------------------------------------------------

def _so(t: T, *cols: str) -> DataFrame:
    return t["stg_so_detail"].select(*SO_KEYS, *cols)


@unit("surrogate_key_lookup")
def _surrogate(t: T) -> DataFrame:
    df = key_lookup(_so(t, "CMP_AUTO_KEY", "SYSUR_AUTO_KEY", "WHS_AUTO_KEY"), t["d_customer"], "CMP_AUTO_KEY", "CustomerId")
    df = key_lookup(df, t["d_employee"], "SYSUR_AUTO_KEY", "EmployeeId")
    return key_lookup(df, t["d_warehouse"], "WHS_AUTO_KEY", "WarehouseId")


@unit("route_lookup")
def _route(t: T) -> DataFrame:
    so = key_lookup(_so(t, "ROUTE_CODE"), t["d_route"], "ROUTE_CODE", "RouteId", native="RouteCode", Source="Sales")
    return so


@unit("rep_line_over_header")
def _rep(t: T) -> DataFrame:
    so = _so(t, "SPN_AUTO_KEY_LINE", "SPN_AUTO_KEY")
    return key_lookup(so, t["d_sales_rep"], F.coalesce(F.col("SPN_AUTO_KEY_LINE"), F.col("SPN_AUTO_KEY")), "SalesRepId")


@unit("alternate_part_lookup")
def _alt(t: T) -> DataFrame:
    so = key_lookup(_so(t, "PNM_AUTO_KEY", "ALT_PNM_AUTO_KEY"), t["d_part"], "PNM_AUTO_KEY", "PartId")
    return key_lookup(so, t["d_part"], "ALT_PNM_AUTO_KEY", "PartId", out="AltPartId")


@unit("staging_lookup")
def _staging(t: T) -> DataFrame:
    so = lookup(_so(t, "CTH_AUTO_KEY"), t["stg_contract_header"], "CTH_AUTO_KEY", "CTH_AUTO_KEY",
                {"CONTRACT_NUMBER": "CONTRACT_NUMBER"})
    return so


@unit("entity_lookup")
def _entity_lookup(t: T) -> DataFrame:
    inv = t["stg_invc_detail"].select("INH_AUTO_KEY", "IND_AUTO_KEY", "DPT_AUTO_KEY")
    return classify(inv, entity_by_department(t), "DPT_AUTO_KEY", "DivisionId", "DEPT_Definition")


@unit("invoice_long_term_flag")
def _inv_lta(t: T) -> DataFrame:
    inv = t["stg_invc_detail"].select("INH_AUTO_KEY", "IND_AUTO_KEY", "SOD_AUTO_KEY")
    lta = INV.long_term_by_line(t, (BASE_DIVISION,))
    return inv.join(lta, inv["SOD_AUTO_KEY"] == lta["__so_line"], "left").drop("__so_line")


@unit("reverse_part_lookup")
def _reverse(t: T) -> DataFrame:
    po = t["f_purchase_order"].select("NativeLineId", "PartId")
    parts = part_native_by_id(t)
    return po.join(parts, "PartId", "left").select("NativeLineId", "PartId", F.col("NativeId").alias("PartAutoKey"), "PartNumber")


@unit("manufacturer_by_name")
def _mfg(t: T) -> DataFrame:
    st = t["stg_stock"].select("STM_AUTO_KEY", "IC_UDF_005")
    return key_lookup(st, manufacturers(t), F.rtrim("IC_UDF_005"), "ManufacturerId", native="ManufacturerName")


@unit("age_band")
def _age(t: T) -> DataFrame:
    run = RunContext()
    st = t["stg_stock"].select("STM_AUTO_KEY", "REC_DATE")
    months = X.months_between_boundaries(F.col("REC_DATE"), X.ts_literal(run.run_ts))
    ages = age_band_by_month(t["d_age"], st.select(months.alias("__age_m")).distinct())
    j = st.join(ages, months == F.col("__age_m"), "left")
    return j.select("STM_AUTO_KEY", "REC_DATE", X.key_or_unknown("__age_id").alias("AgeId"))


@unit("prev_month_class")
def _prev_month(t: T) -> DataFrame:
    so = lookup(_so(t, "PNM_AUTO_KEY", "SHIP_DATE"), scoped(t["d_part"]), "PNM_AUTO_KEY", "NativeId",
                {"PartNumber": "PartNumber"})
    classes = part_classes(t)
    prev = X.month_number(F.add_months(F.col("SHIP_DATE").cast("date"), -1))
    j = so.join(classes, (F.col("PartNumber") == F.col("__pc_part")) & (prev == F.col("__pc_month")), "left")
    return j.select(*SO_KEYS, "PartNumber", "SHIP_DATE",
                    F.coalesce(F.col("__pc_class"), F.lit("Z")).alias("ProductClass"))


@unit("latest_po_cost")
def _latest_cost(t: T) -> DataFrame:
    return latest_po_cost(t, t["f_purchase_order"].filter(F.col("DivisionId") == BASE_DIVISION))


@unit("cost_fallback")
def _cost_fallback(t: T) -> DataFrame:
    so = _so(t, "PNM_AUTO_KEY", "UNIT_COST", "QTY_ORDERED")
    costs = latest_po_cost(t, t["f_purchase_order"].filter(F.col("DivisionId") == BASE_DIVISION))
    j = so.join(costs, so["PNM_AUTO_KEY"] == costs["PartAutoKey"], "left")
    cost = F.coalesce(F.nullif(X.money("UNIT_COST"), F.lit(0).cast(X.MONEY)), F.col("PoUnitCost"))
    return j.select(*SO_KEYS, cost.alias("UnitCost"), X.money_product(cost, "QTY_ORDERED").alias("LineCost"))


@unit("tax_per_line")
def _tax(t: T) -> DataFrame:
    inv = t["stg_invc_detail"]
    tax = INV.tax_lines(inv, None)
    j = inv.join(tax, inv["INVC_NUMBER"] == tax["__t_invc"], "left")
    return j.select("INH_AUTO_KEY", "IND_AUTO_KEY", F.col("__t_lines").alias("Lines"),
                    X.money_quotient(X.money("TAX_AMOUNT"), "__t_lines").alias("TaxAmount"))


@unit("has_stock_flag")
def _has_stock(t: T) -> DataFrame:
    return parts_with_stock(t, (BASE_DIVISION,)).select(F.col("__qoh_part").alias("NativeId"))


@unit("invoice_rollup")
def _rollup(t: T) -> DataFrame:
    return invoice_rollup(t, (BASE_DIVISION,))


@unit("account_lookup")
def _account(t: T) -> DataFrame:
    return account_by_po_header(t)


@unit("last_receipt_date")
def _last_receipt(t: T) -> DataFrame:
    return last_receipt_dates(t).select(F.col("__rd_po").alias("PO_NUMBER"), F.col("__rd_item").alias("ITEM_NUMBER"),
                                        "last_rec_date")


@unit("existence_join")
def _exists(t: T) -> DataFrame:
    det = t["stg_sm_detail"].select("SMH_AUTO_KEY")
    return t["stg_sm_header"].join(det, "SMH_AUTO_KEY", "left_semi").select("SMH_AUTO_KEY", "INH_AUTO_KEY")


@unit("receipt_totals")
def _receipt_totals(t: T) -> DataFrame:
    return receipt_totals(t)


# --- dedupe windows (whole tables, every division) -----------------------------------

@unit("latest_per_line")
def _latest_line(t: T) -> DataFrame:
    return SO.latest_lines(t["stg_so_detail"]).select(*SO_KEYS, "ETLImportDate", "PNM_AUTO_KEY", "QTY_ORDERED", "rownum")


@unit("invoice_dedupe")
def _inv_dedupe(t: T) -> DataFrame:
    raw = t["stg_invc_detail"]
    inv = classify(raw, entity_by_department(t), "DPT_AUTO_KEY", "DivisionId")
    out = first_per_key(inv, [*INV.KEYS, "DivisionId"], tiebreak=[c for c in raw.columns if c not in INV.KEYS], rn_name="rn")
    return out.select(*INV.KEYS, "DivisionId", "INVC_NUMBER", "PNM_AUTO_KEY", "QTY_SHIP", "rn")


@unit("inventory_dedupe")
def _stock_dedupe(t: T) -> DataFrame:
    raw = t["stg_stock"]
    st = classify(raw, entity_by_department(t), "DPT_AUTO_KEY", "DivisionId")
    out = first_per_key(st, ["STM_AUTO_KEY", "DivisionId"], tiebreak=[c for c in raw.columns if c != "STM_AUTO_KEY"],
                        rn_name="rn")
    return out.select("STM_AUTO_KEY", "DivisionId", "PNM_AUTO_KEY", "QTY_REC", "rn")


@unit("po_dedupe")
def _po_dedupe(t: T) -> DataFrame:
    raw = t["stg_po_detail"]
    keys = ["POH_AUTO_KEY", "POD_AUTO_KEY"]
    out = first_per_key(raw, keys, tiebreak=[c for c in raw.columns if c not in keys], rn_name="rn")
    return out.select(*keys, "PNM_AUTO_KEY", "QTY_ORDERED", "rn")


@unit("receipt_dedupe")
def _receipt_dedupe(t: T) -> DataFrame:
    from slicewright.plans.receipts import TIEBREAK

    return first_per_key(receipt_totals(t), ["VendorId", "PartId", "LineNumber"], tiebreak=list(TIEBREAK), rn_name="rn")


# --- sink primitive ------------------------------------------------------------------

@unit("delete_where")
def _delete(t: T) -> DataFrame:
    cfg = EntityConfig()
    return delete_where(t["f_invoice"], F.col("DPT_AUTO_KEY").isin(*cfg.split_departments))


__all__ = ["UNITS", "SLICES"]


# --- text comparison by a collation ------------------------------------------------

#: Compared columns and the key whose parity decides how the tests respell them.
RESPELLED = {
    "stg_sys_companies": ("company_name", "SYSCM_AUTO_KEY"),
    "stg_division": ("division_name", "DIV_AUTO_KEY"),
    "stg_warehouse": ("warehouse_code", "WHS_AUTO_KEY"),
    "stg_stock": ("IC_UDF_005", "STM_AUTO_KEY"),
    "d_manufacturer": ("ManufacturerName", "ManufacturerId"),
}


def respelled(t: T) -> T:
    """Test tables whose compared texts differ in case and trailing blanks: upper case and two
    blanks at even keys, lower case at odd ones."""
    for name, (text, key) in RESPELLED.items():
        spelled = F.when(F.col(key) % 2 == 0, F.concat(F.upper(text), F.lit("  "))).otherwise(F.lower(text))
        t = t.with_table(name, t[name].withColumn(text, spelled))
    return t


def _caseless(job: Callable[[T], DataFrame]) -> Callable[[T], DataFrame]:
    return lambda t: plain(job(collated(respelled(t))))


UNITS["entity_dim_caseless"] = _caseless(entity_dim)
UNITS["warehouse_region_label_caseless"] = _caseless(_region)
UNITS["manufacturer_by_name_caseless"] = _caseless(_mfg)


@unit("age_band_by_days")
def _age_days(t: T) -> DataFrame:
    """Bands of 30-day months that run on 45 days into the next: the lowest and their number."""
    bands = t["d_age"].select(
        "AgeId", (F.col("MinMonth").cast("long") * 30).alias("low"), (F.col("MaxMonth").cast("long") * 30 + 45).alias("high")
    )
    days = F.datediff(F.lit(RunContext().run_ts.date()), F.col("REC_DATE").cast("date")).alias("Days")
    st = t["stg_stock"].select("STM_AUTO_KEY", "REC_DATE", days)
    found = range_lookup(st, "Days", bands, "low", "high", {"AgeId": F.min("AgeId"), "Bands": F.count(F.lit(1))})
    return found.select(
        "STM_AUTO_KEY", "REC_DATE", X.key_or_unknown("AgeId").alias("AgeId"), F.coalesce("Bands", F.lit(0).cast("long")).alias("Bands")
    )


@unit("has_stock_by_quote")
def _quote_stock(t: T) -> DataFrame:
    return with_stock_flag(t, t["stg_cq_detail"].select("CQH_AUTO_KEY", "CQD_AUTO_KEY", "PNM_AUTO_KEY"), (BASE_DIVISION,))


def foreign_addresses(detail: DataFrame) -> DataFrame:
    """Test addresses of five kinds by header: as given, British, Canadian, Chinese and US."""
    kind, digit = F.pmod(F.col("SOH_AUTO_KEY"), F.lit(5)), F.pmod(F.col("SOD_AUTO_KEY"), F.lit(10)).cast("string")
    four = (
        F.when(kind == 1, F.concat(F.lit("London, sw1a "), digit, F.lit("aa")))
        .when(kind == 2, F.concat(F.lit("TORONTO M"), digit, F.lit("V "), digit, F.lit("T"), digit))
        .when(kind == 3, F.concat(F.lit("Beijing 1000"), digit, digit))
        .when(kind == 4, F.concat(F.lit("Troy NY 12180-123"), digit))
    )
    five = F.when(kind == 1, "Great  Britain").when(kind == 2, "Can.").when(kind == 3, "P.R.C.").when(kind == 4, "U.S.A.")
    return detail.withColumns({
        "BILL_ADDRESS4": F.coalesce(four, "BILL_ADDRESS4"), "BILL_ADDRESS5": F.coalesce(five, "BILL_ADDRESS5"),
    })


@unit("billing_address_by_tables")
def _address_tables(t: T) -> DataFrame:
    so = foreign_addresses(t["stg_so_detail"])
    return split_address(so, *default_rules(so.sparkSession)).select(*SO_KEYS, "BillingCountry", "BillingZipCode")
