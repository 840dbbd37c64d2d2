"""Sales-order slice: order lines of one division, shaped for the sales-order fact.

Plan (one lazy DataFrame):

1. latest import per order line: ``row_number`` over (header key, line key) by
   import date, total tie-break on the detail columns; planned as a partial
   ``WindowGroupLimit`` before the shuffle;
2. header (one row per header key) ⟕ status ⟕ lowest division of the company ⟕
   entity (broadcast) → keep the slice's division.  The division depends on the
   header only, so the filter runs before every dimension lookup;
3. dimension lookups (division-1 scope, ``-1`` default), contract number, latest
   purchase-order cost per part, previous month's product class, address split;
4. the 47 output columns, ``rownum`` and ``Rank`` (both 1 after the filter).

``sales_order_all`` does the same for all divisions in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.config import (
    BASE_DIVISION,
    DEFAULT_PRODUCT_CLASS,
    SLICES,
    DivisionSlice,
    EntityConfig,
)
from slicewright.functions import exprs as X
from slicewright.operators.broadcast import is_bounded
from slicewright.operators.dedupe import first_per_key, one_per_key
from slicewright.operators.entity import classify, entity_by_department
from slicewright.operators.lookups import Lookups, lookup, lookup_side, scoped
from slicewright.plans.common import (
    ADDRESS_LINES,
    class_months_by_part,
    latest_po_cost,
    latest_po_costs,
    min_division_per_company,
    with_billing_address,
)

DETAIL_KEYS = ("SOH_AUTO_KEY", "SOD_AUTO_KEY")

OUTPUT_COLUMNS = (
    "NativeId", "NativeLineId", "CustomerId", "SalesRepId", "PartId", "AltPartId",
    "EmployeeId", "WarehouseId", "RouteId", "SYSCM_AUTO_KEY", "DPT_AUTO_KEY",
    "DIV_AUTO_KEY", "DivisionId", "SONumber", "LineNumber", "NativeQuoteLineId",
    "OrderDate", "OrderDateId", "ShipDate", "ShipDateId", "DueDate", "DeliveryDate",
    "UnitPrice", "UnitCost", "LinePrice", "LineCost", "Discount", "QtyOrdered",
    "QtyShipped", "QtyInvoiced", "QtyAllocated", "QtyOpen", "ExchangeRate", "IsOpen",
    "NativeModifiedDate", "NativeModifiedDateLine", "BillingCountry", "BillingZipCode",
    "IsLTA", "ETLImportDate", "ProductClass", "Status", "CTD_AUTO_KEY", "CTH_AUTO_KEY",
    "CONTRACT_NUMBER", "rownum", "Rank",
)


def latest_lines(detail: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Latest import per (header, line) key; ``rownum`` kept (= 1).  Ties are broken by the
    detail's ``columns`` (all, by default)."""
    tiebreak = [c for c in columns or detail.columns if c not in DETAIL_KEYS and c != "ETLImportDate"]
    return first_per_key(
        detail,
        list(DETAIL_KEYS),
        order=[F.col("ETLImportDate").desc_nulls_last()],
        tiebreak=tiebreak,
        rn_name="rownum",
    )


def headers_in_divisions(tables: Mapping[str, DataFrame], entity: DataFrame, divisions: Sequence[int]) -> DataFrame:
    h = one_per_key(
        tables["stg_so_header"],
        "SOH_AUTO_KEY",
        ["DPT_AUTO_KEY", "SYSCM_AUTO_KEY", "SOS_AUTO_KEY"],
    )
    h = classify(h, entity, "DPT_AUTO_KEY", "DivisionId").filter(F.col("DivisionId").isin(*divisions))
    h = lookup(h, tables["stg_so_status"], "SOS_AUTO_KEY", "SOS_AUTO_KEY", {"Status": "DESCRIPTION"})
    h = h.join(min_division_per_company(tables), "SYSCM_AUTO_KEY", "left")
    return h.select(
        F.col("SOH_AUTO_KEY").alias("__h_soh"),
        "SYSCM_AUTO_KEY", "DPT_AUTO_KEY", "DIV_AUTO_KEY", "DivisionId", "Status",
    )


def po_cost_scope(
    tables: Mapping[str, DataFrame], entity: DataFrame, sl: DivisionSlice, fact_divisions: Sequence[int]
) -> DataFrame:
    po = tables["f_purchase_order"]
    if sl.split_unit:
        # the split unit prices from the base division's purchase orders
        return po.filter(F.col("DivisionId").isin(*fact_divisions))
    # other entities: purchase orders whose department belongs to the entity
    return classify(po, entity, "DPT_AUTO_KEY", "__po_div").filter(F.col("__po_div") == sl.division_id)


def scoped_po_costs(
    tables: Mapping[str, DataFrame], entity: DataFrame, slices: Sequence[DivisionSlice], fact_divisions: Sequence[int]
) -> DataFrame:
    """Latest costs per part, a column for each slice (``cost_name``), in one pass over the
    purchase orders: a row counts for its department's entity, and in the fact's own base
    divisions for the split unit too."""
    po = classify(tables["f_purchase_order"], entity, "DPT_AUTO_KEY", "__po_div")
    in_base = F.col("DivisionId").isin(*fact_divisions)
    own = lambda sl: F.col("__po_div") == sl.division_id
    return latest_po_costs(tables, po, {cost_name(sl): in_base if sl.split_unit else own(sl) for sl in slices})


def cost_name(sl: DivisionSlice) -> str:
    return f"__cost_{sl.division_id}"


def detail_of(tables: Mapping[str, DataFrame], h: DataFrame) -> DataFrame:
    """The latest lines of the headers ``h``, with the headers' columns."""
    detail = tables["stg_so_detail"]
    if is_bounded(tables["stg_so_header"]):
        # the header decides the division and is in the dedupe key: other divisions' lines go
        # before the sort, in the scan's stage, and the partial limit stays
        so = detail.join(F.broadcast(h), detail["SOH_AUTO_KEY"] == h["__h_soh"])
        return latest_lines(so, detail.columns).drop("__h_soh")
    so = latest_lines(detail)
    return so.join(h, so["SOH_AUTO_KEY"] == h["__h_soh"]).drop("__h_soh")


def sales_order_slice(
    tables: Mapping[str, DataFrame],
    sl: DivisionSlice | str = "split",
    cfg: EntityConfig = EntityConfig(),
    fact_divisions: Sequence[int] = (BASE_DIVISION,),
) -> DataFrame:
    sl = SLICES[sl] if isinstance(sl, str) else sl
    entity = entity_by_department(tables, cfg)
    so = detail_of(tables, headers_in_divisions(tables, entity, [sl.division_id]))
    costs = latest_po_cost(tables, po_cost_scope(tables, entity, sl, fact_divisions))
    return _shaped(tables, so, costs, F.col("PoUnitCost"), F.lit(sl.division_id), fact_divisions)


def sales_order_all(
    tables: Mapping[str, DataFrame],
    slices: Sequence[DivisionSlice] = tuple(SLICES.values()),
    cfg: EntityConfig = EntityConfig(),
    fact_divisions: Sequence[int] = (BASE_DIVISION,),
) -> DataFrame:
    """The rows of all ``slices`` in one pass.  A header has one division, so a line belongs to
    one slice at most: the lines are read, deduplicated and looked up once, and ``DivisionId``
    tells the slices apart.  Only the purchase-order cost depends on the slice: the part's
    costs are joined, and a row takes its division's."""
    entity = entity_by_department(tables, cfg)
    so = detail_of(tables, headers_in_divisions(tables, entity, [sl.division_id for sl in slices]))
    costs = scoped_po_costs(tables, entity, slices, fact_divisions)
    cost = F.coalesce(*[F.when(F.col("DivisionId") == sl.division_id, F.col(cost_name(sl))) for sl in slices])
    return _shaped(tables, so, costs, cost, F.col("DivisionId").cast("int"), fact_divisions)


def _shaped(
    tables: Mapping[str, DataFrame], so: DataFrame, costs: DataFrame, cost: Column, division: Column,
    fact_divisions: Sequence[int],
) -> DataFrame:
    """Lookups and output columns of deduplicated lines.  A line's cost is made from its part's ``costs``."""
    # the address lines end here: two short columns go on instead of four
    so = with_billing_address(so).drop(*ADDRESS_LINES)
    # lines that were shuffled to headers which aren't broadcast lie by the header key; those staged by
    # bucket lie in another number of partitions
    shuffled = not is_bounded(tables["stg_so_header"]) and "stg_so_detail" not in getattr(tables, "bucketed", ())
    lk = Lookups(so, DETAIL_KEYS, DETAIL_KEYS[:1] if shuffled else ())
    lk.key(tables["d_customer"], "CMP_AUTO_KEY", "CustomerId")
    lk.key(tables["d_employee"], "SYSUR_AUTO_KEY", "EmployeeId")
    lk.add(scoped(tables["d_part"]), "PNM_AUTO_KEY", "NativeId",
           {"PartId": "PartId", "__pt_number": "PartNumber"}, default_unknown=("PartId",))
    lk.add(scoped(tables["d_part"]), "ALT_PNM_AUTO_KEY", "NativeId",
           {"AltPartId": "PartId", "__alt_number": "PartNumber"}, default_unknown=("AltPartId",))
    lk.key(tables["d_sales_rep"], F.coalesce(F.col("SPN_AUTO_KEY_LINE"), F.col("SPN_AUTO_KEY")), "SalesRepId")
    lk.key(tables["d_route"], "ROUTE_CODE", "RouteId", native="RouteCode", Source="Sales")
    lk.key(tables["d_warehouse"], "WHS_AUTO_KEY", "WarehouseId")
    lk.add(tables["stg_contract_header"], "CTH_AUTO_KEY", "CTH_AUTO_KEY", {"CONTRACT_NUMBER": "CONTRACT_NUMBER"})

    lk.join(costs, key="PNM_AUTO_KEY", side_key=F.col("PartAutoKey"), picks={"PoUnitCost": cost})

    # the part's number is its key's, so its classes are found by the key too
    classes = class_months_by_part(tables, lookup_side(scoped(tables["d_part"]), "NativeId", ["PartId", "PartNumber"]), fact_divisions)
    prev_month = X.month_number(F.add_months(F.col("SHIP_DATE").cast("date"), -1))
    lk.join(classes, key="PNM_AUTO_KEY", side_key=F.col("__pc_native"), picks={"__pc_class": F.col("__pc_classes")[prev_month]})
    so = lk.done()

    unit_cost = F.coalesce(F.nullif(X.money("UNIT_COST"), F.lit(0).cast(X.MONEY)), F.col("PoUnitCost"))
    return so.select(
        F.col("SOH_AUTO_KEY").alias("NativeId"),
        F.col("SOD_AUTO_KEY").alias("NativeLineId"),
        "CustomerId", "SalesRepId", "PartId", "AltPartId", "EmployeeId", "WarehouseId", "RouteId",
        "SYSCM_AUTO_KEY", "DPT_AUTO_KEY", "DIV_AUTO_KEY",
        division.alias("DivisionId"),
        F.col("SO_NUMBER").alias("SONumber"),
        F.col("ITEM_NUMBER").alias("LineNumber"),
        F.col("CQD_AUTO_KEY").alias("NativeQuoteLineId"),
        X.date_floor("ENTRY_DATE").alias("OrderDate"),
        X.floored_date_key("ENTRY_DATE").alias("OrderDateId"),
        X.date_floor("SHIP_DATE").alias("ShipDate"),
        X.floored_date_key("SHIP_DATE").alias("ShipDateId"),
        X.date_floor("DELIVERY_DATE").alias("DueDate"),
        X.date_floor("NEXT_SHIP_DATE").alias("DeliveryDate"),
        X.money("UNIT_PRICE").alias("UnitPrice"),
        unit_cost.alias("UnitCost"),
        X.money_product("UNIT_PRICE", "QTY_ORDERED").alias("LinePrice"),
        X.money_product(unit_cost, "QTY_ORDERED").alias("LineCost"),
        X.money("DISCOUNT").alias("Discount"),
        X.as_float("QTY_ORDERED").alias("QtyOrdered"),
        X.as_float("QTY_DELIVERED").alias("QtyShipped"),
        X.as_float("QTY_INVOICED").alias("QtyInvoiced"),
        X.as_float("QTY_RESERVED").alias("QtyAllocated"),
        X.as_float(F.col("QTY_ORDERED") - F.col("QTY_DELIVERED")).alias("QtyOpen"),
        F.col("EXCHANGE_RATE").alias("ExchangeRate"),
        X.open_flag("OPEN_FLAG", "QTY_ORDERED", "QTY_DELIVERED").alias("IsOpen"),
        F.col("LAST_MODIFIED").alias("NativeModifiedDate"),
        F.col("LAST_MODIFIED_LINE").alias("NativeModifiedDateLine"),
        "BillingCountry", "BillingZipCode",
        X.long_term_flag("SO_NUMBER").alias("IsLTA"),
        "ETLImportDate",
        F.coalesce(F.col("__pc_class"), F.lit(DEFAULT_PRODUCT_CLASS)).alias("ProductClass"),
        "Status", "CTD_AUTO_KEY", "CTH_AUTO_KEY", "CONTRACT_NUMBER",
        F.col("rownum").cast("int").alias("rownum"),
        F.lit(1).alias("Rank"),
    )
