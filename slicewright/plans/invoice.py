"""Invoice slice: invoice lines of one division with a per-line share of the tax.

* tax lines per invoice number: all lines (split unit) or only the entity's lines;
* ``rn`` keeps one row per (invoice, line, division) with a total tie-break;
* the split unit and the entities keep rows by division id (and label) before the
  window, because the division is part of the window key; the base entity's view
  writes a constant division, so its label filter applies after the window;
* long-term flag from the sales-order fact (base-division rows), any true wins.

``invoice_all`` does the same for all divisions in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicewright.config import BASE_DIVISION, SLICES, DivisionSlice, EntityConfig
from slicewright.functions import exprs as X
from slicewright.operators.dedupe import first_per_key, total_order
from slicewright.operators.entity import classify, entity_by_department
from slicewright.operators.lookups import Lookups
from slicewright.plans.common import ADDRESS_LINES, with_billing_address

KEYS = ("INH_AUTO_KEY", "IND_AUTO_KEY")
#: Of the deduplicated lines: one line can be several divisions' (see ``invoice_all``).
ROW_KEY = (*KEYS, "DivisionId")


def tax_lines(inv: DataFrame, label: str | None) -> DataFrame:
    src = inv if label is None else inv.filter(F.col("DEPT_Definition") == F.lit(label))
    return src.groupBy(F.col("INVC_NUMBER").alias("__t_invc")).agg(F.count(F.lit(1)).alias("__t_lines"))


def long_term_by_line(tables: Mapping[str, DataFrame], fact_divisions: Sequence[int]) -> DataFrame:
    so = tables["f_sales_order"].filter(F.col("DivisionId").isin(*fact_divisions))
    return so.groupBy(F.col("NativeLineId").alias("__so_line")).agg(F.max("IsLTA").alias("IsLTA"))


def invoice_slice(
    tables: Mapping[str, DataFrame],
    sl: DivisionSlice | str = "split",
    cfg: EntityConfig = EntityConfig(),
    fact_divisions: Sequence[int] = (BASE_DIVISION,),
) -> DataFrame:
    sl = SLICES[sl] if isinstance(sl, str) else sl
    entity = entity_by_department(tables, cfg)
    raw = tables["stg_invc_detail"]
    detail_cols = raw.columns
    inv = classify(raw, entity, "DPT_AUTO_KEY", "__div", "DEPT_Definition")
    label = None if sl.split_unit else cfg.label_of(sl.division_id)
    tax = tax_lines(inv, label)

    tiebreak = [c for c in detail_cols if c not in KEYS]
    if sl.literal_division:
        inv = inv.withColumn("DivisionId", F.lit(sl.division_id))
        inv = first_per_key(inv, list(KEYS), tiebreak=tiebreak, rn_name="rn")
        inv = inv.filter(F.col("DEPT_Definition") == F.lit(label))
    else:
        inv = inv.withColumn("DivisionId", F.col("__div")).filter(F.col("DivisionId") == sl.division_id)
        if label is not None:
            inv = inv.filter(F.col("DEPT_Definition") == F.lit(label))
        inv = first_per_key(inv, [*KEYS, "DivisionId"], tiebreak=tiebreak, rn_name="rn")

    place = F.col("DPT_AUTO_KEY" if sl.split_unit else "DEPT_Definition")
    return _shaped(tables, inv, tax, F.col("INVC_NUMBER") == tax["__t_invc"], [place], fact_divisions)


#: Scope of the tax share that counts all lines of an invoice number; no entity has it as label.
ALL_LINES = "*"


def scoped_tax_lines(inv: DataFrame) -> DataFrame:
    """Lines per invoice number and scope: an entity's label, or ALL_LINES."""
    by_label = inv.groupBy("INVC_NUMBER", "DEPT_Definition").agg(F.count(F.lit(1)).alias("n"))
    scopes = F.explode(F.array_compact(F.array(F.col("DEPT_Definition"), F.lit(ALL_LINES))))
    counted = by_label.select(F.col("INVC_NUMBER").alias("__t_invc"), scopes.alias("__t_scope"), "n")
    return counted.groupBy("__t_invc", "__t_scope").agg(F.sum("n").alias("__t_lines"))


def invoice_all(
    tables: Mapping[str, DataFrame],
    slices: Sequence[DivisionSlice] = tuple(SLICES.values()),
    cfg: EntityConfig = EntityConfig(),
    fact_divisions: Sequence[int] = (BASE_DIVISION,),
) -> DataFrame:
    """The rows of all ``slices`` in one pass, told apart by ``DivisionId``.

    The slices keep the first line per (invoice, line) in their own lines, but for the base
    entity's, which takes the first of all lines and then looks at its label.  So the first
    line is kept per (invoice, line, slice), where the base entity's and nobody's lines are one
    group; that cuts repeated imports before the shuffle.  The first line of all is the first
    of those few."""
    entity = entity_by_department(tables, cfg)
    raw = tables["stg_invc_detail"]
    inv = classify(raw, entity, "DPT_AUTO_KEY", "__div", "DEPT_Definition")
    tax = scoped_tax_lines(inv)
    own = F.lit(None).cast("int")
    for sl in slices:
        if not sl.literal_division:
            labelled = F.lit(True) if sl.split_unit else F.col("DEPT_Definition") == F.lit(cfg.label_of(sl.division_id))
            own = F.when((F.col("__div") == sl.division_id) & labelled, F.lit(sl.division_id)).otherwise(own)
    tiebreak = [c for c in raw.columns if c not in KEYS]
    firsts = first_per_key(inv.withColumn("__own", own), [*KEYS, "__own"], tiebreak=tiebreak, rn_name="rn")
    literal = [sl for sl in slices if sl.literal_division]
    division = F.col("__own")
    if literal:
        of_all = Window.partitionBy(*KEYS).orderBy(*total_order(firsts, (), tiebreak))
        firsts = firsts.withColumn("__of_all", F.row_number().over(of_all))
        for sl in literal:
            base = F.col("__own").isNull() & (F.col("__of_all") == 1) & (F.col("DEPT_Definition") == F.lit(cfg.label_of(sl.division_id)))
            division = F.when(base, F.lit(sl.division_id)).otherwise(division)
    whole = [sl.division_id for sl in slices if sl.split_unit]
    inv = firsts.withColumn("DivisionId", division).filter(F.col("DivisionId").isNotNull()).drop("__own", "__of_all")
    inv = inv.withColumn("__scope", F.when(~F.col("DivisionId").isin(*whole), F.col("DEPT_Definition")).otherwise(F.lit(ALL_LINES)))
    on = (F.col("INVC_NUMBER") == tax["__t_invc"]) & (F.col("__scope") == tax["__t_scope"])
    # as in the slices: the split unit's rows tell their department, the others their entity
    of_unit = F.col("DivisionId").isin(*whole)
    places = [F.when(of_unit, F.col("DPT_AUTO_KEY")).alias("DPT_AUTO_KEY"), F.when(~of_unit, F.col("DEPT_Definition")).alias("DEPT_Definition")]
    return _shaped(tables, inv, tax, on, places, fact_divisions)


def _shaped(
    tables: Mapping[str, DataFrame], inv: DataFrame, tax: DataFrame, tax_on: Column, places: Sequence[Column],
    fact_divisions: Sequence[int],
) -> DataFrame:
    """Lookups and output columns of deduplicated lines; ``places`` say whose they are."""
    inv = with_billing_address(inv).drop(*ADDRESS_LINES)
    lk = Lookups(inv, ROW_KEY)
    lk.key(tables["d_customer"], "CMP_AUTO_KEY", "CustomerId")
    lk.key(tables["d_employee"], "SYSUR_AUTO_KEY", "EmployeeId")
    lk.key(tables["d_part"], "PNM_AUTO_KEY", "PartId")
    lk.key(tables["d_sales_rep"], "SPN_AUTO_KEY", "SalesRepId")
    lk.key(tables["d_route"], "ROUTE_CODE", "RouteId", native="RouteCode", Source="Sales")
    lta = long_term_by_line(tables, fact_divisions)
    lk.join(lta, F.col("SOD_AUTO_KEY") == lta["__so_line"], key="SOD_AUTO_KEY")
    lk.join(tax, tax_on, key="INVC_NUMBER")
    inv = lk.done()

    return inv.select(
        F.col("INH_AUTO_KEY").alias("NativeId"),
        F.col("IND_AUTO_KEY").alias("NativeLineId"),
        "EmployeeId", "CustomerId", "PartId", "SalesRepId", "RouteId",
        F.col("DivisionId").cast("int").alias("DivisionId"),
        F.col("INVC_NUMBER").alias("InvoiceNumber"),
        F.col("ITEM_NUMBER").alias("LineNumber"),
        F.col("SOD_AUTO_KEY").alias("NativeSOLineId"),
        F.col("INVOICE_DATE").alias("InvoiceDate"),
        X.date_key("INVOICE_DATE").alias("InvoiceDateId"),
        F.col("ORDER_DATE").alias("OrderDate"),
        X.date_key("ORDER_DATE").alias("OrderDateId"),
        F.col("SHIP_DATE").alias("ShipDate"),
        F.col("POST_DATE").alias("PostDate"),
        F.col("POST_DESC").alias("PostStatus"),
        F.col("INVC_TYPE").alias("InvoiceType"),
        F.col("EXCHANGE_RATE").alias("ExchangeRate"),
        X.as_float("QTY_SHIP").alias("QtyShipped"),
        X.as_float("QTY_BACK_ORDER").alias("QtyBackOrdered"),
        X.money("UNIT_COST").alias("UnitCost"),
        X.money("UNIT_PRICE").alias("UnitPrice"),
        X.money_product("UNIT_PRICE", "QTY_SHIP").alias("LinePrice"),
        X.money_product("UNIT_COST", "QTY_SHIP").alias("LineCost"),
        X.money_quotient(X.money("TAX_AMOUNT"), "__t_lines").alias("TaxAmount"),
        "IsLTA",
        *places,
        "BillingCountry", "BillingZipCode", "ETLImportDate",
        F.col("rn").cast("int").alias("rn"),
    )
