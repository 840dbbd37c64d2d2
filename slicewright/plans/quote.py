"""Quote slice: quote lines of one division with a has-stock flag.

Has-stock: the quoted part's native key is among the parts whose on-hand quantity
in the inventory fact (base-division rows) sums above zero — a grouped aggregate
with a HAVING filter, joined back as a key set.  No dedupe in this view.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright.config import BASE_DIVISION, SPLIT_DIVISION, EntityConfig, RunContext
from slicewright.functions import exprs as X
from slicewright.operators.entity import classify, entity_by_department
from slicewright.operators.lookups import Lookups, scoped
from slicewright.plans.common import part_native_by_id


def parts_with_stock(tables: Mapping[str, DataFrame], fact_divisions: Sequence[int]) -> DataFrame:
    inv = tables["f_inventory"].filter(F.col("DivisionId").isin(*fact_divisions)).select("PartId", "QtyOnHand")
    parts = part_native_by_id(tables).select("PartId", "NativeId")
    j = inv.join(parts, "PartId", "left")
    return (
        j.groupBy("NativeId")
        .agg(F.sum("QtyOnHand").alias("__q"))
        .filter(F.col("__q") > 0)
        .select(F.col("NativeId").alias("__qoh_part"))
    )


def with_stock_flag(tables: Mapping[str, DataFrame], quotes: DataFrame, fact_divisions: Sequence[int]) -> DataFrame:
    """Quote lines with ``HasQOH``: 1 if their part is in the part dimension and its stock is above 0."""
    qoh = parts_with_stock(tables, fact_divisions)
    lk = Lookups(quotes)
    lk.add(scoped(tables["d_part"]), "PNM_AUTO_KEY", "NativeId", {"__pt_found": "PartId"})
    lk.join(qoh, (F.col("PNM_AUTO_KEY") == qoh["__qoh_part"]) & lk.col("__pt_found").isNotNull())
    flag = F.when(F.col("__qoh_part").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("HasQOH")
    return lk.done().select(*quotes.columns, flag)


def quote_slice(
    tables: Mapping[str, DataFrame],
    cfg: EntityConfig = EntityConfig(),
    run: RunContext = RunContext(),
    division_id: int = SPLIT_DIVISION,
    fact_divisions: Sequence[int] = (BASE_DIVISION,),
) -> DataFrame:
    entity = entity_by_department(tables, cfg)
    qt = classify(tables["stg_cq_detail"], entity, "DPT_AUTO_KEY", "DivisionId")
    qt = qt.filter(F.col("DivisionId") == division_id)
    lk = Lookups(qt)
    lk.key(tables["d_customer"], "CMP_AUTO_KEY", "CustomerId")
    lk.key(tables["d_employee"], "SYSUR_AUTO_KEY", "EmployeeId")
    lk.add(scoped(tables["d_part"]), "PNM_AUTO_KEY", "NativeId",
           {"PartId": "PartId", "PartNumber": "PartNumber", "__pt_found": "PartId"}, default_unknown=("PartId",))
    lk.add(scoped(tables["d_part"]), "ALT_PNM_AUTO_KEY", "NativeId",
           {"AltPartId": "PartId", "__alt_number": "PartNumber"}, default_unknown=("AltPartId",))
    lk.key(tables["d_sales_rep"], F.coalesce(F.col("SPN_AUTO_KEY_LINE"), F.col("SPN_AUTO_KEY")), "SalesRepId")
    qoh = parts_with_stock(tables, fact_divisions)
    # the stock test goes through the division-1 part lookup: no part row, no stock
    lk.join(qoh, (F.col("PNM_AUTO_KEY") == qoh["__qoh_part"]) & lk.col("__pt_found").isNotNull())
    qt = lk.done()

    return qt.select(
        F.col("CQH_AUTO_KEY").alias("NativeId"),
        F.col("CQD_AUTO_KEY").alias("NativeLineId"),
        "CustomerId", "EmployeeId", "PartId", "AltPartId", "SalesRepId",
        F.col("DivisionId").cast("int").alias("DivisionId"),
        F.col("CQ_NUMBER").alias("QuoteNumber"),
        F.col("ITEM_NUMBER").alias("LineNumber"),
        X.date_floor("DUE_DATE").alias("DueDate"),
        F.col("DATE_CREATED").alias("DateCreated"),
        X.date_floor("ENTRY_DATE").alias("QuoteDate"),
        X.floored_date_key("ENTRY_DATE").alias("QuoteDateId"),
        X.date_floor("SENT_DATE").alias("SentDate"),
        X.as_float("QTY_QUOTED").alias("QtyQuoted"),
        X.as_float("QTY_REQ").alias("QtyRequired"),
        X.money("UNIT_COST").alias("UnitCost"),
        X.money("UNIT_PRICE").alias("UnitPrice"),
        X.money_product("UNIT_PRICE", "QTY_QUOTED").alias("LinePrice"),
        X.money_product("UNIT_COST", "QTY_QUOTED").alias("LineCost"),
        F.col("EXCHANGE_RATE").alias("ExchangeRate"),
        X.letter_flag("SO_FLAG").alias("SOFlag"),
        X.letter_flag("SOD_LINK").alias("SOLinked"),
        X.letter_flag("PRINTED").alias("IsPrinted"),
        X.letter_flag("HISTORICAL_FLAG").alias("IsHistorical"),
        F.when(F.col("__qoh_part").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("HasQOH"),
        "PartNumber",
        X.ts_literal(run.run_ts).alias("ETLImportDate"),
        "DPT_AUTO_KEY",
    )
