"""Shipment slice: shipment headers of one division with the invoice roll-up.

* invoice fact (base-division rows) rolled up per (invoice, department) before the
  join — latest date, summed price, greatest number — so a many-line invoice does
  not multiply shipments; the division comes from the roll-up's department;
* shipment header ⋉ shipment detail (only the key is used, and the result is
  DISTINCT, so a semi join is exact);
* whole-row DISTINCT at the end (partial aggregation on the map side).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright.config import BASE_DIVISION, SPLIT_DIVISION, EntityConfig, RunContext
from slicewright.functions import exprs as X
from slicewright.operators.entity import classify, entity_by_department
from slicewright.operators.lookups import Lookups


def invoice_rollup(tables: Mapping[str, DataFrame], fact_divisions: Sequence[int]) -> DataFrame:
    inv = tables["f_invoice"].filter(F.col("DivisionId").isin(*fact_divisions))
    return inv.groupBy("NativeId", "DPT_AUTO_KEY").agg(
        F.max("InvoiceDate").alias("InvoiceDate"),
        F.sum("LinePrice").cast(X.MONEY).alias("InvoicePrice"),
        F.max("InvoiceNumber").alias("InvoiceNumber"),
    )


def shipment_slice(
    tables: Mapping[str, DataFrame],
    cfg: EntityConfig = EntityConfig(),
    run: RunContext = RunContext(),
    division_id: int = SPLIT_DIVISION,
    fact_divisions: Sequence[int] = (BASE_DIVISION,),
) -> DataFrame:
    entity = entity_by_department(tables, cfg)
    inv = classify(invoice_rollup(tables, fact_divisions), entity, "DPT_AUTO_KEY", "DivisionId")
    inv = inv.filter(F.col("DivisionId") == division_id).withColumnRenamed("NativeId", "__inv_id")

    shp = tables["stg_sm_header"]
    det = tables["stg_sm_detail"].select("SMH_AUTO_KEY")
    shp = shp.join(det, "SMH_AUTO_KEY", "left_semi")
    shp = shp.join(inv, shp["INH_AUTO_KEY"] == inv["__inv_id"], "inner")
    lk = Lookups(shp)
    lk.key(tables["d_customer"], "CMP_AUTO_KEY", "CustomerId")
    lk.key(tables["d_employee"], "SYSUR_AUTO_KEY", "EmployeeId")
    lk.key(tables["d_currency"], "CUR_AUTO_KEY", "CurrencyId")
    shp = lk.done()

    out = shp.select(
        F.col("SMH_AUTO_KEY").cast("int").alias("NativeId"),
        F.col("SMH_AUTO_KEY").cast("int").alias("NativeSODId"),
        "CustomerId", "CurrencyId", "EmployeeId",
        F.col("DivisionId").cast("int").alias("DivisionId"),
        F.col("SOH_AUTO_KEY").cast("int").alias("NativeSOId"),
        F.col("INH_AUTO_KEY").cast("int").alias("NativeInvoiceId"),
        F.col("SVC_AUTO_KEY").cast("int").alias("NativeSvcAutoKey"),
        X.fixed_width("SM_NUMBER", 75).alias("ShipmentNumber"),
        X.fixed_width("TRACKING_NUMBER", 100).alias("TrackingNumber"),
        X.letter_flag("OPEN_FLAG").alias("IsOpen"),
        X.date_floor("SHIP_DATE").alias("ShipDate"),
        X.floored_date_key("SHIP_DATE").alias("ShipDateId"),
        X.date_floor("ENTRY_DATE").alias("EntryDate"),
        X.floored_date_key("ENTRY_DATE").alias("EntryDateId"),
        "InvoiceDate",
        "InvoicePrice",
        "InvoiceNumber",
        X.fixed_width("PACKER_NAME", 50).alias("PackerName"),
        X.fixed_width("SM_UDF_002", 10).alias("WarehouseLocation"),
        F.col("SHIP_PRIORITY").cast("int").alias("ShipmentPriority"),
        F.col("SMS_UPDATE").alias("NativeModifiedDate"),
        F.col("DATE_CREATED").alias("NativeCreatedDate"),
        X.ts_literal(run.run_ts).alias("ETLImportDate"),
        "SMS_AUTO_KEY", "SM_UDF_002", "WHS_TO", "DPT_AUTO_KEY",
    )
    return out.distinct()
