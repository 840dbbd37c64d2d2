"""Inventory slice: stock lots of one division with cost and value, age band, maker.

* division from the lot's department; kept before the window (it is in the key);
* ``rn`` keeps one row per (lot, division) with a total tie-break;
* age band: month boundaries between receipt and the run clock; the distinct counts
  that occur get their band (the lowest wins on overlap), then an equi-join;
* manufacturer by name, part condition without default.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright.config import NOT_APPLICABLE, SPLIT_DIVISION, EntityConfig, RunContext
from slicewright.functions import exprs as X
from slicewright.operators.dedupe import first_per_key
from slicewright.operators.entity import classify, entity_by_department
from slicewright.operators.lookups import Lookups

KEYS = ("STM_AUTO_KEY", "DivisionId")


def age_band_by_month(ages: DataFrame, months: DataFrame) -> DataFrame:
    """(__age_m, __age_id): each month count that occurs, and the lowest AgeId whose
    [MinMonth, MaxMonth] holds it; a band with a null bound holds nothing.

    ``months`` has the distinct counts in column ``__age_m``: as many as there are
    months between the oldest receipt and the run, however wide a band is.  They and
    the bands of the dimension meet in one row of two arrays.
    """
    band = F.struct("AgeId", F.col("MinMonth").cast("long").alias("low"), F.col("MaxMonth").cast("long").alias("high"))
    tagged = ages.filter(F.col("MinMonth") <= F.col("MaxMonth")).select(F.lit(None).cast("int").alias("__age_m"), band.alias("band"))
    tagged = tagged.unionByName(months.select(F.col("__age_m").cast("int").alias("__age_m")), allowMissingColumns=True)
    both = tagged.agg(F.collect_set("__age_m").alias("months"), F.collect_list("band").alias("bands"))
    holds = F.filter("bands", lambda b: (b["low"] <= F.col("__age_m")) & (F.col("__age_m") <= b["high"]))
    return (
        both.select("bands", F.explode("months").alias("__age_m"))
        .select("__age_m", F.array_min(holds.getField("AgeId")).alias("__age_id"))
        .filter(F.col("__age_id").isNotNull())
    )


def manufacturers(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Manufacturers by name; trailing blanks don't count."""
    return tables["d_manufacturer"].withColumn("ManufacturerName", F.rtrim("ManufacturerName"))


def inventory_slice(
    tables: Mapping[str, DataFrame],
    cfg: EntityConfig = EntityConfig(),
    run: RunContext = RunContext(),
    division_id: int = SPLIT_DIVISION,
) -> DataFrame:
    entity = entity_by_department(tables, cfg)
    raw = tables["stg_stock"]
    st = classify(raw, entity, "DPT_AUTO_KEY", "DivisionId").filter(F.col("DivisionId") == division_id)
    st = first_per_key(
        st, list(KEYS), tiebreak=[c for c in raw.columns if c != "STM_AUTO_KEY"], rn_name="rn"
    )
    lk = Lookups(st, KEYS)
    lk.key(tables["d_vendor"], "CMP_AUTO_KEY", "VendorId")
    lk.key(tables["d_employee"], "SYSUR_AUTO_KEY", "EmployeeId")
    lk.key(tables["d_part"], "PNM_AUTO_KEY", "PartId")
    lk.key(tables["d_warehouse"], "WHS_AUTO_KEY", "WarehouseId")
    lk.key(tables["d_location"], "LOC_AUTO_KEY", "LocationId")
    lk.key(tables["d_warehouse"], "WHS_ORIGINAL", "WarehouseId", out="OriginalWarehouseId")
    lk.key(tables["d_location"], "LOC_ORIGINAL", "LocationId", out="OriginalLocationId")
    lk.key(manufacturers(tables), F.rtrim("IC_UDF_005"), "ManufacturerId", native="ManufacturerName")
    lk.key(tables["d_part_condition"], "PCC_AUTO_KEY", "PartConditionId", default=False)
    months = X.months_between_boundaries(F.col("REC_DATE"), X.ts_literal(run.run_ts))
    occurring = raw.select(months.alias("__age_m")).distinct()
    lk.join(age_band_by_month(tables["d_age"], occurring), months == F.col("__age_m"))
    st = lk.done()

    return st.select(
        F.col("STM_AUTO_KEY").alias("NativeId"),
        "PartId",
        F.col("IC_UDF_006").alias("LotNumber"),
        "VendorId", "LocationId", "OriginalLocationId", "WarehouseId", "OriginalWarehouseId", "EmployeeId",
        "DPT_AUTO_KEY",
        F.col("DivisionId").cast("int").alias("DivisionId"),
        X.key_or_unknown("__age_id").alias("AgeId"),
        "ManufacturerId",
        F.col("IND_AUTO_KEY").alias("NativeInvoiceLineId"),
        F.col("POD_AUTO_KEY").alias("NativePOLineId"),
        F.col("ORIGINAL_PO_NUMBER").alias("PONumber"),
        F.col("REC_DATE").alias("ReceivedDate"),
        F.col("QTY_REC").alias("QtyReceived"),
        F.col("QTY_OH").alias("QtyOnHand"),
        F.col("QTY_RESERVED").alias("QtyReserved"),
        F.col("QTY_AVAILABLE").alias("QtyAvailable"),
        X.money("UNIT_COST").alias("UnitCost"),
        X.money("UNIT_PRICE").alias("UnitPrice"),
        X.money_product("UNIT_COST", "QTY_OH").alias("CurrentCost"),
        X.money_product("UNIT_PRICE", "QTY_OH").alias("CurrentValue"),
        X.money_product("UNIT_COST", "QTY_REC").alias("OriginalCost"),
        X.money_product("UNIT_PRICE", "QTY_REC").alias("OriginalValue"),
        X.letter_flag("HISTORICAL_FLAG").alias("IsHistorical"),
        F.col("CHANGE_TIMESTAMP").alias("NativeModifiedDate"),
        "ETLImportDate",
        "PartConditionId",
        F.lit(NOT_APPLICABLE).alias("TestRptCode"),
        F.coalesce(F.col("PART_CERT_NUMBER"), F.lit(NOT_APPLICABLE)).alias("CertNumber"),
        F.coalesce(F.col("REVISION"), F.lit(NOT_APPLICABLE)).alias("Revision"),
        F.col("rn").cast("int").alias("rn"),
    )
