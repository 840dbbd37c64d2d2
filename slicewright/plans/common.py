"""Pieces shared by several slices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.config import BASE_DIVISION
from slicewright.functions.address import billing_country, billing_zip


ADDRESS_LINES = tuple(f"BILL_ADDRESS{i}" for i in (2, 3, 4, 5))


def with_billing_address(df: DataFrame, prefix: str = "BILL_ADDRESS") -> DataFrame:
    a = [F.col(f"{prefix}{i}") for i in (2, 3, 4, 5)]
    return df.withColumn("BillingCountry", billing_country(*a)).withColumn(
        "BillingZipCode", billing_zip(*a)
    )


def part_native_by_id(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Reverse lookup of the part dimension: PartId → NativeId, PartNumber (any division)."""
    from slicewright.operators.lookups import lookup_side

    side = lookup_side(tables["d_part"], "PartId", ["NativeId", "PartNumber"])
    return side.toDF("PartId", "NativeId", "PartNumber")


def latest_po_costs(tables: Mapping[str, DataFrame], po: DataFrame, scopes: Mapping[str, Column]) -> DataFrame:
    """Latest purchase-order unit cost per native part key (``PartAutoKey``): one column for each of
    ``scopes``, over the rows of ``po`` that its condition holds for.

    Latest = greatest PODate, then greatest cost (nulls lowest): a grouped max over
    a struct, i.e. a partial aggregate that is safe for hot parts.  It is taken per part id
    first, so that few rows go on to the part's native key.
    """
    parts = part_native_by_id(tables).select("PartId", F.col("NativeId").alias("PartAutoKey"))
    dated = F.struct("PODate", "UnitCost")
    latest = (
        po.filter(F.col("PartId").isNotNull() & reduce(Column.__or__, scopes.values()))
        .groupBy("PartId")
        .agg(*[F.max(F.when(where, dated)).alias(name) for name, where in scopes.items()])
    )
    j = latest.join(parts, "PartId", "left")
    agg = j.filter(F.col("PartAutoKey").isNotNull()).groupBy("PartAutoKey").agg(*[F.max(name).alias(name) for name in scopes])
    return agg.select("PartAutoKey", *[F.col(name).getField("UnitCost").alias(name) for name in scopes])


def latest_po_cost(tables: Mapping[str, DataFrame], po_scope: DataFrame) -> DataFrame:
    """``PartAutoKey`` and its latest ``PoUnitCost`` of the purchase-order fact already restricted to the cost scope."""
    return latest_po_costs(tables, po_scope, {"PoUnitCost": F.lit(True)})


def part_classes(tables: Mapping[str, DataFrame], divisions: Sequence[int] = (BASE_DIVISION,)) -> DataFrame:
    """Product class per (part number, calendar month) from the inventory snapshots.

    One row per key: the latest snapshot in the month, then the greatest class.
    ``MonthNo`` = year * 12 + month.
    """
    ih = tables["f_inventory_history"].filter(F.col("DivisionId").isin(*divisions))
    parts = part_native_by_id(tables).select("PartId", "PartNumber")
    j = ih.select("AsOfDate", "PartId", "ProductClass").join(parts, "PartId", "left")
    j = j.withColumn("MonthNo", F.year("AsOfDate") * 12 + F.month("AsOfDate"))
    agg = j.groupBy("PartNumber", "MonthNo").agg(F.max(F.struct("AsOfDate", "ProductClass")).alias("__m"))
    return agg.select(
        F.col("PartNumber").alias("__pc_part"),
        F.col("MonthNo").alias("__pc_month"),
        F.col("__m.ProductClass").alias("__pc_class"),
    )


def class_months_by_part(tables: Mapping[str, DataFrame], part: DataFrame, divisions: Sequence[int] = (BASE_DIVISION,)) -> DataFrame:
    """Native part key (``__pc_native``) and the classes of its part number by month (a map, as long as there
    are months).  ``part`` has one row per native key: key, id, number.

    Rows that are with their part already find their month's class there; a join on part number
    and month would shuffle them once more."""
    known = part_classes(tables, divisions).dropna()
    month = F.struct("__pc_month", "__pc_class")
    classes = known.groupBy("__pc_part").agg(F.map_from_entries(F.collect_list(month)).alias("__pc_classes"))
    key, _, number = part.columns
    native = part.select(F.col(key).alias("__pc_native"), F.col(number).alias("__pc_number"))
    return native.join(classes, F.col("__pc_number") == F.col("__pc_part")).select("__pc_native", "__pc_classes")


def min_division_per_company(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Company → its lowest division key (the division join by company fans out)."""
    return (
        tables["stg_division"]
        .groupBy("SYSCM_AUTO_KEY")
        .agg(F.min("DIV_AUTO_KEY").alias("DIV_AUTO_KEY"))
    )
