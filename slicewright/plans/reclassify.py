"""Reclassification of already-loaded fact rows.

Rows of the split unit's departments that still sit in the base division move to
the entity's division and get ``IsSplit = 1``; every other row is unchanged.  One
function for all seven facts: a left join of the entity on the
department and two conditional columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright.config import BASE_DIVISION, SPLIT_DIVISION, EntityConfig
from slicewright.operators.entity import entity_by_department
from slicewright.operators.merge import reclassify

#: Warehouse table of each fact.
FACT_TABLES = {
    "sales_order": "f_SalesOrder",
    "invoice": "f_Invoice",
    "inventory": "f_Inventory",
    "purchase_order": "f_PurchaseOrder",
    "receipts": "f_PurchaseOrderDetail",
    "quote": "f_Quote",
    "shipment": "f_Shipment",
}
#: Column that says whether a row was moved.
moved = "__moved"


def reclassify_fact(
    tables: Mapping[str, DataFrame], fact: DataFrame, cfg: EntityConfig = EntityConfig(), mark: bool = False
) -> DataFrame:
    entity = entity_by_department(tables, cfg)
    return reclassify(fact, entity, cfg.label_of(SPLIT_DIVISION), BASE_DIVISION, mark=moved if mark else None)


def with_split_flag(fact: DataFrame, relabel_base: bool = False) -> DataFrame:
    """A fact as loaded before the split: optional division reset to the base
    division, ``IsSplit`` null."""
    if relabel_base:
        fact = fact.withColumn("DivisionId", F.lit(BASE_DIVISION).cast(fact.schema["DivisionId"].dataType))
    return fact.withColumn("IsSplit", F.lit(None).cast("int"))
