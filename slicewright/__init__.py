"""slicewright: re-divide a data warehouse by business entity, as Spark DataFrame jobs.

Layers
------
``sources``    table catalog (staging, dimension and fact tables) and fixture relations
``functions``  column expressions (money, date floor and key, flags, address split)
``operators``  reusable relational steps (entity classification, scoped key lookup,
               deterministic first-per-key, merge upsert, conditional delete, reclassify)
``plans``      the slice jobs (sales order, invoice, inventory, purchase order, receipts,
               quote, shipment) and the load jobs with their run log
``streaming``  nothing: every load in this domain is a batch job
``oracle``     DuckDB SQL for each registered query, used only by the correctness check
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
