"""Registered jobs and queries.

``JOBS``: key → callable(spark, tables) → DataFrame, over a :class:`Tables` catalog.
``QUERIES``: key → callable(spark, sf_dir) → DataFrame, the same jobs over the
relations derived from the test tables in ``sf_dir`` (whole tables, no sampling).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright.config import SLICES, EntityConfig
from slicewright.operators.entity import entity_dim
from slicewright.operators.incremental import absorb, read_state
from slicewright.operators.merge import ACTION, AFTER, BEFORE, DELETE, KEEP
from slicewright.plans.inventory import inventory_slice
from slicewright.plans.invoice import invoice_all, invoice_slice
from slicewright.plans.loads import SPECS, LoadScope, blocked_receipt_target, merge_plan, seed_target
from slicewright.plans.purchase_order import purchase_order_slice, zero_factors
from slicewright.plans.quote import quote_slice
from slicewright.plans.receipts import receipt_slice
from slicewright.plans.reclassify import FACT_TABLES, reclassify_fact, with_split_flag
from slicewright.plans.runner import COUNTS, run_load, run_reclassify
from slicewright.plans.refresh import run_refresh
from slicewright.plans.sales_order import DETAIL_KEYS, sales_order_all, sales_order_slice
from slicewright.plans.shipment import shipment_slice
from slicewright.plans.units import UNITS
from slicewright.session import STORED, frees_shuffles, scratch_path
from slicewright.sources import snapshot
from slicewright.sources.bucketing import BUCKET_KEYS, stage_bucketed
from slicewright.sources.catalog import fixture_tables

Job = Callable[[SparkSession, Mapping[str, DataFrame]], DataFrame]
Query = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}


JOBS["entity_dim"] = lambda spark, t: entity_dim(t)
for _k in SLICES:
    JOBS[f"sales_order_slice_{_k}"] = lambda spark, t, k=_k: sales_order_slice(t, k)
for _k in SLICES:
    JOBS[f"invoice_slice_{_k}"] = lambda spark, t, k=_k: invoice_slice(t, k)
JOBS["sales_order_all"] = lambda spark, t: sales_order_all(t)
JOBS["invoice_all"] = lambda spark, t: invoice_all(t)
JOBS["inventory_slice_split"] = lambda spark, t: inventory_slice(t)
JOBS["quote_slice_split"] = lambda spark, t: quote_slice(t)
JOBS["shipment_slice_split"] = lambda spark, t: shipment_slice(t)
JOBS["purchase_order_slice_split"] = lambda spark, t: purchase_order_slice(t)
JOBS["receipt_slice_split"] = lambda spark, t: receipt_slice(t)
JOBS["receipt_slice_by_order"] = lambda spark, t: receipt_slice(t, by_order=True)
def _bucketed(job: Callable[[Mapping[str, DataFrame]], DataFrame], keys: Sequence[str]) -> Job:
    """A slice over staging tables that are written by bucket of their join key first."""

    def run(spark, t):
        tag = uuid.uuid4().hex[:12]
        root = scratch_path(spark, "bucketed", tag)
        return job(stage_bucketed(spark, t, root, tag, QUERY_BUCKETS, {k: BUCKET_KEYS[k] for k in keys}))

    return run


#: Buckets of the queries over the test tables.
QUERY_BUCKETS = 8
JOBS["sales_order_slice_bucketed"] = _bucketed(sales_order_slice, ("stg_so_header", "stg_so_detail"))
JOBS["receipt_slice_bucketed"] = _bucketed(receipt_slice, ("stg_rc_header", "stg_rc_detail", "stg_stock"))
JOBS["zero_factors"] = lambda spark, t: zero_factors(t)


@frees_shuffles
def _store(spark, rows: DataFrame, path: str) -> None:
    rows.write.options(**STORED).parquet(path)


class LoadRun:
    """One load over a seeded warehouse, run as the scheduled job runs it: the slice is staged,
    a target is published, and ``run_load`` does the rest."""

    def __init__(self, spark, t, kind: str, scope: LoadScope = LoadScope(), blocked: bool = False, spoiled: bool = False,
                 changes: bool = False):
        spec = SPECS[kind]
        self.spark, self.root = spark, scratch_path(spark, "load-queries", uuid.uuid4().hex)
        self.target, self.log = f"{self.root}/{spec.target_name}", f"{self.root}/run_log"
        self.audit, self.touched = f"{self.root}/audit", merge_plan(spec, scope).touched
        _store(spark, JOBS[spec.slice_job](spark, t), f"{self.root}/slice")
        rows = spark.read.parquet(f"{self.root}/slice")
        seed = blocked_receipt_target(rows, t) if blocked else seed_target(spec, rows, t)
        snapshot.publish(spark, seed, self.target)
        try:
            self.result = run_load(
                spark, kind, rows.unionByName(rows) if spoiled else rows, self.target, self.log, scope=scope, audit_path=None if changes else self.audit, changes=changes,
            )
        except ValueError:
            if not spoiled:
                raise
            self.result = {"Status": "FAIL"}

    def rows(self) -> DataFrame:
        """The published target with what the load did to each row."""
        changed = self.spark.read.parquet(self.audit).filter(F.col(ACTION) != DELETE).drop("changed")
        rest = snapshot.read_current(self.spark, self.target, without=self.touched)
        return changed.unionByName(rest.withColumn(ACTION, F.lit(KEEP)))

    def changes(self) -> DataFrame:
        """The stored change feed: each changed row's columns as they were and as they are."""
        feed = snapshot.read_changes(self.spark, self.target)
        sides = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in (BEFORE, AFTER) for c in feed.schema[side].dataType.names]
        return feed.select(ACTION, *sides)

    def logged(self) -> DataFrame:
        return self.spark.read.parquet(self.log).drop("LogId", "LoggedAt")

    def counts(self) -> DataFrame:
        return self.logged().filter(F.col("Status") == "PASS").select(*COUNTS)


def _load_job(kind: str, scope: LoadScope = LoadScope()) -> Job:
    return lambda spark, t: LoadRun(spark, t, kind, scope).rows()


def _guard_blocked(spark, t):
    """A blocked receipt load: its log row, the guard's numbers and the rows left in storage."""
    run = LoadRun(spark, t, "receipts", blocked=True)
    left = snapshot.read_current(spark, run.target).count()
    numbers = {**{c: run.result[c] for c in ("SourceRows", "TargetRows")}, "TargetRowsAfter": left}
    passed = run.logged().filter(F.col("Status") == "PASS")
    return passed.select(*[F.lit(n).cast("bigint").alias(c) for c, n in numbers.items()], *COUNTS, "Status", "Message")


def _reclassify_counts(fact: str) -> Job:
    """A published fact is reclassified as a job: logged counts and rows per division after it."""

    def run(spark, t):
        root = scratch_path(spark, "load-queries", uuid.uuid4().hex)
        table, log = f"{root}/{FACT_TABLES[fact]}", f"{root}/run_log"
        snapshot.publish(spark, _unmoved(spark, t, fact), table)
        done = run_reclassify(spark, fact, t, table, log)
        after = snapshot.read_current(spark, table).groupBy("DivisionId").agg(
            F.count(F.lit(1)).alias("RowsAfter"), F.sum(F.coalesce(F.col("IsSplit"), F.lit(0))).cast("bigint").alias("SplitRows")
        )
        return after.select("*", *[F.lit(done[c]).cast("bigint").alias(c) for c in COUNTS])

    return run


def _refreshed(family: str) -> Job:
    """All entities published in one refresh: rows and line prices of each division's folder,
    beside the logged counts."""

    def run(spark, t):
        root = scratch_path(spark, "load-queries", uuid.uuid4().hex)
        done = run_refresh(spark, family, t, f"{root}/{family}", f"{root}/run_log")
        after = snapshot.read_current(spark, f"{root}/{family}").groupBy("DivisionId").agg(
            F.count(F.lit(1)).alias("RowsAfter"), F.sum("LinePrice").cast("decimal(38,4)").alias("LinePrice")
        )
        return after.select("*", *[F.lit(done[c]).cast("bigint").alias(c) for c in ("RowsRead", "RowsWritten")])

    return run


for _k in ("sales_order", "invoice"):
    JOBS[f"refresh_{_k}"] = _refreshed(_k)
_RECLASS_SEED = {"sales_order": "f_sales_order", "invoice": "f_invoice", "inventory": "f_inventory",
                 "purchase_order": "f_purchase_order"}
_RECLASS_SLICE = {"receipts": "receipt_slice_split", "quote": "quote_slice_split",
                  "shipment": "shipment_slice_split"}


def _unmoved(spark, t, fact: str) -> DataFrame:
    """A fact as loaded before the split."""
    if fact in _RECLASS_SEED:
        return with_split_flag(t[_RECLASS_SEED[fact]])
    return with_split_flag(JOBS[_RECLASS_SLICE[fact]](spark, t), relabel_base=True)


for _k in SPECS:
    JOBS[f"load_{_k}"] = _load_job(_k)
    JOBS[f"load_changes_{_k}"] = lambda spark, t, k=_k: LoadRun(spark, t, k, changes=True).changes()
    JOBS[f"load_counts_{_k}"] = lambda spark, t, k=_k: LoadRun(spark, t, k).counts()
ALL_DEPARTMENTS = LoadScope(EntityConfig().split_departments)
JOBS["load_purchase_order_as_written"] = _load_job("purchase_order", LoadScope(as_written=True))
JOBS["load_inventory_as_written"] = _load_job("inventory", LoadScope(as_written=True))
JOBS["load_invoice_all_departments"] = _load_job("invoice", ALL_DEPARTMENTS)
JOBS["load_receipts_all_departments"] = _load_job("receipts", ALL_DEPARTMENTS)
JOBS["load_receipts_guard_blocked"] = _guard_blocked
JOBS["run_log"] = lambda spark, t: LoadRun(spark, t, "sales_order").logged()
JOBS["run_log_failed"] = lambda spark, t: LoadRun(spark, t, "inventory", spoiled=True).logged()
for _k in FACT_TABLES:
    JOBS[f"reclassify_{_k}"] = lambda spark, t, k=_k: reclassify_fact(t, _unmoved(spark, t, k))
    JOBS[f"reclassify_counts_{_k}"] = _reclassify_counts(_k)


# Headline jobs (slices, loads, reclassification): what bench.py times.  Of the queries that
# repeat a load to look at its log or counts, none is timed.
HEADLINE: tuple[str, ...] = tuple(
    k for k in JOBS if not k.startswith(("run_log", "load_counts_", "load_changes_", "reclassify_counts_")) and "as_written" not in k
    and "all_departments" not in k
)

def _latest_incremental(spark, t):
    """The sales-order detail absorbed in three imports by date (those without one come last)."""
    detail, root = t["stg_so_detail"], scratch_path(spark, "load-queries", uuid.uuid4().hex, "latest")
    day = F.to_date("ETLImportDate")
    first, second = F.lit("1994-01-01").cast("date"), F.lit("1996-07-01").cast("date")
    for part in (day < first, (day >= first) & (day < second), day.isNull() | (day >= second)):
        absorb(spark, root, detail.filter(part), DETAIL_KEYS, [F.col("ETLImportDate").desc_nulls_last()], buckets=8)
    return read_state(spark, root).select(*DETAIL_KEYS, "ETLImportDate", "PNM_AUTO_KEY", "QTY_ORDERED")


JOBS["latest_incremental"] = _latest_incremental
for _k, _u in UNITS.items():
    JOBS[_k] = lambda spark, t, u=_u: u(t)


def _as_query(j: Job) -> Query:
    return lambda spark, sf_dir: j(spark, fixture_tables(spark, sf_dir))


class _Queries(dict):
    """Live view of JOBS as (spark, sf_dir) queries (later registrations included)."""

    def refresh(self) -> "_Queries":
        self.clear()
        self.update({k: _as_query(j) for k, j in JOBS.items()})
        return self


QUERIES = _Queries()


def queries() -> dict[str, Query]:
    return dict(QUERIES.refresh())
