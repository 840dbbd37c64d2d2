"""Load runner: one load with its run-log rows, as the scheduled job calls it.

``run_load`` evaluates the slice once (written to the shared checkpoint folder, so all
steps read the same rows and lineage is cut), checks that no target row can match two
source rows, applies the guard where the load has one, merges, publishes and appends
RUNNING and PASS/FAIL rows to the run log.  Of the target only the folders (division and
department bucket) in which a row is updated, deleted or inserted are read and written;
which those are follows from the scope, from the source's departments and, unless these
cover the rest, from a join of the key columns alone.  Counts are observed on the rows
being published.

Changes: with ``changes`` the rows that a load updates, inserts or deletes are stored beside
the version, as they were and as they are, and named in its manifest.

Restart: with ``run_id`` each step leaves a record under that id in the shared folder.  A second
call with the id takes up after the last recorded step: the staged source isn't evaluated
again, a finished merge isn't either (unless another version was published since), and a
run that had published returns its counts and changes nothing.

Counts: RowsRead are the staged source rows, RowsWritten the inserted ones, RowsUpdated
the source rows that matched (each source row either matches or is inserted), and
RowsByPassed what is left: all of them where the guard blocks, else none.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.config import BASE_DIVISION, SPLIT_DIVISION, VOLUME_GUARD_RATIO, EntityConfig, RunContext
from slicewright.operators.entity import entity_by_department
from slicewright.operators.merge import (
    ACTION,
    BEFORE,
    DELETE,
    INSERT,
    KEEP,
    UPDATE,
    assert_unique,
    changed_rows,
    matched_rows,
    volume_guard,
)
from slicewright.plans.loads import FLAG, SPECS, STAMP, LoadScope, LoadSpec, MergePlan, merge_load, merge_plan, prepare_source
from slicewright.plans.reclassify import FACT_TABLES, moved, reclassify_fact
from slicewright.session import STORED, frees_shuffles, scratch_path
from slicewright.sources import snapshot
from slicewright.sources.catalog import Tables
from slicewright.sources.collation import collated, plain

RUN_LOG_SCHEMA = (
    "LogId string, SystemName string, SystemNameRank int, ProcessName string, SourceName string, "
    "TargetName string, UniqueRunID string, ParentPipelineID string, PipelineID string, Status string, "
    "RowsRead bigint, RowsWritten bigint, RowsUpdated bigint, RowsDeleted bigint, RowsByPassed bigint, "
    "Message string, ErrorDescription string, LoggedAt timestamp_ntz"
)
COUNTS = ("RowsRead", "RowsWritten", "RowsUpdated", "RowsDeleted", "RowsByPassed")
BLOCKED = "Not enough staged records"
RESUMED = "Published by an earlier attempt"


def log_row(spark: SparkSession, log_path: str, **values) -> None:
    cols = [c.split()[0] for c in RUN_LOG_SCHEMA.split(", ")]
    row = tuple(values.get(c) for c in cols)
    spark.createDataFrame([row], RUN_LOG_SCHEMA).write.mode("append").parquet(log_path)


class Logged:
    """The run-log rows around one job: RUNNING, then PASS with counts or FAIL with the error."""

    def __init__(self, spark: SparkSession, log_path: str, ctx: RunContext, process: str, source: str, target: str):
        self.spark, self.log_path, self.id = spark, log_path, str(uuid.uuid4())
        self.base = dict(
            LogId=self.id, SystemName=ctx.system_name, SystemNameRank=ctx.system_rank, ProcessName=process,
            SourceName=source, TargetName=target, UniqueRunID=ctx.unique_run_id,
            ParentPipelineID=ctx.parent_pipeline_id, PipelineID=ctx.pipeline_id,
        )

    def row(self, **values) -> None:
        log_row(self.spark, self.log_path, **self.base, **values, LoggedAt=dt.datetime.now())

    def __enter__(self) -> Logged:
        self.row(Status="RUNNING")
        return self

    def passed(self, counts: dict, message: str = "Success") -> dict:
        self.row(Status="PASS", Message=message, **{c: counts[c] for c in COUNTS})
        return {**counts, "Status": "PASS", "Message": message}

    def __exit__(self, kind, error, trace) -> bool:
        if error is not None:
            self.row(Status="FAIL", ErrorDescription=str(error), **dict.fromkeys(COUNTS, 0))
        return False


def target_schema(spec: LoadSpec, source: DataFrame) -> T.StructType:
    fields = [T.StructField(c, source.schema[c].dataType) for c in spec.insert_cols]
    return T.StructType([*fields, T.StructField(STAMP, T.TimestampNTZType()), T.StructField(FLAG, T.IntegerType())])


class Steps:
    """Tables that the steps of one run wrote, by step name.

    A table counts once its record is there, which is written after it; what an unfinished
    attempt left lies in a folder that no record names."""

    def __init__(self, spark: SparkSession, kind: str, run_id: str):
        self.spark, self.root = spark, scratch_path(spark, "runs", run_id, kind)

    def table(self, step: str, base: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The step's table, made unless it was recorded on the same ``base``."""
        found = snapshot.read_json(self.spark, f"{self.root}/{step}.json")
        if found is None or found["base"] != base:
            folder = f"{step}-{uuid.uuid4().hex}"
            make().write.mode("errorifexists").options(**STORED).parquet(f"{self.root}/{folder}")
            found = {"base": base, "folder": folder}
            snapshot.write_json(self.spark, f"{self.root}/{step}.json", found)
        return self.spark.read.parquet(f"{self.root}/{found['folder']}")


def touched_folders(spark: SparkSession, root: str, plan: MergePlan, source: DataFrame) -> set[str]:
    """Names of the target's folders (those to come included) whose rows the load changes."""
    version = snapshot.current(spark, root)
    at = [snapshot.PARTITION, snapshot.BUCKET]
    places = lambda rows: rows.select(snapshot.PARTITION, snapshot.bucket_column().alias(snapshot.BUCKET)).distinct().collect()
    # one row for each division and bucket at most
    inserts = {snapshot.folder_name(*(r[c] for c in at)) for r in places(source)}
    touched = {n for n in version.folders if snapshot.plain(n) in inserts} if version else set()
    for division, departments in plan.deletes:
        touched |= snapshot.folders_in(version, division, departments)
    open_ = set().union(*(snapshot.folders_in(version, *m) for m in plan.matches)) - touched
    if open_:
        rows = snapshot.read_current(spark, root, names=open_)
        found = {snapshot.folder_name(*(r[c] for c in at)) for r in places(
            matched_rows(rows, source, plan.keys, plan.target_where, plan.source_where, plan.delete)
        )}
        touched |= {n for n in open_ if snapshot.plain(n) in found or "/" not in n}
    return touched | inserts


@frees_shuffles
def run_load(
    spark: SparkSession,
    kind: str,
    slice_df: DataFrame,
    target_root: str,
    log_path: str,
    ctx: RunContext = RunContext(),
    scope: LoadScope = LoadScope(),
    audit_path: str | None = None,
    run_id: str | None = None,
    changes: bool = False,
) -> dict:
    """Run one load.  With ``audit_path`` the rows of all divisions in its reach are also written
    there with their actions, deleted rows included.  ``changes`` stores the change feed with the
    version; ``run_id`` makes the load restartable.  A run id is for one load of one day's data: it
    must not be used again for another."""
    spec = SPECS[kind]
    plan = merge_plan(spec, scope)
    with Logged(spark, log_path, ctx, f"load_{kind}", spec.slice_job, spec.target_name) as log:
        if run_id is not None:
            finished = snapshot.published_by(spark, target_root, run_id)
            if finished is not None:
                return log.passed(finished.note["counts"], RESUMED) | {"Blocked": False, "Resumed": True}
        steps = Steps(spark, kind, run_id or log.id)
        source = steps.table("source", "", lambda: plain(prepare_source(spec, slice_df)))
        rows_read = source.count()
        assert_unique(source, plan.keys, plan.source_where)
        loaded = snapshot.read_current(spark, target_root, only=plan.touched)
        if loaded is None:
            loaded = spark.createDataFrame([], target_schema(spec, source))
        if kind == "receipts":
            guard = volume_guard(source, loaded, F.col("DivisionId") == SPLIT_DIVISION, VOLUME_GUARD_RATIO).first()
            if not guard["Pass"]:
                counts = dict.fromkeys(COUNTS, 0) | {"RowsRead": rows_read, "RowsByPassed": rows_read}
                return log.passed(counts, BLOCKED) | {
                    "Blocked": True, "SourceRows": guard["SourceRows"], "TargetRows": guard["TargetRows"]
                }
        names = touched_folders(spark, target_root, plan, source)
        version = snapshot.current(spark, target_root)
        held = names & set(version.folders) if version else set()
        target = snapshot.read_current(spark, target_root, names=held) if version else loaded
        merge = lambda: merge_load(spec, target, source, ctx, scope, before=changes)
        if run_id is not None or changes:
            merged = steps.table("merged", f"{version.name if version else ''} changes={changes}", merge)
        else:
            merged = merge()
        feed = None
        if changes:
            feed = f"changes/{uuid.uuid4().hex}"
            changed_rows(merged).write.mode("errorifexists").options(**STORED).parquet(f"{target_root}/{feed}")
            merged = merged.drop(BEFORE)
        if audit_path is not None:
            merged.write.mode("errorifexists").options(**STORED).parquet(f"{audit_path}/changed=1")
            rest = set().union(*(snapshot.folders_in(version, d) for d in plan.touched)) - held
            if rest:
                others = snapshot.read_current(spark, target_root, names=rest).withColumn(ACTION, F.lit(KEEP))
                others.write.mode("errorifexists").options(**STORED).parquet(f"{audit_path}/changed=0")
            merged = spark.read.parquet(f"{audit_path}/changed=1")
        seen = Observation(f"merge_{kind}")
        count = lambda action: F.sum(F.when(F.col(ACTION) == action, 1).otherwise(0))
        merged = merged.observe(seen, count(INSERT).alias("i"), count(UPDATE).alias("u"), count(DELETE).alias("d"))

        def counted() -> tuple[dict, dict]:
            n = {k: int(v or 0) for k, v in seen.get.items()}
            return n, {
                "RowsRead": rows_read, "RowsWritten": n["i"], "RowsUpdated": rows_read - n["i"], "RowsDeleted": n["d"],
                "RowsByPassed": 0,
            }

        snapshot.publish(
            spark, merged.filter(F.col(ACTION) != DELETE).drop(ACTION), target_root, names=names, changes=feed,
            from_files=run_id is not None or changes or audit_path is not None,
            note=(lambda: {"run": run_id, "counts": counted()[1]}) if run_id is not None else None,
        )
        n, counts = counted()
        return log.passed(counts) | {"Blocked": False, "TargetRowsUpdated": n["u"]}


@frees_shuffles
def run_reclassify(
    spark: SparkSession,
    fact: str,
    tables: Mapping[str, DataFrame],
    target_root: str,
    log_path: str,
    ctx: RunContext = RunContext(),
    cfg: EntityConfig = EntityConfig(),
) -> dict:
    """Move the split unit's rows of a published fact out of the base division.  Of the base
    division only the department buckets that hold such rows are read in full and written; the
    moved rows are added beside those of the split division.  If none moves, nothing is written."""
    reach = (BASE_DIVISION, SPLIT_DIVISION)
    with Logged(spark, log_path, ctx, f"reclassify_{fact}", FACT_TABLES[fact], FACT_TABLES[fact]) as log:
        version = snapshot.current(spark, target_root)
        if version is None:
            return log.passed(dict.fromkeys(COUNTS, 0))
        n = snapshot.read_current(spark, target_root, only=reach).count()
        counts = dict.fromkeys(COUNTS, 0) | {"RowsRead": n, "RowsByPassed": n}
        entity = entity_by_department(tables, cfg).filter(F.col("DEPT_Definition") == cfg.label_of(SPLIT_DIVISION))
        departments = [r[0] for r in entity.select("DPT_AUTO_KEY").distinct().collect()]  # of one entity
        names = snapshot.folders_in(version, BASE_DIVISION, departments)
        if not names:
            return log.passed(counts)
        narrow = snapshot.read_current(spark, target_root, names=names).select("DPT_AUTO_KEY", "DivisionId", "IsSplit")
        bucket = snapshot.bucket_column().alias(snapshot.BUCKET)
        hit = reclassify_fact(tables, narrow, cfg, mark=True).filter(moved).groupBy(bucket).count().collect()  # a row a bucket
        m, buckets = sum(r["count"] for r in hit), {snapshot.folder_name(BASE_DIVISION, r[snapshot.BUCKET]) for r in hit}
        if not m:
            return log.passed(counts)
        names = {x for x in names if snapshot.plain(x) in buckets or "/" not in x}
        rows = reclassify_fact(tables, snapshot.read_current(spark, target_root, names=names), cfg)
        snapshot.publish(spark, rows, target_root, names=names, beside=True)
        return log.passed(counts | {"RowsUpdated": m, "RowsByPassed": n - m})


def run_all(
    spark: SparkSession, tables: Tables, warehouse_root: str, ctx: RunContext = RunContext()
) -> dict[str, dict]:
    """The split refresh: move the unit's loaded rows to its division, then every load in the
    order the source system runs them.  Texts compare by the run's collation, if it has one."""
    from slicewright.registry import JOBS

    tables = collated(tables, ctx.collation)
    log = f"{warehouse_root}/run_log"
    out = {
        f"reclassify_{fact}": run_reclassify(spark, fact, tables, f"{warehouse_root}/{table}", log, ctx)
        for fact, table in FACT_TABLES.items()
    }
    for kind in ("inventory", "invoice", "purchase_order", "sales_order", "shipment", "receipts"):
        spec = SPECS[kind]
        out[kind] = run_load(spark, kind, JOBS[spec.slice_job](spark, tables), f"{warehouse_root}/{spec.target_name}", log, ctx)
    return out
