"""Staging tables bucketed by their join key.

Header, detail and fact tables that meet on one key at every run are written once with that key
as bucket column, in as many buckets on both sides.  Joins, windows and aggregates on the key
(or on more columns than it) then need no exchange: each task reads its bucket of either side.

A bucket is one task's, so the layout suits keys that no single value dominates.  A table in
which one value (null included) holds more than ``MOST_OF_ONE`` of the rows is staged without
buckets, and Spark's shuffles, with their splitting of skewed partitions, serve it as before.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright.session import STORED, frees_shuffles
from slicewright.sources.catalog import Tables, path_exists

#: Table → the key that it is joined on.
BUCKET_KEYS = {
    "stg_so_header": "SOH_AUTO_KEY",
    "stg_so_detail": "SOH_AUTO_KEY",
    "stg_invc_detail": "INH_AUTO_KEY",
    "stg_rc_header": "RCH_AUTO_KEY",
    "stg_rc_detail": "RCH_AUTO_KEY",
    "stg_stock": "RCD_AUTO_KEY",
    "f_sales_order": "NativeLineId",
}
BUCKETS = 64
MOST_OF_ONE = 0.05
#: Tables with fewer rows can't have a value that matters.
LEAST_ROWS = 1000
#: Up to so many files, each task writes the buckets of the rows that it has.
MOST_FILES = 4096


def dominated(df: DataFrame, key: str) -> bool:
    """Whether one value of ``key`` holds more than ``MOST_OF_ONE`` of the rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    r = counts.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    return bool(r["rows"] and r["rows"] >= LEAST_ROWS and r["most"] > MOST_OF_ONE * r["rows"])


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_they_lie(spark: SparkSession, buckets: int) -> bool:
    """Whether tables are written in buckets without a shuffle: as many files as tasks and buckets make, at most."""
    return _tasks(spark) * buckets <= MOST_FILES


def bucketed_table(spark: SparkSession, name: str, df: DataFrame, key: str, path: str, buckets: int) -> DataFrame:
    """The table ``name`` over the folder ``path``: written if it isn't there yet, and made
    known to this session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    options = ", ".join(f"'{k}' '{v}'" for k, v in STORED.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS ({options}) "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    if not path_exists(spark, f"{path}/_SUCCESS"):
        if as_they_lie(spark, buckets):
            rows = df.coalesce(_tasks(spark))
        else:
            # by the session's number of shuffle partitions: rows that lie by the key already (as joined
            # on it) aren't shuffled again, and a task writes the few buckets that fall in its partition
            rows = df.repartition(key)
        rows.write.insertInto(name, overwrite=True)
    return spark.table(name)


@frees_shuffles
def stage_bucketed(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, tag: str, buckets: int = BUCKETS,
    keys: Mapping[str, str] = BUCKET_KEYS,
) -> Tables:
    """``tables`` with those of ``keys`` staged below ``root``, by bucket where no value of the key
    dominates.  ``tag`` tells the catalog names of several stagings apart."""
    staged, bucketed = {}, set()
    for name, key in keys.items():
        path, df = f"{root}/{name}", tables[name]
        plain, known = f"{path}-plain", path_exists(spark, f"{path}/_SUCCESS")
        if not path_exists(spark, f"{plain}/_SUCCESS"):
            if not known and not as_they_lie(spark, buckets) and dominated(df, key):
                df.write.mode("overwrite").options(**STORED).parquet(plain)
            else:
                table = bucketed_table(spark, f"bucketed_{tag}_{name}", df, key, path, buckets)
                # as they lie, no task has met a value's rows yet: whether one dominates is seen in the
                # files, and the table needn't be derived for it
                if not as_they_lie(spark, buckets) or not dominated(table, key):
                    bucketed.add(name)
                    staged[name] = table
                    continue
                spark.read.schema(table.schema).parquet(path).write.mode("overwrite").options(**STORED).parquet(plain)
        staged[name] = spark.read.parquet(plain)
    rest = {n: (lambda n=n: tables[n]) for n in tables if n not in staged}
    out = Tables(rest | {n: (lambda d=d: d) for n, d in staged.items()})
    out.bucketed = frozenset(bucketed)
    return out
