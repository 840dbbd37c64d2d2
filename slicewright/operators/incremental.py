"""Latest row per key, kept as a state and brought up to date import by import.

The state is a published table (:mod:`slicewright.sources.snapshot`) of the first row of each
key, in folders by hash of the key.  An import is reduced to one row per key, then meets only
the state's folders that its keys fall in; folders where no row of the import wins keep their
files.  As the order is total, any sequence of imports gives the rows of one run over all of
them, and an import that comes twice changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slicewright.operators.dedupe import first_per_key
from slicewright.session import STORED, frees_shuffles, scratch_path
from slicewright.sources import snapshot

#: Derived from the key at each import; kept in the state's folder names.
KEY_BUCKET = "KeyBucket"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_state(spark: SparkSession, root: str) -> DataFrame | None:
    """The latest rows; None before the first import."""
    rows = snapshot.read_current(spark, root)
    return None if rows is None else rows.drop(KEY_BUCKET)


@frees_shuffles
def absorb(
    spark: SparkSession, root: str, imported: DataFrame, keys: Sequence[str], order: Sequence[Column],
    tiebreak: Sequence[str] | None = None, buckets: int = 64,
) -> dict[str, int]:
    """Merge one import into the state at ``root``.  Null keys are keys like any other.

    ``buckets`` counts on the first import; later ones use the state's.  Returns the rows
    imported (one per key), the folders written and the folders left alone."""
    tiebreak = tiebreak or [c for c in imported.columns if c not in keys]
    version = snapshot.current(spark, root)
    buckets = version.note["buckets"] if version else buckets
    path = scratch_path(spark, "imports", uuid.uuid4().hex)
    latest = first_per_key(imported, list(keys), order, tiebreak, rn_name=None)
    latest.withColumn(KEY_BUCKET, _bucket(keys, buckets)).write.options(**STORED).parquet(path)
    fresh = spark.read.parquet(path)
    # a row a bucket: as many as the parameter says, at most
    hit = {snapshot.partition_folder(r[0], KEY_BUCKET) for r in fresh.select(KEY_BUCKET).distinct().collect()}
    n = fresh.count()
    if version is None:
        snapshot.publish(spark, fresh, root, by=KEY_BUCKET, note={"buckets": buckets})
        return {"Rows": n, "Written": len(hit), "Kept": 0}
    if not hit:
        return {"Rows": n, "Written": 0, "Kept": len(version.folders)}
    if not hit & set(version.folders):  # nothing to meet: the import's rows are the folders'
        snapshot.publish(spark, fresh, root, names=hit, by=KEY_BUCKET, note={"buckets": buckets})
        return {"Rows": n, "Written": len(hit), "Kept": len(version.folders)}
    held = snapshot.read_current(spark, root, names=hit & set(version.folders))
    both = held.withColumn("__new", F.lit(False)).unionByName(fresh.withColumn("__new", F.lit(True)))
    # at most two rows a key; shuffled by bucket and key in ranges, so that they can be written as they
    # lie, in few files a folder.  Of a row that is in both, the state's comes first
    both = both.repartitionByRange(KEY_BUCKET, *keys)
    merged = first_per_key(both, [KEY_BUCKET, *keys], order, [*tiebreak, "__new"], rn_name=None)
    seen = Observation("absorb")
    merged = merged.observe(seen, F.collect_set(F.when(F.col("__new"), F.col(KEY_BUCKET))).alias("won"))
    won: set[str] = set()

    def winners() -> set[str]:
        # a number a bucket, at most; known once the rows are written
        won.update(snapshot.partition_folder(b, KEY_BUCKET) for b in seen.get["won"])
        return won

    snapshot.publish(
        spark, merged.drop("__new"), root, names=winners, by=KEY_BUCKET, note={"buckets": buckets}, as_dealt=True,
    )
    return {"Rows": n, "Written": len(won), "Kept": len(set(version.folders) - won)}
