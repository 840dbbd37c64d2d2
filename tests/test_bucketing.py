"""Bucketed staging: no exchange below the joins on the bucket key; null keys of large lookups are spread."""

import tempfile
import uuid
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from slicewright.operators.broadcast import estimated_bytes
from slicewright.operators.lookups import Lookups, lookup
from slicewright.plans.receipts import receipt_slice
from slicewright.plans.sales_order import sales_order_slice
from slicewright.sources import bucketing
from slicewright.sources.bucketing import stage_bucketed
from slicewright.sources.staging import stage_fixtures
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def staged(spark):
    return stage_fixtures(spark, SF_SMALL)


@pytest.fixture(scope="module")
def bucketed(spark, staged):
    return stage_bucketed(spark, staged, tempfile.mkdtemp(prefix="bucketed-"), f"t{uuid.uuid4().hex[:8]}", 4)


@pytest.fixture
def threshold(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    yield lambda n: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(n))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("slice_of", "header", "keys"), [
    (sales_order_slice, "stg_so_header", ("SOH_AUTO_KEY", "SOD_AUTO_KEY", "__h_soh")),
    (receipt_slice, "stg_rc_header", ("RCH_AUTO_KEY",)),
])
def test_headers_and_details_meet_without_an_exchange(spark, staged, bucketed, threshold, slice_of, header, keys):
    expected = rows_of(slice_of(staged))
    threshold(min(estimated_bytes(bucketed[header]), estimated_bytes(staged[header])) - 1)
    exchanged = lambda df: [k for k in keys if f"hashpartitioning({k}#" in plan_of(df)]
    assert exchanged(slice_of(staged))  # without buckets both sides are shuffled
    plan = plan_of(slice_of(bucketed))
    assert not exchanged(slice_of(bucketed)) and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert rows_of(slice_of(bucketed)) == expected


def test_a_dominated_key_is_staged_without_buckets(spark, staged):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("SOH_AUTO_KEY"), "id")
    root, tag = tempfile.mkdtemp(prefix="dominated-"), f"t{uuid.uuid4().hex[:8]}"
    for _ in range(2):  # the second time it is only read
        tables = stage_bucketed(spark, {"stg_so_detail": rows, "x": rows}, root, tag, 4, {"stg_so_detail": "SOH_AUTO_KEY"})
        assert rows_of(tables["stg_so_detail"]) == rows_of(rows) and set(tables) == {"stg_so_detail", "x"}
        assert "Bucketed: true" not in plan_of(tables["stg_so_detail"].groupBy("SOH_AUTO_KEY").count())


def test_rows_that_lie_by_the_key_are_not_shuffled_again(spark, threshold):
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        threshold(-1)
        for k, v in changed.items():
            spark.conf.set(k, v)
        heads = spark.range(300).select(F.col("id").alias("h"))
        lines = spark.range(3000).select((F.col("id") % 300).alias("SOH_AUTO_KEY"), "id")
        joined = lines.join(heads, F.col("SOH_AUTO_KEY") == F.col("h")).drop("h")
        root, tag = tempfile.mkdtemp(prefix="lying-"), f"t{uuid.uuid4().hex[:8]}"
        table = stage_bucketed(spark, {"stg_so_detail": joined}, root, tag, 4, {"stg_so_detail": "SOH_AUTO_KEY"})["stg_so_detail"]
        # each of the join's eight tasks wrote its own rows; a further shuffle wrote one file a bucket
        assert len(table.inputFiles()) == 8
        assert rows_of(table) == rows_of(joined)
        found = table.groupBy("SOH_AUTO_KEY").count()
        assert "Exchange" not in plan_of(found) and rows_of(found) == Counter({(i, 10): 1 for i in range(300)})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize(("most", "files"), [(None, 12), (8, 4)])
def test_rows_are_put_into_buckets_where_they_lie_while_files_are_few(spark, monkeypatch, most, files):
    if most is not None:
        monkeypatch.setattr(bucketing, "MOST_FILES", most)
    rows = spark.range(0, 3000, 1, 3).select((F.col("id") % 300).alias("SOH_AUTO_KEY"), "id")
    root, tag = tempfile.mkdtemp(prefix="lie-"), f"t{uuid.uuid4().hex[:8]}"
    table = stage_bucketed(spark, {"stg_so_detail": rows}, root, tag, 4, {"stg_so_detail": "SOH_AUTO_KEY"})["stg_so_detail"]
    # three tasks wrote four buckets each; a shuffle by the key wrote one file a bucket
    assert len(table.inputFiles()) == files
    found = table.groupBy("SOH_AUTO_KEY").count()
    assert "Exchange" not in plan_of(found) and rows_of(found) == Counter({(i, 10): 1 for i in range(300)})


def test_another_session_reads_what_was_staged(spark, staged):
    root, tag = tempfile.mkdtemp(prefix="again-"), f"t{uuid.uuid4().hex[:8]}"
    keys = {"stg_so_header": "SOH_AUTO_KEY"}
    first = stage_bucketed(spark, staged, root, tag, 4, keys)
    files = set(first["stg_so_header"].inputFiles())
    again = stage_bucketed(spark, staged, root, f"{tag}b", 4, keys)
    assert set(again["stg_so_header"].inputFiles()) == files and len(files) <= 4
    assert rows_of(again["stg_so_header"]) == rows_of(staged["stg_so_header"])


@pytest.mark.parametrize("chained", [True, False])
def test_null_keys_of_a_large_lookup_are_spread(spark, threshold, chained):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        threshold(-1)
        left = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 5000).alias("key"), "id").repartition(6)
        dim = spark.range(4000).select(F.col("id").alias("NativeId"), (F.col("id") * 2).alias("PartId"))
        if chained:
            lk = Lookups(left)
            lk.add(dim, "key", "NativeId", {"PartId": "PartId"}, default_unknown=("PartId",))
            lk.join(dim.select(F.col("NativeId").alias("k2"), F.col("PartId").alias("Other")), F.col("key") == F.col("k2"), key="key")
            found = lk.done()
        else:
            found = lookup(left, dim, "key", "NativeId", {"PartId": "PartId"}, ("PartId",))
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("count"), F.sum("PartId")).collect()]
        assert max(sizes) <= 2 * median(sizes) and len(sizes) == 8
        assert rows_of(found.select("id", "key", "PartId")) == Counter(
            (i, None if i % 3 == 0 else i % 5000, -1 if i % 3 == 0 or i % 5000 >= 4000 else i % 5000 * 2) for i in range(30_000)
        )
        assert set(found.columns) <= {"id", "key", "PartId", "k2", "Other"}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
