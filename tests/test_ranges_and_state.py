"""Range joins, the latest-per-key state and text comparison by a collation."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from slicewright.config import RunContext
from slicewright.operators import incremental
from slicewright.operators.dedupe import first_per_key, one_per_key
from slicewright.operators.incremental import absorb, read_state
from slicewright.operators.lookups import lookup
from slicewright.operators.ranges import range_join, range_lookup
from slicewright.plans.inventory import inventory_slice
from slicewright.plans.units import UNITS, respelled
from slicewright.sources import snapshot
from slicewright.sources.collation import CASELESS, collated, is_collated, plain

# --- ranges ------------------------------------------------------------------------------

EXTREMES = (-(2**63), 2**63 - 1)


def interval_rows():
    rnd = random.Random(5)
    rows = [(i, a := rnd.randint(-300, 300), a + rnd.choice((0, 1, 5, 40, 400))) for i in range(60)]
    rows += [(100, *EXTREMES), (101, None, 5), (102, 5, None), (103, 9, 8), (104, 7, 7), (104, 7, 7), (105, 0, 2**62), (106, -1, 0)]
    return rows


@pytest.fixture(scope="module")
def ranges(spark):
    values = [*range(-350, 360, 3), 7, 7, None, None, *EXTREMES, 2**62, 2**62 + 1]
    points = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, at bigint")
    return points, spark.createDataFrame(interval_rows(), "band int, low bigint, high bigint")


def brute(points):
    found = []
    for p in points.collect():
        found += [
            (p["id"], b) for b, low, high in interval_rows()
            if None not in (low, high, p["at"]) and low <= p["at"] <= high
        ]
    return sorted(found)


def test_range_join_gives_every_pair_once(ranges):
    points, bands = ranges
    got = range_join(points, "at", bands, "low", "high")
    assert got.columns == ["id", "at", "band", "low", "high"]
    assert sorted((r["id"], r["band"]) for r in got.collect()) == brute(points)


def test_range_join_is_an_equi_join(ranges):
    points, bands = ranges
    plan = range_join(points, "at", bands, "low", "high")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_join_over_clashing_names_and_empty_sides(spark, ranges):
    points, _ = ranges
    both = spark.createDataFrame([(1, 0, 10)], "id int, low int, at int")
    got = range_join(points.select("id", "at"), "at", both, "low", "at")
    assert got.count() == points.filter("at between 0 and 10").count()
    none = both.limit(0)
    assert range_join(points, "at", none, "low", "at").count() == 0
    assert range_join(points.limit(0), "at", both, "low", "at").count() == 0


def test_range_lookup_keeps_every_row(ranges):
    points, bands = ranges
    want = {}
    for i, b in brute(points):
        want.setdefault(i, []).append(b)
    got = range_lookup(points, "at", bands, "low", "high", {"least": F.min("band"), "n": F.count(F.lit(1))}).collect()
    assert len(got) == points.count()
    assert {r["id"]: (r["least"], r["n"]) for r in got} == {
        r["id"]: (min(want[r["id"]]), len(want[r["id"]])) if r["id"] in want else (None, None) for r in got
    }


# --- latest per key ------------------------------------------------------------------------

SCHEMA = "k int, line int, day int, v string"


def by_day():
    return [F.col("day").desc_nulls_last()]


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="state-")


def imports(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice((None, 1, 2, 3, 4, 5, 6)), rnd.randint(0, 3), rnd.choice((None, 1, 2, 3)), rnd.choice("abc")) for _ in range(300)]
    return [spark.createDataFrame(rows[i: i + 100], SCHEMA) for i in (0, 100, 200)]


def same(a, b):
    key = lambda r: repr(tuple(r))
    return sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


def test_imports_give_the_rows_of_one_run(spark, root):
    parts = imports(spark)
    for part in parts:
        absorb(spark, root, part, ["k", "line"], by_day(), buckets=4)
    whole = parts[0].unionAll(parts[1]).unionAll(parts[2])
    want = first_per_key(whole, ["k", "line"], by_day(), rn_name=None)
    assert same(read_state(spark, root), want)


def test_an_import_that_comes_again_writes_nothing(spark, root):
    part = imports(spark)[0]
    absorb(spark, root, part, ["k", "line"], by_day(), buckets=4)
    before = snapshot.current(spark, root)
    done = absorb(spark, root, part, ["k", "line"], by_day(), buckets=4)
    assert done["Written"] == 0 and snapshot.current(spark, root).name == before.name


def test_only_folders_with_a_winner_are_written(spark, root):
    state = spark.createDataFrame([(i, 0, 5, "a") for i in range(200)], SCHEMA)
    absorb(spark, root, state, ["k", "line"], by_day(), buckets=8)
    before = snapshot.current(spark, root).folders
    late = spark.createDataFrame([(3, 0, 9, "new"), (4, 0, 1, "stale")], SCHEMA)
    done = absorb(spark, root, late, ["k", "line"], by_day(), buckets=99)  # the state's number of buckets holds
    after = snapshot.current(spark, root).folders
    assert done == {"Rows": 2, "Written": 1, "Kept": 7}
    assert sum(before[n] != after[n] for n in before) == 1 and before.keys() == after.keys()
    assert {r["k"]: r["v"] for r in read_state(spark, root).filter("k in (3, 4)").collect()} == {3: "new", 4: "a"}


def test_an_import_reads_only_its_folders(spark, root, monkeypatch):
    absorb(spark, root, spark.createDataFrame([(i, 0, 5, "a") for i in range(200)], SCHEMA), ["k", "line"], by_day(), buckets=8)
    asked = []
    read = snapshot.read_current
    monkeypatch.setattr(incremental.snapshot, "read_current", lambda *a, **k: asked.append(k["names"]) or read(*a, **k))
    absorb(spark, root, spark.createDataFrame([(3, 0, 9, "new")], SCHEMA), ["k", "line"], by_day())
    assert [len(n) for n in asked] == [1]


def test_an_import_is_written_and_met_as_seldom_as_needed(spark, root, monkeypatch):
    calls, deduped = [], incremental.first_per_key
    monkeypatch.setattr(incremental, "first_per_key", lambda *a, **k: calls.append("dedupe") or deduped(*a, **k))
    writer, written = type(spark.range(1).write), type(spark.range(1).write).parquet
    monkeypatch.setattr(writer, "parquet", lambda self, *a, **k: calls.append("write") or written(self, *a, **k))

    def absorbed(*rows):
        calls.clear()
        return absorb(spark, root, spark.createDataFrame(list(rows), SCHEMA), ["k", "line"], by_day(), buckets=4), sorted(calls)

    absorb(spark, root, spark.createDataFrame([], SCHEMA), ["k", "line"], by_day(), buckets=4)
    # into folders that hold nothing: not merged; else merged and written once beside the import (it was twice)
    first, how = absorbed(*[(i, 0, 5, "a") for i in range(100)])
    assert first == {"Rows": 100, "Written": 4, "Kept": 0} and how == ["dedupe", "write", "write"]
    second, how = absorbed(*[(i, 0, 6, "b") for i in range(50, 150)], *[(i, 0, 4, "c") for i in range(50)])
    assert second["Rows"] == 150 and second["Written"] == 4 and how == ["dedupe", "dedupe", "write", "write"]
    got = {r["k"]: r["v"] for r in read_state(spark, root).collect()}
    assert got == {i: "a" if i < 50 else "b" for i in range(150)}
    # nothing of a write that won nothing stays
    version = snapshot.current(spark, root)
    stale, _ = absorbed((1, 0, 1, "stale"))
    assert stale["Written"] == 0 and snapshot.current(spark, root).name == version.name
    used = {f.split("/")[1] for n in snapshot._names(spark, f"{root}/manifests") if n.endswith(".json")
            for f in snapshot._version(spark, root, n).folders.values()}
    assert used >= set(snapshot._names(spark, f"{root}/data")) - {"_SUCCESS"} - _empty(spark, root)


def _empty(spark, root):
    """Writes without a folder of rows."""
    data = snapshot._names(spark, f"{root}/data")
    return {w for w in data if not any("=" in n for n in snapshot._names(spark, f"{root}/data/{w}"))}


def test_empty_imports(spark, root):
    empty = spark.createDataFrame([], SCHEMA)
    assert read_state(spark, root) is None
    assert absorb(spark, root, empty, ["k", "line"], by_day())["Rows"] == 0
    assert read_state(spark, root).count() == 0
    assert absorb(spark, root, empty, ["k", "line"], by_day())["Written"] == 0
    absorb(spark, root, spark.createDataFrame([(1, 1, 1, "a")], SCHEMA), ["k", "line"], by_day())
    assert read_state(spark, root).count() == 1


# --- collation -----------------------------------------------------------------------------

def test_no_collation_changes_nothing(tables):
    assert collated(tables, None) is tables


def test_results_are_plain_and_texts_keep_their_spelling(tables):
    t = collated(respelled(tables))
    assert is_collated(t["d_manufacturer"].schema["ManufacturerName"].dataType)
    got = UNITS["warehouse_region_label_caseless"](tables)
    assert not any(is_collated(f.dataType) for f in got.schema)
    codes = {r[0] for r in got.select("warehouse_code").distinct().collect()}
    assert "US-EAST  " in codes and "coe1" in codes


def test_respelled_names_only_match_under_the_collation(tables):
    strict = UNITS["manufacturer_by_name"](respelled(tables)).filter("ManufacturerId <> -1").count()
    loose = UNITS["manufacturer_by_name_caseless"](tables).filter("ManufacturerId <> -1").count()
    as_given = UNITS["manufacturer_by_name"](tables).filter("ManufacturerId <> -1").count()
    assert loose == as_given > strict


def test_a_slice_over_collated_tables_equals_the_plain_one(tables):
    want, got = inventory_slice(tables), plain(inventory_slice(collated(respelled(tables))))
    assert got.columns == want.columns
    # IC_UDF_005 is only looked up, so respelling it changes no column
    assert same(got, want)


def test_equal_texts_compete_by_their_bytes(spark):
    rows = spark.createDataFrame([(1, "b "), (1, "B"), (1, "b"), (2, None), (2, "a")], "k int, name string")
    rows = rows.withColumn("name", F.collate("name", CASELESS))
    least = {r["k"]: r["name"] for r in one_per_key(rows, "k", ["name"]).collect()}
    first = {r["k"]: r["name"] for r in first_per_key(rows, ["k"], rn_name=None).collect()}
    left = spark.createDataFrame([(1,), (2,)], "x int")
    looked = {r["x"]: r["n"] for r in lookup(left, rows, "x", "k", {"n": "name"}).collect()}
    assert least == {1: "B", 2: "a"} and first == {1: "B", 2: None} and looked == least


def test_run_parameter_reaches_the_refresh():
    assert RunContext(run_ts=dt.datetime(2002, 1, 1)).collation is None and RunContext(collation=CASELESS).collation == CASELESS
