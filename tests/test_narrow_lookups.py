"""Lookups into sides too large to be broadcast: the wide rows are shuffled once for all of them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from slicewright.operators.lookups import Lookups, lookup
from slicewright.plans.common import class_months_by_part, latest_po_cost, latest_po_costs
from slicewright.plans.inventory import inventory_slice
from slicewright.plans.invoice import invoice_all
from slicewright.plans.purchase_order import purchase_order_slice
from slicewright.plans.receipts import receipt_slice
from slicewright.plans.sales_order import sales_order_all, sales_order_slice
from slicewright.sources.catalog import ORDERS_FIRST, fixture_tables, read_base
from slicewright.sources.fixture_sql import LI_SQL
from tests.conftest import SF_SMALL

PLANS = {
    "sales_order_slice": sales_order_slice, "sales_order_all": sales_order_all, "invoice_all": invoice_all,
    "purchase_order": purchase_order_slice, "inventory": inventory_slice,
}
#: A detail column that no lookup needs.
CARRIED = {
    "sales_order_slice": "LAST_MODIFIED_LINE", "sales_order_all": "LAST_MODIFIED_LINE", "invoice_all": "POST_DESC",
    "purchase_order": "Remarks", "inventory": "CHANGE_TIMESTAMP",
}


@pytest.fixture()
def nothing_fits(spark):
    """A session in which no side may be broadcast; plans as they are before they adapt."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def exchanges(df):
    """The output columns of each shuffle in the plan, reused ones once."""
    found = []

    def walk(node):
        if node.nodeName() == "Exchange":
            found.append({a.split("#")[0] for a in node.output().mkString("|").split("|")})
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def carrying(df, column):
    return sum(column in columns for columns in exchanges(df))


@pytest.mark.parametrize("name", PLANS)
def test_wide_rows_are_shuffled_once_for_all_lookups(nothing_fits, spark, name):
    from slicewright.sources.staging import stage_fixtures

    staged = stage_fixtures(spark, SF_SMALL)
    # for the division, for the dedupe (of the rows and of their copy) and by the row; it was one a lookup
    df = PLANS[name](staged)
    assert carrying(df, CARRIED[name]) <= 5
    assert len(exchanges(df)) >= 12  # no lookup is missing


@pytest.mark.parametrize("name", ["sales_order_all", "invoice_all", "purchase_order"])
def test_rows_are_those_of_plain_joins(nothing_fits, spark, name, monkeypatch):
    narrow = PLANS[name](fixture_tables(spark, SF_SMALL))
    columns = narrow.columns
    got = Counter(tuple(r) for r in narrow.collect())
    monkeypatch.setattr(Lookups, "_joined", lambda self: _in_order(self))
    want = Counter(tuple(r) for r in PLANS[name](fixture_tables(spark, SF_SMALL)).select(*columns).collect())
    assert got == want and got


def _in_order(lookups):
    df = lookups.df
    for join in lookups._joins:
        df = join.to(df)
    return df


def test_null_keys_meet_their_own_row_and_chained_keys_work(nothing_fits, spark):
    rows = spark.createDataFrame(
        [(1, 1, 10, 7, "a"), (1, None, 11, 8, "b"), (None, 1, 12, None, "c"), (None, None, None, 9, "d")],
        "h int, l int, k int, m int, wide string",
    )
    first = spark.createDataFrame([(10, 100), (11, 101), (12, 102), (12, 99)], "k int, via int")
    second = spark.createDataFrame([(100, "x"), (99, "y")], "via int, label string")
    third = spark.createDataFrame([(8, 80), (9, 90)], "m int, other int")

    def looked_up(row_key):
        lk = Lookups(rows, row_key)
        lk.add(first, "k", "k", {"via": "via"})
        lk.add(third, "m", "m", {"other": "other"}, default_unknown=("other",))
        lk.add(second, "via", "via", {"label": "label"})
        return lk.done()

    assert carrying(looked_up(()), "wide") == 3 and carrying(looked_up(("h", "l")), "wide") == 1
    want = {(1, 1, 10, 7, "a", 100, -1, "x"), (1, None, 11, 8, "b", 101, 80, None), (None, 1, 12, None, "c", 99, -1, "y"),
            (None, None, None, 9, "d", None, 90, None)}
    for key in ((), ("h", "l")):
        got = looked_up(key).select("h", "l", "k", "m", "wide", "via", "other", "label").collect()
        assert len(got) == 4 and {tuple(r) for r in got} == want


def test_sides_on_one_key_share_a_shuffle_and_grouped_sides_are_not_shuffled_again(nothing_fits, spark):
    rows = spark.createDataFrame([(1, 10, 7, "a"), (2, None, 8, "b"), (3, 11, None, "c"), (4, 12, 9, "d")], "l int, k bigint, m int, wide string")
    first = spark.createDataFrame([(10, 100), (11, 101)], "k bigint, via int")
    other = spark.createDataFrame([(7, 70)], "m int, other int")
    cost = spark.createDataFrame([(10, 5), (10, 6), (12, 7)], "ck bigint, cost int").groupBy("ck").agg(F.max("cost").alias("cost"))
    lk = Lookups(rows, ("l",))
    lk.add(first, "k", "k", {"via": "via"})
    lk.add(other, "m", "m", {"other": "other"})
    lk.join(cost, None, key="k", side_key=cost["ck"])
    found = lk.done().select("l", "k", "m", "wide", "via", "other", "cost")
    want = {(1, 10, 7, "a", 100, 70, 6), (2, None, 8, "b", None, None, None), (3, 11, None, "c", 101, None, None), (4, 12, 9, "d", None, None, 7)}
    assert {tuple(r) for r in found.collect()} == want
    # three sides (once each), the rows, and their copy by k, by m and by l; it was eleven
    assert len(exchanges(found)) == 7


@pytest.mark.parametrize("kind", ["int", "bigint", "string", "string collate UTF8_LCASE", "decimal(9,2)", "date"])
def test_null_keys_of_any_type_match_nothing(nothing_fits, spark, kind):
    as_key = (lambda c: F.date_add(F.lit("2000-01-01").cast("date"), c)) if kind == "date" else lambda c: c.cast(kind)
    rows = spark.range(200).select("id", as_key(F.when(F.col("id") % 2 == 0, (F.col("id") % 10).cast("int"))).alias("k"))
    side = spark.range(7).select(as_key(F.when(F.col("id") < 6, F.col("id").cast("int"))).alias("n"), F.concat(F.lit("v"), "id").alias("v"))
    want = {i: f"v{i % 10}" if i % 2 == 0 and i % 10 < 6 else None for i in range(200)}
    assert {r["id"]: r["v"] for r in lookup(rows, side, "k", "n", {"v": "v"}).collect()} == want
    lk = Lookups(rows, ("id",))
    lk.add(side, "k", "n", {"v": "v"}).add(side, F.coalesce("k", "k"), "n", {"w": "v"})
    found = lk.done().collect()
    assert {r["id"]: r["v"] for r in found} == {r["id"]: r["w"] for r in found} == want and len(found) == 200


def test_line_items_are_shuffled_once_on_the_way_to_their_customers(nothing_fits, spark):
    read_base(spark, SF_SMALL)
    old, new = spark.sql(LI_SQL), spark.sql(ORDERS_FIRST)
    assert new.columns == old.columns
    assert Counter(map(tuple, new.collect())) == Counter(map(tuple, old.collect()))
    assert carrying(old, "l_shipdate") > 1
    assert carrying(new, "l_shipdate") == 1
    # and the lines of an order stay together: the dedupe needs no further shuffle
    assert carrying(new.groupBy("l_orderkey", "l_linenumber").agg(F.count("*")), "l_linenumber") == 1


def test_latest_cost_is_the_greatest_over_all_ids_of_a_part(spark):
    parts = spark.createDataFrame([(1, 50, "a"), (2, 50, "b"), (3, 51, "c"), (4, None, "d")], "PartId int, NativeId int, PartNumber string")
    orders = spark.createDataFrame(
        [(1, 3, 9), (1, 5, None), (1, 5, 2), (2, 5, 4), (2, 4, 8), (3, 1, None), (4, 9, 9), (None, 9, 9), (7, 9, 9)], "PartId int, PODate int, UnitCost int"
    )
    found = latest_po_cost({"d_part": parts}, orders)
    assert {(r["PartAutoKey"], r["PoUnitCost"]) for r in found.collect()} == {(50, 4), (51, None)}


def test_rows_that_lie_by_a_part_of_their_key_stay_where_they_are(nothing_fits, spark):
    rows = spark.createDataFrame(
        [(1, 1, 10, 7, "a"), (1, None, 11, 8, None), (2, 1, 12, None, "c"), (2, 2, None, 9, "d"), (None, None, 10, 9, "e")],
        "h int, l int, k int, m int, wide string",
    )
    first = spark.createDataFrame([(10, 100), (11, None), (12, 102)], "k int, via int")
    second = spark.createDataFrame([(100, "x")], "via int, label string")
    third = spark.createDataFrame([(8, 80), (9, 90)], "m int, other int")

    def looked_up(*dealt_by):
        lk = Lookups(rows.repartition("h"), ("h", "l"), dealt_by)
        lk.add(first, "k", "k", {"via": "via"})
        lk.add(third, "m", "m", {"other": "other"}, default_unknown=("other",))
        lk.add(second, "via", "via", {"label": "label"})
        return lk.done()

    want = {(1, 1, 10, 7, "a", 100, -1, "x"), (1, None, 11, 8, None, None, 80, None), (2, 1, 12, None, "c", 102, -1, None),
            (2, 2, None, 9, "d", None, 90, None), (None, None, 10, 9, "e", 100, 90, "x")}
    for dealt_by, shuffles in (((), 2), (("h",), 1)):  # the first is how they were dealt
        found = looked_up(*dealt_by)
        assert carrying(found, "wide") == shuffles
        got = found.select("h", "l", "k", "m", "wide", "via", "other", "label").collect()
        assert len(got) == 5 and {tuple(r) for r in got} == want


def test_lines_stay_with_their_headers_through_the_lookups(nothing_fits, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "174762")  # small sides are broadcast, headers and parts aren't
    # the address lines end before the lookups, and no shuffle has what they become; by header and line key one had
    df = sales_order_slice(fixture_tables(spark, "/root/testdata/sf0.01"))
    assert carrying(df, "BillingCountry") == 0


def test_receipts_meet_lots_that_know_their_part(nothing_fits, spark):
    # once a receipt has its lot and its order line, it is shuffled for the groups and the dedupe only
    df = receipt_slice(fixture_tables(spark, SF_SMALL))
    assert not [c for c in exchanges(df) if {"__st_pnm", "FACTOR"} <= c or {"__co", "FACTOR"} <= c]
    assert sum({"PO_NUMBER", "SYSCM_AUTO_KEY"} <= c for c in exchanges(df)) == 1


@pytest.mark.parametrize("name", ["sales_order_slice", "sales_order_all"])
def test_costs_and_classes_are_found_where_the_part_is(nothing_fits, spark, name):
    plan = PLANS[name](fixture_tables(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line and "LeftOuter" in line]
    assert joins and not [line for line in joins if "__pc_month" in line or "__c_div" in line or "__pc_part" in line]


def test_classes_by_part_and_month(spark):
    history = spark.createDataFrame(
        [("1996-03-01", 1001, "A"), ("1996-03-15", 1001, "B"), ("1996-04-01", 1002, "C"), (None, 1001, "N"),
         ("1996-05-01", 1001, None), ("1996-05-01", 1003, "X"), ("1996-06-01", None, "Y")],
        "d string, PartId bigint, ProductClass string",
    ).selectExpr("cast(d as date) as AsOfDate", "PartId", "1 as DivisionId", "ProductClass")
    # two keys of one part number, a part without a number, one without snapshots
    parts = spark.createDataFrame(
        [(1001, 1, "P"), (1002, 2, "P"), (1003, 3, None), (1004, 4, "Q")], "PartId bigint, NativeId bigint, PartNumber string"
    ).withColumn("DivisionId", F.lit(1))
    side = parts.select(F.col("NativeId").alias("k"), F.col("PartId").alias("v0"), F.col("PartNumber").alias("v1"))
    found = class_months_by_part({"f_inventory_history": history, "d_part": parts}, side)
    march, april = 1996 * 12 + 3, 1996 * 12 + 4
    assert {r["__pc_native"]: r["__pc_classes"] for r in found.collect()} == {k: {march: "B", april: "C"} for k in (1, 2)}


def test_latest_costs_of_several_scopes(spark):
    orders = spark.createDataFrame(
        [(5, "1997-01-01", 1, 1), (5, "1997-02-01", 2, 2), (5, "1997-02-01", 3, 2), (6, "1997-01-01", 4, 3), (None, "1997-01-01", 9, 1)],
        "PartId bigint, d string, UnitCost int, scope int",
    ).withColumn("PODate", F.col("d").cast("date"))
    parts = spark.createDataFrame([(5, 50, "P"), (6, 60, "Q")], "PartId bigint, NativeId bigint, PartNumber string")
    scopes = {"one": F.col("scope") == 1, "two": F.col("scope") <= 2, "null": F.lit(None).cast("boolean")}
    found = latest_po_costs({"d_part": parts}, orders, scopes)
    assert {tuple(r) for r in found.collect()} == {(50, 1, 3, None)}
