from pyspark.sql import functions as F

from slicewright.config import EntityConfig, EntityRule
from slicewright.operators.dedupe import first_per_key, one_per_key
from slicewright.operators.entity import entity_dim
from slicewright.operators.lookups import key_lookup
import pytest

from slicewright.operators.merge import MergeKey, assert_unique, delete_where, merge_rows, reclassify, volume_guard


def test_first_per_key_is_deterministic_across_partitions(spark):
    rows = [(k % 7, k % 3, f"v{k % 5}", k) for k in range(300)]
    base = spark.createDataFrame(rows, "k int, d int, s string, n int")
    results = set()
    for parts in (1, 8, 200):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = first_per_key(base.repartition(parts), ["k"], order=[F.col("d").desc()], rn_name="rn").orderBy("k").collect()
        results.add(tuple(tuple(r) for r in got))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(results) == 1
    (res,) = results
    assert all(r[4] == 1 for r in res) and len(res) == 7


def test_one_per_key_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, 5, "z"), (1, 5, "a"), (2, None, None)], "k int, a int, b string")
    got = {r["k"]: (r["a"], r["b"]) for r in one_per_key(df, "k", ["a", "b"]).collect()}
    assert got == {1: (5, "a"), 2: (None, None)}


def test_key_lookup_defaults_and_no_fanout(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "x bigint")
    dim = spark.createDataFrame([(10, 1, 1), (11, 1, 1), (20, 2, 2)], "CustomerId bigint, NativeId bigint, DivisionId int")
    got = sorted((tuple(r) for r in key_lookup(left, dim, "x", "CustomerId").collect()), key=repr)
    assert got == sorted([(1, 10), (2, -1), (None, -1)], key=repr)


def test_entity_rules_first_match_and_fallback(spark):
    dept = spark.createDataFrame([(106, "A", 0, 0), (120, "B", 0, 0), (121, "C", 1, 0), (122, "D", 0, 9)],
                                 "DPT_AUTO_KEY int, dept_name string, DIV_AUTO_KEY int, SYSCM_AUTO_KEY int")
    div = spark.createDataFrame([(0, "AMER", 0), (1, "EMEA", 0)], "DIV_AUTO_KEY int, division_name string, SYSCM_AUTO_KEY int")
    co = spark.createDataFrame([(0, "PARENT, LLC"), (9, "OTHER")], "SYSCM_AUTO_KEY int, company_name string")
    t = {"stg_department": dept, "stg_division": div, "stg_sys_companies": co}
    got = {r["DPT_AUTO_KEY"]: (r["DEPT_Definition"], r["DivisionId"]) for r in entity_dim(t).collect()}
    assert got == {106: ("Split Unit", 12), 120: ("US", 1), 121: ("EMEA", 25), 122: ("OTHER", None)}
    cfg = EntityConfig(rules=(EntityRule("Split Unit", 12, dept_keys=(106,)),), fallback_company="PARENT, LLC")
    got = {r["DPT_AUTO_KEY"]: (r["DEPT_Definition"], r["DivisionId"]) for r in entity_dim(t, cfg).collect()}
    assert got[120] == ("PARENT, LLC", 1)  # the fallback only fires for unlabelled departments


def _merge(spark, target_rows, source_rows, **kw):
    t = spark.createDataFrame(target_rows, "k int, d int, v int, stamp string")
    s = spark.createDataFrame(source_rows, "k int, d int, v int")
    m = merge_rows(t, s, [MergeKey("k")], ["v"], ["k", "d", "v"], {"stamp": F.lit("now")}, **kw)
    return sorted((tuple(r) for r in m.collect()), key=repr)


def test_merge_rows_actions(spark):
    split = F.col("d") == 12
    got = _merge(spark, [(1, 12, 0, None), (2, 1, 0, None), (None, 12, 0, None), (4, 12, 0, None)],
                 [(1, 12, 5), (3, 12, 7), (None, 12, 9), (4, 12, 8)], target_where=split, delete=F.col("k") == 4)
    assert (1, 12, 5, "now", "UPDATE") in got
    assert (2, 1, 0, None, "KEEP") in got          # outside the slice: kept
    assert (3, 12, 7, None, "INSERT") in got
    assert (None, 12, 0, None, "KEEP") in got and (None, 12, 9, None, "INSERT") in got  # null keys never match
    assert (4, 12, 0, None, "DELETE") in got and (4, 12, 8, None, "INSERT") in got  # a deleted row can't match
    assert len(got) == 7
    again = _merge(spark, [r[:4] for r in got if r[4] != "DELETE"], [(1, 12, 5), (3, 12, 7)], target_where=split)
    assert sum(1 for r in again if r[4] == "INSERT") == 0  # second run inserts nothing


def test_target_only_condition_is_not_a_filter(spark):
    got = _merge(spark, [(1, 1, 0, None), (1, None, 0, None)], [(1, 12, 5)], target_where=F.col("d") == 12)
    assert (1, 1, 0, None, "KEEP") in [r for r in got if r[1]] and (1, 12, 5, None, "INSERT") in got and len(got) == 3


def test_null_stand_ins_match_and_count_as_one_key(spark):
    schema = "k int, line int, v int"
    t = spark.createDataFrame([(1, None, 0), (2, 0, 0)], schema)
    s = spark.createDataFrame([(1, 0, 5), (2, None, 6)], schema)
    keys = [MergeKey("k"), MergeKey("line", F.lit(0))]
    got = {(r["k"], r["v"], r["MergeAction"]) for r in merge_rows(t, s, keys, ["v"], ["k", "line", "v"]).collect()}
    assert got == {(1, 5, "UPDATE"), (2, 6, "UPDATE")}
    with pytest.raises(ValueError):
        assert_unique(spark.createDataFrame([(1, None, 0), (1, 0, 1)], schema), keys)
    assert_unique(spark.createDataFrame([(None, 1, 0), (None, 1, 1), (1, 2, 0)], schema), keys)  # null keys insert each


def test_rows_that_cannot_match_are_spread(spark):
    t = spark.createDataFrame([(None, 12, i, None) for i in range(2000)], "k int, d int, v int, stamp string").repartition(4)
    s = spark.createDataFrame([(None, 12, i) for i in range(2000)], "k int, d int, v int").repartition(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = merge_rows(t, s, [MergeKey("k")], ["v"], ["k", "d", "v"])
        sizes = [r["count"] for r in merged.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and max(sizes) < 1000  # 8 partitions


def test_plain_keys_go_through_the_merge_once(spark):
    t = spark.createDataFrame([(1, 2, "a")], "k long, line long, v string")
    s = spark.createDataFrame([(1, 2, "b")], "k long, line long, v string")
    merged = merge_rows(t, s, [MergeKey("k"), MergeKey("line", F.lit(0))], ["v"], ["k", "line", "v"])
    shown = merged._jdf.queryExecution().analyzed().toString()
    assert "s__k0" not in shown and "s__k1" in shown  # only the key with a stand-in has a column of its own
    assert [tuple(r) for r in merged.collect()] == [(1, 2, "b", "UPDATE")]


def test_delete_where_keeps_null(spark):
    df = spark.createDataFrame([(106,), (1,), (None,)], "d int")
    assert sorted(r[0] or 0 for r in delete_where(df, F.col("d") == 106).collect()) == [0, 1]


def test_reclassify(spark):
    fact = spark.createDataFrame([(1, 106, 1, None), (2, 106, 12, None), (3, 101, 1, None), (4, 999, 1, None)],
                                 "id int, DPT_AUTO_KEY int, DivisionId int, IsSplit int")
    ent = spark.createDataFrame([(106, 12, "Split Unit"), (101, 1, "US")], "DPT_AUTO_KEY int, DivisionId int, DEPT_Definition string")
    got = {r["id"]: (r["DivisionId"], r["IsSplit"]) for r in reclassify(fact, ent, "Split Unit", 1).collect()}
    assert got == {1: (12, 1), 2: (12, None), 3: (1, None), 4: (1, None)}


def test_volume_guard_is_strict(spark):
    tgt = spark.createDataFrame([(12,)] * 10 + [(1,)] * 5, "DivisionId int")
    for n, expect in ((7, False), (8, False), (9, True)):
        src = spark.createDataFrame([(i,) for i in range(n)], "x int")
        g = volume_guard(src, tgt, F.col("DivisionId") == 12, 0.8).first()
        assert (g["SourceRows"], g["TargetRows"], g["Pass"]) == (n, 10, expect)


def test_product_class_takes_latest_snapshot_in_month(spark):
    import datetime as dt

    from slicewright.plans.common import part_classes

    ih = spark.createDataFrame(
        [(dt.date(1996, 3, 1), 1001, 1, "A"), (dt.date(1996, 3, 15), 1001, 1, "B"),
         (dt.date(1996, 3, 15), 1001, 1, None), (dt.date(1996, 4, 1), 1001, 2, "C")],
        "AsOfDate date, PartId bigint, DivisionId int, ProductClass string")
    parts = spark.createDataFrame([(1001, 1, 1, "P-1", "EA")], "PartId bigint, NativeId bigint, DivisionId int, PartNumber string, UoM string")
    got = {(r["__pc_part"], r["__pc_month"]): r["__pc_class"]
           for r in part_classes({"f_inventory_history": ih, "d_part": parts}).collect()}
    assert got == {("P-1", 1996 * 12 + 3): "B"}  # latest date in March wins; April is another division


def test_latest_po_cost_ties(spark):
    import datetime as dt
    from decimal import Decimal

    from slicewright.plans.common import latest_po_cost

    po = spark.createDataFrame(
        [(5, dt.datetime(1997, 1, 1), Decimal("1.0000")), (5, dt.datetime(1997, 2, 1), Decimal("2.0000")),
         (5, dt.datetime(1997, 2, 1), Decimal("3.0000")), (5, None, Decimal("9.0000")), (6, None, Decimal("4.0000"))],
        "PartId bigint, PODate timestamp_ntz, UnitCost decimal(19,4)")
    parts = spark.createDataFrame([(5, 50, 1, "P5", "EA"), (6, 60, 1, "P6", "EA")],
                                  "PartId bigint, NativeId bigint, DivisionId int, PartNumber string, UoM string")
    got = {r["PartAutoKey"]: r["PoUnitCost"] for r in latest_po_cost({"d_part": parts}, po).collect()}
    assert got == {50: Decimal("3.0000"), 60: Decimal("4.0000")}  # latest date, then highest cost; null date last


def test_receipt_totals_edge_factors(spark):
    import datetime as dt
    from decimal import Decimal as D

    from slicewright.plans.receipts import receipt_totals

    d = dt.datetime(1997, 5, 1)
    t = {
        "stg_rc_detail": spark.createDataFrame([(i, 1, i, 1) for i in range(1, 5)],
                                               "RCD_AUTO_KEY bigint, RCH_AUTO_KEY bigint, POD_AUTO_KEY bigint, ITEM_NUMBER int"),
        "stg_rc_header": spark.createDataFrame([(1, 0, 7)], "RCH_AUTO_KEY bigint, SYSCM_AUTO_KEY int, CMP_AUTO_KEY bigint"),
        "stg_stock": spark.createDataFrame([(1, 11, D(300000), d), (2, 12, D(300000), d), (3, 13, D(10), d), (4, 14, D(10), d)],
                                           "RCD_AUTO_KEY bigint, PNM_AUTO_KEY bigint, QTY_REC decimal(19,4), REC_DATE timestamp_ntz"),
        "stg_po_detail": spark.createDataFrame(
            [(1, "PO-1", D("2.5000"), D(2), 1, 106), (2, "PO-2", D("2.5000"), D(0), 1, 106),
             (3, "PO-3", D("2.5001"), D("0.5"), 4, 106), (4, "PO-4", D("2.5000"), None, 4, 106)],
            "POD_AUTO_KEY bigint, PO_NUMBER string, UNIT_COST decimal(19,4), FACTOR decimal(19,4), UOM_AUTO_KEY bigint, DPT_AUTO_KEY int"),
        "stg_parts_master": spark.createDataFrame([(p,) for p in (11, 12, 13, 14)], "PNM_AUTO_KEY bigint"),
        "stg_sys_companies": spark.createDataFrame([(0, "PARENT, LLC")], "SYSCM_AUTO_KEY int, company_name string"),
        "stg_companies": spark.createDataFrame([(7,)], "CMP_AUTO_KEY bigint"),
        "d_vendor": spark.createDataFrame([(700007, 7, 1)], "VendorId bigint, NativeId bigint, DivisionId int"),
        "d_part": spark.createDataFrame([(100011, 11, 1, "P11", "EA")], "PartId bigint, NativeId bigint, DivisionId int, PartNumber string, UoM string"),
    }
    got = {r["PONumber"]: r for r in receipt_totals(t).collect()}
    assert got["PO-1"]["QuantityReceived"] == 150000.0 and got["PO-1"]["CalculatedValue"] == 750000.0  # outlier repaired
    assert got["PO-1"]["VendorId"] == 700007 and got["PO-1"]["PartId"] == 100011
    assert got["PO-2"]["QuantityReceived"] is None and got["PO-2"]["UnitCost"] == D("2.5000")  # factor 0: no error
    assert got["PO-3"]["UnitCost"] == D("5.0002") and got["PO-3"]["CalculatedValue"] == 50.002  # unit of measure 4
    assert got["PO-4"]["UnitCost"] == D("2.5000") and got["PO-4"]["QuantityReceived"] == 10.0  # null factor
    assert got["PO-2"]["PartId"] == -1


def test_lookup_chain_uses_earlier_outputs(spark):
    from pyspark.sql import functions as F

    from slicewright.operators.lookups import Lookups

    left = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id int, pnm bigint")
    parts = spark.createDataFrame([(100, 7, 1, "P7"), (101, 7, 1, "P7b"), (200, 8, 2, "P8")],
                                  "PartId bigint, NativeId bigint, DivisionId int, PartNumber string")
    classes = spark.createDataFrame([("P7", "A")], "pn string, cls string")
    lk = Lookups(left)
    lk.add(parts.filter("DivisionId = 1"), "pnm", "NativeId", {"PartId": "PartId", "__pn": "PartNumber"},
           default_unknown=("PartId",))
    lk.join(classes, lk.col("__pn") == F.col("pn"))
    got = {r["id"]: (r["PartId"], r["cls"]) for r in lk.done().collect()}
    assert got == {1: (100, "A"), 2: (-1, None), 3: (-1, None)}  # lowest id wins, no fan-out


def test_age_bands_of_any_width(spark):
    from slicewright.plans.inventory import age_band_by_month

    bands = [(1, 0, 12), (2, 10, 20), (5, 21, 2147483647), (6, None, 30), (7, 30, None), (8, None, None), (9, 40, 35)]
    ages = spark.createDataFrame(bands, "AgeId int, MinMonth int, MaxMonth int")
    months = spark.createDataFrame([(m,) for m in (-5, 0, 11, 15, 21, 30, 99_999_999, None)], "__age_m int")
    got = {r[0]: r[1] for r in age_band_by_month(ages, months).collect()}
    assert got == {0: 1, 11: 1, 15: 2, 21: 5, 30: 5, 99_999_999: 5}  # lowest id wins; a null bound holds nothing


def test_trailing_blanks_do_not_count(spark):
    from slicewright.functions import exprs as X

    rows = spark.createDataFrame([("T ", "SHANGHAI  ", 2, 1), ("t", " SHANGHAI", 2, 1), (None, None, 2, 1)], "f string, w string, o int, d int")
    got = [tuple(r) for r in rows.select(X.letter_flag("f"), X.region_label("w"), X.open_flag("f", "o", "d")).collect()]
    assert got == [(True, "China", True), (False, " SHANGHAI", False), (False, None, False)]


def test_zero_factors_are_counted_and_strict_mode_raises(spark, tables):
    from slicewright.plans.purchase_order import purchase_order_slice, zero_factors

    po = tables["stg_po_detail"]
    spoiled = tables.with_table("stg_po_detail", po.withColumn("FACTOR", F.when(F.col("DPT_AUTO_KEY") == 106, F.lit(0)).otherwise(F.col("FACTOR")).cast(po.schema["FACTOR"].dataType)))
    of_106 = po.filter("DPT_AUTO_KEY = 106").count()
    counts = {r["DivisionId"]: r["ZeroFactors"] for r in zero_factors(spoiled).collect()}
    assert counts[12] >= of_106 > 0
    assert purchase_order_slice(spoiled).filter("DPT_AUTO_KEY = 106 AND UnitCost IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="zero unit-of-measure factor"):
        purchase_order_slice(spoiled, strict=True).collect()
