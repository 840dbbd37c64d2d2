import datetime as dt
from decimal import Decimal

from slicewright.functions import address as A
from slicewright.functions import exprs as X


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_date_floor_and_key(spark):
    rows = [(dt.datetime(201, 3, 4),), (dt.datetime(1999, 12, 31, 5),), (None,)]
    df = spark.createDataFrame(rows, "d timestamp_ntz")
    got = df.select(X.date_floor("d").alias("f"), X.floored_date_key("d").alias("k"), X.date_key("d").alias("raw")).collect()
    assert got[0]["f"] == dt.datetime(1900, 1, 1) and got[0]["k"] == 19000101
    assert got[1]["f"] == dt.datetime(1999, 12, 31, 5) and got[1]["k"] == 19991231
    assert got[2]["f"] is None and got[2]["k"] is None


def test_letter_and_open_flags(spark):
    assert one(spark, X.letter_flag("c"), [("T",), ("F",), (None,), ("t",)], "c string") == [True, False, False, False]
    got = one(spark, X.open_flag("f", "o", "d"),
              [("T", Decimal(5), Decimal(2)), ("T", Decimal(2), Decimal(2)), ("T", None, Decimal(1)), ("F", Decimal(5), Decimal(0))],
              "f string, o decimal(19,4), d decimal(19,4)")
    assert got == [True, False, False, False]


def test_long_term_flag(spark):
    rows = [("SLA123",), ("SO-123",), ("L",), ("AL ",), (None,), ("xL1",), ("sla9",)]
    assert one(spark, X.long_term_flag("n"), rows, "n string") == [True, False, False, False, False, True, False]


def test_money_rounding_and_zero_divisor(spark):
    rows = [(Decimal("12345.6789"), Decimal("2")), (Decimal("1.0000"), Decimal("3")), (Decimal("5"), Decimal("0")),
            (Decimal("-0.0001"), Decimal("2"))]
    got = one(spark, X.money_quotient("a", "b"), rows, "a decimal(19,4), b decimal(19,4)")
    assert got == [Decimal("6172.8395"), Decimal("0.3333"), None, Decimal("-0.0001")]
    got = one(spark, X.money_product("a", "b"), [(Decimal("1.2345"), Decimal("0.5"))], "a decimal(19,4), b decimal(19,4)")
    assert got == [Decimal("0.6173")]


def test_region_ladder_order(spark):
    codes = [("US-EAST",), ("COE1",), ("UK-HUB",), ("CN-02",), ("SHANGHAI",), ("DE-N",), ("Germany",), ("VMI-7",),
             ("PDQ",), ("OTHER",), ("USDE",), (None,)]
    got = one(spark, X.region_label("c"), codes, "c string")
    assert got == ["US", "US", "UK", "China", "China", "Bremen", "Bremen", "VMI", "PDQ", "OTHER", "US", None]


def test_months_between_boundaries(spark):
    rows = [(dt.datetime(2001, 12, 31), dt.datetime(2002, 1, 1)), (dt.datetime(2002, 1, 1), dt.datetime(2002, 1, 31))]
    got = one(spark, X.months_between_boundaries("a", "b"), rows, "a timestamp_ntz, b timestamp_ntz")
    assert got == [1, 0]


def test_billing_address(spark):
    rows = [("Customer#000000123", "BUILDING", "ZIP 00123", "UNITED STATES"),
            ("x", "y", "PO Box 7", "usa"), (None, None, None, None), ("12345-6789 Main", "", "", "  ")]
    df = spark.createDataFrame(rows, "a2 string, a3 string, a4 string, a5 string")
    got = df.select(A.billing_country("a2", "a3", "a4", "a5"), A.billing_zip("a2", "a3", "a4", "a5")).collect()
    assert tuple(got[0]) == ("UNITED STATES", "00123")
    assert tuple(got[1]) == ("UNITED STATES", None)
    assert tuple(got[2]) == (None, None)
    assert tuple(got[3]) == (None, "12345-6789")
