"""Address split by rule tables."""

from slicewright.operators.addresses import default_rules, normalised, shape, split_address
from pyspark.sql import functions as F

LINES = "id int, BILL_ADDRESS2 string, BILL_ADDRESS3 string, BILL_ADDRESS4 string, BILL_ADDRESS5 string"
ROWS = [
    # id, lines 2 to 5, country, code
    (1, "Acme", "1 Main St", "Springfield 62704-1234", "u.s.a.", "UNITED STATES", "62704-1234"),
    (2, "Acme", None, "London SW1A 1AA", "England", "UNITED KINGDOM", "SW1A 1AA"),
    (3, "Acme", None, "Leeds ls1  4ap", " Great   Britain ", "UNITED KINGDOM", "LS1 4AP"),
    (4, "Acme", None, "Toronto, M5V,2T6", "CAN", "CANADA", "M5V 2T6"),
    (5, "Acme", None, "Beijing 100080", "P.R.C.", "CHINA", "100080"),
    (6, "Acme", None, "Beijing 10008", "China", "CHINA", None),  # a form of another country
    (7, "Acme", "75001", "PARIS", "FRANCE 3", "PARIS", "75001"),
    (8, None, None, None, None, None, None),
    (9, "", " ", "", "  ", None, None),
    (10, "12345", "23456", None, "Peru", "PERU", "23456"),  # line 3 comes before line 2
    (11, "x" * 50_000 + " 12345", None, None, "Peru", "PERU", "12345"),
    (12, "a " * 50_000 + "12345", None, None, "Peru", "PERU", "12345"),
    (11, "repeated id", "54321", None, "Peru", "PERU", "54321"),
]


def split(spark, rows=ROWS, aliases=None, shapes=None):
    a, s = default_rules(spark)
    return split_address(spark.createDataFrame([r[:5] for r in rows], LINES), aliases or a, shapes or s)


def test_codes_of_several_countries(spark):
    got = split(spark)
    assert got.columns == [*(c.split()[0] for c in LINES.split(", ")), "BillingCountry", "BillingZipCode"]
    assert sorted(((r["id"], r["BillingCountry"], r["BillingZipCode"]) for r in got.collect()), key=repr) == sorted(
        ((r[0], r[5], r[6]) for r in ROWS), key=repr
    )


def test_many_aliases_are_one_join_and_never_fan_out(spark):
    name = F.concat(F.lit("Land "), F.translate(F.col("id").cast("string"), "0123456789", "ABCDEFGHIJ"))
    wide = spark.range(10_000).select(name.alias("Alias"), F.lit("PERU").alias("Country"))
    more = spark.createDataFrame([(None, "NOWHERE"), ("land h", "ANDORRA")], "Alias string, Country string")
    rows = [(1, "x", "12345", None, "land  BCD"), (2, "x", "12345", None, "LAND H"), (3, "x", None, None, None), (4, "x", None, "12", "Land")]
    got = split(spark, rows * 5, aliases=wide.unionAll(wide).unionAll(more))
    # of the spellings that are listed twice the lowest country holds
    found = sorted((r["id"], r["BillingCountry"] or "", r["BillingZipCode"] or "") for r in got.collect())
    assert found == sorted([(1, "PERU", "12345"), (2, "ANDORRA", "12345"), (3, "", ""), (4, "LAND", "")] * 5)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2  # aliases, forms


def test_alias_table_decides(spark):
    aliases = spark.createDataFrame([("Nippon", "JAPAN"), ("nippon.", "JAPAN")], "Alias string, Country string")
    shapes = spark.createDataFrame([("JAPAN", "999-9999"), ("*", "9999")], "Country string, Shape string")
    rows = [(1, None, None, "Tokyo 100-0001", "NIPPON"), (2, None, None, "Wien 1010", "Austria"), (3, None, None, "Tokyo 1010", "Nippon")]
    got = {r["id"]: (r["BillingCountry"], r["BillingZipCode"]) for r in split(spark, rows, aliases, shapes).collect()}
    assert got == {1: ("JAPAN", "100-0001"), 2: ("AUSTRIA", "1010"), 3: ("JAPAN", None)}


def test_empty_rule_tables(spark):
    a, s = default_rules(spark)
    got = split(spark, ROWS[:2], a.limit(0), s.limit(0)).collect()
    assert [(r["BillingCountry"], r["BillingZipCode"]) for r in sorted(got)] == [("USA", None), ("ENGLAND", None)]


def test_shape_and_spelling(spark):
    row = spark.range(1).select(shape(F.lit("SW1A 2-x")), normalised(F.lit(" u.S.  a "))).first()
    assert tuple(row) == ("AA9A 9-x", "US A")
