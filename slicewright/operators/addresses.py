"""Address split by rule tables: free-text lines → (country, postal code).

The rules are two tables of the catalog, so new countries need no change of code:

* ``Alias, Country``: spellings of a country.  The country line (the last of the two last lines
  that is non-blank and has no digit) is normalised (upper case, no full stops, single blanks)
  and looked up; a spelling that isn't listed stands for itself.
* ``Country, Shape``: forms of postal codes, written with ``9`` for a digit and ``A`` for a letter
  (``AA9A 9AA``).  Each word and each two neighbouring words of the lines is brought into that form
  and compared with the country's; the first in the order of lines 4, 5, 3, 2 that fits is the
  code, two words before one.  ``*`` holds the forms of countries that have none of their own.

Both tables are reduced to one row per key and joined once each; a row in gives one row out.
Nulls: no country line gives a null country and the forms of ``*``; no fitting word a null code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.operators.lookups import lookup

ANY = "*"
_LETTERS, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

# --- fixed values: forms of postal codes and further spellings of countries -----------------
# 9 is a digit, A a letter; * is any country that isn't listed.
SHAPES: tuple[tuple[str, str], ...] = (
    ("*", "99999"),
    ("*", "99999-9999"),
    ("CANADA", "A9A 9A9"),
    ("CHINA", "999999"),
    ("UNITED KINGDOM", "A9 9AA"),
    ("UNITED KINGDOM", "A99 9AA"),
    ("UNITED KINGDOM", "A9A 9AA"),
    ("UNITED KINGDOM", "AA9 9AA"),
    ("UNITED KINGDOM", "AA99 9AA"),
    ("UNITED KINGDOM", "AA9A 9AA"),
)
ALIASES: tuple[tuple[str, str], ...] = (
    ("CAN", "CANADA"),
    ("ENGLAND", "UNITED KINGDOM"),
    ("GB", "UNITED KINGDOM"),
    ("GREAT BRITAIN", "UNITED KINGDOM"),
    ("PEOPLES REPUBLIC OF CHINA", "CHINA"),
    ("PRC", "CHINA"),
    ("UK", "UNITED KINGDOM"),
    ("UNITED STATES OF AMERICA", "UNITED STATES"),
    ("US", "UNITED STATES"),
    ("USA", "UNITED STATES"),
)
# ---------------------------------------------------------------------------------------------


def default_rules(spark) -> tuple[DataFrame, DataFrame]:
    """The fixed values as rule tables (aliases, shapes)."""
    return spark.createDataFrame(ALIASES, "Alias string, Country string"), spark.createDataFrame(SHAPES, "Country string, Shape string")


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.upper(text), ".", ""), r"\s+", " "))


def shape(text: Column) -> Column:
    return F.translate(text, _DIGITS + _LETTERS, "9" * 10 + "A" * 26)


def _country_line(line: Column) -> Column:
    text = normalised(line)
    return F.when((F.length(text) > 0) & ~text.rlike("[0-9]"), text)


def _words(line: Column) -> Column:
    """Each word of a line, after the pair that it begins."""
    words = F.filter(F.split(F.upper(F.coalesce(line, F.lit(""))), r"[\s,|]+"), lambda w: w != "")
    following = F.slice(words, F.lit(2), F.size(words))
    return F.flatten(F.zip_with(words, following, lambda w, n: F.array(F.concat(w, F.lit(" "), n), w)))


def split_address(
    rows: DataFrame, aliases: DataFrame, shapes: DataFrame,
    lines: Sequence[str] = ("BILL_ADDRESS2", "BILL_ADDRESS3", "BILL_ADDRESS4", "BILL_ADDRESS5"),
    country: str = "BillingCountry", code: str = "BillingZipCode",
) -> DataFrame:
    """``rows`` with the columns ``country`` and ``code``."""
    two, three, four, five = (F.col(c) for c in lines)
    raw = F.coalesce(_country_line(five), _country_line(four))
    names = aliases.filter(F.col("Alias").isNotNull()).select(normalised(F.col("Alias")).alias("Alias"), "Country")
    forms = shapes.groupBy("Country").agg(F.collect_set("Shape").alias("Shapes"))
    any_country = shapes.filter(F.col("Country") == ANY).agg(F.collect_set("Shape")).scalar()
    out = lookup(rows.withColumn("__raw", raw), names, "__raw", "Alias", {"__country": "Country"})
    out = out.withColumn(country, F.coalesce("__country", "__raw"))
    out = lookup(out, forms.filter(F.col("Country") != ANY), country, "Country", {"__shapes": "Shapes"})
    fits = F.coalesce(F.col("__shapes"), any_country)
    words = F.flatten(F.array(*map(_words, (four, five, three, two))))
    out = out.withColumn("__fits", fits)
    found = F.get(F.filter(words, lambda w: F.array_contains(F.col("__fits"), shape(w))), F.lit(0))
    return out.withColumn(code, found).drop("__raw", "__country", "__shapes", "__fits")
