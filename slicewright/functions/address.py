"""Billing address split: four free-text address lines → (Country, ZipCode).

The source system resolves country and postal code with a table function whose body
is not part of the slice definitions; these are our rules, chosen to be plain
column expressions (one output row per input row, no join):

* ZipCode: the first five-digit group (optionally ``-dddd``) in lines 4, 5, 3, 2,
  in that order; null when there is none.
* Country: the last of lines 5 and 4 that is non-blank and holds no digit, in upper
  case, with a few common aliases mapped to one spelling; null when neither fits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slicewright.functions.exprs import col

ZIP_PATTERN = r"([0-9]{5}(-[0-9]{4})?)"

# --- fixed values: country aliases → one spelling ---------------------------------
# USA, US, U.S.A., UNITED STATES OF AMERICA → UNITED STATES;
# UK, GB, GREAT BRITAIN → UNITED KINGDOM; PRC → CHINA.
COUNTRY_ALIASES: tuple[tuple[str, str], ...] = (
    ("USA", "UNITED STATES"),
    ("US", "UNITED STATES"),
    ("U.S.A.", "UNITED STATES"),
    ("UNITED STATES OF AMERICA", "UNITED STATES"),
    ("UK", "UNITED KINGDOM"),
    ("GB", "UNITED KINGDOM"),
    ("GREAT BRITAIN", "UNITED KINGDOM"),
    ("PRC", "CHINA"),
)


def _country_line(c: Column) -> Column:
    t = F.upper(F.trim(c))
    return F.when((F.length(t) > 0) & ~t.rlike("[0-9]"), t)


def billing_zip(a2, a3, a4, a5) -> Column:
    text = F.concat_ws("|", col(a4), col(a5), col(a3), col(a2))
    z = F.regexp_extract(text, ZIP_PATTERN, 1)
    return F.when(z != F.lit(""), z)


def billing_country(a2, a3, a4, a5) -> Column:
    raw = F.coalesce(_country_line(col(a5)), _country_line(col(a4)))
    out = None
    for alias, name in COUNTRY_ALIASES:
        cond = raw == F.lit(alias)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(raw)
