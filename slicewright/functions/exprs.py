"""Column expressions.

Every function returns a :class:`pyspark.sql.Column` built from built-in functions,
so it stays inside whole-stage code generation.  Rules:

* money is ``decimal(19,4)``; a product or quotient is computed exactly in decimal
  and rounded HALF_UP once, when cast back to money;
* float outputs are cast from exact decimals at the end;
* flags compare letters and never return null;
* dates before year 1000 are floored to 1900-01-01 where the warehouse needs it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slicewright.config import (
    DATE_FLOOR_LIMIT,
    DATE_FLOOR_VALUE,
    UNKNOWN_KEY,
)

MONEY = "decimal(19,4)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def money_product(a: str | Column, b: str | Column) -> Column:
    """``CAST(a * b AS money)``: exact decimal product, rounded once."""
    return (col(a) * col(b)).cast(MONEY)


def money_quotient(a: str | Column, b: str | Column) -> Column:
    """``CAST(a / b AS money)``; a zero or null divisor gives null (no ANSI error)."""
    return F.try_divide(col(a), col(b)).cast(MONEY)


def checked_divisor(c: str | Column, strict: bool) -> Column:
    """The divisor; with ``strict`` a zero raises instead of giving null quotients."""
    c = col(c)
    return F.when(c == 0, F.raise_error(F.lit("zero unit-of-measure factor"))).otherwise(c) if strict else c


def as_float(c: str | Column) -> Column:
    return col(c).cast("double")


def key_or_unknown(c: str | Column) -> Column:
    """``ISNULL(id, -1)`` for a surrogate key; keeps the key's type."""
    return F.coalesce(col(c), F.lit(UNKNOWN_KEY))


def ts_literal(d) -> Column:
    return F.lit(d.isoformat() if hasattr(d, "isoformat") else str(d)).cast("timestamp_ntz")


def date_floor(c: str | Column) -> Column:
    """Dates before 1000-01-01 become 1900-01-01; null stays null."""
    c = col(c).cast("timestamp_ntz")
    return F.when(c < ts_literal(DATE_FLOOR_LIMIT), ts_literal(DATE_FLOOR_VALUE)).otherwise(c)


def date_key(c: str | Column) -> Column:
    """``yyyymmdd`` as int (style-112 date key)."""
    return F.date_format(col(c), "yyyyMMdd").cast("int")


def floored_date_key(c: str | Column) -> Column:
    return date_key(date_floor(c))


def letter_flag(c: str | Column, letter: str = "T") -> Column:
    """'T' → true, anything else (null included) → false; trailing blanks don't count."""
    return F.coalesce(F.rtrim(col(c)) == F.lit(letter), F.lit(False))


def open_flag(flag: str | Column, ordered: str | Column, delivered: str | Column) -> Column:
    """Open letter and something left to deliver; null → false."""
    return F.coalesce(
        (F.rtrim(col(flag)) == F.lit("T")) & ((col(ordered) - col(delivered)) > 0), F.lit(False)
    )


def long_term_flag(number: str | Column) -> Column:
    """First three characters contain 'L' and are three characters long (blanks trimmed)."""
    head = F.substring(col(number), 1, 3)
    return F.coalesce(head.contains("L") & (F.length(F.rtrim(head)) == 3), F.lit(False))


def fixed_width(c: str | Column, n: int) -> Column:
    """``CAST(x AS varchar(n))``: cut to ``n`` characters."""
    return F.substring(col(c).cast("string"), 1, n)


def month_number(c: str | Column) -> Column:
    """Months since year 0: equal month numbers = same calendar month."""
    c = col(c)
    return F.year(c) * 12 + F.month(c)


def months_between_boundaries(start: str | Column, end: str | Column) -> Column:
    """``DATEDIFF(month, start, end)``: month boundaries crossed, not elapsed months."""
    return month_number(end) - month_number(start)


# --- fixed values: warehouse-code region ladder (first match wins) ---------------
# contains 'US' → US; contains 'COE' → US; contains 'UK' → UK; contains 'CN' → China;
# equals 'SHANGHAI', 'XAIC C919', 'XIAN LTA' → China; contains 'DE' → Bremen;
# equals 'Germany' → Bremen; contains 'VMI' → VMI; contains 'PDQ' → PDQ; else the code.
REGION_LADDER: tuple[tuple[str, str, str], ...] = (
    ("contains", "US", "US"),
    ("contains", "COE", "US"),
    ("contains", "UK", "UK"),
    ("contains", "CN", "China"),
    ("equals", "SHANGHAI", "China"),
    ("equals", "XAIC C919", "China"),
    ("equals", "XIAN LTA", "China"),
    ("contains", "DE", "Bremen"),
    ("equals", "Germany", "Bremen"),
    ("contains", "VMI", "VMI"),
    ("contains", "PDQ", "PDQ"),
)


def region_label(code: str | Column) -> Column:
    code = col(code)
    out = None
    for kind, text, label in REGION_LADDER:
        cond = code.contains(text) if kind == "contains" else (F.rtrim(code) == F.lit(text))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(code)
