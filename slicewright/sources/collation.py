"""Text comparison by a collation, as a run parameter.

The source system's collation is not declared.  By default texts compare by their letters
as they are, trailing blanks aside.  With a collation the columns that the jobs compare
(entity rules, name lookup, region ladder) are read under it, so equality, joins, grouping
and contains/prefix tests of the same jobs follow it; the jobs themselves don't change.

* Where texts that are equal under the collation compete (one row per key, ties of a
  dedupe), the choice goes by their bytes, so it is repeatable.
* ``plain`` gives collated columns their plain type back.  Published tables and query
  results are plain; the texts are never respelled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.sources.catalog import Tables

BINARY = "UTF8_BINARY"
#: Letter case and trailing blanks don't count.
CASELESS = "UTF8_LCASE_RTRIM"
#: Columns that some job compares with another text.
COMPARED: dict[str, tuple[str, ...]] = {
    "stg_sys_companies": ("company_name",),
    "stg_division": ("division_name",),
    "stg_warehouse": ("warehouse_code",),
    "stg_stock": ("IC_UDF_005",),
    "d_manufacturer": ("ManufacturerName",),
}


def is_collated(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType) and kind.collation != BINARY


def by_bytes(df: DataFrame, column: str) -> Column:
    """A column for ordering: collated text by its bytes, anything else as it is."""
    c = F.col(column)
    return F.collate(c, BINARY) if is_collated(df.schema[column].dataType) else c


def plain(df: DataFrame) -> DataFrame:
    """Collated columns as plain text; unchanged if there is none."""
    if not any(is_collated(f.dataType) for f in df.schema):
        return df
    return df.select(*[by_bytes(df, c).alias(c) for c in df.columns])


def collated(
    tables: Tables, collation: str | None = CASELESS, columns: Mapping[str, Sequence[str]] = COMPARED
) -> Tables:
    """The catalog with the compared text columns under ``collation`` (None: as they are)."""
    if collation is None:
        return tables
    for name, texts in columns.items():
        if name in tables:
            df = tables[name]
            tables = tables.with_table(
                name, df.withColumns({c: F.collate(F.col(c), collation) for c in texts if c in df.columns})
            )
    return tables
