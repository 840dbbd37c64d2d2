"""Deterministic first-row-per-key.

The source views rank duplicates with ``ROW_NUMBER()`` ordered by a date or by the
partition key itself, which leaves the surviving row arbitrary.  Here the order is
always total: the given order, then the listed tie-break columns ascending with
nulls first.  ``row_number() == 1`` over a window is planned by Spark as a
``WindowGroupLimit`` that keeps one row per key *before* the shuffle, so a key that
holds a large share of the rows does not land whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicewright.sources.collation import by_bytes


def total_order(df: DataFrame, order: Sequence[Column], tiebreak: Sequence[str]) -> list[Column]:
    return list(order) + [by_bytes(df, c).asc_nulls_first() for c in tiebreak]


def first_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column] = (),
    tiebreak: Sequence[str] | None = None,
    rn_name: str | None = "rn",
) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` + ``tiebreak``.

    ``tiebreak=None`` uses every column of ``df`` (in schema order) that is not a key.
    With ``rn_name`` the row number (always 1) is kept as a column, as in the views.
    """
    key_names = {k for k in keys if isinstance(k, str)}
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in key_names]
    w = Window.partitionBy(*keys).orderBy(*total_order(df, order, tiebreak))
    name = rn_name or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) == 1)
    return out if rn_name else out.drop(name)


def one_per_key(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """One row per ``key``: the smallest ``values`` tuple (nulls last).

    Built as a grouped ``min`` over a struct, i.e. a partial (map-side) aggregate:
    safe for hot keys and cheaper than a window for lookup tables.
    """
    if not values:
        return df.select(key).distinct()
    # min over a struct compares field by field; wrap each field so that nulls sort
    # last: (is_null, value).
    parts = []
    for v in values:
        parts.append(F.col(v).isNull().alias(f"__n_{v}"))
        parts.append(by_bytes(df, v).alias(v))
    agg = df.groupBy(key).agg(F.min(F.struct(*parts)).alias("__m"))
    return agg.select(key, *[F.col(f"__m.{v}").cast(df.schema[v].dataType).alias(v) for v in values])
