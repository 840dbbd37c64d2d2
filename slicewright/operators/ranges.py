"""Range joins as equi-joins.

``point BETWEEN low AND high`` has no key to hash.  Here each interval gets the power of two
2^k that is just large enough for it to lie in at most two aligned blocks of that length, and
one row for each; a point looks its block up at every length that some interval has.  Block
and length are the join key; the bounds are compared after it.

An interval covers over a quarter of its blocks, so at most a constant share of the compared
pairs fails.  Intervals are doubled at most, points multiplied by the number of different
lengths (64 at most, however wide the intervals are).  Intervals may overlap, nest and repeat;
one with a null bound, or that ends before it begins, holds nothing; a null point is in none.

Points and bounds are whole numbers; use days or microseconds for times.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ids = count()


def _block(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value, level)


def _blocks(intervals: DataFrame, low: str, high: str, tag: str) -> DataFrame:
    """The intervals with their ``level`` and one row for each block (at most two)."""
    a, b = F.col(f"{tag}_low"), F.col(f"{tag}_high")
    held = intervals.withColumns({f"{tag}_low": F.col(low).cast("long"), f"{tag}_high": F.col(high).cast("long")}).filter(a <= b)
    # the smallest k with (high >> k) - (low >> k) <= 1 (a difference beyond 64 bits is null)
    fits = lambda k: F.try_subtract(_block(b, k), _block(a, k)) <= 1
    level = F.array_min(F.filter(F.sequence(F.lit(0), F.lit(63)), fits))
    held = held.withColumn(f"{tag}_level", level)
    lvl = F.col(f"{tag}_level")
    return held.withColumn(f"{tag}_block", F.explode(F.array_distinct(F.array(_block(a, lvl), _block(b, lvl)))))


def range_join(points: DataFrame, point: str, intervals: DataFrame, low: str, high: str) -> DataFrame:
    """Every row of ``points`` with every interval that holds its ``point`` (inner join): the
    columns of both."""
    tag = f"__rg{next(_ids)}"
    sides = _blocks(intervals, low, high, tag)
    levels = sides.agg(F.collect_set(f"{tag}_level")).scalar()  # at most 64 numbers
    sides = sides.select(
        *[F.col(c).alias(f"{tag}_i{i}") for i, c in enumerate(intervals.columns)],
        *[f"{tag}_{c}" for c in ("low", "high", "level", "block")],
    )
    at = points.withColumn(f"{tag}_at", F.col(point).cast("long")).filter(F.col(f"{tag}_at").isNotNull())
    at = at.withColumn(f"{tag}_pl", F.explode(levels))
    value = F.col(f"{tag}_at")
    at = at.withColumn(f"{tag}_pb", _block(value, F.col(f"{tag}_pl")))
    on = (
        (F.col(f"{tag}_pl") == F.col(f"{tag}_level")) & (F.col(f"{tag}_pb") == F.col(f"{tag}_block"))
        & (value >= F.col(f"{tag}_low")) & (value <= F.col(f"{tag}_high"))
    )
    return at.join(sides, on).select(
        *points.columns, *[F.col(f"{tag}_i{i}").alias(c) for i, c in enumerate(intervals.columns)]
    )


def range_lookup(points: DataFrame, point: str, intervals: DataFrame, low: str, high: str, aggregates: dict[str, Column]) -> DataFrame:
    """Each row of ``points`` with aggregates over the intervals that hold its ``point`` (null,
    if none does).

    Only the distinct points meet the intervals, so a point that many rows share is one row
    there; the rows then look their point up."""
    tag = f"__rl{next(_ids)}"
    distinct = points.filter(F.col(point).isNotNull()).select(F.col(point).alias(f"{tag}_p")).distinct()
    found = range_join(distinct, f"{tag}_p", intervals, low, high).groupBy(f"{tag}_p").agg(
        *[a.alias(name) for name, a in aggregates.items()]
    )
    # rows without a point match nothing and needn't meet
    own = F.when(F.col(point).isNull(), F.monotonically_increasing_id() + 1).otherwise(F.lit(0).cast("long"))
    found = found.withColumn(f"{tag}_z", F.least(F.spark_partition_id(), F.lit(0)).cast("long"))
    rows = points.withColumn(f"{tag}_s", own)
    joined = rows.join(found, (F.col(point) == F.col(f"{tag}_p")) & (F.col(f"{tag}_s") == F.col(f"{tag}_z")), "left")
    return joined.select(*points.columns, *aggregates)
