"""Broadcast of a side whose size Spark's own statistics bound.

The estimate is that of the optimised plan (file sizes for scans), so no job runs while a
plan is built.  Beyond the session's ``autoBroadcastJoinThreshold`` the relation is
returned as it is, and statistics and AQE choose the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_bounded(df: DataFrame) -> bool:
    """Whether ``df`` is estimated below the session's broadcast threshold."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= estimated_bytes(df) <= threshold


def broadcast_if_bounded(df: DataFrame, bound: DataFrame) -> DataFrame:
    """Broadcast ``df`` if ``bound``, a relation that is at least as large, is bounded."""
    return F.broadcast(df) if is_bounded(bound) else df
