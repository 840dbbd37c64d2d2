"""Row-level sinks as DataFrame transforms: merge, conditional delete,
reclassification, volume guard.

Parquet tables have no row-level MERGE/UPDATE/DELETE, so each sink computes the new
rows of the partitions it can touch (published afterwards, see
:mod:`slicewright.sources.snapshot`):

* ``merge_rows``: one full outer join of target and source, each read once.  A target
  row with a matching source row takes the listed update columns (UPDATE), a source
  row without a match is inserted (INSERT), a target row that the delete condition
  holds for is marked (DELETE) and can't match, every other target row stays (KEEP).
  Rows that can't match (null key, outside the scope, deleted) get a salt of their
  own in the join key, so they are spread evenly and meet nothing.
* ``delete_where``: keep rows where the predicate is false *or null*.
* ``reclassify``: left join of the entity on the department; matching rows get the
  entity's division and the split flag.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "MergeAction"
#: Struct of the row as it was (null for an inserted or kept row), and as it is now.
BEFORE, AFTER = "Before", "After"
KEEP, UPDATE, INSERT, DELETE = "KEEP", "UPDATE", "INSERT", "DELETE"


@dataclass(frozen=True)
class MergeKey:
    """An equality of the match.  Null never matches, unless ``null_as`` stands for it."""

    name: str
    null_as: Column | None = None

    def value(self) -> Column:
        return F.col(self.name) if self.null_as is None else F.coalesce(F.col(self.name), self.null_as)


def _matchable(keys: Sequence[MergeKey], where: Column | None, delete: Column | None = None) -> Column:
    ok = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    if delete is not None:
        ok = ok & ~delete
    for k in keys:
        ok = ok & k.value().isNotNull()
    return ok


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[MergeKey],
    update_cols: Sequence[str],
    insert_cols: Sequence[str],
    set_on_update: Mapping[str, Column] | None = None,
    target_where: Column | None = None,
    source_where: Column | None = None,
    delete: Column | None = None,
    before: bool = False,
) -> DataFrame:
    """The target's columns and ``MergeAction``, deleted rows included; with ``before`` also the
    updated and deleted rows as they were, in a struct column ``Before``.

    ``target_where`` and ``source_where`` say which rows may match; they never drop one.
    """
    gone = F.coalesce(delete, F.lit(False)) if delete is not None else F.lit(False)
    own = F.monotonically_increasing_id()
    # a key that nothing stands in for is compared where it is, and goes through the shuffle once
    names = [k.name if k.null_as is None else f"k{i}" for i, k in enumerate(keys)]
    extra = [(k, n) for k, n in zip(keys, names) if k.null_as is not None]
    t = target.select(
        *[F.col(c).alias(f"t__{c}") for c in target.columns], F.lit(True).alias("t__present"), gone.alias("t__gone"),
        F.when(_matchable(keys, target_where, gone), F.lit(0)).otherwise(2 * own + 1).alias("t__salt"),
        *[k.value().alias(f"t__{n}") for k, n in extra],
    )
    s = source.select(
        *[F.col(c).alias(f"s__{c}") for c in source.columns], F.lit(True).alias("s__present"),
        F.when(_matchable(keys, source_where), F.lit(0)).otherwise(2 * own + 2).alias("s__salt"),
        *[k.value().alias(f"s__{n}") for k, n in extra],
    )
    match = F.col("t__salt") == F.col("s__salt")
    for n in names:
        match = match & (F.col(f"t__{n}") == F.col(f"s__{n}"))
    joined = t.join(s, match, "full_outer")
    in_target, in_source = F.col("t__present").isNotNull(), F.col("s__present").isNotNull()
    action = (
        F.when(in_target & in_source, F.lit(UPDATE)).when(in_source, F.lit(INSERT))
        .when(F.col("t__gone"), F.lit(DELETE)).otherwise(F.lit(KEEP))
    )
    set_on_update, inserted, updated = dict(set_on_update or {}), set(insert_cols), set(update_cols)
    outs = []
    for c in target.columns:
        old, new = F.col(f"t__{c}"), F.col(f"s__{c}") if c in source.columns else F.lit(None)
        on_update = set_on_update.get(c, new if c in updated else old)
        on_insert = new if c in inserted else F.lit(None)
        kind = target.schema[c].dataType
        value = F.when(action == UPDATE, on_update.cast(kind)).when(action == INSERT, on_insert.cast(kind)).otherwise(old)
        outs.append(value.alias(c))
    if before:
        old_row = F.struct(*[F.col(f"t__{c}").alias(c) for c in target.columns])
        outs.append(F.when(action.isin(UPDATE, DELETE), old_row).alias(BEFORE))
    return joined.select(*outs, action.alias(ACTION))


def changed_rows(merged: DataFrame) -> DataFrame:
    """The change feed of ``merge_rows(..., before=True)``: ``MergeAction``, ``Before`` (null for an
    insert) and ``After`` (null for a delete), one row for each row that isn't kept."""
    columns = [c for c in merged.columns if c not in (ACTION, BEFORE)]
    now = F.when(F.col(ACTION) != DELETE, F.struct(*columns))
    return merged.filter(F.col(ACTION) != KEEP).select(ACTION, BEFORE, now.alias(AFTER))


def replay(old: DataFrame, changes: DataFrame) -> DataFrame:
    """The rows of a version, from those of the version before and its changes.  Repeated rows
    count: a change takes one of them away or adds one."""
    gone = changes.filter(F.col(BEFORE).isNotNull()).select(f"{BEFORE}.*").select(*old.columns)
    come = changes.filter(F.col(AFTER).isNotNull()).select(f"{AFTER}.*").select(*old.columns)
    return old.exceptAll(gone).unionAll(come)


def matched_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[MergeKey], target_where: Column | None = None,
    source_where: Column | None = None, delete: Column | None = None,
) -> DataFrame:
    """The rows of ``target`` that :func:`merge_rows` would update.  Neither side's other rows
    take part in the join, so null keys don't meet."""
    names = [f"__m{i}" for i in range(len(keys))]
    wanted = source.filter(_matchable(keys, source_where)).select(*[k.value().alias(n) for k, n in zip(keys, names)])
    gone = F.coalesce(delete, F.lit(False)) if delete is not None else None
    rows = target.filter(_matchable(keys, target_where, gone)).select("*", *[k.value().alias(f"t{n}") for k, n in zip(keys, names)])
    match = F.lit(True)
    for n in names:
        match = match & (F.col(f"t{n}") == F.col(n))
    return rows.join(wanted, match, "left_semi").select(*target.columns)


def assert_unique(source: DataFrame, keys: Sequence[MergeKey], where: Column | None = None, what: str = "merge source") -> None:
    """Raise if two source rows that may match have equal keys, as the match compares them."""
    values = source.filter(_matchable(keys, where)).select(*[k.value().alias(f"k{i}") for i, k in enumerate(keys)])
    if values.groupBy(*values.columns).count().filter(F.col("count") > 1).limit(1).count():
        raise ValueError(f"{what}: a target row would be matched by more than one source row")


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that a ``DELETE ... WHERE predicate`` leaves (null predicate → kept)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def reclassify(
    fact: DataFrame,
    entity: DataFrame,
    split_label: str,
    from_division: int,
    flag_col: str = "IsSplit",
    mark: str | None = None,
) -> DataFrame:
    """Move rows of the split entity's departments from ``from_division`` to the
    entity's division and set the split flag; every other row is unchanged.  ``mark``
    names a further column that says which rows moved."""
    e = entity.select(
        F.col("DPT_AUTO_KEY").alias("__r_dpt"),
        F.col("DivisionId").alias("__r_div"),
        F.col("DEPT_Definition").alias("__r_label"),
    )
    j = fact.join(e, fact["DPT_AUTO_KEY"] == e["__r_dpt"], "left")
    hit = F.coalesce((F.col("__r_label") == F.lit(split_label)) & (F.col("DivisionId") == from_division),
                     F.lit(False))
    outs = []
    for c in fact.columns:
        if c == "DivisionId":
            outs.append(F.when(hit, F.col("__r_div")).otherwise(F.col(c)).cast(fact.schema[c].dataType).alias(c))
        elif c == flag_col:
            outs.append(F.when(hit, F.lit(1)).otherwise(F.col(c)).cast(fact.schema[c].dataType).alias(c))
        else:
            outs.append(F.col(c))
    return j.select(*outs, *([hit.alias(mark)] if mark else []))


def volume_guard(source: DataFrame, target: DataFrame, target_scope: Column, ratio: float) -> DataFrame:
    """One row: source rows, target rows in scope, and whether the load may replace
    (strictly more source rows than ``ratio`` × target rows).

    Both counts come from one aggregate over the tagged union of the two inputs.
    """
    tagged = source.select(F.lit(1).alias("__s"), F.lit(0).alias("__t")).unionByName(
        target.filter(target_scope).select(F.lit(0).alias("__s"), F.lit(1).alias("__t"))
    )
    g = tagged.agg(
        F.coalesce(F.sum("__s"), F.lit(0)).cast("bigint").alias("SourceRows"),
        F.coalesce(F.sum("__t"), F.lit(0)).cast("bigint").alias("TargetRows"),
    )
    limit = F.col("TargetRows").cast("decimal(38,4)") * F.lit(str(ratio)).cast("decimal(5,4)")
    return g.withColumn("Pass", F.col("SourceRows").cast("decimal(38,4)") > limit)
