"""Surrogate-key and staging lookups as left joins that never fan out.

The warehouse views resolve every native key through a left join to a dimension
scoped to one division, with ``-1`` for a miss.  A dimension or staging table with
two rows for one key would multiply detail rows; the views then hide that behind a
row-number filter with an arbitrary winner.  Here each lookup side is first reduced
to one row per key (smallest values, nulls last), so the join keeps the row count
and the choice is repeatable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.config import DIMENSION_DIVISION
from slicewright.functions.exprs import key_or_unknown
from slicewright.operators.broadcast import is_bounded
from slicewright.operators.dedupe import one_per_key
from slicewright.sources.collation import by_bytes

_ids = count()


def _kept(df: DataFrame) -> dict[tuple, DataFrame]:
    """Relations derived from ``df``, kept on the DataFrame itself: they live as long as the
    catalog that holds it, and two sessions never share one."""
    return df.__dict__.setdefault("_derived", {})


def _stand_in(left: DataFrame, key: Column) -> Column | None:
    """``key`` with another value in each row where it is null; None if its type has none to give."""
    kind = left.select(key).schema[0].dataType
    row = F.monotonically_increasing_id()
    values = {T.LongType: F.xxhash64(row), T.IntegerType: F.hash(row), T.StringType: row}
    return F.coalesce(key, values[type(kind)].cast(kind)) if type(kind) in values else None


def left_join(
    left: DataFrame, side: DataFrame, on: Column | None, key: Column, bound: DataFrame, side_key: Column | None = None,
    spread: dict[str, str] | None = None,
) -> DataFrame:
    """``left`` ⟕ ``side`` on ``key`` equal to ``side_key`` and ``on`` (or on ``on`` alone, which asks
    ``key`` of the left side to equal something).

    Unless ``bound`` (a relation at least as large as ``side``) is small enough to be broadcast,
    the rows whose key is null, which can't match, must not meet in one task.  With a ``side_key``
    the join compares a column in which each of them has a value of its own, and a flag beside it
    says which may match: neither side gets a further join key, so a side that was grouped by its
    key isn't shuffled again, nor are rows that met another side on the same column (``spread``: those
    of earlier joins, by key; without it the column ends here).  Else such rows get a number of
    their own as a further join key; all others have 0 there.  (The side's 0 is computed: a literal
    would be folded into the condition, and no longer be a key.)"""
    if side_key is not None:
        equal = key == side_key
        whole = equal if on is None else equal & on
    else:
        whole = on
    if is_bounded(bound):
        return left.join(side, whole, "left")
    own = _stand_in(left, key) if side_key is not None else None
    if own is not None:
        known = {} if spread is None else spread
        if str(key) not in known:
            known[str(key)] = f"__own{next(_ids)}"
            left = left.withColumns({known[str(key)]: own, f"{known[str(key)]}_set": key.isNotNull()})
        at = known[str(key)]
        match = (F.col(at) == side_key) & F.col(f"{at}_set")
        joined = left.join(side, match if on is None else match & on, "left")
        return joined if spread is not None else joined.drop(at, f"{at}_set")
    tag = f"__null{next(_ids)}"
    own = F.when(key.isNull(), F.monotonically_increasing_id() + 1).otherwise(F.lit(0).cast("long"))
    zero = F.least(F.spark_partition_id(), F.lit(0)).cast("long")
    left, side = left.withColumn(f"{tag}_l", own), side.withColumn(f"{tag}_r", zero)
    return left.join(side, whole & (F.col(f"{tag}_l") == F.col(f"{tag}_r")), "left").drop(f"{tag}_l", f"{tag}_r")


def lookup_side(right: DataFrame, right_key: str, src: Sequence[str]) -> DataFrame:
    """``right`` reduced to one row per ``right_key``: columns ``k, v0, v1, ...``.

    Kept with the input DataFrame, so two lookups into the same table (part and
    alternate part, current and original place) share one plan and Spark reuses
    the exchange instead of reducing the table twice.
    """
    kept, key = _kept(right), ("side", right_key, *src)
    if key in kept:
        return kept[key]
    if len(src) == 1:
        least = F.min(by_bytes(right, src[0])).cast(right.schema[src[0]].dataType)
        side = right.groupBy(F.col(right_key).alias("k")).agg(least.alias("v0"))
    else:
        side = one_per_key(right.select(right_key, *src), right_key, list(src)).toDF(
            "k", *[f"v{i}" for i in range(len(src))]
        )
    kept[key] = side
    return side


def scoped(dim: DataFrame, division: int | None = DIMENSION_DIVISION, **equals) -> DataFrame:
    """Rows of ``dim`` in ``division`` (None: all) and with the given column values.

    Kept with the input DataFrame (see :func:`lookup_side`)."""
    kept, key = _kept(dim), ("scoped", division, *sorted(equals.items()))
    if key in kept:
        return kept[key]
    out = dim
    if division is not None:
        out = out.filter(F.col("DivisionId") == F.lit(division))
    for c, v in equals.items():
        out = out.filter(F.col(c) == F.lit(v))
    kept[key] = out
    return out


def lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str | Column,
    right_key: str,
    values: Mapping[str, str],
    default_unknown: Sequence[str] = (),
) -> DataFrame:
    """Left-join ``right`` (reduced to one row per ``right_key``) on ``left_key``.

    ``values`` maps output column → right column.  Outputs named in
    ``default_unknown`` get ``-1`` on a miss.  The lookup side is prepared on its
    own small plan; the large side gets one join and one projection.
    """
    tag = f"__lk{next(_ids)}"
    src = list(dict.fromkeys(values.values()))
    side = lookup_side(right, right_key, src).toDF(f"{tag}_k", *[f"{tag}_{i}" for i in range(len(src))])
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    joined = left_join(left, side, None, lk, right, F.col(f"{tag}_k"))
    outs = []
    for out_c, src_c in values.items():
        c = F.col(f"{tag}_{src.index(src_c)}")
        outs.append((key_or_unknown(c) if out_c in default_unknown else c).alias(out_c))
    keep = [c for c in left.columns if c not in values]
    return joined.select(*keep, *outs)


def key_lookup(
    left: DataFrame,
    dim: DataFrame,
    left_key: str | Column,
    id_col: str,
    out: str | None = None,
    division: int | None = DIMENSION_DIVISION,
    default: bool = True,
    **equals,
) -> DataFrame:
    """Surrogate key of ``dim`` by ``NativeId`` (or another key via ``native``)."""
    native = equals.pop("native", "NativeId")
    out = out or id_col
    return lookup(
        left,
        scoped(dim, division, **equals),
        left_key,
        native,
        {out: id_col},
        default_unknown=(out,) if default else (),
    )


class Lookups:
    """A chain of lookups on one large DataFrame: one join per lookup and a single
    projection at the end (``done``), instead of a projection after every join.

    Outputs of earlier lookups are available to later join keys through ``col``.

    ``row_key`` names columns that no two rows share (null counts as a value).  With it, lookups into
    sides too large to be broadcast are made on a copy of the rows that column pruning cuts to
    the keys, and the copy meets the rows once, by ``row_key``: each such lookup shuffles the narrow
    copy, and the wide rows are shuffled once for all of them.  A single large side is joined to the rows.

    ``dealt_by`` names columns of the row key that the rows were shuffled by already, into the session's
    number of partitions.  The copy is then brought to the rows, which stay where they are: a join on
    the row key would shuffle them once more, so the two are united and meet in a window.
    """

    def __init__(self, df: DataFrame, row_key: Sequence[str] = (), dealt_by: Sequence[str] = ()):
        self.df = df
        self._base = list(df.columns)
        self._outs: dict[str, Column] = {}
        self._row_key = tuple(row_key)
        self._dealt_by = tuple(dealt_by)
        self._joins: list[_Join] = []
        self._asked: set[str] = set()

    def col(self, name: str) -> Column:
        self._asked.add(name)
        return self._outs[name] if name in self._outs else F.col(name)

    def add(
        self,
        right: DataFrame,
        left_key: str | Column,
        right_key: str,
        values: Mapping[str, str],
        default_unknown: Sequence[str] = (),
    ) -> Lookups:
        tag = f"__lk{next(_ids)}"
        src = list(dict.fromkeys(values.values()))
        side = lookup_side(right, right_key, src).toDF(f"{tag}_k", *[f"{tag}_{i}" for i in range(len(src))])
        lk = self.col(left_key) if isinstance(left_key, str) else left_key
        self._register(side, None, "left", lk, right, side.columns[1:], values, F.col(f"{tag}_k"))
        for out_c, src_c in values.items():
            c = F.col(f"{tag}_{src.index(src_c)}")
            self._outs[out_c] = key_or_unknown(c) if out_c in default_unknown else c
        return self

    def key(
        self,
        dim: DataFrame,
        left_key: str | Column,
        id_col: str,
        out: str | None = None,
        division: int | None = DIMENSION_DIVISION,
        default: bool = True,
        **equals,
    ) -> Lookups:
        native = equals.pop("native", "NativeId")
        out = out or id_col
        return self.add(scoped(dim, division, **equals), left_key, native, {out: id_col},
                        default_unknown=(out,) if default else ())

    def join(
        self, other: DataFrame, on: Column | None = None, how: str = "left", key: str | Column | None = None,
        side_key: Column | None = None, picks: Mapping[str, Column] | None = None,
    ) -> Lookups:
        """A plain join in the chain (pre-reduced side, e.g. an aggregate).  ``key``: a column of
        the large side that ``on`` asks to be equal, whose nulls are spread in a left join; with
        ``side_key``, the side's column that it equals, ``on`` holds what else is asked, if anything.
        ``picks``: what goes on from the join, by name, in place of the side's columns; it is made
        from these and from columns of the rows."""
        added = list(picks) if picks else [c for c in other.columns if c not in self._base]
        self._base += added
        key = self.col(key) if isinstance(key, str) else key
        self._register(other, on, how, key if how == "left" else None, other, added, added, side_key, picks)
        return self

    def _register(self, side, on, how, key, bound, columns, outs, side_key, picks=None) -> None:
        uses = [j for j in self._joins if self._asked & set(j.outs)]
        self._asked = set()
        self._joins.append(_Join(side, on, how, key, bound, list(columns), set(outs), uses, side_key, picks))

    def _joined(self) -> DataFrame:
        far = [j for j in self._joins if self._row_key and j.how == "left" and not is_bounded(j.bound)]
        if len(far) < 2:
            return reduce(lambda df, j: j.to(df), self._joins, self.df)
        rows = reduce(lambda df, j: j.to(df), [j for j in self._joins if j not in far], self.df)
        # what the keys of the large lookups are made from comes along
        needed = far + [u for j in far for u in j.with_uses()]
        spread: dict[str, str] = {}
        narrow = reduce(lambda df, j: j.to(df, spread), _by_key([j for j in self._joins if j in needed]), self.df)
        tag = f"__row{next(_ids)}"
        if self._dealt_by:
            return self._brought(rows, narrow, [c for j in far for c in j.columns], tag)
        narrow = narrow.select(
            *[F.col(k).alias(f"{tag}_{k}") for k in self._row_key], *[F.col(c) for j in far for c in j.columns]
        )
        same = [F.col(k).eqNullSafe(F.col(f"{tag}_{k}")) for k in self._row_key]
        return rows.join(narrow, reduce(Column.__and__, same), "left")

    def _brought(self, rows: DataFrame, narrow: DataFrame, found: Sequence[str], tag: str) -> DataFrame:
        """``rows`` with the columns ``found`` of ``narrow``, which has one row for each of them."""
        narrow = narrow.select(*[F.col(c).alias(f"{tag}_{c}") for c in (*self._row_key, *found)])
        narrow = narrow.repartition(*[f"{tag}_{c}" for c in self._dealt_by])
        narrow = narrow.withColumnsRenamed({f"{tag}_{k}": k for k in self._row_key})
        both = rows.withColumn(tag, F.lit(True)).unionByName(narrow, allowMissingColumns=True)
        pair = Window.partitionBy(*self._row_key)  # a row and what was found for it, null in the row itself
        met = both.select(
            tag, *rows.columns, *[F.first(f"{tag}_{c}", ignorenulls=True).over(pair).alias(c) for c in found]
        )
        return met.filter(F.col(tag)).drop(tag)

    def done(self) -> DataFrame:
        keep = [F.col(c) for c in self._base if c not in self._outs]
        return self._joined().select(*keep, *[e.alias(n) for n, e in self._outs.items()])


def _by_key(joins: Sequence[_Join]) -> list[_Join]:
    """``joins`` with those on one key side by side, as far as what they use comes before them: rows
    that were shuffled by the key then meet all its sides."""
    out: list[_Join] = []
    for j in joins:
        alike = [i for i, o in enumerate(out) if j.side_key is not None and o.side_key is not None and str(o.key) == str(j.key)]
        used = [i for i, o in enumerate(out) if o in j.uses]
        at = alike[-1] + 1 if alike else len(out)
        out.insert(at if at > max(used, default=-1) else len(out), j)
    return out


@dataclass(eq=False)
class _Join:
    """One registered join of a :class:`Lookups` chain; ``uses`` are those its key is made from."""

    side: DataFrame
    on: Column | None
    how: str
    key: Column | None
    bound: DataFrame
    columns: list[str]
    outs: set[str]
    uses: list[_Join]
    side_key: Column | None = None
    picks: Mapping[str, Column] | None = None

    def to(self, df: DataFrame, spread: dict[str, str] | None = None) -> DataFrame:
        if self.key is None:
            joined = df.join(self.side, self.on, self.how)
        else:
            joined = left_join(df, self.side, self.on, self.key, self.bound, self.side_key, spread)
        if self.picks is None:
            return joined
        return joined.withColumns(self.picks).drop(*[c for c in self.side.columns if c not in self.picks])

    def with_uses(self) -> list[_Join]:
        return [x for u in self.uses for x in (u, *u.with_uses())]
