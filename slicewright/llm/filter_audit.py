"""Filter interaction audit by min-plus removal ranks.

Filters are applied one after the other; which one takes a document away depends on their
order.  Documents that fail the same set of filters behave alike in every order, so the table
is first folded, with map-side sums, into cells (part, set of failed filters): at most
``2**filters`` of them in a part, whatever its number of documents.

For the cells of a part, ``fails`` is a matrix (cell x filter) with 0 where the cell fails the
filter and infinity elsewhere, and ``positions`` a matrix (filter x order) with the inverse
permutation of every order.  Their product in (min, +) is the step at which an order removes
a cell (infinity: never).  The cells' weights are scattered to those steps, which gives what
every step removes; a cell that fails a filter which comes after its removal is redundant
there.

Defined results
  empty table: empty result; a part without failures still has a row for each order and step,
  of zeros; a null condition counts as passed, a null weight as zero; repeated rows all count;
  other columns are ignored.  :func:`repeats_smaller`: null text is the empty text; a row
  without a key is never a repeat, and rows of one key don't repeat each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.llm._store import plainly_named, written

#: Orders are all permutations unless they are listed; above so many filters they must be.
MOST_PERMUTED = 7


def removal_steps(fails: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product of ``fails`` (cells x filters: True where failed) and ``positions``
    (filters x orders, from 1): the step that removes a cell, filters + 1 where none does."""
    never = len(positions) + 1
    steps = np.full((len(fails), positions.shape[1]), never, np.int64)
    for one, place in zip(fails.T, positions, strict=True):  # bounded by the number of filters
        np.minimum(steps, np.where(one, 0, never)[:, None] + place[None, :], out=steps)
    return steps


def _tables(fails: np.ndarray, weights: np.ndarray, orders: np.ndarray) -> dict[str, np.ndarray]:
    """Counts (orders x steps) of one part; ``weights`` (cells x kinds) begins with documents."""
    n_orders, k = orders.shape
    steps = removal_steps(fails, np.argsort(orders, axis=1).T + 1)
    scattered = np.zeros((weights.shape[1], n_orders, k + 2), np.int64)
    where = np.broadcast_to(np.arange(n_orders), steps.shape), steps
    for total, weight in zip(scattered, weights.T):
        np.add.at(total, where, np.broadcast_to(weight[:, None], steps.shape))
    removed = scattered[:, :, 1 : k + 1]
    n = weights[:, 0]
    late = [((steps < s) & fails[:, orders[:, s - 1]]) * n[:, None] for s in range(1, k + 1)]
    alone = (fails & (fails.sum(axis=1) == 1)[:, None]).T @ n
    by_filter = np.zeros(k, np.int64)
    np.add.at(by_filter, orders, removed[0])
    return {
        "kept": n.sum() - np.cumsum(removed[0], axis=1), "removed": removed[0],
        "redundant": np.stack([x.sum(axis=0) for x in late], axis=1),
        "unique_fails": alone[orders], "shapley": by_filter[orders], "lost": removed[1:],
    }


def audit(
    rows: DataFrame, part: Column, filters: dict[str, Column], lost: dict[str, Column],
    orders: Sequence[str] | None = None,
) -> DataFrame:
    """For each part, order of the filters and step: kept, removed, redundant, unique_fails,
    shapley, and a column for each condition of ``lost``, which counts the removed rows that
    meet it.

    ``filters``: by a letter, the condition on which a row fails.  ``orders``: strings of these
    letters (default: all permutations)."""
    names = list(filters)
    if any(len(x) != 1 for x in names) or not names:
        raise ValueError("filters are named by one letter each")
    if orders is None:
        if len(names) > MOST_PERMUTED:
            raise ValueError("list the orders of so many filters")
        orders = ["".join(p) for p in permutations(names)]
    if any(sorted(o) != sorted(names) for o in orders):
        raise ValueError("an order names each filter once")
    listed = np.array([[names.index(x) for x in o] for o in orders]).reshape(len(orders), len(names))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    mask = sum((flag(c) * (1 << i) for i, c in enumerate(filters.values())), F.lit(0).cast("long"))
    cells = (
        rows.select(part.cast("string").alias("part"), mask.alias("mask"), *[flag(c).alias(f"w{i}") for i, c in enumerate(lost.values())])
        .groupBy("part", "mask").agg(F.count("*").alias("n"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(lost))])
    )
    lost_names = list(lost)
    kinds = ["n", *[f"w{i}" for i in range(len(lost))]]
    counts = ["kept", "removed", "redundant", "unique_fails", *lost_names, "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"`{c}` long" for c in counts)

    def one(table: pa.Table) -> pa.Table:
        sets = table.column("mask").to_numpy()
        fails = (sets[:, None] >> np.arange(len(names))) & 1 == 1
        made = _tables(fails, np.stack([table.column(c).to_numpy() for c in kinds], axis=1), listed)
        k = len(names)
        columns = {
            "part": pa.array([table.column("part")[0].as_py()] * (len(orders) * k), pa.string()),
            "filter_order": pa.array(np.repeat(list(orders), k).tolist(), pa.string()),
            "step": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders))),
        }
        shown = made | dict(zip(lost_names, made["lost"]))
        return pa.table(columns | {c: pa.array(shown[c].ravel().astype(np.int64)) for c in counts})

    return cells.groupBy("part").applyInArrow(one, schema)


def repeats_smaller(docs: DataFrame, key: str, text: str, flag: str) -> DataFrame:
    """``docs`` without ``text`` and with a boolean column ``flag``: a row with a smaller key has
    the same text.  Texts are compared by SHA-256; ``docs`` is written once without them."""
    plain, (key_, text_) = plainly_named(docs, key, text)
    others = [c for c in plain.columns if c != text_]
    digest = F.unhex(F.sha2(F.coalesce(text_, F.lit("")), 256))
    rows = written(plain.select(*others, digest.alias("digest")), "texts")
    keyed = rows.filter(F.col(key_).isNotNull())
    # the rows of a text's smallest key are no repeats; joined on text and key, copies of one text
    # don't meet in one task
    least = keyed.groupBy("digest").agg(F.min(key_).alias(key_)).withColumn("first", F.lit(True))
    found = keyed.join(least, ["digest", key_], "left").withColumn("again", F.col("first").isNull())
    found = found.unionByName(rows.filter(F.col(key_).isNull()).withColumn("again", F.lit(False)), allowMissingColumns=True)
    named = [F.col(c).alias(docs.columns[plain.columns.index(c)]) for c in others]
    return found.select(*named, F.col("again").alias(flag))


def with_flags(rows: DataFrame, flags: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``flags``, which has a key once.  Rows without a key can't
    match; they carry numbers of their own in the join, so that they don't meet in one task."""
    spread = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    left = rows.withColumn("_spread", spread)
    # (computed, as a literal would be folded into the condition and no longer be a key)
    minus_one = F.least(F.spark_partition_id(), F.lit(0)).cast("long") - 1
    right = flags.filter(F.col(key).isNotNull()).withColumn("_spread", minus_one)
    return left.join(right, [key, "_spread"], "left").drop("_spread")
