"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints have 64 bits.  Bit positions are dealt to the points of a finite projective
space, and each of its hyperplanes gives a mask that drops the bits of its points.  Any
``max_distance`` points lie on a common hyperplane, so two fingerprints that differ in so
many bits, or fewer, agree under at least one mask: no pair is missed.  Fingerprints that
agree with another one under some mask are candidates.

Candidates are linked without comparing pairs: each sends itself to all points within
``max_distance / 2`` bits.  Two fingerprints meet at a common point exactly if they are
within ``max_distance``, and everything that meets there is within it pairwise; a star to
the smallest one keeps them connected.  A point has a bounded number of possible visitors
(65 for two bits), so a group of near copies of any size costs rows in proportion.
Equal fingerprints are one node from the start.

Defined results
  null or blank text: fingerprint zero, linked like any other; null doc_id: the row takes part
  in linking, but never names a component (a component without any id has null);
  repeated rows: each is returned; empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.llm._store import plainly_named, written
from slicewright.llm._text import lower_ascii, release, slices, utf8
from slicewright.llm.components import connected_components

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
#: Prime order of the projective space: 3 keeps about 44 of 64 bits in each of 13 tables for
#: two bits' distance; 2 would keep 37 in each of 7, 5 would keep 51 in each of 31.
ORDER = 3


def covering_masks(max_distance: int = MAX_DISTANCE, order: int = ORDER, bits: int = BITS) -> list[int]:
    """Masks such that any ``max_distance`` bits are dropped together by one of them."""
    dims = max_distance + 1
    points = [p for p in product(range(order), repeat=dims) if next((x for x in p if x), 0) == 1]
    masks = []
    for plane in points:
        on = [sum(x * y for x, y in zip(p, plane, strict=True)) % order == 0 for p in points]
        masks.append(sum(1 << bit for bit in range(bits) if not on[bit % len(points)]))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _fingerprints(data: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    raw, at = lower_ascii(data).tobytes(), offsets.tolist()
    hashes: list[int] = []
    sizes = []
    for a, b in zip(at, at[1:]):
        words = raw[a:b].split()  # bytes split at the ASCII white space that parts words
        if len(words) > k:
            found = list(map(b" ".join, zip(*[words[i:] for i in range(k)])))
        else:
            found = [b" ".join(words)] if words else []
        sizes.append(len(found))
        hashes += map(xxhash.xxh64_intdigest, found, repeat(SEED))
    out = np.zeros(len(sizes), np.uint64)
    size = np.array(sizes, np.int64)
    if hashes:
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        some = np.flatnonzero(size)
        first = np.concatenate([[0], np.cumsum(size[some])[:-1]])
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        majority = (2 * ones > size[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (key, text_hash, fingerprint as a signed long) for every row of ``docs``."""
    kept = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    names = ["key", "text_hash", "fp"]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, (kept.schema["key"].dataType, T.LongType(), T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            parts = [_fingerprints(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k) for a, b in slices(offsets)]
            fp = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("text_hash"), pa.array(fp.view(np.int64))], names)
        release()

    return kept.mapInArrow(run, schema)


def candidates(fps: DataFrame, max_distance: int = MAX_DISTANCE, order: int = ORDER) -> DataFrame:
    """The distinct fingerprints of ``fps`` that share a bucket with another one."""
    masks = F.array(*[
        F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket"))
        for i, m in enumerate(covering_masks(max_distance, order))
    ])
    rows = fps.select("fp", F.explode(masks).alias("t")).select("fp", "t.table", "t.bucket")
    shared = written(
        rows.groupBy("table", "bucket").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high"),
        "buckets",
    )
    return rows.join(shared, ["table", "bucket"]).select("fp").distinct()


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges (a, b) that connect exactly what is within ``max_distance`` in ``fps``."""
    flips = [0] + [sum(1 << b for b in c) for n in range(1, max_distance // 2 + 1) for c in combinations(range(BITS), n)]
    near = F.transform(F.array(*[F.lit(_signed(x)) for x in flips]), lambda x: F.col("fp").bitwiseXOR(x))
    met = fps.select("fp", F.explode(near).alias("point")).groupBy("point").agg(F.collect_list("fp").alias("met"))
    return (
        met.filter(F.size("met") > 1)
        .select(F.array_min("met").alias("a"), F.explode("met").alias("b"))
        .filter("a <> b").distinct()
    )


def _labelled(
    docs: DataFrame, key: str, text: str, k: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE, order: int = ORDER,
) -> DataFrame:
    """Rows (key, text_hash, fp, root, component) for every row: root is the component's
    smallest fingerprint."""
    if max_distance < 2 or max_distance % 2:
        raise ValueError("max_distance must be a positive even number")
    rows = written(fingerprints(docs, key, text, k), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    roots = connected_components(links(candidates(fps, max_distance, order), max_distance), "a", "b")
    joined = fps.join(roots, fps["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    named = joined.groupBy("root").agg(F.min("least").alias("component"))
    labels = written(joined.join(named, "root").select("fp", "root", "component"), "labels")
    return rows.join(labels, "fp").select("key", "text_hash", "fp", "root", "component")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """Rows (key, fp, component) for every row: component is the smallest key reachable."""
    return _labelled(docs, key, text, **how).select(F.col("key").alias(key), "fp", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """``docs`` without near-duplicates: of each component, one row with its smallest key (a
    row without a key only where none has one), and of those the one with the smallest text."""
    plain, (key, text) = plainly_named(docs, key, text)
    found = _labelled(plain, key, text, **how)
    chosen = found.filter(F.col("key").eqNullSafe(F.col("component"))).select("key", "text_hash", "root").distinct()
    order = Window.partitionBy("root").orderBy(text)
    hashed = plain.withColumn("own_hash", F.xxhash64(text))
    return (
        hashed.join(chosen, F.col(key).eqNullSafe(F.col("key")) & (F.col("own_hash") == F.col("text_hash")))
        .withColumn("copy_number", F.row_number().over(order)).filter("copy_number = 1").select(*plain.columns)
    ).toDF(*docs.columns)
