"""Blocks of documents, and questions that they put to a dealt index.

A block is a group of documents with a bounded amount of text (one longer document stands
alone in effect), named by a hash of key and text: the same block whenever it is computed.
Equal rows that fill more than a block are dealt to several, and their deal is written.  A
block asks about its distinct keys (hashes) in messages, one per bucket of the hash space;
a bucket sees each key once per block that has it, however often it occurs there, and its
answers return in the order of the question.  So neither a frequent key nor a large group of
copies meets in one place, and nothing is held whole by a task but one block or one bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.llm._store import written

BLOCK_BYTES = 2 << 20
#: What a row counts for besides its text.
ROW_BYTES = 64


def _size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def block_count(docs: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> int:
    total = docs.agg(F.sum(_size(text))).first()[0] or 0
    return max(8, -(-total // block_bytes))


def bucket_count(blocks: int) -> int:
    """A power of two, so that the hash space's first bits name the bucket."""
    return 1 << max(4, (blocks // 4).bit_length())


def in_blocks(docs: DataFrame, key: str, text: str, blocks: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a column ``block``.  Rows of one key need not share a block."""
    same = F.xxhash64(key, text)
    often = written(
        docs.groupBy(same.alias("same")).agg(F.ceil(F.sum(_size(text)) / block_bytes).alias("parts")).filter("parts > 1"), "often"
    )
    if often.isEmpty():
        return docs.withColumn("block", F.pmod(same, F.lit(blocks)))
    numbered = docs.withColumn("same", same).withColumn("copy", F.xxhash64(F.monotonically_increasing_id()))
    salt = F.pmod("copy", F.coalesce("parts", F.lit(1)))
    return written(
        numbered.join(often, "same", "left").select(*docs.columns, F.pmod(F.xxhash64("same", salt), F.lit(blocks)).alias("block")), "dealt"
    )


def bucket_edges(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of sorted hashes begins, and the end: buckets + 1 places."""
    bounds = [(b << 64) // buckets for b in range(1, buckets)]
    inner = np.searchsorted(sorted_hashes, np.array(bounds, np.uint64))
    return np.concatenate([[0], inner, [len(sorted_hashes)]]).astype(np.int64)


def bucket_runs(sorted_hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets (a power of two of them) that sorted hashes fall in, and where each one's part
    begins, with the end."""
    of = sorted_hashes >> np.uint64(64 - (buckets.bit_length() - 1))
    begin = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.empty(0, np.int64)
    return of[begin].astype(np.int64), np.append(begin, len(of)).astype(np.int64)


def grouped(order: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct value in sorted ``values[order]``, and each row's group."""
    s = values[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    group = np.empty(len(s), np.int64)
    group[order] = np.cumsum(new) - 1
    return np.flatnonzero(new), group


def arrays(table: pa.Table, column: str, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), dtype) if b.is_valid else np.empty(0, dtype) for b in table.column(column)]


def packed(numbers: np.ndarray) -> bytes:
    return np.ascontiguousarray(numbers).tobytes()
