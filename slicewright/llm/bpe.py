"""Byte-level BPE encoding and decoding of whole texts.

A text is cut into segments that always begin at a pre-token boundary: white space that
follows something else starts a new match of the splitting pattern, whatever surrounds it.
Each segment's ids depend on the segment alone, so they are remembered per worker.

Texts longer than ``CHUNK`` characters are cut into overlapping chunks that are dealt over the
cluster.  Each chunk is pre-tokenised from its own start; where two neighbours first agree on
a boundary inside their overlap, both are in step, as matching only looks ahead.  The pieces
between these seams are encoded in parallel and their ids joined in order.  A text with an
overlap that has no common boundary (one very long run) is encoded in one piece instead.
Decoding joins the raw bytes of the ids.

Defined results
  null or empty text: no ids and empty bytes; any key, null included, is carried along;
  repeated rows: each is returned; empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.llm._text import release, slices, utf8

CHUNK = 32_768
OVERLAP = 1_024
#: Segments remembered by a worker, and the longest that is.
REMEMBERED, LONGEST = 100_000, 64
#: White space as the splitting patterns understand it (Unicode White_Space; fixed values).
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SEGMENT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")


class Tokenizer:
    """A rank file's content and its splitting pattern; small enough to travel with a task."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = file.read()
        self.pattern = pattern

    def coder(self) -> _Coder:
        return _coder(self.ranks, self.pattern)


class _Coder(dict):
    """Ids (as bytes) by segment."""

    def __init__(self, ranks: bytes, pattern: str):
        super().__init__()
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pieces = [b""] * (max(table.values(), default=-1) + 1)
        for piece, rank in table.items():
            self.pieces[rank] = piece

    def __missing__(self, segment: str) -> bytes:
        ids = array("I", self.encoding.encode_ordinary(segment)).tobytes()
        if len(segment) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[segment] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, SEGMENT.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _coder(ranks: bytes, pattern: str) -> _Coder:
    return _Coder(ranks, pattern)


def _mapped(df: DataFrame, source: str, made: dict[str, T.DataType], keep: list[str], f: Callable[..., list]) -> DataFrame:
    """``df``'s columns ``keep``, and those that ``f(values of source, *other columns)`` makes
    of some rows at a time."""
    kept = df.select(*dict.fromkeys([*keep, source]))
    schema = T.StructType([*[kept.schema[c] for c in keep], *[T.StructField(n, t) for n, t in made.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(source)).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in slices(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])):
                part = batch.slice(a, b - a)
                made_columns = f(part)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + made_columns, [*keep, *made])
        release()

    return kept.mapInArrow(run, schema)


def _encoded(df: DataFrame, keep: list[str], tokenizer: Tokenizer, text: str = "text") -> DataFrame:
    def ids(part: pa.RecordBatch) -> list:
        coder = tokenizer.coder()
        return [pa.array([coder.encode(t or "") for t in part.column(text).to_pylist()], pa.binary())]

    return _mapped(df, text, {"ids": T.BinaryType()}, keep, ids)


def _boundaries(text: str, start: int, last: bool, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Segment starts in the chunk's first ``overlap`` characters, and in those that it shares
    with the next chunk.  A segment that the chunk's end may have cut isn't trusted."""
    at = [m.start() for m in SEGMENT.finditer(text)]
    if not last and at:
        at.pop()
    return [start + p for p in at if p < overlap], [start + p for p in at if p >= chunk]


def _encode_long(docs: DataFrame, tokenizer: Tokenizer, chunk: int, overlap: int) -> DataFrame:
    """(key, ids) for rows (key, text) whose texts are longer than a chunk."""
    key_type = docs.schema["key"].dataType
    name = F.sha2(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("null")), F.lit(":"), F.col("text")), 256)
    named = docs.groupBy(name.alias("name")).agg(F.first("key").alias("key"), F.first("text").alias("text"), F.count("*").alias("copies"))
    schema = T.StructType([
        T.StructField("name", T.StringType()), T.StructField("key", key_type), T.StructField("copies", T.LongType()),
        T.StructField("j", T.LongType()), T.StructField("start", T.LongType()), T.StructField("last", T.BooleanType()),
        T.StructField("chunk", T.StringType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                starts = range(0, len(text), chunk)
                for j, start in enumerate(starts):
                    one = batch.slice(i, 1)
                    yield pa.RecordBatch.from_arrays(
                        [one.column("name"), one.column("key"), one.column("copies"), pa.array([j]), pa.array([start]),
                         pa.array([j == len(starts) - 1]), pa.array([text[start : start + chunk + overlap]])],
                        schema.names,
                    )

    chunks = named.select("name", "key", "copies", "text").mapInArrow(cut, schema).repartition("name", "j")

    def seams(part: pa.RecordBatch) -> list:
        found = [
            _boundaries(t, s, e, chunk, overlap)
            for t, s, e in zip(*(part.column(c).to_pylist() for c in ("chunk", "start", "last")), strict=True)
        ]
        return [pa.array([f[i] for f in found], pa.list_(pa.int64())) for i in (0, 1)]

    numbers = T.ArrayType(T.LongType())
    starts = _mapped(chunks, "chunk", {"head": numbers, "tail": numbers}, ["name", "j", "start", "last"], seams)
    order = Window.partitionBy("name").orderBy("j")
    common = F.array_min(F.array_intersect(F.lag("tail").over(order), F.col("head")))
    stitched = (
        starts.withColumn("low", F.when(F.col("j") == 0, F.lit(0)).otherwise(common))
        .withColumn("high", F.lead("low").over(order))
        .withColumn("whole", F.min((F.col("low").isNotNull()).cast("int")).over(Window.partitionBy("name")) == 1)
        .select("name", "j", "low", "high", "whole")
    )
    pieces = chunks.join(stitched.filter("whole"), ["name", "j"])
    size = F.coalesce(F.col("high"), F.col("start") + F.length("chunk")) - F.col("low")
    pieces = pieces.withColumn("piece", F.substring(F.col("chunk"), (F.col("low") - F.col("start") + 1).cast("int"), size.cast("int")))
    ids = _encoded(pieces, ["name", "key", "copies", "j"], tokenizer, "piece")
    gathered = ids.groupBy("name").agg(
        F.first("key").alias("key"), F.first("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("j", "ids"))).alias("pieces")
    ).select("key", "copies", F.col("pieces.ids").alias("pieces"))
    joined_schema = T.StructType([gathered.schema["key"], gathered.schema["copies"], T.StructField("ids", T.BinaryType())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                ids = pa.array([b"".join(one.column("pieces")[0].as_py())], pa.binary())
                yield pa.RecordBatch.from_arrays([one.column("key"), one.column("copies"), ids], joined_schema.names)

    in_step = gathered.mapInArrow(join, joined_schema)
    broken = stitched.filter(~F.col("whole")).select("name").distinct()
    whole = _encoded(named.join(broken, "name", "left_semi"), ["key", "copies"], tokenizer)
    return in_step.union(whole).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("key", "ids")


def encode(
    docs: DataFrame, tokenizer: Tokenizer, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Rows (key, ids) for every row of ``docs``: ids as little-endian 32-bit numbers."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = _encoded(rows.filter(F.length("text") <= chunk), ["key"], tokenizer)
    long = _encode_long(rows.filter(F.length("text") > chunk), tokenizer, chunk, overlap)
    return short.union(long).withColumnRenamed("key", key)


def decode(encoded: DataFrame, tokenizer: Tokenizer, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids in column ``out``."""

    def texts(part: pa.RecordBatch) -> list:
        coder = tokenizer.coder()
        return [pa.array([coder.decode(i or b"") for i in part.column(ids).to_pylist()], pa.binary())]

    return _mapped(encoded, ids, {out: T.BinaryType()}, encoded.columns, texts)
