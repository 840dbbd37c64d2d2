"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions, each in the context of the bits before it in the byte
and of the ``DEPTH`` bytes before that.  For a decision, the contexts of depth 0 .. DEPTH are
nodes of a tree.  A node's counts give a Krichevsky-Trofimov estimate, and its weighted
probability is half the estimate and half the product of its children's weighted
probabilities, so the training texts themselves decide how much each depth counts.  A decision
is then coded by the mixture along its path, as deep as training has seen it.  The code length
of a text, its end mark included, is the sum over its bytes.

Counting, and looking up, both go by distinct (DEPTH + 1)-byte strings ("grams").  Counts are
gathered per slice of text, dealt to buckets by the two latest context bytes, so that each
bucket holds whole subtrees below depth 2, and added up there.  Depths 0 and 1 have 256 x 255
nodes at most; their sums are all that the driver sees of the tree.  Blocks of documents ask
the buckets for their distinct grams and words and add up the answers per document.

The words' unigram model with add-one smoothing (``base_score``) is counted and looked up
along the same way; words are compared by a 64-bit hash.

Defined results
  null or empty text: the end mark alone; null key: trains, and is scored like any other;
  repeated rows: each counts and is returned; empty table: empty result; no training
  document: every decision has probability 1/2, and the unigram model one unseen word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.llm._blocks import arrays, block_count, bucket_count, bucket_edges, in_blocks, packed
from slicewright.llm._store import written
from slicewright.llm._text import U64, lower_ascii, slices, utf8, words_of

DEPTH = 4
BLOCK_BYTES = 8 << 20
#: Byte that ends a text; it occurs in no UTF-8 text.  Contexts before a text are zero bytes.
END = 0xFF
WORD, GRAM = 0, 1
#: Stands for the end of a text among the words' hashes (fixed value).
END_WORD = U64(0x5D3F1A9C27E84B61)
_TURN, _BACK = 40503, pow(40503, -1, 1 << 16)
_LOG_HALF = math.log(0.5)

_COUNTS = "bucket long, kind int, keys binary, counts binary"
_QUESTION = "block long, bucket long, kind int, keys binary"
_ANSWER = "block long, bucket long, kind int, values binary"


def gram_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Key of the gram that ends at each byte of the rows, each followed by the end mark: 16
    bits that spread the two latest context bytes, then the two before them, then the byte."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    pad = DEPTH + 1  # END and zeros after each row separate it from the next
    out = np.zeros(len(data) + rows * pad + DEPTH, np.uint8)
    start = offsets[:-1] + np.arange(rows) * pad + DEPTH
    place = np.repeat(start - offsets[:-1], size) + np.arange(len(data))
    out[place] = data
    out[start + size] = END
    ends = np.repeat(start - offsets[:-1] - np.arange(rows), size + 1) + np.arange(len(data) + rows)
    x = out.astype(U64)
    c1, c2, c3, c4 = (x[ends - j] for j in range(1, DEPTH + 1))
    near = ((c2 << U64(8)) | c1) * U64(_TURN) & U64(0xFFFF)
    return (near << U64(48)) | (c4 << U64(16)) | (c3 << U64(8)) | x[ends]


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    s = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.empty(0, np.int64)
    return s[first], np.diff(np.append(first, len(s)))


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of several (keys, counts)."""
    if not parts:
        return np.empty(0, U64), np.empty(0, np.int64)
    keys, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.empty(0, np.int64)
    return s[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _kinds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end mark for each row, and gram keys."""
    data = lower_ascii(data)
    words = words_of(data, offsets).hash
    return np.concatenate([words, np.full(len(offsets) - 1, END_WORD)]), gram_keys(data, offsets)


def _dealt(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    edges = bucket_edges(keys, buckets)
    return [(b, int(edges[b]), int(edges[b + 1])) for b in range(buckets) if edges[b] < edges[b + 1]]


def training_counts(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """(bucket, kind, keys, counts): the totals of the training rows, one row a bucket and kind."""
    names = ["bucket", "kind", "keys", "counts"]

    def message(kind: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, counts = added(parts)
        dealt = _dealt(keys, buckets)
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _, _ in dealt], pa.int64()), pa.array([kind] * len(dealt), pa.int32()),
             pa.array([packed(keys[x:y]) for _, x, y in dealt], pa.binary()),
             pa.array([packed(counts[x:y].astype(np.int64)) for _, x, y in dealt], pa.binary())], names,
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = 0, ([], [])
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            for a, b in slices(offsets):
                for part, keys in zip(parts, _kinds(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])):
                    part.append(counted(keys))
                held += int(offsets[b] - offsets[a]) + 1
                if held >= BLOCK_BYTES:
                    yield from (message(k, p) for k, p in enumerate(parts))
                    held, parts = 0, ([], [])
        if held:
            yield from (message(k, p) for k, p in enumerate(parts))

    def add(table: pa.Table) -> pa.Table:
        keys, counts = added(list(zip(arrays(table, "keys", "<u8"), arrays(table, "counts", "<i8"))))
        first = table.slice(0, 1)
        return pa.table([first.column("bucket"), first.column("kind"), pa.array([packed(keys)], pa.binary()), pa.array([packed(counts)], pa.binary())], names)

    return docs.select(text).mapInArrow(count, _COUNTS).groupBy("bucket", "kind").applyInArrow(add, _COUNTS)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 1/2, by Stirling's series eight steps further."""
    product = np.zeros_like(x)
    for i in range(8):
        product += np.log(x + i)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - product


def _log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the KT probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def _decisions(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Node keys of each gram's eight decisions at depths 2, 3 and 4 (context, then the bits
    before), and the bits."""
    near, rest = keys >> U64(48), keys & U64(0xFFFFFF)
    c4, c3, byte = rest >> U64(16), (rest >> U64(8)) & U64(0xFF), rest & U64(0xFF)
    step = np.arange(8, dtype=U64)[None, :]
    before = (U64(1) << step) | (byte[:, None] >> (U64(8) - step))
    bits = ((byte[:, None] >> (U64(7) - step)) & U64(1)).astype(np.int64)
    contexts = [near, (near << U64(8)) | c3, (((near << U64(8)) | c3) << U64(8)) | c4]
    return [((c[:, None] << U64(8)) | before).ravel() for c in contexts], bits.ravel()


class _Subtrees:
    """The nodes of depth 2 and below that one bucket holds."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        nodes, bits = _decisions(keys)
        weight = np.repeat(counts.astype(float), 8)
        self.nodes, self.zeros, self.ones, places = [], [], [], []
        for node in nodes:
            found, first, place = np.unique(node, return_index=True, return_inverse=True)
            self.nodes.append(found)
            self.ones.append(np.bincount(place, weight * bits, len(found)))
            self.zeros.append(np.bincount(place, weight * (1 - bits), len(found)))
            places.append((first, place))
        log_weighted = None
        self.stays = [None, None, None]  # weight of a node's own estimate
        for d in (2, 1, 0):
            own = _log_estimate(self.zeros[d], self.ones[d])
            if log_weighted is None:
                self.stays[d] = np.ones(len(own))
                log_weighted = own
                continue
            first = places[d + 1][0]
            below = np.bincount(places[d][1][first], log_weighted, len(own)) if len(own) else own
            total = np.logaddexp(_LOG_HALF + own, _LOG_HALF + below)
            self.stays[d] = np.exp(_LOG_HALF + own - total)
            log_weighted = total
        self.log_weighted = log_weighted

    def ones_rate(self, d: int) -> np.ndarray:
        return (self.ones[d] + 0.5) / (self.zeros[d] + self.ones[d] + 1.0)


def _latest(near: np.ndarray) -> np.ndarray:
    """The latest context byte of spread two-byte contexts."""
    return (near * U64(_BACK) & U64(0xFF)).astype(np.int64)


class Top:
    """Depths 0 and 1, as arrays over (context byte, bits before)."""

    def __init__(self, rows: list[tuple[int, int, float, float, float]]):
        zeros, ones, below = np.zeros((3, 256, 256))
        for c, b, z, o, w in rows:
            zeros[c, b], ones[c, b], below[c, b] = z, o, w
        seen = zeros + ones > 0
        own = _log_estimate(zeros, ones)
        total = np.where(seen, np.logaddexp(_LOG_HALF + own, _LOG_HALF + below), 0.0)
        stays = np.where(seen, np.exp(_LOG_HALF + own - total), 0.0)
        rate = (ones + 0.5) / (zeros + ones + 1.0)
        root_zeros, root_ones = zeros.sum(axis=0), ones.sum(axis=0)
        root_own = _log_estimate(root_zeros, root_ones)
        root_stays = np.exp(_LOG_HALF + root_own - np.logaddexp(_LOG_HALF + root_own, _LOG_HALF + total.sum(axis=0)))
        root_rate = (root_ones + 0.5) / (root_zeros + root_ones + 1.0)
        mixed = root_stays * root_rate
        #: What depths 0 and 1 give when depth 2 goes on, the weight left to it, and what they
        #: give when it hasn't been seen.
        self.mixed = mixed + (1 - root_stays) * stays * rate
        self.left = (1 - root_stays) * (1 - stays)
        self.alone = np.where(seen, mixed + (1 - root_stays) * rate, root_rate)


def log_probabilities(tree: _Subtrees, top: Top, keys: np.ndarray) -> np.ndarray:
    """log10 of the mixture's probability of each gram's byte in its context."""
    nodes, bits = _decisions(keys)
    context = np.repeat(_latest(keys >> U64(48)), 8)
    before = (nodes[0] & U64(0xFF)).astype(np.int64)
    mixed, left, result = top.mixed[context, before], top.left[context, before], top.alone[context, before].copy()
    going = np.ones(len(bits), bool)
    for d in range(3):
        known = tree.nodes[d]
        at = np.minimum(np.searchsorted(known, nodes[d]), max(len(known) - 1, 0))
        going &= known[at] == nodes[d] if len(known) else False
        if not going.any():
            break
        own, stays = tree.ones_rate(d)[at], tree.stays[d][at]
        result = np.where(going, mixed + left * own, result)
        mixed, left = np.where(going, mixed + left * stays * own, mixed), np.where(going, left * (1 - stays), left)
    chosen = np.where(bits == 1, result, 1.0 - result)
    return np.log10(chosen).reshape(-1, 8).sum(axis=1)


def _top(totals: DataFrame) -> tuple[Top, int, int]:
    """The tree's top, and the words' total and number of distinct ones."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["c", "b", "zeros", "ones", "below"]
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for kind, keys, counts in zip(table.column("kind").to_pylist(), arrays(table, "keys", "<u8"), arrays(table, "counts", "<i8")):
                if kind == WORD:
                    yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([0]), *[pa.array([float(x)]) for x in (counts.sum(), len(keys), 0)]], names)
                    continue
                tree = _Subtrees(keys, counts)
                node = _latest(tree.nodes[0] >> U64(8)) * 256 + (tree.nodes[0] & U64(0xFF)).astype(np.int64)
                found, place = np.unique(node, return_inverse=True)
                values = [np.bincount(place, x, len(found)) for x in (tree.zeros[0], tree.ones[0], tree.log_weighted)]
                yield pa.RecordBatch.from_arrays([pa.array(found >> 8), pa.array(found & 255), *map(pa.array, values)], names)

    rows = totals.mapInArrow(sums, "c long, b long, zeros double, ones double, below double")
    rows = rows.groupBy("c", "b").agg(F.sum("zeros"), F.sum("ones"), F.sum("below")).collect()  # 256 x 255 + 1 rows at most
    total, distinct = next(((int(r[2]), int(r[3])) for r in rows if r[0] == -1), (0, 0))
    return Top([tuple(r) for r in rows if r[0] >= 0]), total, distinct


def score(docs: DataFrame, is_training: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, training, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte);
    ``is_training`` is a condition on the columns of ``docs``."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(is_training, F.lit(False)).alias("training"))
    blocks = block_count(rows, "text", BLOCK_BYTES)
    buckets = min(1 << 16, bucket_count(blocks))
    totals = written(training_counts(rows.filter("training"), "text", buckets), "counts")
    top, train_tokens, distinct = _top(totals)
    dealt = in_blocks(rows, "key", "text", blocks, BLOCK_BYTES).groupBy("block")

    def distinct_keys(table: pa.Table) -> tuple[list[np.ndarray], list[list[np.ndarray]], np.ndarray, np.ndarray]:
        data, offsets = utf8(table.column("text"))
        held = ([], [])
        for a, b in slices(offsets):
            for part, keys in zip(held, _kinds(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])):
                part.append(counted(keys)[0])
        return [np.unique(np.concatenate(h)) if h else np.empty(0, U64) for h in held], data, offsets

    def ask(table: pa.Table) -> pa.Table:
        keys, _, _ = distinct_keys(table)
        block = table.column("block")[0].as_py()
        made = [(block, b, kind, packed(k[x:y])) for kind, k in enumerate(keys) for b, x, y in _dealt(k, buckets)]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*made), types)], ["block", "bucket", "kind", "keys"])

    def answer(questions: pa.Table, known: pa.Table) -> pa.Table:
        if not questions.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.binary())], ["block", "bucket", "kind", "values"])
        kind = questions.column("kind")[0].as_py()
        keys, counts = (arrays(known, c, t)[0] if known.num_rows else np.empty(0, t) for c, t in (("keys", "<u8"), ("counts", "<i8")))
        asked = arrays(questions, "keys", "<u8")
        every, place = np.unique(np.concatenate(asked), return_inverse=True)
        if kind == GRAM:
            values = log_probabilities(_Subtrees(keys, counts), top, every)
        else:
            at = np.minimum(np.searchsorted(keys, every), max(len(keys) - 1, 0))
            values = np.where(keys[at] == every, counts[at], 0).astype(float) if len(keys) else np.zeros(len(every))
        ends = np.cumsum([0, *map(len, asked)])
        values = values[place]
        if kind == WORD and values.max(initial=0) < 2**24:
            values = values.astype(np.float32)  # whole numbers up to 2**24 are exact in it
        out = [packed(values[a:b]) for a, b in zip(ends, ends[1:])]
        return pa.table([questions.column("block"), questions.column("bucket"), questions.column("kind"), pa.array(out, pa.binary())], ["block", "bucket", "kind", "values"])

    names = ["key", "training", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    types = [rows.schema["key"].dataType, T.BooleanType(), *[T.LongType()] * 3, *[T.DoubleType()] * 3]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])

    def add_up(table: pa.Table, answers: pa.Table) -> pa.Table:
        keys, data, offsets = distinct_keys(table)
        values = []
        for kind in (WORD, GRAM):
            own = answers.filter(pyarrow.compute.equal(answers.column("kind"), kind)).sort_by("bucket")
            sizes = {b: y - x for b, x, y in _dealt(keys[kind], buckets)}
            parts = [
                np.frombuffer(v.as_buffer(), "<f4" if len(v.as_buffer()) == 4 * sizes[b] else "<f8").astype(float)
                for b, v in zip(own.column("bucket").to_pylist(), own.column("values"))
            ]
            values.append(np.concatenate(parts) if parts else np.empty(0))
        n = len(offsets) - 1
        tokens, known, base, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        logs = np.log10((values[WORD] + 1) / (train_tokens + distinct + 1))
        for a, b in slices(offsets):
            part, at = lower_ascii(data[offsets[a] : offsets[b]]), offsets[a : b + 1] - offsets[a]
            words = words_of(part, at)
            row = np.concatenate([words.row, np.arange(b - a)])
            place = np.searchsorted(keys[WORD], np.concatenate([words.hash, np.full(b - a, END_WORD)]))
            tokens[a:b] = np.bincount(row, minlength=b - a)
            known[a:b] = np.bincount(row, values[WORD][place] > 0, b - a)
            base[a:b] = np.bincount(row, logs[place], b - a)
            length = np.diff(at) + 1
            place = np.searchsorted(keys[GRAM], gram_keys(part, at))
            total[a:b] = np.bincount(np.repeat(np.arange(b - a), length), values[GRAM][place], b - a)
        bits = -total / math.log10(2) / (np.diff(offsets) + 1)
        return pa.table(
            [table.column("key"), table.column("training"), pa.array(tokens), pa.array(known),
             pa.array(np.full(n, train_tokens)), pa.array(base), pa.array(total), pa.array(bits)], names,
        )

    answers = (
        dealt.applyInArrow(ask, _QUESTION).groupBy("bucket", "kind")
        .cogroup(totals.select(F.col("bucket").alias("of_bucket"), F.col("kind").alias("of_kind"), "keys", "counts").groupBy("of_bucket", "of_kind"))
        .applyInArrow(answer, _ANSWER)
    )
    return dealt.cogroup(answers.select(F.col("block").alias("for_block"), "bucket", "kind", "values").groupBy("for_block")).applyInArrow(
        add_up, schema
    ).withColumnRenamed("key", key)
