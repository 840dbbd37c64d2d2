"""Substring dedup by relative Lempel-Ziv parsing against an index of all blocks.

The reference is the corpus itself, in blocks of documents.  A window of ``window`` words is
anchored at the least of the hashed ``anchor``-word runs inside it, so equal windows have equal
anchors; neighbouring windows with one anchor form a phrase.  Every block adds its anchors to
the index, one entry each: the phrase (or "several"), the smallest document that has it and the
place where it first stands there.

A document is parsed from left to right.  A factor points at a place in a smaller document, and
goes on for as long as the next window stands at the next place there: by whole phrases where
the index has an anchor in one form only, and window by window at the boundaries of factors,
where an anchor occurs in several phrases, so a factor ends at the very word where the texts
part.  The next factor begins behind it; it may be shorter than ``window`` words there, as the
window that stands over the boundary was found too.  A text that no factor covers is new.  The
words of factors are the duplicate spans, and are removed.

A window's place is the first one in the smallest document that has it.  So a factor is the
longest match along that place, not always the longest in any document: it also ends where an
even smaller document has the next window.

The window hashes have 64 bits; texts are compared by them.

Defined results
  null or blank text: no words, nothing removed, empty text; texts under ``window`` words: kept;
  null key: the row neither owns nor loses text; rows with one key count as one document, and
  each row is returned; empty table: empty result.  Keys are integers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.llm._blocks import (
    arrays,
    block_count,
    bucket_count,
    bucket_runs,
    grouped,
    in_blocks,
    packed,
)
from slicewright.llm._store import plainly_named
from slicewright.llm._text import U64, Words, gram_hash, mix, release, slices, utf8, words_of

WINDOW = 13
ANCHOR = 5
#: What the index says of an anchor: no other block has it; one phrase; several phrases.
ALONE, ONE_PHRASE, SEVERAL = 0, 1, 2
#: A factor: its words in the document, and where they stand in a smaller one.
FACTOR = ["first", "last", "source", "source_first"]

_QUESTION = "block long, bucket long, keys binary, phrases binary, owners binary, places binary"
_ANSWER = "block long, bucket long, round int, status binary, owners binary, places binary"


class _Parse:
    """A block's words, windows, phrases and distinct anchors."""

    def __init__(self, table: pa.Table, key: str, text: str, window: int, anchor: int):
        keys = table.column(key)
        self.known = keys.is_valid().to_numpy(zero_copy_only=False) if len(keys) else np.empty(0, bool)
        self.keys = keys.cast(pa.int64()).fill_null(0).to_numpy().astype(np.int64) if len(keys) else np.empty(0, np.int64)
        self.data, self.offsets = utf8(table.column(text))
        self.words = self._words()
        self.window = window
        w = self.words
        n = len(w.hash)
        last = max(0, n - window + 1)
        at = np.flatnonzero((w.row[:last] == w.row[window - 1 :][:last]) & self.known[w.row[:last]]) if last else np.empty(0, np.int64)
        self.at = at
        runs = gram_hash(w.hash, np.arange(n - anchor + 1), np.arange(n - anchor + 1) + anchor) if len(at) else np.empty(0, U64)
        least, place = runs[at], at.copy()
        for j in range(1, window - anchor + 1):
            lower = runs[at + j] < least
            least = np.where(lower, runs[at + j], least)
            place = np.where(lower, at + j, place)
        new = np.ones(len(at), bool)
        new[1:] = place[1:] != place[:-1]
        first = np.flatnonzero(new)
        self.phrase_of = (np.cumsum(new) - 1).astype(np.int32)
        start, end = at[first], at[np.append(first[1:], len(at)) - 1] + window if len(at) else at
        form = ((end - start) * 64 + place[first] - start).astype(U64)
        del runs, place, new
        self.phrase = mix(gram_hash(w.hash, start, end) ^ mix(form + U64(1))) | U64(1)
        self.owner = self.keys[w.row[start]]
        self.start = start
        self.place = self.place_of(start)
        anchors = mix(least[first])  # least hashes crowd at the low end; spread them again
        self.order = np.argsort(anchors, kind="stable")
        self.begin, self.group = grouped(self.order, anchors)
        self.anchors = anchors[self.order][self.begin]

    def _words(self) -> Words:
        parts, bytes_before, words_before = [], 0, 0
        for a, b in slices(self.offsets):
            base = self.offsets[a]
            w = words_of(self.data[base : self.offsets[b]], self.offsets[a : b + 1] - base)
            parts.append(Words(w.start + base, w.end + base, w.row + a, w.hash, w.first[:-1] + words_before))
            words_before += len(w.hash)
        empty = Words(*(np.empty(0, np.int64),) * 3, np.empty(0, U64), np.empty(0, np.int64))
        parts = parts or [empty]
        first = np.append(np.concatenate([p.first for p in parts]), words_before)
        return Words(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("start", "end", "row", "hash")), first)

    def place_of(self, word: np.ndarray) -> np.ndarray:
        """The places of words in their documents."""
        return (word - self.words.first[self.words.row[word]]).astype(np.int32)

    def window_hash(self, chosen: np.ndarray) -> np.ndarray:
        at = self.at[chosen]
        return gram_hash(self.words.hash, at, at + self.window)

    def window_owner(self, chosen: np.ndarray) -> np.ndarray:
        return self.keys[self.words.row[self.at[chosen]]]


def _least(owners: np.ndarray, places: np.ndarray, order: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest owner of each group, and its first place."""
    if not len(begin):
        return owners[:0], places[:0]
    owners, places = owners[order], places[order]
    least = np.minimum.reduceat(owners, begin)
    other = owners != np.repeat(least, np.diff(np.append(begin, len(owners))))
    return least, np.minimum.reduceat(np.where(other, np.iinfo(np.int32).max, places), begin).astype(np.int32)


def _questions(
    block: int, buckets: int, keys: np.ndarray, phrases: np.ndarray | None, owners: np.ndarray, places: np.ndarray
) -> pa.Table:
    some, edges = bucket_runs(keys, buckets)
    cut = lambda x: pa.array([packed(x[a:b]) for a, b in zip(edges, edges[1:])], pa.binary())
    empty = pa.array([b""] * len(some), pa.binary())
    return pa.table(
        [pa.array([block] * len(some), pa.int64()), pa.array(some, pa.int64()), cut(keys),
         empty if phrases is None else cut(phrases), cut(owners), cut(places)],
        ["block", "bucket", "keys", "phrases", "owners", "places"],
    )


def _answered(
    table: pa.Table, status: np.ndarray | None, owners: np.ndarray, places: np.ndarray, sizes: list[int], number: int
) -> pa.Table:
    ends = np.cumsum([0, *sizes])
    cut = lambda x: pa.array([packed(x[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())
    empty = pa.array([b""] * len(sizes), pa.binary())
    return pa.table(
        [table.column("block"), table.column("bucket"), pa.array([number] * len(sizes), pa.int32()),
         empty if status is None else cut(status), cut(owners), cut(places)],
        ["block", "bucket", "round", "status", "owners", "places"],
    )


def _judge_anchors(table: pa.Table) -> pa.Table:
    kinds = (("keys", "<u8"), ("phrases", "<u8"), ("owners", "<i8"), ("places", "<i4"))
    keys, phrases, owners, places = (arrays(table, c, t) for c, t in kinds)
    sizes = [len(k) for k in keys]
    keys, phrases, owners, places = map(np.concatenate, (keys, phrases, owners, places))
    order = np.argsort(keys, kind="stable")
    begin, group = grouped(order, keys)
    count = np.diff(np.append(begin, len(keys)))
    low, high = np.minimum.reduceat(phrases[order], begin), np.maximum.reduceat(phrases[order], begin)
    status = np.where(count < 2, ALONE, np.where((low == high) & (low > 0), ONE_PHRASE, SEVERAL)).astype(np.uint8)
    least, first = (np.where(status == ONE_PHRASE, x, x.dtype.type(0)) for x in _least(owners, places, order, begin))
    return _answered(table, status[group], least[group], first[group], sizes, 1)


def _judge_windows(table: pa.Table) -> pa.Table:
    keys, owners, places = (arrays(table, c, t) for c, t in (("keys", "<u8"), ("owners", "<i8"), ("places", "<i4")))
    sizes = [len(k) for k in keys]
    keys, owners, places = map(np.concatenate, (keys, owners, places))
    order = np.argsort(keys, kind="stable")
    begin, group = grouped(order, keys)
    least, first = _least(owners, places, order, begin)
    return _answered(table, None, least[group], first[group], sizes, 2)


def _joined(answers: pa.Table, number: int, column: str, dtype: str) -> np.ndarray:
    chosen = answers.filter(pa.compute.equal(answers.column("round"), number)).sort_by("bucket")
    parts = arrays(chosen, column, dtype)
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def _window_table(p: _Parse, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of the chosen windows, their smallest document and its first place, and
    which of them each window is."""
    hashes = p.window_hash(chosen)
    order = np.argsort(hashes, kind="stable")
    begin, group = grouped(order, hashes)
    return hashes[order][begin], *_least(p.window_owner(chosen), p.place_of(p.at[chosen]), order, begin), group


def _found_windows(p: _Parse, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows that a smaller document has too, the smallest such document and its place."""
    status = _joined(answers, 1, "status", "u1")[p.group]
    of_window = status[p.phrase_of]
    source = _joined(answers, 1, "owners", "<i8")[p.group][p.phrase_of]
    place = _joined(answers, 1, "places", "<i4")[p.group][p.phrase_of] + (p.at - p.start[p.phrase_of]).astype(np.int32)
    several = np.flatnonzero(of_window == SEVERAL)
    if len(several):
        which = _window_table(p, several)[3]
        source[several] = _joined(answers, 2, "owners", "<i8")[which]
        place[several] = _joined(answers, 2, "places", "<i4")[which]
    alone = np.flatnonzero(of_window == ALONE)
    if len(alone):
        _, least, first, which = _window_table(p, alone)
        source[alone], place[alone] = least[which], first[which]
    found = np.flatnonzero(source < p.window_owner(np.arange(len(p.at))))
    return found, source[found], place[found]


@dataclass
class _Factors:
    """The factors of a block's documents, from left to right: the words ``first`` up to ``end``
    (places in the block) also stand in ``source`` from ``source_first`` on."""

    row: np.ndarray
    first: np.ndarray
    end: np.ndarray
    source: np.ndarray
    source_first: np.ndarray


def _parsed(p: _Parse, answers: pa.Table) -> _Factors:
    found, source, place = _found_windows(p, answers)
    at = p.at[found]
    row = p.words.row[at] if len(at) else at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]) | (source[1:] != source[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(new)
    end = at[np.append(begin[1:], len(at)) - 1] + p.window if len(at) else at
    first = at[begin]
    first[1:] = np.maximum(first[1:], end[:-1])
    return _Factors(row[begin], first, end, source[begin], place[begin] + first - at[begin])


def _factor_lists(p: _Parse, f: _Factors) -> pa.Array:
    before = p.words.first[f.row]
    numbers = [f.first - before, f.end - 1 - before, f.source, f.source_first]
    structs = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in numbers], FACTOR)
    edges = np.searchsorted(f.row, np.arange(len(p.offsets)))
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), structs)


def _runs(mask: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``mask``, cut where rows begin."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[first] = True
    begins = np.flatnonzero(mask & (edge[:-1] | ~np.concatenate([[False], mask[:-1]])))
    ends = np.flatnonzero(mask & (edge[1:] | ~np.concatenate([mask[1:], [False]]))) + 1
    return begins, ends


def _cut_text(text: bytes, start: list[int], end: list[int], gone: list[tuple[int, int]], joined: bool) -> bytes:
    """A text without the words of the spans ``gone``; start and end are its words' places."""
    parts, at = [], 0
    if joined:
        for s, e in [*gone, (len(start), len(start))]:
            parts += [text[start[i] : end[i]] for i in range(at, s)]
            at = e
        return b" ".join(parts)
    for s, e in gone:
        parts.append(text[at : start[s]])
        at = start[e] if e < len(start) else len(text)
    return b"".join([*parts, text[at:]])


def _cleaned(p: _Parse, factors: _Factors, joined: bool) -> tuple[np.ndarray, list[list[dict]], list[str]]:
    w, n = p.words, len(p.words.hash)
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, factors.first, 1)
    np.add.at(depth, factors.end, -1)
    covered = np.cumsum(depth[:-1]) > 0
    removed = np.add.reduceat(np.append(covered, False).astype(np.int64), w.first[:-1]) * (w.count > 0) if len(w.first) > 1 else np.empty(0, np.int64)
    begins, ends = _runs(covered, w.first)
    by_row: dict[int, list[tuple[int, int]]] = {}
    for r, s, e in zip((w.row[begins] if len(begins) else begins).tolist(), begins.tolist(), ends.tolist()):
        by_row.setdefault(r, []).append((s, e))
    spans, texts = [], []
    for r in range(len(p.offsets) - 1):
        text = p.data[p.offsets[r] : p.offsets[r + 1]].tobytes()
        a, b = int(w.first[r]), int(w.first[r + 1])
        gone = [(s - a, e - a) for s, e in by_row.get(r, [])]
        spans.append([{"first": s, "last": e - 1} for s, e in gone])
        if gone:
            text = _cut_text(text, (w.start[a:b] - p.offsets[r]).tolist(), (w.end[a:b] - p.offsets[r]).tolist(), gone, joined)
        elif joined:
            text = b" ".join(text.split())
        texts.append(text.decode("utf-8", "replace"))
    return removed, spans, texts


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, joined: bool = True
) -> DataFrame:
    """``docs`` with n_words, n_removed, factors (first and last word, the document that has them
    and the word there), spans (ranges of removed words) and kept_text.  The kept words are joined by one space; with ``joined=False`` the text around removed spans
    stays as it is.  Columns of ``docs`` with the names of the new ones are left out."""
    new = ["n_words", "n_removed", "factors", "spans", "kept_text"]
    given = [c for c in docs.columns if c not in new]
    docs, (key, text) = plainly_named(docs.select(*given), key, text)
    blocks = block_count(docs, text)
    buckets = bucket_count(blocks)
    dealt = in_blocks(docs, key, text, blocks).groupBy("block")

    def ask_anchors(table: pa.Table) -> pa.Table:
        p = _Parse(table, key, text, window, anchor)
        low, high = (f.reduceat(p.phrase[p.order], p.begin) if len(p.begin) else p.phrase[:0] for f in (np.minimum, np.maximum))
        form = np.where(low == high, low, U64(0))
        least = _least(p.owner, p.place, p.order, p.begin)
        asked = _questions(table.column("block")[0].as_py(), buckets, p.anchors, form, *least)
        del p
        release()
        return asked

    def ask_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        p = _Parse(table, key, text, window, anchor)
        status = _joined(answers, 1, "status", "u1")[p.group]
        several = np.flatnonzero(status[p.phrase_of] == SEVERAL)
        hashes, owners, places, _ = _window_table(p, several)
        asked = _questions(table.column("block")[0].as_py(), buckets, hashes, None, owners, places)
        del p
        release()
        return asked

    schema = T.StructType([
        *docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        *[
            T.StructField(name, T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in fields])))
            for name, fields in (("factors", FACTOR), ("spans", FACTOR[:2]))
        ],
        T.StructField("kept_text", T.StringType()),
    ])
    columns = docs.columns

    def factor(table: pa.Table, answers: pa.Table) -> pa.Table:
        p = _Parse(table, key, text, window, anchor)
        factors = _parsed(p, answers)
        removed, spans, texts = _cleaned(p, factors, joined)
        words, listed = p.words.count, _factor_lists(p, factors)
        del p
        release()
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        return pa.table(
            [*[table.column(c) for c in columns], pa.array(words), pa.array(removed), listed, pa.array(spans, span), pa.array(texts, pa.string())],
            schema.names,
        )

    first = dealt.applyInArrow(ask_anchors, _QUESTION).groupBy("bucket").applyInArrow(_judge_anchors, _ANSWER)
    windows = dealt.cogroup(first.groupBy("block")).applyInArrow(ask_windows, _QUESTION)
    second = windows.groupBy("bucket").applyInArrow(_judge_windows, _ANSWER)
    return dealt.cogroup(first.union(second).groupBy("block")).applyInArrow(factor, schema).toDF(*given, *new)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars", **how: int) -> DataFrame:
    """``docs`` with the duplicate spans cut out of the texts; untouched texts stay as they are.
    The column ``length``, if any, follows the text."""
    plain, (key, text) = plainly_named(docs, key, text)
    found = remove_repeats(plain, key, text, joined=False, **how)
    cut = F.col("n_removed") > 0
    changed = {text: F.when(cut, F.col("kept_text")).otherwise(F.col(text)).alias(text)}
    if length in docs.columns:
        name = plain.columns[docs.columns.index(length)]
        characters = F.length("kept_text").cast(plain.schema[name].dataType)
        changed[name] = F.when(cut, characters).otherwise(F.col(name)).alias(name)
    return found.select(*[changed.get(c, F.col(c)) for c in plain.columns]).toDF(*docs.columns)
