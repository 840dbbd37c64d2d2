"""Quality rules with thresholds that follow the corpus.

Each document gets a few measures.  Per language and source, every measure is summarised by
a mergeable quantile sketch: counts in logarithmic bins, so that a quantile has a relative
error of ``ACCURACY`` at most.  Bins add up, whatever the partitioning, and the sketch of a
language, or of the whole corpus, is the sum of its groups' sketches.  A group's sketch is
shrunk towards its language's, as if ``PRIOR`` more documents were spread as those of the
language are, and the language's likewise towards the corpus': a large group follows itself,
a small one its language, without a size at which the rule changes.  The sums are exact
(whole numbers), so they don't depend on the order of rows.

All limits are read off these sketches (see ``FENCES``); they are joined back by language and
source, and a document beyond one fails.  Shares that are zero in most documents are taken as
rates with one more occurrence, (n + 1) / (size + 1), so that a short clean document and a
long one differ and the sketch has a spread.

Defined results
  null or empty text: no words, which fails the fixed rule; null language or source: a group
  of its own; repeated rows: each counts and is returned; empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.llm._store import plainly_named
from slicewright.llm._text import blank, exact_ids, gram_ids, grams, ranges, release, slices, span_hash, unequal, utf8, words_of

ACCURACY = 0.01
#: Documents of its language that a group's sketch takes in besides its own.
PRIOR = 200
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


#: Percentages of the quantiles that fences are made of.
LOW, MIDDLE, HIGH, TAIL = 25, 50, 75, 99
#: How often the distance of quartiles is laid beyond them, as a power of their ratio.
REACH = 3


@dataclass(frozen=True)
class Fence:
    """The limits of a measure.

    ``both``: it fails above ``high * f`` or under ``low / f``, with f = (high / low) ** REACH.
    ``above``: only above that, or above ``median * (median / low) ** (2 * REACH + 1)`` if this
    is less: the same limit in a group whose upper half is spread as its lower one, and not
    moved by up to half of the group being bad.
    ``tail``: it fails above the TAIL quantile, for counts too small to have quartiles.

    ``least`` is the smallest factor, for groups in which all documents have one value.
    """

    measure: str
    kind: str
    least: float = 1.0


FENCES = (
    Fence("symbol_rate", "above", 4.0),
    Fence("repeat_rate", "above", 4.0),
    Fence("dup_line_share", "tail"),
    Fence("n_words", "both", 2.0),
    Fence("word_length", "both", 1.1),
    Fence("words_per_line", "both", 2.0),
)


def _neighbours(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal hashes of a row together, and which ones equal the one before."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    return order, (h[1:] == h[:-1]) & (r[1:] == r[:-1])


def _stats(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    rows = len(offsets) - 1
    words = words_of(data, offsets)
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~blank(data) & ((data & 0xC0) != 0x80), out=seen[1:])
    chars = seen[offsets[1:]] - seen[offsets[:-1]]
    marks = np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8))
    np.cumsum(marks, out=seen[1:])
    symbols = seen[offsets[1:]] - seen[offsets[:-1]]

    line_start, line_end = ranges(data != 10, offsets)
    some = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, line_start)
    line_start, line_end = line_start[some], line_end[some]
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    dup_lines = np.zeros(rows, np.int64)
    lines = np.bincount(line_row, minlength=rows)
    if len(line_start):
        line = span_hash(data, line_start, line_end)
        order, same = _neighbours(line, line_row)
        a, b = order[1:][same], order[:-1][same]
        if unequal(data, line_start[a], line_end[a], line_start[b], line_end[b]).any():
            order, same = _neighbours(exact_ids(data, line_start, line_end, line), line_row)
        dup_lines = np.bincount(line_row[order][1:][same], minlength=rows)

    repeat = np.zeros(rows, np.int64)
    at, gram = grams(words, 3)
    if len(at):
        order, same = _neighbours(gram, words.row[at])
        a, b = ((at[x[same]][:, None] + np.arange(3)).ravel() for x in (order[1:], order[:-1]))
        if unequal(data, words.start[a], words.end[a], words.start[b], words.end[b]).any():
            order, same = _neighbours(gram_ids(exact_ids(data, words.start, words.end, words.hash), at, 3), words.row[at])
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        covered = np.zeros(len(words.hash), bool)
        for shift in range(3):
            covered[at[order[twice]] + shift] = True
        repeat = np.bincount(words.row[covered], minlength=rows)
    return [words.count, chars, symbols, dup_lines, repeat, lines]


def count_stats(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of each row, and COUNTS over its whole text."""
    kept = docs.select(*keep, *([] if text in keep else [text]))
    fields = [kept.schema[c] for c in keep]
    schema = T.StructType([*fields, *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            parts = [
                _stats(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for a, b in slices(offsets)
            ]
            counts = [np.concatenate([p[i] for p in parts] or [np.empty(0, np.int64)]) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(c.astype(np.int64)) for c in counts], [*keep, *COUNTS]
            )
        release()

    return kept.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _measures() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbol_rate": (F.col("n_symbols") + 1) / (F.col("word_chars") + 1),
        "repeat_rate": (F.col("n_repeat_words") + 1) / (F.col("n_words") + 1),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "words_per_line": F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1)),
    }


_GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
#: Bin of zero and of what is too small to matter.
_ZERO_BIN = -10_000


def _bin(value: Column) -> Column:
    log = F.ceil(F.log(value) / F.log(F.lit(_GAMMA)))
    return F.when(value > 1e-9, log.cast("int")).otherwise(F.lit(_ZERO_BIN))


def _bin_value(index: Column) -> Column:
    middle = 2 * F.pow(F.lit(_GAMMA), index) / (_GAMMA + 1)
    return F.when(index > _ZERO_BIN, middle).otherwise(F.lit(0.0))


#: Whole numbers of sketches: products of three counts of documents.
_WHOLE = T.DecimalType(38, 0)


def sketches(stats: DataFrame, groups: list[str]) -> DataFrame:
    """Bins and counts of each measure in each group: (groups.., measure, bin, n).  Documents
    that the fixed rule rejects aren't part of the corpus that thresholds follow."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), _bin(c).alias("bin")) for m, c in _measures().items()])
    return (
        stats.filter(~base_failed())
        .select(*groups, F.explode(pairs).alias("m"))
        .groupBy(*groups, F.col("m.measure").alias("measure"), F.col("m.bin").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """The sum of sketches over the columns that ``groups`` leaves out."""
    return sketch.groupBy(*groups, "measure", "bin").agg(F.sum("n").alias("n"))


def gathered(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups.., measure, bins, total): a group has a bounded number of bins (about 1,100 at
    most), which is what one row gathers."""
    counts = sketch.withColumn("n", F.col("n").cast(_WHOLE))
    return counts.groupBy(*groups, "measure").agg(
        F.collect_list(F.struct("bin", "n")).alias("bins"), F.sum("n").cast(_WHOLE).alias("total")
    )


def shrunk(own: Column, total: Column, prior: Column, prior_total: Column) -> tuple[Column, Column]:
    """Bins and total of a sketch together with PRIOR documents spread as in another, all
    multiplied by the other's total."""
    times = lambda bins, factor: F.transform(
        bins, lambda b: F.struct(b["bin"].alias("bin"), (b["n"] * factor).cast(_WHOLE).alias("n"))
    )
    weight = F.lit(PRIOR).cast(_WHOLE)
    return F.concat(times(own, prior_total), times(prior, weight)), ((total + weight) * prior_total).cast(_WHOLE)


def quantile(bins: Column, total: Column, percent: int) -> Column:
    """The least bin up to which so many percent of sorted ``bins`` lie."""
    start = F.struct(F.lit(0).cast(_WHOLE).alias("seen"), F.lit(_ZERO_BIN).alias("bin"))
    walked = F.aggregate(
        bins, start,
        lambda acc, b: F.when(acc["seen"] * 100 >= total * percent, acc).otherwise(
            F.struct((acc["seen"] + b["n"]).cast(_WHOLE).alias("seen"), b["bin"].alias("bin"))
        ),
    )
    return walked["bin"]


def group_quantiles(stats: DataFrame, lang: str, source: str) -> DataFrame:
    """(t_lang, t_source, measure, low, median, high, tail): quantiles of each group's shrunk sketch;
    tail is the bin itself."""
    fine = sketches(stats, [lang, source])
    by_lang = merged(fine, [lang])
    a = gathered(fine, [lang, source]).alias("a")
    b = gathered(by_lang, [lang]).alias("b")
    c = gathered(merged(by_lang, []), []).alias("c")
    of_lang = b.join(c, F.col("b.measure") == F.col("c.measure")).select(
        F.col(f"b.{lang}").alias("l_lang"), F.col("b.measure").alias("l_measure"),
        *[x.alias(n) for x, n in zip(shrunk(*[F.col(n) for n in ("b.bins", "b.total", "c.bins", "c.total")]), ("l_bins", "l_total"))],
    )
    bins, total = shrunk(F.col("a.bins"), F.col("a.total"), F.col("l_bins"), F.col("l_total"))
    whole = a.join(of_lang, F.col(f"a.{lang}").eqNullSafe(F.col("l_lang")) & (F.col("a.measure") == F.col("l_measure"))).select(
        F.col(f"a.{lang}").alias("t_lang"), F.col(f"a.{source}").alias("t_source"), F.col("a.measure").alias("measure"),
        F.array_sort(bins).alias("bins"), total.alias("total"),
    )
    at = lambda percent: quantile(F.col("bins"), F.col("total"), percent)
    return whole.select(
        "t_lang", "t_source", "measure", _bin_value(at(LOW)).alias("low"), _bin_value(at(MIDDLE)).alias("median"),
        _bin_value(at(HIGH)).alias("high"), at(TAIL).alias("tail"),
    )


def _limit(fence: Fence) -> tuple[Column, Column]:
    """The lower (or null) and upper limit of a measure."""
    none = F.lit(None).cast("double")
    if fence.kind == "tail":
        return none, F.when(F.col("tail") > _ZERO_BIN, F.pow(F.lit(_GAMMA), F.col("tail"))).otherwise(0.0)
    beyond = lambda ratio, reach: F.greatest(F.pow(ratio, F.lit(float(reach))), F.lit(fence.least))
    factor = beyond(F.try_divide("high", "low"), REACH)
    if fence.kind == "both":
        return F.col("low") / factor, F.col("high") * factor
    return none, F.least(F.col("high") * factor, F.col("median") * beyond(F.try_divide("median", "low"), 2 * REACH + 1))


def _limits() -> list[tuple[str, str]]:
    return [(side, f.measure) for f in FENCES for side in (("min", "max") if f.kind == "both" else ("max",))]


def thresholds(stats: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per language and source: the limits of each measure."""
    limits = {(side, f.measure): limit for f in FENCES for side, limit in zip(("min", "max"), _limit(f))}
    return group_quantiles(stats, lang, source).groupBy("t_lang", "t_source").agg(*[
        F.max(F.when(F.col("measure") == m, limits[side, m])).alias(f"{side}_{m}") for side, m in _limits()
    ])


def judged(stats: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``stats`` with base_failed and kept."""
    joined = stats.join(
        limits, stats[lang].eqNullSafe(limits["t_lang"]) & stats[source].eqNullSafe(limits["t_source"]), "left"
    )
    measures = _measures()
    past = lambda side, m: measures[m] > F.col(f"max_{m}") if side == "max" else measures[m] < F.col(f"min_{m}")
    fails = [F.coalesce(past(side, m), F.lit(False)) for side, m in _limits()]
    beyond = fails[0]
    for one in fails[1:]:
        beyond = beyond | one
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~beyond)
        .drop("t_lang", "t_source", *[f"{side}_{m}" for side, m in _limits()])
    )


def passing(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are.  The measures are computed
    twice, for the sketches and beside the rows, so that no text is shuffled."""
    plain, (text, lang, source) = plainly_named(docs, text, lang, source)
    limits = thresholds(count_stats(plain, [lang, source], text), lang, source)
    found = judged(count_stats(plain, plain.columns, text), limits, lang, source)
    return found.filter("kept").select(*plain.columns).toDF(*docs.columns)
