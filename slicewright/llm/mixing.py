"""Mixing to target weights with soft domain membership.

A Bernoulli naive Bayes classifier over words, fitted on a table of labelled documents, gives
every document a posterior over domains.  Document i then stands for ``n_i * p_ik`` expected
tokens of domain k, and nonnegative rates r_i are fitted by projected gradient descent so that
the rated totals ``sum_i r_i n_i p_ik`` meet the targets in the least-squares sense.  Steps
run in the metric in which a token, not a document, has unit weight, and residuals are scaled by
the inverse of ``sum_i n_i p_i p_i'`` (domains x domains), for which 1 is a safe step.  Every
step is one aggregation over the documents; the driver holds vectors of one number per domain.

The classifier is fitted on at most about ``MAX_LABELLED`` labelled rows (picked by a hash of
the key) and has ``MAX_FEATURES`` words at most; these bounds hold at any size of the corpus.
All totals, posteriors and rates cover every document.

Defined results
  null or empty text: no tokens, the prior as posterior; a null key: rated like any other;
  repeated rows: each is returned; labels of unknown documents, or null labels: ignored;
  no usable label: one domain, "unknown", whose target is all, so all rates are 1; no
  documents: empty result; a domain without target has target 0; targets for domains that no
  labelled document has are left out, and the others' shares rescaled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.llm._store import plainly_named, written

MAX_LABELLED = 20_000
MAX_FEATURES = 200
#: Labelled documents that must have a word before it can become a feature.
LEAST_DOCS = 5
#: Twice the log-likelihood ratio that a feature needs, against equal rates in all domains.
LEAST_EVIDENCE = 20.0
#: How much more frequent a feature must be in one domain than in the others together.
LEAST_RATIO = 4.0
STEPS = 40
TOLERANCE = 1e-4
_RIDGE = 1e-9
#: White space, and the place where a word's punctuation begins.  Both are of few characters, so that
#: all others cost one look; the one before is only looked at where punctuation is.
_BETWEEN = (
    r"(?=[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E])"
    r"(?:[\x09-\x0D\x20]+|(?<![\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]))"
)


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


@dataclass(frozen=True)
class Classifier:
    """Domains, the log-score of a document without any feature, and each feature's words
    with what its presence adds per domain."""

    domains: list[str]
    base: list[float]
    features: DataFrame  # word, add (array of doubles)


def fit(docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED) -> Classifier:
    """``labelled`` has the key and a column ``domain``."""
    labelled = labelled.filter(F.col("domain").isNotNull() & F.col(key).isNotNull())
    total = labelled.count()
    share = max_labelled / max(total, max_labelled)
    picked = labelled.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20)))
    picked = picked.groupBy(F.col(key).alias("labelled_key")).agg(F.min("domain").alias("domain"))
    # some max_labelled rows of a key and a name, whatever the corpus: the join's small side
    known = docs.select(F.col(key).alias("labelled_key"), F.col(text).alias("text")).join(F.broadcast(picked), "labelled_key")
    words = written(
        known.select("domain", F.explode(F.array_distinct(F.concat(tokens(F.col("text")), F.array(F.lit(""))))).alias("word"))
        .groupBy("word", "domain").agg(F.count("*").alias("n")), "words",
    )
    counts = {r["domain"]: r["n"] for r in words.filter("word = ''").collect()}  # one row a domain
    domains = sorted(counts)
    if not domains:
        return Classifier(["unknown"], [0.0], docs.sparkSession.createDataFrame([], "word string, add array<double>"))
    sizes = F.array(*[F.lit(float(counts[d])) for d in domains])
    n = F.array(*[F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)).cast("double") for d in domains])
    every = float(sum(counts.values()))
    expected = lambda i: F.col("docs") * F.element_at(sizes, i + 1) / every
    evidence = 2 * F.aggregate(
        F.transform("n", lambda x, i: F.when(x > 0, x * F.log(x / expected(i))).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x
    )
    rate = F.transform("n", lambda x, i: (x + 0.5) / (F.element_at(sizes, i + 1) + 1.0))
    rest = F.transform(
        "n", lambda x, i: (F.col("docs") - x + 0.5) / (every - F.element_at(sizes, i + 1) + 1.0)
    )
    gain = F.array_max(F.zip_with("rate", "rest", lambda a, b: a * F.log(a / b)))
    chosen = (
        words.filter("word <> ''").groupBy("word").agg(n.alias("n"), F.sum("n").cast("double").alias("docs"))
        .filter(F.col("docs") >= LEAST_DOCS)
        .filter(evidence >= LEAST_EVIDENCE)
        .withColumn("rate", rate).withColumn("rest", rest)
        .filter(F.array_max(F.zip_with("rate", "rest", lambda a, b: a / b)) >= LEAST_RATIO)
        .orderBy(gain.desc(), "word").limit(MAX_FEATURES)
        .select("word", "rate")
    )
    rows = [(r["word"], r["rate"]) for r in chosen.collect()]  # MAX_FEATURES at most
    p = np.array([r for _, r in rows]).reshape(len(rows), len(domains))
    prior = np.log(np.array([counts[d] for d in domains]) / sum(counts.values()))
    base = prior + np.log1p(-p).sum(axis=0)
    add = np.log(p) - np.log1p(-p)
    features = docs.sparkSession.createDataFrame(
        [(w, a) for (w, _), a in zip(rows, add.tolist())], "word string, add array<double>"
    )
    return Classifier(domains, base.tolist(), features)


def posteriors(docs: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_hash, copies, n_tokens, p): one row per key and text."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), tokens(F.col(text)).alias("tokens"))
    rows = rows.withColumn("n_tokens", F.size("tokens"))
    # the features among the tokens, each once (MAX_FEATURES at most, whatever the corpus)
    names = [F.lit(r["word"]) for r in model.features.select("word").collect()]
    met = F.array_intersect("tokens", F.array(*names).cast("array<string>"))
    # a row for each, and one for a document without; each document's first also stands for it
    words = rows.select("key", "text_hash", "n_tokens", F.posexplode_outer(met).alias("pos", "word"))
    begins = F.coalesce(F.col("pos"), F.lit(0)) == 0
    present = words.join(F.broadcast(model.features), "word", "left").groupBy("key", "text_hash", "n_tokens", "word").agg(
        F.first("add").alias("add"), F.sum(begins.cast("long")).alias("copies")
    )
    sums = [
        (F.lit(b) + F.coalesce(F.sum(F.element_at("add", i + 1)), F.lit(0.0))).alias(f"s{i}") for i, b in enumerate(model.base)
    ]
    scored = present.groupBy("key", "text_hash", "n_tokens").agg(*sums, F.sum("copies").alias("copies"))
    names = [F.col(f"s{i}") for i in range(len(model.base))]
    top = F.greatest(*names) if len(names) > 1 else names[0]
    scored = scored.withColumn("e", F.array(*[F.exp(c - top) for c in names]))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return scored.withColumn("total", total).select(
        "key", "text_hash", "copies", F.col("n_tokens").cast("long").alias("n_tokens"),
        F.transform("e", lambda x: x / F.col("total")).alias("p"),
    )


def fit_rates(scored: DataFrame, totals: np.ndarray, max_rate: float | None = None, pinned: Column | None = None, steps: int = STEPS) -> tuple[Column, list[np.ndarray]]:
    """The rate as a column over ``scored``, and the residuals (as parts of the targets' sum)
    before each step.  Rates stay between 0 and ``max_rate``, and 1 where ``pinned`` holds."""
    k = len(totals)
    p = [F.element_at("p", i + 1) for i in range(k)]
    weight = (F.col("n_tokens") * F.col("copies")).cast("double")
    second = scored.agg(*[F.sum(weight * p[i] * p[j]) for i in range(k) for j in range(i, k)]).first()
    gram = np.zeros((k, k))
    at = iter(x or 0.0 for x in second)
    for i in range(k):
        for j in range(i, k):
            gram[i, j] = gram[j, i] = next(at)
    scale = np.linalg.pinv(gram + _RIDGE * max(np.trace(gram), 1.0) * np.eye(k))
    rate: Column = F.lit(1.0)
    residuals = []
    for _ in range(steps):
        sums = scored.agg(*[F.sum(weight * x * rate) for x in p]).first()
        residual = np.array([x or 0.0 for x in sums]) - totals
        residuals.append(residual / max(totals.sum(), 1.0))
        if len(residuals) > 1 and np.abs(residuals[-1] - residuals[-2]).max() < TOLERANCE or np.abs(residuals[-1]).max() < TOLERANCE:
            break
        step = scale @ residual
        moved = rate
        for x, d in zip(p, step.tolist()):
            moved = moved - x * d
        rate = F.greatest(moved, F.lit(0.0))
        if max_rate is not None:
            rate = F.least(rate, F.lit(float(max_rate)))
        if pinned is not None:
            rate = F.when(pinned, F.lit(1.0)).otherwise(rate)
    return rate, residuals


def rated(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], key: str = "doc_id", text: str = "text",
    max_rate: float | None = None, whole: str | None = None,
) -> tuple[DataFrame, Classifier]:
    """(key, text_hash, copies, n_tokens, p, rate) and the classifier.  ``targets`` are shares of
    the mix.  The mix has as many tokens as the corpus.  With ``whole``, the documents that belong
    to this domain (posterior of 1/2 at least) keep rate 1, and the mix has so many tokens that
    this domain's fit into it."""
    model = fit(docs, labelled, key, text)
    scored = written(posteriors(docs, model, key, text), "posteriors")
    weight = F.col("n_tokens") * F.col("copies")
    found = scored.agg(*[F.sum(weight * F.element_at("p", i + 1)) for i in range(len(model.domains))]).first()
    natural = np.array([x or 0.0 for x in found])
    share = np.array([targets.get(d, 0.0) for d in model.domains])
    share = share / share.sum() if share.sum() > 0 else natural / max(natural.sum(), 1.0)
    total, pinned = natural.sum(), None
    if whole in model.domains and share[at := model.domains.index(whole)] > 0:
        total, pinned = natural[at] / share[at], F.element_at("p", at + 1) >= 0.5
    rate, _ = fit_rates(scored, share * total, max_rate, pinned)
    return scored.withColumn("rate", rate), model


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` drawn by their rates: the whole part of a rate in copies, and one more with the
    fraction's probability, decided by a hash of key and text, so that it repeats."""
    plain, (own_key, text) = plainly_named(docs, key, text)
    named = labelled.select(F.col(key).alias(own_key), "domain")
    rates, _ = rated(plain, named, targets, own_key, text, **how)
    chance = F.pmod(F.xxhash64(F.lit("mix"), "key", "text_hash"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rates.select(
        F.col("key").alias("rated_key"), F.col("text_hash").alias("rated_hash"), F.floor(F.col("rate") + chance).cast("int").alias("times")
    ).filter("times > 0")
    same = F.col(own_key).eqNullSafe(F.col("rated_key")) & (F.xxhash64(text) == F.col("rated_hash"))
    joined = plain.join(drawn, same).withColumn("time", F.explode(F.sequence(F.lit(1), "times")))
    return joined.select(*plain.columns).toDF(*docs.columns)
