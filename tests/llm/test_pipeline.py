"""The pipeline's stages, each on its own input, against brute force; and odd tables."""

import math
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from slicewright.llm import mixing, quality
from slicewright.llm.oracle import ORACLE
from slicewright.llm.queries import QUERIES, labelled_domains
from tests.llm.test_text_operators import brute_components, brute_counts, brute_fingerprint, brute_removal, library

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output rows."""
    folder, found = str(tmp_path_factory.mktemp("stages")), {}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select(*COLUMNS).collect()]
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found[name] = (before, [tuple(r) for r in docs.collect()], docs.columns)
    return found


def test_stages_and_columns(stages):
    assert list(stages) == ["quality_rules", "simhash_near_dedup", "substring_dedup", "mix_to_targets", "byte_bpe"]
    assert all(stages[n][2] == COLUMNS for n in list(stages)[:-1])


GAMMA = (1 + quality.ACCURACY) / (1 - quality.ACCURACY)


def brute_limits(group, lang, whole):
    """Lower and upper limit of every measure, from Counters of bins by measure."""
    out = {}
    for fence in quality.FENCES:
        sizes = [sum(s[fence.measure].values()) for s in (group, lang, whole)]
        scale = (sizes[1] + quality.PRIOR) * sizes[2]
        bins = Counter()
        for sketch, times in ((group, scale), (lang, quality.PRIOR * sizes[2]), (whole, quality.PRIOR**2)):
            for b, n in sketch[fence.measure].items():
                bins[b] += n * times

        def at(percent):
            seen = 0
            for b in sorted(bins):
                seen += bins[b]
                if seen * 100 >= percent * sum(bins.values()):
                    return b

        value = lambda b: 2 * GAMMA**b / (GAMMA + 1)
        if fence.kind == "tail":
            out[fence.measure] = -1, GAMMA ** at(99) if at(99) > -10_000 else 0
            continue
        low, median, high = (value(at(q)) for q in (25, 50, 75))
        factor = max((high / low) ** 3, fence.least)
        if fence.kind == "both":
            out[fence.measure] = low / factor, high * factor
        else:
            out[fence.measure] = -1, min(high * factor, median * max((median / low) ** 7, fence.least))
    return out


def brute_kept(rows):
    measured = []
    for i, t, lang, source, *_ in rows:
        words, chars, symbols, dup, repeat, lines = brute_counts(t)
        failed = words < quality.MIN_WORDS or 100 * repeat > quality.MAX_REPEAT_PERCENT * words
        measured.append(((lang, source), failed, {
            "symbol_rate": (symbols + 1) / (chars + 1), "repeat_rate": (repeat + 1) / (words + 1), "dup_line_share": dup / max(lines, 1),
            "n_words": words, "word_length": chars / max(words, 1), "words_per_line": words / max(lines, 1),
        }))
    sketches = defaultdict(lambda: defaultdict(Counter))
    for group, failed, m in measured:
        for name, v in m.items() if not failed else ():
            for g in (group, group[:1], ()):
                sketches[g][name][math.ceil(math.log(v) / math.log(GAMMA)) if v > 1e-9 else -10_000] += 1
    limits = {g: brute_limits(*(sketches[x] for x in (g, g[:1], ()))) for g, failed, _ in measured if not failed}
    return [not failed and all(low <= m[name] <= high for name, (low, high) in limits[g].items()) for g, failed, m in measured]


def test_quality_stage(stages):
    before, after, _ = stages["quality_rules"]
    assert Counter(after) == Counter(r for r, k in zip(before, brute_kept(before)) if k)


def test_every_kind_of_fence_rejects(spark):
    """One document a fence is planted among the given ones; each limit is read off the sketches."""
    usual = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).collect()]
    texts = {
        -1: "word & thing | " * 100, -2: "\n".join(["the very same line of words here"] * 9 + [f"w{i} v{i} u{i}" for i in range(40)]),
        -3: " ".join(f"{i}incomprehensibilities" for i in range(80)), -4: " ".join(f"w{i}" for i in range(150_000)),
        -5: "\n".join(f"w{i}" for i in range(90)), -6: " ".join(f"w{i} a" for i in range(90)),
    }
    rows = usual + [(i, t, "en", "planted", len(t)) for i, t in texts.items()]
    kept = quality.passing(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert Counter(map(tuple, kept)) == Counter(r for r, k in zip(rows, brute_kept(rows)) if k)
    assert not {r["doc_id"] for r in kept} & set(texts)


def test_limits_follow_the_source_in_every_language(spark):
    """No group takes over its language's limits as they are."""
    docs = spark.read.parquet(SF.replace("0.001", "0.1") + "/documents.parquet")
    limits = quality.thresholds(quality.count_stats(docs, ["lang", "source"])).collect()
    by_lang = defaultdict(list)
    for r in limits:
        by_lang[r["t_lang"]].append(r["max_symbol_rate"])
    assert all(len(set(found)) > len(found) / 2 > 1 for found in by_lang.values())


def test_near_dedup_stage(stages):
    before, after, _ = stages["simhash_near_dedup"]
    groups = brute_components([(r[0], brute_fingerprint(r[1])) for r in before])
    assert sorted(after) == sorted(r for r, (i, _, least) in zip(before, groups) if i == least)


def test_substring_stage(stages):
    before, after, _ = stages["substring_dedup"]
    kept = {i: (removed, text) for i, _, removed, text in brute_removal(before)}
    texts = {r[0]: r[1] for r in before}
    assert len(after) == len(before)
    for i, text, _, _, n in after:
        removed, words = kept[i]
        assert re.findall(r"[^\x20\x09-\x0D]+", text) == words.split(" ") if words else not text.strip()
        assert n == len(text) and (removed or text == texts[i])


# --- mixing --------------------------------------------------------------------------------

PUNCTUATION = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


def brute_tokens(text):
    found = []
    for word in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()):
        at = 0
        for i in range(1, len(word)):
            inside = word[i - 1].isalnum() and ord(word[i - 1]) < 128 or ord(word[i - 1]) > 127
            if inside and word[i] in PUNCTUATION:
                found.append(word[at:i])
                at = i
        found.append(word[at:])
    return found


def test_tokens_of_odd_texts(spark):
    rng = random.Random(6)
    odd = "aZ09 \t\n\x0b\x0c\r,.!@[`{~/:\x00\x1c\x1f\x7f\x80\x85\xa0éßK日\u3000😀\U00010400"
    texts = [None, "", " ", "!", "a", *("".join(rng.choice(odd) for _ in range(rng.randint(1, 14))) for _ in range(4_000))]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").select("id", mixing.tokens(F.col("text")).alias("tokens"))
    assert {r["id"]: r["tokens"] for r in rows.collect()} == {i: brute_tokens(t) for i, t in enumerate(texts)}


def test_only_features_become_rows(spark):
    features = spark.createDataFrame([("ab", [1.0, 0.0]), (",c", [0.0, 2.0])], "word string, add array<double>")
    model = mixing.Classifier(["x", "y"], [0.0, 0.5], features)
    docs = [(1, "AB ab d,c ab"), (1, "AB ab d,c ab"), (2, "d " * 500), (3, None), (3, ""), (None, "e ,c"), (4, "c, ab")]
    scored = mixing.posteriors(spark.createDataFrame(docs, "doc_id long, text string"), model)
    share = lambda x, y: pytest.approx([math.exp(x) / (math.exp(x) + math.exp(y)), math.exp(y) / (math.exp(x) + math.exp(y))])
    found = sorted(((r["key"] or 0, r["copies"], r["n_tokens"], r["p"]) for r in scored.collect()), key=lambda r: r[:3])
    assert found == [
        (0, 1, 2, share(0, 2.5)), (1, 2, 5, share(1, 2.5)), (2, 1, 500, share(0, 0.5)),
        (3, 1, 0, share(0, 0.5)), (3, 1, 0, share(0, 0.5)), (4, 1, 3, share(1, 0.5)),
    ]
    assert "posexplode(array_intersect(" in scored._jdf.queryExecution().executedPlan().toString()


def brute_rates(rows, labels, targets, whole=None, max_rate=None):
    """Naive Bayes and projected gradient descent from their definitions."""
    known = [(set(brute_tokens(t)), labels[i]) for i, t in rows if labels.get(i)]
    domains = sorted({d for _, d in known})
    size = Counter(d for _, d in known)
    have = defaultdict(Counter)
    for words, d in known:
        for w in words:
            have[w][d] += 1
    chosen = []
    for w, n in have.items():
        docs = sum(n.values())
        evidence = 2 * sum(n[d] * math.log(n[d] / (docs * size[d] / len(known))) for d in n)
        rate = [(n[d] + 0.5) / (size[d] + 1) for d in domains]
        rest = [(docs - n[d] + 0.5) / (len(known) - size[d] + 1) for d in domains]
        if docs >= mixing.LEAST_DOCS and evidence >= mixing.LEAST_EVIDENCE and max(a / b for a, b in zip(rate, rest)) >= mixing.LEAST_RATIO:
            chosen.append((-max(a * math.log(a / b) for a, b in zip(rate, rest)), w, rate))
    model = {w: np.array(r) for _, w, r in sorted(chosen)[: mixing.MAX_FEATURES]}
    base = np.log([size[d] / len(known) for d in domains]) + sum(np.log1p(-r) for r in model.values())
    p, n = [], []
    for _, t in rows:
        words = brute_tokens(t)
        s = base + sum(np.log(model[w]) - np.log1p(-model[w]) for w in set(words) if w in model)
        e = np.exp(s - s.max())
        p.append(e / e.sum())
        n.append(len(words))
    p, n = np.array(p), np.array(n, float)
    share = np.array([targets.get(d, 0.0) for d in domains])
    share, total, pinned = share / share.sum(), (p * n[:, None]).sum(), np.zeros(len(n), bool)
    if whole:
        at = domains.index(whole)
        total, pinned = (p[:, at] * n).sum() / share[at], p[:, at] >= 0.5
    gram = (p * n[:, None]).T @ p
    scale = np.linalg.pinv(gram + 1e-9 * np.trace(gram) * np.eye(len(domains)))
    r = np.ones(len(n))
    for _ in range(300):
        residual = (p * (n * r)[:, None]).sum(axis=0) - share * total
        r = np.maximum(r - p @ (scale @ residual), 0)
        r = np.where(pinned, 1.0, np.minimum(r, max_rate) if max_rate else r)
    return domains, p, r


@pytest.mark.parametrize("whole", [None, "good"])
def test_posteriors_and_rates_are_those_of_brute_force(spark, whole):
    docs, labelled = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), labelled_domains(spark, "/root/testdata/sf0.01")
    how = {"whole": whole, "max_rate": 1.0 if whole else None}
    rates, model = mixing.rated(docs, labelled, {"good": 0.6, "poor": 0.3, "toxic": 0.1}, **how)
    found = {r["key"]: r for r in rates.collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    labels = {r["doc_id"]: r["domain"] for r in labelled.collect()}
    domains, p, r = brute_rates(rows, labels, {"good": 0.6, "poor": 0.3, "toxic": 0.1}, **how)
    assert model.domains == domains
    for (i, _), mine, rate in zip(rows, p, r):
        assert found[i]["p"] == pytest.approx(list(mine), abs=1e-6)
        assert found[i]["rate"] == pytest.approx(rate, abs=0.02)


def test_mixing_stage_draws_by_the_rates(spark, stages):
    before, after, _ = stages["mix_to_targets"]
    docs = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    rates, _ = mixing.rated(docs, labelled_domains(spark, SF), corpus_pipeline.TARGETS, max_rate=corpus_pipeline.MAX_RATE, whole=corpus_pipeline.WHOLE)
    chance = F.pmod(F.xxhash64(F.lit("mix"), "key", "text_hash"), F.lit(1 << 30)) / float(1 << 30)
    drawn = {r["key"] for r in rates.withColumn("u", chance).collect() if math.floor(r["rate"] + r["u"]) > 0}
    assert sorted(after) == sorted(r for r in before if r[0] in drawn)
    pinned = {r["key"] for r in rates.collect() if r["rate"] == 1.0}
    assert pinned <= {r[0] for r in after}


def test_bpe_stage(stages):
    before, after, columns = stages["byte_bpe"]
    assert columns == ["doc_id", "n_tokens", "ids", "decoded"]
    encoding = library()
    expected = Counter()
    for i, text, *_ in before:
        ids = np.array(encoding.encode_ordinary(text), "<u4")
        expected[(i, len(ids), ids.tobytes(), text)] += 1
    assert Counter((i, n, bytes(ids), text) for i, n, ids, text in after) == expected


def test_run_gives_what_the_stages_give(spark, stages):
    found = Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in corpus_pipeline.run(spark, SF).collect())
    assert found == Counter((i, n, bytes(ids)) for i, n, ids, _ in stages["byte_bpe"][1])


def test_stages_take_odd_tables(spark, awkward, empty):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == awkward.columns, name
        after.count()
        assert stage(spark, empty, SF).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, awkward, SF).count() == awkward.count()
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).collect() == []


# --- registered queries --------------------------------------------------------------------


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)} and set(QUERIES) | {"pipeline"} <= names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    expected = con.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(expected.fetchall())


def test_the_repository_carries_no_vocabulary():
    root = os.path.dirname(corpus_pipeline.__file__)
    assert not [f for _, _, files in os.walk(root) for f in files if f.endswith((".tiktoken", ".model"))]
