"""Nearest neighbours, URL filter, preference pairs, mixing and context trees."""

import math
import time
import zlib
from collections import Counter
from functools import lru_cache

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from slicewright.llm import ann, ctw, mixing, preference, url_filter
from slicewright.llm.oracle import ORACLE
from slicewright.llm.queries import URL_RULES

# --- nearest neighbours --------------------------------------------------------------------


def vectors(spark, x, ids=None):
    rows = [(int(i), [float(a) for a in v], 0) for i, v in zip(ids if ids is not None else range(len(x)), x)]
    odd = [(900_001, None, 0), (900_002, [0.0] * x.shape[1], 0), (900_003, [float("nan")] * x.shape[1], 0),
           (900_004, [float("inf")] + [0.0] * (x.shape[1] - 1), 0), (900_005, [None] * x.shape[1], 0), (900_006, [1.0], 0), (None, [1.0] * x.shape[1], 0)]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, part int").withColumn("list", F.lit(1))


def brute_nearest(x, ids, queries, n=20):
    x = np.float32(x).astype(float)
    found = {}
    for i in queries:
        score = x @ x[i]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:n]
        found[int(ids[i])] = [(int(ids[j]), score[j]) for j in order]
    return found


def got(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_against_brute_force(spark, lengths):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths:
        x *= rng.uniform(0.2, 3.0, (1500, 1))
    found = got(ann.search(vectors(spark, x), F.col("id") % 20 == 0))
    expected = brute_nearest(x, np.arange(1500), range(0, 1500, 20))
    assert found.keys() == expected.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    scores = np.float32(x).astype(float)
    assert all(abs(s - scores[q] @ scores[i]) < 1e-12 for q in found for i, s in found[q])


def test_copies_tie_to_the_smaller_id_and_long_lists_are_cut(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 64)
    monkeypatch.setattr(ann, "PART_QUERIES", 16)
    rng = np.random.default_rng(1)
    x = np.concatenate([np.repeat(rng.standard_normal((1, 8)), 400, axis=0), rng.standard_normal((200, 8))])
    ids = rng.permutation(600)
    found = got(ann.search(vectors(spark, x, ids), F.col("id") % 20 == 0, lists=6, probed=6))
    expected = brute_nearest(x, ids, np.flatnonzero(ids % 20 == 0))
    copies = {int(i) for i in ids[:400]}
    for q in copies & set(expected):
        assert [i for i, _ in found[q]] == [i for i, _ in expected[q]]


def test_repeated_rows_are_listed_once(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((60, 6))
    table = vectors(spark, x)
    once, twice = got(ann.search(table, F.col("id") % 20 == 0)), got(ann.search(table.union(table), F.col("id") % 20 == 0))
    for q, found in twice.items():
        ids = [i for i, _ in found]
        assert len(ids) == len(set(ids)) == len(once[q]) == 20 and q not in ids


def test_queries_beside_many_copies_get_all_twenty(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((150, 16))
    small = np.repeat(centres, 12, axis=0) + 0.01 * rng.standard_normal((1800, 16))
    x = np.concatenate([np.repeat(rng.standard_normal((1, 16)), 900, axis=0), small])
    found = got(ann.search(vectors(spark, x), F.col("id") % 20 == 0))
    assert set(found) == set(range(0, 2700, 20)) and all(len(hits) == 20 for hits in found.values())


def test_narrow_probes_are_widened_to_all_candidates(spark):
    rng = np.random.default_rng(10)
    x = rng.standard_normal((60, 6))
    found = got(ann.search(vectors(spark, x), F.col("id") >= 0, lists=30, probed=1))
    assert set(found) == set(range(60)) and all(len(hits) == 20 for hits in found.values())
    few = got(ann.search(vectors(spark, x[:12]), F.col("id") >= 0, lists=6, probed=1))
    assert all(len(hits) == 11 for hits in few.values()) and len(few) == 12


def test_few_rows_give_all_and_none_give_none(spark):
    x = np.eye(4)[:3]
    assert {q: [i for i, _ in v] for q, v in got(ann.search(vectors(spark, x), F.col("id") >= 0)).items()} == {0: [1, 2], 1: [0, 2], 2: [0, 1]}
    assert ann.search(vectors(spark, x).limit(0), F.col("id") >= 0).collect() == []


def test_tests_abandon_most_rows_and_keep_the_nearest():
    rng = np.random.default_rng(2)
    rows, queries = rng.standard_normal((2000, 64)), rng.standard_normal((20, 64))
    rows[:400] += np.repeat(queries, 20, axis=0)
    left = ann.adaptive_scan(queries, rows, 20)
    far = ((queries[:, None, :] - rows[None]) ** 2).sum(axis=2)
    nearest = np.argsort(far, axis=1)[:, :20]
    assert np.take_along_axis(left, nearest, axis=1).mean() > 0.97 and left.mean() < 0.5


# --- URL filter ----------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "http://org", "http://org/", "HTTP://A.Example.ORG/es/x", "http://example.org/en/1", "http://x.example.org/en/123?q#f",
    "https://user@example.org:80/es/", "http://notexample.org/es/", "http://a.com/fr/b", "http://com/de/", "http://b.com/de", "ftp://a.b.c.com/de/?x",
    "http://.org/", "http://É.ORG/fr", "http://a.com?x/fr/", "http://a.com#/fr/", "http://a://b.org/", "x://example.org/es/" + "é" * 3000, "http://a.com/FR/",
]


def test_verdicts_are_those_of_sql(spark):
    pages = [(i % 20 if i != 5 else None, u, "html") for i, u in enumerate(URLS + URLS[5:8])]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("rule", F.lit(1))
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    found = url_filter.judge_urls(frame, rules)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    assert Counter(map(tuple, found.collect())) == Counter(con.execute(ORACLE["op7_url_filter"]).fetchall())
    assert url_filter.judge_urls(frame.limit(0), rules).collect() == []
    assert {r["verdict"] for r in url_filter.judge_urls(frame, rules.limit(0)).collect()} == {"allow"}


def test_a_host_with_very_many_labels(spark):
    hosts = [".".join(["a"] * 16_000), ".".join(["a"] * 16_000) + ".example.org", "example.org.", "", "."]
    pages = spark.createDataFrame([(i, f"http://{h}/en/1/x") for i, h in enumerate(hosts)], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    began = time.time()
    found = {r["page_id"]: r["rule"] for r in url_filter.judge_urls(pages, rules).collect()}
    assert found == {0: None, 1: "example.org/en/1", 2: None, 3: None, 4: None} and time.time() - began < 15


def test_the_longest_rule_wins_and_block_breaks_ties(spark):
    rules = spark.createDataFrame(
        [("b.org", "/", "allow"), ("b.org", "/x", "block"), ("b.org", "/x", "allow"), ("a.b.org", "/", "allow"), (None, None, "block")],
        "host string, path string, verdict string",
    )
    pages = spark.createDataFrame([(1, "http://c.b.org/xy"), (2, "http://a.b.org/z"), (3, "http://b.org/q")], "page_id long, url string")
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules).collect()} == {
        1: ("b.org/x", "block"), 2: ("a.b.org/", "allow"), 3: ("b.org/", "allow"),
    }


# --- preference pairs ----------------------------------------------------------------------


def test_prompt_is_the_common_prefix_and_masks_fit(spark):
    turns = [
        (0, 0, "system", "be kind"), (0, 1, "user", "hi"), (0, 2, "assistant", "hello"), (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "go away"),
        (1, 3, "user", "why"), (2, 0, "user", "a"), (3, 0, "user", "a"), (4, 0, None, None), (4, 0, None, None), (5, None, "user", "x"), (6, 0, "user", "alone"),
        (8, 0, "user", "q"), (9, 0, "user", "q"), (9, 1, "assistant", "é" * 5000), (None, 0, "user", "lost"), (-2, 0, "user", "m"), (-1, 0, "assistant", "m"),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("c", F.lit(2))
    found = {r["pair_id"]: r for r in preference.format_pairs(table, preference.neighbours(table)).collect()}
    assert sorted(found) == [-1, 0, 1, 2, 4]
    a = found[0]
    assert a["prefix_turns"] == 2 and a["prompt"] == "<|system|>\nbe kind<|end|>\n<|user|>\nhi<|end|>\n"
    assert a["chosen"] == "<|assistant|>\nhello<|end|>\n" and a["chosen_mask"] == "0*14,1*13"
    assert a["rejected"].endswith("<|user|>\nwhy<|end|>\n")
    assert found[1]["chosen"] == found[1]["rejected"] == found[1]["chosen_mask"] == "" and found[1]["prefix_turns"] == 1
    assert found[2]["prefix_turns"] == 0 and found[4]["prefix_turns"] == 1 and found[4]["chosen"] == "" and found[-1]["prefix_turns"] == 0
    for r in found.values():
        for side in ("chosen", "rejected"):
            runs = [tuple(map(int, x.split("*"))) for x in r[f"{side}_mask"].split(",") if x]
            assert sum(n for _, n in runs) == len(r[side])
            text, at = "", 0
            for trained, n in runs:
                text += r[side][at : at + n] if trained else ""
                at += n
            assert text == "".join(p.split("|>\n", 1)[1] + "<|end|>\n" for p in r[side].split("<|end|>\n") if p.startswith("<|assistant|>"))
    assert preference.format_pairs(table.limit(0), preference.neighbours(table)).collect() == []


def test_every_conversation_is_paired_with_another_reply(spark):
    turns = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 2, "user", "bye"), (1, 0, "user", "why"), (1, 1, "assistant", "so"), (1, 2, "assistant", "no"),
        (2, 0, "user", "a"), (3, None, None, None), (3, 1, "assistant", "c"), (4, 0, "user", "x"), (4, 1, "assistant", "y"),
        (6, 0, "assistant", "same"), (7, 0, "assistant", "same"), (-1, 0, "user", "m"), (-1, 1, "assistant", "é"), (-2, 0, "assistant", "é" * 4000),
        (2**60 + 1, 0, "user", "u"), (2**60 + 1, 1, "assistant", "v"), (None, 0, "user", "lost"),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("turns", "c", "reply", "place", "donor")})
    found = {r["pair_id"]: r for r in preference.swapped_replies(table).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", turns)
    told = con.sql(ORACLE["op3_preference_format"])
    assert Counter(told.fetchall()) == Counter(tuple(r[c] for c in told.columns) for r in found.values())
    assert set(found) == {t[0] for t in turns if t[0] is not None}
    a = found[0]
    assert (a["prefix_turns"], a["rejected_id"], a["prompt"]) == (1, 1, "<|user|>\nhi<|end|>\n")
    assert a["chosen"] == "<|assistant|>\nhello<|end|>\n<|user|>\nbye<|end|>\n" and a["rejected"] == "<|assistant|>\nno<|end|>\n<|user|>\nbye<|end|>\n"
    assert found[2]["prefix_turns"] == 1 and found[2]["chosen"] == "" and found[2]["rejected"] == "<|assistant|>\nc<|end|>\n"
    assert found[4]["rejected_id"] is None and found[4]["rejected"] == "<|assistant|>\n<|end|>\n" and found[4]["chosen_mask"] == "0*14,1*9"
    assert found[6]["prefix_turns"] == 1 and found[6]["chosen"] == found[6]["rejected"] == ""
    assert preference.swapped_replies(table.limit(0)).collect() == []


# --- mixing --------------------------------------------------------------------------------


def labelled_corpus(spark, n=400):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(n):
        domain = ["good", "poor", "toxic"][0 if i % 10 < 7 else 1 if i % 10 < 9 else 2]
        words = [f"w{x}" for x in rng.integers(0, 500, rng.integers(20, 80))]
        marks = {"good": [], "poor": ["###", "spam!!!"], "toxic": ["vile", "nasty"]}[domain]
        rows.append((i, " ".join(list(rng.permutation(words + marks * 3)))))
        labels.append((i, domain if i % 2 else None))
    rows += [(1000, None), (1001, ""), (None, "w1 w2 vile nasty"), (5, rows[5][1]), (1002, "word " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("times", F.lit(1)).withColumn("p", F.lit("x"))
    return docs, spark.createDataFrame(labels, "doc_id long, domain string"), rows


def test_rated_totals_meet_the_targets(spark):
    docs, labels, rows = labelled_corpus(spark)
    targets = {"good": 0.5, "poor": 0.2, "toxic": 0.3}
    rates, model = mixing.rated(docs, labels, targets)
    found = rates.collect()
    assert model.domains == ["good", "poor", "toxic"] and sum(r["copies"] for r in found) == len(rows)
    totals = sum(r["copies"] * r["n_tokens"] * r["rate"] * np.array(r["p"]) for r in found)
    assert totals / totals.sum() == pytest.approx([0.5, 0.2, 0.3], abs=1e-3)
    assert all(r["rate"] >= 0 and sum(r["p"]) == pytest.approx(1) for r in found)
    right = [np.argmax(r["p"]) == (0 if r["key"] % 10 < 7 else 1 if r["key"] % 10 < 9 else 2) for r in found if r["key"] is not None and r["key"] < 400 and r["key"] % 2 == 0]
    assert np.mean(right) > 0.95  # held-out accuracy: even ids have no label


def test_mixing_keeps_the_whole_domain_and_drops_the_unwanted(spark):
    docs, labels, rows = labelled_corpus(spark)
    mixed = mixing.mixed(docs, labels, {"good": 0.95, "poor": 0.05, "toxic": 0.0}, max_rate=1.0, whole="good")
    assert mixed.columns == docs.columns
    ids = Counter(r["doc_id"] for r in mixed.collect())
    assert all(ids[i] >= 1 for i in range(400) if i % 10 < 7) and ids[5] == 2
    assert sum(ids[i] for i in range(400) if i % 10 == 9) <= 2


def test_mixing_without_labels_or_documents(spark):
    docs, labels, rows = labelled_corpus(spark, 20)
    assert mixing.mixed(docs, labels.limit(0), {"good": 1.0}).count() == len(rows)
    assert mixing.mixed(docs.limit(0), labels, {"good": 1.0}).collect() == []


# --- context trees -------------------------------------------------------------------------


def brute_scores(training, texts, depth):
    """Recursion over all contexts, from the definition."""
    counts = {}
    for t in training:
        data = bytes(depth) + t + b"\xff"
        for at in range(depth, len(data)):
            for j in range(8):
                before, bit = (1 << j) | (data[at] >> (8 - j)), (data[at] >> (7 - j)) & 1
                for d in range(depth + 1):
                    counts.setdefault((data[at - d : at], before), [0, 0])[bit] += 1
    children = {}
    for context, before in counts:
        if context:
            children.setdefault((context[1:], before), []).append((context, before))
    estimate = lambda n: math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)

    @lru_cache(maxsize=None)
    def weighted(node):
        if len(node[0]) == depth:
            return estimate(counts[node])
        return np.logaddexp(math.log(0.5) + estimate(counts[node]), math.log(0.5) + sum(map(weighted, children[node])))

    def one(data, at, before):
        result, weight = 0.5, 1.0
        done = 0.0
        for d in range(depth + 1):
            node = (data[at - d : at], before)
            if node not in counts:
                break
            n = counts[node]
            rate = (n[1] + 0.5) / (sum(n) + 1)
            result = done + weight * rate
            if d < depth:
                stays = math.exp(math.log(0.5) + estimate(n) - weighted(node))
                done, weight = done + weight * stays * rate, weight * (1 - stays)
        return result

    for t in texts:
        data, total = bytes(depth) + t + b"\xff", 0.0
        for at in range(depth, len(data)):
            for j in range(8):
                p = one(data, at, (1 << j) | (data[at] >> (8 - j)))
                total += math.log10(p if (data[at] >> (7 - j)) & 1 else 1 - p)
        yield total


def test_scores_are_those_of_the_recursion(spark):
    rng = np.random.default_rng(6)
    texts = ["the cat sat on the mat", "The cat ate the rat", None, "", "été à la mer", "zzz", "a" * 300] + [
        " ".join(rng.choice(["the", "cat", "rat", "ate", "mat", "été"], 12)) for _ in range(40)
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the rat"), (7, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit(1)).repartition(3)
    found = ctw.score(docs, F.coalesce(F.col("doc_id") % 4 != 2, F.lit(True))).collect()
    low = lambda t: bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode())
    training = [low(t) for i, t in rows if i is None or i % 4 != 2]
    expected = Counter((i, round(s, 6)) for (i, _), s in zip(rows, brute_scores(training, [low(t) for _, t in rows], ctw.DEPTH)))
    assert Counter((r["doc_id"], round(r["score"], 6)) for r in found) == expected
    words = Counter(w for t in training for w in [*t.split(), None])
    total, distinct = sum(words.values()), len(words)
    base = Counter((i, round(sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in [*low(t).split(), None]), 6)) for i, t in rows)
    assert Counter((r["doc_id"], round(r["base_score"], 6)) for r in found) == base
    assert {r["train_tokens"] for r in found} == {total}


def test_context_trees_predict_held_out_text_better_than_the_root(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    found = ctw.score(docs, ~held).collect()
    bits = [r["bits_per_byte"] for r in found if not r["training"] and r["n_tokens"] > 50]
    assert all((not r["training"]) == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in found)
    assert np.mean(bits) < 3.0  # order 0 takes over 4 bits


def test_scores_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ctw.score(empty, F.lit(True)).collect() == []
    one = ctw.score(spark.createDataFrame([(1, "ab")], "doc_id long, text string"), F.lit(False)).first()
    assert one["score"] == pytest.approx(24 * math.log10(0.5)) and one["base_score"] == 0 and one["n_known"] == 0
