"""Quality rules, SimHash, substring dedup, licenses and BPE against brute force."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from public_tokenizers import PATTERN, path
from pyspark.sql import functions as F

from slicewright.llm import _blocks, _text, bpe, ctw, license_scan, quality, simhash, substring_dedup
from tests.llm.conftest import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def counter(rows):
    return Counter(tuple(r) for r in rows)


# --- quality -------------------------------------------------------------------------------


def brute_counts(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(lines)


def test_counts_are_those_of_brute_force(docs, rows):
    found = quality.count_stats(docs, ["doc_id"]).collect()
    assert counter(found) == Counter((r[0], *brute_counts(r[1])) for r in rows)


def thue_morse(n):
    """Two words of n letters a and b that every polynomial hash modulo a power of two confuses."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 4096])
def test_balanced_words_are_told_apart(spark, n):
    a, b = thue_morse(n)
    rows = [(1, f"{a}\n{b}"), (2, f"{a}\n{a}"), (3, " ".join([a, "x", "y", b, "x", "y"])), (4, " ".join([a, "x", "y"] * 2))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert counter(quality.count_stats(table, ["doc_id"]).collect()) == Counter((i, *brute_counts(t)) for i, t in rows)
    others = [f"o{i}" for i in range(12)]
    windows = spark.createDataFrame([(1, " ".join([a, *others])), (2, " ".join([b, *others])), (3, " ".join([b, *others]))], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(windows).collect()} == {1: 0, 2: 0, 3: 13}
    scored = spark.createDataFrame([(1, a, True), (2, b, False), (3, a, False)], "doc_id long, text string, learn boolean")
    known = {r["doc_id"]: r["n_known"] for r in ctw.score(scored, F.col("learn")).collect()}
    assert known == {1: 2, 2: 1, 3: 2}


def test_equal_hashes_are_confirmed_on_the_bytes(monkeypatch):
    """With a hash that says nothing, all is told apart by the bytes."""
    monkeypatch.setattr(_text, "span_hash", lambda data, start, end: np.zeros(len(start), np.uint64))
    monkeypatch.setattr(quality, "span_hash", _text.span_hash)
    rng = np.random.default_rng(0)
    texts = ["\n".join(" ".join(rng.choice(["a", "b", "c" * 70, "c" * 69 + "d"], 3)) for _ in range(rng.integers(1, 12))) for _ in range(30)]
    data, offsets = _text.utf8(pa.array(texts))
    found = np.stack(quality._stats(data, offsets), axis=1).tolist()
    assert found == [list(brute_counts(t)) for t in texts]


def test_quality_keeps_clean_and_rejects_symbols(awkward, rows):
    kept = quality.passing(awkward)
    assert kept.columns == awkward.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    ids = {t: i for i, t, *_ in rows}
    assert ids["### *** | <a> " * 40] not in texts and ids["spam " * 100] not in texts and ids[None] not in texts
    assert {6, 7, 8, 100, 104} <= set(texts)


def test_quantiles_come_from_the_merged_bins(spark):
    values = [(i, "en", "a" if i % 3 else "b", i / 1000) for i in range(1, 1001)]
    stats = spark.createDataFrame(values, "doc_id long, lang string, source string, share double").select(
        "lang", "source", F.lit(100).alias("n_words"), F.lit(1000).alias("word_chars"), (F.col("share") * 1000).alias("n_symbols"),
        F.lit(0).alias("n_dup_lines"), F.lit(0).alias("n_repeat_words"), F.lit(1).alias("n_lines"),
    )
    fine = quality.sketches(stats, ["lang", "source"])
    both = quality.gathered(quality.merged(fine, ["lang"]), ["lang"]).filter("measure = 'symbol_rate'")
    found = both.select("total", *[quality.quantile(F.array_sort("bins"), F.col("total"), p).alias(f"q{p}") for p in (25, 50, 75)]).first()
    assert found["total"] == 1000
    for p in (25, 50, 75):
        assert quality.ACCURACY * 2 > abs(((1 + quality.ACCURACY) / (1 - quality.ACCURACY)) ** found[f"q{p}"] / (p / 100) - 1)


def test_small_groups_lean_on_their_language(spark):
    """A group of three documents has nearly its language's quartiles, a large one its own."""
    rows = [("a", 1000 + i) for i in range(1000)] + [("b", 10)] * 3 + [("c", 10)] * 5000
    stats = spark.createDataFrame(rows, "source string, n_words long").select(
        F.when(F.col("source") == "c", "fr").otherwise("en").alias("lang"), "source", (F.col("n_words") * 50).alias("n_words"),
        (F.col("n_words") * 250).alias("word_chars"), *[F.lit(0).alias(c) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")],
        F.lit(1).alias("n_lines"),
    )
    found = {(r["t_source"], r["measure"]): r["median"] for r in quality.group_quantiles(stats, "lang", "source").collect()}
    assert found["a", "n_words"] > 60_000 and found["b", "n_words"] > 50_000
    assert found["c", "n_words"] == pytest.approx(500, rel=0.02)


def measured(spark, rows):
    """Stats rows (doc_id, n_words, word_chars, n_symbols, n_lines) of one group."""
    return spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_lines long").select(
        "*", F.lit("en").alias("lang"), F.lit("a").alias("source"), F.lit(0).alias("n_dup_lines"), F.lit(0).alias("n_repeat_words")
    )


def test_thresholds_follow_the_group_on_both_sides(spark):
    usual = [(i, 100 + i, 5 * (100 + i) + 10 * (i % 7), 0, 5) for i in range(300)]
    odd = {1000: (60, 1200, 0, 3), 1001: (200, 200, 0, 8), 1002: (90_000, 450_000, 0, 4000), 1003: (800, 4000, 0, 1)}
    stats = measured(spark, usual + [(i, *r) for i, r in odd.items()])
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(stats, quality.thresholds(stats)).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in odd)
    # the same word lengths are usual in another corpus
    other = measured(spark, [(i, 60 + i % 50, 20 * (60 + i % 50) - i % 9, 0, 3) for i in range(300)] + [(1000, *odd[1000])])
    assert all(r["kept"] for r in quality.judged(other, quality.thresholds(other)).collect())


def test_no_group_is_so_bad_that_everything_passes(spark):
    stats = measured(spark, [(i, 100, 500, 300 + i % 9 if i % 3 == 0 else 0, 5) for i in range(300)])
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(stats, quality.thresholds(stats)).collect()}
    assert all(kept[i] == (i % 3 > 0) for i in kept)


def test_quality_of_nothing(empty):
    assert quality.passing(empty).collect() == []


# --- SimHash -------------------------------------------------------------------------------


def brute_fingerprint(text, k=3):
    words = WORD.findall(lower(text))
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))


def brute_components(ids_and_prints, distance=2):
    prints = sorted({f for _, f in ids_and_prints})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[i:]:
            if (a ^ b).bit_count() <= distance:
                root[find(b)] = find(a)
    least = defaultdict(lambda: None)
    for i, f in ids_and_prints:
        r = find(f)
        if i is not None and (least[r] is None or i < least[r]):
            least[r] = i
    return [(i, f, least[find(f)]) for i, f in ids_and_prints]


def test_simhash_groups_are_those_of_brute_force(docs, rows):
    found = simhash.near_duplicates(docs).collect()
    expected = brute_components([(i, brute_fingerprint(t)) for i, t, *_ in rows])
    assert Counter((r[0], r[1] % (1 << 64), r[2]) for r in found) == Counter(expected)


def test_links_in_dense_and_chained_groups(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(1 << 62))
    prints = {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}  # a dense ball
    chain = int(rng.integers(1 << 62))
    for step in range(30):
        chain ^= 3 << (2 * step)
        prints.add(chain)
    prints |= {int(x) for x in rng.integers(1 << 62, size=200)}
    table = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    close = simhash.candidates(table)
    edges = {tuple(r) for r in simhash.links(close).collect()}
    roots = {r["node"]: r["root"] for r in simhash.connected_components(simhash.links(close), "a", "b").collect()}
    groups = defaultdict(set)
    for p in prints:
        groups[roots.get(simhash._signed(p), simhash._signed(p))].add(p)
    expected = defaultdict(set)
    for i, _, least in brute_components([(p, p) for p in prints]):
        expected[least].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    assert len(edges) <= 65 * len(prints)


@pytest.mark.parametrize(("distance", "order"), [(2, 2), (2, 3), (2, 5), (4, 2)])
def test_every_set_of_bits_is_dropped_together(distance, order):
    masks = simhash.covering_masks(distance, order)
    rng = np.random.default_rng(1)
    sets = [rng.choice(64, distance, replace=False) for _ in range(500)]
    assert all(any(not any((m >> int(b)) & 1 for b in bits) for m in masks) for bits in sets)


def brute_survivors(rows):
    """Of each component of (id, text) rows: the smallest id (none only where all lack it), and of
    its rows the smallest text."""
    prints = [brute_fingerprint(t) for _, t in rows]
    named = brute_components([(n, f) for n, f in enumerate(prints)])  # components by row number
    groups = defaultdict(list)
    for (_, _, least), row in zip(named, rows):
        groups[least].append(row)
    smallest = lambda rows: min(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    return Counter(smallest(g) for g in groups.values())


def test_one_document_of_each_group_stays(awkward, rows):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    expected = brute_survivors([(i, t) for i, t, *_ in rows])
    assert counter(kept.select("doc_id", "text").collect()) == expected
    assert len(expected) < len({(i, t) for i, t, *_ in rows})


def test_an_id_with_unrelated_texts_loses_none_of_them(spark):
    words = lambda seed: " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 500, 80))
    unrelated = [words(i) for i in range(6)]
    rows = [(5, t) for t in unrelated] + [(5, unrelated[0]), (3, unrelated[1]), (9, unrelated[2])]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert counter(kept.collect()) == Counter([(3 if i == 1 else 5, t) for i, t in enumerate(unrelated)])


def test_copies_without_an_id_go_like_others(spark):
    words = lambda seed: " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 500, 80))
    rows = [(None, words(0)), (4, words(0)), (None, words(0)), (None, words(1)), (None, words(1)), (None, words(2))]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert counter(kept.collect()) == Counter([(4, words(0)), (None, words(1)), (None, words(2))])


def test_simhash_of_nothing(empty):
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_one(empty).collect() == []


# --- substring dedup -----------------------------------------------------------------------


def brute_removal(rows, window=13):
    owner = {}
    for i, t, *_ in rows:
        words = WORD.findall(t or "")
        for q in range(len(words) - window + 1 if i is not None else 0):
            w = tuple(words[q : q + window])
            owner[w] = min(owner.get(w, i), i)
    for i, t, *_ in rows:
        words = WORD.findall(t or "")
        gone = [False] * len(words)
        for q in range(len(words) - window + 1 if i is not None else 0):
            if owner[tuple(words[q : q + window])] < i:
                gone[q : q + window] = [True] * window
        yield i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)


def brute_factors(rows, window=13):
    """A greedy parse, word by word: (id, factors) of each row."""
    words = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    first = {}
    for i, w in words:
        for q in range(len(w) - window + 1 if i is not None else 0):
            seen = tuple(w[q : q + window])
            first[seen] = min(first.get(seen, (i, q)), (i, q))
    for i, w in words:
        factors, q, done = [], 0, 0
        while i is not None and q <= len(w) - window:
            source, place = first[tuple(w[q : q + window])]
            if source >= i:
                q += 1
                continue
            end = q + window
            while end < len(w) and first[tuple(w[end + 1 - window : end + 1])] == (source, place + end + 1 - window - q):
                end += 1
            begin = max(q, done)
            factors.append((begin, end - 1, source, place + begin - q))
            done, q = end, end + 1 - window
        yield i, tuple(factors)


def test_factors_are_those_of_a_greedy_parse(awkward, rows):
    found = [(r["doc_id"], tuple(map(tuple, r["factors"]))) for r in substring_dedup.remove_repeats(awkward).collect()]
    assert Counter(found) == Counter(brute_factors(rows))
    assert any(len(f) > 1 for _, f in found)


def test_factors_point_at_their_words_and_part_where_the_texts_do(spark):
    a, b, c = ([f"{x}{i}" for i in range(40)] for x in "abc")
    texts = {1: a, 2: b + a[5:30], 3: a[:20] + b[10:30] + ["new"] + c, 4: c + a[7:27] + b[3:23] + c[:20], 5: b[:12] + c[:12], 6: a[:14] + a[:14]}
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    found = {r["doc_id"]: [tuple(f) for f in r["factors"]] for r in substring_dedup.remove_repeats(table).collect()}
    assert found == {
        1: [], 2: [(40, 64, 1, 5)], 3: [(0, 19, 1, 0), (20, 39, 2, 10)],
        4: [(0, 39, 3, 41), (40, 59, 1, 7), (60, 79, 2, 3), (80, 99, 3, 41)], 5: [], 6: [(0, 13, 1, 0), (14, 27, 1, 0)],
    }
    for i, factors in found.items():
        for first, last, source, place in factors:
            assert texts[i][first : last + 1] == texts[source][place : place + last + 1 - first]


def test_removed_words_are_those_of_brute_force(awkward, rows):
    found = substring_dedup.remove_repeats(awkward)
    got = found.select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert counter(got) == Counter(brute_removal(rows))
    spans = {r["doc_id"]: r["spans"] for r in found.collect()}
    assert spans[10] == [(0, 39)] or spans[10] == []


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_blocks_do_not_change_the_result(docs, rows, blocks, monkeypatch):
    monkeypatch.setattr(substring_dedup, "block_count", lambda *a: blocks)
    found = substring_dedup.remove_repeats(docs, window=6, anchor=3).collect()
    assert counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in found) == Counter(brute_removal(rows, 6))
    assert Counter((r["doc_id"], tuple(map(tuple, r["factors"]))) for r in found) == Counter(brute_factors(rows, 6))


def test_no_key_fills_a_block(spark):
    rows = [(None, f"text {i}") for i in range(300)] + [(7, f"other {i}") for i in range(300)] + [(8, "same " * 20)] * 300
    dealt = _blocks.in_blocks(spark.createDataFrame(rows, "k long, t string").repartition(4), "k", "t", 40, 2048).collect()
    assert Counter((r["k"], r["t"]) for r in dealt) == Counter(rows)
    for key in (None, 7, 8):
        of_key = Counter(r["block"] for r in dealt if r["k"] == key)
        assert len(of_key) > 8 and max(of_key.values()) < 100


def test_equal_rows_in_several_blocks_do_not_change_the_result(docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "in_blocks", lambda d, k, t, n: _blocks.in_blocks(d, k, t, n, 512))
    found = substring_dedup.remove_repeats(docs.union(docs)).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert counter(found) == Counter(brute_removal(rows * 2))


def test_cut_texts_keep_their_layout(awkward, rows):
    cut = substring_dedup.without_repeats(awkward)
    assert cut.columns == awkward.columns
    removed = Counter((i, n, kept) for i, _, n, kept in brute_removal(rows))
    same = {(i, t) for i, t, *_ in rows}
    for r in cut.collect():
        if (r["doc_id"], r["text"]) not in same:
            assert any(i == r["doc_id"] and n and kept.split() == r["text"].split() for i, n, kept in removed)
            assert r["n_chars"] == len(r["text"])
    untouched = Counter((i, t) for (i, t, *_), (_, _, n, _) in zip(rows, brute_removal(rows)) if not n)
    assert not untouched - Counter((r["doc_id"], r["text"]) for r in cut.collect())


def test_substring_dedup_of_nothing(empty):
    assert substring_dedup.remove_repeats(empty).collect() == []


# --- licenses ------------------------------------------------------------------------------


def brute_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places = [
        (i, label) for phrase, label in license_scan.PHRASES.items()
        for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
    ]
    first, last = (min(places)[0], max(places)[0]) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted({label for _, label in places}))


def test_license_places_are_those_of_brute_force(awkward, rows):
    found = license_scan.scan(awkward).collect()
    got = Counter(tuple(r[:6]) for r in found)
    assert got == Counter((i, *brute_license(t)) for i, t, *_ in rows)
    for r in found:
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
    # one word differs from the template: found by neighbouring diagonals
    granted = next(i for i, t, *_ in rows if t and t.startswith("Permission"))
    assert next(r for r in found if r["doc_id"] == granted)["labels"] == "mit"


def test_diagonals_with_a_missing_or_added_word_are_merged(spark):
    base = "redistribution and use in source and binary forms with or without modification are permitted".split()
    texts = [base[:5] + base[6:], base[:7] + ["extra"] + base[7:], base[:4], base[::-1]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in license_scan.scan(docs).collect()} == {0: "bsd", 1: "bsd", 2: "", 3: ""}


def test_license_scan_of_nothing(empty):
    assert license_scan.scan(empty).collect() == []


# --- BPE -----------------------------------------------------------------------------------

FILE = path("byte_bpe_multi_50k.tiktoken")


def library():
    with open(FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize(("chunk", "overlap"), [(bpe.CHUNK, bpe.OVERLAP), (300, 40)])
def test_ids_are_the_library_s_and_decode_to_the_text(awkward, rows, chunk, overlap):
    tokenizer = bpe.Tokenizer(FILE, PATTERN)
    found = bpe.decode(bpe.encode(awkward, tokenizer, chunk=chunk, overlap=overlap), tokenizer).collect()
    encoding = library()
    digest = lambda b: hashlib.sha256(b).hexdigest()
    expected = Counter(
        (i, digest(np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes()), digest((t or "").encode())) for i, t, *_ in rows
    )
    assert Counter((r["doc_id"], digest(r["ids"]), digest(r["decoded"])) for r in found) == expected


def test_segments_begin_where_the_pattern_has_a_match(rows):
    import regex

    pattern = regex.compile(PATTERN)
    for _, text, *_ in rows:
        for t in filter(None, [text[:3000] if text else None]):
            starts = {m.start() for m in pattern.finditer(t)}
            assert {m.start() for m in bpe.SEGMENT.finditer(t)} <= starts


def test_bpe_of_nothing(empty):
    assert bpe.encode(empty, bpe.Tokenizer(FILE, PATTERN)).collect() == []


def test_awkward_names_are_there(awkward):
    assert set(AWKWARD) <= set(awkward.columns)
