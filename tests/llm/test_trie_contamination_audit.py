"""Prefix trie, decontamination and filter audit against brute force and their SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from slicewright.llm import contamination, filter_audit, prefix_trie, queries
from slicewright.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def same_as_sql(spark, name, sf_dir=SF):
    found = queries.QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    for t in ("conversations", "documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    told = con.sql(ORACLE[name])
    assert sorted(told.columns) == sorted(found.columns)
    assert Counter(tuple(r) for r in found.select(*told.columns).collect()) == Counter(told.fetchall())
    return found


# --- prefix trie ---------------------------------------------------------------------------

TURNS = "conv_id long, place int, role string, text string"


def brute_trie(convs):
    """``convs``: id -> list of (role, text)."""
    members, ending = defaultdict(set), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ending[tuple(turns)].add(c)
    children = Counter(k[:-1] for k in members if k)
    out = []
    for k in members:
        below = [x for x in members if x[: len(k)] == k]
        out.append((
            min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), children[k], sum(not children[x] for x in below),
            sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
            hashlib.sha256(",".join(map(str, sorted(ending.get(k, ())))).encode()).hexdigest(),
        ))
    return Counter(out)


def trie_rows(spark, convs, **how):
    rows = [(c, None, None, None) for c in convs] + [(c, i + 1, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    random.Random(3).shuffle(rows)
    turns = spark.createDataFrame(rows, TURNS).withColumns({"key": F.lit(1), "run": F.lit("x"), "n": F.lit(2), "id": F.lit(3), "code": F.lit(4)})
    found = prefix_trie.trie(turns, **how).select("conv", "depth", "parent_conv", "n", "children", "leaves", "saved", "ends")
    return Counter(tuple(r) for r in found.collect())


def bushy(n, seed, longest=7):
    rng = random.Random(seed)
    turn = lambda: (rng.choice(["user", "assistant", ""]), rng.choice(["", "a", "héllo", "x" * 300]))
    convs = {}
    for i in range(n):
        c = rng.randrange(-50, 10_000)
        start = convs[rng.choice(list(convs))] if convs and rng.random() < 0.7 else []
        convs[c] = start[: rng.randrange(len(start) + 1)] + [turn() for _ in range(rng.randrange(longest))]
    return convs


@pytest.mark.parametrize(("run_bytes", "fan"), [(1 << 20, 32), (900, 2), (2500, 3)])
def test_trie_is_that_of_brute_force_in_any_number_of_rounds(spark, run_bytes, fan):
    convs = bushy(120, run_bytes)
    assert trie_rows(spark, convs, run_bytes=run_bytes, fan=fan) == brute_trie(convs)


def test_forests_of_any_runs_merge_to_one_trie():
    """The rounds without Spark, on many random tries cut at random places."""
    for seed in range(150):
        rng = random.Random(seed)
        convs = bushy(rng.randrange(1, 40), seed, 5)
        code = lambda t: hashlib.sha256(repr(t).encode()).digest()[:16] + len(t[1]).to_bytes(4, "big")
        ending = defaultdict(set)
        for c, turns in convs.items():
            ending[b"".join(map(code, turns))].add(c)
        keys = sorted(ending)
        cuts = sorted(rng.randrange(len(keys) + 1) for _ in range(rng.randrange(6)))
        runs = [keys[a:b] for a, b in zip([0, *cuts], [*cuts, len(keys)]) if a < b]
        bounds = [(r[0], r[-1]) for r in runs]
        rows = [{k: prefix_trie.Sums(len(ending[k]), min(ending[k])) for k in r} for r in runs]
        nodes = []
        while True:
            opened = []
            for i, r in enumerate(rows):
                beside = ([bounds[i - 1][1]] if i else []) + ([bounds[i + 1][0]] if i + 1 < len(rows) else [])
                run = prefix_trie.Run(sorted(r), [r[k] for k in sorted(r)], beside)
                nodes += [(x[2], x[1], x[3], x[4], x[5], x[6]) for x in run.nodes]
                opened.append(run.open)
            if len(rows) == 1:
                break
            merged = []
            for i in range(0, len(rows), 2):
                into = {}
                for key, s in [x for o in opened[i : i + 2] for x in o]:
                    if key in into:
                        into[key].add(s)
                    else:
                        into[key] = s
                merged.append(into)
            bounds = [(bounds[i][0], bounds[min(i + 1, len(bounds) - 1)][1]) for i in range(0, len(rows), 2)]
            rows = merged
        assert Counter(nodes) == Counter({(c, d, n, ch, lv, sv): m for (c, d, _, n, ch, lv, sv, _), m in _short(brute_trie(convs)).items()})


def _short(counted):
    out = Counter()
    for r, m in counted.items():
        out[(*r[:2], None, *r[3:7], None)] += m
    return out


def test_trie_of_copies_and_a_long_conversation(spark):
    rng = random.Random(2)
    long = [("user", f"t{i}") for i in range(3000)]
    convs = {i * 3 - 4000: [("user", "hi"), ("assistant", "ho")] for i in range(6000)}  # many pieces of ids
    convs |= {50_000 + i: [("user", "hi"), ("assistant", f"{rng.random()}")] for i in range(300)} | {90_000: [], 90_001: []}
    found = trie_rows(spark, convs | {99_999: long, 99_998: long[:2990]}, run_bytes=20_000, fan=3)
    expected = brute_trie(convs | {99_999: [("user", "only")], 99_998: [("user", "only")]})
    by_depth = lambda rows: Counter((r[0], r[1], r[3], r[7]) for r in rows.elements() if r[1] and r[0] < 99_998)
    assert by_depth(found) == by_depth(expected)
    deep = {r[1]: r for r in found if r[0] in (99_998, 99_999)}
    assert len(deep) == 3000 and deep[2990][3:6] == (2, 1, 1) and deep[2991][3:6] == (1, 1, 1) and deep[3000][4] == 0
    saved = lambda d: sum(len(f"t{i}") for i in range(d - 1, 2990))
    assert all(deep[d][6] == saved(d) and deep[d][2] == (99_998 if 1 < d <= 2991 else min(convs) if d == 1 else 99_999) for d in deep)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(empty).collect() == []
    one = prefix_trie.trie(spark.createDataFrame([(7, None, None, None), (None, 1, "user", "x")], TURNS)).collect()
    assert [(r["conv"], r["depth"], r["n"], r["children"], r["leaves"], r["parent"]) for r in one] == [(7, 0, 1, 0, 1, None)]


def test_null_turns_are_empty_and_ties_stay(spark):
    rows = [(1, 1, None, None), (2, 1, "", ""), (2, 2, "user", "b"), (2, 2, "user", "a"), (3, 1, "", ""), (3, 2, "user", "a"), (3, 2, "user", "b")]
    found = prefix_trie.trie(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted((r["depth"], r["n"]) for r in found) == [(0, 3), (1, 3), (2, 2), (3, 2)]


def test_trie_query(spark):
    found = same_as_sql(spark, "op11_prefix_trie")
    assert dict(found.dtypes) == {c: "string" if c == "ends_sha256" else "bigint" for c in found.columns}


def test_shared_starts_are_those_of_the_family(spark):
    turns = [(c, t, "user", f"{c}-{t}") for c in (100, 117, 142, 250, 301) for t in (3, 1, 2)] + [(142, None, "system", "first")]
    found = queries.shared_starts(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))
    nodes = prefix_trie.trie(found, code=F.col("code")).collect()
    own = {c: [f"{c}-{t}" for t in (1, 2, 3)] for c in (100, 117, 142, 250, 301)} | {142: ["first", "142-1", "142-2", "142-3"]}
    rebuilt = {}
    for c, texts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = [("user", x) for x in own.get(c - c % 100, [])[:h] + texts[h:]]
    rebuilt = {c: [("system" if x == "first" else "user", x) for _, x in t] for c, t in rebuilt.items()}
    assert Counter((r["conv"], r["depth"], r["n"], r["ends"]) for r in nodes) == Counter((r[0], r[1], r[3], r[7]) for r in brute_trie(rebuilt))


# --- decontamination -----------------------------------------------------------------------


def item_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_hits(text, items, window=10, shingle=4, containment=1.0):
    w, hit, ids = item_words(text), set(), set()
    for item, item_text in items:
        v = item_words(item_text)
        for part in {tuple(v[i : i + window]) for i in range(max(1, len(v) - window + 1))} if v else ():
            n = min(shingle, len(part))
            m = len(part) - n + 1
            for start in range(len(w) - len(part) + 1):
                shared = sum(w[start + i : start + i + n] == list(part[i : i + n]) for i in range(m))
                if shared >= max(1, -(-(containment * m - 1e-9) // 1)):
                    hit |= set(range(start, start + len(part)))
                    ids |= {str(item)} - {"None"}
    return len(w), len(hit), tuple(sorted(ids))


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", "It's", "é1", "naïve", "x" * 300, *[f"w{i}" for i in range(60)]]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, some(rng.randrange(10, 30))) for i in range(12)] + [(20, some(7)), (21, some(2)), (22, some(1)), (23, ["a"] * 14), (24, [])]
    items += [(30, items[0][1]), (0, some(15)), (None, some(12)), (31, items[3][1][:12])]
    texts = [None, "", " ".join(some(200)), "a " * 40, " ".join(some(9))]
    for _ in range(40):
        v = rng.choice(items)[1]
        cut = rng.randrange(len(v) + 1)
        broken = v[:cut] + (["odd"] if rng.random() < 0.4 else []) + v[cut:]
        texts.append(rng.choice([" ", "\n", "--"]).join(some(rng.randrange(30)) + broken[rng.randrange(3) :] + some(rng.randrange(30))))
    return items, texts


@pytest.mark.parametrize(("how", "seed"), [({}, 1), ({"shingle": 2}, 2), ({"window": 6, "shingle": 3, "containment": 0.5}, 3), ({"shingle": 1, "containment": 0.7}, 4)])
def test_contamination_is_that_of_brute_force(spark, how, seed):
    items, texts = corpus(seed)
    listed = [(i, " ".join(v).upper()) for i, v in items] + [(40, None)]
    rows = [(i % 41 if i % 9 else None, t) for i, t in enumerate([*texts, *texts[:7]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("row", "pos", "sid", "n_words", "words", "items")})
    bench = spark.createDataFrame(listed, "item_id long, text string").withColumns({c: F.lit(1) for c in ("gid", "ids", "w", "wid")})
    found = contamination.contaminated(docs, bench, **how).collect()
    expected = Counter((i, *brute_hits(t, listed, **how)) for i, t in rows)
    assert Counter((r[0], r[1], r[2], tuple(r[3])) for r in found) == expected
    assert sum(bool(x[2]) for x in expected) > 10


def test_large_benchmarks_are_joined_by_shuffle(spark, monkeypatch):
    items, texts = corpus(5)
    listed, rows = [(i, " ".join(v)) for i, v in items], list(enumerate(texts))
    bench = spark.createDataFrame(listed, "item_id long, text string")
    monkeypatch.setattr(contamination._bounded, "__defaults__", (0,))
    found = contamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert Counter((r[0], r[1], r[2], tuple(r[3])) for r in found) == Counter((i, *brute_hits(t, listed)) for i, t in rows)


def test_contamination_of_nothing(spark, docs, empty):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert contamination.contaminated(empty, bench).collect() == []
    none = contamination.contaminated(docs, bench.limit(0))
    assert none.count() == docs.count() and none.filter("n_hit > 0 or size(items) > 0").count() == 0


def test_contamination_query_has_no_python(spark):
    found = same_as_sql(spark, "op12_decontaminate")
    assert dict(found.dtypes) == {
        "doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean",
    }
    assert found.filter("contaminated").count() > 0
    assert not re.search("Python|Arrow|Pandas", found._jdf.queryExecution().toString())


# --- filter audit --------------------------------------------------------------------------


def brute_audit(rows, names, lost, orders):
    """``rows``: (part, failed letters, flags)."""
    out = set()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        taken = Counter()
        steps = []
        for order in orders:
            left = list(own)
            for s, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                late = sum(f in r[1] for r in own) - len(gone)
                left = [r for r in left if f not in r[1]]
                taken[f] += len(gone)
                alone = sum(r[1] == {f} for r in own)
                steps.append((part, order, s, len(left), len(gone), late, alone, *[sum(x in r[2] for r in gone) for x in lost], f))
        out |= {(*r[:-1], taken[r[-1]]) for r in steps}
    return out


def test_audit_is_that_of_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["en", "fr", ""]), {x for x in "ABCD" if rng.random() < 0.35}, {x for x in ("good", "bad") if rng.random() < 0.3}) for _ in range(400)]
    rows += [("es", set(), set())] * 3
    table = spark.createDataFrame(
        [(p, *[x in f or (None if i % 2 else False) for x in "ABCD"], *[x in w or None for x in ("good", "bad")]) for i, (p, f, w) in enumerate(rows)],
        "lang string, A boolean, B boolean, C boolean, D boolean, good boolean, bad boolean",
    ).withColumns({c: F.lit(1) for c in ("part", "mask", "n", "w0", "step")})
    for orders in (None, ["DCBA", "BADC"]):
        found = filter_audit.audit(table, F.col("lang"), {x: F.col(x) for x in "ABCD"}, {x: F.col(x) for x in ("good", "bad")}, orders)
        assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good", "bad", "shapley"]
        told = found.collect()
        expected = brute_audit(rows, "ABCD", ("good", "bad"), orders or ["".join(p) for p in permutations("ABCD")])
        assert {tuple(r) for r in told} == expected and len(told) == len(expected)


def test_removal_steps_are_the_min_plus_product():
    rng = np.random.default_rng(1)
    fails, positions = rng.random((20, 4)) < 0.4, np.argsort([rng.permutation(4) for _ in range(9)], axis=1).T + 1
    steps = filter_audit.removal_steps(fails, positions)
    for c in range(20):
        for o in range(9):
            assert steps[c, o] == min([positions[f, o] for f in range(4) if fails[c, f]], default=5)


def test_repeats_of_a_smaller_key(spark):
    rows = [(5, "a"), (3, "a"), (3, "a"), (None, "a"), (9, None), (2, ""), (7, "b"), (7, "b"), (8, "a\x00"), (10, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("digest", "least", "in_0")})
    found = filter_audit.repeats_smaller(docs, "doc_id", "text", "again")
    assert found.columns == ["doc_id", "digest", "least", "in_0", "again"]
    assert Counter((r["doc_id"], r["again"]) for r in found.collect()) == Counter([
        (5, True), (3, False), (3, False), (None, False), (9, True), (2, False), (7, False), (7, False), (8, False), (10, True),
    ])


def test_flags_of_rows_without_a_key(spark):
    rows = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "doc_id long")
    flags = spark.createDataFrame([(1, True), (None, True)], "doc_id long, good boolean")
    found = filter_audit.with_flags(rows, flags, "doc_id").collect()
    assert Counter((r["doc_id"], r["good"]) for r in found) == Counter([(1, True)] * 2 + [(None, None)] * 2 + [(2, None)])


def test_audit_refuses_odd_filters(spark):
    rows = spark.createDataFrame([(1,)], "a int")
    for filters, orders in (({}, None), ({"AB": F.lit(True)}, None), ({"A": F.lit(True)}, ["B"]), ({x: F.lit(True) for x in "ABCDEFGH"}, None)):
        with pytest.raises(ValueError):
            filter_audit.audit(rows, F.lit("x"), filters, {}, orders)


def test_audit_query(spark):
    found = same_as_sql(spark, "op13_filter_audit")
    assert found.dtypes[:3] == [("part", "string"), ("filter_order", "string"), ("step", "int")]
    assert all(t == "bigint" for _, t in found.dtypes[3:])


def test_audit_of_nothing(empty):
    found = filter_audit.audit(empty, F.col("lang"), {"A": F.col("n_chars") > 3}, {"lost": F.col("n_chars") > 5})
    assert found.collect() == []
