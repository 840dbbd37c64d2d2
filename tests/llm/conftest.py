"""Small documents with every odd case, and the same with other columns of awkward names."""

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside or return.
AWKWARD = ["block", "n_words", "kept_text", "fp", "component", "copies", "text_hash", "times", "kept", "base_failed", "rate", "bucket"]


def documents() -> list[tuple]:
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, other = some(40), some(13)
    texts = [
        None, "", " \n\t ", "one", "One two", "one\x0btwo  three\x1cfour\x85five",
        " ".join(some(80)), " ".join(some(80)),
        " ".join(some(30) + passage + some(30)), " ".join(some(9) + passage + some(5)), " ".join(passage),
        " ".join(some(20) + passage[3:25] + some(20)), " ".join(some(12) + other + some(12)), "  ".join(some(5) + other + some(6)),
        " ".join(other[:12]), " ".join(some(60) + passage[:13] + passage[20:]),
        "spam " * 100, "### *** | <a> " * 40, "same line of words\n" * 20 + " ".join(some(60)),
        "It's we'll DON'T  stop.\n\n Now: 123,456 　wide\xa0space " + "日本語テキスト " * 30,
        "x" * 50_000 + " tail", " ".join(some(20_000)), "ab cd " * 9_000,
        "Released under the MIT License. mit-license, (MIT) license; Licensed under the Apache License, Version 2.0!",
        "This work is licensed under the GNU General Public License, version 3. general public general public license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of the software",
    ]
    near = some(70)
    for i in range(6):  # near copies
        words = list(near)
        words[i * 9] = "changed"
        texts.append(" ".join(words))
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", None])) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[6], "en", "a") for i in range(5)]  # exact copies
    rows += [(7, texts[7], "en", "a"), (8, " ".join(some(30) + passage), "fr", "b")]  # repeated row, repeated id
    rows += [(None, texts[6], "en", "a"), (None, " ".join(some(60)), None, None), (-4, " ".join(passage[5:]), "en", "a")]
    rng.shuffle(rows)
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def awkward(docs):
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(AWKWARD)])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
