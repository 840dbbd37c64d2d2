"""A training corpus from raw documents: five stages over ``documents``.

Quality rules, one document of each SimHash group, substring dedup, mixing to target weights
and byte-level BPE.  Each stage takes the whole output of the one before, which is written as
Parquet and read again; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from public_tokenizers import PATTERN, path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright.llm import bpe, mixing, quality, simhash, substring_dedup
from slicewright.llm._store import shared_folder, shipped
from slicewright.llm.queries import labelled_domains

#: Share of tokens by domain.  The good domain's tokens all stay, and no rate is above one, so
#: the others are thinned until they fit beside them.
TARGETS = {"good": 0.95, "poor": 0.05, "toxic": 0.0}
WHOLE = "good"
MAX_RATE = 1.0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rule and the limits of their language and source."""
    return quality.passing(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: of the smallest id, and text where that repeats."""
    return simhash.keep_one(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has too."""
    return substring_dedup.without_repeats(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the rates that bring the domains to TARGETS."""
    return mixing.mixed(docs, labelled_domains(spark, sf_dir), TARGETS, max_rate=MAX_RATE, whole=WHOLE)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian 32-bit numbers, and the text that
    they decode to."""
    tokenizer = bpe.Tokenizer(tokenizer_path("byte_bpe_multi_50k.tiktoken"), PATTERN)
    decoded = bpe.decode(bpe.encode(docs, tokenizer), tokenizer)
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("decoded")
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("mix_to_targets", mix_to_targets),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither the mixing stage nor BPE; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
