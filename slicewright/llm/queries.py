"""The operators bound to the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import PATTERN, path as tokenizer_path
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slicewright.llm import ann, bpe, contamination, ctw, filter_audit, license_scan, mixing, preference, prefix_trie, quality, simhash, substring_dedup, url_filter
from slicewright.llm._store import shipped, written

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules of the query (fixed values): host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op8_context_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    scored = ctw.score(table(spark, sf_dir, "documents"), ~F.coalesce(held_out, F.lit(False)))
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = written(quality.count_stats(docs, ["doc_id", "lang", "source"]), "stats")
    return quality.judged(stats, quality.thresholds(stats)).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "lang", "source"
    )


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


#: Every so-manieth vector is a query.
QUERY_STEP = 20


def op1_adaptive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_STEP == 0)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.swapped_replies(table(spark, sf_dir, "conversations"))


#: Domains of the labels table, and the mix that is aimed at.
MIX_TARGETS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain): toxic, else good or poor by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates, model = mixing.rated(table(spark, sf_dir, "documents"), labelled_domains(spark, sf_dir), MIX_TARGETS)
    each = rates.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return each.select(
        F.col("key").alias("doc_id"), "n_tokens",
        *[F.element_at("p", i + 1).alias(f"p_{d}") for i, d in enumerate(model.domains)], "rate",
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = bpe.Tokenizer(tokenizer_path("byte_bpe_multi_50k.tiktoken"), PATTERN)
    encoded = bpe.encode(table(spark, sf_dir, "documents"), tokenizer)
    return bpe.decode(encoded, tokenizer).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: So many neighbouring numbers of conversations share their first turns.
FAMILY, MOST_SHARED = 100, 5


def shared_starts(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, place, code): each conversation c begins with the first h turns of the first
    one of its family, h = crc32(c) % 6, in place of its own; and a row with null place for each."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).alias("h")
    coded = conversations.filter("conv_id is not null").select("conv_id", "turn", prefix_trie.turn_code().alias("code"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "code"))
    placed = written(coded.select("conv_id", place.alias("place"), "code"), "turns")
    convs = placed.select("conv_id").distinct().select("conv_id", h, (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first_id"))
    starts = placed.filter(F.col("place") <= MOST_SHARED).withColumnRenamed("conv_id", "first_id")
    own = placed.select("conv_id", "place", "code", h).filter("place > h").drop("h")
    none = convs.select("conv_id", F.lit(None).cast("int").alias("place"), F.lit(None).cast("binary").alias("code"))
    return convs.join(starts, "first_id").filter("place <= h").select("conv_id", "place", "code").unionByName(own).unionByName(none)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.trie(shared_starts(table(spark, sf_dir, "conversations")), code=F.col("code"))
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Filters of the audit (fixed values): A under 200 words; B 100 x distinct words under 50 x words;
#: C 100 x capitals over 3 x code points; D one of #$%&*|.
def text_filters(text: Column) -> dict[str, Column]:
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    failed = text_filters(F.col("text"))
    rows = filter_audit.repeats_smaller(docs.select("*", *[c.alias(f) for f, c in failed.items()]), "doc_id", "text", "E")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    return filter_audit.audit(
        filter_audit.with_flags(rows, labels, "doc_id"), F.coalesce("lang", F.lit("")),
        {f: F.col(f) for f in "ABCDE"}, {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")},
    )


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_adaptive_ann, op2_substring_dedup, op3_preference_format, op4_mix_sources, op5_license_scan,
        op6_byte_bpe, op7_url_filter, op8_context_tree_score, op9_quality_rules, op10_simhash_near_dedup,
        op11_prefix_trie, op12_decontaminate, op13_filter_audit,
    )
}
