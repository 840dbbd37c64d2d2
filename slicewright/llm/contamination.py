"""Benchmark decontamination by a prefix-filtered set join.

Every item is cut into windows of ``window`` consecutive words (a shorter item is one window).
A window is the set of its shingles (``shingle`` words each, with their places), and occurs
where a stretch of a document with the window's length holds a share of at least
``containment`` of them at their places; with 1, where the words are the same.

* One pass over the documents meets all their shingles with those of the items; shingles are
  equi-joined on a hash and compared as words.  What meets (document row, place, shingle) is
  written; texts aren't needed after that.
* The number of meetings is a shingle's rarity.  A window that shares ``k`` of its ``m``
  shingles shares one of any ``m - k + 1``, so only the rarest so many (the prefix) are joined
  to the meetings; with containment 1 that is one shingle for each window.
* A joined shingle fixes where the window would begin.  Beginnings before the first word, and
  windows that would end behind the last one, go (positional and length bounds).
* The others are verified on the meetings around: the shingles at their places are counted.

The items' tables are broadcast only if their size, which is measured, is below
``BROADCAST_BYTES``; beyond it the same joins shuffle, and Spark splits skewed partitions.

Defined results
  null or empty text: no words, so no windows and no hits; repeated documents: each row is
  returned; null key: kept; items with equal words share windows, and all their ids are listed;
  an id that several items have is listed once; an item without an id hits words, but isn't
  listed or counted; ids are sorted as strings; empty table of documents: empty result; no
  items: no hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicewright.llm._store import written
from slicewright.llm.license_scan import words

WINDOW = 10
SHINGLE = 4
CONTAINMENT = 1.0
BROADCAST_BYTES = 32 << 20


def _bounded(table: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``table`` (a written one), marked for broadcast if it has at most ``limit`` bytes."""
    size = table.agg(F.sum(F.octet_length(F.to_json(F.struct(*table.columns))) + 16)).first()[0] or 0
    return F.broadcast(table) if size <= limit else table


def _need(m: Column, containment: float) -> Column:
    """How many of ``m`` shingles make the share (within rounding of the product)."""
    return F.greatest(F.lit(1), F.ceil(m * F.lit(containment) - F.lit(1e-9))).cast("int")


def item_texts(items: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (gid, words, ids): each sequence of words that items have, and the ids of those items."""
    parts = items.select(F.col(key).cast("string").alias("item"), words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    texts = parts.groupBy("words").agg(F.collect_set("item").alias("ids"))
    return written(texts.withColumn("gid", F.monotonically_increasing_id()), "item-texts")


def windows_of(texts: DataFrame, window: int) -> DataFrame:
    """Rows (gid, w): the words of every window."""
    last = F.greatest(F.lit(1), F.size("words") - window + 1)
    cut = F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("words", i, F.lit(window)))
    return written(texts.select("gid", F.explode(cut).alias("w")), "text-windows")


def _meetings(docs: DataFrame, key: str, text: str, known: DataFrame, shingle: int) -> DataFrame:
    """Rows (row, key, n_words, pos, sid): a row with pos null for each document, and the places of the
    ``known`` shingles (sid, words, hash) in it."""
    lengths = sorted(r[0] for r in known.select(F.size("words")).distinct().collect())  # at most ``shingle`` numbers
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), words(F.col(text)).alias("words"))
    shifted = [F.slice("words", i + 1, F.size("words")).alias(f"w{i}") for i in range(shingle)]
    placed = rows.select(
        "row", "key", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(F.arrays_zip(*shifted)).alias("pos", "near")
    ).select("row", "key", "n_words", "pos", *[F.col(f"near.w{i}").alias(f"w{i}") for i in range(shingle)])
    own = lambda n: F.array(*[F.col(f"w{i}") for i in range(n)])
    there = lambda n: F.col(f"w{n - 1}").isNotNull()
    hashed = lambda n: F.when(there(n), F.xxhash64(*[f"w{i}" for i in range(n)]))
    if len(lengths) > 1:
        asked = placed.withColumn("asked", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), hashed(n).alias("hash")) for n in lengths])))
        asked = asked.select(*placed.columns, "asked.n", "asked.hash")
    else:
        n = lengths[0] if lengths else shingle
        asked = placed.withColumn("n", F.lit(n)).withColumn("hash", hashed(n))
    same = (F.col("hash") == F.col("known_hash")) & (F.col("n") == F.size("known_words"))
    for i in range(shingle):
        same &= (F.col("n") <= i) | (F.col(f"w{i}") == F.get("known_words", F.lit(i)))
    listed = _bounded(known.select("sid", F.col("hash").alias("known_hash"), F.col("words").alias("known_words")))
    begins = (F.coalesce("pos", F.lit(0)) == 0) & (F.col("n") == (lengths[-1] if lengths else shingle))
    met = asked.join(listed, same, "left").filter(F.col("sid").isNotNull() | begins)
    # a document's first place also stands for the document itself
    kinds = F.array_compact(F.array(
        F.when(F.col("sid").isNotNull(), F.struct(F.col("pos"), F.col("sid"))),
        F.when(begins, F.struct(F.lit(None).cast("int").alias("pos"), F.lit(None).cast("long").alias("sid"))),
    ))
    return met.select("row", "key", "n_words", F.explode(kinds).alias("at")).select("row", "key", "n_words", "at.pos", "at.sid")


def occurrences(
    docs: DataFrame, texts: DataFrame, key: str = "doc_id", text: str = "text",
    window: int = WINDOW, shingle: int = SHINGLE, containment: float = CONTAINMENT,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: documents (row, key, n_words); occurrences (row, start, size, wid, shared,
    shingles) of the windows of ``texts`` (see :func:`item_texts`); windows (gid, wid)."""
    if not 0 < containment <= 1 or not 0 < shingle <= window:
        raise ValueError("containment is a share, and a shingle fits into a window")
    cut = windows_of(texts, window)
    windows = written(cut.select("w").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    length = F.least(F.lit(shingle), F.size("w"))
    shingles = F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.slice("w", i, length))
    placed = windows.select("wid", F.size("w").alias("size"), F.posexplode(shingles).alias("offset", "words"))
    known = written(
        placed.select("words").distinct().select("words", F.xxhash64("words").alias("hash"), F.monotonically_increasing_id().alias("sid")),
        "shingles",
    )
    met = written(_meetings(docs, key, text, known, shingle), "meetings")
    hits = met.filter(F.col("sid").isNotNull())
    rarity = hits.groupBy("sid").agg(F.count("*").alias("times"))
    ordered = placed.join(known.select("words", "sid"), "words").join(rarity, "sid", "left").select(
        "wid", "size", "offset", "sid", F.coalesce("times", F.lit(0)).alias("times")
    )
    sets = ordered.groupBy("wid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("offset", "sid"))), lambda x: x["sid"]).alias("sids")
    )
    rarest = Window.partitionBy("wid").orderBy("times", "sid", "offset")
    prefix = written(
        ordered.withColumn("place", F.row_number().over(rarest)).join(sets, "wid")
        .withColumn("need", _need(F.size("sids"), containment))
        .filter((F.col("place") <= F.size("sids") - F.col("need") + 1) & (F.col("times") > 0))
        .select("sid", "wid", "offset", "size", "sids", "need"),
        "prefix",
    )
    # only the meetings of a document that has some window's prefix are looked at again
    marked = hits.join(_bounded(prefix.select("sid").distinct().withColumn("is_prefix", F.lit(True))), "sid", "left")
    reach = Window.partitionBy("row").orderBy("pos").rangeBetween(-(window - 1), window - 1)
    around = marked.withColumn("around", F.collect_list(F.struct("pos", "sid")).over(reach)).filter("is_prefix")
    start = F.col("pos") - F.col("offset")
    shared = F.size(F.filter("around", lambda x: F.get("sids", x["pos"] - F.col("start")) == x["sid"]))
    found = (
        around.join(_bounded(prefix), "sid")
        .withColumn("start", start).filter((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
        .withColumn("shared", shared).filter(F.col("shared") >= F.col("need"))
        .select("row", "start", "size", "wid", "shared", F.size("sids").alias("shingles")).distinct()
    )
    owners = written(cut.join(windows, "w").select("gid", "wid").distinct(), "owners")
    return met.filter(F.col("sid").isNull()).select("row", "key", "n_words"), written(found, "occurrences"), owners


def covered_words(found: DataFrame) -> DataFrame:
    """(row, n_hit): words of a document inside any occurrence."""
    spans = found.groupBy("row", "start").agg(F.max("size").alias("size"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    return (
        spans.withColumn("new", F.greatest(F.lit(0), end - F.greatest("start", reached)))
        .groupBy("row").agg(F.sum("new").cast("long").alias("n_hit"))
    )


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", **how,
) -> DataFrame:
    """Rows (key, n_words, n_hit, items) for every row of ``docs``: the hit words, and the sorted
    ids of the items that have occurring windows."""
    texts = item_texts(items, item, item_text)
    rows, found, owners = occurrences(docs, texts, key, text, **how)
    touched = found.select("row", "wid").distinct().join(_bounded(owners), "wid").select("row", "gid").distinct()
    listed = touched.join(_bounded(texts.select("gid", "ids")), "gid").groupBy("row").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items")
    )
    none = F.array().cast("array<string>")
    return (
        rows.join(covered_words(found), "row", "left").join(listed, "row", "left")
        .select(F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"))
    )
