"""Nearest neighbours by an adaptive scan over the dimensions of probed lists.

Largest inner products become smallest distances by one more coordinate (``sqrt(M^2 - |x|^2)``
for rows, 0 for queries).  A random rotation spreads the distance evenly over the dimensions,
and rows are kept in column blocks of it, in the inverted list of their nearest centre.  A
query visits its nearest lists, and twice as many each time that these hold too few other rows,
at last all.  In a list the distance to each row is summed block by block;
after each block a row is abandoned if, by the hypothesis test for a random rotation, its
whole distance exceeds the query's current 20th best with high confidence: partial distance
times D/d above ``(1 + EPSILON / sqrt(d))^2`` times the bound.  The rows left are scored by
the exact inner product of the original vectors in double precision.

Lists are cut into parts of a bounded number of rows, so that a list that holds a third of
all rows (copies of one vector) is many tasks' work.  Each part returns a query's best few,
which are merged per query.  Centres are fitted on at most ``FIT_ROWS`` rows, the rotation is
drawn from a seed; both are matrices bounded by parameters.

Defined results
  null, zero and non-finite vectors, and those whose length isn't the most common one, take
  no part, as queries or as rows; ties go to the smaller id; an id that several rows have is
  listed once, with its best score, and is one query; a query never finds its own id; null
  ids take no part; fewer candidates than asked for: all of them; empty
  table: empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.llm._store import written

NEAREST = 20
FIT_ROWS = 20_000
MAX_LISTS = 4_096
#: The number of lists that a query visits is chosen on so many sampled queries, to find this
#: share of their neighbours in the sample.
FIT_QUERIES = 256
FIT_RECALL = 0.97
PART_ROWS = 4_096
PART_QUERIES = 8_192
#: Queries that are scanned at once.
QUERY_ROWS = 256
#: Where an id has more rows than this in a part, all of the part's rows are scored.
MOST_REPEATS = 4
BLOCK_DIMS = 16
EPSILON = 2.1
SEED = 7


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): rows whose vectors take part."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    common = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    return rows.filter(F.size("v") == (common["n"] if common else 0))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class Space:
    """The rotated space: centres of the lists, and how vectors are put into it."""

    def __init__(self, sample: np.ndarray, longest: float, rows: int, lists: int | None = None):
        rng = np.random.default_rng(SEED)
        self.dims = sample.shape[1]
        self.longest = longest
        q, r = np.linalg.qr(rng.standard_normal((self.dims + 1, self.dims + 1)))
        self.rotation = q * np.sign(np.diag(r))
        x = self.place(sample)
        count = lists or max(1, min(MAX_LISTS, int(np.sqrt(rows)), len(np.unique(x, axis=0))))
        self.centres = x[rng.choice(len(x), count, replace=False)] if len(x) else x
        for _ in range(8):
            of = self.nearest(x, 1)[:, 0]
            n = np.bincount(of, minlength=count)
            sums = np.zeros_like(self.centres)
            np.add.at(sums, of, x)
            self.centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], self.centres)
        self.probed = self._probes(sample, x, rng)

    def _probes(self, sample: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> int:
        """Lists to visit so that the share FIT_RECALL of true neighbours in the sample is met.
        Neighbours in the whole table are nearer, so they are in nearer lists."""
        picked = rng.choice(len(x), min(len(x), FIT_QUERIES), replace=False)
        placed = self.place(sample[picked], query=True)
        score = sample[picked] @ sample.T
        score[np.arange(len(picked)), picked] = -np.inf
        best = np.argsort(-score, axis=1)[:, : min(NEAREST, len(x) - 1)]
        if not best.size:
            return len(self.centres)
        near = np.argsort((self.centres**2).sum(axis=1) - 2 * placed @ self.centres.T, axis=1)
        place = np.empty_like(near)
        np.put_along_axis(place, near, np.arange(near.shape[1])[None, :].repeat(len(near), 0), axis=1)
        wanted = np.take_along_axis(place, self.nearest(x, 1)[:, 0][best], axis=1)
        return int(np.quantile(wanted, FIT_RECALL, method="higher")) + 1

    def place(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        if query:
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            x = x / norm * self.longest  # its length doesn't change the order of its neighbours
            more = np.zeros(len(x))
        else:
            more = np.sqrt(np.maximum(0.0, self.longest**2 - (x * x).sum(axis=1)))
        return np.column_stack([x, more]) @ self.rotation

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        far = (self.centres**2).sum(axis=1) - 2 * x @ self.centres.T
        n = min(n, far.shape[1])
        return np.argpartition(far, n - 1, axis=1)[:, :n] if n < far.shape[1] else np.argsort(far, axis=1)


def adaptive_scan(queries: np.ndarray, rows: np.ndarray, bound_rows: int) -> np.ndarray:
    """Pairs (query, row) that no test abandons: a boolean matrix.  The bound of a query is its
    ``bound_rows``-th smallest whole distance among the rows nearest in the first two blocks."""
    dims = rows.shape[1]
    left = np.ones((len(queries), len(rows)), bool)
    if len(rows) <= bound_rows:
        return left
    part = np.zeros((len(queries), len(rows)))
    bound = np.full(len(queries), np.inf)
    for d in range(0, dims, BLOCK_DIMS):
        a, b = queries[:, d : d + BLOCK_DIMS], rows[:, d : d + BLOCK_DIMS]
        if d == 0 or left.mean() > 0.2:
            part += (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
        else:
            at = np.nonzero(left)
            part[at] += ((a[at[0]] - b[at[1]]) ** 2).sum(axis=1)
        seen = min(d + BLOCK_DIMS, dims)
        if d < 2 * BLOCK_DIMS:  # the rows that look nearest so far give the bound
            n = min(len(rows), 3 * bound_rows)
            pick = np.argpartition(np.where(left, part, np.inf), n - 1, axis=1)[:, :n]
            whole = ((queries[:, None, :] - rows[pick]) ** 2).sum(axis=2)
            bound = np.minimum(bound, np.partition(whole, bound_rows - 1, axis=1)[:, bound_rows - 1])
        slack = (1 + EPSILON / np.sqrt(seen)) ** 2 if seen < dims else 1 + 1e-9
        left &= part * (dims / seen) <= bound[:, None] * slack + 1e-9
    return left


def search(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST,
    lists: int | None = None, probed: int | None = None,
) -> DataFrame:
    """(query_id, rank, key, score): each query's nearest other rows.  ``is_query`` is a
    condition on a column ``id``."""
    rows = usable(vectors, key, vector)
    about = rows.agg(F.count("*").alias("rows"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("longest"), F.max(F.size("v")).alias("dims")).first()
    spark = vectors.sparkSession
    out = f"query_id long, rank int, {key} long, score double"
    if not about["rows"]:
        return spark.createDataFrame([], out)
    share = min(1.0, FIT_ROWS / about["rows"])
    fitted = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) <= int(share * (1 << 20))).select("v").limit(2 * FIT_ROWS)
    sample = np.array([r["v"] for r in fitted.collect()]).reshape(-1, about["dims"])
    if not len(sample):
        sample = np.array([rows.first()["v"]])
    space = Space(sample, about["longest"], about["rows"], lists)
    every = len(space.centres)
    probes = min(probed or space.probed, every)
    dims = space.dims

    placed = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField("list", T.IntegerType())])

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                of = space.nearest(space.place(_matrix(batch.column("v"), dims)), 1)[:, 0]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(of.astype(np.int32))], placed.names)

    indexed = written(rows.mapInArrow(assign, placed), "lists")
    from_zero = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    found = f"query_id long, {key} long, score double"

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, x = right.column("id").to_numpy(), _matrix(right.column("v"), dims) if right.num_rows else np.empty((0, dims))
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        rotated = space.place(x)
        repeats = int(np.unique(ids, return_counts=True)[1].max(initial=1))
        queries, q = left.column("id").to_numpy(), _matrix(left.column("v"), dims) if left.num_rows else np.empty((0, dims))
        made = []
        for a in range(0, len(queries) if len(ids) else 0, QUERY_ROWS):
            some = q[a : a + QUERY_ROWS]
            if repeats <= MOST_REPEATS:
                stays = adaptive_scan(space.place(some, query=True), rotated, (nearest + 1) * repeats)
            else:
                stays = np.ones((len(some), len(ids)), bool)
            for i in range(len(some)):
                at = np.flatnonzero(stays[i] & (ids != queries[a + i]))
                score = (x[at] * some[i]).sum(axis=1)
                best = np.lexsort((ids[at], -score))
                best = best[np.sort(np.unique(ids[at][best], return_index=True)[1])[:nearest]]
                made.append((np.full(len(best), queries[a + i]), ids[at][best], score[best]))
        columns = [np.concatenate([m[i] for m in made]) if made else np.empty(0) for i in range(3)]
        return pa.table([pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)), pa.array(columns[2].astype(float))], ["query_id", key, "score"])

    def nearest_in(queries: DataFrame, probes: int) -> DataFrame:
        """The best rows of the ``probes`` lists nearest to each query."""

        def probe(batches):
            for batch in batches:
                if batch.num_rows:
                    of = space.nearest(space.place(_matrix(batch.column("v"), dims), query=True), probes)
                    at = pa.array(np.repeat(np.arange(batch.num_rows), of.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(at), batch.column("v").take(at), pa.array(of.ravel().astype(np.int32))], placed.names
                    )

        asked = written(queries.mapInArrow(probe, placed), "probes")
        # a list's rows and its queries are cut into parts, and every pair of parts is a task's work
        sizes = written(
            indexed.groupBy("list").agg(F.ceil(F.count("*") / PART_ROWS).alias("parts"))
            .join(asked.groupBy("list").agg(F.ceil(F.count("*") / PART_QUERIES).alias("query_parts")), "list"),
            "sizes",
        )
        seekers = (
            asked.join(sizes, "list")
            .withColumn("query_part", F.pmod(F.xxhash64("id"), F.col("query_parts"))).withColumn("part", F.explode(from_zero(F.col("parts"))))
            .select("list", "part", "query_part", "id", "v")
        )
        sought = (
            indexed.join(sizes, "list")
            .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).withColumn("query_part", F.explode(from_zero(F.col("query_parts"))))
            .select(F.col("list").alias("in_list"), F.col("part").alias("in_part"), F.col("query_part").alias("for_part"), "id", "v")
        )
        hits = seekers.groupBy("list", "part", "query_part").cogroup(sought.groupBy("in_list", "in_part", "for_part")).applyInArrow(scan, found)
        hits = hits.groupBy("query_id", key).agg(F.max("score").alias("score"))  # repeated ids
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
        return (
            hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
            .select("query_id", "rank", key, "score")
        )

    queries = rows.filter(is_query)
    hits = written(nearest_in(queries, probes), "hits")
    done = None
    while probes < every:
        full = hits.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= nearest).select(F.col("query_id").alias("id"))
        queries = written(queries.join(full, "id", "left_anti"), "short")
        if queries.isEmpty():
            break
        enough = hits.join(full.withColumnRenamed("id", "query_id"), "query_id", "left_semi").select(*hits.columns)
        done = enough if done is None else done.union(enough)
        probes = min(2 * probes, every)
        hits = written(nearest_in(queries, probes), "hits")
    return hits if done is None else done.union(hits)
