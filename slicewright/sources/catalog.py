"""Table catalog.

The jobs never open files themselves: they take a :class:`Tables` mapping from the
logical table name (``stg_so_detail``, ``d_part``, ``f_invoice`` ...) to a DataFrame.
In production the mapping points at catalog tables or Parquet paths; in tests and in
``__spark_entry__`` it is built from the TPC-H-style test tables by
:func:`fixture_tables`, with explicit schemas (nothing inferred).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from slicewright.sources.fixture_sql import BY_NAME, LI_SQL

#: The rows of ``LI_SQL``; the orders meet their customers before the line items, which are then
#: shuffled once, by order, and stay dealt by it.
ORDERS_FIRST = LI_SQL.split(" from ")[0] + (
    " from lineitem l join (orders o join customer c on o.o_custkey=c.c_custkey join nation n on "
    "c.c_nationkey=n.n_nationkey) on l.l_orderkey=o.o_orderkey"
)
BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the store that Spark reads it from."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def spark_type(t: str) -> str:
    """Fixture type name → Spark SQL type (all timestamps are zone-less)."""
    return "timestamp_ntz" if t in ("timestamp", "timestamp_ntz") else t


class Tables(Mapping[str, DataFrame]):
    """Lazy name → DataFrame mapping; each table is built at most once."""

    def __init__(self, factories: Mapping[str, Callable[[], DataFrame]]):
        self._factories = dict(factories)
        self._built: dict[str, DataFrame] = {}
        self._entity_cache: dict = {}  # derived per catalog, see operators.entity
        self.bucketed: frozenset[str] = frozenset()  # tables that are stored by bucket, see sources.bucketing

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)

    def with_table(self, name: str, df: DataFrame) -> Tables:
        """A copy of the catalog where ``name`` points at ``df``."""
        f = dict(self._factories)
        f[name] = lambda: df
        out = Tables(f)
        out._built = {k: v for k, v in self._built.items() if k != name}
        if name not in ("stg_department", "stg_division", "stg_sys_companies"):
            out._entity_cache = self._entity_cache
        out._built[name] = df
        out.bucketed = self.bucketed - {name}
        return out

    @staticmethod
    def from_parquet(spark: SparkSession, root: str, names: list[str]) -> Tables:
        """Catalog over ``<root>/<name>`` Parquet folders or files."""

        def reader(n: str) -> Callable[[], DataFrame]:
            def read() -> DataFrame:
                p = f"{root.rstrip('/')}/{n}"
                return spark.read.parquet(p if path_exists(spark, p) else f"{p}.parquet")

            return read

        return Tables({n: reader(n) for n in names})


def _suffix(sf_dir: str) -> str:
    import hashlib

    return hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10]


def read_base(spark: SparkSession, sf_dir: str, suffix: str = "") -> dict[str, DataFrame]:
    """Read the base test tables and register them as temp views (``name + suffix``)."""
    out = {}
    for t in BASE_TABLES:
        df = spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet"))
        df.createOrReplaceTempView(t + suffix)
        out[t] = df
    return out


def _rename_views(sql: str, suffix: str) -> str:
    import re

    for t in (*BASE_TABLES, "li"):
        sql = re.sub(rf"\b{t}\b(?!\.)", t + suffix, sql)
    return sql


def _typed(spark: SparkSession, name: str, suffix: str) -> DataFrame:
    fx = BY_NAME[name]
    raw = spark.sql(_rename_views(fx.sql.format(ts="timestamp_ntz", unnest="explode"), suffix))
    return raw.selectExpr(*[f"cast(`{c}` as {spark_type(t)}) as `{c}`" for c, t in fx.columns])


def fixture_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Staging, dimension and seed-fact relations derived from ``sf_dir``'s tables.

    Each relation is analysed on first use only.  Its temp views carry a suffix
    derived from the folder, so catalogs of two folders in one session never mix.
    """
    sfx = "_" + _suffix(sf_dir)
    read_base(spark, sf_dir, sfx)
    spark.sql(_rename_views(ORDERS_FIRST, sfx)).createOrReplaceTempView("li" + sfx)
    return Tables({n: (lambda n=n: _typed(spark, n, sfx)) for n in BY_NAME})
