"""Intermediate tables on the folder that all executors share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from weakref import WeakSet

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: WeakSet = WeakSet()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  A scratch folder stands in only on a local
    master (tests); on a cluster a missing setting is an error, as executors would write to
    folders that the others can't see."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-scratch-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: its lineage
    ends there, and losing an executor later costs nothing that came before."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession) -> SparkSession:
    """Make the package importable for the Python workers, unless the folder that holds it is
    on their path already (PYTHONPATH, or the folder the session was started in)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p] + [os.getcwd()]
    if root not in map(os.path.abspath, known) and spark not in _SHIPPED:
        folder = tempfile.mkdtemp(prefix="llm-package-")
        archive = shutil.make_archive(f"{folder}/package", "zip", root, "slicewright")
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(spark)
    return spark


def plainly_named(docs: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns named by their place, and the new names of the columns ``used``:
    whatever else the table has can't clash with what an operator adds."""
    names = [f"in_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), [names[docs.columns.index(c)] for c in used]
