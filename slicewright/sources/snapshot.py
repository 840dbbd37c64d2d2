"""Versions of a fact table on shared storage.

A version is a manifest: the table's schema and, for each division and department bucket,
the folder that holds its rows (for each division alone, if the table has no department).
A job writes only the folders whose rows it changes, under a name that is never used
again, and its manifest points to the earlier folders for the rest.  Rows that move to a
folder which the job doesn't read are added beside it.  ``_CURRENT`` names the current manifest and is replaced by one overwriting
rename, as the last step; until then, and after any failure, the previous version
is current and whole.  Manifests without a pointer mean that the pointer was lost,
which is an error, not an empty table.

One writer per table at a time is assumed.  The overwriting rename is atomic on HDFS
and local file systems; object stores need a committer of their own.
:func:`retain` removes what the latest versions don't use.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.operators.broadcast import estimated_bytes
from slicewright.session import STORED, frees_shuffles

POINTER = "_CURRENT"
PARTITION = "DivisionId"
DEPARTMENT = "DPT_AUTO_KEY"
#: Derived from the department at each write; readers don't see it.
BUCKET = "DeptBucket"
#: Names the folders of one write; no table may have a column of this name.  (Tables written as
#: ``v=...`` are still read.)
WRITE = "SnapshotWrite"
BUCKETS = 16
#: Rows read from files are published by tasks that read this much.
BYTES_A_TASK = 64 << 20
#: Marks a folder that was added beside another of its name.
_BESIDE = "+"


class LostPointerError(RuntimeError):
    """Versions exist, but none is marked as current."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    folders: dict[str, str]  # partition folder name → folder below the root
    note: dict = field(default_factory=dict)  # what the writer says about the version
    changes: str | None = None  # folder of the rows that differ from the version before
    name: str = ""  # of the manifest
    parent: str | None = None  # manifest of the version before


def _files(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(conf), path, jvm, conf


def _read_text(spark: SparkSession, where: str) -> str | None:
    fs, path, jvm, _ = _files(spark, where)
    if not fs.exists(path(where)):
        return None
    stream = fs.open(path(where))
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, where: str, text: str) -> None:
    fs, path, _, _ = _files(spark, where)
    stream = fs.create(path(where), False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_json(spark: SparkSession, where: str) -> dict | None:
    """A small record; None if there is none."""
    text = _read_text(spark, where)
    return None if text is None else json.loads(text)


def write_json(spark: SparkSession, where: str, record: dict) -> None:
    """Write or replace a record in one rename."""
    folder, name = where.rsplit("/", 1)
    _replace(spark, folder, name, json.dumps(record))


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path, _, _ = _files(spark, folder)
    if not fs.exists(path(folder)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path(folder)))


def _version(spark: SparkSession, root: str, name: str) -> Version:
    found = json.loads(_read_text(spark, f"{root}/manifests/{name}"))
    return Version(
        found["number"], T.StructType.fromJson(found["schema"]), found["folders"], found.get("note", {}),
        found.get("changes"), name, found.get("parent"),
    )


def current(spark: SparkSession, root: str) -> Version | None:
    """The current version, or None if nothing was ever published."""
    name = _read_text(spark, f"{root}/{POINTER}")
    if name is not None:
        return _version(spark, root, name.strip())
    if any(n.endswith(".json") for n in _names(spark, f"{root}/manifests")):
        raise LostPointerError(f"{root}: versions exist, but {POINTER} is missing")
    return None


def published_by(spark: SparkSession, root: str, run: str) -> Version | None:
    """The version that a run published, the current one or an ancestor of it that is kept."""
    version = current(spark, root)
    while version is not None and version.note.get("run") != run:
        older = version.parent
        version = _version(spark, root, older) if older and older in _names(spark, f"{root}/manifests") else None
    return version


def read_changes(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame | None:
    """The stored changes of a version (default: the current one); None if it has none."""
    version = version or current(spark, root)
    return spark.read.parquet(f"{root}/{version.changes}") if version and version.changes else None


def partition_folder(value: object, by: str = PARTITION) -> str:
    return f"{by}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def bucket_of(department: int | None) -> int:
    return (-1 if department is None else int(department)) % BUCKETS


def bucket_column(department: str = DEPARTMENT) -> Column:
    return F.pmod(F.coalesce(F.col(department).cast("long"), F.lit(-1)), F.lit(BUCKETS)).cast("int")


def folder_name(division: object, bucket: int | None = None) -> str:
    return partition_folder(division) + ("" if bucket is None else f"/{BUCKET}={bucket}")


def plain(name: str) -> str:
    """A folder's division and bucket."""
    return name.split(_BESIDE)[0]


def folders_in(version: Version | None, division: object, departments: Iterable[int | None] | None = None) -> set[str]:
    """Names of the folders that can hold rows of a division (and of some departments)."""
    of_division = {n for n in version.folders if plain(n).split("/")[0] == partition_folder(division)} if version else set()
    if departments is None:
        return of_division
    wanted = {partition_folder(division), *(folder_name(division, bucket_of(d)) for d in departments)}
    return {n for n in of_division if plain(n) in wanted}


def read_current(
    spark: SparkSession, root: str, only: Iterable[object] | None = None, without: Iterable[object] = (),
    names: Iterable[str] | None = None,
) -> DataFrame | None:
    """The current rows, or those of some divisions or of the folders ``names``; None if nothing
    was ever published."""
    version = current(spark, root)
    if version is None:
        return None
    wanted = set(version.folders) if names is None else set(names)
    if only is not None:
        wanted &= set().union(*(folders_in(version, v) for v in only))
    wanted -= set().union(*(folders_in(version, v) for v in without))
    return _read(spark, root, version, wanted)


def _read(spark: SparkSession, root: str, version: Version, names: Iterable[str]) -> DataFrame:
    alike: dict[tuple[str, bool], list[str]] = {}  # by folder columns: the version's, the bucket
    for n in sorted(names):
        written_as = version.folders[n].split("/")[1].split("=")[0]
        alike.setdefault((written_as, "/" in plain(n)), []).append(f"{root}/{version.folders[n]}")
    parts = []
    for (written_as, bucketed), paths in alike.items():
        fields = [T.StructField(written_as, T.StringType())] + [T.StructField(BUCKET, T.IntegerType())] * bucketed
        schema = T.StructType([*version.schema.fields, *fields])
        rows = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*paths)
        parts.append(rows.select(*version.schema.names))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], version.schema)


@frees_shuffles
def publish(
    spark: SparkSession, df: DataFrame, root: str, touched: Iterable[object] | None = None,
    names: Iterable[str] | Callable[[], Iterable[str]] | None = None, beside: bool = False, by: str = PARTITION,
    note: dict | Callable[[], dict] | None = None, changes: str | None = None, as_dealt: bool = False,
    from_files: bool = False,
) -> Version | None:
    """Make a new version current: ``df`` replaces the divisions ``touched``, or the folders
    ``names``, or all (if both are None); the rest stays where it is.  Rows for other folders
    are refused, or with ``beside`` added beside what those hold.

    ``names`` may be a function, called once the rows are written: of these, only its folders count
    then, and the others are removed again (without any, there is no new version).

    With ``by`` the folders go by that column instead of division and department; rows that lie by
    it already are written ``as_dealt``, else those of a folder are brought together.  Rows that go by
    division and department are stored as they come, unless they are read ``from_files`` (as they are, or
    filtered), and aren't shuffled: tasks of ``BYTES_A_TASK`` of the files write a file for each folder
    that they meet.  (Stored rows are a third of the shuffled ones or less.)  ``note``
    (or what it returns once the rows are written) and ``changes`` (a folder below the root)
    are kept in the manifest."""
    before = current(spark, root)
    folder = f"data/{WRITE}={uuid.uuid4().hex}"
    levels = [by]
    out, staged = df, None
    if as_dealt:
        pass
    elif by != PARTITION:
        out = df.hint("rebalance", F.col(by))
    elif DEPARTMENT in df.columns:
        levels.append(BUCKET)
        if not from_files:
            # below data: `retain` removes what a stopped job left there
            staged = f"{root}/data/rows-{uuid.uuid4().hex}"
            df.write.mode("errorifexists").options(**STORED).parquet(staged)
            out = spark.read.schema(df.schema).parquet(staged)
        # rows of a folder meet in few files
        tasks = -(-estimated_bytes(out) // BYTES_A_TASK) or 1
        out = out.withColumn(BUCKET, bucket_column()).coalesce(tasks)
    stored = out.write.mode("errorifexists").options(**STORED).option("partitionOverwriteMode", "static")
    stored.partitionBy(*levels).parquet(f"{root}/{folder}")
    if staged is not None:
        fs, path, _, _ = _files(spark, root)
        fs.delete(path(staged), True)
    listed = [n for n in _names(spark, f"{root}/{folder}") if n.startswith(f"{by}=")]
    if len(levels) > 1:
        listed = [f"{n}/{m}" for n in listed for m in _names(spark, f"{root}/{folder}/{n}") if m.startswith(f"{BUCKET}=")]
    if callable(names):
        names = set(names())
        fs, path, _, _ = _files(spark, root)
        for n in set(listed) - names:
            fs.delete(path(f"{root}/{folder}/{n}"), True)
        if not names:
            fs.delete(path(f"{root}/{folder}"), True)
            return None
        listed = [n for n in listed if n in names]
    written = {n: f"{folder}/{n}" for n in listed}
    kept: dict[str, str] = {}
    if before is not None and (touched is not None or names is not None):
        if names is not None:
            gone, replaced = set(names), {plain(n) for n in names}
            outside = {n for n in written if n not in replaced and any(plain(o) == n for o in before.folders)}
        else:
            divisions = {partition_folder(v) for v in touched}
            gone = {n for n in before.folders if plain(n).split("/")[0] in divisions}
            outside = {n for n in written if n.split("/")[0] not in divisions}
        if outside and not beside:
            raise ValueError(f"rows outside the folders of this load: {sorted(outside)}")
        kept = {n: f for n, f in before.folders.items() if n not in gone}
        written = {f"{n}{_BESIDE}{uuid.uuid4().hex[:8]}" if n in outside else n: f for n, f in written.items()}
    number = before.number + 1 if before else 1
    name = f"{number:08d}-{uuid.uuid4().hex}.json"
    version = Version(number, df.schema, kept | written, (note() if callable(note) else note) or {}, changes, name, before.name if before else None)
    text = json.dumps({
        "number": number, "schema": df.schema.jsonValue(), "folders": version.folders,
        "note": version.note, "changes": changes, "parent": version.parent,
    })
    _write_text(spark, f"{root}/manifests/{name}", text)
    _point_to(spark, root, name)
    return version


def _point_to(spark: SparkSession, root: str, name: str) -> None:
    _replace(spark, root, POINTER, name)


def _replace(spark: SparkSession, root: str, file: str, text: str) -> None:
    """Write ``file`` below ``root``, over what is there, by one rename."""
    _, path, jvm, conf = _files(spark, root)
    fresh = f"{root}/.{file}-{uuid.uuid4().hex}"
    _write_text(spark, fresh, text)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(root).getFileSystem(conf).getUri(), conf)
    qualified = lambda p: path(root).getFileSystem(conf).makeQualified(path(p))
    files.rename(qualified(fresh), qualified(f"{root}/{file}"), options)


def retain(spark: SparkSession, root: str, versions: int = 2) -> list[str]:
    """Remove data and change folders that none of the latest ``versions`` manifests uses, and the
    older manifests; returns the removed data folders.  Not for use while a load runs."""
    fs, path, _, _ = _files(spark, root)
    names = [n for n in _names(spark, f"{root}/manifests") if n.endswith(".json")]
    latest = names[-max(1, versions):]
    pointed = (_read_text(spark, f"{root}/{POINTER}") or "").strip()
    kept = [_version(spark, root, n) for n in {*latest, pointed} if n]
    used = {f.split("/")[1] for v in kept for f in v.folders.values()}
    for n in set(_names(spark, f"{root}/changes")) - {v.changes.split("/")[1] for v in kept if v.changes}:
        fs.delete(path(f"{root}/changes/{n}"), True)
    gone = [n for n in _names(spark, f"{root}/data") if n not in used]
    for n in gone:
        fs.delete(path(f"{root}/data/{n}"), True)
    for n in set(names) - {*latest, pointed}:
        fs.delete(path(f"{root}/manifests/{n}"), False)
    return gone
