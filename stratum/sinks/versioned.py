"""Parquet tables in versions: atomic replacement and keyed merge by whole files.

Data files lie under ``<root>/version=<n>-<attempt>/<partitions>/`` and are never
changed. ``<root>/_manifest/<n>.json`` lists the files of version n. Writing a version
is: write its new files, then create its manifest. Until the manifest is whole, readers
resolve the version before, so a run that dies at any step leaves the table as it was;
its folder is removed by a later :func:`vacuum`. A manifest is created only if there is
none of that number, so of two concurrent writers one fails and changes nothing.

* :func:`replace` - the table becomes these rows.
* :func:`append` - these rows are added.
* :func:`merge` - keyed upsert by copy-on-write of files: the update rows are written
  first; only live files in the same partition directories are searched for their
  keys (a semi-join that yields file paths), and only files that hold one are
  rewritten without those rows. All other files stay, by name, in the next version.

The lists of files go through the driver, as they do in any listing of a table.
Partition directories are spelled so that ``''`` and NULL stay apart.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.session import create_file, delete_path, list_dirs, list_files, read_file
from stratum.sinks import partitions
from stratum.sinks.files import write_parquet

MANIFESTS = "_manifest"


@dataclass(frozen=True)
class Version:
    """A manifest: live files (relative to the root) and the writer's notes."""

    number: int
    files: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    notes: Mapping[str, Any] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"files": self.files, "partition_by": self.partition_by, "notes": dict(self.notes)})


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all manifests, whole or not, the newest first."""
    names = list_files(spark, f"{root}/{MANIFESTS}")
    return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def _load(spark: SparkSession, root: str, number: int) -> Version | None:
    """The version, or None if its manifest was never finished."""
    text = read_file(spark, f"{root}/{MANIFESTS}/{number}.json")
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return Version(number, tuple(found["files"]), tuple(found["partition_by"]), found["notes"])


def current(spark: SparkSession, root: str) -> Version | None:
    """The newest whole version; None if the folder has none."""
    return next((v for n in _numbers(spark, root) if (v := _load(spark, root, n))), None)


def _files(spark: SparkSession, root: str, names: Sequence[str], schema: StructType, partition_by: Sequence[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", root)
    return partitions.decode(reader.parquet(*[f"{root}/{unquote(n)}" for n in names]), partition_by)


def read(spark: SparkSession, root: str, schema: StructType, version: Version | None = None) -> DataFrame:
    """Rows of a version (the current one by default), with the columns of ``schema``."""
    version = version or current(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version of a table at {root}")
    return _files(spark, root, version.files, schema, version.partition_by).select(*schema.fieldNames())


def _new_folder(number: int) -> str:
    return f"version={number}-{uuid.uuid4().hex[:12]}"


def _write(spark: SparkSession, df: DataFrame, root: str, folder: str, partition_by: Sequence[str]) -> None:
    write_parquet(partitions.encode(df, partition_by), f"{root}/{folder}", mode="append", partition_by=partition_by)


def _written(spark: SparkSession, root: str, folder: str, schema: StructType) -> tuple[str, ...]:
    """Files of a version's folder, relative to the root, as Spark spells their paths."""
    found = spark.read.schema(schema).parquet(f"{root}/{folder}").inputFiles()
    return tuple(sorted(folder + f.split(f"/{folder}", 1)[1] for f in found))


def _commit(spark: SparkSession, root: str, version: Version) -> None:
    create_file(spark, f"{root}/{MANIFESTS}/{version.number}.json", version.text())


def _next_number(spark: SparkSession, root: str) -> int:
    numbers = _numbers(spark, root)
    return numbers[0] + 1 if numbers else 1


def replace(
    spark: SparkSession,
    root: str,
    df: DataFrame,
    *,
    partition_by: Sequence[str] = (),
    notes: Mapping[str, Any] | None = None,
    keep: int = 2,
) -> Version:
    """The table becomes the rows of ``df``; the ``keep`` newest versions stay readable."""
    number = _next_number(spark, root)
    folder = _new_folder(number)
    _write(spark, df, root, folder, partition_by)
    version = Version(number, _written(spark, root, folder, df.schema), tuple(partition_by), notes or {})
    _commit(spark, root, version)
    vacuum(spark, root, keep)
    return version


def append(
    spark: SparkSession,
    root: str,
    df: DataFrame,
    *,
    partition_by: Sequence[str] = (),
    notes: Mapping[str, Any] | None = None,
    keep: int = 2,
) -> Version:
    """The current files and those of ``df``: rows and notes change in one step."""
    base = current(spark, root)
    partition_by = base.partition_by if base else tuple(partition_by)
    number = _next_number(spark, root)
    folder = _new_folder(number)
    _write(spark, df, root, folder, partition_by)
    files = (*(base.files if base else ()), *_written(spark, root, folder, df.schema))
    version = Version(number, files, partition_by, notes if notes is not None else base.notes if base else {})
    _commit(spark, root, version)
    vacuum(spark, root, keep)
    return version


def _keys_equal(a: DataFrame, b: DataFrame, key: Sequence[str]):
    return [a[k].eqNullSafe(b[f"__{k}"]) for k in key]


def merge(
    spark: SparkSession,
    root: str,
    updates: DataFrame,
    key: Sequence[str],
    *,
    schema: StructType,
    partition_by: Sequence[str] = (),
    notes: Mapping[str, Any] | None = None,
    keep: int = 2,
) -> Version:
    """Rows of ``updates`` replace those of equal key (nulls are equal); others are added.

    Raises if two update rows share a key, and changes nothing then. The table keeps
    its partitioning; ``partition_by`` is that of a table that doesn't exist yet.
    """
    base = current(spark, root)
    partition_by = base.partition_by if base else tuple(partition_by)
    if outside := set(partition_by) - set(key):
        raise ValueError(f"partition columns {sorted(outside)} are not in the key: a row that "
                         "changes partition would stay in its old one")
    columns = schema.fieldNames()
    number = _next_number(spark, root)
    folder = _new_folder(number)
    _write(spark, updates.select(*columns), root, folder, partition_by)
    added = _written(spark, root, folder, schema)
    # from here on the updates are read from their files, their plan runs once
    keys = _files(spark, root, added, schema, partition_by).select(*[F.col(k).alias(f"__{k}") for k in key])
    twice = keys.groupBy(*keys.columns).count().where(F.col("count") > 1).drop("count").first()
    if twice is not None:
        raise ValueError(f"two update rows share the key {tuple(twice)}; pick one, e.g. by merge.latest_per_key")
    live = base.files if base else ()
    hit = _touched(spark, root, live, added, keys, key, schema, partition_by)
    if hit:
        rows = _files(spark, root, hit, schema, partition_by).select(*columns)
        kept = rows.join(keys, _keys_equal(rows, keys, key), "left_anti")
        _write(spark, kept, root, folder, partition_by)
        added = _written(spark, root, folder, schema)
    gone = set(hit)
    files = (*[f for f in live if f not in gone], *added)
    version = Version(number, files, partition_by, notes if notes is not None else base.notes if base else {})
    _commit(spark, root, version)
    vacuum(spark, root, keep)
    return version


def _directory(file: str) -> str:
    """A file's partition directories, without the version's and its own name."""
    return file.split("/", 1)[1].rpartition("/")[0]


def _touched(spark, root, live, added, keys, key, schema, partition_by) -> list[str]:
    """Live files that hold a key of the updates; only the updates' partitions are read."""
    places = {_directory(f) for f in added}
    near = [f for f in live if _directory(f) in places]
    if not near:
        return []
    rows = _files(spark, root, near, schema, partition_by).select(*key, F.col("_metadata.file_path").alias("__file"))
    found = rows.join(keys, _keys_equal(rows, keys, key), "left_semi").select("__file").distinct()
    names = {"version=" + r[0].rsplit("/version=", 1)[1] for r in found.toLocalIterator()}  # at most len(near)
    return [f for f in near if f in names]


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete what the ``keep`` newest versions don't list; returns what was removed.

    Manifests go first, so no reader resolves a version whose files are going. Folders
    of numbers above the current version may belong to a writer at work and stay.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    whole = [v for n in _numbers(spark, root) if (v := _load(spark, root, n))]
    if not whole:
        return []
    kept, newest = whole[:keep], whole[0].number
    live = {f for v in kept for f in v.files}
    folders = {f.split("/", 1)[0] for f in live}
    removed = [f"{root}/{MANIFESTS}/{v.number}.json" for v in whole[keep:]]
    listed = {f for v in whole[keep:] for f in v.files} - live
    for name in list_dirs(spark, root):
        number = name.removeprefix("version=").split("-", 1)[0]
        if name.startswith("version=") and number.isdigit() and int(number) <= newest and name not in folders:
            removed.append(f"{root}/{name}")
    removed += [f"{root}/{unquote(f)}" for f in sorted(listed) if f.split("/", 1)[0] in folders]
    for path in removed:
        delete_path(spark, path)
    return removed
