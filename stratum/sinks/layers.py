"""Layers whose files were written over time, read against a declared schema.

Files of a layer may lack columns that were declared later, hold columns that nobody
declared, or store a column with another type. ``read_reconciled`` takes the union of
all files' footers and gives back the declared columns first, in order and type, then
the others; what differed is said in a :class:`Differences`.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


@dataclass(frozen=True)
class Differences:
    """``missing``: declared, in no file (read as NULL). ``added``: not declared (kept).
    ``clashes``: (column, declared, stored type); values that the declared type can't
    hold read as NULL. ``empty``: there are no files."""

    missing: tuple[str, ...] = ()
    added: tuple[str, ...] = ()
    clashes: tuple[tuple[str, str, str], ...] = ()
    empty: bool = False


def stored_schema(spark: SparkSession, path: str, partition_by: Sequence[str]) -> StructType | None:
    """Union of the footers' schemas without the directory columns; None without files.

    Raises if two files store one column with types that have no common one.
    """
    try:
        found = spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
    return StructType([f for f in found.fields if f.name not in partition_by])


def read_reconciled(
    spark: SparkSession, path: str, declared: StructType, partition_by: Sequence[str] = ()
) -> tuple[DataFrame, Differences]:
    """The rows at ``path`` with the declared columns, then those that only the files have.

    ``partition_by`` names the columns that directories hold: they are read with their
    declared type, whatever their values look like (``segment=1`` stays text).
    """
    stored = stored_schema(spark, path, partition_by)
    if stored is None:
        return spark.createDataFrame([], declared), Differences(missing=tuple(declared.fieldNames()), empty=True)
    types = {f.name: f.dataType for f in stored.fields}
    places = [StructField(c, declared[c].dataType) for c in partition_by]
    rows = spark.read.schema(StructType([*stored.fields, *places])).parquet(path)
    added = [f.name for f in stored.fields if f.name not in declared.fieldNames()]
    missing = [f.name for f in declared.fields if f.name not in types and f.name not in partition_by]
    clashes = [
        (f.name, f.dataType.simpleString(), types[f.name].simpleString())
        for f in declared.fields if f.name in types and types[f.name] != f.dataType
    ]
    changed = {c for c, _, _ in clashes}

    def column(f: StructField):
        if f.name in missing:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in changed else F.col(f.name)

    return rows.select(*map(column, declared.fields), *added), Differences(tuple(missing), tuple(added), tuple(clashes))
