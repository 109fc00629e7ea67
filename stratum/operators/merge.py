"""Keyed upsert (MERGE) for Parquet tables.

``upsert(current, updates, key)`` keeps every current row whose key is absent
from ``updates`` and takes all update rows: a null-safe left-anti join plus a
union. Spark turns the null-safe key equality into an equi-join, and AQE
picks broadcast only when the update side's measured size is under the
broadcast threshold, otherwise a shuffled join on the key. Duplicate keys in
``updates`` are resolved by ``latest_per_key`` with a partial ``max_by``
aggregation, so a hot key is reduced map-side instead of being gathered into
one task.

:func:`merge_into` applies that to a partitioned Parquet directory and
rewrites only the partitions the updates touch.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import path_exists, scratch
from stratum.sinks.files import write_parquet


def latest_per_key(df: DataFrame, key: Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the one with the greatest ``order_col``."""
    others = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order_col)).alias("__row")
    )
    return picked.select(*key, *[F.col(f"__row.{c}").alias(c) for c in others]).select(*df.columns)


def upsert(current: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """Current rows not replaced by ``updates``, plus all of ``updates``."""
    keys = updates.select(*[F.col(k).alias(f"__k_{k}") for k in key])
    cond = [current[k].eqNullSafe(keys[f"__k_{k}"]) for k in key]
    kept = current.join(keys, on=cond, how="left_anti")
    return kept.unionByName(updates.select(*current.columns))


def _exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def _touched_partitions(current: DataFrame, updates: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``current`` in partitions that ``updates`` touch.

    The distinct partition tuples of the updates are as many as the directories that
    the write replaces (which its commit lists as well), so they are fetched and become
    a filter of the scan: it lists and reads exactly these directories. One IN over the
    tuple; tuples that hold a null are compared null-safely.
    """
    found = [tuple(r) for r in updates.select(*partition_by).distinct().collect()]
    columns = [F.col(c) for c in partition_by]
    plain = [F.struct(*[F.lit(v) for v in row]) for row in found if None not in row]
    touched = F.struct(*columns).isin(*plain) if plain else F.lit(False)
    for row in found:
        if None in row:
            same = [c.isNull() if v is None else c == F.lit(v) for c, v in zip(columns, row)]
            touched = touched | reduce(Column.__and__, same)
    return current.filter(touched)


def _refuse_duplicates(updates: DataFrame, key: Sequence[str]) -> None:
    twice = updates.groupBy(*key).count().where(F.col("count") > 1).drop("count").first()
    if twice is not None:
        raise ValueError(f"two update rows share the key {tuple(twice)}; name an order_col to pick one")


def merge_into(
    spark: SparkSession,
    target: str,
    updates: DataFrame,
    key: Sequence[str],
    *,
    schema=None,
    partition_by: Sequence[str] = (),
    order_col: str | None = None,
) -> None:
    """MERGE ``updates`` into the Parquet table at ``target`` on ``key``.

    With ``partition_by``, only partitions present in ``updates`` are read
    (see :func:`_touched_partitions`) and rewritten with dynamic partition
    overwrite, which writes to a job staging folder and swaps partitions in
    only when every task has finished reading. An unpartitioned table is
    rewritten whole, from merged rows staged in the shared checkpoint folder
    first, because a plain overwrite would delete the files the plan still
    reads. Among duplicate update keys, ``order_col`` picks the greatest; without
    it they are an error. For plain directories that others read as they are; a
    reader that comes during the swap can see it half done. Tables of
    :mod:`stratum.sinks.versioned` merge by whole files and switch at once.
    """
    if outside := set(partition_by) - set(key):
        raise ValueError(f"partition columns {sorted(outside)} are not in the key: a row that "
                         "changes partition would stay in its old one")
    if order_col is not None:
        updates = latest_per_key(updates, key, order_col).drop(order_col)
    else:
        _refuse_duplicates(updates, key)
    if not _exists(spark, target):
        write_parquet(updates, target, mode="overwrite", partition_by=partition_by,
                      dynamic=bool(partition_by))
        return
    # The updates feed three branches (touched partitions, anti-join keys,
    # union); computing them once bounds the cost to one evaluation.
    updates = updates.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        current = reader.parquet(target).select(*updates.columns)
        if partition_by:
            current = _touched_partitions(current, updates, partition_by)
            write_parquet(upsert(current, updates, key), target, mode="overwrite",
                          partition_by=partition_by, dynamic=True)
            return
        staged = scratch(spark, "merge-stage")
        write_parquet(upsert(current, updates, key), staged, mode="overwrite")
        write_parquet(spark.read.parquet(staged), target, mode="overwrite")
    finally:
        updates.unpersist()
