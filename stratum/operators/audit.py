"""Layer audit: row and column counts per layer, plus reconciliation checks.

All counts are global aggregates over the layer files (a partial count per
task, one tiny final stage); the union of them runs as one job.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def require_layers(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Fail loudly when a layer the audit expects was never written."""
    from stratum.session import path_exists

    missing = [name for name, path in paths.items() if not path_exists(spark, path)]
    if missing:
        raise RuntimeError(f"missing layers: {', '.join(missing)}")


def audit(
    spark: SparkSession,
    layers: Mapping[str, DataFrame],
    *,
    bronze: str = "bronze",
    silver: str = "silver",
    quarantine: str = "quarantine",
    gold: str = "gold",
) -> DataFrame:
    """One row per layer, then two reconciliation rows whose count must be 0.

    * ``reconcile:bronze-silver-quarantine`` - bronze has as many rows as silver
      and quarantine together;
    * ``reconcile:silver_ids-gold_count`` - the gold counts add up to the
      silver rows with an id.

    Each layer is read once: one aggregate holds its own row and its signed
    shares of the checks, and a grouped sum over those few rows adds them up.
    """
    rows = F.count(F.lit(1))
    shares: dict[str, dict[str, Column]] = {name: {} for name in layers}
    if {bronze, silver, quarantine} <= set(layers):
        for name, share in ((bronze, rows), (silver, -rows), (quarantine, -rows)):
            shares[name]["reconcile:bronze-silver-quarantine"] = share
    if {silver, gold} <= set(layers):
        shares[silver]["reconcile:silver_ids-gold_count"] = F.count("financing_id")
        shares[gold]["reconcile:silver_ids-gold_count"] = -F.coalesce(F.sum("financing_count"), F.lit(0))

    def line(layer: str, count: Column, names: list[str]) -> Column:
        return F.struct(F.lit(layer).alias("layer"), count.cast("long").alias("row_count"),
                        F.lit(len(names)).alias("column_count"), F.lit(",".join(names)).alias("columns"))

    parts = [
        df.agg(F.array(line(name, rows, df.columns), *[line(c, v, []) for c, v in shares[name].items()]).alias("lines"))
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, parts).select(F.inline("lines")).groupBy("layer").agg(
        F.sum("row_count").alias("row_count"), F.max("column_count").alias("column_count"), F.max("columns").alias("columns")
    )


# ---- row by row --------------------------------------------------------------

def row_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row that tell NULL from values and columns apart."""
    marked = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(*marked).alias("h1"), F.xxhash64(F.lit(1), *marked).alias("h2")]


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row that depends on the rows and how often each occurs, not on their order:
    their number and the sums of their hashes. No shuffle but of one row a task."""
    hashes = df.select(*row_hashes(df, columns))
    sums = [F.coalesce(F.sum(F.col(h).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"sum_{h}") for h in ("h1", "h2")]
    return hashes.agg(F.count(F.lit(1)).alias("row_count"), *sums)


def row_differences(expected: DataFrame, found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``row_count`` of ``expected``, and how many of its rows ``found`` lacks and how many
    it has beyond, counting repeats. A lost row and a repeated one don't cancel.

    Rows are added up by their hashes with a sign; every task adds before the shuffle,
    so a row that occurs very often moves once a task.
    """
    signed = [df.select(*row_hashes(df, columns), F.lit(sign).alias("n")) for df, sign in ((expected, 1), (found, -1))]
    each = signed[0].unionByName(signed[1]).groupBy("h1", "h2").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("n") > 0, F.col("n"))).alias("own"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return each.agg(
        total("own").alias("row_count"),
        total(F.when(F.col("n") > 0, F.col("n"))).alias("lost"),
        total(F.when(F.col("n") < 0, -F.col("n"))).alias("extra"),
    )


def reconcile(checks: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]]) -> DataFrame:
    """``check, row_count, lost, extra`` of each (expected, found, columns)."""
    parts = [row_differences(*what).select(F.lit(name).alias("check"), "*") for name, what in checks.items()]
    return reduce(DataFrame.unionByName, parts)
