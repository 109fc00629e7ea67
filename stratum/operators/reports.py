"""Named reports over the gold table (and one over silver), chosen by name.

Every report is a group-by on low-cardinality dimensions (partial aggregation
leaves a few rows per task before the shuffle) or a projection of gold
ordered for reading; ties in the sort key are broken by the dimension keys
so the order is total.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.money import Measure, final_column, partial_columns
from stratum.session import scratch

REPORT_DIMS = ("region", "vehicle_type", "segment")


def _rollup(df: DataFrame, dims, measures, money: str) -> DataFrame:
    parts = [c for m in measures for c in partial_columns(m, money)]
    return df.groupBy(*dims).agg(*parts).select(*dims, *[final_column(m, money) for m in measures])


def summary_order() -> list:
    return [F.desc("total_financed_amount"), *REPORT_DIMS]


def windows_order() -> list:
    return ["window_start", F.desc("total_financed_amount"), "segment", "region", "vehicle_type", "vehicle_brand",
            "vehicle_model"]


def gold_order() -> list:
    return ["window_start", "region", "vehicle_type", "segment", "vehicle_brand", "vehicle_model"]


def positions(df: DataFrame, order: list) -> DataFrame:
    """``df`` with each row's ``position`` (from 1) in the total order given.

    Rows are dealt by ranges of the sort key and sorted per range; a row's position is
    its place in its range plus the rows of the ranges before. Only the ranges' sizes
    come together, never the rows. The sorted rows are written first, as places must
    not be dealt anew.
    """
    path = scratch(df.sparkSession, "positions")
    df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("__range"), F.monotonically_increasing_id().alias("__place")
    ).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("n"), F.min("__place").alias("__first")).select(
        "__range", "__first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")
    )  # one row a range
    placed = rows.join(F.broadcast(ranges), "__range")
    return placed.select(*df.columns, (F.col("__place") - F.col("__first") + F.col("__before") + 1).alias("position"))


def summary(gold: DataFrame, money: str = "exact", with_average: bool = True,
            round_total: bool = True) -> DataFrame:
    """Per region/type/segment: windows' counts summed, totals summed, mean of
    the per-window mean instalments (unweighted: each window counts once).

    ``round_total=False`` keeps the raw double sum of totals (double mode).
    """
    measures = [Measure("total_financed_amount", "sum", "total_financed_amount",
                        2 if round_total else None)]
    if with_average:
        measures.append(Measure("avg_installment", "avg", "average_monthly_installment", 2))
    counted = gold.groupBy(*REPORT_DIMS).agg(
        F.sum("financing_count").alias("financing_count"),
        *[c for m in measures for c in partial_columns(m, money)],
    )
    out = counted.select(*REPORT_DIMS, "financing_count", *[final_column(m, money) for m in measures])
    return out.orderBy(*summary_order())


def summary_totals(gold: DataFrame, money: str = "exact") -> DataFrame:
    return summary(gold, money, with_average=False)


def summary_weighted(silver: DataFrame, money: str = "exact") -> DataFrame:
    """Customer-level version from silver: every contract weighs the same."""
    measures = [
        Measure("financing_count", "count", "financing_id"),
        Measure("total_financed_amount", "sum", "financed_amount", 2),
        Measure("avg_installment", "avg", "monthly_installment", 2),
    ]
    return _rollup(silver, REPORT_DIMS, measures, money).orderBy(*summary_order())


def windows(gold: DataFrame) -> DataFrame:
    return gold.select(
        "window_start", "window_end", "vehicle_model", "financing_count", "total_financed_amount",
        "segment", "region", "vehicle_type", "vehicle_brand",
    ).orderBy(*windows_order()).select(
        "window_start", "window_end", "vehicle_model", "financing_count", "total_financed_amount"
    )


def ordered(gold: DataFrame) -> DataFrame:
    return gold.orderBy(*gold_order())


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "summary": summary,
    "summary_totals": summary_totals,
    "windows": windows,
    "ordered": ordered,
    "row_count": row_count,
}


MONEY_REPORTS = {"summary", "summary_totals"}


def run(name: str, gold: DataFrame, money: str = "exact") -> DataFrame:
    if name not in REPORTS:
        raise KeyError(f"unknown report {name!r}; choose from {sorted(REPORTS)}")
    if name in MONEY_REPORTS:
        return REPORTS[name](gold, money)
    return REPORTS[name](gold)
