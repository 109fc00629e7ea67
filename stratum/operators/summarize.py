"""Tumbling event-time window summaries (batch and streaming).

One function serves the streaming gold (watermarked, emits a window once it
is closed), the batch snapshot (no watermark, every window including the
still-open ones) and the generic category summary. The plan is always
``HashAggregate(partial) -> Exchange(hash(window, dims)) -> HashAggregate``:
a hot key is reduced to one row per input partition before the shuffle, so
no single task ever receives the raw rows of a skewed group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from stratum import schemas
from stratum.functions.money import (
    Measure,
    final_column,
    mergeable_names,
    partial_columns,
    remerge_columns,
)

GOLD_MEASURES = (
    Measure("financing_count", "count", "financing_id"),
    Measure("total_financed_amount", "sum", "financed_amount", 2),
    Measure("average_monthly_installment", "avg", "monthly_installment", 2),
    # rates are averaged from 4-decimal units, so up to 4 input decimals stay exact
    Measure("average_interest_rate_monthly", "avg", "interest_rate_monthly", 4, in_scale=4),
)

CATEGORY_MEASURES = (
    Measure("event_count", "count", "*"),
    Measure("total_amount", "sum", "amount", 2),
    Measure("average_amount", "avg", "amount", 2),
)


def as_event_time(df: DataFrame, time_col: str) -> DataFrame:
    """Watermarks need a zoned timestamp; wall-clock (NTZ) input is read as UTC."""
    if isinstance(df.schema[time_col].dataType, TimestampNTZType):
        return df.withColumn(time_col, F.col(time_col).cast(TimestampType()))
    return df


def windowed(
    df: DataFrame,
    time_col: str,
    every: str,
    dims: Sequence[str],
    measures: Sequence[Measure],
    *,
    watermark: str | None = None,
    money: str = "exact",
) -> DataFrame:
    """``(window_start, window_end, *dims, *measures)`` per tumbling window.

    Window bounds are emitted as ``timestamp_ntz`` (UTC wall clock) so batch
    and streaming outputs share one schema. With ``watermark`` the input must
    be a stream or batch with an event-time column; only closed windows are
    emitted in append mode.
    """
    if watermark is not None:
        df = as_event_time(df, time_col).withWatermark(time_col, watermark)
    partials = [c for m in measures for c in partial_columns(m, money)]
    agg = df.groupBy(F.window(F.col(time_col), every).alias("window"), *dims).agg(*partials)
    return agg.select(
        F.col("window.start").cast(TimestampNTZType()).alias("window_start"),
        F.col("window.end").cast(TimestampNTZType()).alias("window_end"),
        *dims,
        *[final_column(m, money) for m in measures],
    )


def gold_summary(
    silver: DataFrame,
    every: str,
    *,
    watermark: str | None = None,
    money: str = "exact",
) -> DataFrame:
    """Financing gold: window x segment/region/type/brand/model."""
    return windowed(
        silver, "created_at", every, schemas.GOLD_DIMENSIONS, GOLD_MEASURES,
        watermark=watermark, money=money,
    )


def with_derived(gold: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Gold with those of ``columns`` that only serve its layout (``window_date``)."""
    return gold.withColumn("window_date", F.to_date("window_start")) if "window_date" in columns else gold


def category_summary(
    transactions: DataFrame,
    every: str,
    *,
    watermark: str | None = None,
    money: str = "exact",
    time_col: str = "event_time",
    category: str = "category",
    amount: str = "amount",
) -> DataFrame:
    """Window x category -> event_count, total_amount, average_amount."""
    df = transactions
    renames = {time_col: "event_time", category: "category", amount: "amount"}
    if any(k != v for k, v in renames.items()):
        df = df.select(*[F.col(k).alias(v) for k, v in renames.items()])
    return windowed(df, "event_time", every, ["category"], CATEGORY_MEASURES,
                    watermark=watermark, money=money)


# ---- incremental summaries ---------------------------------------------------

LAST_EVENT = "last_event"


def windowed_partials(
    df: DataFrame,
    time_col: str,
    every: str,
    dims: Sequence[str],
    measures: Sequence[Measure],
    *,
    money: str = "exact",
) -> DataFrame:
    """Per-window sums and counts of one batch of rows, ready to be added to
    the partials of other batches (no watermark: late rows count too).
    ``last_event`` is the latest event time of a window's rows."""
    parts = [c for m in measures for c in partial_columns(m, money)]
    parts.append(F.max(F.col(time_col)).cast(TimestampNTZType()).alias(LAST_EVENT))
    agg = df.groupBy(F.window(F.col(time_col), every).alias("window"), *dims).agg(*parts)
    return agg.select(
        F.col("window.start").cast(TimestampNTZType()).alias("window_start"),
        F.col("window.end").cast(TimestampNTZType()).alias("window_end"),
        *dims,
        *[n for m in measures for n in mergeable_names(m, money)],
        LAST_EVENT,
    )


def merge_partials(
    partials: DataFrame, dims: Sequence[str], measures: Sequence[Measure], money: str = "exact"
) -> DataFrame:
    """Add partials of the same (window, dims) key: partial/final hash aggregate."""
    return partials.groupBy("window_start", "window_end", *dims).agg(
        *[c for m in measures for c in remerge_columns(m, money)], F.max(LAST_EVENT).alias(LAST_EVENT)
    )


def finalize_partials(
    merged: DataFrame, dims: Sequence[str], measures: Sequence[Measure], money: str = "exact"
) -> DataFrame:
    return merged.select(
        "window_start", "window_end", *dims, *[final_column(m, money) for m in measures]
    )


def gold_partials(silver: DataFrame, every: str, *, money: str = "exact") -> DataFrame:
    return windowed_partials(silver, "created_at", every, schemas.GOLD_DIMENSIONS, GOLD_MEASURES,
                             money=money)


def gold_from_partials(partials: DataFrame, *, money: str = "exact") -> DataFrame:
    merged = merge_partials(partials, schemas.GOLD_DIMENSIONS, GOLD_MEASURES, money)
    return finalize_partials(merged, schemas.GOLD_DIMENSIONS, GOLD_MEASURES, money)
