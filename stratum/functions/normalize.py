"""Dimension normalisation: ``upper(trim(x))`` / ``lower(trim(x))``.

``trim`` removes spaces only (a tab survives), matching SQL ``TRIM``.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns the silver layer normalises (fixed by the data product).
UPPER_COLUMNS = ("vehicle_type", "region", "state", "status", "currency")
LOWER_COLUMNS = ("segment",)


def upper_trim(c: Column | str) -> Column:
    return F.upper(F.trim(F.col(c) if isinstance(c, str) else c))


def lower_trim(c: Column | str) -> Column:
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def clean(
    df: DataFrame,
    upper: Iterable[str] = UPPER_COLUMNS,
    lower: Iterable[str] = LOWER_COLUMNS,
) -> DataFrame:
    """Normalise the named columns in one projection (columns keep their order)."""
    mapping = {c: upper_trim(c) for c in upper if c in df.columns}
    mapping.update({c: lower_trim(c) for c in lower if c in df.columns})
    return df.withColumns(mapping) if mapping else df


def zero_padded(value: Column, digits: int) -> Column:
    """Decimal text of at least ``digits`` digits; longer numbers stay whole."""
    text = value.cast("string")
    return F.lpad(text, F.greatest(F.lit(digits), F.length(text)), F.lit("0"))
