"""Partition directories that give back every string.

A directory name can't hold an empty string: Spark writes it like NULL. Strings are
therefore spelled before they become directory names: an empty string, the name of
the NULL directory and strings that begin with the mark get a mark in front. NULL and
all other values stay as they are, so usual directories read as ever, and a filter
on the decoded column still prunes directories (it depends on nothing else).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MARK = "~"
NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"


def spelled(value: Column) -> Column:
    plain = (value != "") & (value != NULL_DIRECTORY) & ~F.startswith(value, F.lit(MARK))
    return F.when(plain, value).otherwise(F.concat(F.lit(MARK), value))


def unspelled(value: Column) -> Column:
    return F.when(F.startswith(value, F.lit(MARK)), F.substr(value, F.lit(2))).otherwise(value)


def _on_strings(df: DataFrame, columns: Sequence[str], change) -> DataFrame:
    texts = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    return df.withColumns({c: change(F.col(c)) for c in texts}) if texts else df


def encode(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``df`` with its partition columns as directory names spell them."""
    return _on_strings(df, partition_by, spelled)


def decode(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``df``, read from encoded directories, with its own values back."""
    return _on_strings(df, partition_by, unspelled)
