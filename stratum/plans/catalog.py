"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the given tables (or data Spark derives from them), runs
the library operator on all of it, and returns a DataFrame whose column
names match the SQL twin in :mod:`stratum.plans.oracle`.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from stratum.functions import normalize
from stratum.functions.rules import contract_rules, silver_rules, transaction_rules
from stratum.operators import summarize, validate
from stratum.session import pin_utc
from stratum.sources import synthetic, tables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (fixed so both sides agree).
CATEGORY_WINDOW = "1 hour"
LINEITEM_WINDOW = "1 day"
GOLD_WINDOW = "1 day"
WATERMARK = "30 seconds"
CONTRACT_SEED = 42
CONTRACT_BAD_PERCENT = 5


def given_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; ``spread`` when heavy per-row work follows the scan."""
    pin_utc(spark)
    return tables.table(spark, sf_dir, name, spread=spread)


def fin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Financing events with injected dirt, derived from ``orders``."""
    return tables.financing(given_table(spark, sf_dir, "orders", spread=True))


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.to_silver(fin(spark, sf_dir))


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(TimestampNTZType()) for c in cols})


# ---- windowed summaries ----------------------------------------------------

def q_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given_table(spark, sf_dir, "events")
    return summarize.category_summary(tables.transactions(events), CATEGORY_WINDOW)


def q_category_summary_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data product's own rounding: sums and means of doubles."""
    events = given_table(spark, sf_dir, "events")
    return summarize.category_summary(tables.transactions(events), CATEGORY_WINDOW, money="double")


def q_lineitem_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = given_table(spark, sf_dir, "lineitem")
    tx = li.select(
        F.col("l_shipdate").alias("event_time"),
        F.concat_ws("|", "l_returnflag", "l_linestatus").alias("category"),
        F.col("l_extendedprice").alias("amount"),
    )
    return summarize.category_summary(tx, LINEITEM_WINDOW)


def q_gold_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.gold_summary(silver_of(spark, sf_dir), GOLD_WINDOW)


# ---- quality ---------------------------------------------------------------

def q_normalize_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fin(spark, sf_dir).select("vehicle_id", *normalize.UPPER_COLUMNS, *normalize.LOWER_COLUMNS)
    return normalize.clean(df)


def q_validate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = validate.validate_transactions(fin(spark, sf_dir))
    return valid


def q_validate_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, invalid = validate.validate_transactions(fin(spark, sf_dir))
    return invalid


def q_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.reason_profiles(fin(spark, sf_dir), {
        "transaction": (transaction_rules(), False),
        "silver": (silver_rules(), True),
    })


def q_silver_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_of(spark, sf_dir)


def q_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.contract_check(fin(spark, sf_dir), contract_rules())
    return checked.select("vehicle_id", "violation_text", "violation_count")


def q_contract_violations_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.contract_check(_contract_events(spark, sf_dir), contract_rules())
    return checked.select("financing_id", "violation_text", "violation_count")


# ---- generators ------------------------------------------------------------

def q_synth_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given_table(spark, sf_dir, "events", spread=True)
    return _ntz(synthetic.from_counter(tables.counter_rows(events)), "created_at", "event_time")


def _contract_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given_table(spark, sf_dir, "orders", spread=True)
    return synthetic.contract_events(
        orders, "o_orderkey", "o_orderdate", seed=CONTRACT_SEED, bad_percent=CONTRACT_BAD_PERCENT
    )


def q_synth_contract_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contract_events(spark, sf_dir)


def queries() -> dict[str, Query]:
    from stratum.plans import catalog_io  # file/stream based queries

    out: dict[str, Query] = {
        "category_summary": q_category_summary,
        "category_summary_double": q_category_summary_double,
        "lineitem_summary": q_lineitem_summary,
        "gold_batch": q_gold_batch,
        "normalize_dims": q_normalize_dims,
        "validate_valid": q_validate_valid,
        "validate_invalid": q_validate_invalid,
        "reason_counts": q_reason_counts,
        "silver_batch": q_silver_batch,
        "contract_violations": q_contract_violations,
        "contract_violations_generated": q_contract_violations_generated,
        "synth_events": q_synth_events,
        "synth_contract_events": q_synth_contract_events,
    }
    out.update(catalog_io.queries())
    return out


__all__ = ["queries", "fin", "silver_of"]
