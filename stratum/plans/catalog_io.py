"""Registered queries that run through files and streams.

Each call lands its input under a fresh folder in the shared checkpoint
location, runs the real jobs (available-now streams with checkpoints, batch
snapshot, keyed merge) and returns the written layer read back.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from stratum import schemas
from stratum.functions.contract import read_contract
from stratum.functions.rules import contract_document
from stratum.operators import audit, reports, summarize, validate
from stratum.plans import catalog as C
from stratum.plans import chain
from stratum.session import create_file, scratch
from stratum.settings import Settings
from stratum.sinks.files import read_layer, write_jsonl
from stratum.sources import tables
from stratum.streaming import jobs

UPSERT_A_BEFORE = "1998-07-01"
UPSERT_B_FROM = "1998-01-01"
INCREMENTAL_SPLIT = "1998-01-01"


def _settings(spark: SparkSession, name: str, **kw) -> Settings:
    # Window state sized to the task slots: these checkpoints are fresh, so the
    # width is chosen here rather than inherited from an arbitrary session.
    base = dict(root=scratch(spark, name), window=C.GOLD_WINDOW, watermark=C.WATERMARK,
                state_partitions=spark.sparkContext.defaultParallelism)
    base.update(kw)
    return Settings(**base)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(TimestampNTZType()) for c in cols})


def _financing_cols(df: DataFrame) -> DataFrame:
    return _ntz(df.select(*schemas.FINANCING_COLUMNS), "created_at")


def _landed(spark: SparkSession, sf_dir: str, name: str) -> Settings:
    s = _settings(spark, name)
    write_jsonl(C.fin(spark, sf_dir), s.landing_path)
    return s


# ---- bronze ----------------------------------------------------------------

def q_bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _landed(spark, sf_dir, "bronze-ingest")
    chain.run_bronze(spark, s)
    return _financing_cols(read_layer(spark, s.bronze.path))


def q_bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings and three runs on one checkpoint: every row exactly once."""
    s = _settings(spark, "bronze-incremental")
    orders = C.given_table(spark, sf_dir, "orders", spread=True)
    # undated orders land in the second part
    early = F.coalesce(F.col("o_orderdate") < F.lit(INCREMENTAL_SPLIT).cast("timestamp_ntz"), F.lit(False))
    write_jsonl(tables.financing(orders.filter(early)), s.landing_path)
    chain.run_bronze(spark, s)
    write_jsonl(tables.financing(orders.filter(~early)), s.landing_path)
    chain.run_bronze(spark, s)
    chain.run_bronze(spark, s)  # nothing new: must add nothing
    return _financing_cols(read_layer(spark, s.bronze.path))


def q_jsonl_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _landed(spark, sf_dir, "jsonl-count")
    lines = spark.read.text(s.landing_path)
    return lines.filter(F.trim(F.col("value")) != "").agg(F.count(F.lit(1)).alias("line_count"))


def q_contract_raw_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing text checked for undeclared keys and the created_at format."""
    s = _settings(spark, "raw-contract")
    write_jsonl(tables.financing_landing(C.given_table(spark, sf_dir, "orders", spread=True)), s.landing_path)
    checked = validate.raw_contract_check(spark.read.text(s.landing_path))
    return checked.select(
        F.get_json_object("value", "$.vehicle_id").alias("vehicle_id"), "raw_violation_text"
    )


def q_contract_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from the contract's document, read back from where it was written."""
    path = scratch(spark, "contract") + "/contract.json"
    create_file(spark, path, json.dumps(contract_document()))
    checked = read_contract(spark, path).check(C.fin(spark, sf_dir))
    return checked.select("vehicle_id", "violation_text", "violation_count")


# ---- silver / quarantine ---------------------------------------------------

def _through_silver(spark: SparkSession, sf_dir: str, name: str) -> Settings:
    s = _landed(spark, sf_dir, name)
    chain.run_bronze(spark, s)
    chain.run_silver(spark, s)
    return s


def q_silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _through_silver(spark, sf_dir, "silver-stream")
    return _financing_cols(chain.read_silver(spark, s))


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _through_silver(spark, sf_dir, "quarantine")
    q = chain.read_quarantine(spark, s)
    return _ntz(q.select(*schemas.FINANCING_COLUMNS, validate.REASON), "created_at")


# ---- gold ------------------------------------------------------------------

def q_gold_stream_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _through_silver(spark, sf_dir, "gold-stream")
    chain.run_gold(spark, s)
    return chain.read_gold_stream(spark, s)


def q_gold_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _settings(spark, "gold-snapshot")
    chain.write_silver_batch(spark, s, C.fin(spark, sf_dir), mode="overwrite")
    chain.run_snapshot(spark, s)
    return chain.read_gold(spark, s.gold.path)


def q_medallion_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _landed(spark, sf_dir, "chain")
    chain.run_chain(spark, s)
    return chain.read_gold(spark, s.gold.path)


def q_gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, each folded into mergeable partials and compacted; the
    result must equal the full recompute over all of silver."""
    s = _settings(spark, "gold-incremental")
    orders = C.given_table(spark, sf_dir, "orders", spread=True)
    # undated orders land in the second part
    early = F.coalesce(F.col("o_orderdate") < F.lit(INCREMENTAL_SPLIT).cast("timestamp_ntz"), F.lit(False))
    for part in (orders.filter(early), orders.filter(~early)):
        write_jsonl(tables.financing(part), s.landing_path)
        chain.run_bronze(spark, s)
        chain.run_silver(spark, s)
        chain.run_snapshot_incremental(spark, s)
        chain.compact_gold_partials(spark, s)  # next run reads base + newer batches
    return chain.read_gold(spark, s.gold.path)


def q_gold_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows over files in no order of time, one file a batch in places: the
    same windows as of one batch over all of them."""
    s = _settings(spark, "gold-closed", max_files_per_trigger=3)
    orders = C.given_table(spark, sf_dir, "orders")
    shuffled = orders.repartition(7, F.xxhash64("o_orderkey"))
    chain.write_silver_batch(spark, s, tables.financing(shuffled), mode="overwrite")
    chain.run_closed_windows(spark, s)
    return chain.read_closed(spark, s)


def q_layer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _landed(spark, sf_dir, "audit")
    chain.run_chain(spark, s)
    layers = {
        "bronze": read_layer(spark, s.bronze.path),
        "silver": chain.read_silver(spark, s),
        "quarantine": chain.read_quarantine(spark, s),
        "gold": chain.read_gold(spark, s.gold.path),
    }
    return audit.audit(spark, layers)


def q_layer_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _landed(spark, sf_dir, "reconcile")
    chain.run_chain(spark, s)
    return chain.run_reconcile(spark, s)


def q_gold_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stale slice A (no pending contracts, early windows), then slice B
    recomputed from all of silver for later windows, merged on the key."""
    s = _settings(spark, "gold-upsert")
    silver = C.silver_of(spark, sf_dir)
    # windows start at midnight, so the bounds hold for the rows and cut the scans
    slice_a = silver.filter((F.col("status") != "PENDING_APPROVAL") & (F.col("created_at") < F.lit(UPSERT_A_BEFORE).cast("timestamp_ntz")))
    slice_b = silver.filter(F.col("created_at") >= F.lit(UPSERT_B_FROM).cast("timestamp_ntz"))
    for part in (slice_a, slice_b):
        chain.upsert_gold(spark, s, summarize.gold_summary(part, C.GOLD_WINDOW))
    return chain.read_gold(spark, s.gold.path)


# ---- reports over gold -----------------------------------------------------

def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.q_gold_batch(spark, sf_dir)


def q_report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.summary(_gold(spark, sf_dir))


def q_report_summary_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.summary_totals(_gold(spark, sf_dir))


def q_report_summary_raw_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over gold in double mode, its totals left unrounded."""
    gold = summarize.gold_summary(C.silver_of(spark, sf_dir), C.GOLD_WINDOW, money="double")
    return reports.summary(gold, "double", round_total=False)


def q_report_summary_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.summary_weighted(C.silver_of(spark, sf_dir))


def q_report_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.windows(_gold(spark, sf_dir))


def q_gold_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ordered(_gold(spark, sf_dir))


def q_gold_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.row_count(_gold(spark, sf_dir))


# the three sorted reports with each row's place: the order itself is compared

def q_report_summary_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.positions(reports.summary(_gold(spark, sf_dir)), reports.summary_order())


def q_report_windows_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = reports.positions(_gold(spark, sf_dir), reports.windows_order())
    return placed.select("position", "window_start", "window_end", "vehicle_model", "financing_count", "total_financed_amount")


def q_gold_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.positions(_gold(spark, sf_dir), reports.gold_order())


# ---- streams over the given tables -----------------------------------------

def _events_schema(spark: SparkSession, sf_dir: str):
    return C.given_table(spark, sf_dir, "events").schema


def q_category_summary_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _settings(spark, "category-stream", window=C.CATEGORY_WINDOW)
    events = jobs.table_stream(spark, sf_dir, "events", _events_schema(spark, sf_dir))
    jobs.await_all([jobs.start_category_summary(spark, tables.transactions(events), s)])
    return read_layer(spark, s.summary.path).select(*schemas.CATEGORY_SUMMARY_COLUMNS)


def _fanout(spark: SparkSession, sf_dir: str, name: str) -> Settings:
    s = _settings(spark, name, window=C.CATEGORY_WINDOW)
    events = jobs.table_stream(spark, sf_dir, "events", _events_schema(spark, sf_dir), s.max_files_per_trigger)
    jobs.await_all(jobs.start_quality_fanout(spark, tables.counter_rows(events), s, live=False))
    return s


def q_valid_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _fanout(spark, sf_dir, "fanout-valid")
    valid = chain.read_events(spark, s, schemas.QUALITY_VALID).select(*schemas.COUNTER_EVENT_COLUMNS)
    return _ntz(valid, "created_at", "event_time")


def q_fanout_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _fanout(spark, sf_dir, "fanout-summary")
    return read_layer(spark, s.summary.path).select(*schemas.CATEGORY_SUMMARY_COLUMNS)


def queries() -> dict:
    return {
        "bronze_ingest": q_bronze_ingest,
        "bronze_incremental": q_bronze_incremental,
        "jsonl_line_count": q_jsonl_line_count,
        "contract_raw_violations": q_contract_raw_violations,
        "contract_document": q_contract_document,
        "silver_stream": q_silver_stream,
        "quarantine": q_quarantine,
        "gold_stream_closed": q_gold_stream_closed,
        "gold_snapshot": q_gold_snapshot,
        "medallion_chain": q_medallion_chain,
        "layer_audit": q_layer_audit,
        "layer_reconcile": q_layer_reconcile,
        "gold_incremental": q_gold_incremental,
        "gold_closed_windows": q_gold_closed_windows,
        "gold_upsert": q_gold_upsert,
        "report_summary": q_report_summary,
        "report_summary_totals": q_report_summary_totals,
        "report_summary_raw_total": q_report_summary_raw_total,
        "report_summary_weighted": q_report_summary_weighted,
        "report_windows": q_report_windows,
        "gold_ordered": q_gold_ordered,
        "gold_row_count": q_gold_row_count,
        "report_summary_positions": q_report_summary_positions,
        "report_windows_positions": q_report_windows_positions,
        "gold_positions": q_gold_positions,
        "category_summary_stream": q_category_summary_stream,
        "valid_partitioned": q_valid_partitioned,
        "fanout_summary": q_fanout_summary,
    }


__all__ = ["queries"]
