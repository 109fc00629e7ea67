"""Streaming stages of the medallion chain.

Each stage is one Structured Streaming query with its own checkpoint, so a
re-run only processes files it has not seen (the file source keeps a log of
processed files in the checkpoint) and a lost executor or driver restart
resumes from the last committed batch. Layers are chained through files:
the file sink's ``_spark_metadata`` log is what the next stage's file source
reads, so a downstream stream never sees a half-written batch.
"""

from __future__ import annotations

from collections import defaultdict
from contextlib import contextmanager
from threading import Event
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from stratum import schemas
from stratum.functions import normalize
from stratum.functions.rules import silver_rules, transaction_rules
from stratum.operators import summarize, validate
from stratum.session import is_dir
from stratum.settings import Settings
from stratum.sinks import partitions
from stratum.sinks.files import (
    prepare_layer,
    replay_safe_batch_writer,
    start_parquet_stream,
    write_parquet,
)
from stratum.sources import synthetic


class LateRows(StreamingQueryListener):
    """Rows that stateful queries discarded as too late, over all their batches.

    Attach it with ``spark.streams.addListener`` before the queries start.
    Spark keeps only the recent progress of a query; this adds up every batch.
    """

    def __init__(self) -> None:
        self._dropped: dict[str, int] = defaultdict(int)
        self._ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self._dropped[str(progress.id)] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.id)].set()

    def dropped(self, query: StreamingQuery, timeout_s: float = 60) -> int:
        """The count so far; of an ended query, after its last event has arrived."""
        if not query.isActive and not self._ended[str(query.id)].wait(timeout_s):
            raise TimeoutError(f"no end event of streaming query {query.id} within {timeout_s} s")
        return self._dropped[str(query.id)]


LANDING_SCHEMA = StructType(
    schemas.FINANCING.fields + [StructField(schemas.CORRUPT_COLUMN, StringType(), True)]
)
BRONZE_SCHEMA = StructType(
    schemas.BRONZE.fields + [StructField(schemas.CORRUPT_COLUMN, StringType(), True)]
)


def _trigger(settings: Settings, live: bool) -> dict:
    return {"processingTime": settings.trigger} if live else {"availableNow": True}


@contextmanager
def _state_conf(spark: SparkSession, settings: Settings):
    """Start a stateful query with the configured state partitions and store.

    A query keeps its own copy of the session conf (and records both values
    in its checkpoint on the first run), so the caller's session is restored
    right after ``start()``.
    """
    from stratum.session import ROCKSDB_STATE_CONF

    wanted: dict[str, str] = {}
    if settings.state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(settings.state_partitions)
    if settings.state_store == "rocksdb":
        wanted.update(ROCKSDB_STATE_CONF)
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# ---- sources ---------------------------------------------------------------

def landing_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    """New JSON-lines files under the landing folder, typed by the contract.

    Unparsable lines keep their raw text in ``_corrupt_record``; provenance
    (source file, ingestion time) is added from the file metadata.
    """
    reader = spark.readStream.schema(LANDING_SCHEMA).option(
        "columnNameOfCorruptRecord", schemas.CORRUPT_COLUMN
    )
    raw = reader.options(**batch_limit(settings)).json(settings.landing_path)
    return raw.select(
        *schemas.FINANCING_COLUMNS,
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("ingestion_time"),
        schemas.CORRUPT_COLUMN,
    )


def batch_limit(settings: Settings, gold: bool = False) -> dict[str, str]:
    """Per-micro-batch input bound of a stream (the two Spark options are exclusive)."""
    if gold:
        n = settings.gold_max_files_per_trigger
        return {"maxFilesPerTrigger": str(n)} if n else {}
    if settings.max_bytes_per_trigger:
        return {"maxBytesPerTrigger": str(settings.max_bytes_per_trigger)}
    n = settings.max_files_per_trigger
    return {"maxFilesPerTrigger": str(n)} if n else {}


def layer_stream(spark: SparkSession, path: str, schema: StructType,
                 limit: dict[str, str] | None = None) -> DataFrame:
    return spark.readStream.schema(schema).options(**(limit or {})).parquet(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: StructType,
                 max_files: int = 0) -> DataFrame:
    """One of the given tables read as a file stream: one file or a directory of files."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = f"{sf_dir}/{name}.parquet"
    if is_dir(spark, path):
        return reader.parquet(path)
    # a file stream reads directories only: the table's one file, by name
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


# ---- stages ----------------------------------------------------------------

def start_bronze(spark: SparkSession, settings: Settings, live: bool = False) -> StreamingQuery:
    prepare_layer(spark, settings.landing_path)
    return start_parquet_stream(
        landing_stream(spark, settings), settings.bronze.path, settings.bronze.checkpoint,
        trigger=_trigger(settings, live), name=None,
    )


def refine(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Normalise and classify bronze rows; tag each ``quality`` valid/rejected."""
    classified = validate.classify(normalize.clean(bronze), silver_rules(), strict=strict)
    return classified.withColumn(
        schemas.QUALITY_COLUMN,
        F.when(F.col(validate.REASON).isNull(), F.lit(schemas.QUALITY_VALID))
        .otherwise(F.lit(schemas.QUALITY_REJECTED)),
    )


def start_silver(spark: SparkSession, settings: Settings, live: bool = False) -> list[StreamingQuery]:
    """Silver and its quarantine in one pass over bronze.

    One exactly-once file sink partitioned by ``quality``: bronze is read
    once per micro-batch, accepted and rejected rows commit together in the
    sink log, and downstream streams read the log, never a half-written batch.
    """
    prepare_layer(spark, settings.bronze.path)
    bronze = layer_stream(spark, settings.bronze.path, BRONZE_SCHEMA, batch_limit(settings))
    refined = refine(bronze, strict=settings.strict_nulls)
    return [start_parquet_stream(refined, settings.silver.path, settings.silver.checkpoint,
                                 partition_by=(schemas.QUALITY_COLUMN,),
                                 trigger=_trigger(settings, live))]


def silver_stream(spark: SparkSession, settings: Settings, gold: bool = False) -> DataFrame:
    """Accepted silver rows as a stream (the contract's 19 columns)."""
    prepare_layer(spark, settings.silver.path)
    refined = layer_stream(spark, settings.silver.path, schemas.REFINED, batch_limit(settings, gold))
    return refined.filter(F.col(schemas.QUALITY_COLUMN) == schemas.QUALITY_VALID).select(
        *schemas.FINANCING_COLUMNS
    )


def start_gold(
    spark: SparkSession,
    settings: Settings,
    live: bool = False,
    extra_sinks: Sequence[Callable[[DataFrame, int], None]] = (),
) -> StreamingQuery:
    """Watermarked window summary of silver; each closed window is emitted once."""
    silver = silver_stream(spark, settings, gold=True)
    gold = summarize.gold_summary(silver, settings.window, watermark=settings.watermark,
                                  money=settings.money)
    gold = summarize.with_derived(gold, settings.gold_partitions)
    writer = replay_safe_batch_writer(
        settings.gold_stream.path, partition_by=settings.gold_partitions, extra=extra_sinks
    )
    with _state_conf(spark, settings):
        return (
            gold.writeStream.outputMode("append")
            .foreachBatch(writer)
            .option("checkpointLocation", settings.gold_stream.checkpoint)
            .trigger(**_trigger(settings, live))
            .start()
        )


def start_gold_partials(spark: SparkSession, settings: Settings, live: bool = False) -> StreamingQuery:
    """Incremental gold: each new silver micro-batch becomes mergeable
    window partials under ``batch_id=<n>`` (a replay overwrites its own
    folder). No watermark: a late row is added to its window, never dropped.
    """
    silver = silver_stream(spark, settings)
    path, every, money = settings.gold_partials.path, settings.window, settings.money

    def write(batch: DataFrame, batch_id: int) -> None:
        partials = summarize.gold_partials(batch, every, money=money)
        write_parquet(partials.withColumn("batch_id", F.lit(batch_id)), path, mode="overwrite",
                      partition_by=("batch_id",), dynamic=True, cluster=False)

    return (
        silver.writeStream.foreachBatch(write)
        .option("checkpointLocation", settings.gold_partials.checkpoint)
        .trigger(**_trigger(settings, live))
        .start()
    )


def start_category_summary(
    spark: SparkSession, transactions: DataFrame, settings: Settings, live: bool = False
) -> StreamingQuery:
    """Window x category summary of a transaction stream, appended when closed."""
    summary = summarize.category_summary(
        transactions, settings.window, watermark=settings.watermark, money=settings.money
    )
    with _state_conf(spark, settings):
        return start_parquet_stream(summary, settings.summary.path, settings.summary.checkpoint,
                                    trigger=_trigger(settings, live))


def classified_events(counter: DataFrame, settings: Settings) -> DataFrame:
    """Counter events with the first rule they break and their ``quality``."""
    classified = validate.classify(synthetic.from_counter(counter), transaction_rules(), strict=settings.strict_nulls)
    return classified.withColumn(
        schemas.QUALITY_COLUMN,
        F.when(F.col(validate.REASON).isNull(), F.lit(schemas.QUALITY_VALID)).otherwise(F.lit(schemas.QUALITY_REJECTED)),
    )


def classified_schema(spark: SparkSession, settings: Settings) -> StructType:
    nothing = spark.createDataFrame([], "value long, timestamp timestamp")
    return classified_events(nothing, settings).schema


def start_quality_sink(
    spark: SparkSession, counter: DataFrame, settings: Settings, live: bool = False
) -> StreamingQuery:
    """Counter stream -> events, valid and rejected side by side in one exactly-once
    sink: the source is read once, nothing is cached, and a batch commits whole."""
    partition_by = (schemas.QUALITY_COLUMN, *settings.valid_partitions)
    events = partitions.encode(classified_events(counter, settings), settings.valid_partitions)
    return start_parquet_stream(events, settings.classified.path, settings.classified.checkpoint,
                                partition_by=partition_by, trigger=_trigger(settings, live))


def start_fanout_summary(spark: SparkSession, settings: Settings, live: bool = False) -> StreamingQuery:
    """Category summary of the valid events, from the log of the sink above."""
    prepare_layer(spark, settings.classified.path)
    events = layer_stream(spark, settings.classified.path, classified_schema(spark, settings), batch_limit(settings, gold=True))
    valid = partitions.decode(events.filter(F.col(schemas.QUALITY_COLUMN) == schemas.QUALITY_VALID), settings.valid_partitions)
    tx = valid.select(F.col("event_time"), F.col("segment").alias("category"), F.col("financed_amount").alias("amount"))
    return start_category_summary(spark, tx, settings, live)


def start_quality_fanout(
    spark: SparkSession, counter: DataFrame, settings: Settings, live: bool = False
) -> list[StreamingQuery]:
    """Counter stream -> (valid, rejected) events -> category summary.

    Live, both queries run side by side; otherwise the sink has drained its source
    before the summary starts, so the summary sees all of it.
    """
    sink = start_quality_sink(spark, counter, settings, live)
    if not live:
        await_all([sink])
    return [sink, start_fanout_summary(spark, settings, live)]


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows a stateful query discarded as too late, over the batches whose progress
    Spark still keeps; :class:`LateRows` counts all batches."""
    total = 0
    for progress in query.recentProgress:
        for op in progress.get("stateOperators", []):
            total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total


def await_all(queries: Sequence[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait for each query in order; stop survivors; surface the first error.

    With ``timeout_s`` all queries share one deadline (a bounded live run),
    otherwise each available-now query runs until it has drained its input.
    """
    import time

    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        for query in queries:
            if deadline is None:
                query.awaitTermination()
            else:
                query.awaitTermination(max(0.001, deadline - time.monotonic()))
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    for query in queries:
        err = query.exception()
        if err is not None:
            raise RuntimeError(f"streaming query {query.name or query.id} failed: {err}")
