"""Jobs: one stage at a time, or the whole chain in order.

``run_chain`` waits for bronze to drain before silver starts, and for silver
before gold, then writes the batch snapshot that closes the windows the
watermark still holds open. Every stage raises on failure (nothing is
swallowed) and pins the session time zone to UTC, so window bounds and
landed timestamps mean the same instant in batch and streaming runs. ``python -m stratum.plans.chain <stage>`` is the spark-submit
entry point; settings come from ``STRATUM_*`` environment variables.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stratum import schemas
from stratum.operators import summarize
from stratum.session import delete_path, list_dirs, path_exists, pin_utc
from stratum.settings import Settings
from stratum.sinks import partitions, versioned, warehouse
from stratum.sinks.files import read_layer, write_parquet
from stratum.sinks.layers import read_reconciled
from stratum.streaming import jobs


def run_bronze(spark: SparkSession, settings: Settings, live: bool = False) -> None:
    pin_utc(spark)
    jobs.await_all([jobs.start_bronze(spark, settings, live)], _timeout(settings, live))


def run_silver(spark: SparkSession, settings: Settings, live: bool = False) -> None:
    pin_utc(spark)
    jobs.await_all(jobs.start_silver(spark, settings, live), _timeout(settings, live))


def run_gold(spark: SparkSession, settings: Settings, live: bool = False):
    """Run the gold stream; returns the finished query (progress, late-row metrics)."""
    pin_utc(spark)
    extra = [warehouse.batch_upsert_sink(settings)] if settings.jdbc_url else []
    query = jobs.start_gold(spark, settings, live, extra)
    jobs.await_all([query], _timeout(settings, live))
    return query


def read_refined(spark: SparkSession, settings: Settings, quality: str) -> DataFrame:
    refined = read_layer(spark, settings.silver.path, schemas.REFINED)
    return refined.filter(F.col(schemas.QUALITY_COLUMN) == quality)


def read_silver(spark: SparkSession, settings: Settings) -> DataFrame:
    """Accepted rows (partition-pruned to ``quality=valid``), contract columns."""
    return read_refined(spark, settings, schemas.QUALITY_VALID).select(*schemas.FINANCING_COLUMNS)


def read_quarantine(spark: SparkSession, settings: Settings) -> DataFrame:
    """Rejected rows with provenance and the first violated rule."""
    return read_refined(spark, settings, schemas.QUALITY_REJECTED).select(*schemas.QUARANTINE_COLUMNS)


def write_silver_batch(spark: SparkSession, settings: Settings, bronze: DataFrame, mode: str = "append") -> None:
    """Batch twin of the silver stream: same classification, same layout."""
    cols = {c: F.lit(None).cast(t) for c, t in (("source_file", "string"), ("ingestion_time", "timestamp"),
                                               (schemas.CORRUPT_COLUMN, "string")) if c not in bronze.columns}
    write_parquet(jobs.refine(bronze.withColumns(cols), strict=settings.strict_nulls), settings.silver.path,
                  mode=mode, partition_by=(schemas.QUALITY_COLUMN,))


def gold_snapshot(spark: SparkSession, settings: Settings) -> DataFrame:
    """Batch gold over all of silver, including windows still open."""
    pin_utc(spark)
    return summarize.gold_summary(read_silver(spark, settings), settings.window, money=settings.money)


def run_snapshot(spark: SparkSession, settings: Settings) -> None:
    """Rewrite the partitioned gold snapshot, then reload the warehouse from it."""
    _publish_gold(spark, settings, gold_snapshot(spark, settings))


def _gold_schema(settings: Settings) -> StructType:
    """Gold plus the partition columns that are derived from it."""
    derived = [f for f in schemas.GOLD_DERIVED.fields if f.name in settings.gold_partitions]
    return StructType([*schemas.GOLD.fields, *derived])


def _publish_gold(spark: SparkSession, settings: Settings, gold: DataFrame, notes: dict | None = None) -> None:
    """The snapshot becomes the next version of the gold table: a run that fails at any
    step leaves the version before in place, and no partition outlives its rows. The
    warehouse is loaded from the written snapshot (the aggregate runs once).
    """
    versioned.replace(spark, settings.gold.path, summarize.with_derived(gold, settings.gold_partitions),
                      partition_by=settings.gold_partitions, notes=notes)
    _reload_warehouse(spark, settings)


def _reload_warehouse(spark: SparkSession, settings: Settings) -> None:
    if settings.jdbc_url:
        warehouse.reload(spark, read_gold(spark, settings.gold.path), settings)


def run_gold_partials(spark: SparkSession, settings: Settings, live: bool = False) -> None:
    pin_utc(spark)
    jobs.await_all([jobs.start_gold_partials(spark, settings, live)], _timeout(settings, live))


def _latest_base(spark: SparkSession, settings: Settings) -> int | None:
    """Newest complete compaction (its ``_SUCCESS`` marker is written last)."""
    root = settings.gold_partials_base
    done = [int(name[len("upto="):]) for name in list_dirs(spark, root)
            if name.startswith("upto=") and path_exists(spark, f"{root}/{name}/_SUCCESS")]
    return max(done) if done else None


def _batches(fields: StructType) -> StructType:
    return StructType([*fields.fields, StructField("batch_id", LongType())])


def _partials_schema(spark: SparkSession, settings: Settings) -> StructType:
    """Declared, so a layer without any file yet reads as empty."""
    nothing = spark.createDataFrame([], schemas.FINANCING)
    return summarize.gold_partials(nothing, settings.window, money=settings.money).schema


def _current_partials(spark: SparkSession, settings: Settings, upto: int | None = None) -> DataFrame | None:
    """Base (if any) plus the per-batch partials newer than it, up to ``upto``."""
    base_n = _latest_base(spark, settings)
    schema = _partials_schema(spark, settings)
    parts = None
    if path_exists(spark, settings.gold_partials.path):
        batches = read_layer(spark, settings.gold_partials.path, _batches(schema))
        if base_n is not None:
            batches = batches.filter(F.col("batch_id") > base_n)  # partition pruning
        if upto is not None:
            batches = batches.filter(F.col("batch_id") <= upto)
        parts = batches.drop("batch_id")
    if base_n is not None:
        base = read_layer(spark, f"{settings.gold_partials_base}/upto={base_n}", schema)
        parts = base if parts is None else base.unionByName(parts)
    return parts


def incremental_gold(spark: SparkSession, settings: Settings) -> DataFrame:
    """Gold from the compacted base plus newer partials: work grows with the
    partials (one row per window and dimension set per batch), not with silver."""
    parts = _current_partials(spark, settings)
    if parts is None:
        raise RuntimeError("no gold partials yet: run the partials stream first")
    return summarize.gold_from_partials(parts, money=settings.money)


def compact_gold_partials(spark: SparkSession, settings: Settings) -> int | None:
    """Fold the base and every newer batch into a new base ``upto=<newest>``.

    Readers switch to the new base only once its ``_SUCCESS`` marker exists,
    and ignore batches at or below it, so a crash mid-compaction changes
    nothing and batches written meanwhile are picked up next time. Old
    batch folders are no longer read; removing them is a storage clean-up.
    """
    # batch folders appear whole (dynamic overwrite commits by rename), so a
    # listing is enough to find the newest; no job over the partials
    batches = [int(n[len("batch_id="):]) for n in list_dirs(spark, settings.gold_partials.path)
               if n.startswith("batch_id=")]
    newest = max(batches) if batches else None
    base_n = _latest_base(spark, settings)
    if newest is None or (base_n is not None and newest <= base_n):
        return base_n
    parts = _current_partials(spark, settings, upto=newest)
    merged = summarize.merge_partials(parts, schemas.GOLD_DIMENSIONS, summarize.GOLD_MEASURES, settings.money)
    merged = merged.sortWithinPartitions("window_start")  # later runs read a range of windows
    write_parquet(merged, f"{settings.gold_partials_base}/upto={newest}", mode="overwrite")
    return newest


def _newest_batch(spark: SparkSession, settings: Settings) -> int | None:
    """Newest batch in the partials: a batch folder, or what a base has folded."""
    batches = [int(n[len("batch_id="):]) for n in list_dirs(spark, settings.gold_partials.path)
               if n.startswith("batch_id=")]
    base = _latest_base(spark, settings)
    return max([*batches, *([] if base is None else [base])], default=None)


def _oldest_base(spark: SparkSession, settings: Settings) -> int | None:
    """Batches at or below the oldest base may have been removed."""
    found = [int(n[len("upto="):]) for n in list_dirs(spark, settings.gold_partials_base) if n.startswith("upto=")]
    return min(found, default=None)


def changed_gold(spark: SparkSession, settings: Settings, since: int, upto: int) -> DataFrame:
    """Gold rows of the windows that batches after ``since`` have added to.

    The change set is the keys of the new partials. The partials of all batches are
    read within the keys' time range (pushed to the scan; bases are sorted by window)
    and semi-joined with them, so untouched windows are neither added up nor written.
    """
    fresh = read_layer(spark, settings.gold_partials.path, _batches(_partials_schema(spark, settings)))
    fresh = fresh.filter((F.col("batch_id") > since) & (F.col("batch_id") <= upto))
    changed = fresh.select(*schemas.GOLD_KEY).distinct()
    first, last = changed.agg(F.min("window_start"), F.max("window_start")).first()
    parts = _current_partials(spark, settings, upto=upto)
    if first is not None:
        span = F.col("window_start").between(F.lit(first), F.lit(last))
        parts = parts.filter(F.col("window_start").isNull() | span)
    mine = parts.join(changed, [parts[k].eqNullSafe(changed[k]) for k in schemas.GOLD_KEY], "left_semi")
    return summarize.gold_from_partials(mine, money=settings.money)


def run_snapshot_incremental(spark: SparkSession, settings: Settings) -> None:
    """Fold new silver files into the partials, then bring gold up to date.

    The gold version notes the newest batch it holds. Later runs recompute only the
    windows that newer batches touch and merge them by key; files of gold without a
    changed window stay. A table without that note, or made with another window, money
    mode or layout, or whose newer batches have been removed, is published whole.
    Without any batch (no accepted row so far) gold is an empty table.
    """
    run_gold_partials(spark, settings)
    upto = _newest_batch(spark, settings)
    made = {"window": settings.window, "money": settings.money, "partitions": list(settings.gold_partitions)}
    version = versioned.current(spark, settings.gold.path)
    since = version.notes.get("upto") if version else None
    oldest = _oldest_base(spark, settings)
    whole = since is None or upto is None or since > upto or any(version.notes.get(k) != v for k, v in made.items())
    if whole or (oldest is not None and since < oldest):
        _publish_gold(spark, settings, incremental_gold(spark, settings), {**made, "upto": upto})
    elif since < upto:
        merge_gold(spark, settings, changed_gold(spark, settings, since, upto), {**made, "upto": upto})
        _reload_warehouse(spark, settings)


def close_windows(spark: SparkSession, settings: Settings) -> str | None:
    """Emit the windows that have closed since the last call, each once; the watermark.

    Windows close by the event times in the partials, not by micro-batches: the
    watermark is the latest event of all batches so far less the allowed lateness, so
    the same files give the same windows in any order and number of batches. The
    table's notes hold the watermark and the newest batch of the last call, and change
    in one step with the rows. Since then:

    * windows that end after the old watermark and not after the new one are closed:
      their rows are computed from the partials of all batches;
    * partials of newer batches for windows that had closed before are late: kept as
      rows of kind ``late`` (one a window and dimension set, what the batch added).

    Rows of closed, late and open windows together count every accepted row.
    """
    pin_utc(spark)
    version = versioned.current(spark, settings.gold_closed.path)
    notes = dict(version.notes) if version else {"watermark": None, "upto": -1}
    upto = _newest_batch(spark, settings)
    if upto is None or upto <= notes["upto"]:
        return notes["watermark"]
    oldest = _oldest_base(spark, settings)
    if oldest is not None and notes["upto"] < oldest:
        raise RuntimeError(f"batches up to {oldest} may have been folded away, windows were last closed at {notes['upto']}")
    fresh = read_layer(spark, settings.gold_partials.path, _batches(_partials_schema(spark, settings)))
    fresh = fresh.filter((F.col("batch_id") > notes["upto"]) & (F.col("batch_id") <= upto)).drop("batch_id")
    old = F.lit(notes["watermark"]).cast("timestamp_ntz")
    latest = F.max(summarize.LAST_EVENT) - F.expr(f"INTERVAL {settings.watermark}")
    new = fresh.agg(F.greatest(old, latest).cast("string").alias("w")).first().w
    end, now = F.col("window_end"), F.lit(new).cast("timestamp_ntz")
    parts = _current_partials(spark, settings, upto=upto).filter(end <= now)
    closed = parts if notes["watermark"] is None else parts.filter(end > old)
    late = fresh.filter(F.lit(notes["watermark"] is not None) & (end <= old))
    rows = [
        summarize.gold_from_partials(df, money=settings.money).withColumn(schemas.KIND_COLUMN, F.lit(kind))
        for df, kind in ((closed, schemas.KIND_CLOSED), (late, schemas.KIND_LATE))
    ]
    versioned.append(spark, settings.gold_closed.path, rows[0].unionByName(rows[1]),
                     partition_by=(schemas.KIND_COLUMN,), notes={"watermark": new, "upto": upto})
    return new


def run_closed_windows(spark: SparkSession, settings: Settings) -> None:
    """Fold new silver files into the partials, then emit the windows they close."""
    run_gold_partials(spark, settings)
    close_windows(spark, settings)


def read_closed(spark: SparkSession, settings: Settings, kind: str = schemas.KIND_CLOSED) -> DataFrame:
    rows = versioned.read(spark, settings.gold_closed.path, schemas.GOLD_CLOSED)
    return rows.filter(F.col(schemas.KIND_COLUMN) == kind).select(*schemas.GOLD_COLUMNS)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the gold table."""
    return versioned.read(spark, path, schemas.GOLD)


def read_gold_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    """Windows the gold stream has emitted so far (its ``batch_id`` folders)."""
    found = read_layer(spark, settings.gold_stream.path, _batches(schemas.GOLD), schemas.GOLD_COLUMNS)
    own = [c for c in settings.gold_partitions if c in schemas.GOLD_COLUMNS]
    return partitions.decode(found, own)


def merge_gold(spark: SparkSession, settings: Settings, updates: DataFrame, notes: dict | None = None) -> None:
    """Keyed merge of gold rows into the gold table (7-column key)."""
    derived = [c for c in settings.gold_partitions if c in schemas.GOLD_DERIVED.fieldNames()]
    versioned.merge(spark, settings.gold.path, summarize.with_derived(updates, derived), [*schemas.GOLD_KEY, *derived],
                    schema=_gold_schema(settings), partition_by=settings.gold_partitions, notes=notes)


def upsert_gold(spark: SparkSession, settings: Settings, updates: DataFrame) -> None:
    """Merge rows from elsewhere; the next incremental run publishes gold whole."""
    merge_gold(spark, settings, updates.select(*schemas.GOLD_COLUMNS), {})


def run_chain(spark: SparkSession, settings: Settings) -> None:
    """Landing -> bronze -> silver (+ quarantine) -> gold stream -> gold snapshot."""
    run_bronze(spark, settings)
    run_silver(spark, settings)
    run_gold(spark, settings)
    run_snapshot(spark, settings)


def run_quality_fanout(spark: SparkSession, settings: Settings, counter: DataFrame | None = None,
                       live: bool = True) -> None:
    """Counter stream (``rate`` by default) -> valid / invalid / summary sinks."""
    from stratum.sources import synthetic

    pin_utc(spark)
    source = counter if counter is not None else synthetic.rate_stream(spark, settings.rows_per_second)
    jobs.await_all(jobs.start_quality_fanout(spark, source, settings, live), _timeout(settings, live))


def read_events(spark: SparkSession, settings: Settings, quality: str) -> DataFrame:
    """Committed events of the fan-out: ``valid`` or ``rejected``."""
    events = read_layer(spark, settings.classified.path, jobs.classified_schema(spark, settings))
    chosen = events.filter(F.col(schemas.QUALITY_COLUMN) == quality).drop(schemas.QUALITY_COLUMN)
    return partitions.decode(chosen, settings.valid_partitions)


def _timeout(settings: Settings, live: bool):
    return settings.runtime_seconds if live else None


def vacuum_gold_partials(spark: SparkSession, settings: Settings, keep_bases: int = 2) -> list[str]:
    """Delete partials no reader can need any more; returns what was removed.

    The ``keep_bases`` newest complete bases stay, and so does every batch
    above the oldest of them, so a reader that started on the previous base
    still finds all it reads. Older bases, incomplete bases below the newest
    complete one, and batches at or below the oldest kept base are deleted.
    """
    root = settings.gold_partials_base
    complete = sorted(int(n[len("upto="):]) for n in list_dirs(spark, root)
                      if n.startswith("upto=") and path_exists(spark, f"{root}/{n}/_SUCCESS"))
    if len(complete) < keep_bases or keep_bases < 1:
        return []
    floor = complete[-keep_bases]
    newest = complete[-1]
    removed = []
    for name in list_dirs(spark, root):
        if name.startswith("upto=") and int(name[len("upto="):]) < floor:
            removed.append(f"{root}/{name}")
        elif name.startswith("upto=") and int(name[len("upto="):]) < newest \
                and int(name[len("upto="):]) not in complete:
            removed.append(f"{root}/{name}")
    for name in list_dirs(spark, settings.gold_partials.path):
        if name.startswith("batch_id=") and int(name[len("batch_id="):]) <= floor:
            removed.append(f"{settings.gold_partials.path}/{name}")
    for path in removed:
        delete_path(spark, path)
    return removed


def run_report(spark: SparkSession, settings: Settings, name: str = "summary") -> DataFrame:
    """A named report over the gold snapshot (``summary``, ``windows``, ...)."""
    from stratum.operators import reports

    return reports.run(name, read_gold(spark, settings.gold.path), settings.money)


def run_audit(spark: SparkSession, settings: Settings) -> DataFrame:
    """Layer row/column counts and reconciliation; fails if a layer is missing."""
    from stratum.operators import audit

    audit.require_layers(spark, {"bronze": settings.bronze.path, "silver": settings.silver.path,
                                 "gold": settings.gold.path})
    return audit.audit(spark, {
        "bronze": read_reconciled(spark, settings.bronze.path, jobs.BRONZE_SCHEMA)[0],
        "silver": read_silver(spark, settings),
        "quarantine": read_quarantine(spark, settings),
        "gold": read_gold(spark, settings.gold.path),
    })


def run_reconcile(spark: SparkSession, settings: Settings) -> DataFrame:
    """Row by row: refined bronze against silver and quarantine, and gold against what
    silver gives. Counts that agree say nothing of a lost and a repeated row."""
    from stratum.operators import audit

    refined = jobs.refine(read_layer(spark, settings.bronze.path, jobs.BRONZE_SCHEMA), strict=settings.strict_nulls)
    written = read_layer(spark, settings.silver.path, schemas.REFINED)
    return audit.reconcile({
        "bronze-silver": (refined, written, schemas.REFINED.fieldNames()),
        "silver-gold": (gold_snapshot(spark, settings), read_gold(spark, settings.gold.path), schemas.GOLD_COLUMNS),
    })


def run_generate(spark: SparkSession, settings: Settings, n: str = "20", day: str = "") -> None:
    """Land ``n`` contract-shaped events as new JSON-lines files."""
    import datetime as dt

    from stratum.sinks.files import write_jsonl
    from stratum.sources import synthetic

    day = day or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")
    pin_utc(spark)
    write_jsonl(synthetic.contract_events_for_range(spark, int(n), day), settings.landing_path)


STAGES = {
    "bronze": run_bronze,
    "silver": run_silver,
    "gold": lambda spark, s: (run_gold(spark, s), run_snapshot(spark, s)),
    "snapshot": run_snapshot,
    "snapshot_incremental": run_snapshot_incremental,
    "closed": run_closed_windows,
    "compact": lambda spark, s: compact_gold_partials(spark, s),
    "vacuum": lambda spark, s: vacuum_gold_partials(spark, s),
    "chain": run_chain,
    "fanout": run_quality_fanout,
    "generate": run_generate,
    "report": lambda spark, s, name="summary": print_rows(run_report(spark, s, name)),
    "audit": lambda spark, s: print_rows(run_audit(spark, s)),
    "reconcile": lambda spark, s: print_rows(run_reconcile(spark, s)),
}


def print_rows(df: DataFrame) -> None:
    """Every row, tab-separated under a header, a partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join(map(str, row)))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """``<stage> [args...]``; a given session is used and left running."""
    from stratum.session import build_session

    argv = sys.argv[1:] if argv is None else argv
    stage, args = (argv[0], argv[1:]) if argv else ("chain", [])
    if stage not in STAGES:
        raise SystemExit(f"unknown stage {stage!r}; choose from {sorted(STAGES)}")
    settings = Settings.from_env()
    own = spark is None
    if own:
        spark = build_session(f"stratum-{stage}", conf=settings.spark_conf())
    try:
        STAGES[stage](spark, settings, *args)
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    main()
