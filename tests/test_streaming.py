import datetime as dt
import json
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from helpers import UTC, base_row
from stratum import schemas
from stratum.plans import chain
from stratum.settings import Settings
from stratum.sinks.files import read_layer, replay_safe_batch_writer
from stratum.streaming import jobs

ARROW = pa.schema(
    [(c, {"int": pa.int32(), "double": pa.float64(), "timestamp": pa.timestamp("us", tz="UTC")}
      .get(t, pa.string())) for c, t in (
        (f.name, f.dataType.simpleString()) for f in schemas.FINANCING.fields)]
)


def _silver_files(path, batches):
    """One Parquet file per batch, modification times in batch order."""
    path = os.path.join(path, "quality=valid")
    os.makedirs(path, exist_ok=True)
    now = time.time() - 1000
    for i, times in enumerate(batches):
        rows = [base_row(financing_id=f"F{i}{j}", created_at=ts) for j, ts in enumerate(times)]
        table = pa.Table.from_pylist(rows, schema=ARROW)
        f = os.path.join(path, f"part-{i:03d}.parquet")
        pq.write_table(table, f)
        os.utime(f, (now + i * 10, now + i * 10))


def at(h, m, s):
    return dt.datetime(2026, 1, 1, h, m, s, tzinfo=UTC)


def _gold_counts(spark, tmp_root, batches, dropped=None):
    s = Settings(root=tmp_root, window="10 seconds", watermark="30 seconds", gold_max_files_per_trigger=1)
    _silver_files(s.silver.path, batches)
    late = jobs.LateRows()
    spark.streams.addListener(late)
    try:
        query = chain.run_gold(spark, s)
        if dropped is not None:
            assert jobs.dropped_by_watermark(query) == dropped
            assert late.dropped(query) == dropped
    finally:
        spark.streams.removeListener(late)
    out = read_layer(spark, s.gold_stream.path).orderBy("window_start").collect()
    return [(r.window_start.strftime("%H:%M:%S"), r.financing_count) for r in out]


def test_late_row_dropped_by_previous_batch_watermark(spark, tmp_root):
    # L1: 00:00:05, 00:02:00, 00:02:01, 00:00:06 -> the last one is late
    got = _gold_counts(spark, tmp_root, [[at(0, 0, 5)], [at(0, 2, 0)], [at(0, 2, 1)], [at(0, 0, 6)]],
                       dropped=1)
    assert got[0] == ("00:00:00", 1)


def test_late_row_kept_while_watermark_lags_one_batch(spark, tmp_root):
    # L2: 00:00:05, 00:02:00, 00:00:06 -> watermark of the previous batch still admits it
    got = _gold_counts(spark, tmp_root, [[at(0, 0, 5)], [at(0, 2, 0)], [at(0, 0, 6)]], dropped=0)
    assert got[0] == ("00:00:00", 2)


def test_window_close_is_inclusive(spark, tmp_root):
    # L3: watermark reaches exactly the window end
    got = _gold_counts(spark, tmp_root, [[at(0, 0, 5)], [at(0, 0, 40)]])
    assert got == [("00:00:00", 1)]


def test_same_batch_late_rows_are_kept(spark, tmp_root):
    # L4: all three in one batch
    got = _gold_counts(spark, tmp_root, [[at(0, 0, 5), at(0, 2, 0), at(0, 0, 6)]])
    assert got[0] == ("00:00:00", 2)


def _line(**changes):
    row = base_row(**changes)
    row["created_at"] = row["created_at"].isoformat() if row["created_at"] else None
    return json.dumps(row)


def test_incremental_ingest_ignores_rewritten_files(spark, tmp_root):
    s = Settings(root=tmp_root)
    os.makedirs(s.landing_path, exist_ok=True)
    a = os.path.join(s.landing_path, "a.jsonl")
    with open(a, "w") as f:
        f.write(_line(financing_id="A1") + "\n")
    chain.run_bronze(spark, s)
    assert read_layer(spark, s.bronze.path).count() == 1
    with open(a, "w") as f:
        f.write(_line(financing_id="A1") + "\n" + _line(financing_id="A2") + "\n")
    os.utime(a, (time.time() + 5, time.time() + 5))
    chain.run_bronze(spark, s)
    assert read_layer(spark, s.bronze.path).count() == 1
    with open(os.path.join(s.landing_path, "b.jsonl"), "w") as f:
        f.write(_line(financing_id="B1") + "\n")
    chain.run_bronze(spark, s)
    assert sorted(r[0] for r in read_layer(spark, s.bronze.path).select("financing_id").collect()) == ["A1", "B1"]


def test_malformed_lines_keep_raw_text_and_reach_quarantine(spark, tmp_root):
    s = Settings(root=tmp_root)
    os.makedirs(s.landing_path, exist_ok=True)
    good = json.loads(_line(financing_id="OK"))
    quoted = dict(good, financing_id="Q", financed_amount="37838.62")
    badyear = dict(good, financing_id="Y", vehicle_year=2024.5)
    noregion = {k: v for k, v in good.items() if k != "region"}
    noregion["financing_id"] = "NR"
    badtime = dict(good, financing_id="T", created_at="nonsense")
    extra = dict(good, financing_id="X", unknown_key=1)
    lines = ["{broken", "", json.dumps(good), json.dumps(quoted), json.dumps(badyear),
             json.dumps(noregion), json.dumps(badtime), json.dumps(extra)]
    with open(os.path.join(s.landing_path, "m.jsonl"), "w") as f:
        f.write("\n".join(lines) + "\n")
    chain.run_bronze(spark, s)
    chain.run_silver(spark, s)
    bronze = read_layer(spark, s.bronze.path)
    assert bronze.count() == 7  # blank line skipped
    broken = bronze.filter(F.col("financing_id").isNull()).collect()
    assert len(broken) == 1 and broken[0]["_corrupt_record"] == "{broken"
    by_id = {r.financing_id: r for r in bronze.collect() if r.financing_id}
    assert by_id["Q"].financed_amount is None and by_id["Q"].region == "SOUTH"
    assert by_id["Y"].vehicle_year is None
    assert by_id["NR"].region is None
    assert by_id["T"].created_at is None
    quarantine = {(r.financing_id, r.validation_reason)
                  for r in chain.read_quarantine(spark, s).collect()}
    assert quarantine == {(None, "missing_id"), ("T", "missing_created_at")}
    raw = chain.read_quarantine(spark, s).filter(F.col("financing_id").isNull()).collect()[0]
    assert raw["_corrupt_record"] == "{broken" and raw["source_file"].endswith("m.jsonl")
    silver_ids = sorted(r[0] for r in chain.read_silver(spark, s).select("financing_id").collect())
    assert silver_ids == ["NR", "OK", "Q", "X", "Y"]


def test_replayed_batch_does_not_duplicate(spark, tmp_root):
    path = tmp_root + "/gold_stream"
    writer = replay_safe_batch_writer(path, partition_by=("region",))
    batch = spark.createDataFrame([("SOUTH", 1), ("NORTH", 2)], "region string, n int")
    writer(batch, 0)
    writer(batch, 0)  # replay of the same batch id
    writer(batch.limit(1), 1)
    assert spark.read.parquet(path).count() == 3
    writer(batch.filter("false"), 2)  # empty batch writes nothing
    assert spark.read.parquet(path).count() == 3


def test_chain_reconciles(spark, tmp_root):
    s = Settings(root=tmp_root, window="10 seconds")
    os.makedirs(s.landing_path, exist_ok=True)
    with open(os.path.join(s.landing_path, "x.jsonl"), "w") as f:
        f.write("\n".join(_line(financing_id=f"F{i}", region=r) for i, r in
                          enumerate(["SOUTH", "SOUTH", "XX", "NORTH"])) + "\n")
    chain.run_chain(spark, s)
    gold = chain.read_gold(spark, s.gold.path).collect()
    assert sum(r.financing_count for r in gold) == 3
    # the stream emits nothing: all rows fall in one still-open window
    assert not os.path.exists(s.gold_stream.path) or read_layer(spark, s.gold_stream.path).count() == 0
    from stratum.operators import audit

    layers = {
        "bronze": read_layer(spark, s.bronze.path),
        "silver": chain.read_silver(spark, s),
        "quarantine": chain.read_quarantine(spark, s),
        "gold": chain.read_gold(spark, s.gold.path),
    }
    rows = {r.layer: r.row_count for r in audit.audit(spark, layers).collect()}
    assert rows["bronze"] == 4 and rows["silver"] == 3 and rows["quarantine"] == 1
    assert rows["reconcile:bronze-silver-quarantine"] == 0
    assert rows["reconcile:silver_ids-gold_count"] == 0


def test_table_stream_reads_only_named_table(spark, tmp_root):
    from conftest import SF_SMALL

    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    s = Settings(root=tmp_root, window="1 hour")
    events = jobs.table_stream(spark, SF_SMALL, "events", schema)
    from stratum.sources import tables

    jobs.await_all([jobs.start_category_summary(spark, tables.transactions(events), s)])
    total = read_layer(spark, s.summary.path).agg(F.sum("event_count")).collect()[0][0]
    assert 0 < total <= 1000


def test_table_stream_reads_a_directory_of_files(spark, tmp_root):
    from conftest import SF_SMALL
    from stratum.sources import tables

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(4).write.parquet(f"{tmp_root}/in/events.parquet")
    found = {}
    for name, root in (("one", SF_SMALL), ("many", f"{tmp_root}/in")):
        s = Settings(root=f"{tmp_root}/{name}", window="1 hour")
        stream = jobs.table_stream(spark, root, "events", events.schema)
        jobs.await_all([jobs.start_category_summary(spark, tables.transactions(stream), s)])
        found[name] = sorted(map(str, read_layer(spark, s.summary.path).collect()))
    assert found["one"] == found["many"] and found["one"]


def test_batch_write_split_conserves_rows(spark, tmp_root):
    from helpers import frame
    from stratum.functions.rules import silver_rules
    from stratum.operators import validate
    from stratum.sinks.files import write_split

    rows = [base_row(financing_id=None), base_row(region="XX"), base_row(), base_row(region="NORTH")]
    classified = validate.classify(frame(spark, rows), silver_rules())
    write_split(classified, validate.REASON, tmp_root + "/split", partition_by=("region",))
    out = spark.read.parquet(tmp_root + "/split")
    ok = out.filter("quality = 'valid'")
    bad = out.filter("quality = 'rejected'")
    assert ok.count() == 2 and bad.count() == 2
    assert sorted(r.region for r in ok.collect()) == ["NORTH", "SOUTH"]
    assert sorted(r.validation_reason for r in bad.collect()) == ["bad_region", "missing_id"]


def test_stream_equals_batch_on_closed_windows_and_rerun_is_idempotent(spark):
    from conftest import SF_SMALL
    from stratum.plans import catalog as C
    from stratum.plans import catalog_io as IO

    s = IO._through_silver(spark, SF_SMALL, "equiv")
    chain.run_gold(spark, s)
    streamed = read_layer(spark, s.gold_stream.path).select(*schemas.GOLD_COLUMNS)
    def rows(df):
        return sorted((tuple("" if v is None else str(v) for v in r) for r in df.collect()))

    first = rows(streamed)
    chain.run_gold(spark, s)  # same checkpoint, no new files: nothing changes
    assert rows(read_layer(spark, s.gold_stream.path).select(*schemas.GOLD_COLUMNS)) == first
    silver = chain.read_silver(spark, s)
    horizon = silver.agg(F.max("created_at")).collect()[0][0]
    import datetime as _dt

    cutoff = horizon.replace(tzinfo=None) - _dt.timedelta(seconds=30)
    batch = C.q_gold_batch(spark, SF_SMALL).filter(F.col("window_end") <= F.lit(cutoff))
    assert first == rows(batch)
    assert len(first) > 0


def test_live_rate_fanout_runs_for_bounded_time(spark, tmp_root):
    s = Settings(root=tmp_root, rows_per_second=50, trigger="1 second", runtime_seconds=8,
                 window="2 seconds", watermark="1 second")
    chain.run_quality_fanout(spark, s)  # rate source, processing-time trigger
    valid = spark.read.parquet(s.valid.path)
    assert valid.count() > 0
    assert set(valid.columns) >= set(schemas.COUNTER_EVENT_COLUMNS)
    import glob

    assert not glob.glob(os.path.join(s.invalid.path, "**", "*.parquet"), recursive=True)


def test_require_layers(spark, tmp_root):
    import pytest

    from stratum.operators.audit import require_layers

    with pytest.raises(RuntimeError, match="gold"):
        require_layers(spark, {"gold": tmp_root + "/nope"})


def test_generated_contract_events_through_the_chain(spark, tmp_root):
    import glob

    from stratum.sinks.files import write_jsonl
    from stratum.sources import synthetic

    s = Settings(root=tmp_root, window="1 day")
    keys = spark.range(0, 400).select(
        F.col("id").alias("k"), F.lit("2026-01-01").cast("timestamp_ntz").alias("d"))
    events = synthetic.contract_events(keys, "k", "d")
    write_jsonl(events, s.landing_path)
    line = open(sorted(glob.glob(os.path.join(s.landing_path, "*.json")))[0]).readline()
    created = json.loads(line)["created_at"]
    assert created.startswith("2026-01-01T") and created.endswith("Z") and len(created) == 27
    chain.run_chain(spark, s)
    negative = events.filter(F.col("financed_amount") < 0).count()
    reasons = {r.validation_reason for r in chain.read_quarantine(spark, s).collect()}
    assert chain.read_quarantine(spark, s).count() == negative and reasons <= {"nonpositive_amount"}
    assert chain.read_silver(spark, s).count() == 400 - negative
    gold = chain.read_gold(spark, s.gold.path)
    assert gold.agg(F.sum("financing_count")).collect()[0][0] == 400 - negative


def test_command_line_stages(spark, tmp_root, monkeypatch, capsys):
    monkeypatch.setenv("STRATUM_ROOT", tmp_root)
    monkeypatch.setenv("STRATUM_WINDOW", "1 day")
    chain.main(["generate", "300", "2026-01-01"], spark=spark)
    chain.main(["chain"], spark=spark)
    chain.main(["report", "summary"], spark=spark)
    chain.main(["audit"], spark=spark)
    out = capsys.readouterr().out
    assert "financing_count" in out and "reconcile:bronze-silver-quarantine" in out
    s = Settings.from_env()
    audit_rows = {r.layer: r.row_count for r in chain.run_audit(spark, s).collect()}
    assert audit_rows["bronze"] == 300
    assert audit_rows["reconcile:bronze-silver-quarantine"] == 0
    assert audit_rows["reconcile:silver_ids-gold_count"] == 0
    import pytest

    with pytest.raises(SystemExit):
        chain.main(["nope"], spark=spark)


def test_state_width_applies_to_checkpoint_and_restores_session(spark, tmp_root):
    from conftest import SF_SMALL
    from stratum.sources import tables

    before = spark.conf.get("spark.sql.shuffle.partitions")
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    s = Settings(root=tmp_root, window="1 hour", state_partitions=3)
    events = jobs.table_stream(spark, SF_SMALL, "events", schema)
    jobs.await_all([jobs.start_category_summary(spark, tables.transactions(events), s)])
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    offsets = open(os.path.join(s.summary.checkpoint, "offsets", "0")).read()
    assert '"spark.sql.shuffle.partitions":"3"' in offsets


def test_hot_directory_is_spread_over_tasks(spark, tmp_root):
    import glob

    from stratum.sinks import files

    path = tmp_root + "/hot"
    writer = files.replay_safe_batch_writer(path, partition_by=("region",))
    batch = spark.range(1000).selectExpr(
        "CASE WHEN id < 900 THEN 'HOT' ELSE 'COLD' END AS region", "id")
    # stateful micro-batches run without AQE; mimic that so nothing is coalesced
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        writer(batch, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hot = glob.glob(os.path.join(path, "batch_id=0", "region=HOT", "*.parquet"))
    cold = glob.glob(os.path.join(path, "batch_id=0", "region=COLD", "*.parquet"))
    assert len(hot) > 1 and len(cold) >= 1
    assert spark.read.parquet(path).count() == 1000


def test_compaction_is_crash_safe_and_exact(spark, tmp_root):
    from helpers import frame
    from stratum.operators import summarize

    s = Settings(root=tmp_root, window="10 seconds")
    first = [base_row(financing_id=f"A{i}", financed_amount=10.0 + i,
                      created_at=at(0, 0, i % 30)) for i in range(20)]
    late = [base_row(financing_id=f"B{i}", financed_amount=5.05,
                     created_at=at(0, 0, i % 5)) for i in range(7)]  # old windows again
    chain.write_silver_batch(spark, s, frame(spark, first))
    chain.run_gold_partials(spark, s)
    assert chain.compact_gold_partials(spark, s) == 0
    chain.write_silver_batch(spark, s, frame(spark, late))
    chain.run_gold_partials(spark, s)
    # an interrupted compaction: folder without its completion marker
    os.makedirs(os.path.join(s.gold_partials_base, "upto=99"))
    got = sorted(tuple(r) for r in chain.incremental_gold(spark, s).collect())
    full = summarize.gold_summary(frame(spark, first + late), "10 seconds")
    assert got == sorted(tuple(r) for r in full.collect())
    assert chain.compact_gold_partials(spark, s) == 1
    assert sorted(tuple(r) for r in chain.incremental_gold(spark, s).collect()) == got


def test_gold_stream_recovers_from_a_failed_batch_without_duplicates(spark, tmp_root):
    import pytest

    s = Settings(root=tmp_root, window="10 seconds", watermark="30 seconds")
    _silver_files(s.silver.path, [[at(0, 0, 5), at(0, 0, 7), at(0, 5, 0)]])

    def crash(batch, batch_id):
        raise RuntimeError("executor lost")  # after the Parquet write of this batch

    with pytest.raises(Exception):
        jobs.await_all([jobs.start_gold(spark, s, extra_sinks=[crash])])
    chain.run_gold(spark, s)  # restart on the same checkpoint: the batch is replayed
    out = read_layer(spark, s.gold_stream.path).collect()
    assert [(r.window_start.strftime("%H:%M:%S"), r.financing_count) for r in out] == [("00:00:00", 2)]


def test_byte_bound_replaces_file_bound(spark, tmp_root):
    s = Settings(root=tmp_root, max_bytes_per_trigger=1000)
    assert jobs.batch_limit(s) == {"maxBytesPerTrigger": "1000"}
    assert jobs.batch_limit(s, gold=True) == {}
    assert jobs.batch_limit(Settings(root=tmp_root, gold_max_files_per_trigger=7), gold=True) == {"maxFilesPerTrigger": "7"}
    assert jobs.batch_limit(Settings(root=tmp_root, max_files_per_trigger=0)) == {}
    os.makedirs(s.landing_path, exist_ok=True)
    for i in range(3):
        with open(os.path.join(s.landing_path, f"f{i}.jsonl"), "w") as f:
            f.write("\n".join(_line(financing_id=f"F{i}{j}") for j in range(5)) + "\n")
    query = jobs.start_bronze(spark, s)
    jobs.await_all([query])
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3  # one file per batch
    assert read_layer(spark, s.bronze.path).count() == 15


def test_rocksdb_state_store_is_opt_in_and_scoped(spark, tmp_root):
    from conftest import SF_SMALL
    from stratum.sources import tables

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    s = Settings(root=tmp_root, window="1 hour", state_store="rocksdb", state_partitions=2)
    events = jobs.table_stream(spark, SF_SMALL, "events", schema)
    jobs.await_all([jobs.start_category_summary(spark, tables.transactions(events), s)])
    assert spark.conf.get(key, None) == before
    offsets = open(os.path.join(s.summary.checkpoint, "offsets", "0")).read()
    assert "RocksDBStateStoreProvider" in offsets
    assert read_layer(spark, s.summary.path).count() > 0


def test_vacuum_keeps_what_readers_need(spark, tmp_root):
    from helpers import frame

    s = Settings(root=tmp_root, window="10 seconds")
    expected = None
    rows = []
    for i in range(3):  # three batches, compacted after each
        batch = [base_row(financing_id=f"R{i}{j}", financed_amount=1.0 + j, created_at=at(0, 0, j))
                 for j in range(4)]
        rows += batch
        chain.write_silver_batch(spark, s, frame(spark, batch))
        chain.run_gold_partials(spark, s)
        chain.compact_gold_partials(spark, s)
    expected = sorted(tuple(r) for r in chain.incremental_gold(spark, s).collect())
    removed = chain.vacuum_gold_partials(spark, s, keep_bases=2)
    names = sorted(os.path.basename(p) for p in removed)
    assert names == ["batch_id=0", "batch_id=1", "upto=0"]
    assert sorted(tuple(r) for r in chain.incremental_gold(spark, s).collect()) == expected
    assert chain.vacuum_gold_partials(spark, s, keep_bases=2) == []


def test_snapshot_leaves_no_stale_partition(spark, tmp_root):
    from helpers import frame

    s = Settings(root=tmp_root, window="10 seconds")
    rows = [base_row(financing_id="A", vehicle_type="CAR"), base_row(financing_id="B", vehicle_type="MOTORCYCLE")]
    chain.write_silver_batch(spark, s, frame(spark, rows))
    chain.run_snapshot(spark, s)
    assert {r.vehicle_type for r in chain.read_gold(spark, s.gold.path).collect()} == {"CAR", "MOTORCYCLE"}
    chain.write_silver_batch(spark, s, frame(spark, rows[:1]), mode="overwrite")
    chain.run_snapshot(spark, s)
    assert [r.vehicle_type for r in chain.read_gold(spark, s.gold.path).collect()] == ["CAR"]


def test_incremental_snapshot_when_every_row_is_rejected(spark, tmp_root):
    from helpers import frame

    s = Settings(root=tmp_root, window="10 seconds")
    chain.write_silver_batch(spark, s, frame(spark, [base_row(region="NOWHERE")]))
    chain.run_snapshot_incremental(spark, s)
    assert chain.read_gold(spark, s.gold.path).collect() == []
    chain.write_silver_batch(spark, s, frame(spark, [base_row()]))
    chain.run_snapshot_incremental(spark, s)
    assert chain.read_gold(spark, s.gold.path).count() == 1
