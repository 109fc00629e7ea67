import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum import schemas
from stratum.functions.rules import contract_rules
from stratum.operators import validate
from stratum.operators.merge import latest_per_key, merge_into, upsert
from stratum.settings import Settings
from stratum.sinks import warehouse
from stratum.sources import synthetic

COUNTER_GOLDEN = {
    0: ("FIN-0000000000", "CUS-00000000", "CAR", 2024, "premium", "NORTH", 15000.0, 3000.0, 24, 500.0, 1.2),
    1: ("FIN-0000000001", "CUS-00000001", "MOTORCYCLE", 2025, "standard", "NORTHEAST", 15001.0, 3001.0, 25, 501.0, 1.21),
    7: ("FIN-0000000007", "CUS-00000007", "MOTORCYCLE", 2025, "standard", "MIDWEST", 15007.0, 3007.0, 31, 507.0, 1.27),
    123456789: ("FIN-0123456789", "CUS-23456789", "MOTORCYCLE", 2024, "premium", "SOUTH", 111789.0, 19789.0, 60, 1289.0, 2.09),
    12345678901: ("FIN-12345678901", "CUS-45678901", "MOTORCYCLE", 2025, "standard", "NORTHEAST", 93901.0, 21901.0, 36, 1401.0, 1.21),
}


def test_counter_generator_golden(spark):
    ts = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    rows = spark.createDataFrame([(v, ts) for v in COUNTER_GOLDEN], "value long, timestamp timestamp")
    out = synthetic.from_counter(rows).collect()
    assert len(out[0]) == 17
    for r in out:
        v = int(r.financing_id[4:]) if r.financing_id != "FIN-12345678901" else 12345678901
        assert (r.financing_id, r.customer_id, r.vehicle_type, r.vehicle_year, r.segment, r.region,
                r.financed_amount, r.down_payment, r.installment_count, r.monthly_installment,
                r.interest_rate_monthly) == COUNTER_GOLDEN[v]
        assert r.vehicle_brand == ("Toyota" if r.vehicle_type == "CAR" else "Honda")


def test_contract_events_deterministic_and_partition_independent(spark):
    keys = spark.range(0, 4000).select(F.col("id").alias("k"),
                                       F.lit("2026-01-01").cast("timestamp_ntz").alias("d"))
    a = synthetic.contract_events(keys, "k", "d").orderBy("financing_id").collect()
    b = synthetic.contract_events(keys.repartition(7), "k", "d").orderBy("financing_id").collect()
    assert a == b
    bad = sum(1 for r in a if r.financed_amount < 0)
    assert 100 < bad < 320  # about 5 %
    for r in a:
        assert (r.financed_amount < 0) == (r.monthly_installment < 0)
        assert 15000 <= r.financed_amount <= 150000 or -5000 <= r.financed_amount <= -100
        assert r.installment_count in (24, 36, 48, 60)
        assert 1.29 <= r.interest_rate_monthly <= 1.99
        assert r.down_payment >= 0


def test_contract_events_flag_id_pattern_and_negative_amounts(spark):
    keys = spark.range(0, 500).select(F.col("id").alias("k"),
                                      F.lit("2026-01-01").cast("timestamp_ntz").alias("d"))
    checked = validate.contract_check(synthetic.contract_events(keys, "k", "d"), contract_rules())
    texts = [r.violation_text for r in checked.collect()]
    assert all(t.startswith("pattern:financing_id") for t in texts)
    assert all("required" not in t and "enum" not in t for t in texts)


def test_bad_percent_bounds(spark):
    keys = spark.range(1).select(F.col("id").alias("k"), F.current_timestamp().alias("d"))
    with pytest.raises(ValueError):
        synthetic.contract_events(keys, "k", "d", bad_percent=101)


def test_upsert_replaces_by_key_null_safe(spark):
    cur = spark.createDataFrame([("a", None, 1), ("b", "x", 2), ("c", "y", 3)], "k1 string, k2 string, v int")
    upd = spark.createDataFrame([("a", None, 10), ("d", "z", 40)], "k1 string, k2 string, v int")
    out = sorted(tuple(r) for r in upsert(cur, upd, ["k1", "k2"]).collect())
    assert out == [("a", None, 10), ("b", "x", 2), ("c", "y", 3), ("d", "z", 40)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "k string, seq int, v string")
    out = sorted(tuple(r) for r in latest_per_key(df, ["k"], "seq").collect())
    assert out == [("a", 2, "new"), ("b", 1, "only")]


def test_merge_into_rewrites_only_touched_partitions(spark, tmp_root):
    target = tmp_root + "/t"
    first = spark.createDataFrame([("p1", "a", 1), ("p1", "b", 2), ("p2", "c", 3)], "part string, k string, v int")
    merge_into(spark, target, first, ["k", "part"], partition_by=["part"])
    import glob
    import os

    p2_files = sorted(glob.glob(os.path.join(target, "part=p2", "*.parquet")))
    upd = spark.createDataFrame([("p1", "a", 10), ("p1", "z", 9)], "part string, k string, v int")
    merge_into(spark, target, upd, ["k", "part"], partition_by=["part"])
    out = sorted(tuple(r) for r in spark.read.parquet(target).select("part", "k", "v").collect())
    assert out == [("p1", "a", 10), ("p1", "b", 2), ("p1", "z", 9), ("p2", "c", 3)]
    assert sorted(glob.glob(os.path.join(target, "part=p2", "*.parquet"))) == p2_files


def test_settings_from_env():
    env = {"STRATUM_WINDOW": "1 minute", "STRATUM_ROWS_PER_SECOND": "7",
           "STRATUM_GOLD_PARTITIONS": "region, segment", "STRATUM_STRICT_NULLS": "true",
           "ROWS_PER_SECOND": "99"}
    s = Settings.from_env(env, root="s3a://bucket/x")
    assert (s.window, s.rows_per_second, s.gold_partitions, s.strict_nulls) == (
        "1 minute", 7, ("region", "segment"), True)
    assert s.bronze.path == "s3a://bucket/x/bronze"
    assert s.gold.checkpoint == "s3a://bucket/x/_checkpoints/gold"
    assert s.gold_stream.path != s.gold.path
    with pytest.raises(ValueError):
        Settings.from_env({"STRATUM_RUNTIME_SECONDS": "soon"})


def test_object_store_conf_passthrough():
    s = Settings(s3_endpoint="http://store:9000", s3_access_key="a", s3_secret_key="b")
    conf = s.spark_conf()
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_warehouse_sql_text():
    ddl = warehouse.create_table_sql("t", warehouse.GOLD_SQL_TYPES, schemas.GOLD_KEY)
    assert "PRIMARY KEY (window_start, window_end, segment, region, vehicle_type, vehicle_brand, vehicle_model)" in ddl
    assert "NUMERIC(10, 4)" in ddl
    merge = warehouse.merge_sql("t", "s", schemas.GOLD_COLUMNS, schemas.GOLD_KEY)
    assert merge.startswith("MERGE INTO t t USING s s ON t.window_start = s.window_start")
    update_clause = merge.split("UPDATE SET", 1)[1].split("\n")[0]
    assert "financing_count = s.financing_count" in update_clause
    assert "segment = s.segment" not in update_clause
    assert warehouse.reload_sql("t", "s", ["a"])[0] == "DELETE FROM t"


def test_warehouse_rows_use_sentinel_and_decimals(spark):
    ws = dt.datetime(2026, 1, 1)
    gold = spark.createDataFrame(
        [(ws, ws, None, "SOUTH", "CAR", "B", "M", 1, 10.005, 2.0, 1.23456)], schemas.GOLD)
    row = warehouse.to_warehouse(gold).collect()[0]
    assert row.segment == warehouse.NULL_KEY
    assert str(row.total_financed_amount) == "10.01"
    assert str(row.average_interest_rate_monthly) == "1.2346"


def test_merge_into_unpartitioned_target(spark, tmp_root):
    target = tmp_root + "/flat"
    merge_into(spark, target, spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), ["k"])
    merge_into(spark, target, spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int"), ["k"])
    out = sorted(tuple(r) for r in spark.read.parquet(target).collect())
    assert out == [("a", 1), ("b", 20), ("c", 30)]


def test_merge_into_resolves_duplicate_updates_by_order(spark, tmp_root):
    target = tmp_root + "/dups"
    upd = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 5, 1)], "k string, v int, seq int")
    merge_into(spark, target, upd, ["k"], order_col="seq")
    out = sorted(tuple(r) for r in spark.read.parquet(target).collect())
    assert out == [("a", 2), ("b", 5)]


@pytest.mark.parametrize("bad", [dict(money="float"), dict(window="ten seconds"), dict(rows_per_second=0),
                                 dict(max_files_per_trigger=-1)])
def test_settings_reject_bad_values(bad):
    with pytest.raises(ValueError):
        Settings(**bad)


def test_merge_leaves_partitions_between_the_touched_ones(spark, tmp_root):
    target = tmp_root + "/gaps"
    first = spark.createDataFrame(
        [("p1", "a", 1), ("p2", "b", 2), ("p3", "c", 3), (None, "d", 4)], "part string, k string, v int")
    merge_into(spark, target, first, ["k", "part"], partition_by=["part"])
    upd = spark.createDataFrame([("p1", "a", 10), ("p3", "z", 9), (None, "d", 40)], "part string, k string, v int")
    merge_into(spark, target, upd, ["k", "part"], partition_by=["part"])
    out = {(r.part, r.k, r.v) for r in spark.read.parquet(target).collect()}
    assert out == {("p1", "a", 10), ("p2", "b", 2), ("p3", "c", 3), ("p3", "z", 9), (None, "d", 40)}


def test_merge_with_several_touched_partitions(spark, tmp_root):
    target = tmp_root + "/many"
    first = spark.createDataFrame([("p1", "a", 1), ("p2", "b", 2), ("p3", "c", 3)], "part string, k string, v int")
    merge_into(spark, target, first, ["k", "part"], partition_by=["part"])
    upd = spark.createDataFrame([("p1", "a", 10), ("p2", "z", 9)], "part string, k string, v int")
    merge_into(spark, target, upd, ["k", "part"], partition_by=["part"])
    out = sorted(tuple(r) for r in spark.read.parquet(target).select("part", "k", "v").collect())
    assert out == [("p1", "a", 10), ("p2", "b", 2), ("p2", "z", 9), ("p3", "c", 3)]


def test_warehouse_upsert_and_reload_orchestration(spark, monkeypatch):
    staged, executed = [], []
    monkeypatch.setattr(warehouse, "_stage", lambda df, s, name: staged.append((name, df.collect())))
    monkeypatch.setattr(warehouse, "_execute", lambda sp, s, stmts: executed.append(list(stmts)))
    s = Settings(jdbc_url="jdbc:any://host/db", jdbc_table="gold_t")
    ws = dt.datetime(2026, 1, 1)
    gold = spark.createDataFrame(
        [(ws, ws, None, "SOUTH", "CAR", "B", "M", 3, 10.005, 2.0, 1.23456)], schemas.GOLD)
    warehouse.batch_upsert_sink(s)(gold, 7)
    assert staged[0][0] == "gold_t_stage_b7"
    row = staged[0][1][0]
    assert row.segment == warehouse.NULL_KEY and str(row.total_financed_amount) == "10.01"
    assert executed[0][0].startswith("CREATE TABLE IF NOT EXISTS gold_t")
    assert executed[1][0].startswith("MERGE INTO gold_t t USING gold_t_stage_b7 s")
    assert executed[1][1] == "DROP TABLE gold_t_stage_b7"
    staged.clear(), executed.clear()
    warehouse.reload(spark, gold, s)
    assert staged[0][0] == "gold_t_stage_reload"
    assert executed[1][:2] == ["DELETE FROM gold_t",
                               "INSERT INTO gold_t (" + ", ".join(schemas.GOLD_COLUMNS) + ") SELECT "
                               + ", ".join(schemas.GOLD_COLUMNS) + " FROM gold_t_stage_reload"]


def test_newer_settings_load_from_env():
    s = Settings.from_env({"STRATUM_STATE_STORE": "rocksdb", "STRATUM_MAX_BYTES_PER_TRIGGER": "1048576",
                           "STRATUM_GOLD_MAX_FILES_PER_TRIGGER": "0", "STRATUM_STATE_PARTITIONS": "64",
                           "STRATUM_MONEY": "double"})
    assert (s.state_store, s.max_bytes_per_trigger, s.gold_max_files_per_trigger, s.state_partitions,
            s.money) == ("rocksdb", 1048576, 0, 64, "double")
    with pytest.raises(ValueError):
        Settings.from_env({"STRATUM_STATE_STORE": "leveldb"})


def test_merge_refuses_partition_columns_outside_the_key(spark, tmp_root):
    rows = spark.createDataFrame([(1, "a")], "k int, part string")
    with pytest.raises(ValueError, match="part"):
        merge_into(spark, tmp_root + "/moved", rows, ["k"], partition_by=["part"])


def test_long_ids_stay_whole(spark):
    from stratum.functions.normalize import zero_padded

    rows = spark.createDataFrame([(7,), (12345678901,), (12345678902,)], "v long")
    assert [r[0] for r in rows.select(zero_padded(rows.v, 10)).collect()] == ["0000000007", "12345678901", "12345678902"]


def test_settings_hide_secrets():
    s = Settings(jdbc_password="hush", s3_secret_key="hush2")
    assert "hush" not in repr(s)


def test_draws_are_independent(spark):
    from stratum.sources.synthetic import draw

    keys = spark.range(20_000)
    d = keys.select(*[(F.pmod(draw(F.col("id"), n, 42), F.lit(1000)) / 1000.0).alias(f"d{n}") for n in (1, 2)],
                    (F.pmod(draw(F.col("id") + 2**31 - 2, 1, 42), F.lit(1000)) / 1000.0).alias("far"))
    got = d.agg(F.corr("d1", "d2").alias("streams"), F.corr("d1", "far").alias("keys"), F.avg("d1").alias("mean")).first()
    assert abs(got.streams) < 0.04 and abs(got["keys"]) < 0.04 and abs(got["mean"] - 0.5) < 0.02
