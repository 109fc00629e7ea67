"""Physical-plan properties the scale design relies on."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from stratum.operators import audit
from stratum.operators.merge import latest_per_key, upsert
from stratum.sources import tables

STREAMING_OR_FILE_KEYS = {
    "bronze_ingest", "bronze_incremental", "jsonl_line_count", "silver_stream", "quarantine",
    "gold_stream_closed", "gold_snapshot", "medallion_chain", "layer_audit", "gold_upsert",
    "category_summary_stream", "valid_partitioned", "fanout_summary", "gold_incremental",
    "contract_raw_violations", "gold_closed_windows", "layer_reconcile", "contract_document",
    "report_summary_positions", "report_windows_positions", "gold_positions",
}


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_window_summary_is_partial_then_final_aggregate(spark):
    p = plan(E.queries()["category_summary"](spark, SF_SMALL))
    assert "partial_count" in p and "partial_sum" in p
    assert "Exchange" in p and "hashpartitioning" in p
    assert "Window " not in p and "CartesianProduct" not in p
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p


def test_financing_source_prunes_columns(spark):
    p = plan(E.queries()["silver_batch"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p


def test_filters_reach_the_scan_below_the_spread(spark):
    orders = tables.table(spark, SF_SMALL, "orders", spread=True)
    df = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select("o_orderkey")
    p = plan(df, "simple")
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


@pytest.mark.parametrize("name", sorted(set(E.queries()) - STREAMING_OR_FILE_KEYS))
def test_no_python_udfs_or_cartesian_products(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL), "simple")
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, bad


def test_upsert_is_an_equi_anti_join(spark):
    cur = spark.range(1000).selectExpr("id AS k", "id AS v")
    upd = spark.range(500, 1500).selectExpr("id AS k", "id * 2 AS v")
    p = plan(upsert(cur, upd, ["k"]), "simple")
    assert "LeftAnti" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_latest_per_key_uses_partial_aggregation(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS seq", "id * 3 AS v")
    p = plan(latest_per_key(df, ["k"], "seq"), "simple")
    assert "partial_max_by" in p
    assert "Window" not in p


def test_audit_has_no_cross_join(spark):
    a = spark.range(10).selectExpr("cast(id as string) AS financing_id")
    g = spark.range(3).selectExpr("id AS financing_count")
    out = audit.audit(spark, {"bronze": a, "silver": a, "quarantine": a.limit(0), "gold": g})
    p = plan(out, "simple")
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    rows = {r.layer: r.row_count for r in out.collect()}
    assert rows["reconcile:bronze-silver-quarantine"] == 0
    assert rows["reconcile:silver_ids-gold_count"] == 7


def test_silver_read_prunes_to_valid_partition(spark, tmp_root):
    from helpers import base_row, frame
    from stratum.plans import chain
    from stratum.settings import Settings

    s = Settings(root=tmp_root)
    chain.write_silver_batch(spark, s, frame(spark, [base_row(), base_row(region="XX")]))
    p = plan(chain.read_silver(spark, s), "simple")
    assert "PartitionFilters: [isnotnull(quality" in p and "(quality#" in p
    assert chain.read_silver(spark, s).count() == 1
    assert chain.read_quarantine(spark, s).count() == 1


def test_merge_reads_only_touched_partitions(spark, tmp_root):
    from stratum.operators.merge import _touched_partitions

    target = tmp_root + "/t"
    spark.range(200).selectExpr("id AS k", "concat('p', id % 20) AS part", "id AS v") \
        .write.partitionBy("part").parquet(target)
    current = spark.read.schema("k long, v long, part string").parquet(target)
    updates = spark.createDataFrame([(1, "p1", 9), (2, "p2", 9), (3, None, 9)], "k long, part string, v long")
    p = plan(_touched_partitions(current, updates, ["part"]), "simple")
    assert "PartitionFilters: [" in p and "IN ([p1],[p2])" in p and "isnull(part" in p
    assert _touched_partitions(current, updates, ["part"]).count() == 20
