"""Layers read against a declared schema."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from helpers import base_row, frame
from stratum.plans import chain
from stratum.session import ensure_dir
from stratum.settings import Settings
from stratum.sinks.files import write_jsonl
from stratum.sinks.layers import Differences, read_reconciled

DECLARED = StructType([StructField("k", LongType()), StructField("v", StringType()), StructField("segment", StringType())])


def test_empty_layer(spark, tmp_root):
    ensure_dir(spark, tmp_root + "/none")
    df, found = read_reconciled(spark, tmp_root + "/none", DECLARED, ["segment"])
    assert df.schema == DECLARED and df.collect() == []
    assert found == Differences(missing=("k", "v", "segment"), empty=True)


def test_added_and_missing_columns_over_time(spark, tmp_root):
    path = tmp_root + "/t"
    spark.createDataFrame([(1, "a")], "k long, segment string").write.partitionBy("segment").parquet(path)
    spark.createDataFrame([(2, "x", 7, "b")], "k long, v string, extra int, segment string").write.mode("append").partitionBy("segment").parquet(path)
    df, found = read_reconciled(spark, path, DECLARED, ["segment"])
    assert df.columns == ["k", "v", "segment", "extra"]
    assert sorted(map(tuple, df.collect())) == [(1, None, "a", None), (2, "x", "b", 7)]
    assert found == Differences(added=("extra",))
    _, found = read_reconciled(spark, path + "/segment=a", StructType.fromDDL("k long, v string"))
    assert found == Differences(missing=("v",))


def test_directory_values_keep_their_declared_type(spark, tmp_root):
    path = tmp_root + "/t"
    spark.createDataFrame([(1, "a", "1"), (2, "b", "02"), (3, "c", "2026-01-01"), (4, "d", None)], DECLARED).write.partitionBy("segment").parquet(path)
    df, found = read_reconciled(spark, path, DECLARED, ["segment"])
    assert df.schema == DECLARED and found == Differences()
    assert sorted((r.k, r.segment) for r in df.collect()) == [(1, "1"), (2, "02"), (3, "2026-01-01"), (4, None)]


def test_type_clashes_are_reported(spark, tmp_root):
    path = tmp_root + "/t"
    spark.createDataFrame([("1", "a"), ("many", "b")], "k string, v string").write.parquet(path)
    declared = StructType.fromDDL("k long, v string")
    df, found = read_reconciled(spark, path, declared)
    assert df.schema == declared and found == Differences(clashes=(("k", "bigint", "string"),))
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "a"), (None, "b")]
    spark.createDataFrame([(2, "c")], "k long, v string").write.mode("append").parquet(path)
    with pytest.raises(Exception, match="CANNOT_MERGE|[Ff]ailed to merge"):
        read_reconciled(spark, path, declared)


def test_audit_of_an_empty_bronze(spark, tmp_root):
    s = Settings(root=tmp_root, window="1 day")
    write_jsonl(frame(spark, [base_row()]), s.landing_path)
    chain.run_chain(spark, s)
    assert {r.layer: r.row_count for r in chain.run_audit(spark, s).collect()}["bronze"] == 1
    empty = Settings(root=tmp_root + "/empty", window="1 day")
    ensure_dir(spark, empty.bronze.path)
    chain.write_silver_batch(spark, empty, frame(spark, [base_row()]).where(F.lit(False)))
    chain.run_snapshot(spark, empty)
    got = {r.layer: r for r in chain.run_audit(spark, empty).collect()}
    assert got["bronze"].row_count == 0 and got["bronze"].column_count == 22 and got["reconcile:bronze-silver-quarantine"].row_count == 0
