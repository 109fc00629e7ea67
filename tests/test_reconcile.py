"""Row-level reconciliation: fingerprints and multiset differences."""

from pyspark.sql import functions as F

from helpers import base_row, frame
from stratum.operators import audit
from stratum.plans import chain
from stratum.settings import Settings
from stratum.sinks.files import write_jsonl
from test_plans import plan

COLUMNS = ["a", "b"]


def table(spark, rows):
    return spark.createDataFrame(rows, "a long, b string")


def test_fingerprints_tell_multisets_apart_and_ignore_order(spark):
    rows = [(1, "x"), (1, "x"), (2, None), (None, "2"), (None, None), (3, "")]
    same = audit.fingerprint(table(spark, rows).repartition(5), COLUMNS).first()
    assert audit.fingerprint(table(spark, rows[::-1]), COLUMNS).first() == same
    for other in ([*rows[1:], rows[2]], [(2, "x"), *rows[1:]], [*rows[:2], (None, None), *rows[3:]], rows[:-1], [*rows[:-1], (3, None)]):
        assert audit.fingerprint(table(spark, other), COLUMNS).first() != same
    empty = audit.fingerprint(table(spark, []), COLUMNS).first()
    assert tuple(map(int, empty)) == (0, 0, 0)


def test_a_lost_and_a_repeated_row_are_both_reported(spark):
    rows = [(i, "v") for i in range(10)] + [(0, "v")]
    found = [r for r in rows if r[0] != 4] + [(7, "v")]
    got = audit.reconcile({"c": (table(spark, rows), table(spark, found), COLUMNS)}).collect()
    assert [tuple(r) for r in got] == [("c", 11, 1, 1)]
    assert [tuple(r) for r in audit.reconcile({"c": (table(spark, []), table(spark, []), COLUMNS)}).collect()] == [("c", 0, 0, 0)]
    p = plan(audit.row_differences(table(spark, rows), table(spark, found), COLUMNS), "simple")
    assert "partial_sum" in p and "Join" not in p


def test_layers(spark, tmp_root):
    s = Settings(root=tmp_root, window="1 day")
    rows = [base_row(financing_id=f"F{i}", region="xx" if i % 4 == 0 else " south ") for i in range(12)]
    write_jsonl(frame(spark, rows), s.landing_path)
    chain.run_chain(spark, s)
    assert {tuple(r) for r in chain.run_reconcile(spark, s).collect()} == {("bronze-silver", 12, 0, 0), ("silver-gold", 1, 0, 0)}
    # one accepted row is lost and another stands twice: counts agree, rows don't
    valid = chain.read_refined(spark, s, "valid").cache()
    lost, twice = [r.financing_id for r in valid.limit(2).collect()]
    changed = valid.where(F.col("financing_id") != lost).unionByName(valid.where(F.col("financing_id") == twice))
    other = Settings(root=tmp_root + "/other", window="1 day")
    whole = changed.unionByName(chain.read_refined(spark, s, "rejected"))
    whole.write.partitionBy("quality").parquet(other.silver.path)
    chain.read_layer(spark, s.bronze.path).write.parquet(other.bronze.path)
    chain.run_snapshot(spark, other)
    got = {r.check: tuple(r)[1:] for r in chain.run_reconcile(spark, other).collect()}
    assert got["bronze-silver"] == (12, 1, 1) and got["silver-gold"] == (1, 0, 0)
