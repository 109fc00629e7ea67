"""Versioned tables: atomic replacement, merge by whole files, lossless partitions."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from helpers import base_row, frame
from stratum import schemas
from stratum.plans import chain
from stratum.settings import Settings
from stratum.sinks import partitions, versioned
from stratum.sinks.files import write_jsonl

T = "k long, v long, part string"


def table(spark, rows):
    return spark.createDataFrame(rows, T)


def rows(spark, root):
    from pyspark.sql.types import StructType

    return sorted(map(tuple, versioned.read(spark, root, StructType.fromDDL(T)).collect()), key=str)


def schema():
    from pyspark.sql.types import StructType

    return StructType.fromDDL(T)


def files(root):
    return {f for f in glob.glob(root + "/**/*.parquet", recursive=True)}


def gold_row(segment, model="M", window=dt.datetime(2026, 1, 1), count=1):
    return (window, window + dt.timedelta(days=1), segment, "SOUTH", "CAR", "B", model, count, 1.0, 2.0, 1.5)


ODD_STRINGS = [None, "", "~", "~~", "~x", "__HIVE_DEFAULT_PARTITION__", "null", " ", "a b", "a=b", "a/b", "%41", "ü:*?{}[]^'\"#\\", "x~"]


def test_partition_values_come_back(spark, tmp_root):
    df = spark.createDataFrame([(i, i, s) for i, s in enumerate(ODD_STRINGS * 2)], T)
    versioned.replace(spark, tmp_root + "/t", df, partition_by=["part"])
    assert rows(spark, tmp_root + "/t") == sorted(((i, i, s) for i, s in enumerate(ODD_STRINGS * 2)), key=str)
    got = df.select(partitions.unspelled(partitions.spelled(F.col("part"))).alias("p")).collect()
    assert [r.p for r in got] == ODD_STRINGS * 2


def test_gold_keeps_empty_and_null_segments_apart(spark, tmp_root):
    s = Settings(root=tmp_root)
    gold = spark.createDataFrame([gold_row("", "A"), gold_row("", "B"), gold_row(None, "A"), gold_row(None, "B")], schemas.GOLD)
    chain._publish_gold(spark, s, gold)
    back = chain.read_gold(spark, s.gold.path)
    assert sorted(r.segment is None for r in back.collect()) == [False, False, True, True]
    assert back.select(*schemas.GOLD_KEY).distinct().count() == 4
    chain.upsert_gold(spark, s, spark.createDataFrame([gold_row("", "A", count=9)], schemas.GOLD))
    assert {(r.segment, r.vehicle_model): r.financing_count for r in chain.read_gold(spark, s.gold.path).collect()} == {
        ("", "A"): 9, ("", "B"): 1, (None, "A"): 1, (None, "B"): 1}


def test_decoded_partition_filter_prunes(spark, tmp_root):
    from test_plans import plan

    versioned.replace(spark, tmp_root + "/t", table(spark, [(1, 1, "a"), (2, 2, ""), (3, 3, None)]), partition_by=["part"])
    df = versioned.read(spark, tmp_root + "/t", schema()).filter(F.col("part") == "")
    assert [r.k for r in df.collect()] == [2]
    p = plan(df, "simple")
    assert "PartitionFilters: [" in p and "CASE WHEN StartsWith(part" in p.split("PartitionFilters: [", 1)[1]


STEPS = ("_write", "_written", "_commit", "vacuum")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("how", ["replace", "merge"])
def test_a_run_that_dies_at_any_step_leaves_the_table(spark, tmp_root, monkeypatch, step, how):
    root = tmp_root + "/t"
    versioned.replace(spark, root, table(spark, [(i, i, f"p{i % 3}") for i in range(9)]), partition_by=["part"])
    before = rows(spark, root)
    new = table(spark, [(1, 100, "p1"), (50, 50, "p2")])

    def run():
        if how == "replace":
            versioned.replace(spark, root, new, partition_by=["part"])
        else:
            versioned.merge(spark, root, new, ["k", "part"], schema=schema())

    real = getattr(versioned, step)

    def dies(*args, **kw):
        if step in ("_write", "_written"):
            real(*args, **kw)  # half of the work is there
        raise RuntimeError("killed")

    monkeypatch.setattr(versioned, step, dies)
    with pytest.raises(RuntimeError, match="killed"):
        run()
    monkeypatch.undo()
    after = [(1, 100, "p1"), (50, 50, "p2")] if how == "replace" else sorted(
        [r for r in before if r[0] != 1] + [(1, 100, "p1"), (50, 50, "p2")], key=str)
    assert rows(spark, root) == (after if step == "vacuum" else before)  # committed before the clean-up
    run()
    run()
    assert rows(spark, root) == after
    live = set(versioned.current(spark, root).files)
    versioned.vacuum(spark, root, keep=1)
    assert {f[len(root) + 1:] for f in files(root)} == live  # nothing abandoned is left


def test_unfinished_and_contested_manifests(spark, tmp_root):
    root = tmp_root + "/t"
    versioned.replace(spark, root, table(spark, [(1, 1, "a")]))
    path = root + "/_manifest/2.json"
    with open(path, "w") as f:
        f.write('{"files": ["version=2')
    assert rows(spark, root) == [(1, 1, "a")]
    v = versioned.replace(spark, root, table(spark, [(2, 2, "b")]))
    assert v.number == 3 and rows(spark, root) == [(2, 2, "b")]
    with pytest.raises(Exception, match="exists"):  # another writer has the number
        versioned._commit(spark, root, versioned.Version(3, ()))
    assert rows(spark, root) == [(2, 2, "b")]


def test_merge_keeps_files_without_a_touched_key(spark, tmp_root):
    root = tmp_root + "/t"
    first = table(spark, [(i, i, f"p{i % 4}") for i in range(400)]).repartitionByRange(4, "k")
    from stratum.sinks.files import write_parquet
    import stratum.sinks.versioned as V

    real = V._write
    try:  # four files a partition, each with a range of keys
        V._write = lambda spark, df, root, folder, by: write_parquet(
            partitions.encode(df, by), f"{root}/{folder}", mode="append", partition_by=by, cluster=False)
        versioned.replace(spark, root, first, partition_by=["part"])
    finally:
        V._write = real
    old = set(versioned.current(spark, root).files)
    assert len(old) == 16
    versioned.merge(spark, root, table(spark, [(1, -1, "p1"), (5, -5, "p1"), (403, -3, "p3"), (1000, 0, None)]),
                    ["k", "part"], schema=schema())
    new = set(versioned.current(spark, root).files)
    assert len(old - new) == 1 and next(iter(old - new)).split("/")[1] == "part=p1"
    got = {r[0]: r for r in rows(spark, root)}
    assert len(got) == 402 and got[1] == (1, -1, "p1") and got[5] == (5, -5, "p1") and got[9] == (9, 9, "p1")
    assert got[1000] == (1000, 0, None)


def test_merge_reads_only_the_updates_partitions(spark, tmp_root, monkeypatch):
    root = tmp_root + "/t"
    versioned.replace(spark, root, table(spark, [(i, i, f"p{i}") for i in range(12)]), partition_by=["part"])
    seen = []
    real = versioned._files
    monkeypatch.setattr(versioned, "_files", lambda spark, root, names, *a: (seen.append(list(names)), real(spark, root, names, *a))[1])
    versioned.merge(spark, root, table(spark, [(1, 9, "p1"), (3, 9, "p3")]), ["k", "part"], schema=schema())
    assert {f.split("/")[1] for names in seen for f in names} == {"part=p1", "part=p3"}


def test_merge_refuses_duplicate_keys_and_changes_nothing(spark, tmp_root):
    root = tmp_root + "/t"
    with pytest.raises(ValueError, match="share the key"):
        versioned.merge(spark, root, table(spark, [(1, 1, "a"), (1, 2, "a")]), ["k", "part"], schema=schema(), partition_by=["part"])
    assert versioned.current(spark, root) is None
    versioned.merge(spark, root, table(spark, [(1, 1, "a"), (1, 2, None)]), ["k", "part"], schema=schema(), partition_by=["part"])
    with pytest.raises(ValueError, match="share the key"):
        versioned.merge(spark, root, table(spark, [(7, 1, None), (7, 2, None)]), ["k", "part"], schema=schema())
    assert rows(spark, root) == [(1, 1, "a"), (1, 2, None)]
    with pytest.raises(ValueError, match="not in the key"):
        versioned.merge(spark, root, table(spark, [(7, 1, "a")]), ["k"], schema=schema())


def test_merges_equal_a_dictionary(spark, tmp_root):
    import random

    r = random.Random(4)
    root, want = tmp_root + "/t", {}
    for turn in range(6):
        keys = r.sample([(k, p) for k in range(12) for p in ("a", "", None, "~")], r.randrange(0, 20))
        want.update({key: turn for key in keys})
        versioned.merge(spark, root, table(spark, [(k, turn, p) for k, p in keys]), ["k", "part"], schema=schema(), partition_by=["part"])
        assert rows(spark, root) == sorted(((k, v, p) for (k, p), v in want.items()), key=str)


def test_old_versions_stay_for_running_readers(spark, tmp_root):
    root = tmp_root + "/t"
    versioned.replace(spark, root, table(spark, [(1, 1, "a")]))
    reader = versioned.read(spark, root, schema())
    versioned.replace(spark, root, table(spark, [(2, 2, "b")]))
    assert [tuple(r) for r in reader.collect()] == [(1, 1, "a")]
    versioned.replace(spark, root, spark.createDataFrame([], T))
    assert rows(spark, root) == [] and not glob.glob(root + "/version=1-*")


def test_incremental_run_rewrites_changed_windows_only(spark, tmp_root):
    s = Settings(root=tmp_root, window="1 day", gold_partitions=("window_date",))

    def land(day, n, amount):
        made = [base_row(financing_id=f"F{day}-{amount}-{i}", financed_amount=amount, created_at=dt.datetime(2026, 1, day, i % 24, tzinfo=dt.timezone.utc)) for i in range(n)]
        write_jsonl(frame(spark, made), s.landing_path)
        chain.run_bronze(spark, s)
        chain.run_silver(spark, s)
        chain.run_snapshot_incremental(spark, s)

    def same_as_recomputed():
        want = chain.gold_snapshot(spark, s)
        got = chain.read_gold(spark, s.gold.path)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    def by_date():
        out = {}
        for f in versioned.current(spark, s.gold.path).files:
            out.setdefault(f.split("/")[1], set()).add(f)
        return out

    for day in (1, 2, 3):
        land(day, 4, 100.0)
    first = by_date()
    assert set(first) == {f"window_date=2026-01-0{d}" for d in (1, 2, 3)}
    land(4, 3, 50.0)
    second = by_date()
    assert {d: second[d] for d in first} == first and "window_date=2026-01-04" in second
    chain.compact_gold_partials(spark, s)
    land(2, 2, 7.0)  # late rows of a day before
    third = by_date()
    assert {d for d in second if third[d] != second[d]} == {"window_date=2026-01-02"}
    same_as_recomputed()
    files_before = versioned.current(spark, s.gold.path)
    chain.run_snapshot_incremental(spark, s)  # nothing new: no new version
    assert versioned.current(spark, s.gold.path) == files_before
    chain.upsert_gold(spark, s, chain.read_gold(spark, s.gold.path).limit(1).withColumn("financing_count", F.lit(-1).cast("long")))
    chain.run_snapshot_incremental(spark, s)  # gold was changed from elsewhere: published whole
    same_as_recomputed()
