"""Windows that close by event time over partials, and rows that come too late."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import UTC, base_row, frame
from stratum import schemas
from stratum.plans import chain
from stratum.settings import Settings


def at(second):
    return dt.datetime(2026, 1, 1, tzinfo=UTC) + dt.timedelta(seconds=second)


def land(spark, s, rows, files=1):
    """Accepted rows as new silver files."""
    df = frame(spark, [base_row(financing_id=f"F{t}-{i}", created_at=at(t)) for i, t in rows])
    chain.write_silver_batch(spark, s, df.repartition(files))


def count(df):
    return df.agg(F.coalesce(F.sum("financing_count"), F.lit(0))).first()[0]


def windows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("cap", [1, 3, 0])
def test_any_number_of_batches_closes_the_same_windows(spark, tmp_root, cap):
    r = random.Random(5)
    rows = [(i, r.randrange(200)) for i in range(60)]  # in no order of time
    s = Settings(root=f"{tmp_root}/{cap}", window="10 seconds", watermark="30 seconds", max_files_per_trigger=cap)
    land(spark, s, rows, files=8)
    chain.run_closed_windows(spark, s)
    last = max(t for _, t in rows) - 30
    want = chain.gold_snapshot(spark, s).where(F.col("window_end") <= F.lit(at(last)).cast("timestamp_ntz"))
    assert windows(chain.read_closed(spark, s)) == windows(want)
    assert windows(chain.read_closed(spark, s, schemas.KIND_LATE)) == []


def test_each_window_is_emitted_once_and_late_rows_are_kept(spark, tmp_root):
    s = Settings(root=tmp_root, window="10 seconds", watermark="30 seconds")
    silver = 0
    emitted = {}
    for rows in ([5, 7, 12, 61], [8, 33, 90], [6, 14, 15, 200], [20, 21, 199, 260], [261]):
        land(spark, s, list(enumerate(rows, silver)))
        silver += len(rows)
        chain.run_closed_windows(spark, s)
        closed = {r.window_start: r.financing_count for r in chain.read_closed(spark, s).collect()}
        assert {k: closed[k] for k in emitted} == emitted  # what was emitted stays
        emitted = closed
        upto = dt.datetime.fromisoformat(chain.versioned.current(spark, s.gold_closed.path).notes["watermark"])
        still_open = chain.gold_snapshot(spark, s).where(F.col("window_end") > F.lit(upto).cast("timestamp_ntz"))
        late = chain.read_closed(spark, s, schemas.KIND_LATE)
        assert count(chain.read_closed(spark, s)) + count(late) + count(still_open) == silver
    assert count(chain.read_closed(spark, s, schemas.KIND_LATE)) == 6  # 8, 6, 14, 15 and 20, 21
    assert windows(chain.read_closed(spark, s).select("window_start")) == [
        (at(t).replace(tzinfo=None),) for t in (0, 10, 30, 60, 90, 190, 200)]


def test_a_repeated_or_failed_call_changes_nothing(spark, tmp_root, monkeypatch):
    s = Settings(root=tmp_root, window="10 seconds", watermark="30 seconds")
    land(spark, s, [(1, 5), (2, 70)])
    chain.run_gold_partials(spark, s)
    real = chain.versioned._commit
    monkeypatch.setattr(chain.versioned, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        chain.close_windows(spark, s)
    monkeypatch.setattr(chain.versioned, "_commit", real)
    assert chain.close_windows(spark, s) == chain.close_windows(spark, s) == "2026-01-01 00:00:40"
    chain.compact_gold_partials(spark, s)
    assert chain.close_windows(spark, s) == "2026-01-01 00:00:40"
    land(spark, s, [(3, 6), (4, 120)])
    chain.run_closed_windows(spark, s)  # base and newer batches together
    assert [(r.window_start.second + 60 * r.window_start.minute, r.financing_count) for r in chain.read_closed(spark, s).orderBy("window_start").collect()] == [(0, 1), (70, 1)]
    assert count(chain.read_closed(spark, s, schemas.KIND_LATE)) == 1


def test_no_rows(spark, tmp_root):
    s = Settings(root=tmp_root, window="10 seconds")
    chain.write_silver_batch(spark, s, frame(spark, [base_row(region="nowhere")]))
    chain.run_closed_windows(spark, s)
    assert chain.versioned.current(spark, s.gold_closed.path) is None
