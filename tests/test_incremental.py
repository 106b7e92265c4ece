from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from replaystats.operators import aggregates as agg
from replaystats.operators import incremental
from replaystats.plans import snapshots as plan
from replaystats.schema import WATERMARK
from tests.conftest import rows, times

AS_OF = datetime(2025, 1, 10, 12)
KEY = plan.JOB_KEY


def marks(spark, data):
    return times(spark.createDataFrame(data, "key string, last_loaded_at string"), "last_loaded_at")


def test_window_from_watermark(spark):
    window = incremental.scan_window(marks(spark, [(KEY, "2025-01-09 12:00:00"), ("x", "2020-01-01")]), KEY, AS_OF)
    assert window == (datetime(2025, 1, 8), AS_OF - timedelta(minutes=5))


def test_first_run(spark):
    for meta in (spark.createDataFrame([], WATERMARK), marks(spark, [(KEY, None)])):
        assert incremental.scan_window(meta, KEY, AS_OF).start.year == 1969
        window = incremental.scan_window(meta, KEY, AS_OF, first_run=None)
        assert window.start is None
        rows_in = incremental.rows_in(times(spark.createDataFrame([("2025-01-01",)], "start_time string"), "start_time"), window)
        assert rows_in.count() == 0


def test_advance_watermark(spark):
    meta = incremental.advance_watermark(marks(spark, [("x", "2020-01-01"), (KEY, None)]), KEY, AS_OF)
    got = rows(meta.withColumn("t", F.col("last_loaded_at").cast("string")), "key", "t")
    assert got == [(KEY, "2025-01-10 12:00:00"), ("x", "2020-01-01 00:00:00")]
    assert incremental.read_watermark(meta, KEY) == AS_OF


def tables(spark):
    players = spark.createDataFrame(
        [("m1", 1, 10.0), ("m2", 1, 11.0), ("m3", 1, 12.0), ("m4", 1, 13.0), ("m5", 1, 14.0), ("m6", 1, None), ("m2", None, 9.0)],
        "replay_id string, user_id int, skill float",
    )
    matches = times(
        spark.createDataFrame(
            [
                ("m1", "1v1", "2025-01-07 23:59:59"),  # before the look-back: lost
                ("m2", "1v1", "2025-01-08 00:00:00"),  # exactly at its start: taken
                ("m3", None, "2025-01-09 00:00:00"),  # no category
                ("m4", "1v1", "2025-01-10 11:54:59"),
                ("m5", "1v1", "2025-01-10 11:55:00"),  # too fresh
                ("m6", "FFA", "2025-01-09 00:00:00"),  # NULL skill is a snapshot too
            ],
            "replay_id string, category string, start_time string",
        ),
        "start_time",
    )
    return players, matches


def test_new_snapshots_and_late_rows(spark):
    players, matches = tables(spark)
    window = incremental.ScanWindow(datetime(2025, 1, 8), AS_OF - timedelta(minutes=5))
    stored = plan.candidate_snapshots(players, matches, window).filter("false")
    new = plan.new_snapshots(plan.candidate_snapshots(players, matches, window), stored, window)
    assert rows(new, "user_id", "category", "skill") == [(1, "1v1", 11.0), (1, "1v1", 13.0), (1, "FFA", None)]
    again = plan.new_snapshots(plan.candidate_snapshots(players, matches, window), new, window)
    assert again.count() == 0


def test_equal_keys_keep_the_highest_skill(spark):
    players, matches = tables(spark)
    window = incremental.ScanWindow(datetime(2025, 1, 8), AS_OF)
    doubled = players.unionByName(players.withColumn("skill", F.col("skill") + 5))
    new = plan.new_snapshots(
        plan.candidate_snapshots(doubled, matches, window), plan.candidate_snapshots(players, matches, window).filter("false"), window
    )
    assert rows(new.filter("category = '1v1'"), "skill") == [(16.0,), (18.0,), (19.0,)]


def test_latest_skill_and_its_increment(spark):
    snapshots = times(
        spark.createDataFrame(
            [(1, "a", 1.0, "2025-01-01"), (1, "a", 3.0, "2025-01-03"), (1, "a", 2.0, "2025-01-02"), (2, "a", 9.0, "2025-01-01")],
            "user_id int, category string, skill float, start_time string",
        ),
        "start_time",
    )
    whole = agg.latest_skill(snapshots)
    assert rows(whole, "user_id", "latest_skill") == [(1, 3.0), (2, 9.0)]
    late = agg.merge_latest_skill(agg.latest_skill(snapshots.filter("skill > 2")), snapshots.filter("skill <= 2"))
    assert rows(late) == rows(whole)
