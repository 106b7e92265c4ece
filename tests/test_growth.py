"""Steps of the hourly run whose work must not exceed what their input needs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from replaystats.operators import aggregates as agg
from replaystats.operators import upserts
from replaystats.plans import players as player_plan
from replaystats.session import stage
from replaystats.sources import tables as t
from replaystats.sources.tables import Tables
from tests.conftest import rows, times
from tests.test_plans import plan_of


@pytest.fixture
def small_broadcasts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_documents_stay_where_they_are_when_the_cache_is_aged_out(spark, small_broadcasts):
    """Only keys move to find the copies of a match on both sides of the limit."""
    start = F.timestamp_seconds(F.lit(1735689600) + F.col("id") * 8)  # from 2025-01-01
    made = spark.range(20000).select(F.col("id").cast("string").alias("replay_id"), start.alias("start_time"), F.repeat(F.md5(F.col("id").cast("string")), 4).alias("raw_json"))
    cache = stage(made, "cache")
    remaining, _ = upserts.age_out(cache, cache.limit(0), "2025-01-03 00:00:00")
    plan = plan_of(remaining)
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert remaining.count() == 20000 - 86400 // 8


def test_copies_on_both_sides_of_the_limit_move_together(spark):
    data = [
        ("a", "2025-01-01 00:00:00", "1"), ("a", "2025-01-02 12:00:00", "2"), ("a", None, "3"),
        ("b", "2025-01-02 12:00:00", "1"), ("b", None, "2"), (None, "2025-01-01 00:00:00", "1"),
    ]
    cache = times(spark.createDataFrame(data, "replay_id string, start_time string, raw_json string"), "start_time")
    remaining, moved = upserts.age_out(cache, cache.limit(0), "2025-01-03 00:00:00")
    assert rows(remaining, "replay_id", "raw_json") == [("b", "1"), ("b", "2"), (None, "1")]
    assert rows(moved, "replay_id", "raw_json") == [("a", "1")]


def test_lobby_stats_gather_no_sets(spark):
    data = [
        ("m", 1, "red", 1, 10.0), ("m", 2, "red", 2, 20.0), ("m", 3, "blue", 2, 30.0), ("m", 4, "blue", None, 40.0),
        ("m", 4, None, 2, 50.0), ("m", None, "green", 9, 99.0), ("n", 1, None, None, 5.0), ("o", 1, "red", 1, None),
    ]
    players = spark.createDataFrame(data, "replay_id string, user_id int, ally_team_id string, player_id int, skill float")
    stats = agg.lobby_stats(players)
    assert rows(stats, "replay_id", "player_count", "team_count", "avg_lobby_skill") == [("m", 2, 2, 30.0), ("n", 0, 0, 5.0)]
    assert "collect_set" not in plan_of(stats)


def test_a_join_with_an_empty_table_moves_nothing(spark, tmp_path):
    """Before the first write the other side stays where it is, broadcasts or not."""
    tables = Tables(spark, str(tmp_path / "tables"))
    made = spark.range(2000).select(F.col("id").cast("string").alias("replay_id"), F.md5(F.col("id").cast("string")).alias("doc_hash"))
    documents = stage(made, "documents")
    for ledger in (tables.read(t.FLATTENED), tables.read_days(t.FLATTENED)):
        fresh = player_plan.not_flattened(documents, ledger)
        assert "Exchange" not in plan_of(fresh) and fresh.count() == 2000
    assert tables.read_days(t.MATCHES).columns == [*t.SCHEMAS[t.MATCHES].names, "start_date"]
    assert "Exchange" not in plan_of(documents.join(tables.read(t.MATCHES), "replay_id", "left_anti"))


def test_a_join_of_small_partitions_sorts_neither_side(spark, small_broadcasts):
    made = spark.range(20000).select(F.col("id").cast("string").alias("replay_id"), F.md5(F.col("id").cast("string")).alias("name"))
    left, right = stage(made, "left"), stage(made.filter("id % 2 = 0").withColumnRenamed("name", "other"), "right")
    joined = left.join(right, "replay_id")
    assert len(joined.collect()) == 10000
    final = plan_of(joined).split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
