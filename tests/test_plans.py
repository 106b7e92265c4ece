"""Shapes of physical plans that must hold at scale."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.views import WINDOW, Views
from replaystats.operators import aggregates as agg
from replaystats.operators import joins, keyed
from replaystats.plans import matches as match_plan
from replaystats.plans import pages
from replaystats.sources import meta

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def plan_of(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_sides(spark):
    """Plan as for sides that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["listing_filter"](spark, SF_DIR).select("replay_id"))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "o_totalprice" not in scan


def test_both_union_sides_are_filtered_at_the_scan(spark):
    v = Views(spark, SF_DIR)
    docs = joins.prefer_left_union(v.archive(), v.cache(), "replay_id", ["start_time"])
    plan = plan_of(docs.filter(F.col("start_time") >= "1999-06-01"))
    assert plan.count("GreaterThanOrEqual(o_orderdate,1999-06-01T00:00)") >= 2


def test_top_n_cuts_before_the_shuffle(spark):
    v = Views(spark, SF_DIR)
    plan = plan_of(agg.match_history(v.base()))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit [user_id") < plan.index("Exchange hashpartitioning(user_id") < plan.rindex("WindowGroupLimit")


def test_first_per_key_cuts_before_the_shuffle(spark):
    plan = plan_of(keyed.first_per_key(Views(spark, SF_DIR).table("events"), ["user_id"], [F.col("ts")]))
    assert plan.count("WindowGroupLimit") == 2


def test_small_batch_does_not_shuffle_the_large_side(spark, tmp_path):
    batch = spark.range(10).select(F.col("id").alias("l_orderkey"))
    batch.write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    known = Views(spark, SF_DIR).table("lineitem")
    plan = plan_of(joins.not_in(batch, known, ["l_orderkey"]))
    semi = plan[plan.index("LeftSemi") :]
    scan = semi.index("lineitem.parquet")
    assert "Exchange hashpartitioning" not in semi[:scan].split("BroadcastExchange")[0]


def test_page_join_needs_no_shuffle_of_its_own(spark, large_sides):
    """Rows are moved by user only after they were reduced, and the page join adds no exchange."""
    v = Views(spark, SF_DIR)
    base = v.base()
    snapshots = v.snapshots()
    parts = pages.page_components(base, agg.latest_skill(snapshots), snapshots, *WINDOW)
    lines = plan_of(parts).splitlines()
    for number, line in enumerate(lines):
        if "SortMergeJoin [user_id" in line and "LeftOuter" in line:
            below = [text for text in lines[number + 1 : number + 3] if "Sort [" in text or "Exchange" in text]
            assert not any("Exchange" in text for text in below), line


def test_raw_matches_of_a_user_are_not_gathered(spark):
    """No exchange by user directly over joined rows: an aggregate or group limit lies under each."""
    v = Views(spark, SF_DIR)
    snapshots = v.snapshots()
    parts = pages.page_components(v.base(), agg.latest_skill(snapshots), snapshots, *WINDOW)
    lines = plan_of(parts).splitlines()
    reducing = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit", "Window ")
    for number, line in enumerate(lines):
        if "Exchange hashpartitioning(user_id" in line:
            below = "\n".join(lines[number + 1 : number + 5])
            assert any(node in below for node in reducing), below


def test_match_documents_are_parsed_once(spark, tmp_path):
    docs = [("a", '{"mapId": "7", "hasBots": "no", "Map": {"scriptName": "x"}}'), ("b", '{"mapId": "seven", "durationMs": "1e"}'), ("c", "{"), ("d", None)]
    spark.createDataFrame(docs, "replay_id string, raw_json string").withColumn("start_time", F.current_timestamp()).write.parquet(str(tmp_path / "docs"))
    replays = spark.read.parquet(str(tmp_path / "docs"))
    players = spark.createDataFrame([(r, 1, 2, 3, 1.0) for r in "abcd"], "replay_id string, user_id int, player_id int, ally_team_id int, skill float")
    batch, bad = match_plan.match_batch_and_rejects(replays, replays.limit(0), replays.limit(0), lambda _: players, "2000-01-01")
    assert sorted((r["replay_id"], r["map_id"], r["has_bots"]) for r in batch.collect()) == [("a", 7, False), ("c", None, None), ("d", None, None)]
    assert sorted((r["replay_id"], r["field"], r["value"]) for r in bad.collect()) == [("b", "durationMs", "1e"), ("b", "mapId", "seven")]
    optimized = match_plan.parsed_matches(replays).filter(F.size("rejects") == 0)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json") == 1


@pytest.mark.parametrize(("small", "most"), [(False, 4), (True, 6)])
def test_insert_moves_each_side_once(spark, small, most):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if small else "-1")
    try:
        plan = plan_of(QUERIES["insert_match_players"](spark, SF_DIR))
        assert plan.count("Exchange hashpartitioning") <= most
        assert ("BroadcastHashJoin" in plan) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_deep_page_reads_its_own_ranges(spark):
    lines = Views(spark, SF_DIR).table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = [F.desc("l_orderkey"), *map(F.col, lines.columns[1:])]
    pages = meta.ListingPages(lines.distinct(), 100, order, ranges=16)
    want = [tuple(r) for r in lines.distinct().orderBy(*order).collect()]
    assert pages.total == len(want)
    last = -(-len(want) // 100)
    for number in (1, 2, 7, last - 1, last):
        assert [tuple(r) for r in pages.page(number).collect()] == want[(number - 1) * 100 : number * 100]
    assert pages.page(last + 1).count() == 0
    plan = plan_of(pages.page(last - 1))
    assert "PushedFilters: [" in plan and "Exchange SinglePartition" not in plan
    touched = [n for n, (a, b) in pages.starts.items() if a < (last - 1) * 100 and b > (last - 2) * 100]
    assert len(touched) <= 2  # of 16
