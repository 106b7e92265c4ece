"""Incremental skill snapshots."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaystats.operators.incremental import ScanWindow, rows_in
from replaystats.operators.upserts import insert_ignore

JOB_KEY = "match_skill_snapshots"
SNAPSHOT_KEY = ["user_id", "category", "start_time"]


def candidate_snapshots(players: DataFrame, matches: DataFrame, window: ScanWindow) -> DataFrame:
    """Skill of every known user in the categorised matches of the window."""
    found = rows_in(matches, window).filter(F.col("category").isNotNull())
    found = found.select("replay_id", "category", "start_time")
    known = players.filter(F.col("user_id").isNotNull()).select("replay_id", "user_id", "skill")
    return known.join(found, "replay_id").select("user_id", "category", "skill", "start_time")


def new_snapshots(candidates: DataFrame, stored: DataFrame, window: ScanWindow) -> DataFrame:
    """Candidates that are not stored. Of equal keys the highest skill stays.

    The time is part of the key, so only stored rows of the same window can conflict and the
    rest of the table is never read.
    """
    order = [F.col("skill").desc_nulls_last()]
    return insert_ignore(rows_in(stored, window), candidates, SNAPSHOT_KEY, order)


def window_days(window: ScanWindow):
    """First and last day the window touches (for partition pruning)."""
    if window.start is None:
        return window.end.date() + timedelta(days=1), window.end.date()
    return window.start.date(), window.end.date()
