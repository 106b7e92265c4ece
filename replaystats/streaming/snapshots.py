"""Streaming form of the snapshot job.

The insert-ignore of the sink removes repeats, within a batch and against what is stored, so the
stream keeps no state and drops no late row. The sink brings the latest skills up to date as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from replaystats.operators.aggregates import merge_latest_skill
from replaystats.operators.joins import only_in
from replaystats.operators.upserts import insert_ignore
from replaystats.plans.snapshots import SNAPSHOT_KEY
from replaystats.session import stage, staging
from replaystats.sources import tables as t
from replaystats.sources.tables import Tables, days_between

LATENESS = "36 hours"


def snapshot_stream(player_match_stream: DataFrame) -> DataFrame:
    """Snapshots of a stream of (user_id, category, skill, start_time), repeats included."""
    known = player_match_stream.filter(F.col("user_id").isNotNull() & F.col("category").isNotNull())
    return known.select("user_id", "category", "skill", "start_time")


def append_snapshots(tables: Tables):
    """Batch writer. Only stored days that the batch touches can conflict, so only they are read.

    The latest skills are merged from the whole batch, so a batch that died after its append and
    comes again still reaches them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with staging(tables.spark):
            rows = stage(batch, "snapshot-batch")  # read once: the insert uses the rows several times
            first, last = rows.agg(F.min(F.to_date("start_time")), F.max(F.to_date("start_time"))).first()
            if first is None:
                return
            stored = days_between(tables.read(t.SNAPSHOTS), first, last)
            new = stage(insert_ignore(stored, rows, SNAPSHOT_KEY, [F.col("skill").desc_nulls_last()]), "snapshots")
            # Rows of the batch that are stored already carry the stored skill, not their own.
            again = only_in(stored.select(*new.columns), rows, SNAPSHOT_KEY)
            recent = stage(again.unionByName(new), "recent")
            tables.append(t.SNAPSHOTS, new)
            tables.replace(t.SKILL_DELTAS, merge_latest_skill(tables.read(t.SKILL_DELTAS), recent))

    return write


def run_snapshot_stream(player_match_stream: DataFrame, tables: Tables, checkpoint: str, every: str | None = None) -> StreamingQuery:
    writer = snapshot_stream(player_match_stream).writeStream.foreachBatch(append_snapshots(tables))
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def daily_skill_stream(player_match_stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Mean skill per user, category and day as tumbling windows, given out once a day is closed."""
    marked = player_match_stream.withWatermark("start_time", lateness)
    grouped = marked.groupBy(F.window("start_time", "1 day"), "user_id", "category")
    means = grouped.agg(F.avg("skill").alias("avg_skill"))
    return means.select("user_id", "category", F.to_date("window.start").alias("day"), "avg_skill")


def daily_parts(player_matches: DataFrame) -> DataFrame:
    """(user, category, day, total, games): sums and counts, which can be added up, unlike means."""
    day = F.to_date("start_time").alias("day")
    return player_matches.groupBy("user_id", "category", day).agg(
        F.sum(F.col("skill").cast("double")).alias("total"), F.count("skill").alias("games")
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    grouped = parts.groupBy("user_id", "category", "day")
    return grouped.agg(F.sum("total").alias("total"), F.sum("games").alias("games"))


def daily_skill(tables: Tables) -> DataFrame:
    """Mean skill per user, category and day of all that the stream has seen, open days included."""
    sums = merged_parts(tables.read(t.DAILY_PARTS))
    mean = F.when(F.col("games") > 0, F.col("total") / F.col("games"))
    return sums.select("user_id", "category", "day", mean.alias("avg_skill"))


def add_daily_parts(tables: Tables, source: str, max_folders: int = 16):
    """Batch writer: a batch adds its own sums and counts. No state is kept and no row is too late.

    A batch that comes again after a failure is known by its number and not added twice; ``source``
    names the stream whose numbers these are. When folders have piled up they are added up into one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with staging(tables.spark):
            done = tables.read(t.DAILY_PARTS).filter(F.col("source") == source).agg(F.max("batch").alias("batch")).first()["batch"]
            if done is None or done < batch_id:
                sums = daily_parts(batch)
                tables.append(t.DAILY_PARTS, sums.withColumns({"source": F.lit(source), "batch": F.lit(batch_id).cast("long")}))
            folders = tables.folders(t.DAILY_PARTS)
            if len(folders) > max_folders:
                parts = tables.read(t.DAILY_PARTS, folders)
                grouped = parts.groupBy("user_id", "category", "day", "source")
                sums = grouped.agg(F.sum("total").alias("total"), F.sum("games").alias("games"))
                # A source's rows carry its latest number, whichever batch they stem from.
                last = parts.groupBy("source").agg(F.max("batch").alias("batch"))
                tables.replace(t.DAILY_PARTS, sums.join(last, "source"), over=folders)

    return write


def run_daily_skill(
    player_match_stream: DataFrame, tables: Tables, checkpoint: str, every: str | None = None, max_folders: int = 16
) -> StreamingQuery:
    """Daily means as a stream with an upsert of sums: :func:`daily_skill` reads them at any time."""
    writer = player_match_stream.writeStream.foreachBatch(add_daily_parts(tables, checkpoint, max_folders))
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
