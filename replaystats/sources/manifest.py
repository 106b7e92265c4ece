"""Seen-id manifests in day folders, and day-partitioned landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replaystats.schema import SEEN_ID
from replaystats.session import exists

# Name of a day folder, and the outcomes that count as downloaded.
DAY_FOLDER = r"/(folder=)?L\d{4}-\d{2}-\d{2}Replays/[^/]+$"
DOWNLOADED = ["ok", "exists"]


def read_seen_ids(spark: SparkSession, root: str) -> DataFrame:
    """Distinct ids of all manifests below day folders; unreadable lines are skipped."""
    reader = (
        spark.read.schema(SEEN_ID)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json*")
    )
    if not exists(spark, root):
        return spark.createDataFrame([], SEEN_ID)
    lines = reader.json(root)
    in_day_folder = F.col("_metadata.file_path").rlike(DAY_FOLDER)
    return lines.filter(in_day_folder & F.col("gameId").isNotNull()).select("gameId").distinct()


def manifest_rows(outcomes: DataFrame, key: str = "replay_id", time: str = "start_time", status: str = "status") -> DataFrame:
    """(folder, gameId) of the items whose download worked or had been done before."""
    folder = F.concat(F.lit("L"), F.date_format(time, "yyyy-MM-dd"), F.lit("Replays"))
    done = outcomes.filter(F.col(status).isin(DOWNLOADED))
    return done.select(folder.alias("folder"), F.col(key).alias("gameId"))


def append_manifest(outcomes: DataFrame, root: str, **columns: str) -> None:
    """Append finished downloads to the manifest of their day, in few files per day."""
    manifest_rows(outcomes, **columns).hint("rebalance", "folder").write.mode("append").partitionBy("folder").json(root)


def with_day(df: DataFrame, time: str = "start_time", name: str = "start_date") -> DataFrame:
    """Add the day a row belongs to, the partition column of large tables."""
    return df.withColumn(name, F.to_date(time))


def write_by_day(df: DataFrame, path: str, mode: str = "append", time: str = "start_time") -> None:
    """Write one folder per day.

    The rebalance hint gathers each day into few files, and lets AQE split a day that is too
    large for one task.
    """
    days = with_day(df, time).hint("rebalance", "start_date")
    days.write.mode(mode).partitionBy("start_date").parquet(path)
