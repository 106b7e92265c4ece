"""The test tables seen as match data: suppliers are users, orders are matches, lines are players."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replaystats.functions.scalars import match_category
from replaystats.operators.aggregates import lobby_stats
from replaystats.plans.pages import player_matches
from replaystats.session import stage

WINDOW = ("1999-07-17", "2000-01-01")
ORDERS_AS_OF = datetime(2000, 1, 1)
EVENTS_WINDOW = ("2024-01-01", "2024-01-30")
EVENTS_AS_OF = datetime(2024, 1, 25)
EVENTS_WATERMARK = datetime(2024, 1, 20)


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._matches: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def players(self, lines: DataFrame | None = None) -> DataFrame:
        lines = self.table("lineitem") if lines is None else lines
        return lines.select(
            F.col("l_suppkey").alias("user_id"),
            F.col("l_orderkey").alias("replay_id"),
            F.concat_ws("-", "l_linestatus", "l_returnflag").alias("name"),
            F.col("l_linenumber").alias("player_id"),
            F.col("l_returnflag").alias("ally_team_id"),
            F.col("l_quantity").cast("float").alias("skill"),
            F.col("l_returnflag").alias("faction"),
            F.when(F.col("l_linenumber") != 7, F.col("l_linestatus") == "F").alias("won"),
        )

    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("replay_id"),
            F.col("o_orderdate").alias("start_time"),
            F.col("o_orderpriority").alias("map_name"),
            (F.col("o_orderstatus") == "F").alias("ranked"),
        )

    def matches(self) -> DataFrame:
        """The match table. Staged, as in the pipeline, where it is a stored table."""
        if self._matches is None:
            stats = lobby_stats(self.players(self.table("lineitem")))
            joined = self.orders().join(stats, "replay_id")
            category = match_category("player_count", "team_count")
            self._matches = stage(joined.withColumn("category", category), "matches")
        return self._matches

    def base(self) -> DataFrame:
        return player_matches(self.players(), self.matches(), *WINDOW)

    def snapshots(self) -> DataFrame:
        return self.table("events").select(
            "user_id",
            F.col("event_type").alias("category"),
            F.col("value").alias("skill"),
            F.col("ts").alias("start_time"),
        )

    def archive(self) -> DataFrame:
        """Documents of the older orders; the newest of them are still in the cache as well."""
        return self._documents("archive").filter(F.col("start_time") < "2000-01-01")

    def cache(self) -> DataFrame:
        return self._documents("cache").filter(F.col("start_time") >= "1999-01-01")

    def _documents(self, origin: str) -> DataFrame:
        orders = self.table("orders")
        document = F.to_json(
            F.struct(
                F.col("o_custkey").cast("string").alias("mapId"),
                F.struct(F.col("o_orderpriority").alias("scriptName")).alias("Map"),
                F.struct(F.when(F.col("o_orderstatus") == "F", "1").otherwise("off").alias("ranked_game")).alias("gameSettings"),
                F.when(F.col("o_orderstatus") == "P", "yes").otherwise("no").alias("hasBots"),
                F.lit("").alias("durationMs"),
                F.lit(origin).alias("engineVersion"),
                F.col("o_orderstatus").alias("gameVersion"),
                F.array("o_orderstatus", "o_orderpriority").alias("Spectators"),
            )
        )
        return orders.select(
            F.col("o_orderkey").alias("replay_id"), F.col("o_orderdate").alias("start_time"), document.alias("raw_json")
        )
