"""Aggregations over players and over player-matches.

Every grouping starts with an aggregate that combines before the shuffle, so the rows of a hot
user or match are reduced where they are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replaystats.functions.arrays import ALL
from replaystats.functions.rating import HARD_LOBBY_SKILL, safe_rate
from replaystats.functions.scalars import bucket_index, in_window
from replaystats.operators.keyed import top_n_per_key

# Lower edges of the lobby histogram, and the lengths of the per-user lists.
LOBBY_EDGES = list(range(0, 59, 2))
HISTORY_MATCHES = 10
ACTIVE_DAYS = 84


def lobby_stats(players: DataFrame) -> DataFrame:
    """Per match: distinct players, distinct teams, mean skill, over rows with user and skill.

    Grouped by (match, team, player) first, so one crowded match is spread, then by (match, player) and
    (match, team). A match is then counts and sums; no distinct set is gathered.
    """
    rated = players.filter(F.col("user_id").isNotNull() & F.col("skill").isNotNull())
    skill = F.col("skill").cast("double")
    seats = rated.groupBy("replay_id", "ally_team_id", "player_id").agg(
        F.sum(skill).alias("skill"), F.count("skill").alias("rows")
    )
    # Each seat twice: once for its player, with the skills, and once for its team.
    is_player = F.col("is_player")
    doubled = seats.withColumn("is_player", F.explode(F.array(F.lit(True), F.lit(False))))
    player, of_team = F.when(is_player, F.col("player_id")), F.when(~is_player, F.col("ally_team_id"))
    counted = doubled.groupBy("replay_id", "is_player", player.alias("player"), of_team.alias("team")).agg(
        F.sum(F.when(is_player, F.col("skill"))).alias("skill"), F.sum(F.when(is_player, F.col("rows"))).alias("rows")
    )
    return counted.groupBy("replay_id").agg(
        F.count("player").alias("player_count"),
        F.count("team").alias("team_count"),
        (F.sum("skill") / F.sum("rows")).cast("float").alias("avg_lobby_skill"),
    )


def active_users(player_matches: DataFrame) -> DataFrame:
    """Users with at least one match of any category."""
    return player_matches.select("user_id").distinct()


def mode_columns(threshold: float = HARD_LOBBY_SKILL) -> list[Column]:
    """Games and wins in hard and easy lobbies; a match without lobby skill counts only in ``games``."""
    hard = F.col("avg_lobby_skill") >= F.lit(threshold)
    easy = F.col("avg_lobby_skill") < F.lit(threshold)
    return [
        F.max("start_time").alias("last_played"),
        F.count_if(hard).alias("ga"),
        F.count_if(hard & F.col("won")).alias("wa"),
        F.count_if(easy).alias("gb"),
        F.count_if(easy & F.col("won")).alias("wb"),
        F.count("*").alias("games"),
    ]


def win_columns() -> list[Column]:
    """Wins and losses; an unknown result is in neither."""
    return [F.count_if(F.col("won")).alias("wins"), F.count_if(~F.col("won")).alias("losses")]


def mode_components(matches: DataFrame, threshold: float = HARD_LOBBY_SKILL) -> DataFrame:
    return matches.groupBy("user_id", "category").agg(*mode_columns(threshold))


def win_loss(matches: DataFrame) -> DataFrame:
    return matches.groupBy("user_id", "category").agg(*win_columns())


def win_loss_summary(per_mode: DataFrame) -> DataFrame:
    """Totals per user from the per-mode rows."""
    totals = per_mode.groupBy("user_id").agg(F.sum("wins").alias("wins"), F.sum("losses").alias("losses"))
    games = F.col("wins") + F.col("losses")
    return totals.select("user_id", "wins", "losses", games.alias("games"), safe_rate(F.col("wins"), games, 1, pct=True).alias("win_rate"))


def usernames(matches: DataFrame) -> DataFrame:
    """Last time each user was seen under each name."""
    named = matches.filter(F.col("username").isNotNull())
    return named.groupBy("user_id", F.col("username").alias("name")).agg(F.max("start_time").alias("last_seen"))


def daily_activity(matches: DataFrame) -> DataFrame:
    """Games and mean skill per user and day."""
    return matches.groupBy("user_id", F.to_date("start_time").alias("day")).agg(
        F.count("*").alias("games"), F.avg("skill").alias("avg_skill")
    )


def recent_days(daily: DataFrame, n: int = ACTIVE_DAYS) -> DataFrame:
    """The latest ``n`` days on which a user was active."""
    return top_n_per_key(daily, ["user_id"], [F.col("day").desc_nulls_first()], n)


def match_history(matches: DataFrame, n: int = HISTORY_MATCHES) -> DataFrame:
    """The latest ``n`` matches per user, numbered by ``rn``.

    Equal times are ordered by match and player, which are unique in the match table; the shown
    columns come last, so that the list is stable on other input too.
    """
    order = [F.col(c).desc_nulls_first() for c in ("start_time", "replay_id", "player_id", "username", "faction", "won")]
    return top_n_per_key(matches, ["user_id"], order, n, rank="rn")


def daily_skill(snapshots: DataFrame, start, end) -> DataFrame:
    """Mean skill per user, category and day of [start, end]."""
    inside = snapshots.filter(in_window("start_time", start, end, closed="day"))
    return inside.groupBy("user_id", "category", F.to_date("start_time").alias("day")).agg(
        F.avg("skill").alias("avg_skill")
    )


def with_all(counts: DataFrame, keys: Sequence[str], sums: Sequence[str], label: str = "category") -> DataFrame:
    """Add the 'All' rows to counts per (keys, category): each row counts for its category and for 'All'.

    Runs on counts that are already small, so doubling the rows is cheap, and keeps the
    partitioning of its input.
    """
    doubled = counts.withColumn(label, F.explode(F.array(F.col(label), F.lit(ALL))))
    return doubled.groupBy(*keys, label).agg(*[F.sum(c).alias(c) for c in sums])


def lobby_histogram(matches: DataFrame, edges: Sequence[float] = tuple(LOBBY_EDGES)) -> DataFrame:
    """Matches per user, category or 'All', and lobby-skill bin (-1 lies under the range)."""
    binned = matches.filter(F.col("avg_lobby_skill").isNotNull()).withColumn(
        "bin", bucket_index("avg_lobby_skill", edges)
    )
    counts = binned.groupBy("user_id", "category", "bin").agg(F.count("replay_id").alias("games"))
    return with_all(counts, ["user_id", "bin"], ["games"])


def faction_stats(matches: DataFrame, by_user: bool = False) -> DataFrame:
    """Wins and losses per user, category or 'All', and faction.

    ``by_user`` moves the counts to one place per user, for callers that go on grouping by user.
    """
    played = matches.filter(F.col("faction").isNotNull())
    counts = played.groupBy("user_id", "category", "faction").agg(*win_columns())
    if by_user:
        counts = counts.repartition("user_id")
    return with_all(counts, ["user_id", "faction"], ["wins", "losses"])


def latest_skill(snapshots: DataFrame) -> DataFrame:
    """Latest skill per user and category. Snapshots are unique by (user, category, time)."""
    return snapshots.groupBy("user_id", "category").agg(
        F.max_by("skill", "start_time").alias("latest_skill"),
        F.max("start_time").alias("latest_played_time"),
    )


def merge_latest_skill(stored: DataFrame, new_snapshots: DataFrame) -> DataFrame:
    """Stored latest skills brought up to date with new snapshots only; the later time wins."""
    columns = ["user_id", "category", F.col("latest_skill").alias("skill"), F.col("latest_played_time").alias("start_time")]
    return latest_skill(stored.select(*columns).unionByName(new_snapshots.select("user_id", "category", "skill", "start_time")))


def outcome_summary(outcomes: DataFrame, elapsed_s: float | None = None, status: str = "status") -> DataFrame:
    """One row: total, ok (fetched now or before), fail and the rate per second."""
    col = F.col(status)
    total = F.count_if(col.isin("ok", "exists", "fail"))
    rate = F.lit(0.0) if not elapsed_s or elapsed_s <= 0 else total / F.lit(float(elapsed_s))
    return outcomes.agg(
        total.alias("total"),
        F.count_if(col == "ok").alias("fetched"),
        F.count_if(col == "exists").alias("existed"),
        F.count_if(col.isin("ok", "exists")).alias("ok"),
        F.count_if(col == "fail").alias("fail"),
        rate.alias("per_second"),
    )


def window_dates(start, end) -> tuple[date, date]:
    """The window ends as dates."""
    return date.fromisoformat(str(start)[:10]), date.fromisoformat(str(end)[:10])
