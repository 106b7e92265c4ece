"""Player pages: eight components per active user, assembled into one document.

All components hang off one staged join of players and matches. Each of them first reduces the
rows of a user (counts, top-n, daily means), and only these reduced rows move to the user's
place. So a user with a large share of all matches never sits in one task, and the eight-way
join at the end finds every side already partitioned by user.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replaystats.functions.arrays import (
    ALL,
    array_agg_ordered,
    fill_series,
    object_agg,
    object_agg_all_first,
)
from replaystats.functions.rating import adjusted_rating, safe_rate
from replaystats.functions.scalars import bucket_index, in_window, pg_round, result_label, ts_lit
from replaystats.operators import aggregates as agg
from replaystats.operators.joins import join_default, only_in

PAGE_VERSION = 1
DAY, LONG_DAY = "yyyy-MM-dd", "dd MMM yyyy"
SLOTS = [f"bin_{i}" for i in range(len(agg.LOBBY_EDGES))]

COMPONENTS = [
    "skillPerMode",
    "winLossSummary",
    "matchHistory",
    "usernames",
    "activityData",
    "lobbyData",
    "factionData",
    "skillHistory",
]


def player_matches(players: DataFrame, matches: DataFrame, start, end) -> DataFrame:
    """Known users' matches of the days [start, end], of any category."""
    inside = matches.filter(in_window("start_time", start, end, closed="day"))
    inside = inside.select("replay_id", "start_time", "category", "map_name", "ranked", "avg_lobby_skill")
    known = players.filter(F.col("user_id").isNotNull()).select(
        "user_id", "replay_id", "player_id", F.col("name").alias("username"), "skill", "won", "faction"
    )
    return known.join(inside, "replay_id")


def relevant_matches(base: DataFrame) -> DataFrame:
    """The matches that components count: those with a category."""
    return base.filter(F.col("category").isNotNull())


# --- per (user, category): skill, wins and losses, lobby histogram -------------------------


def per_mode(matches: DataFrame) -> DataFrame:
    """Everything counted per user and category, in one aggregation."""
    binned = matches.withColumn("bin", bucket_index("avg_lobby_skill", agg.LOBBY_EDGES))
    slots = [F.count_if(F.col("bin") == i).alias(slot) for i, slot in enumerate(SLOTS)]
    lobby_games = F.count("avg_lobby_skill").alias("lobby_games")
    return binned.groupBy("user_id", "category").agg(*agg.mode_columns(), *agg.win_columns(), lobby_games, *slots)


def rated_modes(modes: DataFrame, skills: DataFrame) -> DataFrame:
    """Mode counts with latest skill and adjusted rating, still as unrounded numbers."""
    skills = skills.select("user_id", "category", F.col("latest_skill").cast("float").alias("skill"))
    rated = join_default(modes, skills, ["user_id", "category"], {})
    counts = [F.col(c) for c in ("wa", "ga", "wb", "gb", "games")]
    return rated.withColumns(
        {
            "skill": F.coalesce("skill", F.lit(0.0).cast("float")),
            "adjusted": adjusted_rating(F.col("skill"), *counts),
            "hard_rate": safe_rate(F.col("wa"), F.col("ga"), 2),
            "easy_rate": safe_rate(F.col("wb"), F.col("gb"), 2),
        }
    )


def mode_components_by_user(rated: DataFrame) -> DataFrame:
    """skillPerMode, winLossSummary and lobbyData of each user. A user has few categories."""
    category, played = F.col("category"), F.col("wins") + F.col("losses")
    skill_entry = F.struct(
        category.alias("mode"),
        pg_round("skill", 1, single=True).alias("os"),
        pg_round("adjusted", 2).alias("as"),
        F.col("ga"),
        F.col("hard_rate").alias("wa"),
        F.col("gb"),
        F.col("easy_rate").alias("wb"),
        F.date_format("last_played", DAY).alias("lastPlayed"),
    )
    win_entry = F.struct(
        category.alias("mode"),
        F.col("wins"),
        F.col("losses"),
        safe_rate(F.col("wins"), played, 1, pct=True).alias("rate"),
    )
    # An own row per category plus the summed row 'All'; an array only where games have a lobby skill.
    bins = F.when(F.col("lobby_games") > 0, F.struct(category.alias("key"), F.array(*SLOTS).alias("value")))
    all_bins = F.struct(F.lit(ALL).alias("key"), F.array(*[F.sum(s) for s in SLOTS]).alias("value"))
    by_user = rated.groupBy("user_id").agg(
        object_agg(category, skill_entry).alias("skillPerMode"),
        F.sum("wins").alias("wins"),
        F.sum("losses").alias("losses"),
        object_agg(category, win_entry).alias("perMode"),
        F.sort_array(F.collect_list(bins)).alias("lobby"),
        all_bins.alias("lobby_all"),
    )
    games = F.col("wins") + F.col("losses")
    total = F.struct("wins", "losses", games.alias("games"), safe_rate(F.col("wins"), games, 1, pct=True).alias("winRate"))
    lobby = F.map_from_entries(F.concat(F.array("lobby_all"), F.col("lobby")))
    return by_user.select(
        "user_id",
        "skillPerMode",
        F.struct(total.alias("total"), F.col("perMode")).alias("winLossSummary"),
        F.when(F.size("lobby") > 0, lobby).alias("lobbyData"),
    )


# --- lists per user --------------------------------------------------------------------------


def history_by_user(matches: DataFrame) -> DataFrame:
    entry = F.struct(
        F.date_format("start_time", LONG_DAY).alias("date"),
        F.col("category").alias("mode"),
        F.col("map_name").alias("map"),
        result_label("won").alias("result"),
        "faction",
        "ranked",
        "username",
    )
    return agg.match_history(matches).groupBy("user_id").agg(array_agg_ordered(entry, F.col("rn")).alias("matchHistory"))


def usernames_by_user(matches: DataFrame) -> DataFrame:
    """Names newest first. One entry per distinct name a user has played under."""
    entry = F.struct("name", F.date_format("last_seen", DAY).alias("lastSeen"))
    listed = array_agg_ordered(entry, F.col("last_seen"), F.col("name"), descending=True)
    return agg.usernames(matches).groupBy("user_id").agg(listed.alias("usernames"))


def activity_by_user(matches: DataFrame) -> DataFrame:
    entry = F.struct("games", pg_round("avg_skill", 1).alias("avgSkill"))
    recent = agg.recent_days(agg.daily_activity(matches))
    return recent.groupBy("user_id").agg(object_agg(F.date_format("day", DAY), entry).alias("activityData"))


def faction_arrays(stats: DataFrame) -> DataFrame:
    """Per user and category or 'All': faction labels with wins and losses in the same order."""
    faction = F.col("faction")
    return stats.groupBy("user_id", "category").agg(
        F.array_sort(F.collect_set(faction)).alias("labels"),
        array_agg_ordered(F.col("wins"), faction).alias("wins"),
        array_agg_ordered(F.col("losses"), faction).alias("losses"),
    )


def factions_by_user(matches: DataFrame) -> DataFrame:
    datasets = F.array(
        F.struct(F.lit("Wins").alias("label"), F.col("wins").alias("data")),
        F.struct(F.lit("Losses").alias("label"), F.col("losses").alias("data")),
    )
    chart = F.struct("labels", datasets.alias("datasets"))
    arrays = faction_arrays(agg.faction_stats(matches, by_user=True))
    return arrays.groupBy("user_id").agg(object_agg_all_first(F.col("category"), chart).alias("factionData"))


def skill_history(daily: DataFrame, start, end, fill: str = "lag1", scale: int | None = None) -> DataFrame:
    """(user, category, values): one value per day of [start, end], as an array.

    ``daily`` has at most one row per day of the window, so the points of a group are bounded.
    ``scale`` rounds the known values, before they are repeated.
    """
    value, zero = F.col("avg_skill").cast("double"), F.lit(0.0)
    if scale is not None:
        value, zero = pg_round(value, scale), F.lit(0).cast(f"decimal(20,{scale})")
    points = F.collect_list(F.struct("day", value.alias("value")))
    grouped = daily.groupBy("user_id", "category").agg(points.alias("points"))
    series = fill_series(F.col("points"), _date(start), _date(end), fill, zero)
    return grouped.select("user_id", "category", series.alias("values"))


def skill_history_by_user(daily: DataFrame, start, end, fill: str = "lag1") -> DataFrame:
    # One literal for all users: the window has the same days for everybody.
    first, last = agg.window_dates(start, end)
    labels = F.lit([str(first + timedelta(days=n)) for n in range((last - first).days + 1)])
    dataset = F.struct(F.col("category").alias("label"), F.col("values").alias("data"))
    series = skill_history(daily, start, end, fill, scale=1)
    listed = series.groupBy("user_id").agg(array_agg_ordered(dataset, F.col("category")).alias("datasets"))
    return listed.select("user_id", F.struct(labels.alias("labels"), "datasets").alias("skillHistory"))


# --- the page --------------------------------------------------------------------------------


def page_components(
    base: DataFrame, skills: DataFrame, snapshots: DataFrame, start, end, fill: str = "lag1"
) -> DataFrame:
    """One row per active user with the eight components, NULL where a user has none.

    ``base`` is :func:`player_matches`, staged by the caller because six components read it.
    """
    matches = relevant_matches(base)
    active = agg.active_users(base)
    # Daily means first: afterwards a user has a bounded number of rows to move.
    daily = agg.daily_skill(snapshots, start, end).repartition("user_id")
    parts = [
        mode_components_by_user(rated_modes(per_mode(matches), skills)),
        history_by_user(matches),
        usernames_by_user(matches),
        activity_by_user(matches),
        factions_by_user(matches),
        skill_history_by_user(only_in(daily, active, ["user_id"]), start, end, fill),
    ]
    joined = active
    for part in parts:
        joined = joined.join(part, "user_id", "left")
    return joined.select("user_id", *COMPONENTS)


def assemble_pages(components: DataFrame, as_of: datetime | str) -> DataFrame:
    """(user_id, page): the typed document, with the empty default of each missing component."""
    with_defaults = [F.coalesce(F.col(c), _empty(components, c)).alias(c) for c in COMPONENTS]
    page = F.struct(
        F.lit(PAGE_VERSION).alias("_version"),
        ts_lit(as_of).alias("_generated"),
        F.col("user_id").alias("userId"),
        *with_defaults,
    )
    return components.select("user_id", page.alias("page"))


def page_rows(pages: DataFrame, start, end, as_of: datetime | str) -> DataFrame:
    """Rows of the page table; the document becomes text only here. NULL fields are written."""
    return pages.select(
        "user_id",
        F.to_json("page", {"ignoreNullFields": "false"}).alias("json_data"),
        ts_lit(as_of).alias("last_generated_at"),
        _date(start).alias("data_start_date"),
        _date(end).alias("data_end_date"),
    )


def upsert_pages(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """New pages, and the stored pages of users without a new one (all columns are replaced)."""
    kept = stored.join(rows.select("user_id"), "user_id", "left_anti").select(*rows.columns)
    return kept.unionByName(rows)


def _empty(components: DataFrame, name: str) -> Column:
    kind = components.schema[name].dataType.simpleString()
    documents = {
        "winLossSummary": '{"total": {"wins": 0, "losses": 0, "games": 0, "winRate": 0.0}, "perMode": {}}',
        "skillHistory": '{"labels": [], "datasets": []}',
    }
    if name in documents:
        return F.from_json(F.lit(documents[name]), kind)
    return (F.array() if kind.startswith("array") else F.create_map()).cast(kind)


def _date(value) -> Column:
    return F.lit(str(value)[:10]).cast("date")
