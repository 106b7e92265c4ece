"""Declared schemas. Nothing is inferred: inference costs a full pass and drifts between files."""

from __future__ import annotations

from pyspark.sql import types as T

# Every JSON leaf is read as text and cast explicitly, so that a number and the same
# number in quotes give the same value.
PLAYER = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("userId", "name", "playerId", "skill", "rank", "countryCode", "faction")
    ]
)

TEAM = T.StructType(
    [
        T.StructField("allyTeamId", T.StringType()),
        T.StructField("winningTeam", T.StringType()),
        T.StructField("Players", T.ArrayType(PLAYER)),
    ]
)

META = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("startTime", T.StringType()),
        T.StructField("fileName", T.StringType()),
        T.StructField("mapId", T.StringType()),
        T.StructField("hasBots", T.StringType()),
        T.StructField("durationMs", T.StringType()),
        T.StructField("engineVersion", T.StringType()),
        T.StructField("gameVersion", T.StringType()),
        T.StructField("Map", T.StructType([T.StructField("scriptName", T.StringType())])),
        T.StructField("gameSettings", T.StructType([T.StructField("ranked_game", T.StringType())])),
        # Only the length is needed, so the elements stay as raw text.
        T.StructField("Spectators", T.ArrayType(T.StringType())),
        T.StructField("AllyTeams", T.ArrayType(TEAM)),
    ]
)

TEAMS_ONLY = T.StructType([f for f in META.fields if f.name == "AllyTeams"])
MATCH_ONLY = T.StructType([f for f in META.fields if f.name != "AllyTeams"])

RAW_REPLAY = T.StructType(
    [
        T.StructField("replay_id", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("raw_json", T.StringType()),
    ]
)

MATCH_PLAYER = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("replay_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("player_id", T.IntegerType()),
        T.StructField("ally_team_id", T.IntegerType()),
        T.StructField("skill", T.FloatType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("faction", T.StringType()),
        T.StructField("won", T.BooleanType()),
    ]
)

MATCH = T.StructType(
    [
        T.StructField("replay_id", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("map_id", T.IntegerType()),
        T.StructField("map_name", T.StringType()),
        T.StructField("ranked", T.BooleanType()),
        T.StructField("category", T.StringType()),
        T.StructField("avg_lobby_skill", T.FloatType()),
        T.StructField("player_count", T.LongType()),
        T.StructField("team_count", T.LongType()),
        T.StructField("has_bots", T.BooleanType()),
        T.StructField("duration_ms", T.IntegerType()),
        T.StructField("engine_version", T.StringType()),
        T.StructField("game_version", T.StringType()),
        T.StructField("spectator_count", T.IntegerType()),
    ]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("skill", T.FloatType()),
        T.StructField("start_time", T.TimestampType()),
    ]
)

WATERMARK = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("last_loaded_at", T.TimestampType()),
    ]
)

LATEST_SKILL = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("latest_skill", T.FloatType()),
        T.StructField("latest_played_time", T.TimestampType()),
    ]
)

SEEN_ID = T.StructType([T.StructField("gameId", T.StringType())])

# A day on which player rows of a match are stored.
PLAYER_DAY = T.StructType([T.StructField("replay_id", T.StringType()), T.StructField("day", T.DateType())])

# What became of one state of an ingested file.
FILE_OUTCOME = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("size", T.LongType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)

# A field of a document that was no value of its column.
REJECT = T.StructType(
    [
        T.StructField("replay_id", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)

# A document whose players are stored, by a hash of its text.
FLATTENED = T.StructType([T.StructField("replay_id", T.StringType()), T.StructField("doc_hash", T.StringType())])

# Skills of a user on a day, as far as some batches of a stream go.
DAILY_PART = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("games", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)
