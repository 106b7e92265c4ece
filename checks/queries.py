"""One query per operator, over the whole test tables. Those of the jobs are in ``job_queries``."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks import job_queries  # noqa: F401  (registers its queries)
from checks.registry import QUERIES, query, scratch
from checks.views import (
    EVENTS_AS_OF,
    EVENTS_WATERMARK,
    EVENTS_WINDOW,
    ORDERS_AS_OF,
    WINDOW,
    Views,
)
from replaystats.functions import arrays, rating, scalars
from replaystats.operators import aggregates as agg
from replaystats.operators import generators, incremental, joins, keyed, upserts
from replaystats.plans import matches as match_plan
from replaystats.plans import pages as page_plan
from replaystats.plans import players as player_plan
from replaystats.plans import snapshots as snapshot_plan
from replaystats.session import stage
from replaystats.sources import artifacts, manifest, meta
from replaystats.sources import tables as t
from replaystats.streaming import snapshots as snapshot_streams

AS_OF_END = EVENTS_AS_OF - incremental.DELAY
SNAPSHOT_WINDOW = incremental.ScanWindow(EVENTS_WATERMARK - incremental.LOOKBACK, AS_OF_END)


def r4(col: Column | str) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, 4)


def dbl(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


# --- matches -----------------------------------------------------------------------------------


@query
def category_win_rate(v: Views) -> DataFrame:
    """Games, wins and win rate per match category."""
    matches = v.matches().filter(F.col("category").isNotNull()).select("replay_id", "category")
    played = v.players().join(matches, "replay_id").groupBy("category").agg(*agg.win_columns())
    games = F.col("wins") + F.col("losses")
    rate = rating.safe_rate(F.col("wins"), games, 1, pct=True)
    return played.select("category", "wins", "losses", games.alias("games"), dbl(rate).alias("win_rate"))


@query
def lobby_stats(v: Views) -> DataFrame:
    stats = agg.lobby_stats(v.players())
    return stats.select("replay_id", "player_count", "team_count", r4(dbl("avg_lobby_skill")).alias("avg_lobby_skill"))


@query
def match_category(v: Views) -> DataFrame:
    stats = agg.lobby_stats(v.players())
    labelled = stats.withColumn("category", scalars.match_category("player_count", "team_count"))
    return labelled.groupBy("category").agg(
        F.count("*").alias("matches"),
        F.min("player_count").alias("min_players"),
        F.max("player_count").alias("max_players"),
        F.max("team_count").alias("max_teams"),
    )


@query
def derived_matches(v: Views) -> DataFrame:
    """Documents of archive and cache to match rows, upserted over stale stored rows."""
    stored = v.orders().filter(F.col("start_time") < "1999-07-01")
    stale = stored.select(
        "replay_id",
        "start_time",
        F.lit(-1).alias("map_id"),
        "map_name",
        "ranked",
        F.lit("stale").alias("category"),
        F.lit(0.0).cast("float").alias("avg_lobby_skill"),
        F.lit(0).cast("long").alias("player_count"),
        F.lit(0).cast("long").alias("team_count"),
        F.lit(False).alias("has_bots"),
        F.lit(0).alias("duration_ms"),
        F.lit("stale").alias("engine_version"),
        F.lit("stale").alias("game_version"),
        F.lit(0).alias("spectator_count"),
    )
    batch = match_plan.match_batch(v.archive(), v.cache(), stale, lambda replays: v.players(), "1996-01-01")
    out = match_plan.upsert_matches(stale, batch)
    return out.withColumn("avg_lobby_skill", r4(dbl("avg_lobby_skill")))


# --- scalar expressions --------------------------------------------------------------------------


def _decorated() -> Column:
    """A quantity in the forms in which skills are written."""
    q = F.col("l_quantity").cast("int").cast("string")
    return (
        F.when(F.col("l_linenumber") == 7, "")
        .when(F.col("l_linenumber") == 6, F.lit(None))
        .when(F.col("l_returnflag") == "A", F.concat(F.lit("["), q, F.lit(".67]")))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("#"), q, F.lit("#")))
        .otherwise(F.concat(F.lit(" ~("), q, F.lit(".5) ")))
    )


@query
def clean_skill(v: Views) -> DataFrame:
    lines = v.table("lineitem").withColumn("written", _decorated())
    return lines.select("l_orderkey", "l_linenumber", "written", r4(dbl(scalars.clean_skill("written"))).alias("skill"))


@query
def nullif_cast(v: Views) -> DataFrame:
    text = F.when(F.col("l_linenumber") == 7, "").otherwise(F.col("l_partkey").cast("string"))
    lines = v.table("lineitem").withColumn("written", text)
    return lines.select("l_orderkey", "l_linenumber", scalars.nullif_cast("written", "int").cast("long").alias("value"))


@query
def pg_bool(v: Views) -> DataFrame:
    """Every accepted spelling, picked by the order's attributes."""
    words = ["t", "tr", "tru", "true", "y", "ye", "yes", "on", "1", "f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0"]
    spelled = F.array(*[F.lit(w) for w in words + [f" {w.upper()} " for w in words]])
    chosen = F.element_at(spelled, (F.pmod("o_custkey", F.lit(2 * len(words))) + 1).cast("int"))
    text = F.when(F.col("o_orderstatus") != "P", chosen)
    orders = v.table("orders").withColumn("written", text)
    return orders.select("o_orderkey", "written", scalars.pg_bool("written").alias("value"))


@query
def json_extract_cast(v: Views) -> DataFrame:
    missing = scalars.json_text("props", "absent.deep")
    return v.table("events").select(
        "event_id",
        scalars.nullif_cast(scalars.json_text("props", "k"), "int").cast("long").alias("k"),
        missing.isNull().alias("missing"),
    )


@query
def pg_round(v: Views) -> DataFrame:
    lines = v.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") / 1000).cast("float").alias("single"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("double"),
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        dbl(scalars.pg_round("single", 1, single=True)).alias("single_1"),
        dbl(scalars.pg_round("double", 2)).alias("double_2"),
    )


@query
def bucket_index(v: Views) -> DataFrame:
    value = F.col("l_quantity") * 1.5 - 5
    lines = v.table("lineitem").withColumn("value", F.when(F.col("l_linenumber") != 7, value))
    binned = lines.withColumn("bin", scalars.bucket_index("value", agg.LOBBY_EDGES))
    return binned.groupBy("bin").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


@query
def safe_rate(v: Views) -> DataFrame:
    per_user = v.players().groupBy("user_id").agg(
        F.count_if("won").alias("wins"), F.count_if(F.col("won") & (F.col("skill") > 49)).alias("top"), F.count("*").alias("n")
    )
    return per_user.select(
        "user_id",
        dbl(rating.safe_rate(F.col("wins"), F.col("n"), 2)).alias("ratio"),
        dbl(rating.safe_rate(F.col("wins"), F.col("n"), 1, pct=True)).alias("percent"),
        dbl(rating.safe_rate(F.col("n"), F.col("top"), 2)).alias("guarded"),
    )


@query
def time_predicates(v: Views) -> DataFrame:
    """Rows in each kind of time window, per type."""
    start, end = "2024-01-10", "2024-01-20"
    return v.table("events").groupBy("event_type").agg(
        F.count_if(scalars.in_window("ts", start, end, "both")).alias("closed"),
        F.count_if(scalars.in_window("ts", start, end, "left")).alias("half_open"),
        F.count_if(scalars.in_window("ts", start, end, "day")).alias("whole_days"),
        F.count_if(scalars.in_window("ts", start)).alias("open_end"),
        F.count_if(scalars.older_than("ts", EVENTS_AS_OF, 24)).alias("older"),
    )


@query
def date_formats(v: Views) -> DataFrame:
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    orders = v.table("orders").withColumn("parsed", scalars.iso_timestamp(iso))
    return orders.groupBy(
        F.to_date("parsed").alias("day"),
        F.date_format("parsed", page_plan.DAY).alias("short"),
        F.date_format("parsed", page_plan.LONG_DAY).alias("long"),
    ).agg(F.count("*").alias("orders"))


@query
def result_labels(v: Views) -> DataFrame:
    labelled = v.players().select("user_id", scalars.result_label("won").alias("result"))
    return labelled.groupBy("user_id", "result").agg(F.count("*").alias("n"))


# --- generators ------------------------------------------------------------------------------------


@query
def explode_players(v: Views) -> DataFrame:
    """One document per line: two players in the first team, none in the second, no third."""

    def player(user: Column, number: Column) -> Column:
        return F.struct(
            user.cast("string").alias("userId"),
            F.col("l_linestatus").alias("name"),
            number.cast("string").alias("playerId"),
            F.concat(F.lit("["), F.col("l_quantity").cast("string"), F.lit("]")).alias("skill"),
            F.lit("").alias("rank"),
            F.col("l_returnflag").alias("countryCode"),
            F.col("l_returnflag").alias("faction"),
        )

    pair = F.array(player(F.col("l_suppkey"), F.col("l_linenumber")), player(F.lit(""), F.col("l_linenumber") + 10))
    won = F.when(F.col("l_linestatus") == "F", "true").otherwise("false")
    first = F.struct(F.col("l_linenumber").cast("string").alias("allyTeamId"), won.alias("winningTeam"), pair.alias("Players"))
    second = F.struct(F.lit("2").alias("allyTeamId"), F.lit("no").alias("winningTeam"), F.array_repeat(pair[0], 0).alias("Players"))
    teams = F.when(F.col("l_linenumber") != 7, F.array(first, second))
    raw = v.table("lineitem").select(
        F.col("l_orderkey").alias("replay_id"),
        F.col("l_shipdate").alias("start_time"),
        F.to_json(F.struct(teams.alias("AllyTeams"))).alias("raw_json"),
    )
    flat = generators.explode_players(raw)
    return flat.withColumn("skill", dbl("skill"))


@query
def rejected_values(v: Views) -> DataFrame:
    """Lines as players, some with values that are none: the fields rejected, and the rows left."""
    bad = {
        "userId": F.when((F.col("l_linenumber") == 3) & (F.col("l_quantity") > 40), "u17"),
        "skill": F.when((F.col("l_linenumber") == 4) & (F.col("l_quantity") > 30), "[n/a]"),
        "winningTeam": F.when((F.col("l_linenumber") == 5) & (F.col("l_quantity") > 45), "perhaps"),
        "rank": F.when((F.col("l_linenumber") == 3) & (F.col("l_quantity") > 45), "9.5.1"),
    }
    text = {
        "userId": F.col("l_suppkey").cast("string"),
        "skill": F.concat(F.lit("["), F.col("l_quantity").cast("int").cast("string"), F.lit("]")),
        "winningTeam": F.when(F.col("l_linestatus") == "F", "true").otherwise("false"),
        "rank": F.lit(""),
    }
    given = {k: F.coalesce(bad[k], text[k]) for k in text}
    player = F.struct(*[given[k].alias(k) for k in ("userId", "skill", "rank")], F.col("l_linenumber").cast("string").alias("playerId"))
    team = F.struct(F.lit("0").alias("allyTeamId"), given["winningTeam"].alias("winningTeam"), F.array(player).alias("Players"))
    lines = v.table("lineitem")
    document = F.to_json(F.struct(F.array(team).alias("AllyTeams")))
    docs = lines.select(F.col("l_orderkey").alias("replay_id"), F.col("l_shipdate").alias("start_time"), document.alias("raw_json"))
    players = generators.explode_valid_players(docs)
    fields = players.select("replay_id", "player_id", F.inline("rejects"))
    kept = players.filter(F.size("rejects") == 0)
    kept = kept.select("replay_id", "player_id", F.lit("kept").alias("field"), F.concat_ws("/", "user_id", F.col("skill").cast("int"), "won").alias("value"))
    return fields.unionByName(kept)


@query
def calendar_activity(v: Views) -> DataFrame:
    """Every day of a window longer than the data, with the events of the day."""
    days = generators.calendar(v.spark, date(2023, 12, 25), date(2024, 2, 5))
    daily = v.table("events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("events"))
    return joins.join_default(days, daily, ["day"], {"events": 0})


# --- keys, joins and table maintenance ---------------------------------------------------------------


@query
def first_per_key(v: Views) -> DataFrame:
    first = keyed.first_per_key(v.table("events"), ["user_id", "event_type"], [F.col("ts").asc_nulls_last(), F.col("event_id")])
    return first.select("user_id", "event_type", "event_id", "ts", "value")


@query
def latest_per_key(v: Views) -> DataFrame:
    return agg.latest_skill(v.snapshots())


@query
def merge_latest_skill(v: Views) -> DataFrame:
    """Latest skills from an old state plus new snapshots only."""
    snapshots = v.snapshots()
    old = agg.latest_skill(snapshots.filter(F.col("start_time") < scalars.time_bound(EVENTS_WATERMARK)))
    return agg.merge_latest_skill(old, snapshots.filter(F.col("start_time") >= scalars.time_bound(EVENTS_WATERMARK)))


def _origin(docs: DataFrame) -> DataFrame:
    return docs.select("replay_id", "start_time", scalars.json_text("raw_json", "engineVersion").alias("origin"))


@query
def prefer_left_union(v: Views) -> DataFrame:
    return _origin(joins.prefer_left_union(v.archive(), v.cache(), "replay_id", player_plan.RAW_COLUMNS))


@query
def prefer_left_fieldwise(v: Views) -> DataFrame:
    """Archive rows without a start time take it from the cache, if it has the match."""
    holes = scalars.json_text("raw_json", "gameVersion") != "P"
    archive = v.archive().withColumn("start_time", F.when(holes, F.col("start_time")))
    return _origin(joins.prefer_left_union(archive, v.cache(), "replay_id", player_plan.RAW_COLUMNS, fieldwise=True))


def _listing(v: Views) -> tuple[DataFrame, DataFrame, list[Column]]:
    listing = v.table("lineitem").withColumn("id", F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")))
    seen = v.table("orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))
    order = [F.col(c) for c in ("l_shipdate", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice")]
    return listing, seen, order


@query
def filter_new(v: Views) -> DataFrame:
    listing, seen, order = _listing(v)
    new, _ = joins.filter_new(listing, seen, "id", order)
    return new.select("id", "l_shipdate", "l_linenumber", "l_suppkey")


@query
def filter_new_skipped(v: Views) -> DataFrame:
    listing, seen, order = _listing(v)
    _, skipped = joins.filter_new(listing, seen, "id", order)
    forced, none = joins.filter_new(listing, seen, "id", order, force=True)
    counts = skipped.select(F.lit("normal").alias("mode"), F.col("skipped").alias("n"))
    counts = counts.unionByName(none.select(F.lit("forced").alias("mode"), F.col("skipped").alias("n")))
    return counts.unionByName(forced.agg(F.count("*").alias("n")).select(F.lit("admitted").alias("mode"), "n"))


@query
def insert_ignore(v: Views) -> DataFrame:
    """Lines keyed by (order, line number); number 7 stands for an unknown, which never conflicts."""
    lines = v.table("lineitem").select(
        "l_orderkey", F.nullif(F.col("l_linenumber"), F.lit(7)).alias("l_linenumber"), "l_suppkey", "l_partkey", "l_shipdate"
    )
    order = [F.col(c) for c in ("l_shipdate", "l_suppkey", "l_partkey")]
    stored = lines.filter(F.col("l_shipdate") < "1998-01-01")
    return upserts.insert_ignore(stored, lines, ["l_orderkey", "l_linenumber"], order)


@query
def insert_match_players(v: Views) -> DataFrame:
    """Line 6 has no user, line 5 no player id."""
    lines = v.table("lineitem")
    batch = lines.select(
        F.when(F.col("l_linenumber") != 6, F.col("l_suppkey")).alias("user_id"),
        F.col("l_orderkey").alias("replay_id"),
        F.nullif(F.col("l_linenumber"), F.lit(5)).alias("player_id"),
        F.col("l_shipdate").alias("start_time"),
        F.col("l_quantity").cast("float").alias("skill"),
        F.col("l_partkey").alias("rank"),
        F.lit("x").alias("name"),
        F.col("l_returnflag").alias("ally_team_id"),
        F.col("l_returnflag").alias("faction"),
        F.lit("y").alias("country_code"),
        F.lit(True).alias("won"),
    )
    stored = batch.filter(F.col("start_time") < "1997-01-01")
    new = upserts.insert_match_players(stored, batch, player_plan.player_order())
    return new.select("user_id", "replay_id", "player_id", "start_time", dbl("skill").alias("skill"), "rank", "faction")


@query
def upsert_partial(v: Views) -> DataFrame:
    """Spending per customer over stored customers: segment and balance change, the name does not."""
    customers = v.table("customer").select("c_custkey", "c_name", "c_mktsegment", F.round("c_acctbal", 2).alias("c_acctbal"))
    stored, owing = customers.filter(F.col("c_acctbal") >= 0), customers.filter(F.col("c_acctbal") < 0)
    batch = v.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.lit("new").alias("c_name"),
        F.max("o_orderpriority").alias("c_mktsegment"),
        F.max("o_totalprice").alias("c_acctbal"),
    )
    # Customers in debt are not stored yet; those without an order come with the batch as well.
    batch = batch.unionByName(owing.join(batch, "c_custkey", "left_anti"))
    return upserts.upsert(stored, batch, ["c_custkey"], ["c_mktsegment", "c_acctbal"])


def _aged(v: Views) -> tuple[DataFrame, DataFrame]:
    docs = v._documents("cache")
    archive = v._documents("archive").filter(scalars.json_text("raw_json", "gameVersion") == "F")
    return upserts.age_out(docs, archive, ORDERS_AS_OF)


@query
def age_out_cache(v: Views) -> DataFrame:
    return _origin(_aged(v)[0])


@query
def age_out_archive(v: Views) -> DataFrame:
    return _origin(_aged(v)[1])


# --- incremental -------------------------------------------------------------------------------------


@query
def update_snapshots(v: Views) -> DataFrame:
    """Snapshots of the scan window that are not stored. Each key is offered twice, the higher skill stays."""
    events = v.table("events")
    players = events.select(F.col("event_id").alias("replay_id"), "user_id", F.col("value").alias("skill"))
    players = players.unionByName(players.withColumn("skill", F.col("skill") + 1))
    category = F.when(F.col("event_type") != "error", F.col("event_type"))
    matches = events.select(F.col("event_id").alias("replay_id"), category.alias("category"), F.col("ts").alias("start_time"))
    stored = v.snapshots().filter(F.col("start_time") < scalars.time_bound(EVENTS_WATERMARK))
    candidates = snapshot_plan.candidate_snapshots(players, matches, SNAPSHOT_WINDOW)
    new = snapshot_plan.new_snapshots(candidates, stored, SNAPSHOT_WINDOW)
    return new.select("user_id", "category", "start_time", r4("skill").alias("skill"))


def _watermarks(v: Views) -> DataFrame:
    return v.table("events").groupBy(F.col("event_type").alias("key")).agg(
        F.max("ts").cast("timestamp").alias("last_loaded_at")
    )


@query
def scan_window(v: Views) -> DataFrame:
    """Events per type inside the window that follows from a watermark taken from the data."""
    marks = _watermarks(v)
    window = incremental.scan_window(marks, "click", EVENTS_AS_OF + timedelta(days=5))
    return incremental.rows_in(v.table("events"), window, "ts").groupBy("event_type").agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query
def advance_watermark(v: Views) -> DataFrame:
    marks = incremental.advance_watermark(_watermarks(v), "click", AS_OF_END)
    marks = incremental.advance_watermark(marks, snapshot_plan.JOB_KEY, AS_OF_END)
    return marks.select("key", F.col("last_loaded_at").cast("timestamp_ntz").alias("last_loaded_at"))


# --- page components ---------------------------------------------------------------------------------


@query
def active_users(v: Views) -> DataFrame:
    return agg.active_users(v.base())


@query
def relevant_matches(v: Views) -> DataFrame:
    rows = page_plan.relevant_matches(v.base())
    return rows.select(
        "user_id", "replay_id", "player_id", "category", "start_time", "won", dbl("skill").alias("skill"),
        r4(dbl("avg_lobby_skill")).alias("avg_lobby_skill"),
    )


def _snapshots(v: Views) -> DataFrame:
    """The snapshots of all matches before the clock, unique by key."""
    window = incremental.ScanWindow(incremental.FIRST_RUN, ORDERS_AS_OF)
    candidates = snapshot_plan.candidate_snapshots(v.players(), v.matches(), window)
    return keyed.first_per_key(candidates, snapshot_plan.SNAPSHOT_KEY, [F.col("skill").desc_nulls_last()])


def _rated_modes(v: Views) -> DataFrame:
    modes = page_plan.per_mode(page_plan.relevant_matches(v.base()))
    return page_plan.rated_modes(modes, agg.latest_skill(_snapshots(v)))


@query
def mode_components(v: Views) -> DataFrame:
    return agg.mode_components(page_plan.relevant_matches(v.base()))


@query
def skill_per_mode(v: Views) -> DataFrame:
    modes = page_plan.mode_components_by_user(_rated_modes(v))
    entries = modes.select("user_id", F.explode("skillPerMode").alias("category", "e"))
    return entries.select(
        "user_id",
        "category",
        dbl("e.os").alias("os_rating"),
        dbl("e.as").alias("adjusted"),
        "e.ga",
        dbl("e.wa").alias("hard_rate"),
        "e.gb",
        dbl("e.wb").alias("easy_rate"),
        F.col("e.lastPlayed").alias("last_played"),
    )


@query
def win_loss_mode(v: Views) -> DataFrame:
    return agg.win_loss(page_plan.relevant_matches(v.base()))


@query
def win_loss_total(v: Views) -> DataFrame:
    totals = agg.win_loss_summary(agg.win_loss(page_plan.relevant_matches(v.base())))
    return totals.withColumn("win_rate", dbl("win_rate"))


@query
def match_history_top10(v: Views) -> DataFrame:
    rows = agg.match_history(page_plan.relevant_matches(v.base()))
    return rows.select(
        "user_id",
        F.col("rn").cast("long").alias("rn"),
        F.date_format("start_time", page_plan.LONG_DAY).alias("played_on"),
        "category",
        "map_name",
        scalars.result_label("won").alias("result"),
        "faction",
        "ranked",
        "username",
    )


@query
def usernames_last_seen(v: Views) -> DataFrame:
    """Customers of a nation under the name of their market segment."""
    seen = (
        v.table("orders")
        .join(v.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(v.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("user_id"), F.col("c_mktsegment").alias("username"), F.col("o_orderdate").alias("start_time"))
    )
    return agg.usernames(seen)


@query
def username_lists(v: Views) -> DataFrame:
    lists = page_plan.usernames_by_user(page_plan.relevant_matches(v.base()))
    shown = F.transform("usernames", lambda u: F.concat_ws("@", u["name"], u["lastSeen"]))
    return lists.select("user_id", F.array_join(shown, ",").alias("names"))


@query
def daily_activity_84(v: Views) -> DataFrame:
    recent = agg.recent_days(agg.daily_activity(page_plan.relevant_matches(v.base())))
    return recent.select("user_id", "day", "games", r4("avg_skill").alias("avg_skill"))


@query
def lobby_histogram(v: Views) -> DataFrame:
    counts = agg.lobby_histogram(page_plan.relevant_matches(v.base()))
    return counts.select("user_id", "category", F.col("bin").cast("long").alias("bin"), "games")


@query
def lobby_histogram_dense(v: Views) -> DataFrame:
    counts = agg.lobby_histogram(page_plan.relevant_matches(v.base()))
    slots = F.sequence(F.lit(0), F.lit(len(agg.LOBBY_EDGES) - 1))
    dense = joins.densify(counts, ["user_id", "category"], "bin", slots, "games", 0)
    return dense.select("user_id", "category", F.col("bin").cast("long").alias("bin"), "games")


@query
def lobby_arrays(v: Views) -> DataFrame:
    entries = page_plan.mode_components_by_user(_rated_modes(v)).select("user_id", F.explode("lobbyData").alias("category", "bins"))
    return entries.select("user_id", "category", arrays.text_list(F.col("bins")).alias("bins"))


@query
def faction_stats(v: Views) -> DataFrame:
    return agg.faction_stats(page_plan.relevant_matches(v.base()))


@query
def faction_arrays(v: Views) -> DataFrame:
    charts = page_plan.factions_by_user(page_plan.relevant_matches(v.base()))
    entries = charts.select("user_id", F.explode("factionData").alias("category", "c"))
    return entries.select(
        "user_id",
        "category",
        arrays.text_list(F.col("c.labels")).alias("labels"),
        arrays.text_list(F.col("c.datasets")[0]["data"]).alias("wins"),
        arrays.text_list(F.col("c.datasets")[1]["data"]).alias("losses"),
    )


def _daily(v: Views) -> DataFrame:
    """Daily skills. A user without events of a type on a day, and the days before the data, are holes."""
    return agg.daily_skill(v.snapshots(), *EVENTS_WINDOW)


def _history_rows(v: Views, fill: str) -> DataFrame:
    series = page_plan.skill_history(_daily(v), *EVENTS_WINDOW, fill)
    rows = series.select("user_id", "category", F.posexplode("values").alias("n", "value"))
    day = F.date_add(F.lit(EVENTS_WINDOW[0]).cast("date"), F.col("n"))
    return rows.select("user_id", "category", day.alias("day"), r4("value").alias("value"))


@query
def skill_history_lag1(v: Views) -> DataFrame:
    return _history_rows(v, "lag1")


@query
def skill_history_ffill(v: Views) -> DataFrame:
    return _history_rows(v, "ffill")


@query
def skill_history_arrays(v: Views) -> DataFrame:
    pages = page_plan.skill_history_by_user(_daily(v), *EVENTS_WINDOW)
    sets = pages.select("user_id", F.size("skillHistory.labels").cast("long").alias("days"), F.explode("skillHistory.datasets").alias("d"))
    shown = F.transform("d.data", lambda x: x.cast("double"))
    known = F.filter(shown, lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    return sets.select(
        "user_id",
        F.col("d.label").alias("category"),
        "days",
        F.size(shown).cast("long").alias("points"),
        F.size(known).cast("long").alias("known"),
        F.round(total, 1).alias("total"),
    )


def _components(v: Views) -> DataFrame:
    base = stage(v.base(), "page-base")
    snapshots = stage(_snapshots(v), "snapshots")
    return page_plan.page_components(base, agg.latest_skill(snapshots), snapshots, *WINDOW)


@query
def page_counts(v: Views) -> DataFrame:
    """The size of every page component, per user."""
    page = page_plan.assemble_pages(_components(v), ORDERS_AS_OF).select("user_id", "page.*")
    lobby = F.coalesce(F.try_element_at("lobbyData", F.lit("All")), F.array().cast("array<bigint>"))

    def size(name: str) -> Column:
        return F.size(name).cast("long")

    return page.select(
        "user_id",
        size("skillPerMode").alias("modes"),
        F.col("winLossSummary.total.wins").alias("wins"),
        F.col("winLossSummary.total.losses").alias("losses"),
        size("matchHistory").alias("history"),
        size("usernames").alias("names"),
        size("activityData").alias("days"),
        F.aggregate(lobby, F.lit(0).cast("long"), lambda a, x: a + x).alias("lobby_games"),
        size("lobbyData").alias("lobby_rows"),
        size("factionData").alias("faction_rows"),
        size("skillHistory.labels").alias("labels"),
        size("skillHistory.datasets").alias("datasets"),
    )


@query
def pages_json(v: Views) -> DataFrame:
    pages = page_plan.assemble_pages(_components(v), ORDERS_AS_OF)
    return page_plan.page_rows(pages, *WINDOW, ORDERS_AS_OF)


# The fields of the written document that are read back. Numbers as their text, so that their form counts.
_MODE = "struct<os:string,as:string,ga:string,wa:string,gb:string,wb:string,lastPlayed:string>"
_WON = "struct<wins:string,losses:string,rate:string>"
_CHART = "struct<labels:array<string>,datasets:array<struct<label:string,data:array<string>>>>"
_PAGE = (
    "_version string, _generated string, userId string"
    f", skillPerMode map<string,{_MODE}>"
    f", winLossSummary struct<total:struct<wins:string,losses:string,games:string,winRate:string>,perMode:map<string,{_WON}>>"
    ", matchHistory array<struct<date:string,mode:string,map:string,result:string,faction:string,ranked:string,username:string>>"
    ", usernames array<struct<name:string,lastSeen:string>>"
    ", activityData map<string,struct<games:string,avgSkill:string>>"
    ", lobbyData map<string,array<string>>"
    f", factionData map<string,{_CHART}>"
    f", skillHistory {_CHART}"
)


@query
def page_fields(v: Views) -> DataFrame:
    """Every value of every page, read back from the written text: a row per value, with its place."""
    pages = page_plan.assemble_pages(_components(v), ORDERS_AS_OF)
    written = page_plan.page_rows(pages, *WINDOW, ORDERS_AS_OF).select("user_id", "json_data")
    page = written.select("user_id", "json_data", F.from_json("json_data", _PAGE).alias("p"))
    none = F.lit("")

    def entry(part: Column | str, key: Column, pos: Column, value: Column) -> Column:
        part = F.lit(part) if isinstance(part, str) else part
        return F.struct(part.alias("part"), key.alias("key"), pos.cast("long").alias("pos"), value.alias("value"))

    def fields(part: str, key: Column, row: Column, names: str) -> list[Column]:
        return [entry(part, key, F.lit(n), row[name]) for n, name in enumerate(names.split())]

    def of_map(part: str, column: str, names: str) -> Column:
        rows = F.transform(F.map_entries(column), lambda e: F.array(*fields(part, e["key"], e["value"], names)))
        return F.flatten(rows)

    def of_list(part: str, column: Column, names: str) -> Column:
        return F.flatten(F.transform(column, lambda r, i: F.array(*[entry(part, F.lit(n), i, r[n]) for n in names.split()])))

    def values(part: str, key: Column, column: Column) -> Column:
        return F.transform(column, lambda x, i: entry(part, key, i, x))

    def keys(part: str, path: str) -> Column:
        """The keys in the order in which they stand in the text."""
        return values(part, none, F.json_object_keys(F.get_json_object("json_data", path)))

    def charts(e: Column) -> Column:
        of = lambda n: values(F.concat(F.lit("faction"), F.get(e["value"]["datasets"], F.lit(n))["label"]), e["key"], F.get(e["value"]["datasets"], F.lit(n))["data"])
        return F.concat(values("faction", e["key"], e["value"]["labels"]), of(0), of(1))

    head = fields("page", none, F.col("p"), "_version userId")
    total = fields("total", none, F.col("p.winLossSummary.total"), "wins losses games winRate")
    rows = F.concat(
        F.array(*head, *total),
        of_map("skill", "p.skillPerMode", "os as ga wa gb wb lastPlayed"),
        of_map("mode", "p.winLossSummary.perMode", "wins losses rate"),
        of_list("history", F.col("p.matchHistory"), "date mode map result faction ranked username"),
        of_list("name", F.col("p.usernames"), "name lastSeen"),
        of_map("activity", "p.activityData", "games avgSkill"),
        keys("lobbyOrder", "$.lobbyData"),
        F.flatten(F.transform(F.map_entries("p.lobbyData"), lambda e: values("lobby", e["key"], e["value"]))),
        keys("factionOrder", "$.factionData"),
        F.flatten(F.transform(F.map_entries("p.factionData"), charts)),
        values("day", none, F.col("p.skillHistory.labels")),
        F.flatten(F.transform(F.col("p.skillHistory.datasets"), lambda d: values("series", d["label"], d["data"]))),
    )
    flat = page.select("user_id", F.inline(rows))
    # Texts stay, numbers are compared by value.
    number = F.when(~F.col("part").isin("history", "name", "day", "faction"), F.col("value").try_cast("double"))
    return flat.select("user_id", "part", "key", "pos", F.when(number.isNull(), F.col("value")).alias("text"), number.alias("number"))


def _two_windows(v: Views) -> DataFrame:
    """Pages of two windows: users of the later window get the later page."""

    def page(rows: DataFrame, start: str, end: str) -> DataFrame:
        doc = F.to_json(F.struct(F.col("user_id").alias("userId"), "games"))
        users = rows.groupBy("user_id").agg(F.count("*").alias("games"))
        return users.select(
            "user_id",
            doc.alias("json_data"),
            scalars.ts_lit(end).cast("timestamp_ntz").alias("last_generated_at"),
            F.lit(start).cast("date").alias("data_start_date"),
            F.lit(end).cast("date").alias("data_end_date"),
        )

    orders = v.table("orders").select(F.col("o_custkey").alias("user_id"), "o_orderdate")
    old = page(orders.filter(scalars.in_window("o_orderdate", "1995-01-01", "1999-12-31", "day")), "1995-01-01", "1999-12-31")
    new = page(orders.filter(scalars.in_window("o_orderdate", "2000-01-01", "2000-06-30", "day")), "2000-01-01", "2000-06-30")
    return page_plan.upsert_pages(old, new)


@query
def upsert_pages(v: Views) -> DataFrame:
    return _two_windows(v)


@query
def read_pages(v: Views) -> DataFrame:
    """The pages of exactly one window."""
    return artifacts.read_pages(_two_windows(v), "1995-01-01", "1999-12-31").select("user_id", "json_data")


# --- sources and sinks ---------------------------------------------------------------------------------


@query
def listing_filter(v: Views) -> DataFrame:
    return meta.listing_filter(_listed(v), *WINDOW).select("replay_id", "start_time")


@query
def listing_page(v: Views) -> DataFrame:
    listed = meta.listing_filter(_listed(v), *WINDOW).select("replay_id", "start_time")
    return meta.listing_page(listed, 2, 500, [F.col("start_time").desc(), F.col("replay_id")])


def _listed(v: Views) -> DataFrame:
    return v.table("orders").select(
        F.col("o_orderkey").alias("replay_id"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderstatus") == "P").alias("has_bots"),
        (F.col("o_orderpriority") != "5-LOW").alias("ended_normally"),
    )


def _outcomes(v: Views) -> DataFrame:
    names = F.create_map(*[F.lit(x) for x in ("F", "ok", "O", "exists", "P", "fail")])
    return v.table("orders").select(
        F.col("o_orderkey").cast("string").alias("replay_id"),
        F.col("o_orderdate").alias("start_time"),
        names[F.col("o_orderstatus")].alias("status"),
    )


@query
def outcome_summary(v: Views) -> DataFrame:
    return agg.outcome_summary(_outcomes(v), elapsed_s=60.0).withColumn("per_second", r4("per_second"))


@query
def seen_ids(v: Views) -> DataFrame:
    """Finished downloads written to day manifests and read back as seen ids."""
    status = F.when(F.col("event_type") == "click", "ok").when(F.col("event_type") == "view", "exists").otherwise("fail")
    outcomes = v.table("events").select(
        F.col("event_id").cast("string").alias("replay_id"), F.col("ts").alias("start_time"), status.alias("status")
    )
    root = scratch(v, "manifest")
    manifest.append_manifest(outcomes, root)
    return manifest.read_seen_ids(v.spark, root).select(F.col("gameId").alias("game_id"))


@query
def write_by_day(v: Views) -> DataFrame:
    root = scratch(v, "by-day")
    manifest.write_by_day(v.snapshots(), root)
    rows = v.spark.read.parquet(root)
    return rows.groupBy("start_date").agg(F.count("*").alias("n"), F.min("start_time").alias("first_at"))


@query
def split_valid(v: Views) -> DataFrame:
    """Documents of all orders; those of pending orders are cut short, low-priority ones have no id."""
    ident = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey").cast("string"))
    time = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    whole = F.to_json(F.struct(ident.alias("id"), time.alias("startTime"), F.lit(1).alias("x")))
    text = F.when(F.col("o_orderstatus") == "P", F.substring(whole, 1, 12)).otherwise(whole)
    good, bad = meta.split_valid(v.table("orders").select(text.alias("raw_json"), F.lit("inbox").alias("path")))
    count = F.count("*").alias("n")
    days = good.groupBy(F.to_date("start_time").alias("day")).agg(count, F.max("replay_id").alias("last_id"))
    return days.unionByName(bad.agg(count).select(F.lit(None).cast("date").alias("day"), "n", F.lit(None).cast("string").alias("last_id")))


@query
def packed_index(v: Views) -> DataFrame:
    """Byte ranges of one small document per user, in parts."""
    users = v.players().groupBy("user_id").agg(F.count("*").alias("games"), F.count_if("won").alias("wins"))
    doc = F.to_json(F.struct(F.col("user_id").alias("userId"), "games", "wins"))
    pages = users.select("user_id", doc.alias("json_data"))
    parts = artifacts.part_count(pages, part_bytes=512)
    # The default part is a hash that DuckDB lacks.
    index = artifacts.page_index(artifacts.pack_pages(pages, parts, part=F.pmod("user_id", F.lit(parts)).cast("int")))
    return index.withColumn("part", F.col("part").cast("long"))


# --- streams -------------------------------------------------------------------------------------------


def _event_stream(v: Views) -> DataFrame:
    events = v.table("events").select("user_id", "event_type", "value", "ts")
    folder = scratch(v, "stream-source")
    events.write.parquet(folder)
    stream = v.spark.readStream.schema(events.schema).parquet(folder)
    return stream.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.col("event_type").alias("category"),
        F.col("value").cast("float").alias("skill"),
        F.col("ts").cast("timestamp").alias("start_time"),
    )


@query
def stream_snapshots(v: Views) -> DataFrame:
    """The event table as a stream that offers each snapshot twice."""
    stream = _event_stream(v)
    tables = t.Tables(v.spark, scratch(v, "stream-tables"))
    run = snapshot_streams.run_snapshot_stream(stream.unionByName(stream), tables, scratch(v, "checkpoint"))
    run.awaitTermination()
    rows = tables.read(t.SNAPSHOTS)
    return rows.select(
        "user_id", "category", r4(dbl("skill")).alias("skill"), F.col("start_time").cast("timestamp_ntz").alias("start_time")
    )


@query
def stream_daily_skill(v: Views) -> DataFrame:
    """Daily means of the event stream, of all days, those still open included."""
    tables = t.Tables(v.spark, scratch(v, "stream-tables"))
    snapshot_streams.run_daily_skill(_event_stream(v), tables, scratch(v, "checkpoint")).awaitTermination()
    return snapshot_streams.daily_skill(tables).withColumn("avg_skill", r4("avg_skill"))


@query
def stream_closed_days(v: Views) -> DataFrame:
    """Daily means of the event stream, for the days that the watermark has closed."""
    means = snapshot_streams.daily_skill_stream(_event_stream(v))
    out = scratch(v, "stream-daily")
    writer = means.writeStream.outputMode("append").format("parquet").option("path", out)
    writer.option("checkpointLocation", scratch(v, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    rows = v.spark.read.schema(means.schema).parquet(out)
    return rows.select("user_id", "category", "day", r4("avg_skill").alias("avg_skill"))
