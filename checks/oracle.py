"""The SQL that each query must agree with, run by DuckDB on the same tables."""

from __future__ import annotations

from checks.job_queries import ORACLE as JOB_ORACLE

# The words that a PostgreSQL boolean takes.
TRUE_WORDS = ["t", "tr", "tru", "true", "y", "ye", "yes", "on", "1"]
FALSE_WORDS = ["f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0"]

PLAYERS = """players AS (
  SELECT l_suppkey AS user_id, l_orderkey AS replay_id, l_linestatus || '-' || l_returnflag AS name,
         l_linenumber AS player_id, l_returnflag AS ally_team_id, CAST(l_quantity AS REAL) AS skill,
         l_returnflag AS faction, CASE WHEN l_linenumber <> 7 THEN l_linestatus = 'F' END AS won
  FROM lineitem)"""

STATS = """stats AS (
  SELECT replay_id, count(DISTINCT player_id) AS player_count, count(DISTINCT ally_team_id) AS team_count,
         CAST(avg(CAST(skill AS DOUBLE)) AS REAL) AS avg_lobby_skill
  FROM players WHERE user_id IS NOT NULL AND skill IS NOT NULL GROUP BY replay_id)"""

CATEGORY = """CASE WHEN player_count = 2 THEN '1v1' WHEN team_count > 2 THEN 'FFA'
  WHEN player_count BETWEEN 4 AND 10 THEN 'SmallTeam' WHEN player_count BETWEEN 11 AND 16 THEN 'LargeTeam' END"""

MATCHES = f"""matches AS (
  SELECT o_orderkey AS replay_id, o_orderdate AS start_time, o_orderpriority AS map_name,
         o_orderstatus = 'F' AS ranked, player_count, team_count, avg_lobby_skill, {CATEGORY} AS category
  FROM orders JOIN stats ON o_orderkey = replay_id)"""

BASE = """base AS (
  SELECT user_id, p.replay_id, player_id, name AS username, skill, won, faction, start_time, category,
         map_name, ranked, avg_lobby_skill
  FROM players p JOIN matches m ON p.replay_id = m.replay_id
  WHERE user_id IS NOT NULL AND start_time >= TIMESTAMP '1999-07-17' AND start_time < TIMESTAMP '2000-01-02'),
relevant AS (SELECT * FROM base WHERE category IS NOT NULL)"""

ALL_MATCHES = f"WITH {PLAYERS}, {STATS}, {MATCHES}"
PAGE = f"{ALL_MATCHES}, {BASE}"

LATEST = """candidates AS (
  SELECT user_id, category, max(skill) AS skill, start_time
  FROM players p JOIN matches m ON p.replay_id = m.replay_id
  WHERE category IS NOT NULL AND user_id IS NOT NULL AND start_time < TIMESTAMP '2000-01-01'
  GROUP BY user_id, category, start_time),
latest AS (SELECT user_id, category, arg_max(skill, start_time) AS skill FROM candidates GROUP BY user_id, category)"""

MODES = """modes AS (
  SELECT user_id, category, max(start_time) AS last_played,
         count(*) FILTER (WHERE avg_lobby_skill >= 28) AS ga,
         count(*) FILTER (WHERE avg_lobby_skill >= 28 AND won) AS wa,
         count(*) FILTER (WHERE avg_lobby_skill < 28) AS gb,
         count(*) FILTER (WHERE avg_lobby_skill < 28 AND won) AS wb, count(*) AS games
  FROM relevant GROUP BY user_id, category)"""

WINLOSS = """winloss AS (
  SELECT user_id, category, count(*) FILTER (WHERE won) AS wins, count(*) FILTER (WHERE NOT won) AS losses
  FROM relevant GROUP BY user_id, category)"""

BIN = "CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 0 THEN -1 ELSE least(CAST(floor({x} / 2) AS BIGINT), 29) END"

LOBBY = f"""binned AS (
  SELECT user_id, category, {BIN.format(x="avg_lobby_skill")} AS bin FROM relevant WHERE avg_lobby_skill IS NOT NULL),
lobby AS (
  SELECT user_id, category, bin, count(*) AS games FROM binned GROUP BY user_id, category, bin
  UNION ALL SELECT user_id, 'All', bin, count(*) FROM binned GROUP BY user_id, bin),
lobby_dense AS (
  SELECT k.user_id, k.category, b.bin, coalesce(games, 0) AS games
  FROM (SELECT DISTINCT user_id, category FROM lobby) k
  CROSS JOIN (SELECT CAST(range AS BIGINT) AS bin FROM range(30)) b
  LEFT JOIN lobby l ON l.user_id = k.user_id AND l.category = k.category AND l.bin = b.bin)"""

FACTIONS = """factions AS (
  SELECT user_id, category, faction, count(*) FILTER (WHERE won) AS wins, count(*) FILTER (WHERE NOT won) AS losses
  FROM relevant WHERE faction IS NOT NULL GROUP BY user_id, category, faction
  UNION ALL
  SELECT user_id, 'All', faction, count(*) FILTER (WHERE won), count(*) FILTER (WHERE NOT won)
  FROM relevant WHERE faction IS NOT NULL GROUP BY user_id, faction)"""

HISTORY_GRID = """daily AS (
  SELECT user_id, event_type AS category, CAST(ts AS DATE) AS day, avg(value) AS skill
  FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31' GROUP BY ALL),
grid AS (
  SELECT k.user_id, k.category, CAST(d.day AS DATE) AS day, skill
  FROM (SELECT DISTINCT user_id, category FROM daily) k
  CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS day) d
  LEFT JOIN daily USING (user_id, category, day)),
lag1 AS (
  SELECT user_id, category, day,
         coalesce(skill, lag(skill, 1, 0.0) OVER (PARTITION BY user_id, category ORDER BY day)) AS value
  FROM grid)"""


def document_rows(origin: str, where: str) -> str:
    return (
        f"SELECT o_orderkey AS replay_id, o_orderdate AS start_time, '{origin}' AS origin, o_orderstatus AS status "
        f"FROM orders WHERE {where}"
    )


DOCS = f"""archive AS ({document_rows("archive", "o_orderdate < TIMESTAMP '2000-01-01'")}),
cache AS ({document_rows("cache", "o_orderdate >= TIMESTAMP '1999-01-01'")})"""

AGED = f"""docs AS ({document_rows("cache", "true")}),
stored AS (SELECT o_orderkey AS replay_id FROM orders WHERE o_orderstatus = 'F'),
oldest AS (
  SELECT replay_id FROM docs WHERE start_time < TIMESTAMP '1999-12-31')"""

LISTING = """listed AS (
  SELECT *, CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS id FROM lineitem),
fresh AS (
  SELECT * FROM listed WHERE id IS NOT NULL AND id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY l_shipdate, l_linenumber, l_suppkey, l_partkey, l_extendedprice) = 1)"""


def pg_round(x: str, scale: int, digits: int = 15) -> str:
    """Round through the decimal text with 6 (real) or 15 (double) significant digits."""
    text = f"printf('%.{digits - 1}e', CAST({x} AS DOUBLE))"
    return f"CAST(round(CAST({text} AS DECIMAL(38,18)), {scale}) AS DOUBLE)"


def rate(num: str, den: str, scale: int, pct: bool = False) -> str:
    """A zero-guarded ratio rounded half away from zero, computed in integers so that ties are exact."""
    unit = 10**scale
    top = f"CAST({num} AS BIGINT) * {unit * (100 if pct else 1)}"
    half_up = f"(2 * ({top}) + CAST({den} AS BIGINT)) // (2 * CAST({den} AS BIGINT))"
    return f"CASE WHEN {den} > 0 THEN CAST({half_up} AS DOUBLE) / {unit} ELSE 0 END"


def words(values: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in values)


DECORATED = """CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 THEN NULL
  WHEN l_returnflag = 'A' THEN '[' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.67]'
  WHEN l_returnflag = 'N' THEN '#' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '#'
  ELSE ' ~(' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5) ' END"""

SPELLINGS = [*TRUE_WORDS, *FALSE_WORDS]
SPELLED = [*SPELLINGS, *[f" {w.upper()} " for w in SPELLINGS]]

RATED = f"""rated AS (
  SELECT m.user_id, m.category, CAST(coalesce(l.skill, 0) AS DOUBLE) AS os, coalesce(l.skill, CAST(0 AS REAL)) AS os_real,
         ga, wa, gb, wb, games, last_played,
         CASE WHEN ga > 0 THEN CAST(wa AS DOUBLE) / ga ELSE 0 END AS ra,
         CASE WHEN gb > 0 THEN CAST(wb AS DOUBLE) / gb ELSE 0 END AS rb
  FROM modes m LEFT JOIN latest l ON m.user_id = l.user_id AND m.category = l.category),
adjusted AS (
  SELECT *, CASE WHEN games = 0 THEN os
      WHEN CAST(ga AS DOUBLE) / games < CAST(CAST(0.3 AS REAL) AS DOUBLE) THEN os - 5.0
      ELSE os + (CAST(wa + wb AS DOUBLE) / games - 0.5) * 10.0 + CASE WHEN ra > rb THEN (ra - rb) * 2.5 ELSE 0 END
    END AS as_rating
  FROM rated)"""

TWO_WINDOWS = """WITH pages AS (
  SELECT o_custkey AS user_id, o_orderdate >= TIMESTAMP '2000-01-01' AS late, count(*) AS games
  FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2000-07-01' GROUP BY 1, 2)
SELECT user_id, '{"userId":' || user_id || ',"games":' || games || '}' AS json_data,
  CASE WHEN late THEN TIMESTAMP '2000-06-30' ELSE TIMESTAMP '1999-12-31' END AS last_generated_at,
  CASE WHEN late THEN DATE '2000-01-01' ELSE DATE '1995-01-01' END AS data_start_date,
  CASE WHEN late THEN DATE '2000-06-30' ELSE DATE '1999-12-31' END AS data_end_date
FROM pages QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY late DESC) = 1"""



def numbered(part: str, key: str, columns: list[str], source: str) -> str:
    """A row (user, part, key, pos, text, number) for each of the columns, which are numbers."""
    return " UNION ALL ".join(
        f"SELECT user_id, '{part}' AS part, {key} AS key, {n} AS pos, NULL AS text, CAST({c} AS DOUBLE) AS number FROM {source}"
        for n, c in enumerate(columns)
    )


def named(part: str, columns: dict[str, str], pos: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT user_id, '{part}', '{key}', {pos}, CAST({c} AS VARCHAR), NULL FROM {source}" for key, c in columns.items()
    )


HARD, EASY = rate("wa", "ga", 2), rate("wb", "gb", 2)
PAGE_FIELDS = f"""{PAGE}, {LATEST}, {MODES}, {RATED}, {WINLOSS}, {LOBBY}, {FACTIONS},
users AS (SELECT DISTINCT user_id FROM base),
totals AS (
  SELECT u.user_id, coalesce(sum(wins), 0) AS wins, coalesce(sum(losses), 0) AS losses
  FROM users u LEFT JOIN winloss w ON u.user_id = w.user_id GROUP BY u.user_id),
played AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_time DESC, replay_id DESC, player_id DESC,
    username DESC, faction DESC, won DESC NULLS FIRST) - 1 AS n FROM relevant),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY last_at DESC, username DESC) - 1 AS n FROM (
    SELECT user_id, username, max(start_time) AS last_at FROM relevant WHERE username IS NOT NULL GROUP BY 1, 2)),
active AS (
  SELECT user_id, CAST(start_time AS DATE) AS day, count(*) AS games, avg(CAST(skill AS DOUBLE)) AS avg_skill
  FROM relevant GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day DESC) <= 84),
lobby_keys AS (SELECT DISTINCT user_id, category FROM lobby),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY faction) - 1 AS n FROM factions),
snaps AS (
  SELECT user_id, category, CAST(start_time AS DATE) AS day, avg(CAST(skill AS DOUBLE)) AS skill FROM candidates
  WHERE start_time >= TIMESTAMP '1999-07-17' AND user_id IN (SELECT user_id FROM users) GROUP BY 1, 2, 3),
days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1999-07-17', TIMESTAMP '2000-01-01', INTERVAL 1 DAY)) AS DATE) AS day),
series AS (
  SELECT k.user_id, k.category, d.day, coalesce(skill, lag(skill, 1, 0.0) OVER (PARTITION BY k.user_id, k.category ORDER BY d.day)) AS value
  FROM (SELECT DISTINCT user_id, category FROM snaps) k CROSS JOIN days d
  LEFT JOIN snaps s ON s.user_id = k.user_id AND s.category = k.category AND s.day = d.day)
SELECT user_id, part, key, CAST(pos AS BIGINT) AS pos, text, number FROM (
{numbered("page", "''", ["1", "user_id"], "users")}
UNION ALL {numbered("total", "''", ["wins", "losses", "wins + losses", rate("wins", "(wins + losses)", 1, pct=True)], "totals")}
UNION ALL {numbered("skill", "category", [pg_round("os_real", 1, 6), pg_round("as_rating", 2), "ga", HARD, "gb", EASY], "adjusted")}
UNION ALL SELECT user_id, 'skill', category, 6, strftime(last_played, '%Y-%m-%d'), NULL FROM adjusted
UNION ALL {numbered("mode", "category", ["wins", "losses", rate("wins", "(wins + losses)", 1, pct=True)], "winloss")}
UNION ALL {named("history", {"date": "strftime(start_time, '%d %b %Y')", "mode": "category", "map": "map_name",
    "result": "CASE WHEN won THEN 'Win' ELSE 'Loss' END", "faction": "faction", "ranked": "ranked", "username": "username"},
    "n", "played WHERE n < 10")}
UNION ALL {named("name", {"name": "username", "lastSeen": "strftime(last_at, '%Y-%m-%d')"}, "n", "seen")}
UNION ALL {numbered("activity", "strftime(day, '%Y-%m-%d')", ["games", pg_round("avg_skill", 1)], "active")}
UNION ALL SELECT user_id, 'lobbyOrder', '', row_number() OVER (PARTITION BY user_id ORDER BY category <> 'All', category) - 1, category, NULL FROM lobby_keys
UNION ALL SELECT user_id, 'lobby', category, bin, NULL, games FROM lobby_dense
UNION ALL SELECT user_id, 'factionOrder', '', row_number() OVER (PARTITION BY user_id ORDER BY category <> 'All', category) - 1, category, NULL
  FROM (SELECT DISTINCT user_id, category FROM factions)
UNION ALL SELECT user_id, 'faction', category, n, faction, NULL FROM placed
UNION ALL SELECT user_id, 'factionWins', category, n, NULL, wins FROM placed
UNION ALL SELECT user_id, 'factionLosses', category, n, NULL, losses FROM placed
UNION ALL SELECT user_id, 'day', '', CAST(day - DATE '1999-07-17' AS BIGINT), strftime(day, '%Y-%m-%d'), NULL
  FROM (SELECT DISTINCT user_id FROM snaps) CROSS JOIN days
UNION ALL SELECT user_id, 'series', category, CAST(day - DATE '1999-07-17' AS BIGINT), NULL, {pg_round("value", 1)} FROM series)"""

ORACLE = {
    "category_win_rate": f"""{ALL_MATCHES}
SELECT category, count(*) FILTER (WHERE won) AS wins, count(*) FILTER (WHERE NOT won) AS losses,
       count(won) AS games, {rate("count(*) FILTER (WHERE won)", "count(won)", 1, pct=True)} AS win_rate
FROM players p JOIN matches m ON p.replay_id = m.replay_id WHERE category IS NOT NULL GROUP BY category""",
    "lobby_stats": f"""WITH {PLAYERS}, {STATS}
SELECT replay_id, player_count, team_count, round(CAST(avg_lobby_skill AS DOUBLE), 4) AS avg_lobby_skill FROM stats""",
    "match_category": f"""WITH {PLAYERS}, {STATS}
SELECT {CATEGORY} AS category, count(*) AS matches, min(player_count) AS min_players,
       max(player_count) AS max_players, max(team_count) AS max_teams FROM stats GROUP BY 1""",
    "derived_matches": f"""{ALL_MATCHES}
SELECT o_orderkey AS replay_id, o_orderdate AS start_time,
       CASE WHEN stored THEN -1 ELSE CAST(o_custkey AS INTEGER) END AS map_id, o_orderpriority AS map_name,
       o_orderstatus = 'F' AS ranked, CASE WHEN fresh THEN m.category ELSE 'stale' END AS category,
       CASE WHEN fresh THEN round(CAST(m.avg_lobby_skill AS DOUBLE), 4) ELSE 0 END AS avg_lobby_skill,
       CASE WHEN stored THEN 0 ELSE m.player_count END AS player_count,
       CASE WHEN fresh THEN m.team_count ELSE 0 END AS team_count,
       CASE WHEN stored THEN false ELSE o_orderstatus = 'P' END AS has_bots,
       CASE WHEN stored THEN 0 END AS duration_ms,
       CASE WHEN stored THEN 'stale' WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'archive' ELSE 'cache' END AS engine_version,
       CASE WHEN stored THEN 'stale' ELSE o_orderstatus END AS game_version,
       CASE WHEN stored THEN 0 ELSE 2 END AS spectator_count
FROM (SELECT *, o_orderdate < TIMESTAMP '1999-07-01' AS stored FROM orders) o
LEFT JOIN (SELECT *, start_time >= TIMESTAMP '1999-01-01' AS fresh FROM matches) m ON o_orderkey = m.replay_id
WHERE stored OR fresh""",
    "clean_skill": f"""SELECT l_orderkey, l_linenumber, {DECORATED} AS written,
  round(CAST(CAST(nullif(regexp_replace({DECORATED}, '[\\[\\]#~()\\s]+', '', 'g'), '') AS REAL) AS DOUBLE), 4) AS skill
FROM lineitem""",
    "nullif_cast": """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN l_partkey END AS value FROM lineitem""",
    "pg_bool": f"""WITH spelled AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
    THEN ([{words(SPELLED)}])[CAST(o_custkey % {len(SPELLED)} + 1 AS INTEGER)] END AS written FROM orders)
SELECT o_orderkey, written,
  CASE WHEN lower(trim(written)) IN ({words(TRUE_WORDS)}) THEN true
       WHEN lower(trim(written)) IN ({words(FALSE_WORDS)}) THEN false END AS value FROM spelled""",
    "json_extract_cast": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  json_extract_string(props, '$.absent.deep') IS NULL AS missing FROM events""",
    "pg_round": f"""SELECT l_orderkey, l_linenumber,
  {pg_round("CAST(l_extendedprice / 1000 AS REAL)", 1, 6)} AS single_1,
  {pg_round("l_extendedprice * l_discount", 2)} AS double_2 FROM lineitem""",
    "bucket_index": f"""SELECT CAST({BIN.format(x="value")} AS INTEGER) AS bin, count(*) AS n, min(value) AS low, max(value) AS high
FROM (SELECT CASE WHEN l_linenumber <> 7 THEN l_quantity * 1.5 - 5 END AS value FROM lineitem) GROUP BY 1""",
    "safe_rate": f"""WITH {PLAYERS}, counts AS (
  SELECT user_id, count(*) FILTER (WHERE won) AS wins, count(*) FILTER (WHERE won AND skill > 49) AS top, count(*) AS n
  FROM players GROUP BY user_id)
SELECT user_id, {rate("wins", "n", 2)} AS ratio, {rate("wins", "n", 1, pct=True)} AS percent, {rate("n", "top", 2)} AS guarded
FROM counts""",
    "time_predicates": """SELECT event_type,
  count(*) FILTER (WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20') AS closed,
  count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20') AS half_open,
  count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21') AS whole_days,
  count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-10') AS open_end,
  count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-24') AS older FROM events GROUP BY event_type""",
    "date_formats": """SELECT CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y-%m-%d') AS short,
  strftime(o_orderdate, '%d %b %Y') AS long, count(*) AS orders FROM orders GROUP BY 1, 2, 3""",
    "result_labels": f"""WITH {PLAYERS}
SELECT user_id, CASE WHEN won THEN 'Win' ELSE 'Loss' END AS result, count(*) AS n FROM players GROUP BY 1, 2""",
    "explode_players": """SELECT l_orderkey AS replay_id, l_shipdate AS start_time,
  CASE WHEN seat = 0 THEN CAST(l_suppkey AS INTEGER) END AS user_id, l_linestatus AS name,
  CAST(l_linenumber + 10 * seat AS INTEGER) AS player_id, CAST(l_linenumber AS INTEGER) AS ally_team_id,
  l_quantity AS skill, CAST(NULL AS INTEGER) AS rank, l_returnflag AS country_code, l_returnflag AS faction,
  l_linestatus = 'F' AS won
FROM lineitem, (VALUES (0), (1)) s(seat) WHERE l_linenumber <> 7""",
    "calendar_activity": """SELECT CAST(d.day AS DATE) AS day, count(event_id) AS events
FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS day) d
LEFT JOIN events ON CAST(ts AS DATE) = CAST(d.day AS DATE) GROUP BY 1""",
    "first_per_key": """SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
    "latest_per_key": """SELECT user_id, event_type AS category, arg_max(value, ts) AS latest_skill, max(ts) AS latest_played_time
FROM events GROUP BY 1, 2""",
    "merge_latest_skill": """SELECT user_id, event_type AS category, arg_max(value, ts) AS latest_skill, max(ts) AS latest_played_time
FROM events GROUP BY 1, 2""",
    "prefer_left_union": f"""WITH {DOCS}
SELECT replay_id, coalesce(a.start_time, c.start_time) AS start_time, coalesce(a.origin, c.origin) AS origin
FROM archive a FULL JOIN cache c USING (replay_id)""",
    "prefer_left_fieldwise": f"""WITH {DOCS}
SELECT replay_id, coalesce(CASE WHEN a.status <> 'P' THEN a.start_time END, c.start_time) AS start_time,
       coalesce(a.origin, c.origin) AS origin
FROM archive a FULL JOIN cache c USING (replay_id)""",
    "filter_new": f"""WITH {LISTING} SELECT id, l_shipdate, l_linenumber, l_suppkey FROM fresh""",
    "filter_new_skipped": f"""WITH {LISTING}
SELECT 'normal' AS mode, (SELECT count(id) FROM listed) - (SELECT count(*) FROM fresh) AS n
UNION ALL SELECT 'forced', 0 UNION ALL SELECT 'admitted', (SELECT count(id) FROM listed)""",
    "insert_ignore": """WITH lines AS (
  SELECT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber, l_suppkey, l_partkey, l_shipdate FROM lineitem)
SELECT * FROM (
  SELECT * FROM lines b WHERE l_linenumber IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM lines s WHERE s.l_shipdate < TIMESTAMP '1998-01-01'
      AND s.l_orderkey = b.l_orderkey AND s.l_linenumber = b.l_linenumber)
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_suppkey, l_partkey) = 1)
UNION ALL SELECT * FROM lines WHERE l_linenumber IS NULL""",
    "insert_match_players": """WITH batch AS (
  SELECT CASE WHEN l_linenumber <> 6 THEN l_suppkey END AS user_id, l_orderkey AS replay_id,
         nullif(l_linenumber, 5) AS player_id, l_shipdate AS start_time, l_quantity AS skill, l_partkey AS rank,
         l_returnflag AS faction FROM lineitem),
stored AS (SELECT * FROM batch WHERE start_time < TIMESTAMP '1997-01-01'),
fresh AS (
  SELECT * FROM batch b WHERE user_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.user_id = b.user_id AND s.replay_id = b.replay_id)
  UNION ALL
  SELECT * FROM batch b WHERE user_id IS NULL AND NOT EXISTS (
    SELECT 1 FROM stored s WHERE s.user_id IS NULL AND s.replay_id = b.replay_id AND s.player_id = b.player_id))
SELECT * FROM fresh
QUALIFY player_id IS NULL
  OR row_number() OVER (PARTITION BY replay_id, user_id, player_id ORDER BY start_time, faction, skill, rank) = 1""",
    "upsert_partial": """WITH stored AS (SELECT c_custkey, c_name, c_mktsegment, round(c_acctbal, 2) AS c_acctbal FROM customer WHERE c_acctbal >= 0),
spent AS (SELECT o_custkey AS c_custkey, 'new' AS c_name, max(o_orderpriority) AS c_mktsegment, max(o_totalprice) AS c_acctbal
  FROM orders GROUP BY o_custkey),
batch AS (SELECT * FROM spent UNION ALL
  SELECT c_custkey, c_name, c_mktsegment, round(c_acctbal, 2) FROM customer
  WHERE c_acctbal < 0 AND c_custkey NOT IN (SELECT c_custkey FROM spent))
SELECT c_custkey, coalesce(s.c_name, b.c_name) AS c_name, coalesce(b.c_mktsegment, s.c_mktsegment) AS c_mktsegment,
       coalesce(b.c_acctbal, s.c_acctbal) AS c_acctbal FROM stored s FULL JOIN batch b USING (c_custkey)""",
    "age_out_cache": f"""WITH {AGED}
SELECT replay_id, start_time, origin FROM docs WHERE replay_id NOT IN (SELECT replay_id FROM oldest)""",
    "age_out_archive": f"""WITH {AGED}
SELECT replay_id, start_time, origin FROM docs
WHERE replay_id IN (SELECT replay_id FROM oldest) AND replay_id NOT IN (SELECT replay_id FROM stored)""",
    "update_snapshots": """SELECT user_id, event_type AS category, ts AS start_time, round(max(value) + 1, 4) AS skill
FROM events e WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-18 12:00:00' AND ts < TIMESTAMP '2024-01-24 23:55:00'
  AND NOT EXISTS (SELECT 1 FROM events s WHERE s.ts < TIMESTAMP '2024-01-20'
    AND s.user_id = e.user_id AND s.event_type = e.event_type AND s.ts = e.ts)
GROUP BY user_id, event_type, ts""",
    "scan_window": """SELECT event_type, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'click') - INTERVAL 36 HOUR
  AND ts < TIMESTAMP '2024-01-29 23:55:00' GROUP BY event_type""",
    "advance_watermark": """SELECT event_type AS key,
  CASE WHEN event_type = 'click' THEN TIMESTAMP '2024-01-24 23:55:00' ELSE max(ts) END AS last_loaded_at
FROM events GROUP BY event_type
UNION ALL SELECT 'match_skill_snapshots', TIMESTAMP '2024-01-24 23:55:00'""",
    "active_users": f"{PAGE} SELECT DISTINCT user_id FROM base",
    "relevant_matches": f"""{PAGE}
SELECT user_id, replay_id, player_id, category, start_time, won, CAST(skill AS DOUBLE) AS skill,
       round(CAST(avg_lobby_skill AS DOUBLE), 4) AS avg_lobby_skill FROM relevant""",
    "mode_components": f"{PAGE}, {MODES} SELECT * FROM modes",
    "skill_per_mode": f"""{PAGE}, {LATEST}, {MODES}, {RATED}
SELECT user_id, category, {pg_round("os_real", 1, 6)} AS os_rating, {pg_round("as_rating", 2)} AS adjusted,
       ga, {rate("wa", "ga", 2)} AS hard_rate, gb, {rate("wb", "gb", 2)} AS easy_rate,
       strftime(last_played, '%Y-%m-%d') AS last_played FROM adjusted""",
    "win_loss_mode": f"{PAGE}, {WINLOSS} SELECT * FROM winloss",
    "win_loss_total": f"""{PAGE}, {WINLOSS}, totals AS (
  SELECT user_id, CAST(sum(wins) AS BIGINT) AS wins, CAST(sum(losses) AS BIGINT) AS losses FROM winloss GROUP BY user_id)
SELECT user_id, wins, losses, wins + losses AS games, {rate("wins", "(wins + losses)", 1, pct=True)} AS win_rate FROM totals""",
    "match_history_top10": f"""{PAGE}, ranked_matches AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_time DESC, replay_id DESC, player_id DESC,
    username DESC, faction DESC, won DESC NULLS FIRST) AS rn FROM relevant)
SELECT user_id, rn, strftime(start_time, '%d %b %Y') AS played_on, category, map_name,
       CASE WHEN won THEN 'Win' ELSE 'Loss' END AS result, faction, ranked, username
FROM ranked_matches WHERE rn <= 10""",
    "usernames_last_seen": """SELECT n_name AS user_id, c_mktsegment AS name, max(o_orderdate) AS last_seen
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    "username_lists": f"""{PAGE}, seen AS (
  SELECT user_id, username, max(start_time) AS last_at FROM relevant WHERE username IS NOT NULL GROUP BY user_id, username)
SELECT user_id, string_agg(username || '@' || strftime(last_at, '%Y-%m-%d'), ',' ORDER BY last_at DESC, username DESC) AS names
FROM seen GROUP BY user_id""",
    "daily_activity_84": f"""{PAGE}, daily AS (
  SELECT user_id, CAST(start_time AS DATE) AS day, count(*) AS games, avg(CAST(skill AS DOUBLE)) AS avg_skill
  FROM relevant GROUP BY 1, 2)
SELECT user_id, day, games, round(avg_skill, 4) AS avg_skill FROM daily
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day DESC) <= 84""",
    "lobby_histogram": f"{PAGE}, {LOBBY} SELECT * FROM lobby",
    "lobby_histogram_dense": f"{PAGE}, {LOBBY} SELECT * FROM lobby_dense",
    "lobby_arrays": f"""{PAGE}, {LOBBY}
SELECT user_id, category, string_agg(CAST(games AS VARCHAR), ',' ORDER BY bin) AS bins FROM lobby_dense GROUP BY 1, 2""",
    "faction_stats": f"{PAGE}, {FACTIONS} SELECT user_id, category, faction, wins, losses FROM factions",
    "faction_arrays": f"""{PAGE}, {FACTIONS}
SELECT user_id, category, string_agg(faction, ',' ORDER BY faction) AS labels,
       string_agg(CAST(wins AS VARCHAR), ',' ORDER BY faction) AS wins,
       string_agg(CAST(losses AS VARCHAR), ',' ORDER BY faction) AS losses FROM factions GROUP BY 1, 2""",
    "skill_history_lag1": f"WITH {HISTORY_GRID} SELECT user_id, category, day, round(value, 4) AS value FROM lag1",
    "skill_history_ffill": f"""WITH {HISTORY_GRID}
SELECT user_id, category, day, round(coalesce(last_value(skill IGNORE NULLS) OVER (
  PARTITION BY user_id, category ORDER BY day ROWS UNBOUNDED PRECEDING), 0.0), 4) AS value FROM grid""",
    "skill_history_arrays": f"""WITH {HISTORY_GRID}
SELECT user_id, category, CAST(30 AS BIGINT) AS days, count(*) AS points, count(value) AS known,
       round(sum({pg_round("value", 1)}) FILTER (WHERE value IS NOT NULL), 1) AS total FROM lag1 GROUP BY user_id, category""",
    "page_counts": f"""{PAGE}, {WINLOSS}, {LOBBY}, {FACTIONS},
snaps AS (SELECT DISTINCT user_id, category FROM relevant WHERE start_time < TIMESTAMP '2000-01-01')
SELECT u.user_id,
  (SELECT count(*) FROM winloss w WHERE w.user_id = u.user_id) AS modes,
  (SELECT CAST(coalesce(sum(wins), 0) AS BIGINT) FROM winloss w WHERE w.user_id = u.user_id) AS wins,
  (SELECT CAST(coalesce(sum(losses), 0) AS BIGINT) FROM winloss w WHERE w.user_id = u.user_id) AS losses,
  (SELECT least(count(*), 10) FROM relevant r WHERE r.user_id = u.user_id) AS history,
  (SELECT count(DISTINCT username) FROM relevant r WHERE r.user_id = u.user_id) AS names,
  (SELECT least(count(DISTINCT CAST(start_time AS DATE)), 84) FROM relevant r WHERE r.user_id = u.user_id) AS days,
  (SELECT CAST(coalesce(sum(games), 0) AS BIGINT) FROM lobby l WHERE l.user_id = u.user_id AND category = 'All' AND bin >= 0) AS lobby_games,
  (SELECT count(DISTINCT category) FROM lobby l WHERE l.user_id = u.user_id) AS lobby_rows,
  (SELECT count(DISTINCT category) FROM factions f WHERE f.user_id = u.user_id) AS faction_rows,
  CASE WHEN EXISTS (SELECT 1 FROM snaps s WHERE s.user_id = u.user_id) THEN CAST(169 AS BIGINT) ELSE 0 END AS labels,
  (SELECT count(*) FROM snaps s WHERE s.user_id = u.user_id) AS datasets
FROM (SELECT DISTINCT user_id FROM base) u""",
    "page_fields": PAGE_FIELDS,
    "upsert_pages": TWO_WINDOWS,
    "read_pages": f"SELECT user_id, json_data FROM ({TWO_WINDOWS}) WHERE data_end_date = DATE '1999-12-31'",
    "listing_filter": """SELECT o_orderkey AS replay_id, o_orderdate AS start_time FROM orders
WHERE o_orderdate >= TIMESTAMP '1999-07-17' AND o_orderdate < TIMESTAMP '2000-01-02'
  AND o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
    "listing_page": """SELECT o_orderkey AS replay_id, o_orderdate AS start_time FROM orders
WHERE o_orderdate >= TIMESTAMP '1999-07-17' AND o_orderdate < TIMESTAMP '2000-01-02'
  AND o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
ORDER BY o_orderdate DESC, o_orderkey LIMIT 500 OFFSET 500""",
    "outcome_summary": """SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS fetched,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS existed, count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS ok,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS fail, round(count(*) / 60.0, 4) AS per_second FROM orders""",
    "seen_ids": "SELECT DISTINCT CAST(event_id AS VARCHAR) AS game_id FROM events WHERE event_type IN ('click', 'view')",
    "write_by_day": "SELECT CAST(ts AS DATE) AS start_date, count(*) AS n, min(ts) AS first_at FROM events GROUP BY 1",
    "split_valid": """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, max(CAST(o_orderkey AS VARCHAR)) AS last_id
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' GROUP BY 1
UNION ALL SELECT NULL, count(*), NULL FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'""",
    "packed_index": """WITH docs AS (
  SELECT l_suppkey AS user_id, '{"userId":' || l_suppkey || ',"games":' || count(*) || ',"wins":'
    || count(*) FILTER (WHERE l_linenumber <> 7 AND l_linestatus = 'F') || '}' AS doc FROM lineitem GROUP BY l_suppkey),
sized AS (SELECT user_id, strlen(doc) + 1 AS length FROM docs),
parts AS (SELECT *, user_id % (SELECT CAST(greatest(ceil(sum(length) / 512.0), 1) AS BIGINT) FROM sized) AS part FROM sized)
SELECT user_id, part, CAST(coalesce(sum(length) OVER (PARTITION BY part ORDER BY user_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset", length FROM parts""",
    "stream_snapshots": """SELECT CAST(user_id AS INTEGER) AS user_id, event_type AS category,
  round(CAST(max(CAST(value AS REAL)) AS DOUBLE), 4) AS skill, ts AS start_time FROM events GROUP BY 1, 2, 4""",
    "stream_daily_skill": """SELECT CAST(user_id AS INTEGER) AS user_id, event_type AS category, CAST(ts AS DATE) AS day,
  round(avg(CAST(CAST(value AS REAL) AS DOUBLE)), 4) AS avg_skill FROM events GROUP BY 1, 2, 3""",
    "stream_closed_days": """SELECT CAST(user_id AS INTEGER) AS user_id, event_type AS category, CAST(ts AS DATE) AS day,
  round(avg(CAST(CAST(value AS REAL) AS DOUBLE)), 4) AS avg_skill FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 36 HOUR GROUP BY 1, 2, 3""",
    "rejected_values": """WITH marked AS (
  SELECT l_orderkey AS replay_id, CAST(l_linenumber AS INTEGER) AS player_id, l_suppkey, l_quantity, l_linestatus,
         l_linenumber = 3 AND l_quantity > 40 AS bad_user, l_linenumber = 4 AND l_quantity > 30 AS bad_skill,
         l_linenumber = 5 AND l_quantity > 45 AS bad_won, l_linenumber = 3 AND l_quantity > 45 AS bad_rank FROM lineitem)
SELECT replay_id, player_id, 'userId' AS field, 'u17' AS value FROM marked WHERE bad_user
UNION ALL SELECT replay_id, player_id, 'rank', '9.5.1' FROM marked WHERE bad_rank
UNION ALL SELECT replay_id, player_id, 'skill', '[n/a]' FROM marked WHERE bad_skill
UNION ALL SELECT replay_id, player_id, 'winningTeam', 'perhaps' FROM marked WHERE bad_won
UNION ALL SELECT replay_id, player_id, 'kept', l_suppkey || '/' || CAST(l_quantity AS INTEGER) || '/' || (l_linestatus = 'F')
FROM marked WHERE NOT (bad_user OR bad_skill OR bad_won OR bad_rank)""",
}
ORACLE |= JOB_ORACLE
