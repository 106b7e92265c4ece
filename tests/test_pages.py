"""Pages against a plain Python reading of the rules, on a small random fixture."""

from __future__ import annotations

import json
import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from replaystats.operators import aggregates as agg
from replaystats.plans import pages
from replaystats.schema import MATCH, MATCH_PLAYER
from tests.conftest import times

START, END = date(2025, 1, 1), date(2025, 4, 30)
AS_OF = datetime(2025, 4, 30, 12)
CATEGORIES = ["1v1", "FFA", "SmallTeam", None]
FACTIONS = ["Armada", "Cortex", None]


def half_up(value, places: int) -> float:
    quantum = Decimal(1).scaleb(-places)
    return float(Decimal(f"{value:.15g}" if isinstance(value, float) else value).quantize(quantum, ROUND_HALF_UP))


def ratio(n: int, d: int, places: int, times_100: bool = False) -> float:
    return half_up(Decimal(n) * (100 if times_100 else 1) / d, places) if d else 0.0


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    matches, players, snapshots = [], [], {}
    for n in range(260):
        when = datetime(2024, 12, 20) + timedelta(minutes=rng.randrange(0, 200_000))
        lobby = rng.choice([None, -3.0, 0.0, 20.5, 27.75, 28.0, 40.25, 58.0, 200.0])
        category = rng.choice(CATEGORIES)
        matches.append((f"m{n:03d}", when, f"map{n % 5}", rng.random() < 0.5, category, lobby))
        for user in rng.sample(range(1, 9), 4):
            # User 1 takes part in most matches: a hot key.
            user = 1 if rng.random() < 0.4 else user
            if any(p[0] == user and p[1] == f"m{n:03d}" for p in players):
                continue
            skill = rng.randrange(0, 240) / 4
            players.append(
                (user, f"m{n:03d}", rng.choice(["ann", "bob", "cy", None]), user + 100, skill, rng.choice(FACTIONS), rng.choice([True, False, None]))
            )
            if category is not None:
                snapshots[(user, category, when)] = rng.choice([skill, None])
    players.append((99, "m900", "solo", 1, 5.0, "Armada", True))
    matches.append(("m900", datetime(2025, 2, 2), "map", True, None, 10.0))  # only a match without category
    players.append((98, "m901", "gone", 1, 5.0, "Armada", True))
    matches.append(("m901", datetime(2024, 6, 1), "map", True, "1v1", 10.0))  # outside the window
    players.append((None, "m000", "bot", 1, 5.0, "Armada", True))
    return matches, players, snapshots


def frames(spark, data):
    matches, players, snapshots = data
    match_df = times(
        spark.createDataFrame(
            [(m, str(w), mp, r, c, l) for m, w, mp, r, c, l in matches],
            "replay_id string, start_time string, map_name string, ranked boolean, category string, avg_lobby_skill float",
        ),
        "start_time",
    )
    match_df = match_df.select(*[F.col(f.name) if f.name in match_df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in MATCH.fields])
    player_df = spark.createDataFrame(
        players, "user_id int, replay_id string, name string, player_id int, skill float, faction string, won boolean"
    )
    player_df = player_df.select(
        *[F.col(f.name) if f.name in player_df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in MATCH_PLAYER.fields]
    )
    snap_df = times(
        spark.createDataFrame(
            [(u, c, s, str(w)) for (u, c, w), s in snapshots.items()],
            "user_id int, category string, skill float, start_time string",
        ),
        "start_time",
    )
    return match_df, player_df, snap_df


def python_pages(data, fill: str) -> dict[int, dict]:
    matches, players, snapshots = data
    begin, stop = datetime.combine(START, datetime.min.time()), datetime.combine(END + timedelta(days=1), datetime.min.time())
    info = {m[0]: m for m in matches if begin <= m[1] < stop}
    latest = {}
    for (u, c, w), s in sorted(snapshots.items(), key=lambda kv: kv[0][2]):
        latest[(u, c)] = s
    played = defaultdict(list)
    for user, match, name, number, skill, faction, won in players:
        if user is not None and match in info:
            _, when, mp, ranked, category, lobby = info[match]
            played[user].append(dict(match=match, when=when, map=mp, ranked=ranked, cat=category, lobby=lobby, name=name, number=number, skill=skill, faction=faction, won=won))
    out = {}
    for user, everything in played.items():
        mine = [g for g in everything if g["cat"] is not None]
        modes, per_mode, lobby, factions = {}, {}, {}, {}
        for cat in sorted({g["cat"] for g in mine}):
            games = [g for g in mine if g["cat"] == cat]
            hard = [g for g in games if g["lobby"] is not None and g["lobby"] >= 28]
            easy = [g for g in games if g["lobby"] is not None and g["lobby"] < 28]
            wa, wb = sum(g["won"] is True for g in hard), sum(g["won"] is True for g in easy)
            os = latest.get((user, cat)) or 0.0
            ra, rb = (wa / len(hard) if hard else 0), (wb / len(easy) if easy else 0)
            if len(hard) / len(games) <= 0.3:  # exactly 30 % is too few
                adjusted = os - 5
            else:
                adjusted = os + ((wa + wb) / len(games) - 0.5) * 10 + (max(ra - rb, 0) * 2.5)
            modes[cat] = {"mode": cat, "os": half_up(os, 1), "as": half_up(float(adjusted), 2), "ga": len(hard), "wa": ratio(wa, len(hard), 2), "gb": len(easy), "wb": ratio(wb, len(easy), 2), "lastPlayed": max(g["when"] for g in games).strftime("%Y-%m-%d")}
            wins, losses = sum(g["won"] is True for g in games), sum(g["won"] is False for g in games)
            per_mode[cat] = {"mode": cat, "wins": wins, "losses": losses, "rate": ratio(wins, wins + losses, 1, True)}
        for cat in ["All", *modes]:
            games = [g for g in mine if cat in ("All", g["cat"])]
            rated = [g for g in games if g["lobby"] is not None]
            if rated:
                bins = [0] * 30
                for g in rated:
                    if g["lobby"] >= 0:
                        bins[min(int(g["lobby"] // 2), 29)] += 1
                lobby[cat] = bins
            labels = sorted({g["faction"] for g in games if g["faction"]})
            if labels:
                count = lambda label, won: sum(g["faction"] == label and g["won"] is won for g in games)
                factions[cat] = {"labels": labels, "datasets": [{"label": "Wins", "data": [count(x, True) for x in labels]}, {"label": "Losses", "data": [count(x, False) for x in labels]}]}
        newest = sorted(mine, key=lambda g: (g["when"], g["match"], g["number"]), reverse=True)
        names = defaultdict(lambda: datetime.min)
        for g in mine:
            if g["name"] is not None:
                names[g["name"]] = max(names[g["name"]], g["when"])
        days = defaultdict(list)
        for g in mine:
            days[g["when"].strftime("%Y-%m-%d")].append(g["skill"])
        wins, losses = sum(m["wins"] for m in per_mode.values()), sum(m["losses"] for m in per_mode.values())
        daily = defaultdict(lambda: defaultdict(list))
        for (u, c, w), s in snapshots.items():
            if u == user and begin <= w < stop:
                daily[c][w.date()].append(s)
        calendar = [START + timedelta(days=i) for i in range((END - START).days + 1)]
        sets = []
        for c in sorted(daily):
            mean = {d: (sum(x for x in v if x is not None) / len([x for x in v if x is not None]) if any(x is not None for x in v) else None) for d, v in daily[c].items()}
            values, last = [], 0.0
            for i, d in enumerate(calendar):
                value = mean.get(d)
                if fill == "lag1" and value is None:
                    value = 0.0 if i == 0 else mean.get(calendar[i - 1])
                elif fill == "ffill":
                    last = last if value is None else value
                    value = last
                values.append(None if value is None else half_up(float(value), 1))
            sets.append({"label": c, "data": values})
        out[user] = {
            "_version": 1,
            "_generated": "2025-04-30T12:00:00.000Z",
            "userId": user,
            "skillPerMode": modes,
            "winLossSummary": {"total": {"wins": wins, "losses": losses, "games": wins + losses, "winRate": ratio(wins, wins + losses, 1, True)}, "perMode": per_mode},
            "matchHistory": [{"date": g["when"].strftime("%d %b %Y"), "mode": g["cat"], "map": g["map"], "result": "Win" if g["won"] else "Loss", "faction": g["faction"], "ranked": g["ranked"], "username": g["name"]} for g in newest[:10]],
            "usernames": [{"name": n, "lastSeen": names[n].strftime("%Y-%m-%d")} for n in sorted(names, key=lambda n: (names[n], n), reverse=True)],
            "activityData": {d: {"games": len(days[d]), "avgSkill": half_up(sum(days[d]) / len(days[d]), 1)} for d in sorted(days, reverse=True)[:84]},
            "lobbyData": lobby,
            "factionData": factions,
            "skillHistory": {"labels": [d.isoformat() for d in calendar], "datasets": sets} if sets else {"labels": [], "datasets": []},
        }
    return out


@pytest.mark.parametrize("fill", ["lag1", "ffill"])
def test_pages_match_the_rules(spark, data, fill):
    match_df, player_df, snap_df = frames(spark, data)
    base = pages.player_matches(player_df, match_df, START, END)
    components = pages.page_components(base, agg.latest_skill(snap_df), snap_df, START, END, fill)
    stored = pages.page_rows(pages.assemble_pages(components, AS_OF), START, END, AS_OF)
    got = {r.user_id: json.loads(r.json_data) for r in stored.collect()}
    want = python_pages(data, fill)
    assert got.keys() == want.keys()
    assert 99 in got and 98 not in got
    for user in want:
        for part in want[user]:
            assert got[user][part] == want[user][part], (user, part)


def test_all_rows_are_the_sum_of_categories(spark, data):
    match_df, player_df, _ = frames(spark, data)
    matches = pages.relevant_matches(pages.player_matches(player_df, match_df, START, END))
    for counts, value in ((agg.lobby_histogram(matches), "games"), (agg.faction_stats(matches), "wins")):
        split = counts.groupBy(F.col("category") == "All").agg(F.sum(value)).collect()
        assert split[0][1] == split[1][1]
    in_lobbies = matches.filter("avg_lobby_skill IS NOT NULL").count()
    assert agg.lobby_histogram(matches).filter("category = 'All'").agg(F.sum("games")).first()[0] == in_lobbies


def test_replaced_pages(spark):
    columns = "user_id int, json_data string"
    old = spark.createDataFrame([(1, "a"), (2, "a")], columns)
    new = spark.createDataFrame([(2, "b"), (3, "b")], columns)
    assert sorted(map(tuple, pages.upsert_pages(old, new).collect())) == [(1, "a"), (2, "b"), (3, "b")]
