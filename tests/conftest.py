from __future__ import annotations

import json
from datetime import datetime

import pytest

from replaystats.session import CHECKPOINT_DIR, build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            CHECKPOINT_DIR: str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def times(df, name: str):
    """A text column as a timestamp: Python datetimes would depend on the machine's time zone."""
    return df.withColumn(name, df[name].cast("timestamp"))


def document(ident: str, start: str, players: list[tuple], **extra) -> dict:
    """A match document. A player is (user, name, team, player id, skill text, faction)."""
    teams: dict[int, list] = {}
    for user, name, team, number, skill, faction in players:
        entry = {
            "userId": user,
            "name": name,
            "playerId": number,
            "skill": skill,
            "rank": "3",
            "countryCode": "DE",
            "faction": faction,
        }
        teams.setdefault(team, []).append(entry)
    doc = {
        "id": ident,
        "startTime": start,
        "fileName": f"{ident}.bin",
        "mapId": "7",
        "hasBots": "false",
        "durationMs": 1000,
        "engineVersion": "e1",
        "gameVersion": "g1",
        "Map": {"scriptName": "Plains"},
        "gameSettings": {"ranked_game": "1"},
        "Spectators": [{"name": "s"}],
        "AllyTeams": [{"allyTeamId": t, "winningTeam": t == 0, "Players": p} for t, p in teams.items()],
    }
    doc.update(extra)
    return doc


def write_documents(folder, docs: list[dict]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    for doc in docs:
        (folder / f"{doc['id']}.json").write_text(json.dumps(doc))


def rows(df, *columns: str) -> list[tuple]:
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=repr)
