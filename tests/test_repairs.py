"""Runs that repeat, die half-way or lie side by side."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from replaystats.functions.scalars import pg_round
from replaystats.plans import jobs
from replaystats.session import stage, staging
from replaystats.sources import tables as t
from replaystats.sources.tables import Tables
from replaystats.streaming.snapshots import add_daily_parts, daily_skill, run_daily_skill, run_snapshot_stream
from tests.conftest import document, rows, write_documents

LATER = datetime(2100, 1, 1)


def docs(days):
    return [document(f"m{d}", f"2025-05-{d:02}T10:00:00.000Z", [(1, "a", 0, 1, "[20.5]", "x"), (2, "b", 1, 2, "[21]", "y")]) for d in days]


def test_every_aged_match_is_archived_once(spark, tmp_path):
    tables, inbox = Tables(spark, str(tmp_path / "tables")), tmp_path / "inbox"
    write_documents(inbox, docs(range(20, 24)))
    inserted = []
    for day in (22, 23, 25):
        inserted.append(jobs.ingest_meta(spark, str(inbox), tables, LATER)["inserted"])
        jobs.move_raw_replays(tables, datetime(2025, 5, day, 12))
    assert inserted == [4, 0, 0]
    assert rows(tables.read(t.RAW_ARCHIVE), "replay_id") == [(f"m{d}",) for d in range(20, 24)]
    assert tables.read(t.RAW_CACHE).count() == 0


def test_read_files_are_handed_off(spark, tmp_path):
    tables, inbox = Tables(spark, str(tmp_path / "tables")), tmp_path / "inbox"
    done, aside = tmp_path / "processed", tmp_path / "naughty"
    write_documents(inbox, docs([20, 21]))
    (inbox / "broken.json").write_text("{")
    for _ in range(2):
        jobs.ingest_meta(spark, str(inbox), tables, LATER, str(aside), str(done))
    assert sorted(p.name for p in done.glob("*.json")) == ["m20.json", "m21.json"]
    assert [p.name for p in aside.glob("*.json")] == ["broken.json"] and not list(inbox.glob("*.json"))
    write_documents(inbox, docs([20]))  # the name is taken
    assert jobs.ingest_meta(spark, str(inbox), tables, LATER, str(aside), str(done))["inserted"] == 0
    assert sorted(p.name for p in aside.glob("*.json")) == ["broken.json", "m20.json"]


def test_deltas_after_a_crash(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path / "tables"))
    write_documents(tmp_path / "inbox", docs(range(20, 24)))
    jobs.ingest_meta(spark, str(tmp_path / "inbox"), tables, LATER)
    as_of = datetime(2025, 5, 24, 12)
    jobs.replay_meta_ingress(tables, as_of)
    with monkeypatch.context() as broken:
        broken.setattr(tables, "replace", lambda *a, **b: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            jobs.update_snapshots(tables, as_of)
    assert tables.read(t.SNAPSHOTS).count() > 0 and tables.read(t.SKILL_DELTAS).count() == 0
    assert jobs.update_snapshots(tables, as_of) == 0
    repaired = rows(tables.read(t.SKILL_DELTAS))
    jobs.refresh_latest_skill(tables)
    assert repaired == rows(tables.read(t.SKILL_DELTAS)) and repaired


def test_stream_keeps_late_rows(spark, tmp_path):
    start = datetime(2024, 1, 1)
    for n, day in enumerate((20, 3, 11)):  # in shuffled time order, one file a batch
        row = [(1, "c", float(day), start + timedelta(days=day))]
        spark.createDataFrame(row, "user_id int, category string, skill float, start_time timestamp").coalesce(1).write.parquet(str(tmp_path / "in" / f"b={n}"))
    source = spark.readStream.schema("user_id int, category string, skill float, start_time timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    tables = Tables(spark, str(tmp_path / "tables"))
    run_snapshot_stream(source, tables, str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(tables.read(t.SNAPSHOTS), "skill") == [(11.0,), (20.0,), (3.0,)]
    assert rows(tables.read(t.SKILL_DELTAS), "latest_skill") == [(20.0,)]


def test_staging_scopes_are_apart(spark):
    outer = stage(spark.range(3), "outer")
    with staging(spark):
        inner = stage(spark.range(4), "inner")
        assert inner.count() == 4
    assert outer.count() == 3


def test_rounding_of_what_is_no_number(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (16.05,), (None,)], "x double")
    assert [None if r[0] is None else float(r[0]) for r in df.select(pg_round("x", 1)).collect()] == [None, None, None, 16.1, None]
    assert df.filter(F.isnan("x")).count() == 1


def test_bad_values_go_to_the_reject_table(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "tables"))
    good, bad = docs([20])[0], docs([21])[0]
    good["AllyTeams"][0]["Players"].append(good["AllyTeams"][0]["Players"][0] | {"userId": "x9", "playerId": "9", "skill": "[?]"})
    bad["durationMs"], bad["AllyTeams"][1]["winningTeam"] = "long", "perhaps"
    write_documents(tmp_path / "inbox", [good, bad])
    jobs.ingest_meta(spark, str(tmp_path / "inbox"), tables, LATER)
    for hour in (12, 13):
        jobs.replay_meta_ingress(tables, datetime(2025, 5, 22, hour))
        found = rows(tables.read(t.REJECTS), "replay_id", "target", "field", "value")
        assert found == [
            ("m20", t.MATCH_PLAYERS, "skill", "[?]"),
            ("m20", t.MATCH_PLAYERS, "userId", "x9"),
            ("m21", t.MATCH_PLAYERS, "winningTeam", "perhaps"),
            ("m21", t.MATCHES, "durationMs", "long"),
        ]
        # All other rows are there.
        assert rows(tables.read(t.MATCH_PLAYERS), "replay_id", "user_id") == [("m20", 1), ("m20", 2), ("m21", 1)]
        assert rows(tables.read(t.MATCHES), "replay_id") == [("m20",)]


def test_unchanged_documents_are_not_parsed_again(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path / "tables"))
    bots = document("bots", "2025-05-21T10:00:00.000Z", [(None, "b", 0, None, "", "x")])
    write_documents(tmp_path / "inbox", [*docs([20, 21]), bots])
    jobs.ingest_meta(spark, str(tmp_path / "inbox"), tables, LATER)
    parsed = []
    explode = jobs.explode_valid_players

    def counted(replays):
        parsed.append(sorted(r.replay_id for r in replays.select("replay_id").collect()))
        return explode(replays)

    monkeypatch.setattr(jobs, "explode_valid_players", counted)
    as_of = datetime(2025, 5, 22, 12)
    assert jobs.update_match_players(tables, as_of) == 5
    assert jobs.update_match_players(tables, as_of) == 1  # the row whose key is NULL, as ever
    late = docs([21])[0]
    late["AllyTeams"][0]["Players"].append(late["AllyTeams"][0]["Players"][0] | {"userId": "7", "playerId": "7"})
    changed = spark.createDataFrame([("m21", json.dumps(late))], "replay_id string, raw_json string")
    tables.append(t.RAW_ARCHIVE, changed.withColumn("start_time", F.lit("2025-05-21 10:00:00").cast("timestamp")))
    assert jobs.update_match_players(tables, as_of) == 2
    assert parsed == [["bots", "m20", "m21"], ["bots"], ["bots", "m21"]]


def test_daily_means_of_open_days(spark, tmp_path):
    schema = "user_id int, category string, skill float, start_time timestamp"
    tables, start = Tables(spark, str(tmp_path / "tables")), datetime(2024, 1, 1)
    source, data = tmp_path / "in", []
    for n in range(5):  # a batch each, days in mixed order
        batch = [(u, "c", None if (u, n) == (2, 1) else float(u + n), start + timedelta(days=d)) for u in (1, 2) for d in (n % 2, 3)]
        data += batch
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(str(source / f"b={n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source / "*"))
    run_daily_skill(stream, tables, str(tmp_path / "checkpoint"), max_folders=2).awaitTermination()
    want = spark.createDataFrame(data, schema).groupBy("user_id", "category", F.to_date("start_time").alias("day")).agg(F.avg("skill").alias("avg_skill"))
    assert rows(daily_skill(tables)) == rows(want)
    assert len(tables.folders(t.DAILY_PARTS)) <= 3
    again = spark.createDataFrame(data[-4:], schema)  # the last batch comes once more
    add_daily_parts(tables, str(tmp_path / "checkpoint"))(again, 4)
    assert rows(daily_skill(tables)) == rows(want)
