from __future__ import annotations

import gzip
import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from replaystats.operators import aggregates as agg
from replaystats.sources import artifacts, manifest, meta
from replaystats.sources import tables as t
from replaystats.sources.tables import Tables, days_between
from tests.conftest import document, rows, times, write_documents


def test_read_replay_meta(spark, tmp_path):
    inbox = tmp_path / "inbox"
    write_documents(inbox, [document("a", "2025-01-01T10:00:00.000Z", [(1, "n", 0, 1, "[1]", "F")]), document("b", "2025-01-02T10:00:00Z", [])])
    (inbox / "cut.json").write_text('{"id": "c", "startTime": "2025')
    (inbox / "anonymous.json").write_text('{"startTime": "2025-01-01T10:00:00Z"}')
    (inbox / "undated.json").write_text('{"id": "d"}')
    (inbox / "list.json").write_text("[1, 2]")
    (inbox / "other.txt").write_text("x")
    young = inbox / "young.json"
    young.write_text(json.dumps(document("y", "2025-01-01T10:00:00Z", [])))
    now = datetime(2030, 1, 1)
    for file in inbox.iterdir():
        os.utime(file, (now.timestamp() - 3600 * 48,) * 2)
    clock = datetime.fromtimestamp(now.timestamp(), timezone.utc)
    os.utime(young, (now.timestamp() - 4,) * 2)
    good, bad = meta.read_replay_meta(spark, str(inbox), clock)
    shown = good.withColumn("t", F.col("start_time").cast("string"))
    assert rows(shown, "replay_id", "t") == [("a", "2025-01-01 10:00:00"), ("b", "2025-01-02 10:00:00")]
    assert sorted(os.path.basename(r.path) for r in bad.collect()) == ["anonymous.json", "cut.json", "list.json", "undated.json"]
    good, _ = meta.read_replay_meta(spark, str(inbox), clock + timedelta(seconds=1))
    assert rows(good, "replay_id") == [("a",), ("b",), ("y",)]  # exactly 5 s old is settled


def test_seen_ids_and_manifest(spark, tmp_path):
    assert manifest.read_seen_ids(spark, str(tmp_path / "none")).count() == 0
    day = tmp_path / "L2025-01-01Replays"
    day.mkdir()
    (day / "downloaded.jsonl").write_text('{"gameId": "a"}\nnot json\n{"gameId": "b"}\n{"other": 1}\n{"gameId": "a"}\n')
    other = tmp_path / "Lnot-a-day"
    other.mkdir()
    (other / "downloaded.jsonl").write_text('{"gameId": "zzz"}\n')
    assert rows(manifest.read_seen_ids(spark, str(tmp_path))) == [("a",), ("b",)]
    outcomes = times(
        spark.createDataFrame(
            [("c", "2025-01-02 23:59:59", "ok"), ("d", "2025-01-03", "exists"), ("e", "2025-01-03", "fail")],
            "replay_id string, start_time string, status string",
        ),
        "start_time",
    )
    manifest.append_manifest(outcomes, str(tmp_path))
    assert (tmp_path / "folder=L2025-01-02Replays").is_dir()
    assert rows(manifest.read_seen_ids(spark, str(tmp_path))) == [("a",), ("b",), ("c",), ("d",)]
    summary = agg.outcome_summary(outcomes, elapsed_s=2.0).first()
    assert (summary.total, summary.ok, summary.fail, summary.per_second) == (3, 2, 1, 1.5)
    assert agg.outcome_summary(outcomes, elapsed_s=0).first().per_second == 0.0


def test_listing(spark):
    listing = times(
        spark.createDataFrame(
            [
                ("a", "2025-01-01 00:00:00", False, True),
                ("b", "2025-01-02 23:59:59", False, True),
                ("c", "2025-01-03 00:00:00", False, True),
                ("d", "2025-01-02 00:00:00", True, True),
                ("e", "2025-01-02 00:00:00", False, False),
                ("f", "2025-01-02 00:00:00", None, True),
            ],
            "id string, start_time string, has_bots boolean, ended_normally boolean",
        ),
        "start_time",
    )
    kept = meta.listing_filter(listing, "2025-01-01", "2025-01-02")
    assert rows(kept, "id") == [("a",), ("b",)]
    assert rows(meta.listing_page(kept, 2, 1, [F.col("start_time")]), "id") == [("b",)]


def raw(spark, data):
    return times(spark.createDataFrame(data, "replay_id string, start_time string, raw_json string"), "start_time")


def test_tables(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert tables.read(t.RAW_CACHE).count() == 0 and tables.read(t.RAW_ARCHIVE).count() == 0
    tables.append(t.RAW_CACHE, raw(spark, [("a", "2025-01-01", "1")]))
    folders = tables.folders(t.RAW_CACHE)
    held = tables.read(t.RAW_CACHE, folders)
    # Rows that another writer adds meanwhile survive the rewrite of what was read.
    Tables(spark, str(tmp_path)).append(t.RAW_CACHE, raw(spark, [("b", "2025-01-02", "1")]))
    tables.replace(t.RAW_CACHE, held.withColumn("raw_json", F.lit("2")), over=folders)
    assert rows(tables.read(t.RAW_CACHE), "replay_id", "raw_json") == [("a", "2"), ("b", "1")]
    tables.append(t.RAW_ARCHIVE, raw(spark, [("a", "2025-01-01 05:00:00", "1"), ("b", "2025-01-02", "1")]))
    tables.overwrite_days(t.RAW_ARCHIVE, raw(spark, [("c", "2025-01-02", "9")]))
    archive = tables.read(t.RAW_ARCHIVE)
    assert rows(archive, "replay_id") == [("a",), ("c",)]
    pruned = days_between(archive, datetime(2025, 1, 2).date())
    assert rows(pruned, "replay_id") == [("c",)]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(start_date" in plan


def test_vacuum(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.vacuum(t.RAW_CACHE)  # nothing written yet
    for n in range(3):
        tables.replace(t.RAW_CACHE, raw(spark, [("a", "2025-01-01", str(n))]))

    def data_folders():
        return sorted(f.name for f in (tmp_path / t.RAW_CACHE).iterdir())

    tables.vacuum(t.RAW_CACHE)
    assert len(data_folders()) == 3  # retired just now: a reader may still be at work
    tables.vacuum(t.RAW_CACHE, keep=timedelta(seconds=-5))
    assert data_folders() == tables.folders(t.RAW_CACHE)
    assert rows(tables.read(t.RAW_CACHE), "raw_json") == [("2",)]
    log = [f for f in (tmp_path / "_folders" / t.RAW_CACHE).iterdir() if f.name.endswith(".parquet")]
    assert len(log) == 1


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_index_slices_give_back_the_pages(spark, tmp_path, compression):
    pages = spark.createDataFrame([(i, json.dumps({"userId": i, "name": "ü" * (i % 7)}, ensure_ascii=False)) for i in range(40)], "user_id int, json_data string")
    artifacts.write_artifacts(pages, str(tmp_path / "out"), part_bytes=300, compression=compression)
    index = spark.read.json(str(tmp_path / "out" / "index")).collect()
    blobs = {}
    for part in {r.part for r in index}:
        files = [f for f in (tmp_path / "out" / "pages" / f"part={part}").iterdir() if not f.name.startswith(".")]
        assert len(files) == 1
        data = files[0].read_bytes()
        blobs[part] = gzip.decompress(data) if compression == "gzip" else data
    assert len(blobs) > 3
    assert len(index) == 40
    for row in index:
        piece = blobs[row.part][row.offset : row.offset + row.length]
        assert json.loads(piece)["userId"] == row.user_id
    assert sum(r.length for r in index) == sum(map(len, blobs.values()))


def test_read_pages_exact_window(spark):
    pages = spark.createDataFrame(
        [(1, "{}", "2025-01-01", "2025-02-01"), (2, '{"a":1}', "2025-01-01", "2025-02-01"), (3, '{"a":1}', "2025-01-02", "2025-02-01"), (4, None, "2025-01-01", "2025-02-01")],
        "user_id int, json_data string, data_start_date string, data_end_date string",
    ).withColumns({c: F.col(c).cast("date") for c in ("data_start_date", "data_end_date")})
    assert rows(artifacts.read_pages(pages, "2025-01-01", "2025-02-01"), "user_id") == [(2,)]
    assert artifacts.part_count(pages.filter("false")) == 1
