from __future__ import annotations

import base64
import hashlib
import io
import random
import uuid

import numpy as np
import pytest
import zstandard
from pyspark.sql import types as T

from replaystats.llm import decontaminate, warc
from replaystats.session import CHECKPOINT_DIR
from tests.llm.cases import documents, edges, words

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("first", T.LongType()),
    ]
)


def leak_rows(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, 30, 2000))) for i in range(25)] + [(90, "two words"), (91, ""), (92, None), (None, "an item that has no number")]
    rows = edges()
    planted = set()
    for i in range(100, 160):
        text = words(rng, rng.randint(20, 120), 2000)
        if rng.random() < 0.7:
            item, passage = rng.choice(items[:25])
            own = passage.split()
            for _ in range(rng.randint(0, 3)):  # edited copies
                at = rng.randrange(len(own))
                own[at : at + rng.randint(0, 1)] = words(rng, rng.randint(0, 2), 2000)
            text = text[:9] + [w.upper() + "," for w in own] + text[9:]
            planted.add((i, item))
        rows.append((i, " ".join(text)))
    return rows, items, planted


def test_leaks(spark):
    rows, items, planted = leak_rows(1)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(documents(spark, rows), table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == planted
    # Brute force: every item against every text, by a plain table of cells.
    want = {}
    for ident, text in rows:
        mine = plain(text)
        if len(mine) > 400:
            continue
        for item, passage in items:
            if plain(passage):
                want[ident, item] = best_score(plain(passage), mine)
    for r in got:
        share = r["matched"] / r["item_words"]
        passage = plain(dict(items)[r["item_id"]])
        text = plain(next(t for i, t in rows if i == r["doc_id"]))[r["start"] : r["end"]]
        assert share >= 0.5 and r["item_words"] == len(passage)
        assert best_score(passage, text) == want[r["doc_id"], r["item_id"]]  # the aligned part holds the best alignment
    assert all(score < 30 for pair, score in want.items() if pair not in planted)


SIGNS = ".,;:!?\"'()[]{}#*$%&|<>"


def plain(text):
    return [w for w in (x.strip(SIGNS) for x in (text or "").lower().split()) if w]


def best_score(a, b):
    """Smith-Waterman's best local score, cell by cell."""
    above, best = [0] * (len(b) + 1), 0
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def test_a_passage_of_an_item(spark):
    rng = random.Random(11)
    item = words(rng, 59, 4000)
    texts = {1: item[20:45], 2: item[:12], 3: item[10:16] + ["x"] + item[16:23], 4: item[30:43]}
    rows = [(i, " ".join(words(rng, 40, 4000) + t + words(rng, 40, 4000))) for i, t in texts.items()]
    table = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.find_leaks(documents(spark, rows), table, carry=("lang",)).collect()}
    assert set(got) == {1, 4} and got[1]["run"] == 25 and got[4]["run"] == 13
    assert got[1]["share"] == pytest.approx(25 / 59) and got[1]["lang"] == "en"
    assert (got[1]["start"], got[1]["end"]) == (40, 65)


def test_very_long_items_and_texts(spark):
    rng = random.Random(12)
    item = words(rng, 20_000, 50_000)
    copy = [w if rng.random() > 0.02 else "edited" for w in item]
    rows = [(1, " ".join(words(rng, 500, 50_000) + copy)), (2, " ".join(words(rng, 30_000, 50_000)))]
    table = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    got = decontaminate.find_leaks(documents(spark, rows), table).collect()
    assert [r["doc_id"] for r in got] == [1] and got[0]["share"] > 0.97


def test_alignment_in_parts_is_the_same():
    rng = np.random.default_rng(5)
    for _ in range(60):
        a, b = rng.integers(1, 6, rng.integers(1, 40)), rng.integers(0, 6, rng.integers(1, 60))
        whole = decontaminate.align(a, b)
        assert decontaminate.align(a, b, cells=1) == whole
        assert best_score(a.tolist(), b.tolist()) == best_score(a.tolist(), b[whole[2] : whole[3]].tolist())


def test_blocks_of_items_and_short_items(spark):
    rows, items, _ = leak_rows(2)
    rows.append((700, "here stand two words and no more"))
    table = spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.find_leaks(documents(spark, rows), table).collect()
    parts = decontaminate.find_leaks(documents(spark, rows), table, block_bytes=1500).collect()
    key = lambda r: tuple(r)
    assert sorted(map(key, whole), key=repr) == sorted(map(key, parts), key=repr)
    assert (700, 90) in {(r["doc_id"], r["item_id"]) for r in whole}
    assert decontaminate.find_leaks(documents(spark, []), table).collect() == []
    assert decontaminate.find_leaks(documents(spark, rows), table.limit(0)).collect() == []


def test_alignment():
    align = lambda a, b: decontaminate.align(np.array(a), np.array(b))
    assert align((1, 2, 3), (9, 1, 2, 3, 9)) == (3, 3, 1, 4)
    assert align((1, 2, 3, 4), (1, 2, 7, 3, 4)) == (4, 2, 0, 5)
    assert align((1, 2), (3, 4))[:2] == (0, 0)


def folder(spark):
    return f"{spark.conf.get(CHECKPOINT_DIR)}/warc-{uuid.uuid4().hex}"


@pytest.mark.parametrize("min_bytes,file_bytes", [(0, 16 << 20), (40, 3000)])
def test_round_trip(spark, min_bytes, file_bytes):
    rng = random.Random(5)
    bodies = ["<p>" + " ".join(words(rng, n)) + "</p>" for n in (1, 5, 40, 300, 5000)] + ["", None, "Ünï\r\n\r\nP*M\x18\0"]
    rows = [(i, rng.choice(["http://a.b/ü x\r\ny", None]), rng.choice(bodies), "taken", 1) for i in range(150)]
    rows += [rows[3], (None, "u", bodies[1], "d", 2), (None, None, "alone", "d", 2)]
    where = folder(spark)
    manifest = warc.write(spark.createDataFrame(rows, PAGES), where, min_bytes=min_bytes, file_bytes=file_bytes)
    got = warc.read(manifest, where).collect()
    assert len(got) == len(rows)
    first = {}
    for ident, _, html, *_ in rows:
        if ident is not None:
            first[html or ""] = min(first.get(html or "", ident), ident)
    want = []
    for ident, _, html, *_ in rows:
        raw = (html or "").encode()
        owner = first.get(html or "")
        revisit = len(raw) >= min_bytes and owner is not None and owner != ident
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((ident, len(raw), digest, "revisit" if revisit else "response", owner if revisit else None, None if revisit else raw))
    rows_got = [(r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got]
    assert sorted(rows_got, key=repr) == sorted(want, key=repr)


def test_file_format():
    rng = random.Random(6)
    records = [warc.serialise(warc.Record("response", i, warc.digest32(p), len(p), None, "http://x", p), "2024-01-01T00:00:00Z") for i, p in enumerate(" ".join(words(rng, 200)).encode() for _ in range(60))]
    out = io.BytesIO()
    warc.write_file(out, records)
    raw = out.getvalue()
    assert raw[:4] == b"\x5d\x2a\x4d\x18"
    size = int.from_bytes(raw[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
    plain = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(raw[8 + size :])
    assert plain == records[0]  # each record is a frame of its own
    assert list(warc.read_file(io.BytesIO(raw))) == records
    with pytest.raises(ValueError, match="cut off"):
        list(warc.read_file(io.BytesIO(raw[:-3])))
    with pytest.raises(ValueError, match="digest"):
        warc.parse(records[0][:-10] + b"tampered\r\n")


def test_no_pages(spark):
    where = folder(spark)
    manifest = warc.write(spark.createDataFrame([], PAGES), where)
    assert manifest.collect() == [] and warc.read(manifest, where).collect() == []
