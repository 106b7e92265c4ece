from __future__ import annotations

import random
import re

import duckdb
import pytest

from replaystats.llm import jaccard_join
from replaystats.llm.graph import components
from replaystats.llm.sql import SQL
from tests.llm.cases import documents, edges, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, k=4, part=85, whole=100):
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and whole * len(sets[i] & sets[j]) >= part * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            low[root(i)] = min(low.get(root(i), ident), ident)
    return sorted(((ident, len(s), low.get(root(i)) if s else ident) for i, ((ident, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def corpus(seed, n, lengths, copies, edit):
    rng = random.Random(seed)
    rows = []
    while len(rows) < n:
        text = words(rng, rng.choice(lengths), 3000)
        for _ in range(rng.randint(1, copies)):
            own = list(text)
            for _ in range(rng.randint(0, edit)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(40)}"
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    return rows


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_small_sets(spark):
    rows = corpus(1, 250, range(1, 26), 12, 1)
    assert got(jaccard_join.link(documents(spark, rows))) == brute(rows)


@pytest.mark.parametrize("hot_share", [256, 100_000, 2])
def test_large_sets(spark, hot_share, monkeypatch):
    if hot_share == 100_000:  # small chunks and buckets
        monkeypatch.setattr(jaccard_join, "CHUNK_SETS", 3)
        monkeypatch.setattr(jaccard_join, "BUCKET_SHINGLES", 500)
    rows = corpus(2, 160, (20, 60, 150, 155), 40, 3) + edges()
    assert got(jaccard_join.link(documents(spark, rows), hot_share=hot_share)) == brute(rows)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 8)
    rows = corpus(3, 90, (90,), 60, 4)
    assert got(jaccard_join.link(documents(spark, rows), words=5, part=80)) == brute(rows, 5, 80)


def test_hot_shingles_come_last(spark, monkeypatch):
    """A passage in every text and one in a third of them: hot shingles, and still the same links."""
    monkeypatch.setattr(jaccard_join, "SAMPLE_SETS", 200)
    rng = random.Random(6)
    passage, other = words(rng, 30, 4000), words(rng, 60, 4000)
    rows = [(i, " ".join(words(rng, 40, 4000) + passage + other * (i % 3 == 0))) for i in range(120)]
    rows += [(200 + i, " ".join([*passage, *other, *words(rng, i % 5, 50)])) for i in range(40)]
    raw = documents(spark, rows).selectExpr("doc_id as id", "xxhash64(text) as text_key", "cast(text as binary) as raw")
    rule = jaccard_join.Rule(4, 85, 100)
    hot = jaccard_join.hot_shingles(raw, rule, len(rows), 4)
    common = set.intersection(*({*jaccard_join.shingles(jaccard_join.WordHash().of(jaccard_join.words_of(t.encode())), 4)} for _, t in rows))
    assert common and common <= set(hot) and len(hot) < 200
    assert got(jaccard_join.link(documents(spark, rows), hot_share=4)) == brute(rows)


def test_lists_do_not_grow_with_common_shingles(spark):
    """Unrelated texts that share a passage have lists only for what makes them alike."""
    rng = random.Random(7)
    passage = words(rng, 12, 4000)
    rows = [(i, " ".join(words(rng, 100, 10**6) + passage)) for i in range(200)]
    rows += [(500 + i, t) for i, (_, t) in enumerate(rows[:5])] + [(600 + i, t + " more") for i, (_, t) in enumerate(rows[:5])]
    raw = documents(spark, rows).selectExpr("doc_id as id", "xxhash64(text) as text_key", "cast(text as binary) as raw")
    rule = jaccard_join.Rule(4, 85, 100)
    entered = jaccard_join.list_entries(raw, rule, 0, 205, 25_000, 256).collect()
    assert len(entered) == 10  # the five pairs alone
    assert got(jaccard_join.link(documents(spark, rows))) == brute(rows)


def test_against_sql(spark, tmp_path):
    path = str(tmp_path / "documents")
    rows = corpus(8, 60, (3, 8, 20, 60), 12, 2) + [r for r in edges() if r[0] is not None and r[0] != 5]
    documents(spark, rows).select("doc_id", "text").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(con.execute(SQL["op4_jaccard_join"]).fetchall(), key=repr) == got(jaccard_join.link(spark.read.parquet(path)))


def test_empty(spark):
    assert jaccard_join.link(documents(spark, [])).collect() == []


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 150)] + [(7, 7), (150, 100)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 151)} == {100}


def test_boundary_follows_cost():
    rule = jaccard_join.Rule(4, 85, 100)
    assert jaccard_join.boundary(rule, {}) == 0
    assert 0 < jaccard_join.boundary(rule, dict.fromkeys(range(1, 21), 100)) <= jaccard_join.MAX_SMALL
    for a in range(1, 60):
        for b in range(a, 60):
            for i in range(a + 1):
                assert (100 * i >= 85 * (a + b - i)) == (i >= rule.need(a, b)), (a, b, i)
