from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from replaystats.llm import divergence as dv
from replaystats.llm.sql import SQL

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, p long"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def table(spark, data):
    """(text, lang, source) rows with columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, *row, "x", 1, 1) for i, row in enumerate(data)], SCHEMA)


def brute(data, min_docs=10, top=10):
    """The contract word by word, over Python integers."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in data:
        terms = TERM.findall((text or "").translate(lower))
        held[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {k[0] for k in held}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: {t: c[t] for t in kept} for (g, s), c in held.items() if g == lang}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}

        def shares(counts, v=len(kept)):
            total = sum(counts.values())
            return {t: 1 + 1_000_000_000 * (n + 2) // (total + 2 * v) for t, n in counts.items()}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s, counts in groups.items():
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if counts[t] > 0 and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, r + 1) for r, (item, value) in enumerate(ranked)]
    return sorted(out)


def corpus(rng, n=600, sources=12):
    words = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"] + ["Ähre", "été", "日本", "I'm", "A-b"]
    data = []
    for _ in range(n):
        s = rng.randrange(sources) if rng.random() > 0.3 else 0  # a hot source
        mine = words[s * 5 : s * 5 + 40]
        text = " ".join(rng.choice(mine) for _ in range(rng.randrange(30)))
        data.append((text, rng.choice(["en", "de", None]), f"s{s}"))
    return data + [(None, "en", "bare"), ("", None, None), ("x" * 50_000, "en", "s1"), ("only once", "fr", "a"), (None, "fr", "b")] + data[:20]


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("sizes", [{}, {"tile": 3, "block_cells": 40}, {"tile": 5, "block_cells": 1}])
def test_against_brute_force(spark, sizes):
    data = corpus(random.Random(7))
    assert rows(dv.audit(table(spark, data), **sizes)) == brute(data)


def test_against_sql(spark, tmp_path):
    path = str(tmp_path / "documents")
    data = corpus(random.Random(8))
    table(spark, data).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    mine = dv.audit(spark.read.parquet(path))
    theirs = con.execute(f"SELECT {', '.join(mine.columns)} FROM ({SQL['op12_divergence']})").fetchall()
    assert rows(mine) == sorted(theirs)


def test_counting_in_small_portions(spark):
    data = corpus(random.Random(9), 200)
    docs = table(spark, data).na.fill("").select("lang", "source", "text")
    few = dv.count_terms(docs, held_terms=7)
    assert rows(few.filter("term is not null")) == rows(dv.count_terms(docs).filter("term is not null"))


def test_quadtrees_price_what_they_do_not_open():
    rng = np.random.default_rng(1)
    n, m, columns = 9, 6, 300
    zero = [rng.integers(1, 1000, k) for k in (n, m)]
    dense = [np.repeat(z[:, None], columns, 1) for z in zero]
    trees = []
    for k, grid in zip((n, m), dense, strict=True):
        r, c = np.unique(rng.integers(0, [k, columns], (60, 2)), axis=0).T
        p = rng.integers(1, 10**9, len(r))
        grid[r, c] = p
        trees.append(dv.QuadTree(r, c, p, 9))
    a, b = dense[0][:, None, :], dense[1][None, :, :]
    want = ((a - b) ** 2 // (a + b)).sum(2)
    for cells in (1 << 20, 1 << 8, 1):
        assert (dv.compare(*trees, *zero, columns, False, cells) == want).all()
    opened = []
    find = dv.QuadTree.find
    dv.QuadTree.find = lambda self, r, c, shift: opened.append(len(r)) or find(self, r, c, shift)
    try:
        dv.compare(*trees, *zero, columns, False)
    finally:
        dv.QuadTree.find = find
    assert opened[-1] < n * m * columns / 2  # most leaves lie in quadrants priced whole


def test_no_kept_terms_and_empty_tables(spark):
    data = [("rare words", "en", s) for s in "abc"]
    assert rows(dv.audit(table(spark, data))) == brute(data)
    assert dv.audit(table(spark, [])).count() == 0
