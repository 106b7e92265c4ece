from __future__ import annotations

import random
import re
from collections import defaultdict
from pathlib import Path

from replaystats.llm.line_dedup import dedup_lines
from replaystats.session import staging_root
from tests.llm.cases import documents, edges

BLANKS = " \t\n\x0b\f\r"


def brute(rows, min_chars=20, min_docs=3):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(BLANKS).translate(lower)
    holders = defaultdict(set)
    for ident, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(ident)
    out = []
    for ident, text in rows:
        lines = (text or "").split("\n")
        keep = []
        for line in lines:
            k = key(line)
            ids = [i for i in holders[k] if i is not None]
            gone = len(k) >= min_chars and len(holders[k]) >= min_docs and ident != (max(ids) if ids else None)
            if not gone:
                keep.append(line)
        out.append((ident, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


def test_random(spark):
    rng = random.Random(5)
    pool = [f"A shared line number {i} of some length" for i in range(12)] + ["short", "", "  ", "ÄLine with Umlauts of length"]
    rows = [
        (i, "\n".join(rng.choice([" ", "", "\t"]) + rng.choice([str.upper, str.lower, str])(rng.choice(pool)) for _ in range(rng.randint(0, 9))))
        for i in range(60)
    ]
    assert got(dedup_lines(documents(spark, rows), batches=5)) == brute(rows)


def test_edges(spark):
    line = "this line stands in many of the documents"
    rows = edges() + [(i, f"{line}\nown {i}\n{line.upper()} ") for i in (7, 8, 8, 9)] + [(None, line), (10, "\n".join([line] * 3000))]
    assert got(dedup_lines(documents(spark, rows))) == brute(rows)
    nulls = [(None, line), (None, line)]
    assert got(dedup_lines(documents(spark, nulls))) == brute(nulls)


def test_empty(spark):
    assert dedup_lines(documents(spark, [])).collect() == []


def test_stays_in_spark(spark):
    plan = dedup_lines(documents(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_ids_at_the_ends_of_a_long(spark):
    line = "a line that stands in all of these documents"
    ids = [-(1 << 63), 0, (1 << 63) - 1, 5, 6, None, 5]
    rows = [(i, f"{line}\nown {n}") for n, i in enumerate(ids)]
    got = dedup_lines(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_dropped"]) for r in got) == sorted(
        (i is None, i or 0, int(i != (1 << 63) - 1)) for i in ids
    )
    left = {p.name for p in Path(staging_root(spark)).glob("line_run_*")}
    assert not left and not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]
