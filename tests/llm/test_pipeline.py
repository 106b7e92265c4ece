"""The pipeline against brute force, stage by stage, and that nothing outside needs the package."""

from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm.cases import words
from tests.llm.test_jaccard_join import brute as brute_groups
from tests.llm.test_line_dedup import brute as brute_lines

ROOT = Path(__file__).parents[2]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(9)
    items = [(i, " ".join(words(rng, 25, 4000))) for i in range(5)]
    shared = "one line that stands in very many of the documents"
    rows, labels = [], []
    for i in range(140):
        text = words(rng, rng.randint(30, 60), 4000)
        toxic = i % 6 == 0
        if toxic:
            text[3:3] = ["vermin", "filth", "scum"]
        if i % 10 == 1:
            text[8:8] = items[i % 5][1].split()
        if i % 9 == 2 and rows:
            text = rows[-1][1].split("\n")[0].split()
            text[5:6] = ["changed"]
        body = " ".join(text) + (f"\n{shared}" if i % 4 == 0 else "")
        rows.append((i, body, "en", f"s{i % 3}", len(body)))
        labels.append((i, 1, int(toxic)))
    rows += [(200, None, "en", "s", 0), (201, "", "en", "s", 0), (3, rows[3][1], "en", "s0", 1)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    whole = pairs(docs)
    clean = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert clean.columns == columns
    assert pairs(clean) == [(i, t) for i, t in whole if "vermin" not in (t or "")]
    lines = corpus_pipeline.drop_lines(spark, clean, sf_dir)
    assert lines.columns == columns
    assert pairs(lines) == sorted(((i, t) for i, t, *_ in brute_lines(pairs(clean))), key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    single = corpus_pipeline.drop_near_copies(spark, lines, sf_dir)
    assert single.columns == columns
    stay = {i for i, _, c in brute_groups(pairs(lines), 5, 80) if i == c}
    assert pairs(single) == sorted({p for p in pairs(lines) if p[0] in stay}, key=repr)
    pure = corpus_pipeline.drop_leaks(spark, single, sf_dir)
    assert pure.columns == columns
    items = [set(r["text"].split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaky = lambda text: any(len(item & set(text.split())) >= 13 for item in items)
    assert pairs(pure) == [(i, t) for i, t in pairs(single) if not leaky(t)] != pairs(single)


def test_run(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    rows = got.collect()
    assert rows and all(r["n_tokens"] == len(r["token_ids"]) for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(rows)


PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


def kept_pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_rows_are_judged_not_ids(spark, tmp_path):
    rng = random.Random(3)
    a, b, x = (" ".join(words(rng, 30, 4000)) for _ in range(3))
    copies = [(1, a), (7, a), (7, b), (None, a), (None, x), (None, None), (7, ""), (7, ""), (7, b)]
    docs = spark.createDataFrame([(*r, "en", f"s{n}", 1) for n, r in enumerate(copies)], PLAIN)
    got = kept_pairs(corpus_pipeline.drop_near_copies(spark, docs, ""))
    assert got == sorted([(1, a), (7, b), (None, x), (None, None), (7, ""), (7, "")], key=repr)

    spark.createDataFrame([(5, a)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leaks = [(None, a), (None, x), (7, a), (7, b), (8, b), (8, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in leaks], PLAIN)
    got = kept_pairs(corpus_pipeline.drop_leaks(spark, docs, str(tmp_path)))
    assert got == sorted([(None, x), (7, b), (8, b), (8, None)], key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_by_row_against_brute_force(spark, seed):
    """Few ids on many texts: of each group of linked rows one stays, the smallest by id and text key."""
    rng = random.Random(seed)
    rows = []
    for _ in range(40):
        text = words(rng, rng.choice((4, 25, 40)), 3000)
        for _ in range(rng.randint(1, 4)):
            rows.append((rng.choice([None, *range(6)]), " ".join([*text, "more"][: len(text) + rng.randint(0, 1)])))
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], PLAIN)
    numbered = [(n, t) for n, (_, t) in enumerate(rows)]
    group = {n: c for n, _, c in brute_groups(numbered, 5, 80)}
    keys = {r["text"]: r["k"] for r in docs.selectExpr("text", "xxhash64(text) as k").collect()}
    best = {}
    for n, (ident, text) in enumerate(rows):
        best.setdefault(group[n], []).append((ident is None, ident or 0, keys[text], text))
    want = sorted(((None if m[0] else m[1], m[3]) for m in map(min, best.values())), key=repr)
    assert kept_pairs(corpus_pipeline.drop_near_copies(spark, docs, "")) == want


def test_the_rest_does_not_need_the_package():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('replaystats.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(q.startswith('op') and q[2].isdigit() for q in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
