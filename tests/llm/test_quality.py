from __future__ import annotations

import random
import re
from collections import Counter

from replaystats.llm.quality import BOILERPLATE, rate
from tests.llm.cases import documents, edges

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {p for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] >= 2 for p in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base(spark):
    rng = random.Random(3)
    rows = edges() + [
        (100 + i, "".join(rng.choice(["a", "bb", "#c", "d|e", "f"]) + rng.choice([" ", "  ", "\n", "\t", " "]) for _ in range(rng.randint(0, 90))))
        for i in range(80)
    ]
    got = sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in rate(documents(spark, rows)).collect()), key=repr)
    assert got == sorted(((i, *base(t)) for i, t in rows), key=repr)


def test_verdict(spark):
    rng = random.Random(4)
    prose = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(12)) + "." for _ in range(20)]
    menu = ["Home | About | News | Contact | Login"] * 3
    junk = ["#### **** %%%% $$$$ &&&& |||| <<<< >>>> 123 456 789 ***** ##### $$$$$"] * 30
    rows = [(1, "\n".join(prose)), (2, "\n".join(menu[:1] + prose)), (3, "\n".join(prose + [f"{x} {i}" for i, x in enumerate(junk)])), (4, f"{BOILERPLATE[0]}\n" + "\n".join(prose))]
    got = {r["doc_id"]: r for r in rate(documents(spark, rows)).collect()}
    assert got[1]["kept"] and got[1]["n_bad_lines"] == 0 and got[1]["text"] == rows[0][1]
    assert got[2]["kept"] and got[2]["n_bad_lines"] == 1 and got[2]["text"] == rows[0][1]
    assert not got[3]["kept"] and got[3]["n_bad_lines"] == 30
    assert got[4]["text"] == rows[0][1]


def test_empty_and_native(spark):
    df = rate(documents(spark, []))
    assert df.collect() == []
    assert not re.search("Python|Pandas|Arrow|Exchange", df._jdf.queryExecution().executedPlan().toString())


def test_long_texts_count_exactly(spark):
    """The hashes of these windows agree in their upper 45 bits, all that a text of 300,000 words once had."""
    pairs = [(1856933, 18656082), (2899376, 13731284), (926426, 5462398), (545384, 17602364)]
    filler = (f"w{i}" for i in range(300_000))
    text = []
    for a in (i for pair in pairs for i in pair):
        text += [*(next(filler) for _ in range(30_000)), f"x{a}", "y", "z"]
    text += filler
    got = rate(documents(spark, [(1, " ".join(text)), (2, " ".join([*text, *text[:10]]))])).collect()
    assert {r["doc_id"]: r["n_repeat_words"] for r in got} == {1: 0, 2: 20}
