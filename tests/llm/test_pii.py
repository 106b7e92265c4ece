from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest

from replaystats.llm import pii
from replaystats.llm.sql import SQL
from tests.llm.cases import documents, edges

# The base patterns as the contract states them.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PIECES = [
    "123-45-6789", " ssn ", "phone ", "(0171) 555-1234", "0171 555 1234", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32",
    " iban ", "a@b.c", "_d@e.f", "4111 1111 1111 1111", "1.2.3.4", "+49 171 5551234", " order ", "\n", " ", "x", "9", "tel", "é", "🙂",
    "999.1.1.1", "001.002.003.004", "4111-1111-1111-1112", "@", ".", "+1", "a@b", "\r", " ",
]


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, sign in enumerate(reversed(digits)):
        value = int(sign) * (1 + place % 2)
        total += value // 10 + value % 10
    return total % 10 == 0


def expected(text: str | None) -> list[tuple[int, int, int, str]]:
    text, out = text or "", []
    for rank, (kind, pattern) in enumerate(STATED.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 12 <= len(d) <= 19 and passes_luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def fuzz(n: int, seed: int = 3):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 30)))) for i in range(n)]


def test_base_spans_are_those_of_the_stated_patterns(spark):
    data = fuzz(4000) + edges()
    got = pii.digest(pii.find_pii(documents(spark, data))).collect()
    want = sorted((i, hashlib.sha256(listed(expected(t)).encode()).hexdigest()) for i, t in data if i is not None)
    assert sorted((r.doc_id, r.base_sha256) for r in got if r.doc_id is not None) == want
    assert len(got) == len(data)
    counted = {(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got}
    for i, t in data[:500]:
        kinds = [s[3] for s in expected(t)]
        assert (i, *(kinds.count(k) for k in STATED)) in counted


def test_all_spans_agree_with_sql(spark, tmp_path):
    path = str(tmp_path / "documents")
    documents(spark, fuzz(3000, 5) + edges()).select("doc_id", "text").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    mine = pii.digest(pii.find_pii(spark.read.parquet(path)))
    columns = ", ".join(mine.columns)
    theirs = con.execute(f"SELECT {columns} FROM ({SQL['op11_pii']})").fetchall()
    assert sorted(map(tuple, mine.collect()), key=repr) == sorted(theirs, key=repr)


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("IBAN DE89 3704 0044 0532 0130 00 BIC X", "iban:5:32"),
        ("IBAN DE88 3704 0044 0532 0130 00 BIC X", ""),  # wrong check digits
        ("xDE89370400440532013000", ""),  # cut out of a longer word
        ("my ssn is 123-45-6789.", "ssn:10:21"),
        ("item 123-45-6789.", ""),  # no word speaks for it
        ("ssn of order 123-45-6789", ""),  # one against it
        ("ssn 000-45-6789", ""),
        ("call 0171 555 1234 now", "tel:5:18"),
        ("call +49 171 555 1234 now", "phone:5:21"),  # the weak kind inside the strong one goes
        ("version 1.2.3.4", "ip:8:15"),  # a strong kind stays, with a lower score
    ],
)
def test_added_kinds(spark, text, spans):
    assert pii.digest(pii.find_pii(documents(spark, [(1, text)]))).first().spans == spans


def test_words_nearby_move_the_score(spark):
    data = [(1, "login from 10.0.0.1"), (2, "see 10.0.0.1"), (3, "version 10.0.0.1")]
    got = {r.doc_id: r.spans[0].score for r in pii.find_pii(documents(spark, data)).collect()}
    assert got == {1: 0.9, 2: 0.6, 3: 0.3}


def test_long_texts_take_linear_time(spark):
    data = [
        (1, "1" * 300_000),
        (2, "a" * 1_000_000),
        (3, "a@b" + ".b" * 200_000),
        (4, "a@b.c " * 20_000),
        (5, "+1" + "(" * 500_000),
        (6, "call 0171 555 1234, a@b.c\n" * 3_000),
    ]
    got = {r.doc_id: r for r in pii.digest(pii.find_pii(documents(spark, data))).collect()}
    assert (got[3].n_email, got[4].n_email, got[6].n_email) == (1, 20_000, 3_000)
    assert got[4].spans.endswith("email:119994:119999")
    assert got[4].base_sha256 == hashlib.sha256(listed(expected(data[3][1])).encode()).hexdigest()
    assert got[6].spans.count("tel:") == 3_000


def test_no_python_and_no_shuffle(spark):
    df = pii.digest(pii.find_pii(documents(spark, edges())))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_empty_table(spark):
    assert pii.digest(pii.find_pii(documents(spark, []))).count() == 0
