from __future__ import annotations

import base64
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from replaystats.llm import bpe
from replaystats.llm.queries import RANKS
from tests.llm.cases import documents, edges


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBpe(bpe.read_ranks(RANKS), P.PATTERN)


@pytest.fixture(scope="module")
def oracle():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab'sTtre  \n\t\x1c\x85 é漢1²½🙂́"), st.characters(codec="utf-8")), max_size=80))
def test_as_tiktoken(coder, oracle, text):
    (ids,) = coder.encode_all([text])
    assert ids.tolist() == oracle.encode_ordinary(text)
    assert coder.decode_flat(ids.astype(int), bpe.np.array([len(ids)]))[0].tobytes() == text.encode()


def test_long_pieces(coder, oracle):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (31, 32, 33, 64, 5000)] + ["a" * 4000, " " * 999]
    assert [ids.tolist() for ids in coder.encode_all(texts)] == [oracle.encode_ordinary(t) for t in texts]


def test_one_tree_as_many(coder):
    rng = random.Random(2)
    raws = [bytes(rng.randrange(256) for _ in range(rng.randint(2, 16))) for _ in range(300)]
    assert [bpe.np.frombuffer(ids, "<i4").tolist() for ids in coder.merge_many(raws, 16)] == [coder.merge_one(r) for r in raws]


def test_rows(spark, oracle):
    rows = edges()
    df = documents(spark, rows).withColumn("token_ids", F.lit("taken"))
    back = bpe.decode(bpe.encode(df, "text", RANKS, P.PATTERN), "token_ids", RANKS, P.PATTERN).collect()
    assert len(back) == len(rows)
    for row in back:
        assert row["token_ids"] == oracle.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()


def test_empty_and_bad(spark):
    empty = documents(spark, [])
    assert bpe.decode(bpe.encode(empty, "text", RANKS, P.PATTERN), "token_ids", RANKS, P.PATTERN).count() == 0
    ids = spark.createDataFrame([([1, 2],), (None,), ([],)], "ids array<int>")
    got = [r["decoded"] for r in bpe.decode(ids, "ids", RANKS, P.PATTERN).collect()]
    assert got[1] is None and bytes(got[2]) == b"" and len(got[0]) == 2
    wrong = spark.createDataFrame([([10**7],)], "ids array<int>")
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(wrong, "ids", RANKS, P.PATTERN).collect()


def test_round_trip_is_encode_and_decode(spark):
    docs = documents(spark, [*edges(), (70, "über 12,345 words\tand  blanks "), (71, "x" * 5000)])
    docs = docs.withColumnRenamed("digest", "decoded")  # a column of that name is replaced
    got = bpe.round_trip(docs, "text", RANKS, P.PATTERN)
    key = lambda r: (r["doc_id"], r["text"], tuple(r["token_ids"]), bytes(r["decoded"]))
    both = bpe.decode(bpe.encode(docs.drop("decoded"), "text", RANKS, P.PATTERN, "again"), "again", RANKS, P.PATTERN, "decoded")
    assert sorted(map(key, got.collect()), key=repr) == sorted(
        ((r["doc_id"], r["text"], tuple(r["again"]), bytes(r["decoded"])) for r in both.collect()), key=repr
    )
    assert got.columns.count("decoded") == 1
