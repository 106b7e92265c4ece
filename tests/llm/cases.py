"""Small inputs that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("score", T.StringType()),
        T.StructField("digest", T.StringType()),
    ]
)


def documents(spark, rows):
    """Documents with columns whose names clash with those that operators make."""
    return spark.createDataFrame([(i, t, "en", 1, "x", "y") for i, t in rows], DOCS)


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edges() -> list[tuple]:
    """Null id, null and empty text, blanks only, repeated rows, one word, a very long text."""
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (4, "one"),
        (None, "no id here at all"),
        (None, None),
        (5, "word " * 30_000),
        (6, "Ünïcode ÄÖ   x y 🙂\r\nline"),
    ]
