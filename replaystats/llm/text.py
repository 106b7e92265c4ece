"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space and capitals of the operators' contracts.
BLANKS = " \t\n\x0b\f\r"
BLANKS_PATTERN = r"[ \t-\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows: a row may be a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact name; others may repeat a name or differ only in case."""
    where = [df.columns.index(n) for n in names]
    flat = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return flat.select(*(flat[f"_{i}"].alias(n) for i, n in zip(where, names, strict=True)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value computed once; a plain reference inside a lambda is evaluated per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(raw: bytes) -> list[bytes]:
    """ASCII-lower-cased words between ASCII white space: bytes methods know no other case or blank."""
    return raw.lower().split()


class WordHash(dict):
    """64-bit hash of a word, remembered for at most ``limit`` words."""

    limit = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of the k-word shingles, sorted; a shorter text is one shingle, no word none."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    width = min(k, n)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        out = mix(out * _MIX + hashes[i : n - width + 1 + i])
    return np.unique(out)


def batches(rows: Iterator, size: int, weight: Callable = lambda _: 1) -> Iterator[list]:
    """Lists of rows whose weights sum to ``size`` or one row more."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += weight(row)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held
