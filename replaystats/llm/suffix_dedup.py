"""Repeated passages by sparse suffix arrays.

Of all word suffixes only those at minimisers are kept: in each passage of ``min_words`` words the
``gram``-word sequence with the lowest hash, so two copies of a passage keep the same suffix, about
one word in thirteen. The kept suffixes are sorted by their first ``gram`` words and neighbours are
compared. Where suffixes of different texts agree, the match is extended left and right: each
passage of ``min_words`` around them is compared in the same way, and overlapping passages join to
spans. The result is exact: all words that lie in a passage of ``min_words`` words that also stands
in another document.

Texts of equal words fold into one before sorting, and such texts are whole spans. Keys are sorted
twice, first with the texts dealt into ``salts`` parts; of a key found in several texts of a part one
goes on to the second sort. So a passage that stands in a third of all documents is split over
tasks, and a run of equal keys is streamed, not held.

Words are maximal runs of non-blanks, A-Z lower-cased. Defined results: null, empty and shorter texts
have no span; passages that repeat only inside one id are not reported; repeated rows of an id count
as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaystats.llm.text import WordHash, mix, pick, small_batches, words_of
from replaystats.session import stage

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Hashes:
    """Hashes of all word sequences of a text, whatever their length, in constant time each."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        back = np.full(n + 1, _INVERSE, np.uint64)
        back[0] = 1
        self.power = np.full(n + 1, _BASE, np.uint64)
        self.power[0] = 1
        np.multiply.accumulate(back, out=back)
        np.multiply.accumulate(self.power, out=self.power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(words) * back[:n], out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        ends = self.sums[k:]
        return mix((ends - self.sums[: len(ends)]) * self.power[: len(ends)])


def chosen(grams: np.ndarray, window: int) -> np.ndarray:
    """For each passage the place of its minimiser: the leftmost lowest of ``window`` grams in a row."""
    return np.lib.stride_tricks.sliding_window_view(grams, window).argmin(1) + np.arange(len(grams) - window + 1)


def digest_of(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())[:12]


def _texts(docs: DataFrame, min_words: int, gram: int) -> DataFrame:
    """(id, row, digest, n, keys) of each text that is long enough. ``keys`` are its kept suffixes, where a task
    meets the words for the first time; copies of them in the same task have none. docs: (id, row, raw)."""
    names = ["id", "row", "digest", "n", "keys"]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, done = WordHash(), set()
        for batch in source:
            keep, digests, sizes, keys, ends = [], [], [], [np.empty(0, np.int64)], [0]
            for i, raw in enumerate(batch.column(2).to_pylist()):
                words = hashes.of(words_of(raw or b""))
                if len(words) < min_words:
                    continue
                digest = digest_of(words)
                keep.append(i)
                digests.append(digest)
                sizes.append(len(words))
                if digest not in done:
                    done.add(digest)
                    grams = Hashes(words).grams(gram)
                    keys.append(np.unique(grams[chosen(grams, min_words - gram + 1)]).view(np.int64))
                    ends.append(ends[-1] + len(keys[-1]))
                else:
                    ends.append(ends[-1])
            rows = pa.array(keep, pa.int64())
            own = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys)))
            ids, places = (batch.column(c).take(rows) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([ids, places, pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), own], names=names)

    return docs.select("id", "row", "raw").mapInArrow(run, "id long, row long, digest binary, n long, keys array<long>")


def _compare(sorted_rows: DataFrame, last: bool) -> DataFrame:
    """Rows with ``other``, a different text of the same key (null: none), from rows sorted by key and
    text. Runs of a key are streamed: of one that goes on, its first and last row are held."""
    names = sorted_rows.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted_rows.schema.fields)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the unfinished run, or its first and last row when those before were given out
        given = 0
        for batch in source:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            key = table.column("key").to_numpy()
            start = int(np.searchsorted(key != key[-1], False)) if key[0] == key[-1] else int(np.flatnonzero(key != key[-1])[-1]) + 1
            if start:
                yield from out(table.slice(0, start), given)
                given = 0
            held = table.slice(start).combine_chunks()
            digests = held.column("digest")
            if len(held) > 2 and digests[0] != digests[-1]:
                yield from out(held, given)
                held, given = pa.concat_tables([held.slice(0, 1), held.slice(len(held) - 1)]), 2
        if held is not None:
            yield from out(held, given)

    def out(table: pa.Table, skip: int) -> Iterator[pa.RecordBatch]:
        key = table.column("key").to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([cut, [len(key)]]))
        digest = table.column("digest").combine_chunks()
        first = digest.take(pa.array(np.repeat(cut, size)))
        final = digest.take(pa.array(np.repeat(cut + size - 1, size)))
        same = pc.equal(digest, first)
        other = pc.if_else(same, final, first)
        alone = pc.equal(first, final)
        other = pc.if_else(alone, pa.scalar(None, pa.binary()), other)
        table = table.append_column("other", other)
        if not last:  # which rows the second sort needs: all alone, and one of each run
            lead = np.zeros(len(key), bool)
            lead[cut] = True
            table = table.append_column("on", pc.or_(alone, pa.array(lead)))
        yield from table.slice(skip).to_batches()

    return sorted_rows.select(*names).mapInArrow(run, f"{kinds}, other binary" + ("" if last else ", on boolean"))


def repeated(rows: DataFrame, salts: int, name: str) -> DataFrame:
    """Rows (key, digest, ...) whose key stands in several texts, with ``other``, one of those."""
    salt = F.pmod(F.xxhash64("digest"), F.lit(salts))
    dealt = rows.repartition("key", salt).sortWithinPartitions("key", "digest")
    # One partition holds several parts of a key: sorted by key and text alone they are one run.
    first = stage(_compare(dealt, last=False), name)
    again = first.filter("on").drop("on", "other").repartition("key").sortWithinPartitions("key", "digest")
    second = _compare(again, last=True).filter("other is not null")
    found = first.filter("other is not null and not on").drop("on")
    # A run's first row goes on; if the second sort finds no other text for it, it keeps its own.
    own = first.filter("on and other is not null").drop("on")
    return found.unionByName(own).unionByName(second).dropDuplicates(rows.columns)


def find_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    gram: int = 26,
    salts: int = 16,
) -> DataFrame:
    """(id, start_word, end_word, n_words, other_id) per maximal run of words that lie in passages of
    ``min_words`` words standing in another document too; ``other_id`` holds one of its passages."""
    small_batches(docs.sparkSession)
    raw = pick(docs, id_col, text_col).toDF("id", "raw")
    raw = raw.select(F.col("id").cast("long"), F.col("raw").cast("binary"))
    # The hash of the text's bytes, made without Python, finds the text of a digest again.
    raw = raw.withColumn("row", F.xxhash64("raw"))
    read = stage(_texts(raw, min_words, gram), "texts")
    texts = read.select("id", "digest", "n").distinct()
    copies = texts.groupBy("digest").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.first("n").alias("n"),
        F.max(F.col("id").isNull()).alias("none"),
    )
    copied = (F.col("low") < F.col("high")) | (F.col("none") & F.col("low").isNotNull())

    suffixes = read.select(F.explode("keys").alias("key"), "digest")
    agreed = repeated(suffixes, salts, "suffixes").select("digest", "key")
    passages = _passages(raw, _wanted(agreed, read), min_words, gram)
    spans = _spans(repeated(passages, salts, "passages"), min_words)
    whole = copies.filter(copied).select("digest", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"), F.col("digest").alias("other"))
    # A copied text is one span; its passages need no row of their own.
    spans = whole.unionByName(spans.join(whole.select("digest"), "digest", "left_anti"))
    others = copies.select(F.col("digest").alias("other"), "low", "high")
    rows = texts.select("id", "digest").join(spans, "digest").join(others, "other")
    return rows.select(
        F.col("id").alias(id_col),
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        (F.col("end") - F.col("start")).alias("n_words"),
        F.when(F.col("low").eqNullSafe(F.col("id")), F.col("high")).otherwise(F.col("low")).alias("other_id"),
    )


def _wanted(agreed: DataFrame, read: DataFrame) -> DataFrame:
    """(digest, keys, home) of the texts with agreed suffixes; ``home`` is one row that holds the text."""
    homes = read.select("digest", F.struct("row", "id").alias("home"))
    both = agreed.unionByName(homes, allowMissingColumns=True)
    gathered = both.groupBy("digest").agg(F.collect_set("key").alias("keys"), F.min("home").alias("home"))
    return gathered.filter(F.size("keys") > 0)


def _passages(docs: DataFrame, wanted: DataFrame, min_words: int, gram: int) -> DataFrame:
    """(key, digest, at): the passages around the agreed suffixes. docs: (id, row, raw). wanted: (digest, keys, home)."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in source:
            keys, digests, places = [], [], []
            for digest, raw, agreed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = hashes.of(words_of(raw))
                if digest_of(words) != digest:  # other bytes of the same hash
                    continue
                every = Hashes(words)
                grams = every.grams(gram)
                own = grams[chosen(grams, min_words - gram + 1)].view(np.int64)
                at = np.flatnonzero(np.isin(own, np.array(agreed, np.int64)))
                keys.append(every.grams(min_words)[at].view(np.int64))
                places.append(at)
                digests += [digest] * len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.empty(0, np.int64), *keys])), pa.array(digests, pa.binary()), pa.array(np.concatenate([np.empty(0, np.int64), *places]))],
                names=["key", "digest", "at"],
            )

    home = F.col("home")
    found = docs.join(wanted, (F.col("row") == home["row"]) & F.col("id").eqNullSafe(home["id"]))
    return found.select("digest", "raw", "keys").mapInArrow(run, "key long, digest binary, at long").distinct()


def _spans(rows: DataFrame, min_words: int) -> DataFrame:
    """Join overlapping passages (digest, at, other) of a text to (digest, start, end, other)."""
    schema = pa.schema([("digest", pa.binary()), ("start", pa.int64()), ("end", pa.int64()), ("other", pa.binary())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in source:
            done = []
            for digest, at, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now and now[0] == digest and at <= now[2]:
                    now[2] = max(now[2], at + min_words)
                else:
                    if now:
                        done.append(now)
                    now = [digest, at, at + min_words, other]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema=schema)
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, now, strict=True))], schema=schema)

    dealt = rows.select("digest", "at", "other").repartition("digest").sortWithinPartitions("digest", "at")
    return dealt.mapInArrow(run, "digest binary, start long, end long, other binary")
