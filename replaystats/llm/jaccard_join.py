"""N-gram Jaccard join: size-aware, heavy and light, exact.

Documents with equal shingle sets fold into one class first. Then

* small sets enumerate, for each size a partner may have, all subsets of the size that the two must
  share; sets that meet in a subset link, nothing is left to verify;
* large sets go through inverted lists. A set enters the lists of its rarest shingles only, as many
  as two linked sets cannot both miss. Rarest by the exact number of sets that hold a shingle: most
  shingles stand in one set, have no list, and cost nothing further. The members of a list are chained
  to one of them, chained sets form families, and a family's sets are compared block by block inside
  tasks that return a spanning forest of the links, never the pairs.

The boundary between small and large is the size at which enumerating costs as many rows as the lists
and the verification behind them, computed from the histogram of sizes.

Counting moves every shingle once, packed. A task gathers sets into chunks, sorts a chunk's shingles and
sends each range of hashes to its bucket, as bytes: eight of a hash, ordered so that they compress, and
two for the set's number in the chunk. A bucket counts and answers to each chunk which of its shingles
stand in other sets as well. Buckets and chunks have a fixed size; their number follows the corpus. The
shingles that a sample finds in more than one of ``hot_share`` sets are not sent: they come last in the
order, by hash. The sample decides cost only, since the lists are right for any order that all sets share.

Defined results: null and empty texts have an empty set and link with nothing; repeated rows and
rows of equal text link; repeated ids are taken row by row; a null id never names a component unless
no member has an id (then the component is null); ids that are no numbers raise an error of the cast.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaystats.llm.graph import components
from replaystats.llm.text import WordHash, pick, shingles, small_batches, words_of
from replaystats.session import stage

MAX_SMALL = 20  # largest set that may enumerate its subsets
VERIFY_ROWS = 40  # an entry of an inverted list costs about as much as so many enumerated subsets
CHUNK_SETS, CHUNK_SHINGLES = 1 << 13, 1 << 20
BUCKET_SHINGLES = 1 << 21
SAMPLE_SETS = 1 << 13
BLOCK_DOCS, BLOCK_BYTES = 1024, 16 << 20  # a task holds two blocks: some 300 MB with its work space
_FLUSH = 50_000


@dataclass(frozen=True)
class Rule:
    """Sets link when ``whole * intersection >= part * union``."""

    words: int
    part: int
    whole: int

    def need(self, a: int, b: int) -> int:
        """Shared shingles of linked sets of these sizes."""
        return -(-self.part * (a + b) // (self.part + self.whole))

    def least(self, n: int) -> int:
        return -(-self.part * n // self.whole)

    def most(self, n: int) -> int:
        return self.whole * n // self.part

    def prefix(self, n: int) -> int:
        """So many shingles of a set, first by any fixed order, hold one that each linked set has among its own first ones."""
        return n - self.least(n) + 1

    def subsets(self, n: int, limit: int) -> Iterator[tuple[int, int]]:
        """(partner's size, shared size) for partners up to ``limit``."""
        for m in range(max(1, self.least(n)), min(self.most(n), limit) + 1):
            yield m, self.need(n, m)


def boundary(rule: Rule, sizes: dict[int, int]) -> int:
    """The cheapest largest small size, given how many sets have each size up to MAX_SMALL."""

    def cost(limit: int) -> int:
        total = 0
        for n, count in sizes.items():
            if n <= limit:
                total += count * sum(math.comb(n, k) for _, k in rule.subsets(n, limit))
            if rule.most(n) > limit:
                total += count * rule.prefix(n) * VERIFY_ROWS
        return total

    return min(range(MAX_SMALL + 1), key=lambda limit: (cost(limit), limit))


def _digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())[:12]


def _sets(batch: pa.RecordBatch, hashes: WordHash, rule: Rule, column: int) -> Iterator[np.ndarray]:
    for raw in batch.column(column).to_pylist():
        yield shingles(hashes.of(words_of(raw or b"")), rule.words)


def set_table(docs: DataFrame, rule: Rule) -> DataFrame:
    """(id, text_key, n, digest, small) per document, with the shingles of small sets. docs: (id, text_key, raw)."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in source:
            sizes, digests, small = [], [], []
            for found in _sets(batch, hashes, rule, 2):
                sizes.append(len(found))
                digests.append(_digest(found) if len(found) else None)
                small.append(found.view(np.int64) if 0 < len(found) <= MAX_SMALL else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(small, pa.list_(pa.int64())),
                ],
                names=["id", "text_key", "n", "digest", "small"],
            )

    return docs.mapInArrow(run, "id long, text_key long, n long, digest binary, small array<long>")


def small_links(classes: DataFrame, rule: Rule, limit: int) -> DataFrame:
    """Edges between small sets that share a subset of the size they need. classes: (digest, n, small)."""
    schema = pa.schema([("key", pa.binary()), ("digest", pa.binary()), ("n", pa.int64()), ("even", pa.bool_())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in source:
            for row in batch.to_pylist():
                n = row["n"]
                for partner, shared in rule.subsets(n, limit):
                    sizes = bytes(sorted((n, partner)))
                    for subset in itertools.combinations(sorted(row["small"]), shared):
                        key = xxhash.xxh3_128_digest(sizes + np.array(subset, np.int64).tobytes())
                        rows.append((key, row["digest"], n, partner == n))
                        if len(rows) >= _FLUSH:
                            yield pa.RecordBatch.from_arrays(_columns(rows, schema), schema=schema)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_arrays(_columns(rows, schema), schema=schema)

    small = classes.filter((F.col("n") > 0) & (F.col("n") <= limit)).select("digest", "n", "small")
    keyed = stage(small.mapInArrow(run, "key binary, digest binary, n long, even boolean"), "subsets")
    met = (
        keyed.groupBy("key")
        .agg(F.min("digest").alias("low"), F.max("digest").alias("high"), F.min("n").alias("n1"), F.max("n").alias("n2"), F.first("even").alias("even"))
        .filter(F.col("even") & (F.col("low") < F.col("high")) | (F.col("n1") < F.col("n2")))
    )
    return keyed.join(met.select("key", "low"), "key").select(F.col("digest").alias("a"), F.col("low").alias("b"))


def _columns(rows: list[tuple], schema: pa.Schema) -> list[pa.Array]:
    return [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]


def _packed(values: np.ndarray) -> bytes:
    """Sorted numbers by planes of their bytes: the upper planes of neighbours are equal and compress."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def hot_shingles(docs: DataFrame, rule: Rule, sets: int, hot_share: int) -> np.ndarray:
    """Sorted shingles that stand in more than one of ``hot_share`` sets of a sample of about SAMPLE_SETS
    documents: at most ``hot_share`` times the shingles of an average sampled document."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in source:
            for found in _sets(batch, hashes, rule, 0):
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["shingle"])

    part = max(1, sets // SAMPLE_SETS)
    sample = docs.filter(F.pmod("text_key", F.lit(part)) == 0).select("raw").dropDuplicates(["raw"])
    counts = sample.mapInArrow(run, "shingle long").groupBy("shingle").count()
    least = max(32, min(sets, SAMPLE_SETS) // hot_share)
    found = [r["shingle"] for r in counts.filter(F.col("count") > least).select("shingle").toLocalIterator()]
    return np.sort(np.array(found, np.int64).view(np.uint64))


# A bucket's part of a chunk, or, with a negative bucket, the head of a chunk.
_CHUNKS = "bucket int, chunk long, hashes binary, docs binary, sizes binary, digests binary"
# What a bucket answers to a chunk, or the head of the chunk.
_ANSWERS = "chunk long, hashes binary, docs binary, counts binary, sizes binary, digests binary"


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns, strict=True)})


def chunks(docs: DataFrame, rule: Rule, limit: int, hot: np.ndarray, bits: int) -> DataFrame:
    """The shingles of large sets by bucket, the upper ``bits`` of their hash, and chunk. docs: (raw)."""
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, done = WordHash(), sent.value, set()
        first, number = TaskContext.get().partitionId() << 32, 0
        held: list[np.ndarray] = []
        digests: list[bytes] = []
        weight = 0

        def close() -> list[tuple]:
            chunk = first + number
            docs = np.repeat(np.arange(len(held), dtype=np.uint16), [len(x) for x in held])
            every = np.concatenate(held)
            common = np.isin(every, last) if len(last) else np.zeros(len(every), bool)
            sizes = np.array([len(x) for x in held], np.int64).tobytes()
            rows = [(-1 - chunk % 64, chunk, every[common].tobytes(), docs[common].tobytes(), sizes, b"".join(digests))]
            every, docs = every[~common], docs[~common]
            order = np.argsort(every, kind="stable")
            every, docs = every[order], docs[order]
            buckets = (every >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(every), np.int64)
            cuts = np.searchsorted(buckets, np.arange((1 << bits) + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                a, b = cuts[k], cuts[k + 1]
                rows.append((int(k), chunk, _packed(every[a:b]), docs[a:b].tobytes(), None, None))
            return rows

        for batch in source:
            for found in _sets(batch, hashes, rule, 0):
                if not len(found) or rule.most(len(found)) <= limit:
                    continue
                digest = _digest(found)
                if digest in done:  # a copy in the same task
                    continue
                done.add(digest)
                held.append(found)
                digests.append(digest)
                weight += len(found)
                if len(held) == CHUNK_SETS or weight >= CHUNK_SHINGLES:
                    yield from _table(_CHUNKS, close()).to_batches()
                    held, digests, weight, number = [], [], 0, number + 1
        if held:
            yield from _table(_CHUNKS, close()).to_batches()

    return docs.select("raw").mapInArrow(run, _CHUNKS)


def count_bucket(table: pa.Table) -> pa.Table:
    """For each chunk its shingles that stand in several sets, with the number of sets."""
    rows = table.to_pylist()
    if rows[0]["bucket"] < 0:
        return _table(_ANSWERS, [(r["chunk"], r["hashes"], r["docs"], None, r["sizes"], r["digests"]) for r in rows])
    parts = [_unpacked(r["hashes"]) for r in rows]
    every = np.concatenate(parts)
    _, place, seen = np.unique(every, return_inverse=True, return_counts=True)
    counts = seen[place]
    out, start = [], 0
    for r, part in zip(rows, parts, strict=True):
        own = counts[start : start + len(part)]
        start += len(part)
        keep = own > 1
        if keep.any():
            docs = np.frombuffer(r["docs"], np.uint16)[keep]
            out.append((r["chunk"], _packed(part[keep]), docs.tobytes(), own[keep].astype(np.uint32).tobytes(), None, None))
    return _table(_ANSWERS, out)


CANDIDATES = "digest binary, n long, keys array<long>, found array<long>"


def close_chunk(table: pa.Table, rule: Rule) -> pa.Table:
    """(digest, n, keys, found) of the sets that enter a list: the lists, and all shingles that the set
    may have in common with others."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["digests"] is not None)
    answers = [r for r in rows if r["digests"] is None]
    digests = [head["digests"][i : i + 12] for i in range(0, len(head["digests"]), 12)]
    sizes = np.frombuffer(head["sizes"], np.int64)
    docs = np.concatenate([np.frombuffer(r["docs"], np.uint16) for r in answers] + [np.empty(0, np.uint16)])
    hashes = np.concatenate([_unpacked(r["hashes"]) for r in answers] + [np.empty(0, np.uint64)])
    counts = np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in answers] + [np.empty(0, np.uint32)]).astype(np.int64)
    # The hot ones come after all others.
    docs = np.concatenate([docs, np.frombuffer(head["docs"], np.uint16)]).astype(np.int64)
    last = np.frombuffer(head["hashes"], np.uint64)
    hashes = np.concatenate([hashes, last])
    counts = np.concatenate([counts, np.full(len(last), np.iinfo(np.int64).max)])
    order = np.lexsort((hashes, counts, docs))
    hashes = hashes[order].view(np.int64)
    bounds = np.searchsorted(docs[order], np.arange(len(sizes) + 1))
    out: dict[str, list] = {"digest": [], "n": [], "keys": [], "found": []}
    for i in np.flatnonzero(np.diff(bounds)):
        n = int(sizes[i])
        found = hashes[bounds[i] : bounds[i + 1]]
        take = rule.prefix(n) - (n - len(found))  # shingles of this set alone come first and need no list
        if take > 0:
            for name, value in zip(out, (digests[i], n, found[:take], found), strict=True):
                out[name].append(value)
    numbers = pa.list_(pa.int64())
    return pa.table(
        {
            "digest": pa.array(out["digest"], pa.binary()),
            "n": pa.array(out["n"], pa.int64()),
            "keys": pa.array(out["keys"], numbers),
            "found": pa.array(out["found"], numbers),
        }
    )


def list_entries(docs: DataFrame, rule: Rule, limit: int, sets: int, shingles_in_all: int, hot_share: int) -> DataFrame:
    """(digest, n, keys, found) of all sets that enter a list, staged; copies from several tasks stay once."""
    hot = hot_shingles(docs, rule, sets, hot_share)
    bits = max(0, (shingles_in_all // BUCKET_SHINGLES).bit_length())
    answers = chunks(docs, rule, limit, hot, bits).groupBy("bucket").applyInArrow(count_bucket, _ANSWERS)
    found = answers.groupBy("chunk").applyInArrow(lambda t: close_chunk(t, rule), CANDIDATES)
    return stage(found.dropDuplicates(["digest"]), "entries")


def list_chains(entered: DataFrame) -> DataFrame:
    """Edges (a, b) from each member of a list to its first one."""
    members = entered.select("digest", F.explode("keys").alias("key"))
    lists = members.groupBy("key").agg(F.min("digest").alias("low"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    chained = members.join(lists, "key").filter("digest <> low")
    return chained.select(F.col("digest").alias("a"), F.col("low").alias("b")).distinct()


def block_links(table: pa.Table, rule: Rule) -> pa.Table:
    """A spanning forest of the links among the sets of one or two blocks of a family."""
    digests = table.column("digest").to_pylist()
    lists = table.column("found").combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = table.column("n").to_numpy().astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(digests)), lengths)
    _, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.cumsum(seen > 1) - 1
    keep = seen[column] > 1
    owner, column = owner[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(digests), len(digests)), np.float32)
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((len(digests), width), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    linked = rule.whole * both >= rule.part * union
    left, edges = np.ones(len(digests), bool), []
    while left.any():
        root = int(left.argmax())
        group = np.zeros(len(digests), bool)
        group[root] = True
        front = group
        while front.any():
            reached = linked[front].any(0) & ~group
            group = group | reached
            front = reached
        left &= ~group
        edges += [(digests[i], digests[root]) for i in np.flatnonzero(group) if digests[i] != digests[root]]
    return pa.table({"a": pa.array([e[0] for e in edges], pa.binary()), "b": pa.array([e[1] for e in edges], pa.binary())})


def plan_families(chains: DataFrame, entered: DataFrame) -> DataFrame:
    """(digest, component, blocks): the families that the lists make, and in how many blocks each is compared."""
    families = components(chains).withColumnRenamed("node", "digest").join(entered.select("digest", F.size("found").alias("held")), "digest")
    sizes = families.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("held") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    return stage(families.join(sizes, "component").select("digest", "component", "blocks"), "families")


def family_links(planned: DataFrame, entered: DataFrame, rule: Rule) -> DataFrame:
    """Links inside the families, block by block. The shingles move only to their blocks."""
    own = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    dealt = (
        entered.select("digest", "n", "found")
        .join(planned, "digest")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "digest", "n", "found")
    )
    return dealt.groupBy("component", "i", "j").applyInArrow(lambda t: block_links(t, rule), "a binary, b binary")


def link(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    part: int = 85,
    whole: int = 100,
    hot_share: int = 256,
) -> DataFrame:
    """(id, n_shingles, component_id, text_key, component) per input row. Texts link when
    ``whole * intersection >= part * union`` of their ``words``-word shingles. A component is named by the
    smallest id in it; since an id may stand on several texts, ``text_key``, the xxhash64 of the text, tells
    rows apart, and ``component``, null without words, tells components apart."""
    small_batches(docs.sparkSession)
    rule = Rule(words, part, whole)
    raw = pick(docs, id_col, text_col).toDF("id", "raw")
    raw = raw.select(F.col("id").cast("long"), F.xxhash64("raw").alias("text_key"), F.col("raw").cast("binary"))
    sets = stage(set_table(raw, rule), "sets")
    classes = sets.filter("n > 0").groupBy("digest").agg(F.first("n").alias("n"), F.first("small").alias("small"))
    classes = stage(classes, "classes")
    totals = classes.agg(F.count(F.lit(1)).alias("sets"), F.coalesce(F.sum("n"), F.lit(0)).alias("shingles")).first()
    histogram = classes.filter(F.col("n") <= MAX_SMALL).groupBy("n").count().collect()  # MAX_SMALL rows at most
    limit = boundary(rule, {r["n"]: r["count"] for r in histogram})
    entered = list_entries(raw, rule, limit, totals["sets"], totals["shingles"], hot_share)
    planned = plan_families(list_chains(entered), entered)
    edges = family_links(planned, entered, rule).unionByName(small_links(classes, rule, limit))
    joined = components(edges)
    rows = sets.join(joined.withColumnRenamed("node", "digest"), "digest", "left")
    rows = stage(rows.select("id", "text_key", "n", F.coalesce("component", "digest").alias("component")), "members")
    names = rows.groupBy("component").agg(F.min("id").alias("low"))
    named = rows.join(names.filter("component is not null").withColumnRenamed("component", "own"), F.col("component") == F.col("own"), "left")
    return named.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("low", "id").alias("component_id"),
        "text_key",
        "component",
    )
