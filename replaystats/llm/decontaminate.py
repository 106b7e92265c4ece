"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Each test item gives seeds: in every ``spread`` consecutive n-grams of it, the one that is rarest in
the training corpus. So any ``spread + n - 1`` unedited words hold a seed, common n-grams are seldom
seeds, and none is barred for being frequent: a passage copied into a third of all documents is
found like any other. A document that holds a seed is aligned with the item around it, and reported
if the aligned words match at least ``min_share`` of the item, or ``min_run`` words in a row do.

The test items are the stated query set. They are taken in blocks of at most ``block_bytes`` of text,
so what a task holds of them is bounded, and a block meets all documents as two maps (counting its
n-grams, then aligning): no text is shuffled. A map looks up the words and n-grams of a whole batch
of documents at once in sorted arrays. A document lies in one task as one row in any case; an alignment
keeps some rows of its cells and computes those between them again, so that an item of any length fits.

Words are maximal runs of non-blanks, A-Z lower-cased, without signs at their ends. Defined results:
null and empty texts and items without a word match nothing; items shorter than ``n`` words are
sought whole, as one exact run of words; repeated rows give repeated results; items of null id are
reported with that id; ids that are no numbers raise an error of the cast to long.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replaystats.llm.text import pick, small_batches, words_of
from replaystats.session import stage

# Signs that are no part of a word at its ends, and the scores of an alignment.
SIGNS = ".,;:!?\"'()[]{}#*$%&|<>"
MATCH, MISMATCH, GAP = 2, -1, -1

CELLS = 1 << 22  # cells of an alignment that are held at once
REMEMBERED_BYTES = 64 << 20


def plain_words(raw: bytes) -> list[bytes]:
    return [w for w in (x.strip(SIGNS.encode()) for x in words_of(raw)) if w]


def numbered(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, bounds) of a batch: the words of all texts one after another as places in the vocabulary
    from 1, 0 for a foreign word, and where each text begins and ends in them."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = pc.ascii_trim(split.flatten(), characters=SIGNS)
    real = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    numbers = pc.add(pc.index_in(words, value_set=vocabulary), 1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(real)])
    offsets = split.offsets.to_numpy()
    return numbers[real], before[offsets - offsets[0]]


class Grams:
    """Word n-grams of one width, found in sorted arrays: a gram is its first words' place and a word."""

    def __init__(self, grams: list[tuple[int, ...]], base: int):
        self.base, self.width = base, len(grams[0])
        rows = np.array(grams, np.int64).reshape(len(grams), self.width)
        code = rows[:, 0]
        self.levels = []
        for k in range(1, self.width):
            level, code = np.unique(code * base + rows[:, k], return_inverse=True)
            self.levels.append(level)
        # place of a gram's code -> its number in ``grams``
        self.number = np.full(max(int(code.max()), 0) + 1, -1)
        self.number[code] = np.arange(len(grams))

    def find(self, numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, gram numbers) of all grams in a batch of texts; none reaches over the end of its text."""
        count = len(numbers) - self.width + 1
        if count <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        fits = np.ones(count, bool)
        for end in bounds[1:-1]:
            fits[max(end - self.width + 1, 0) : min(end, count)] = False
        for k in range(self.width):
            fits &= numbers[k : k + count] > 0
        at = np.flatnonzero(fits)
        code = numbers[at]
        for k, level in enumerate(self.levels, 1):
            wanted = code * self.base + numbers[at + k]
            place = np.minimum(np.searchsorted(level, wanted), len(level) - 1)
            good = level[place] == wanted
            at, code = at[good], place[good]
        inside = code < len(self.number)
        at, code = at[inside], code[inside]
        known = self.number[code] >= 0
        return at[known], self.number[code[known]]


@dataclass
class Block:
    """Test items as numbers of their words, and their n-grams. ``places``: by gram, [(item, place in the item)]."""

    ids: list
    vocabulary: list[bytes]
    items: list[np.ndarray]
    n: int
    grams: list[tuple[int, ...]]
    places: list[list[tuple[int, int]]]
    tables: list[tuple[np.ndarray, Grams]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.tables = []
        for width in sorted({len(g) for g in self.grams}):
            own = np.array([k for k, g in enumerate(self.grams) if len(g) == width])
            self.tables.append((own, Grams([self.grams[k] for k in own], len(self.vocabulary) + 1)))

    def words(self) -> pa.Array:
        return pa.array(self.vocabulary, pa.binary()).cast(pa.string())

    def find(self, numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text in the batch, place in the batch, gram) of each gram of the block."""
        found = [(at, own[k]) for own, table in self.tables for at, k in [table.find(numbers, bounds)]]
        at = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
        grams = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)
        return np.searchsorted(bounds, at, side="right") - 1, at, grams


def build_block(rows: list[tuple], n: int) -> Block:
    words: dict[bytes, int] = {}
    ids, items = [], []
    grams: dict[tuple[int, ...], list] = defaultdict(list)
    for ident, text in rows:
        numbers = tuple(words.setdefault(w, len(words) + 1) for w in plain_words(text.encode()))
        if not numbers:
            continue
        width = min(n, len(numbers))
        for place in range(len(numbers) - width + 1):
            grams[numbers[place : place + width]].append((len(ids), place))
        ids.append(ident)
        items.append(np.array(numbers, np.int64))
    return Block(ids, list(words), items, n, list(grams), list(grams.values()))


def rarest(block: Block, seen: np.ndarray, spread: int) -> Block:
    """The block with its seeds only: the rarest gram of every ``spread`` in a row of each item."""
    number = {g: k for k, g in enumerate(block.grams)}
    seeds = set()
    for item in block.items:
        words = tuple(item.tolist())
        width = min(block.n, len(words))
        grams = [words[i : i + width] for i in range(len(words) - width + 1)]
        for low in range(max(1, len(grams) - spread + 1)):
            seeds.add(number[min(grams[low : low + spread], key=lambda g: (seen[number[g]], g))])
    kept = sorted(seeds)
    return Block(block.ids, block.vocabulary, block.items, block.n, [block.grams[k] for k in kept], [block.places[k] for k in kept])


def _next_row(above: np.ndarray, same: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """A row of cells from the one above. A gap along the row makes a cell depend on its left neighbour;
    with linear costs that is a running maximum."""
    down = above + GAP
    down[1:] = np.maximum(down[1:], above[:-1] + np.where(same, MATCH, MISMATCH))
    down[0] = 0
    return np.maximum.accumulate(np.maximum(down, 0) - cost) + cost


def align(item: np.ndarray, words: np.ndarray, cells: int = CELLS) -> tuple[int, int, int, int]:
    """Best local alignment of two sequences of numbers: (matched words, longest run of matched words,
    start and end in ``words``).

    Every ``step``-th row of cells is kept, and the way back computes the rows between two kept ones
    again, so that about ``cells`` cells are held, or two roots of all of them where that is more.
    """
    n, m = len(item), len(words)
    cost = GAP * np.arange(m + 1)
    step = n if n * (m + 1) <= cells else max(1, int(n**0.5))
    row, kept, best, end = np.zeros(m + 1, np.int64), [np.zeros(m + 1, np.int64)], 0, (0, 0)
    for i in range(n):
        row = _next_row(row, words == item[i], cost)
        if (i + 1) % step == 0:
            kept.append(row)
        top = int(row.max())
        if top > best:
            best, end = top, (i + 1, int(row.argmax()))
    i, j = end
    stop, matched, run, longest = j, 0, 0, 0
    low, part = n + 1, np.empty((0, 0))
    while best > 0:
        if i - 1 < low:
            low = (i - 1) // step * step
            part = [kept[low // step]]
            for k in range(low, min(low + step, n)):
                part.append(_next_row(part[-1], words == item[k], cost))
        here, above = part[i - low], part[i - low - 1]
        if here[j] == 0:
            break
        same = j > 0 and item[i - 1] == words[j - 1]
        if j > 0 and here[j] == above[j - 1] + (MATCH if same else MISMATCH):
            run = run + 1 if same else 0
            matched += bool(same)
            longest = max(longest, run)
            i, j = i - 1, j - 1
        elif here[j] == above[j] + GAP:
            i, run = i - 1, 0
        else:
            j, run = j - 1, 0
        if i == 0:
            break
    return matched, longest, j, stop


class Aligner:
    """Alignments with the items of a block. Equal windows, as copies give, are aligned once; what is
    remembered is bounded by its bytes."""

    def __init__(self, block: Block, min_share: float, min_run: int):
        self.block, self.min_share, self.min_run = block, min_share, min_run
        self.members = [np.unique(item) for item in block.items]
        self.known: dict[tuple[int, bytes], tuple] = {}
        self.held = 0

    def enough(self, item: int, matched: int, run: int) -> bool:
        size = len(self.block.items[item])
        return matched >= self.min_share * size or run >= min(self.min_run, size)

    def hopeless(self, item: int, words: np.ndarray) -> bool:
        """No alignment can be enough: too few words of the window stand in the item at all."""
        shared = np.isin(words, self.members[item])
        breaks = np.flatnonzero(np.concatenate([[True], ~shared, [True]]))
        return not self.enough(item, int(shared.sum()), int(np.diff(breaks).max()) - 1)

    def __call__(self, item: int, words: np.ndarray) -> tuple[int, int, int, int] | None:
        key = (item, words.tobytes())
        if key not in self.known:
            if self.held > REMEMBERED_BYTES:
                self.known.clear()
                self.held = 0
            self.held += len(key[1]) + 200
            found = None if self.hopeless(item, words) else align(self.block.items[item], words)
            self.known[key] = found if found and self.enough(item, *found[:2]) else None
        return self.known[key]


def leaks(aligner: Aligner, numbers: np.ndarray, places: list[int], grams: list[int]) -> Iterator[tuple]:
    """(item, matched words, longest run, start, end) of each item that a text holds, from its seeds."""
    block = aligner.block
    hits: dict[int, set[int]] = defaultdict(set)
    for at, gram in zip(places, grams, strict=True):
        for item, place in block.places[gram]:
            hits[item].add(at - place)  # where the item would begin
    for item, all_begins in hits.items():
        size = len(block.items[item])
        slack = size // 2 + 8
        begins = np.array(sorted(all_begins))
        best = None
        while len(begins):
            # Hits that lie close together share one window.
            near = int(np.searchsorted(begins, begins[0] + slack, side="right"))
            start, stop = max(0, int(begins[0]) - slack), min(len(numbers), int(begins[near - 1]) + size + slack)
            begins = begins[near:]
            found = aligner(item, numbers[start:stop])
            if found:
                matched, run, a, b = found
                best = max(best or (0, 0, 0, 0), (matched, run, start + a, start + b), key=lambda x: (x[0], x[1], -x[2]))
        if best:
            yield item, *best


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 3,
    spread: int = 4,
    min_share: float = 0.5,
    min_run: int = 13,
    block_bytes: int = 8 << 20,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, item id, matched words, longest run, item words, share, start word, end word) per document and
    item found, and the columns of the document named in ``carry``."""
    spark = docs.sparkSession
    small_batches(spark)
    kept = [f"carry_{i}" for i in range(len(carry))]
    docs = pick(docs, id_col, text_col, *carry).toDF("id", "raw", *kept).withColumn("id", F.col("id").cast("long"))
    items = pick(items, item_col, item_text_col).toDF("item", "text")
    items = stage(items.select(F.col("item").cast("long"), "text").filter("text is not null"), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) * 2 // block_bytes))
    out = None
    for number in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        rows = sorted(map(tuple, part.toLocalIterator()), key=repr)
        found = _block_leaks(docs, build_block(rows, n), spread, min_share, min_run)
        out = found if out is None else out.unionByName(found)
    named: list[Column] = [F.col(k).alias(name) for k, name in zip(kept, carry, strict=True)]
    return out.select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        "matched",
        "run",
        "item_words",
        (F.col("matched") / F.col("item_words")).alias("share"),
        "start",
        "end",
        *named,
    )


def _block_leaks(docs: DataFrame, block: Block, spread: int, min_share: float, min_run: int) -> DataFrame:
    spark = docs.sparkSession
    context = spark.sparkContext
    every = context.broadcast(block)

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = every.value
        vocabulary, seen = grams.words(), np.zeros(len(grams.grams), np.int64)
        for batch in source:
            row, _, gram = grams.find(*numbered(batch.column(0), vocabulary))
            once = np.unique(row * max(len(seen), 1) + gram)  # a document counts once
            seen += np.bincount(once % max(len(seen), 1), minlength=len(seen))[: len(seen)]
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(seen[held], pa.int64())], names=["gram", "docs"])

    seen = np.zeros(len(block.grams), np.int64)
    if len(seen):
        counted = docs.select("raw").mapInArrow(count, "gram long, docs long")
        for r in counted.groupBy("gram").agg(F.sum("docs").alias("docs")).toLocalIterator():  # at most the block's grams
            seen[r["gram"]] = r["docs"]
    sent = context.broadcast(rarest(block, seen, spread))
    names = ["item", "matched", "run", "item_words", "start", "end"]
    others = [c for c in docs.columns if c != "raw"]
    kinds = dict(docs.dtypes)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = sent.value
        vocabulary, aligner = grams.words(), Aligner(grams, min_share, min_run)
        for batch in source:
            numbers, bounds = numbered(batch.column(0), vocabulary)
            row, at, gram = grams.find(numbers, bounds)
            order = np.argsort(row, kind="stable")
            row, at, gram = row[order], at[order], gram[order]
            which, rows = [], []
            cuts = np.flatnonzero(np.diff(row)) + 1
            for own in np.split(np.arange(len(row)), cuts) if len(row) else []:
                text = int(row[own[0]])
                start = int(bounds[text])
                words = numbers[start : int(bounds[text + 1])]
                for item, matched, longest, first, last in leaks(aligner, words, (at[own] - start).tolist(), gram[own].tolist()):
                    which.append(text)
                    rows.append((grams.ids[item], matched, longest, len(grams.items[item]), first, last))
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            taken = [batch.column(1 + i).take(pa.array(which, pa.int64())) for i in range(len(others))]
            yield pa.RecordBatch.from_arrays(
                taken + [pa.array(c, pa.int64()) for c in columns], names=others + names
            )

    made = ", ".join([f"`{c}` {kinds[c]}" for c in others] + [f"`{c}` long" for c in names])
    return docs.select("raw", *others).mapInArrow(run, made)
