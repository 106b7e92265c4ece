"""How far the sources of a language differ in their terms, pair by pair and term by term.

The counts of terms by (language, source) are a sparse matrix. Its pairs of rows are compared over
quadtrees: a K-squared tree (K = 2) marks which quadrants of the matrix hold a count at all, and two
groups of rows descend their trees together. Where neither has a count, the divergence of a term is
the same for all terms of the quadrant, a function of two totals, so it is priced by its width; only
quadrants in which one side has a count are opened, down to the single terms.

Spark deals the work out. Texts become counts in one pass with bounded memory, summed by
(language, source, term), so that a frequent term or a source with a third of all rows is one row a
task. The matrix is cut into blocks of columns by the hash of the term, about ``block_cells`` counts
each, and tiles of ``tile`` sources; a task holds one block of two tiles and returns a sum for each
of at most tile * tile pairs. Columns that no block of a pair holds are priced at the end.

Integers throughout, so the result does not depend on the order of work. Defined results: null text,
lang and source count as ''; each row is a document, repeated rows as well; a group without terms
takes part with all counts zero; a language without kept terms has pairs of value 0 and no terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replaystats.llm.text import LOWER, UPPER, pick, small_batches
from replaystats.session import stage

# Scale of the shares and their smoothing.
SCALE, SMOOTH = 1_000_000_000, 2

# A term is a run of ASCII letters and bytes above 127, which are those of all other characters.
_LETTERS = bytes.maketrans(UPPER.encode(), LOWER.encode())
_KEEP = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in _LETTERS)

COUNTS = "lang string, source string, term string, n long, docs long"


def _rows(held: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, docs) in held.items():
        # The first row, without a term, says that the group exists.
        terms = [None, *(t.decode() for t in counts)]
        size = len(terms)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * size, pa.string()),
                pa.array([source] * size, pa.string()),
                pa.array(terms, pa.string()),
                pa.array([0, *counts.values()], pa.int64()),
                pa.array([0, *(docs[t] for t in counts)], pa.int64()),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def count_terms(docs: DataFrame, held_terms: int = 300_000) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, and a row with a null term
    for each group. A task holds at most ``held_terms`` terms and those of one text, then hands them on."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for key, raw in zip(keys, batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                terms = raw.translate(_KEEP).split()
                counts, found = held.setdefault(key, (Counter(), Counter()))
                size -= len(counts)
                counts.update(terms)
                found.update(set(terms))
                size += len(counts)
                if size >= held_terms:
                    yield from _rows(held)
                    held, size = {}, 0
        yield from _rows(held)

    parts = docs.mapInArrow(count, COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), exactly; null where nothing is kept."""
    over = F.when(kept > 0, total + SMOOTH * kept).cast("decimal(19,0)")
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTH).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", scaled, over)


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


class QuadTree:
    """K-squared tree of a sparse matrix of shares: per level the codes of the quadrants that are not empty."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, shares: np.ndarray, levels: int):
        self.levels = levels
        code = (rows << levels) | columns
        order = np.argsort(code)
        self.shares = shares[order]
        self.codes = [code[order]]
        for shift in range(1, levels + 1):
            up = ((rows >> shift) << levels) | (columns >> shift)
            self.codes.append(np.unique(up))

    def find(self, rows: np.ndarray, columns: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of quadrants among those that are not empty, and whether each is one of them."""
        held = self.codes[shift]
        if len(held) == 0:
            return np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
        code = (rows << self.levels) | columns
        place = np.minimum(np.searchsorted(held, code), len(held) - 1)
        return place, held[place] == code


def compare(
    left: QuadTree, right: QuadTree, zero_left: np.ndarray, zero_right: np.ndarray, columns: int, same: bool, cells: int = 1 << 20
) -> np.ndarray:
    """Summed divergence of each pair of rows over all columns.

    ``zero_left`` and ``zero_right`` are the shares of a count of zero by row. With ``same`` only pairs
    of a row with a later one are compared. Columns are taken in runs small enough that the opened
    leaves of a run stay below ``cells``.
    """
    n, m = len(zero_left), len(zero_right)
    total = np.zeros((n, m), np.int64)
    empty = np.zeros((n + 1, m + 1), np.int64)
    top = left.levels
    start = top
    while start and n * m * (1 << start) > cells:
        start -= 1
    step = 1 << start
    a0, b0 = np.meshgrid(np.arange(-(-n // step)), np.arange(-(-m // step)), indexing="ij")
    for first in range(-(-columns // step)):
        a, b = a0.ravel(), b0.ravel()
        c = np.full(len(a), first)
        for shift in range(start, -1, -1):
            if same:
                upper = a <= b if shift else a < b
                a, b, c = a[upper], b[upper], c[upper]
            at_left, in_left = left.find(a, c, shift)
            at_right, in_right = right.find(b, c, shift)
            held = in_left | in_right
            # Nothing in either quadrant: every column in it costs the same.
            za, zb, zc = a[~held], b[~held], c[~held]
            width = np.minimum((zc + 1) << shift, columns) - (zc << shift)
            a1, b1 = np.minimum((za + 1) << shift, n), np.minimum((zb + 1) << shift, m)
            for rows, cols, sign in ((za << shift, zb << shift, 1), (a1, zb << shift, -1), (za << shift, b1, -1), (a1, b1, 1)):
                np.add.at(empty, (rows, cols), sign * width)
            if shift == 0:
                p = np.where(in_left, left.shares[at_left] if len(left.shares) else 0, zero_left[a])[held]
                q = np.where(in_right, right.shares[at_right] if len(right.shares) else 0, zero_right[b])[held]
                np.add.at(total, (a[held], b[held]), (p - q) ** 2 // (p + q))
            else:
                a, b, c = a[held], b[held], c[held]
                a, b, c = (
                    np.concatenate([2 * x + (corner >> bit & 1) for corner in range(8)]) for x, bit in ((a, 0), (b, 1), (c, 2))
                )
                real = (a << (shift - 1) < n) & (b << (shift - 1) < m) & (c << (shift - 1) < columns)
                a, b, c = a[real], b[real], c[real]
    widths = empty.cumsum(0).cumsum(1)[:n, :m]
    p, q = zero_left[:, None], zero_right[None, :]
    return total + widths * ((p - q) ** 2 // (p + q))


PARTS = "lang string, first int, second int, value long, width long"


def _compare_block(key: tuple, cells: pa.Table, groups: pa.Table) -> pa.Table:
    """Partial sums of the pairs of two tiles over one block of columns."""
    lang, _, one, two = (k.as_py() for k in key)
    columns, column_ids = np.unique(cells["term"].to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
    place, tile, shares = (cells[c].to_numpy().astype(np.int64) for c in ("place", "tile", "p"))
    members = {c: groups[f"member_{c}"].to_numpy().astype(np.int64) for c in ("place", "tile", "zero")}
    sides = []
    for t in (one, two):
        mine = members["tile"] == t
        order = np.argsort(members["place"][mine])
        places, zero = members["place"][mine][order], members["zero"][mine][order]
        held = tile == t
        sides.append((places, zero, np.searchsorted(places, place[held]), column_ids[held].astype(np.int64), shares[held]))
    longest = max(len(columns), *(len(s[0]) for s in sides), 1)
    levels = int(longest - 1).bit_length()
    trees = [QuadTree(rows, cols, p, levels) for _, _, rows, cols, p in sides]
    sums = compare(*trees, sides[0][1], sides[1][1], len(columns), one == two)
    a, b = np.triu_indices(len(sides[0][0]), 1) if one == two else (x.ravel() for x in np.indices(sums.shape))
    size = len(a)
    return pa.table(
        {
            "lang": pa.array([lang] * size, pa.string()),
            "first": pa.array(sides[0][0][a], pa.int32()),
            "second": pa.array(sides[1][0][b], pa.int32()),
            "value": pa.array(sums[a, b], pa.int64()),
            "width": pa.array(np.full(size, len(columns)), pa.int64()),
        }
    )


def _groups(counts: DataFrame, kept: DataFrame, tile: int, block_cells: int) -> DataFrame:
    """A row per (lang, source): totals, share of a zero count, number and tile within the language."""
    every = counts.select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("cells"))
    langs = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_all"), F.sum("first").alias("kept"), F.count(F.lit(1)).alias("lang_cells")
    )
    filled = every.join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    filled = filled.withColumn("place", place).withColumn("tile", F.floor(F.col("place") / tile).cast("int"))
    tiles = F.max("tile").over(Window.partitionBy("lang")) + 1
    return filled.select(
        "lang",
        "source",
        "n_all",
        "lang_all",
        "kept",
        "place",
        "tile",
        tiles.alias("tiles"),
        F.ceil(F.col("lang_cells") / block_cells).cast("int").alias("blocks"),
        share(F.lit(0), F.col("n_all"), F.col("kept")).alias("zero"),
    )


def _in_tile_pairs(df: DataFrame) -> DataFrame:
    """Each row once for every pair of tiles that its own tile is part of."""
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    return df.withColumn("other", other).withColumns({"one": F.least("tile", "other"), "two": F.greatest("tile", "other")})


def _pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    key = ("lang", "block", "one", "two")
    cells = entries.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    cells = _in_tile_pairs(cells).select(*key, "tile", "place", "term", "p")
    members = groups.filter("blocks > 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = _in_tile_pairs(members).select(*key, "tile", "place", "zero")
    # New names for one side: both stem from the same table.
    names = {c: f"member_{c}" for c in members.columns}
    members = members.withColumnsRenamed(names)
    parts = cells.groupBy(*key).cogroup(members.groupBy(*(names[k] for k in key))).applyInArrow(_compare_block, PARTS)
    sums = parts.groupBy("lang", "first", "second").agg(F.sum("value").alias("value"), F.sum("width").alias("width"))
    named = lambda side: groups.select(
        "lang", F.col("place").alias(side), F.col("source").alias(f"{side}_source"), F.col("zero").alias(f"{side}_zero"), "kept"
    )
    pairs = named("first").join(named("second").drop("kept"), "lang").filter(F.col("first") < F.col("second"))
    priced = pairs.join(sums, ["lang", "first", "second"], "left")
    rest = F.coalesce((F.col("kept") - F.coalesce("width", F.lit(0))) * _gap(F.col("first_zero"), F.col("second_zero")), F.lit(0))
    both = priced.withColumn("value", F.coalesce("value", F.lit(0)) + rest)
    sides = F.array(
        F.struct(F.col("first_source").alias("source"), F.col("second_source").alias("item")),
        F.struct(F.col("second_source").alias("source"), F.col("first_source").alias("item")),
    )
    return both.select("lang", F.inline(sides), "value").select("lang", "source", F.lit("pair").alias("part"), "item", "value")


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = 10,
    top: int = 10,
    tile: int = 256,
    block_cells: int = 200_000,
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` with the divergence from each other source of
    the language, part ``term`` with the ``top`` terms that stand out most against the whole language."""
    docs = pick(docs, lang_col, source_col, text_col).toDF("lang", "source", "text")
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in docs.columns))
    counts = stage(count_terms(docs), "term-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = (
        counts.filter(F.col("term").isNotNull())
        .withColumns(
            {
                "all_docs": F.sum("docs").over(of_term),
                "all_n": F.sum("n").over(of_term),
                "first": (F.row_number().over(of_term.orderBy("source")) == 1).cast("long"),
            }
        )
        .filter(F.col("all_docs") >= min_docs)
        .select("lang", "source", "term", "n", "all_n", "first")
    )
    kept = stage(kept, "kept-terms")
    groups = stage(_groups(counts, kept, tile, block_cells), "term-groups")
    entries = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("n_all"), F.col("kept")))
    q = share(F.col("all_n"), F.col("lang_all"), F.col("kept"))
    terms = entries.withColumn("q", q).filter("p > q")
    terms = terms.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = terms.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    pairs = _pairs(entries, groups).withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(best).select("lang", "source", "part", "item", "value", "rank")
