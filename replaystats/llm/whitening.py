"""Embedding whitening: principal components from refined single-precision eigenvectors.

Entries become integers (1024 steps a unit, shifted), so that counts, sums and deviations are exact. One
pass sums them per dimension, a second sums the products of the centred rows into the covariance, each
task a matrix of the fixed size dims * dims. That matrix, whose size does not grow with the rows, goes to
the driver. There a single-precision eigendecomposition gives a first guess, which Ogita-Aishima steps
(matrix products in extended precision) correct; eigenvalues too close for a step are taken as a cluster,
whose eigenvectors a small problem of its own, shifted by the cluster's mean, separates. A third pass
projects the rows, and Spark's own covariances over the result give the error against the identity.

Defined results: rows whose vector is null, or holds a null, NaN or infinite entry, or one of 2^41 or
more, are left out. Where lengths differ the most frequent length counts, of equally frequent ones the
longest, and rows of others are left out. Repeated rows count as often as they stand. A component without
variance (fewer rows than dimensions, equal rows) cannot be scaled: its ``whitened`` is null, its
``explained`` 0, and the error covers the others (null if there are none). Each eigenvector's entry of
largest size is positive. No row left: no output.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaystats.llm.text import pick, small_batches
from replaystats.session import stage

# Steps per unit and the shift of the integer entries, and the bound of an entry.
STEPS, SHIFT = 1024, 100_000
BOUND = float(1 << 41)

DEVIATION = "decimal(38,0)"


def integers(vectors: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of the rows that count, their lengths, their entries as integers, one after another)."""
    lengths = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.empty(0, np.int64)
    entries = vectors.flatten() if vectors.null_count == 0 else vectors.values[vectors.offsets[0].as_py() : vectors.offsets[-1].as_py()]
    value = entries.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(vectors)), lengths)
    bad = np.zeros(len(vectors), bool)
    bad[row[~(np.abs(value) < BOUND)]] = True
    if vectors.null_count:
        bad |= vectors.is_null().to_numpy(zero_copy_only=False)
    if dims is not None:
        bad |= lengths != dims
    x = np.floor(STEPS * value[~bad[row]]).astype(np.int64) + SHIFT
    return np.flatnonzero(~bad), lengths[~bad], x


def _vectors(batch: pa.RecordBatch, column: int) -> pa.Array:
    return batch.column(column).cast(pa.list_(batch.column(column).type.value_type))


class Fit(NamedTuple):
    """Rows, exact sums per dimension, components as columns, eigenvalues and the total variance."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Rows of the chosen length and their exact sums per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            _, lengths, x = integers(_vectors(batch, 0))
            starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
            for length in np.unique(lengths[lengths > 0]):
                where = starts[lengths == length]
                total = x[where[:, None] + np.arange(length)].sum(0)
                entry = held.setdefault(int(length), [0, np.zeros(length, np.int64)])
                entry[0] += len(where)
                entry[1] += total
        size = sum(held)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([length for length in held for _ in range(length)], pa.int32()),
                pa.array([i for length in held for i in range(length)], pa.int32()),
                pa.array([held[length][0] for length in held for _ in range(length)], pa.int64()),
                pa.array(np.concatenate([held[length][1] for length in held]) if size else [], pa.int64()),
            ],
            names=["dims", "i", "n", "s"],
        )

    parts = rows.mapInArrow(add, "dims int, i int, n long, s long")
    sums = stage(parts.groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")), "sums")
    most = sums.filter("i = 0").orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return 0, []
    found = sums.filter(F.col("dims") == most["dims"]).orderBy("i").select("s").collect()
    return most["n"], [int(r["s"]) for r in found]


def _covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the integers, centred before multiplying, divisor n."""
    dims = len(sums)
    mean = np.array([s / n for s in sums])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            kept, _, x = integers(_vectors(batch, 0), dims)
            centred = x.reshape(len(kept), dims) - mean
            total += centred.T @ centred
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"]
        )

    parts = rows.mapInArrow(multiply, "i int, j int, v double")
    found = parts.groupBy("i", "j").agg((F.sum("v") / n).alias("v")).collect()
    matrix = np.zeros((dims, dims))
    for r in found:
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = r["v"]
    return matrix


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product in extended precision out of double-precision ones. Each factor is split into three
    slices of so few digits that products of slices are exact; what is left out is below 2^-60."""
    bits = (53 - max(a.shape[1] - 1, 1).bit_length()) // 2

    def slices(m: np.ndarray, axis: int) -> list[np.ndarray]:
        rest, out = m.astype(np.longdouble), []
        for _ in range(3):
            top = np.abs(rest).max(axis=axis, keepdims=True)
            unit = np.ldexp(np.longdouble(1), np.frexp(np.where(top > 0, top, 1))[1] - bits)
            part = np.round(rest / unit) * unit
            out.append(part.astype(float))
            rest = rest - part
        return out

    left, right = slices(a, 1), slices(b, 0)
    # The small products first, so that the sum keeps their digits.
    order = sorted(((i, j) for i in range(3) for j in range(3 - i)), key=sum, reverse=True)
    return sum((np.longdouble(1) * (left[i] @ right[j]) for i, j in order), np.longdouble(0))


def refined_eigenvectors(matrix: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, from a single-precision start.

    A step corrects all well-separated pairs at once, by products in extended precision; pairs closer than
    the step's error bound stay unresolved in it, and a small eigenproblem over each such cluster, shifted
    by its mean so that its differences keep their digits, turns the cluster's vectors. Eigenvalues closer
    than the rounding of the matrix itself stay a cluster to the end: their vectors are any basis of it.
    """
    scale = np.abs(matrix).max(initial=0.0)
    if not scale > 0:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    a = matrix.astype(np.longdouble) / scale
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = start[:, ::-1].astype(np.longdouble)
    eye = np.eye(len(a), dtype=np.longdouble)
    norm = np.linalg.norm(a.astype(float), 2)
    least = len(a) * np.finfo(float).eps * norm
    for _ in range(steps):
        rest = eye - product(x.T, x)
        s = product(x.T, product(a, x))
        values = np.diag(s) / (1 - np.diag(rest))
        off = s - np.diag(values)
        bound = max(2 * (np.linalg.norm(off.astype(float), 2) + norm * np.linalg.norm(rest.astype(float), 2)), least)
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > bound
        e = np.where(far, (s + values[None, :] * rest) / np.where(far, gap, 1), rest / 2)
        x = x + product(x, e)
        for group in _clusters(values, bound):
            x[:, group] = _separated(a, x[:, group])
        # The next correction is the square of this one.
        if np.abs(e).max() < 1e-9:
            break
    x = x + product(x, eye - product(x.T, x)) / 2
    values = (x * product(a, x)).sum(0) / (x * x).sum(0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x * x).sum(0))[order]
    x = x * np.sign(x[np.abs(x).argmax(0), np.arange(len(x))])
    return (values[order] * scale).astype(float), x.astype(float)


def _clusters(values: np.ndarray, bound: float) -> Iterator[np.ndarray]:
    """Places of eigenvalues that hang together by gaps of at most ``bound``, groups of two or more."""
    order = np.argsort(-values)
    cuts = np.flatnonzero(-np.diff(values[order]) > bound) + 1
    yield from (group for group in np.split(order, cuts) if len(group) > 1)


def _separated(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The eigenvectors inside the space of the columns of ``x``."""
    for _ in range(2):
        q = np.linalg.qr(x.astype(float))[0].astype(np.longdouble)
        for _ in range(2):  # orthonormal to extended precision
            q = q + product(q, np.eye(q.shape[1]) - product(q.T, q)) / 2
        mean = (q * product(a, q)).sum(0).mean()
        inner = product(q.T, product(a, q) - mean * q)
        size = np.abs(inner).max()
        if not size > np.finfo(np.longdouble).eps * 64:
            return q
        _, turn = np.linalg.eigh((inner / size).astype(float))
        x = product(q, turn[:, ::-1])
    return x


def fit(embeddings: DataFrame, vector_col: str = "embedding") -> Fit | None:
    """Means and components of all rows that count; None if there are none."""
    small_batches(embeddings.sparkSession)
    rows = pick(embeddings, vector_col)
    n, sums = _sums(rows)
    if n == 0:
        return None
    matrix = _covariance(rows, n, sums)
    values, vectors = refined_eigenvectors(matrix)
    return Fit(n, tuple(sums), vectors, values, float(np.trace(matrix)))


def project(embeddings: DataFrame, model: Fit, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, deviation, w): each row that counts with its exact deviation and its first components, scaled
    to variance one (null without variance)."""
    small_batches(embeddings.sparkSession)
    rows = pick(embeddings, id_col, vector_col)
    id_type = dict(rows.dtypes)[id_col]
    n, dims = model.n, len(model.sums)
    k = min(components, dims)
    # Below this share of the largest eigenvalue a component is rounding error.
    real = model.values[:k] > max(model.values[0], 0) * dims * 1e-14
    factor = np.where(real, 1 / np.sqrt(np.where(real, model.values[:k], 1)), np.nan)
    turn = model.vectors[:, :k] * factor
    sums = np.array(model.sums, dtype=object)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, _, x = integers(_vectors(batch, 1), dims)
            x = x.reshape(len(kept), dims)
            largest = int(np.abs(x).max(initial=0)) * n + max(map(abs, model.sums))
            if largest < 1 << 62:
                off = x * n - sums.astype(np.int64)
            else:
                off = x.astype(object) * n - sums
            widest = int(np.abs(off).max(initial=0))
            exact = off if widest * widest * dims < 1 << 63 else off.astype(object)
            deviation = (exact * exact).sum(1)
            w = (off.astype(float) / n) @ turn
            shown = pa.array(w.ravel(), mask=np.isnan(w).ravel())
            whole = [int(v) for v in deviation]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(kept)),
                    pa.array([str(v) if v < 10**38 else None for v in whole], pa.string()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1) * k, pa.int32()), shown),
                ],
                names=["id", "deviation", "w"],
            )

    made = rows.mapInArrow(apply, f"id {id_type}, deviation string, w array<double>")
    return made.select(F.col("id").alias(id_col), F.col("deviation").cast(DEVIATION), "w")


def whiten(embeddings: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per row that counts and component."""
    spark = embeddings.sparkSession
    id_type = dict(pick(embeddings, id_col).dtypes)[id_col]
    out = f"{id_col} {id_type}, component int, n long, deviation {DEVIATION}, whitened double, explained double, identity_error double"
    model = fit(embeddings, vector_col)
    if model is None:
        return spark.createDataFrame([], out)
    rows = stage(project(embeddings, model, components, id_col, vector_col), "whitened")
    k = min(components, len(model.sums))
    entry = lambda i: F.get("w", F.lit(i))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.agg(*(F.covar_pop(entry(i), entry(j)).alias(f"c{i}_{j}") for i, j in pairs)).first()
    errors = [abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs if found[f"c{i}_{j}"] is not None]
    shares = [max(v, 0.0) / model.trace if model.trace > 0 else 0.0 for v in model.values[:k]]
    listed = F.array(*map(F.lit, shares))
    return rows.select(id_col, "deviation", F.posexplode("w").alias("place", "whitened")).select(
        id_col,
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(listed, F.col("place")).alias("explained"),
        F.lit(max(errors) if errors else None).cast("double").alias("identity_error"),
    )
