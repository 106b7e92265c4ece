"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The terms are the words of a text
(letters and digits, lower case) and the prefixes of its longer words, hashed into ``buckets``. The
pairwise part gives a weight to words that are toxic only together, which an additive model lacks.

Training reads at most ``max_train`` labelled rows, those with the smallest hash of their id: a
documented bound, at which a classifier of this size no longer gains. The terms whose presence tells
nothing about the label are left out of the model (``max_terms``, by information gain), so the
factors are few and long texts don't drown them. Everything fitted has a fixed size. Scoring is a
map over all rows, without a shuffle.

Defined results: null or empty text has no term and scores sigmoid(w0); one output row per input
row; labels other than 0 and 1 and rows without a label are not learned from. Without any labelled
row, or with one class only, the model is the smoothed share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaystats.llm.text import WordHash, batches, pick, small_batches

TERM = regex.compile(r"[\p{L}\p{N}]+")
PREFIX = 5
PART_TERMS = 100_000
MIN_STEPS = 200  # of mini-batches, however few rows there are


def terms(text: str, hashes: WordHash, buckets: int) -> np.ndarray:
    """Sorted distinct buckets of a text's terms."""
    found: set[str] = set()
    for match in TERM.finditer(text.lower()):
        found.add(match[0])
    found |= {f"{word[:PREFIX]}*" for word in found if len(word) > PREFIX}
    return np.unique(hashes.of([word.encode() for word in found]) % np.uint64(buckets)).astype(np.int64)


@dataclass
class Machine:
    """``slot`` maps a bucket to its row of ``weight`` and ``factor``; row 0 is all zero."""

    bias: float
    slot: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        """Scores of rows, some terms at a time, since each takes a hundred bytes of work space."""
        return np.concatenate([np.empty(0), *map(self._score, batches(iter(rows), PART_TERMS, len))])

    def _score(self, rows: list[np.ndarray]) -> np.ndarray:
        at = np.concatenate([self.slot[r] for r in rows])
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        keep = at > 0
        return 1 / (1 + np.exp(-np.clip(_logits(self, at[keep], owner[keep], len(rows))[0], -30, 30)))


def _logits(model: Machine, at: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Logits of n rows, and each row's sum of factors."""
    linear = np.bincount(owner, model.weight[at], n)
    v = model.factor[at]
    total = np.stack([np.bincount(owner, v[:, k], n) for k in range(v.shape[1])], 1)
    square = np.bincount(owner, (v * v).sum(1), n)
    return model.bias + linear + 0.5 * ((total * total).sum(1) - square), total


def fit(
    rows: list[np.ndarray],
    labels: np.ndarray,
    buckets: int,
    max_terms: int,
    factors: int,
    epochs: int,
    seed: int = 7,
) -> Machine:
    """Fit by Adam on mini-batches of rows; L2 on weights and factors."""
    n, hits = len(rows), int(labels.sum())
    share = (hits + 0.5) / (n + 1)
    slot = np.zeros(buckets, np.int64)
    empty = Machine(float(np.log(share / (1 - share))), slot, np.zeros(1), np.zeros((1, factors)))
    if hits in (0, n):
        return empty
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    seen = np.bincount(flat, minlength=buckets).astype(float)
    toxic = np.bincount(flat, labels[owner], buckets)
    chosen = np.argsort(-_gain(toxic, seen, hits, n), kind="stable")[:max_terms]
    chosen = np.sort(chosen[seen[chosen] >= 3])
    slot[chosen] = np.arange(1, len(chosen) + 1)
    at = slot[flat]
    owner, at = owner[at > 0], at[at > 0]
    start = np.searchsorted(owner, np.arange(n + 1))

    rng = np.random.default_rng(seed)
    weight = np.zeros(len(chosen) + 1)
    factor = rng.normal(0, 0.01, (len(chosen) + 1, factors))
    factor[0] = 0
    model = Machine(empty.bias, slot, weight, factor)
    state = [np.zeros_like(weight), np.zeros_like(weight), np.zeros_like(factor), np.zeros_like(factor)]
    step, size, l2 = 0, 256, 1e-4
    epochs = max(epochs, -(-MIN_STEPS * size // max(n, size)))  # few rows are gone over more often
    for epoch in range(epochs):
        rate = 0.03 * (1 - epoch / epochs) + 0.002
        order = rng.permutation(n)
        for low in range(0, n, size):
            part = order[low : low + size]
            lens = start[part + 1] - start[part]
            own = np.repeat(np.arange(len(part)), lens)
            where = np.repeat(start[part] - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())
            a = at[where]
            logit, total = _logits(model, a, own, len(part))
            slope = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[part]) / len(part)
            model.bias -= rate * slope.sum()
            touched, back = np.unique(a, return_inverse=True)
            grad_w = np.bincount(back, slope[own], len(touched)) + l2 * weight[touched]
            raw = slope[own][:, None] * (total[own] - factor[a])
            grad_v = np.stack([np.bincount(back, raw[:, k], len(touched)) for k in range(factors)], 1)
            grad_v += l2 * factor[touched]
            step += 1
            for value, m, s, grad in ((weight, state[0], state[1], grad_w), (factor, state[2], state[3], grad_v)):
                m[touched] = 0.9 * m[touched] + 0.1 * grad
                s[touched] = 0.99 * s[touched] + 0.01 * grad * grad
                value[touched] -= rate * m[touched] / (np.sqrt(s[touched]) + 1e-7)
    return model


def _gain(toxic: np.ndarray, seen: np.ndarray, hits: int, n: int) -> np.ndarray:
    """Information gain of a term's presence about the label."""

    def entropy(p: np.ndarray) -> np.ndarray:
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return -(p * np.log(p) + (1 - p) * np.log(1 - p))

    absent = n - seen
    with_term = entropy((toxic + 0.1) / (seen + 0.2))
    without = entropy((hits - toxic + 0.1) / (absent + 0.2))
    return entropy(np.array(hits / n)) - (seen * with_term + absent * without) / n


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_train: int = 16_000,
    buckets: int = 1 << 18,
    max_terms: int = 6_000,
    factors: int = 4,
    epochs: int = 8,
) -> Machine:
    """Fit on the rows of ``docs`` that ``labels`` marks 0 or 1, at most ``max_train`` of them."""
    small_batches(docs.sparkSession)
    marked = (
        pick(labels, id_col, label_col)
        .toDF("id", "label")
        .filter(F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.max("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_train)
    )
    rows = pick(docs, id_col, text_col).toDF("id", "text").join(F.broadcast(marked), "id")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in source:
            ids, texts, marks = (batch.column(i).to_pylist() for i in range(3))
            found = [terms(t or "", hashes, buckets) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([f.astype(np.int32).tobytes() for f in found], pa.binary()), pa.array(marks, pa.int32())],
                names=["id", "terms", "label"],
            )

    # At most max_train rows of distinct terms reach the driver; texts do not.
    sample = rows.select(F.col("id").cast("long"), "text", "label").mapInArrow(run, "id long, terms binary, label int")
    got = sorted(sample.toLocalIterator(), key=lambda r: (r["id"], r["label"], bytes(r["terms"])))
    return fit(
        [np.frombuffer(bytes(r["terms"]), np.int32).astype(np.int64) for r in got],
        np.array([r["label"] for r in got], float),
        buckets,
        max_terms,
        factors,
        epochs,
    )


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per input row: the probability of label 1."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, hashes = sent.value, WordHash()
        for batch in source:
            found = [terms(t or "", hashes, len(machine.slot)) for t in batch.column(1).to_pylist()]
            scores = machine.score(found) if found else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"])

    kind = docs.schema.fields[docs.columns.index(id_col)].dataType.simpleString()
    return pick(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")


def reject(docs: DataFrame, model: Machine, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns; a map without a shuffle."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, hashes = sent.value, WordHash()
        for batch in source:
            if len(batch):
                found = [terms(t or "", hashes, len(machine.slot)) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(machine.score(found) < threshold))

    return docs.mapInArrow(run, docs.schema)
