"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A piece's bytes are the leaves of a minimum tree. Leaf ``i`` holds ``rank * leaves + i`` for the
pair that starts at byte ``i``, so the root is the lowest rank and, among equals, the leftmost.
A merge changes three leaves: the merged pair, the pair to its left and the one swallowed.

Encoding is a map over rows: no shuffle. A worker remembers the ids of words it has met (bounded),
encodes the new words of a batch together, tree by tree in numpy, and long pieces one at a time.

Null text counts as empty: no ids, and no bytes back. One output row per input row, so repeated
rows repeat. Ids outside the vocabulary raise on decoding; null ids decode to null.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from replaystats.llm.text import batches, small_batches

SHORT = 32  # bytes; pieces up to here share a batch of trees
CACHE_WORDS = 400_000
GROUP_CHARS = 2 << 20
# Blanks beside a space, and blanks that are neither space nor line feed (fixed values of the pattern).
LOOSE = ("  ", " \n", "\n ", *map(chr, (9, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
SIGNS = ".,;:!?#*$%&|<>()[]{}\"-"
_NONE = 1 << 20  # above any rank


def read_ranks(path: str) -> bytes:
    """The rank file, read on the driver: a vocabulary is small and of fixed size."""
    with open(path, "rb") as file:
        return file.read()


class ByteBpe:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines())}
        self.pattern = regex.compile(pattern)
        self.size = max(self.ranks.values(), default=0) + 1
        if self.size > _NONE:
            raise ValueError("too many ranks")
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[int(k)] for k in self.pair_keys], np.int32)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        by_rank = sorted((rank, token) for token, rank in self.ranks.items())
        self.lengths = np.full(self.size, -1, np.int64)
        self.starts = np.zeros(self.size, np.int64)
        at = 0
        for rank, token in by_rank:
            self.lengths[rank], self.starts[rank] = len(token), at
            at += len(token)
        self.bytes = np.frombuffer(b"".join(token for _, token in by_rank), np.uint8)
        self.words: dict[str, bytes] = {}  # by word, packed ids of the word with a space before it
        self.pieces: dict[str, bytes] = {}

    # -- encoding -------------------------------------------------------------------------

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. The pattern never matches across a blank that follows a non-blank, and
        takes a single space to the word behind it, so words repeat and are encoded once."""
        for known in (self.words, self.pieces):
            if len(known) > CACHE_WORDS:
                known.clear()
        split, loose = [], []
        for text in texts:
            if any(blank in text for blank in LOOSE):
                split.append([])
                loose.append(self.pattern.findall(text))
            else:
                first, *rest = text.split(" ")
                split.append(rest)
                loose.append(self.pattern.findall(first))
        new = set().union(*split) - self.words.keys()
        # A word of ASCII letters is one piece with its space; signs behind it are another.
        bodies = {word: word.rstrip(SIGNS) for word in new}
        plain = {body for body in bodies.values() if body.isascii() and body.isalpha()}
        cut = {word: self.pattern.findall(" " + word) for word, body in bodies.items() if body not in plain}
        signs = {word[len(body) :] for word, body in bodies.items() if len(body) < len(word) and body in plain}
        self._learn(self.pieces, {p: p for p in set().union(signs, *loose, *cut.values()) - self.pieces.keys()})
        self._learn(self.words, {body: " " + body for body in plain - self.words.keys()})
        pieces, words = self.pieces, self.words
        for word, parts in cut.items():
            words[word] = b"".join([pieces[p] for p in parts])
        for word, body in bodies.items():
            if body in plain and len(body) < len(word):
                words[word] = words[body] + pieces[word[len(body) :]]
        return [
            np.frombuffer(b"".join([*map(pieces.__getitem__, parts), *map(words.__getitem__, rest)]), np.int32)
            for rest, parts in zip(split, loose, strict=True)
        ]

    def _learn(self, known: dict[str, bytes], texts: dict[str, str]) -> None:
        """Put the ids of pieces, as packed numbers, into ``known``. texts: by key, the piece."""
        by_leaves: dict[int, list[tuple[str, bytes]]] = {}
        for key, piece in texts.items():
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                known[key] = whole.to_bytes(4, "little")
            elif len(raw) > SHORT:
                known[key] = np.array(self.merge_one(raw), "<i4").tobytes()
            else:
                by_leaves.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append((key, raw))
        for leaves, group in by_leaves.items():
            for low in range(0, len(group), 8000):
                part = group[low : low + 8000]
                for (key, _), ids in zip(part, self.merge_many([raw for _, raw in part], leaves), strict=True):
                    known[key] = ids

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE)

    def merge_many(self, raws: list[bytes], leaves: int) -> list[bytes]:
        """Merge pieces of at most ``leaves`` bytes, each in its own tree, one merge of all a step."""
        n = len(raws)
        size = np.fromiter(map(len, raws), np.int32, n)
        padded = np.frombuffer(b"".join(r.ljust(leaves, b"\0") for r in raws), np.uint8).reshape(n, leaves)
        ids = self.byte_ids[padded].astype(np.int32)
        place = np.arange(leaves, dtype=np.int32)
        live = place < size[:, None]
        after = np.tile(place + 1, (n, 1)).ravel()
        before = np.tile(place - 1, (n, 1)).ravel()
        none = np.int32(_NONE * leaves)
        rank = np.full((n, leaves - 1), _NONE, np.int32)
        inside = live[:, 1:]
        rank[inside] = self._pair_rank(ids[:, :-1][inside], ids[:, 1:][inside])
        tree = np.full((n, 2 * leaves), none, np.int32)
        tree[:, leaves : 2 * leaves - 1] = np.where(rank < _NONE, rank * leaves + place[:-1], none)
        node = leaves
        while node > 1:
            tree[:, node // 2 : node] = np.minimum(tree[:, node : 2 * node : 2], tree[:, node + 1 : 2 * node : 2])
            node //= 2
        ids, live, tree = ids.ravel(), live.ravel(), tree.ravel()

        def put(row, leaf, value):
            """Set a leaf of each row's tree and the nodes above it. row: where the row's tree starts."""
            node = leaf + leaves
            tree[row + node] = value
            for _ in range(leaves.bit_length() - 1):
                node = node >> 1
                pair = row + 2 * node
                tree[row + node] = np.minimum(tree[pair], tree[pair + 1])

        row = np.arange(n)
        while True:
            best = tree[row * 2 * leaves + 1]
            going = best < none
            row, best = row[going], best[going]
            if not len(row):
                break
            base, root = row * leaves, row * 2 * leaves
            at, merged = best % leaves, best // leaves
            gone = after[base + at]
            behind = after[base + gone]
            ids[base + at] = merged
            live[base + gone] = False
            after[base + at] = behind
            has = behind < size[row]
            value = np.full(len(row), none, np.int32)
            b = base[has] + behind[has]
            before[b] = at[has]
            right = self._pair_rank(merged[has], ids[b])
            value[has] = np.where(right < _NONE, right * leaves + at[has], none)
            put(root, gone, none)
            put(root, at, value)
            left = before[base + at]
            has = left >= 0
            p = left[has]
            rank = self._pair_rank(ids[base[has] + p], merged[has])
            put(root[has], p, np.where(rank < _NONE, rank * leaves + p, none))
        flat = ids[live].astype("<i4").tobytes()
        ends = (4 * np.cumsum(live.reshape(n, leaves).sum(1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def merge_one(self, raw: bytes) -> list[int]:
        """Merge one piece of any length in O(n log n)."""
        n = len(raw)
        leaves = 1 << max(1, (n - 1).bit_length())
        none = _NONE * leaves
        ids = self.byte_ids[np.frombuffer(raw, np.uint8)].tolist()
        pairs, size = self.pairs, self.size
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            rank = pairs.get(ids[i] * size + ids[i + 1])
            if rank is not None:
                tree[leaves + i] = rank * leaves + i
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf, value):
            node = leaf + leaves
            tree[node] = value
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low

        def pair(left, right):
            rank = pairs.get(ids[left] * size + ids[right])
            return none if rank is None else rank * leaves + left

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] < none:
            merged, at = divmod(tree[1], leaves)
            gone = after[at]
            behind = after[gone]
            ids[at], ids[gone] = merged, -1
            after[at] = behind
            put(gone, none)
            if behind < n:
                before[behind] = at
                put(at, pair(at, behind))
            else:
                put(at, none)
            if before[at] >= 0:
                put(before[at], pair(before[at], at))
        return [i for i in ids if i >= 0]

    # -- decoding -------------------------------------------------------------------------

    def decode_flat(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in a row, and where each text (``ends``: its end among the ids) ends in them."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size or (self.lengths[ids] < 0).any()):
            raise ValueError("an id is outside the vocabulary")
        lengths = self.lengths[ids]
        stop = np.cumsum(lengths)
        total = int(stop[-1]) if len(stop) else 0
        at = np.repeat(self.starts[ids] - stop + lengths, lengths) + np.arange(total)
        return self.bytes[at], np.concatenate([[0], stop])[ends]


@functools.lru_cache(maxsize=2)
def _bpe(key: int, pattern: str, source) -> ByteBpe:
    return ByteBpe(source.value, pattern)


class _Shipped:
    """A broadcast rank file with a key by which a worker finds its built encoder again."""

    def __init__(self, spark, rank_file: bytes, pattern: str):
        self.file = spark.sparkContext.broadcast(rank_file)
        self.key, self.pattern = zlib.crc32(rank_file), pattern

    def get(self) -> ByteBpe:
        return _bpe(self.key, self.pattern, _Same(self.file))


class _Same:
    """Equal to every other of its kind, so that the cache goes by the key alone."""

    def __init__(self, file):
        self.file = file

    @property
    def value(self) -> bytes:
        return self.file.value

    def __eq__(self, other):
        return isinstance(other, _Same)

    def __hash__(self):
        return 0


def shipped(spark, rank_path: str, pattern: str) -> _Shipped:
    return _Shipped(spark, read_ranks(rank_path), pattern)


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    at = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in at] + [column], names=[batch.schema.names[i] for i in at] + [name]
    )


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, text: str, rank_path: str, pattern: str, out: str = "token_ids") -> DataFrame:
    """``df`` with the ids of its column ``text`` as ``out`` (replaced where it exists)."""
    small_batches(df.sparkSession)
    bpe = shipped(df.sparkSession, rank_path, pattern)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.get()
        for batch in source:
            texts = [t or "" for t in batch.column(batch.schema.names.index(text)).to_pylist()]
            values, ends = [], [0]
            for group in batches(iter(texts), GROUP_CHARS, len):
                for ids in coder.encode_all(group):
                    values.append(ids)
                    ends.append(ends[-1] + len(ids))
            flat = np.concatenate(values) if values else np.empty(0, np.int32)
            yield _with(batch, out, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))

    return df.mapInArrow(run, _schema(df, out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, ids: str, rank_path: str, pattern: str, out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its id column ``ids`` as ``out`` (replaced where it exists)."""
    small_batches(df.sparkSession)
    bpe = shipped(df.sparkSession, rank_path, pattern)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.get()
        for batch in source:
            lists = batch.column(batch.schema.names.index(ids))
            flat = lists.flatten()
            if flat.null_count:
                raise ValueError("an id is null")
            ends = np.cumsum(np.concatenate([[0], lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)]))
            raw, stops = coder.decode_flat(flat.to_numpy(zero_copy_only=False).astype(np.int64), ends.astype(np.int64))
            column = pa.Array.from_buffers(
                pa.binary(), len(batch), [None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(raw)]
            )
            if lists.null_count:
                column = pa.array([None if n else v for v, n in zip(column.to_pylist(), lists.is_null().to_pylist(), strict=True)], pa.binary())
            yield _with(batch, out, column)

    return df.mapInArrow(run, _schema(df, out, T.BinaryType()))


def round_trip(df: DataFrame, text: str, rank_path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the ids of its column ``text`` as ``ids`` and the bytes decoded from these as ``out``.

    As :func:`encode` and then :func:`decode`, in one worker a task instead of two, a group of texts at a time.
    """
    small_batches(df.sparkSession)
    bpe = shipped(df.sparkSession, rank_path, pattern)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.get()
        for batch in source:
            texts = [t or "" for t in batch.column(batch.schema.names.index(text)).to_pylist()]
            values, lengths, raws = [np.empty(0, np.int32)], [], []
            for group in batches(iter(texts), GROUP_CHARS, len):
                found = coder.encode_all(group)
                sizes = [len(x) for x in found]
                flat = np.concatenate(found)
                raw, stops = coder.decode_flat(flat.astype(np.int64), np.cumsum([0, *sizes]))
                values.append(flat)
                lengths += sizes
                raws += [raw[a:b].tobytes() for a, b in zip(stops, stops[1:], strict=False)]
            listed = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]), pa.int32()), pa.array(np.concatenate(values)))
            yield _with(_with(batch, ids, listed), out, pa.array(raws, pa.binary()))

    kept = [f for f in df.schema.fields if f.name not in (ids, out)]
    made = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(out, T.BinaryType())]
    return df.mapInArrow(run, T.StructType(kept + made))
