"""Byte-level BPE encoding and decoding on length-bucketed numpy matrices.

A text is cut by the pattern of the vocabulary.  The distinct pieces of a slice
are sorted into buckets by length and laid out as padded matrices of ids, one
row a piece.  Each round every row merges its leftmost pair of lowest rank and
drops one column; the rank of a pair comes from an open-addressed hash table.
Rows without a pair that can merge leave the matrix.

Null text counts as empty; an empty text has no ids.  Repeated rows are encoded
alike.  Only the key columns and the text are read, other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import byte_view, lists, mapped, ranges, slices

#: Rank of a pair that is no token.
NONE = np.int32(2**31 - 1)
#: Rows and columns of a matrix; longer pieces go one at a time.
CELLS, WIDEST = 1 << 18, 64
#: Pieces remembered by a task between slices; beyond that it starts anew.
REMEMBERED = 1 << 17
#: Bytes of a rank file that a task closure may carry.
RANK_FILE_BYTES = 16 << 20


class PairTable:
    """Ids that two neighbouring ids merge to, in an open-addressed table."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(len(merged) * 2.5).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, NONE, np.int32)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        todo, slot = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = self.keys[slot[todo]] == -1
            self.keys[slot[todo[free]]] = key[todo[free]]
            placed = self.keys[slot[todo]] == key[todo]
            self.merged[slot[todo[placed]]] = merged[todo[placed]]
            todo = todo[~placed]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = (key ^ (key >> 29)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, NONE if there is none; a negative id is padding."""
        key = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        slot = self._slot(key)
        held = self.keys[slot]
        found = np.where(held == key, self.merged[slot], NONE)
        todo = np.flatnonzero((held != key) & (held != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            held = self.keys[slot[todo]]
            hit = held == key[todo]
            found[todo[hit]] = self.merged[slot[todo[hit]]]
            todo = todo[~hit & (held != -1)]
        found[(key < 0) | ((key & 0x80000000) != 0)] = NONE
        return found.reshape(left.shape)


def merge_rows(ids: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merged ids of padded rows (padding -1 behind) and their lengths."""
    out = np.full(ids.shape, -1, np.int32)
    rows, rank = np.arange(len(ids)), pairs(ids[:, :-1], ids[:, 1:])
    while rank.shape[1] and len(rows):
        at = rank.argmin(axis=1)
        best = rank[np.arange(len(rows)), at]
        live = best != NONE
        if not live.all():
            out[rows[~live], :ids.shape[1]] = ids[~live]
            rows, ids, rank, at, best = rows[live], ids[live], rank[live], at[live], best[live]
        n = np.arange(len(rows))
        ids[n, at] = best
        keep = np.ones(ids.shape, bool)
        keep[n, at + 1] = False
        ids = ids[keep].reshape(len(rows), ids.shape[1] - 1)
        keep = np.ones(rank.shape, bool)
        keep[n, at] = False
        rank = rank[keep].reshape(len(rows), rank.shape[1] - 1)
        k = np.flatnonzero(at > 0)
        rank[k, at[k] - 1] = pairs(ids[k, at[k] - 1], ids[k, at[k]])
        k = np.flatnonzero(at < rank.shape[1])
        rank[k, at[k]] = pairs(ids[k, at[k]], ids[k, at[k] + 1])
    out[rows, :ids.shape[1]] = ids
    return out, (out >= 0).sum(axis=1)


def merge_long(ids: np.ndarray, pairs: PairTable) -> np.ndarray:
    """Merged ids of one long piece; a round merges every place of the lowest rank.

    That equals leftmost merges one by one until a merge creates a pair of a
    still lower rank; the round stops behind the first such merge.
    """
    while len(ids) > 1:
        rank = pairs(ids[:-1], ids[1:])
        best = rank.min()
        if best == NONE:
            break
        at = np.flatnonzero(rank == best)
        n = np.arange(len(at))
        run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, n, 0))
        at = at[(n - run) % 2 == 0]
        padded = np.concatenate([[np.int32(-1)], ids, [np.int32(-1), np.int32(-1)]])
        before = np.where(np.diff(at, prepend=-9) == 2, best, padded[at])
        made = np.full(len(at), best, np.int32)
        lower = np.flatnonzero(np.minimum(pairs(before, made), pairs(made, padded[at + 3])) < best)
        at = at[:lower[0] + 1] if len(lower) else at
        ids[at] = best
        ids = np.delete(ids, at + 1)
    return ids


class Vocabulary:
    """Ranks of a byte-level BPE, with the pieces met lately."""

    def __init__(self, rank_file: bytes, pattern: str):
        lines = [line.split() for line in rank_file.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.pattern = regex.compile(pattern)
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        split = [(self.ranks[t[:i]], self.ranks[t[i:]], rank) for t, rank in self.ranks.items() for i in range(1, len(t))
                 if t[:i] in self.ranks and t[i:] in self.ranks]
        self.pairs = PairTable(*np.array(split or [(0, 0, 0)][:0], np.int32).reshape(-1, 3).T)
        tokens = {rank: token for token, rank in self.ranks.items()}
        size = max(tokens) + 1
        self.widths = np.array([len(tokens.get(i, b"")) for i in range(size)], np.int64)
        self.begins = np.cumsum(self.widths) - self.widths
        self.bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.counts, self.starts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list = [None] * len(pieces)
        lengths = np.array([len(p) for p in pieces])
        for i, p in enumerate(pieces):
            if p in self.ranks:
                out[i] = np.array([self.ranks[p]], np.int32)
                lengths[i] = 0
            elif len(p) > WIDEST:
                out[i] = merge_long(self.first[np.frombuffer(p, np.uint8)], self.pairs)
                lengths[i] = 0
        width = 2
        while width <= WIDEST:
            rows = np.flatnonzero((lengths > width // 2) & (lengths <= width)) if width > 2 else np.flatnonzero((lengths > 0) & (lengths <= 2))
            for begin in range(0, len(rows), max(1, CELLS // width)):
                some = rows[begin:begin + max(1, CELLS // width)]
                flat = np.frombuffer(b"".join([pieces[i].ljust(width, b"\0") for i in some]), np.uint8).reshape(-1, width)
                ids = np.where(np.arange(width) < lengths[some][:, None], self.first[flat], np.int32(-1))
                merged, n = merge_rows(ids, self.pairs)
                for i, row, k in zip(some, merged, n):
                    out[i] = row[:k]
            width *= 2
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of ids of each."""
        if len(self.known) > REMEMBERED:
            self.forget()
        number, found, met = self.known.__getitem__, [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = list(map(number, self.pattern.findall(text)))
            met[i] = len(pieces)
            found.append(np.array(pieces, np.int64))
        if self.known.fresh:
            new = self.merge([p.encode() for p in self.known.fresh])
            counts = np.array([len(x) for x in new], np.int64)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, *new])
            self.known.fresh = []
        piece = np.concatenate(found) if found else np.zeros(0, np.int64)
        counts = self.counts[piece]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[ranges(self.starts[piece], counts)], np.diff(ends[np.concatenate([[0], np.cumsum(met)])])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of all lists of ids, one after the other, and where each list begins and ends."""
        widths = self.widths[ids]
        ends = np.concatenate([[0], np.cumsum(widths)])
        return self.bytes[ranges(self.begins[ids], widths)].tobytes(), ends[np.concatenate([[0], np.cumsum(counts)])]


class _Numbers(dict):
    """Numbers pieces in the order they are met."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number


_vocabularies: dict[tuple[int, str], Vocabulary] = {}


def _vocabulary(rank_file: bytes, pattern: str) -> Vocabulary:
    """One vocabulary a Python worker; workers serve one task after another."""
    key = (hash(rank_file), pattern)
    if key not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[key] = Vocabulary(rank_file, pattern)
    return _vocabularies[key]


def read_ranks(path: str) -> bytes:
    """The rank file, refused beyond RANK_FILE_BYTES since every task gets a copy."""
    with open(path, "rb") as f:
        held = f.read(RANK_FILE_BYTES + 1)
    if len(held) > RANK_FILE_BYTES:
        raise ValueError(f"{path} is larger than {RANK_FILE_BYTES} bytes")
    return held


def encode(docs: DataFrame, keys: list[str], text: str, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``keys`` and the token ids of ``text`` as ``ids`` (array of int), one row a row."""
    rank_file, n = read_ranks(ranks), len(keys)
    chosen = docs.select(*keys, docs[text].cast("string").alias(text) if text not in keys else docs[text].alias("_text"))
    schema = T.StructType([*docs.select(*keys).schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(rank_file, pattern)
        for part in slices(batches, n):
            flat, counts = vocabulary.encode([x or "" for x in part.column(n).to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns[:n], lists(flat, counts, pa.int32())], names=[*keys, ids])

    return mapped(chosen, run, schema)


def decode(encoded: DataFrame, keys: list[str], ids: str, ranks: str, decoded: str = "decoded") -> DataFrame:
    """``keys`` and the bytes that ``ids`` stand for as ``decoded``; null ids give no bytes."""
    rank_file, n = read_ranks(ranks), len(keys)
    schema = T.StructType([*encoded.select(*keys).schema.fields, T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(rank_file, r"(?s).")
        for part in batches:
            for begin in range(0, part.num_rows, 500):
                some = part.slice(begin, 500)
                column = some.column(n)
                counts = np.array([c or 0 for c in column.value_lengths().to_pylist()], np.int64)
                held, at = vocabulary.decode(column.flatten().to_numpy(zero_copy_only=False), counts)
                texts = pa.array([held[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*some.columns[:n], texts], names=[*keys, decoded])

    return mapped(encoded.select(*keys, ids), run, schema)


def round_trip(docs: DataFrame, keys: list[str], text: str, ranks: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``keys``, the token ids of ``text`` and the bytes that these decode to, in one pass."""
    rank_file, n = read_ranks(ranks), len(keys)
    chosen = docs.select(*keys, docs[text].cast("string").alias("_text"))
    schema = T.StructType([*docs.select(*keys).schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(rank_file, pattern)
        for part in slices(batches, n):
            flat, counts = vocabulary.encode([x or "" for x in part.column(n).to_pylist()])
            held, at = vocabulary.decode(flat, counts)
            texts = pa.array([held[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:n], lists(flat, counts, pa.int32()), texts], names=[*keys, ids, decoded])

    return mapped(chosen, run, schema)


def digest_rows(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document the number of ids, and the digests of the ids and of the bytes they decode to."""
    return round_trip(docs, ["doc_id"], "text", ranks, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
