"""Benchmark decontamination with suffix arrays of the training text.

Words: ASCII letters are lower-cased, a word is a run of a-z, 0-9 and characters
beyond ASCII.  A window is ``window`` consecutive words of a benchmark item; an
item of fewer words, but not none, is one window.

A task takes its documents shard by shard (a few MB of text).  Words become the
numbers of the benchmark's vocabulary.  Stretches that can match (every three
words in a row also stand in some item, or it is a whole item of one or two
words) make up the training text, whose suffix array is built by prefix
doubling.  Every test suffix is binary-searched in it, all at once: the bounds
for its first ``window`` words give all places of the window, its neighbours the
longest verbatim match.

The benchmark is cut into blocks of bounded size, each sent with a pass of its
own over the documents; passes follow each other in the same task, without a
shuffle.  Null texts and texts without words have no words and no hits.
Repeated documents get the same result; an item_id that occurs more than once
counts once, a null item_id marks words but is not listed.  Columns other than
those asked for are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import byte_view, columns, fresh, lists, mapped, ranges, slices

#: Bytes of benchmark text sent along with one pass.
BLOCK_BYTES = 4 << 20
#: Words that a stretch has to share with an item before it is sorted.
SEED = 3

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_letter = np.zeros(256, bool)
_letter[48:58] = _letter[97:123] = _letter[128:] = True
_mix = np.random.default_rng(13).integers(0, 2**64, (64, 256), dtype=np.uint64, endpoint=False)
_far = np.uint64(0x9E3779B97F4A7C15)


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts data[at[i]:at[i + 1]], and where each text's words begin and end."""
    data = _lower[data]
    inside = _letter[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    widths = np.flatnonzero(inside & (~after | edge[1:])) + 1 - starts
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    place = ranges(np.zeros(len(starts), np.int64), widths)
    value = _mix[place & 63, data[inside]]
    long = place > 63
    if long.any():
        value[long] *= (place[long] >> 6).astype(np.uint64) * np.uint64(2) * _far + np.uint64(1)
    hashes = np.add.reduceat(value, np.cumsum(widths) - widths)
    return hashes, np.searchsorted(starts, at)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a text of numbers, by prefix doubling."""
    n, step = len(symbols), 1
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    while True:
        second = np.zeros(n, np.int64)
        second[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.diff(key[order], prepend=key[order[:1]]) != 0)
        rank[order] = new
        if not n or new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class Benchmark:
    """Test suffixes of one block of items."""

    def __init__(self, ids: list, texts: list[str | None], window: int):
        data, at = byte_view(pa.array(texts, pa.string()))
        hashes, begins = words(data, at)
        self.window, self.ids = window, ids
        self.vocabulary = np.unique(hashes)
        symbols = self.number(hashes)
        counts = np.diff(begins)
        # all suffixes; only those with a whole window, or of a short item's start, are windows
        item = np.repeat(np.arange(len(counts)), counts)
        place = ranges(np.zeros(len(counts), np.int64), counts)
        self.item, self.place, self.left = item, place, counts[item] - place
        self.text = np.concatenate([symbols, np.zeros(window + SEED, np.int64)])
        lengths = np.minimum(window, counts[item])
        whole = np.flatnonzero(self.left >= lengths)
        whole = whole[(counts[item[whole]] >= window) | (place[whole] == 0)]
        rows = np.where(np.arange(window) < lengths[whole][:, None], self.text[whole[:, None] + np.arange(window)], 0)
        unique, which = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64))
        self.rows, self.lengths = unique, (unique > 0).sum(axis=1)
        owned = np.unique(np.stack([which.ravel(), item[whole]], axis=1), axis=0) if len(rows) else np.zeros((0, 2), np.int64)
        self.owners, self.owner_at = owned[:, 1], np.searchsorted(owned[:, 0], np.arange(len(unique) + 1))
        size = len(self.vocabulary) + 1
        self.seeds = []
        seed = min(SEED, window)
        for n in range(1, seed + 1):
            # items of n words, or n words in a row of longer items if n is the seed length
            some = np.flatnonzero((counts[item] == n) & (place == 0) if n < seed else self.left >= n)
            self.seeds.append(np.unique(self.code(self.text, some, n, size)))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """1, 2, ... for words of the benchmark, 0 for others."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    @staticmethod
    def code(text: np.ndarray, at: np.ndarray, n: int, size: int) -> np.ndarray:
        held = text[at]
        for k in range(1, n):
            held = held * size + text[at + k]
        return held

    def shard(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stretches of ``symbols`` that can match, each followed by a 0; where they stand; their suffix array.

        symbols: 0 for unknown words and between documents.
        """
        size, n = len(self.vocabulary) + 1, len(symbols)
        symbols = np.concatenate([symbols, np.zeros(SEED, np.int64)])
        near = np.zeros(n + SEED + 1, np.int64)
        known = np.flatnonzero(symbols[:n])
        for k, seeds in enumerate(self.seeds, 1):
            some = known
            for j in range(1, k):
                some = some[symbols[some + j] > 0]
            if len(seeds) and len(some):
                code = self.code(symbols, some, k, size)
                at = np.minimum(np.searchsorted(seeds, code), len(seeds) - 1)
                some = some[seeds[at] == code]
                near[some] += 1
                near[some + k] -= 1
        inside = np.cumsum(near)[:n] > 0
        # a 0 behind each stretch
        ends = inside & ~np.concatenate([inside[1:], [False]]) if n else inside
        place = np.repeat(np.flatnonzero(inside), 1 + ends[inside])
        text = symbols[place]
        text[np.flatnonzero(np.diff(place, prepend=-1) == 0)] = 0
        return text, place, suffix_array(text)

    def bounds(self, text: np.ndarray, order: np.ndarray, rows: np.ndarray, lengths: np.ndarray, upper: bool) -> np.ndarray:
        """First suffix that is not below (upper: that is above) the first ``lengths`` words of each row."""
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(order), np.int64)
        padded = np.concatenate([text, np.full(rows.shape[1], -1, np.int64)])
        inside = np.arange(rows.shape[1]) < lengths[:, None]
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            held = padded[order[middle][:, None] + np.arange(rows.shape[1])]
            differ = (held != rows[open_]) & inside[open_]
            first = differ.argmax(axis=1)
            n = np.arange(len(open_))
            below = np.where(differ[n, first], held[n, first] < rows[open_][n, first], upper)
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]
        return low

    def places(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``symbols`` windows begin, and the number of the window."""
        text, place, order = self.shard(symbols)
        low = self.bounds(text, order, self.rows, self.lengths, False)
        high = self.bounds(text, order, self.rows, self.lengths, True)
        return place[order[ranges(low, high - low)]], np.repeat(np.arange(len(low)), high - low)

    def longest(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each test suffix the words of its longest match in ``symbols`` (under SEED: 0) and where it begins."""
        text, place, order = self.shard(symbols)
        n = len(self.item)
        best, where = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if not len(order) or not n:
            return best, where
        widest = int(self.left.max())
        padded = np.concatenate([text, np.full(widest + 1, -1, np.int64)])
        tests = np.concatenate([self.text, np.zeros(widest + 1, np.int64)])
        for begin in range(0, n, max(1, (1 << 21) // widest)):
            some = np.arange(begin, min(n, begin + max(1, (1 << 21) // widest)))
            inside = np.arange(widest) < self.left[some][:, None]
            rows = np.where(inside, tests[some[:, None] + np.arange(widest)], 0)
            at = self.bounds(text, order, rows, self.left[some], False)
            for neighbour in (at - 1, at):
                suffix = order[np.clip(neighbour, 0, len(order) - 1)]
                same = (padded[suffix[:, None] + np.arange(widest)] == rows) & inside
                n_same = np.where(same.all(axis=1), widest, (~same).argmax(axis=1))
                n_same[(neighbour < 0) | (neighbour >= len(order)) | (n_same < np.minimum(SEED, self.left[some]))] = 0
                more = n_same > best[some]
                best[some[more]], where[some[more]] = n_same[more], place[suffix[more]]
        return best, where


def _spread(benchmark: Benchmark, part: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of a shard with a 0 behind each document, where documents begin, and their numbers of words."""
    data, at = byte_view(part)
    hashes, begins = words(data, at)
    counts = np.diff(begins)
    starts = begins[:-1] + np.arange(len(counts))
    symbols = np.zeros(len(hashes) + len(counts), np.int64)
    symbols[ranges(starts, counts)] = benchmark.number(hashes)
    return symbols, starts, counts


def _blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> list[tuple[list, list]]:
    chosen = items.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t")).distinct()
    total = chosen.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes)
    for block in range(n):
        rows = chosen.filter(F.pmod(F.xxhash64("k", "t"), F.lit(n)) == block).collect()
        if rows:
            yield [r["k"] for r in rows], [r["t"] for r in rows]


def hits(docs: DataFrame, carry: list[str], text: str, items: DataFrame, item_key: str = "item_id",
         item_text: str = "text", window: int = 13, names: tuple[str, str, str, str] = ("n_words", "n_hit", "runs", "items"),
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``carry`` columns of every document, and under ``names``: its number of words, those hit, the first and
    last-but-one word numbers of each run hit (flat list), and the sorted item ids (strings) whose windows occur."""
    n = len(carry)
    fields = docs.select(*columns(carry)).schema.fields
    state = [T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType()),
             T.StructField(names[2], T.ArrayType(T.LongType())), T.StructField(names[3], T.ArrayType(T.StringType()))]
    held, = fresh([*docs.columns, *names], "held")
    out = docs.select(*columns(carry), docs[text].cast("string").alias(held))

    def one(block: tuple[list, list], first: bool, last: bool):
        benchmark = Benchmark(*block, window)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, n):
                symbols, starts, counts = _spread(benchmark, part.column(n))
                at, which = benchmark.places(symbols)
                marks = np.zeros(len(symbols) + 1, np.int64)
                np.add.at(marks, at, 1)
                np.add.at(marks, at + benchmark.lengths[which], -1)
                hit = np.cumsum(marks[:-1]) > 0
                doc = np.searchsorted(starts, at, side="right") - 1
                found: list[set] = [set() for _ in range(len(counts))]
                for d, w in np.unique(np.stack([doc, which], axis=1), axis=0).tolist():
                    owners = benchmark.owners[benchmark.owner_at[w]:benchmark.owner_at[w + 1]]
                    found[d].update(benchmark.ids[i] for i in owners if benchmark.ids[i] is not None)
                if not first:
                    for d, (runs, names_) in enumerate(zip(part.column(n + 3).to_pylist(), part.column(n + 4).to_pylist())):
                        found[d].update(names_)
                        for a, b in zip(runs[::2], runs[1::2]):
                            hit[starts[d] + a:starts[d] + b] = True
                edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
                of = np.searchsorted(starts, edges[::2], side="right") - 1
                runs_each = np.bincount(of, minlength=len(counts)) * 2
                ends = np.concatenate([[0], np.cumsum(hit)])
                columns = [
                    pa.array(counts), pa.array(ends[starts + counts] - ends[starts]),
                    lists(edges - np.repeat(starts[of], 2), runs_each, pa.int64()),
                    pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                ]
                kept = part.columns[:n] if last else part.columns[:n + 1]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*carry, *([] if last else [held]), *names])

        return run

    blocks = list(_blocks(items, item_key, item_text, block_bytes)) or [([], [])]
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        middle = [] if last else [T.StructField(held, T.StringType())]
        out = mapped(out, one(block, k == 0, last), T.StructType([*fields, *middle, *state]))
    return out


def longest_matches(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str = "item_id",
                    item_text: str = "text", window: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per item and ``key`` of a document in whose shard it stands: the longest verbatim match.

    Rows: item (string), item_word, key, doc_word, n_words.  Each shard answers
    every test suffix; per item the longest stays (ties: first word, smallest
    document).  Matches of fewer than SEED words are not reported unless they
    are the whole item.
    """
    key_type = docs.schema[key].dataType
    schema = T.StructType([T.StructField("item", T.StringType()), T.StructField("item_word", T.LongType()),
                           T.StructField(key, key_type), T.StructField("doc_word", T.LongType()), T.StructField("n_words", T.LongType())])
    chosen = docs.select(docs[key], docs[text].cast("string").alias("_text"))
    parts = []
    for block in _blocks(items, item_key, item_text, block_bytes):
        def run(batches: Iterable[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            benchmark = Benchmark(*block, window)
            for part in slices(batches, 1):
                symbols, starts, _ = _spread(benchmark, part.column(1))
                n, at = benchmark.longest(symbols)
                some = np.flatnonzero(n)
                doc = np.searchsorted(starts, at[some], side="right") - 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([benchmark.ids[i] for i in benchmark.item[some]], pa.string()), pa.array(benchmark.place[some]),
                    part.column(0).take(pa.array(doc)), pa.array(at[some] - starts[doc]), pa.array(n[some])], names=schema.names)

        parts.append(mapped(chosen, run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.min(F.struct((-F.col("n_words")).alias("n"), "item_word", F.col(key), "doc_word"))
    return found.groupBy("item").agg(best.alias("b")).select(
        "item", "b.item_word", f"b.{key}", "b.doc_word", (-F.col("b.n")).alias("n_words"))


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit", share: int = 20):
    """A word is hit, and at least one in ``share`` words is."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * share >= F.col(n_words))


def clean(docs: DataFrame, text: str, items: DataFrame, item_key: str = "item_id", item_text: str = "text",
          window: int = 13, share: int = 20) -> DataFrame:
    """``docs`` without the contaminated documents, all columns as they were."""
    names = tuple(fresh(docs.columns, "words", "hit", "runs", "items"))
    marked = hits(docs, docs.columns, text, items, item_key, item_text, window, names)
    return marked.filter(~contaminated(names[0], names[1], share)).select(*columns(docs.columns))
