"""Toxicity as a compression distance between zstandard dictionaries.

Training takes a bounded number of labelled documents, each as a whole: tasks
count their strings and work out their gains, the driver gets the strings that
mark a class, one row of gains a document and the dictionaries.  All
dictionaries begin with the same ordinary prose; behind it stand, in each, the
strings that mark its class: runs of short strings that occur in clearly more
documents of the class than those of the other let expect.  There is one
ordinary dictionary and a toxic one for each line of GRAMS: one for short
strings that ordinary text hardly has, one for longer strings that it has less
often.  What the dictionaries share compresses alike, so the lengths differ
where a mark of one class stands.

A text is cut into windows of about WINDOW bytes at blanks, twice, the second
time half a window off.  The gain of a window is its compressed length with the
ordinary dictionary less that with a toxic one.  Counts, shares and maxima of
the gains go through a logistic function that is calibrated on labelled
documents that the dictionaries have not seen; 0.5 is its threshold.

Null and empty texts have no windows and get the score of a text without gains.
Without labels of both classes every score is the share of toxic labels, 0 if
there are none.  A document labelled more than once counts as toxic if any of
its labels does; null labels and null ids are left out of training.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import columns, fresh, mapped, slices
from millrace.llm.scratch import Scratch

#: Labelled documents of each class that training takes at most.
PER_CLASS = 2500
WINDOW, LEVEL = 64, 6
#: Bytes of prose that all dictionaries share, and of marks in each.
SHARED, MARKED = 8192, 16384
#: Kinds of marks: bytes of a string, times and standard deviations that it occurs in more documents than expected.
GRAMS = ((5, 40, 4), (8, 7, 8))
#: Share of its class's documents that a mark occurs in, and share of a mark's strings that no other mark has.
SUPPORT, NEW = 0.006, 0.5
GAINS = (2, 3, 4, 5, 6)
#: The dictionaries' marks: class, then a line of GRAMS.  The ordinary dictionary comes first.
KINDS = ((0, *GRAMS[0]), *((1, *kind) for kind in GRAMS))
#: Counted strings that a task hands over at a time.
COUNTED = 1 << 18


def windows(text: str | None) -> list[bytes]:
    """Windows of a text, ASCII letters lower-cased and white space made blanks."""
    if not text:
        return []
    held = b" ".join(text.encode().lower().split())
    if not held:
        return []
    blanks = np.flatnonzero(np.frombuffer(held, np.uint8) == 32)
    out = []
    for shift in (0, WINDOW // 2):
        cuts = np.arange(WINDOW - shift, len(held), WINDOW)
        if len(blanks):
            # a cut moves back to a blank unless a long word is in the way
            at = blanks[np.maximum(np.searchsorted(blanks, cuts, side="right") - 1, 0)]
            cuts = np.where((at <= cuts) & (cuts - at < WINDOW // 2), at, cuts)
        ends = [0, *cuts.tolist(), len(held)]
        out += [held[a:b] for a, b in zip(ends[:-1], ends[1:]) if b > a]
    return out


def _grams(held: bytes, size: int) -> np.ndarray:
    """All strings of ``size`` bytes (8 at most) of a text, as numbers."""
    data = np.frombuffer(held, np.uint8).astype(np.uint64)
    if len(data) < size:
        return np.zeros(0, np.uint64)
    grams = np.zeros(len(data) - size + 1, np.uint64)
    for k in range(size):
        grams = grams << np.uint64(8) | data[k:len(data) - size + 1 + k]
    return grams


def _plain(text: str) -> bytes:
    return b" " + b" ".join(text.encode().lower().split()) + b" "


def _counted(rows: DataFrame) -> DataFrame:
    """(size, gram, n0, n1): documents (t, y) of each class that hold a string."""
    schema = T.StructType([T.StructField("size", T.IntegerType()), *(T.StructField(x, T.LongType()) for x in ("gram", "n0", "n1"))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            toxic = part.column(1).to_numpy(zero_copy_only=False)
            held = [_plain(t) for t in part.column(0).to_pylist()]
            for size in sorted({kind[0] for kind in GRAMS}):
                each = [np.unique(_grams(t, size)) for t in held]
                grams, which = np.unique(np.concatenate(each), return_inverse=True)
                bad = np.bincount(which, np.repeat(toxic, [len(x) for x in each]), len(grams)).astype(np.int64)
                good = np.bincount(which, minlength=len(grams)) - bad
                for at in range(0, len(grams), COUNTED):
                    some = slice(at, at + COUNTED)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(grams[some]), size, np.int32)), pa.array(grams[some].view(np.int64)), pa.array(good[some]),
                        pa.array(bad[some])], names=schema.names)

    return mapped(rows, run, schema).groupBy("size", "gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _marking(rows: DataFrame, n: tuple[int, int]) -> list[np.ndarray]:
    """For each of KINDS the strings in clearly more documents of its class than those of the other let expect; n: documents of each class."""
    found = []
    for k, (own, size, lift, clear) in enumerate(KINDS):
        here, expected = F.col(f"n{own}"), (F.col(f"n{1 - own}") + 1) * (n[own] / max(1, n[1 - own]))
        above = (here - expected) / F.sqrt(expected + 1)
        marks_ = (F.col("size") == size) & (here >= max(4, SUPPORT * n[own])) & (above >= clear) & (here >= lift * expected)
        found.append(F.when(marks_, F.lit(k)))
    kinds = F.filter(F.array(*found), lambda x: x.isNotNull())
    held = _counted(rows).select(F.explode(kinds).alias("kind"), "gram").toArrow()
    kind, gram = held["kind"].to_numpy(), held["gram"].to_numpy().view(np.uint64)
    return [np.sort(gram[kind == k]) for k in range(len(KINDS))]


def _runs(rows: DataFrame, grams: list[np.ndarray]) -> DataFrame:
    """(kind, run, n): unbroken stretches of a kind's strings in the documents (t, y) of its class, and how often they occur.

    Stretches longer than all marks together may be cannot become one.
    """
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("run", T.BinaryType()), T.StructField("n", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            runs = Counter()
            for t, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                text = _plain(t)
                for kind, (own, size, *_) in enumerate(KINDS):
                    hit = np.flatnonzero(np.isin(_grams(text, size), grams[kind])) if y == own else ()
                    if not len(hit):
                        continue
                    first = np.flatnonzero(np.diff(hit, prepend=-9) > 1)
                    for a, b in zip(hit[first].tolist(), [*hit[first[1:] - 1].tolist(), int(hit[-1])]):
                        if b + size - a <= MARKED:
                            runs[kind, text[a:b + size]] += 1
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in runs], pa.int32()), pa.array([x[1] for x in runs], pa.binary()),
                                              pa.array(runs.values(), pa.int64())], names=schema.names)

    return mapped(rows, run, schema).groupBy("kind", "run").agg(F.sum("n").alias("n"))


def marks(rows: DataFrame, n: tuple[int, int]) -> list[bytes]:
    """For each of KINDS the strings that mark its class in the documents (t, y), the most frequent last."""
    kept, covered, held = defaultdict(list), defaultdict(set), Counter()
    # one row after the other, a partition at a time
    for kind, run, _ in _runs(rows, _marking(rows, n)).orderBy("kind", F.desc("n"), "run").toLocalIterator():
        if held[kind] + len(run) > MARKED:
            continue
        run, size = bytes(run), KINDS[kind][1]
        parts = {run[i:i + size] for i in range(len(run) - size + 1)}
        new = parts - covered[kind]
        # what is mostly there already would add chance matches, not marks
        if len(new) >= NEW * len(parts):
            kept[kind].append(run)
            covered[kind] |= parts
            held[kind] += len(run)
    return [b"".join(reversed(kept[kind])) for kind in range(len(KINDS))]


class Gains:
    """Compressed length with the ordinary dictionary less that with the toxic one."""

    def __init__(self, ordinary: bytes, toxic: list[bytes]):
        self.ordinary, self.toxic = self._compressor(ordinary), [self._compressor(t) for t in toxic]

    @staticmethod
    def _compressor(content: bytes):
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=WINDOW, dict_size=SHARED, min_match=3, write_content_size=0, write_checksum=0, write_dict_id=0,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=params).compress

    def __call__(self, parts: list[bytes]) -> np.ndarray:
        """A row for each window, a column for each toxic dictionary."""
        plain = np.array([len(self.ordinary(x)) for x in parts], np.float64)
        return plain[:, None] - np.array([[len(c(x)) for x in parts] for c in self.toxic], np.float64).T

    def features(self, text: str | None) -> np.ndarray:
        parts = windows(text)
        every = self(parts) if parts else np.zeros((1, len(self.toxic)))
        out = [np.log1p(len(every))]
        for gains in every.T:
            over = gains[:, None] >= np.array(GAINS)
            out += [gains.max(), np.sort(gains)[-3:].mean(), np.maximum(gains - 2, 0).mean(), gains.mean(),
                    *np.log1p(over.sum(axis=0)), *over.mean(axis=0)]
        return np.array(out)


@dataclass
class Model:
    share: float
    ordinary: bytes = b""
    toxic: list[bytes] = field(default_factory=list)
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None

    def score(self, gains: Gains | None, text: str | None) -> float:
        if self.weights is None:
            return self.share
        row = (gains.features(text) - self.mean) / self.spread
        return float(1 / (1 + np.exp(-np.clip(row @ self.weights[:-1] + self.weights[-1], -500, 500))))


def _shared(rows: DataFrame, n: int) -> bytes:
    """Prose from the middle of ``n`` documents (i, t), in the order of i."""
    each = max(16, SHARED // n)
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("piece", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            held = [_plain(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([t[len(t) // 2:len(t) // 2 + each] for t in held], pa.binary())], names=schema.names)

    return b"".join(bytes(r["piece"]) for r in sorted(mapped(rows, run, schema).collect(), key=lambda r: r["i"]))[:SHARED]


def _features(rows: DataFrame, ordinary: bytes, toxic: list[bytes]) -> dict[int, list[float]]:
    """Features of the documents (i, t)."""
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("row", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(ordinary, toxic)
        for part in slices(batches, 1):
            found = [gains.features(t).tolist() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.float64()))], names=schema.names)

    return {r["i"]: r["row"] for r in mapped(rows, run, schema).collect()}


def fit(rows: DataFrame, toxic: list[int], share: float) -> Model:
    """Dictionaries from two thirds of the texts, the logistic function from the rest.

    rows: number (0, 1, ...), whole text and class of each document, as i, t and
    y; they are read several times.  toxic: the classes by number.
    share: that of toxic documents among all labelled ones; the classes of the
    sample are weighted to it.
    """
    build = [y for i, y in enumerate(toxic) if i % 3]
    rest = range(0, len(toxic), 3)
    n = len(build) - sum(build), sum(build)
    label = np.array([toxic[i] for i in rest], np.float64)
    if not all(n) or not 0 < label.sum() < len(label):
        return Model(share)
    built = rows.filter("i % 3 <> 0")
    shared = _shared(built.filter("y = 0").select("i", "t"), n[0])
    ordinary, *bad = (shared + x for x in marks(built.select("t", "y"), n))
    model = Model(share, ordinary, bad)
    found = _features(rows.filter("i % 3 = 0").select("i", "t"), model.ordinary, model.toxic)
    rows = np.array([found[i] for i in rest])
    model.mean, model.spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    x = np.column_stack([(rows - model.mean) / model.spread, np.ones(len(rows))])
    weight = np.where(label == 1, share / label.mean(), (1 - share) / (1 - label.mean()))
    w, ridge = np.zeros(x.shape[1]), 1e-3 * len(x)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (p - label)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    model.weights = w
    return model


def learn(docs: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, chosen: Column,
          per_class: int = PER_CLASS) -> Model:
    """A model from the labels whose rows are ``chosen``: at most ``per_class`` documents of each class, by the hash of the key."""
    marked = labels.filter(chosen & labels[label].isNotNull() & labels[label_key].isNotNull()).groupBy(
        labels[label_key].alias("k")).agg(F.max(labels[label].cast("int")).alias("y"))
    counts = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return Model(0.0)
    few = None
    for y, n in sorted(counts.items()):
        # a share by hash first, so that no more than a few times the bound is ordered
        share = F.pmod(F.xxhash64(F.lit("share"), "k"), F.lit(1 << 20)) < 4.0 * per_class / n * (1 << 20)
        some = marked.filter((F.col("y") == y) & share).orderBy(F.xxhash64("k"), "k").limit(per_class)
        few = some if few is None else few.unionByName(some)
    # at most 2 * per_class rows of two numbers; of texts with the same key the least
    texts = docs.select(docs[key].alias("k"), docs[text].cast("string").alias("t")).filter("t <> ''")
    scratch = Scratch(docs.sparkSession, "toxicity")
    held = scratch.write(texts.join(F.broadcast(few), "k").groupBy("k", "y").agg(F.min("t").alias("t")), "sample")
    keys = sorted((r["k"], int(r["y"] > 0)) for r in held.select("k", "y").collect())
    model = Model(sum(n for y, n in counts.items() if y > 0) / total)
    if keys:
        numbers = docs.sparkSession.createDataFrame([(k, i, y) for i, (k, y) in enumerate(keys)], T.StructType([
            held.schema["k"], T.StructField("i", T.LongType()), T.StructField("y", T.IntegerType())]))
        model = fit(held.select("k", "t").join(F.broadcast(numbers), "k").select("i", "t", "y"), [y for _, y in keys], model.share)
    scratch.drop("sample")
    return model


def score(docs: DataFrame, carry: list[str], text: str, model: Model, name: str = "score") -> DataFrame:
    """``carry`` columns and the score (0 to 1) of every whole text."""
    n = len(carry)
    schema = T.StructType([*docs.select(*columns(carry)).schema.fields, T.StructField(name, T.DoubleType())])
    held, = fresh([*docs.columns, name], "held")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(model.ordinary, model.toxic) if model.weights is not None else None
        for part in slices(batches, n):
            found = [model.score(gains, t) for t in part.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(found, pa.float64())], names=[*carry, name])

    return mapped(docs.select(*columns(carry), docs[text].cast("string").alias(held)), run, schema)
