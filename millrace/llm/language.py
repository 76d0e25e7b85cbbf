"""Language identification by a convolutional network over bytes, in numpy.

A text is cut into windows of WINDOW bytes (the last one padded with zeros) that
overlap by the widest filter less one, so no run of bytes is lost at a border.
Bytes are embedded, filters of several widths run over them, each filter keeps
its maximum over the window, and a softmax layer gives the languages.  The
probabilities of a text are those of its windows, weighted by their bytes.

The network is trained on the driver on at most ``per_language`` labelled
windows a language, one of each document, chosen by the hash of the text.  Every
label found is learned; what the driver holds grows with their number.
Scoring reads whole texts.  A text that is null or has no letter is ``und`` with
score 0, and so is every text if nothing is labelled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import byte_view, columns, fresh, mapped, ranges, slices
from millrace.llm.scratch import Scratch

#: Bytes of a window, filter widths, filters of each width, size of a byte's vector.
WINDOW, WIDTHS, FILTERS, VECTOR = 256, (2, 3, 4), 16, 8
#: Labelled windows a language that training takes at most.
PER_LANGUAGE = 2000
EPOCHS, BATCH, RATE = 6, 64, 0.004
#: Steps that training takes at least, however few the windows.
STEPS = 400
UNKNOWN = "und"
_letter = regex.compile(r"\p{L}")


@dataclass
class Network:
    languages: list[str]
    vectors: np.ndarray  # (256, VECTOR); byte 0 is padding
    filters: np.ndarray  # (widest * VECTOR, filters of all widths)
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray, where: bool = False):
        """Maximum of each filter over each window (rows of bytes); where: the rows of vectors and the places too."""
        n, widest = len(windows), max(WIDTHS)
        held = self.vectors[windows]
        places = windows.shape[1] - widest + 1
        rows = np.lib.stride_tricks.as_strided(
            held, (n, places, widest * VECTOR), (held.strides[0], held.strides[1], held.strides[2]))
        rows = np.ascontiguousarray(rows)
        each = (rows.reshape(-1, widest * VECTOR) @ self.filters).reshape(n, places, -1)
        if not where:
            return np.maximum(each.max(axis=1) + self.bias, 0)
        at = each.argmax(axis=1)
        return np.maximum(np.take_along_axis(each, at[:, None], 1)[:, 0] + self.bias, 0), rows, at

    def __call__(self, windows: np.ndarray) -> np.ndarray:
        """Probability of each language for each window."""
        out = np.empty((len(windows), len(self.languages)), np.float64)
        for begin in range(0, len(windows), 128):
            logits = self.pooled(windows[begin:begin + 128]) @ self.out + self.out_bias
            raised = np.exp((logits - logits.max(axis=1, keepdims=True)).astype(np.float64))
            out[begin:begin + 128] = raised / raised.sum(axis=1, keepdims=True)
        return out


def _width_mask() -> np.ndarray:
    rows = np.arange(max(WIDTHS) * VECTOR)[:, None] // VECTOR
    return (rows < np.repeat(WIDTHS, FILTERS)[None, :]).astype(np.float32)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam on the cross entropy; each epoch cuts the windows to other lengths, so that short texts are known too."""
    rng, mask = np.random.default_rng(seed), _width_mask()
    normal = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    net = Network(languages, normal(256, VECTOR), normal(*mask.shape) * mask, np.zeros(mask.shape[1], np.float32),
                  normal(mask.shape[1], len(languages)), np.zeros(len(languages), np.float32))
    net.vectors[0] = 0
    params = [net.vectors, net.filters, net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    widest, step = max(WIDTHS), 0
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(windows)))):
        order = rng.permutation(len(windows))
        for begin in range(0, len(order), BATCH):
            some = order[begin:begin + BATCH]
            cut = windows[some].copy()
            keep = np.where(rng.random(len(some)) < 0.5, WINDOW, rng.integers(16, WINDOW + 1, len(some)))
            cut[np.arange(WINDOW) >= keep[:, None]] = 0
            pooled, rows, at = net.pooled(cut, where=True)
            logits = pooled @ net.out + net.out_bias
            raised = np.exp(logits - logits.max(axis=1, keepdims=True))
            slope = raised / raised.sum(axis=1, keepdims=True)
            slope[np.arange(len(some)), labels[some]] -= 1
            slope /= len(some)
            back = (slope @ net.out.T) * (pooled > 0)
            best = rows[np.arange(len(some))[:, None], at]  # (windows, filters, widest * VECTOR)
            to_filters = np.einsum("nfk,nf->kf", best, back) * mask
            to_rows = back[:, :, None] * net.filters.T[None]
            to_vectors = np.zeros_like(net.vectors)
            touched = np.take_along_axis(cut, (at[:, :, None] + np.arange(widest)).reshape(len(some), -1), 1)
            np.add.at(to_vectors, touched.ravel(), to_rows.reshape(-1, VECTOR))
            to_vectors[0] = 0
            step += 1
            slopes = [to_vectors, to_filters, back.sum(axis=0), pooled.T @ slope, slope.sum(axis=0)]
            for p, g, m, v in zip(params, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def _windows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, the text of each and its bytes."""
    step, sizes = WINDOW - max(WIDTHS) + 1, np.diff(at)
    counts = np.maximum(1, -(-(sizes - max(WIDTHS) + 1) // step)) * (sizes > 0)
    of = np.repeat(np.arange(len(sizes)), counts)
    begins = ranges(np.zeros(len(sizes), np.int64), counts) * step
    left = np.minimum(WINDOW, sizes[of] - begins)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    held = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[at[of] + begins]
    held[np.arange(WINDOW) >= left[:, None]] = 0
    return held, of, left


def sample(docs: DataFrame, text: str, lang: str, learn: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, piece): one stretch of at most WINDOW characters a document, at most ``per_language`` a language."""
    whole = docs[text].cast("string")
    begin = F.pmod(F.xxhash64(whole, F.lit("begin")), F.greatest(F.length(whole) - WINDOW + 1, F.lit(1))).cast("int") + 1
    rows = docs.filter(learn & docs[lang].isNotNull() & docs[text].isNotNull()).select(
        docs[lang].cast("string").alias("lang"), F.xxhash64(whole).alias("h"), F.substring(whole, begin, F.lit(WINDOW)).alias("piece"))
    # a share by hash leaves a few times the bound, however many texts a language has; copies of a text count once
    texts = rows.select("lang", "h").distinct()
    # written, so that the planner knows its size before it chooses the join
    counts = Scratch(docs.sparkSession, "language").write(texts.groupBy("lang").agg(F.count("*").alias("n")), "counts")
    share = F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < F.lit(4.0 * per_language * (1 << 20)) / F.col("n")
    rows = rows.join(counts, "lang").filter(share).select("lang", "h", "piece").distinct()
    order = Window.partitionBy("lang").orderBy("h", "piece")
    return rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language).select("lang", "piece")


def learn(docs: DataFrame, text: str, lang: str, chosen: Column, per_language: int = PER_LANGUAGE) -> Network | None:
    """A network trained on the chosen rows; None if none is labelled."""
    rows = sorted((r["lang"], r["piece"]) for r in sample(docs, text, lang, chosen, per_language).collect() if _letter.search(r["piece"]))
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    windows = np.zeros((len(rows), WINDOW), np.uint8)
    for row, (_, piece) in zip(windows, rows):
        held = piece.encode()[:WINDOW]
        row[:len(held)] = np.frombuffer(held, np.uint8)
    return train(windows, np.searchsorted(languages, [r[0] for r in rows]), languages)


def predict(docs: DataFrame, carry: list[str], text: str, net: Network | None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``carry`` columns of every row, and under ``names`` its language and the probability of that."""
    n = len(carry)
    schema = T.StructType([*docs.select(*columns(carry)).schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    held, = fresh([*docs.columns, *names], "held")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, n):
            data, at = byte_view(part.column(n))
            k = part.num_rows
            upper = data & 0xDF
            plain = np.concatenate([[0], np.cumsum((upper >= 65) & (upper <= 90))])
            lettered = plain[at[1:]] > plain[at[:-1]]
            for i in np.flatnonzero(~lettered & (np.diff(at) > 0)):
                lettered[i] = bool(_letter.search(part.column(n)[int(i)].as_py()))
            best, score = np.full(k, -1), np.zeros(k)
            if net is not None:
                windows, of, sizes = _windows(data, at)
                each = np.zeros((k, len(net.languages)))
                chances = net(windows) * sizes[:, None]
                begins = np.flatnonzero(np.diff(of, prepend=-1))
                if len(begins):
                    each[of[begins]] = np.add.reduceat(chances, begins, axis=0)
                each /= np.maximum(1e-300, each.sum(axis=1, keepdims=True))
                best, score = each.argmax(axis=1), np.minimum(1.0, each.max(axis=1))
                best[~lettered], score[~lettered] = -1, 0.0
            called = [*(net.languages if net is not None else []), UNKNOWN]
            yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array([called[b] for b in best], pa.string()), pa.array(score)],
                                             names=[*carry, *names])

    return mapped(docs.select(*columns(carry), docs[text].cast("string").alias(held)), run, schema)


def held_out(key: str | Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the key as text falls in the fold kept for testing; a null key does not."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def known_language(docs: DataFrame, text: str, lang: str, key: str, least: float = 0.3) -> DataFrame:
    """``docs`` without texts of no language: null, without a letter, or no language with a probability of ``least``.

    With more than six languages the bar is twice the probability of a guess, if that is lower.
    If no row to learn from is labelled, no language can be told: every text with a letter stays.
    """
    net = learn(docs, text, lang, ~held_out(docs[key]))
    if net is None:
        return docs.filter(F.rlike(docs[text].cast("string"), F.lit(r"\p{L}"))).select(*columns(docs.columns))
    names = tuple(fresh(docs.columns, "lang", "score"))
    found = predict(docs, docs.columns, text, net, names)
    return found.filter((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= min(least, 2 / len(net.languages)))).select(*columns(docs.columns))
