"""A network of one hidden layer, trained by mini-batches whose gradients tasks sum up.

Hidden units are rectified, the output is the chance of label 1.  Rows are dealt
to batches once, by seed and content, and written batch by batch, so an epoch
reads every row once: a task adds up loss and gradient of its part, the parts are
added by parameter, and only one sum a parameter reaches the driver, which steps
with momentum.  A lost executor costs the batch it was working on.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import remove_path, scratch_path

#: Parameters that may travel with every task (8 bytes each).
MOST_PARAMETERS = 4_000_000


@dataclass
class Network:
    """Weights into the hidden units and out of them."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w1.ravel(), self.b1, self.w2, [self.b2]])

    def moved(self, by: np.ndarray) -> Network:
        new, d, h = self.flat() + by, *self.w1.shape
        return Network(new[:d * h].reshape(d, h), new[d * h:d * h + h], new[d * h + h:-1], float(new[-1]))

    def logits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(x @ self.w1 + self.b1, 0)
        return hidden, hidden @ self.w2 + self.b2


def first_network(size: int, hidden: int, seed: int) -> Network:
    """Uniform weights between plus and minus the root of 6 over a layer's sides, no constants."""
    rng = np.random.default_rng(seed)
    if size * hidden > MOST_PARAMETERS:
        raise ValueError(f"more than {MOST_PARAMETERS} parameters")
    one, two = np.sqrt(6 / (size + hidden)), np.sqrt(6 / (hidden + 1))
    return Network(rng.uniform(-one, one, (size, hidden)), np.zeros(hidden), rng.uniform(-two, two, hidden), 0.0)


def sums(net: Network, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Summed over rows: the gradient of every parameter, the loss, right calls, rows."""
    hidden, z = net.logits(x)
    loss = np.logaddexp(0, z) - y * z
    out = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
    back = np.outer(out, net.w2) * (hidden > 0)
    return np.concatenate([(x.T @ back).ravel(), back.sum(0), hidden.T @ out, [out.sum(), loss.sum(), ((z >= 0) == (y == 1)).sum(), len(y)]])


def batch_number(vector: str, label: str, batches: int, seed: int) -> Column:
    """The batch of a row; copies of a row share one."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(vector), F.col(label)), F.lit(batches)).cast("int")


def _added(rows: DataFrame, net: Network) -> np.ndarray:
    """``sums`` over all rows of a frame (vector, label)."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    many = len(net.flat()) + 3

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(many)
        for frame in frames:
            if len(frame):
                total += sums(net, np.stack(frame.iloc[:, 0].to_numpy()).astype("float64"), frame.iloc[:, 1].to_numpy("float64"))
        yield pd.DataFrame({"place": np.arange(many), "value": total})

    parts = rows.mapInPandas(run, "place long, value double")
    out = np.zeros(many)
    for place, value in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[place] = value
    return out


def _checked(df: DataFrame, vector: str, label: str) -> tuple[DataFrame, int]:
    rows = df.select(F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("double").alias("label"))
    odd = F.exists("vector", lambda v: v.isNull() | F.isnan(v))
    low, high, bad, n = rows.agg(
        F.min(F.size("vector")), F.max(F.size("vector")), F.count_if(F.coalesce(odd, F.lit(True)) | F.col("label").isNull()), F.count(F.lit(1))).first()
    if not n or bad or low != high:
        raise ValueError(f"{n} rows, {bad} of them with a null or no number; vectors of {low} to {high} numbers")
    return rows, low


HISTORY = "epoch int, loss double, accuracy double, val_accuracy double, saved boolean"


def train(df: DataFrame, vector: str, label: str, hidden: int = 64, step: float = 0.01, momentum: float = 0.0, epochs: int = 10,
          batches: int = 1, seed: int = 42, validation: DataFrame | None = None) -> tuple[Network, DataFrame]:
    """The network of the epoch with the best accuracy on ``validation``, and the history.

    ``step`` is the learning rate; a batch moves the weights by ``momentum``
    times the last move less ``step`` times its mean gradient.  Loss and
    accuracy of an epoch are means over its batches as they pass, val_accuracy
    is measured after it (without ``validation`` it is that accuracy).  Nulls
    and vectors of different sizes are refused.
    """
    spark = df.sparkSession
    rows, size = _checked(df, vector, label)
    judged = None if validation is None else _checked(validation, vector, label)[0]
    path = scratch_path(spark, "batches")
    try:
        rows.withColumn("batch", batch_number("vector", "label", batches, seed)).write.partitionBy("batch").parquet(path)
        dealt = spark.read.parquet(path)
        net, rng, last = first_network(size, hidden, seed), np.random.default_rng(seed + 1), 0.0
        best, kept, history = -1.0, None, []
        for epoch in range(1, epochs + 1):
            seen = np.zeros(3)
            for number in rng.permutation(batches):
                got = _added(dealt.filter(F.col("batch") == int(number)).select("vector", "label"), net)
                if got[-1]:
                    last = momentum * last - step * got[:-3] / got[-1]
                    net, seen = net.moved(last), seen + got[-3:]
            accuracy = value = float(seen[1] / seen[2])
            if judged is not None:
                _, right, n = _added(judged, net)[-3:]
                value = float(right / n)
            history.append((epoch, float(seen[0] / seen[2]), accuracy, value, value > best))
            if value > best:
                best, kept = value, net
    finally:
        remove_path(spark, path)
    return kept, spark.createDataFrame(history, HISTORY)


def predict(net: Network, df: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and the chance of label 1."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    names = [*keep, "probability"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame.iloc[:, :-1].copy()
            x = np.stack(frame.iloc[:, -1].to_numpy()).astype("float64") if len(frame) else np.zeros((0, len(net.w1)))
            out["probability"] = 1 / (1 + np.exp(-np.clip(net.logits(x)[1], -500, 500)))
            out.columns = names
            yield out

    rows = df.select(*keep, F.col(vector).cast("array<double>").alias("_vector"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields]
    return rows.mapInPandas(run, ", ".join([*fields, "probability double"]))
