"""Jobs on images held as flat arrays (row by row, channels last)."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of the network input, filters, kernel, pool and hidden units.
TARGET = (150, 150)
FILTERS, KERNEL, POOL, HIDDEN = 32, 3, 2, 64


def _gather(pixels: Column, height: int, width: int, channels: int, source) -> Column:
    """New image whose pixel (y, x) is taken from the flat index ``source(y, x, channel)``."""
    def value(p: Column) -> Column:
        y = F.floor(p / F.lit(width * channels))
        x = F.floor(p / F.lit(channels)) % width
        return F.get(pixels, source(y, x, p % channels).cast("int"))

    return F.transform(F.sequence(F.lit(0), F.lit(height * width * channels - 1)), value)


def nearest_resize(pixels: Column, height: Column, width: Column, channels: int, target: tuple[int, int] = TARGET) -> Column:
    """Nearest-neighbour resize: output i reads input floor((i + 0.5) * size / target)."""
    rows, cols = target
    # Whole-number form of the rule, so that no rounding shifts a pixel.
    pick = lambda i, size, n: F.floor((i * 2 + 1) * size / F.lit(2 * n))
    return _gather(pixels, rows, cols, channels,
                   lambda y, x, c: (pick(y, height, rows) * width + pick(x, width, cols)) * channels + c)


def rescale(pixels: Column, by: float = 255.0) -> Column:
    return F.transform(pixels, lambda v: v.cast("double") / F.lit(by))


def augment(
    pixels: Column, height: int, width: int, channels: int, flip: Column, dx: Column, dy: Column,
    degrees: Column | None = None, zoom: Column | None = None,
) -> Column:
    """Flip, shift, rotate about the centre and zoom; edges repeat the nearest pixel.

    Each output pixel is traced back to its nearest input pixel.
    """
    cy, cx = (height - 1) / 2, (width - 1) / 2
    angle = F.radians(F.lit(0.0) if degrees is None else degrees)
    scale = F.lit(1.0) if zoom is None else zoom
    clamp = lambda v, n: F.greatest(F.least(F.floor(v + 0.5), F.lit(n - 1)), F.lit(0))

    def source(y, x, c):
        x = F.when(flip, F.lit(width - 1) - x).otherwise(x)
        v, u = (y - cy) * scale, (x - cx) * scale
        sy = F.sin(angle) * u + F.cos(angle) * v + cy + dy
        sx = F.cos(angle) * u - F.sin(angle) * v + cx + dx
        return (clamp(sy, height) * width + clamp(sx, width)) * channels + c

    return _gather(pixels, height, width, channels, source)


def seeded_unit(key: Column, seed: int, name: str) -> Column:
    """Number in [0, 1) fixed by (seed, name, key)."""
    digest = F.md5(F.concat(F.lit(f"{seed}|{name}|"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def seeded_augment(
    df: DataFrame, key: str, pixels: str, height: int, width: int, channels: int, seed: int,
    rotation: float = 50.0, shift: float = 0.1, zoom: float = 0.1,
) -> DataFrame:
    """Each image changed at random within the limits, the same on every run."""
    between = lambda name, low, high: F.lit(low) + seeded_unit(F.col(key), seed, name) * F.lit(high - low)
    drawn = df.withColumns({
        "_flip": seeded_unit(F.col(key), seed, "flip") < 0.5,
        "_dx": between("dx", -shift, shift) * width, "_dy": between("dy", -shift, shift) * height,
        "_deg": between("deg", -rotation, rotation), "_zoom": between("zoom", 1 - zoom, 1 + zoom),
    })
    new = augment(F.col(pixels), height, width, channels, F.col("_flip"), F.col("_dx"), F.col("_dy"), F.col("_deg"), F.col("_zoom"))
    return drawn.withColumn(pixels, new).drop("_flip", "_dx", "_dy", "_deg", "_zoom")


#: Bytes of weights that may be sent to every executor.
MOST_WEIGHTS = 256 << 20


def forward(images: np.ndarray, weights: dict[str, np.ndarray]) -> np.ndarray:
    """Convolution, relu, pooling, dense relu, dense sigmoid for a batch (n, h, w, c)."""
    windows = np.lib.stride_tricks.sliding_window_view(images, (KERNEL, KERNEL), axis=(1, 2))
    conv = np.maximum(np.einsum("nyxcij,ijcf->nyxf", windows, weights["conv"], optimize=True) + weights["conv_bias"], 0)
    n, h, w, f = conv.shape
    pooled = conv[:, : h // POOL * POOL, : w // POOL * POOL].reshape(n, h // POOL, POOL, w // POOL, POOL, f).max(axis=(2, 4))
    hidden = np.maximum(pooled.reshape(n, -1) @ weights["dense"] + weights["dense_bias"], 0)
    return 1 / (1 + np.exp(-(hidden @ weights["out"] + weights["out_bias"])))[:, 0]


def score_images(df: DataFrame, key: str, pixels: str, shape: tuple[int, int, int], weights: dict[str, np.ndarray],
                 batch: int = 64) -> DataFrame:
    """Class probability per image.

    The network has a fixed size, so its weights are sent once per executor;
    images are scored in small batches to bound memory.
    """
    # Workers get the functions of this module sent along and need no installed package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    if sum(w.nbytes for w in weights.values()) > MOST_WEIGHTS:
        raise ValueError(f"weights of more than {MOST_WEIGHTS} bytes")
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                images = np.stack(part["pixels"].to_numpy()).astype("float64").reshape(-1, *shape)
                yield pd.DataFrame({key: part[key].to_numpy(), "probability": forward(images, sent.value)})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, F.col(pixels).alias("pixels")).mapInPandas(run, f"{key} {kind}, probability double")


def load_weights(path: str) -> dict[str, np.ndarray]:
    with np.load(path) as stored:
        return {k: stored[k] for k in stored.files}


def random_weights(shape: tuple[int, int, int], seed: int) -> dict[str, np.ndarray]:
    """Untrained weights of the right sizes, for trials."""
    h, w, c = shape
    rng = np.random.default_rng(seed)
    flat = ((h - KERNEL + 1) // POOL) * ((w - KERNEL + 1) // POOL) * FILTERS
    draw = lambda *size: rng.normal(0, 1 / np.sqrt(size[0]), size)
    return {
        "conv": rng.normal(0, 1 / 3, (KERNEL, KERNEL, c, FILTERS)), "conv_bias": np.zeros(FILTERS),
        "dense": draw(flat, HIDDEN), "dense_bias": np.zeros(HIDDEN), "out": draw(HIDDEN, 1), "out_bias": np.zeros(1),
    }


def stated_weights(shape: tuple[int, int, int]) -> dict[str, np.ndarray]:
    """Weights by a rule on their place, so that other engines can state the same network."""
    h, w, c = shape
    flat = ((h - KERNEL + 1) // POOL) * ((w - KERNEL + 1) // POOL) * FILTERS
    rule = lambda size, scale: ((np.arange(np.prod(size)) * 37 % 101 - 50) / scale).reshape(size)
    bias = lambda n: (np.arange(n) * 13 % 7 - 3) / 10
    return {
        "conv": rule((KERNEL, KERNEL, c, FILTERS), 250.0), "conv_bias": bias(FILTERS), "dense": rule((flat, HIDDEN), 1000.0),
        "dense_bias": bias(HIDDEN), "out": rule((HIDDEN, 1), 250.0), "out_bias": bias(1),
    }
