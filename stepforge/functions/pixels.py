"""Pixel work: the one place where Python runs, in Arrow batches.

Images arrive as the columns of Spark's image source (height, width,
nChannels, data), whose bytes are row-wise BGR(A).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, StringType, StructField, StructType,
)

from stepforge import domains as D

HASH_SIDE = 16
SAMPLE_SIDE = 64
SMALL_FRAME = 4096  # values of frames whose variance is taken value by value

DIFF_TYPE = StructType([
    StructField("same_shape", BooleanType()),
    StructField("ratio", DoubleType()),
    StructField("channel_ratio", DoubleType()),
    StructField("regions", ArrayType(DoubleType())),
])


def _rgb(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(pixels, 3, axis=2)
    return pixels[:, :, 2::-1]


def _lanczos_weights(source: int, target: int) -> np.ndarray:
    """Row-normalised windowed-sinc resampling matrix (target x source)."""
    scale = source / target
    stretch = max(scale, 1.0)
    centre = (np.arange(target) + 0.5) * scale
    distance = (np.arange(source) + 0.5 - centre[:, None]) / stretch
    weights = np.where(np.abs(distance) < 3.0, np.sinc(distance) * np.sinc(distance / 3.0), 0.0)
    return weights / weights.sum(axis=1, keepdims=True)


def _cosine_matrix(n: int) -> np.ndarray:
    k = np.arange(n)
    return 2.0 * np.cos(np.pi * k[:, None] * (2 * k + 1) / (2.0 * n))


def perceptual_hash_of(rgb: np.ndarray) -> str:
    """64 hex digits: signs of the 16x16 lowest frequencies against their median."""
    grey = (rgb.astype(np.uint32) @ np.array([19595, 38470, 7471], dtype=np.uint32) + 0x8000) >> 16
    height, width = grey.shape
    across = np.clip(np.rint(grey @ _lanczos_weights(width, SAMPLE_SIDE).T), 0, 255)
    small = np.clip(np.rint(_lanczos_weights(height, SAMPLE_SIDE) @ across), 0, 255)
    cosines = _cosine_matrix(SAMPLE_SIDE)
    low = (cosines @ small @ cosines.T)[:HASH_SIDE, :HASH_SIDE]
    bits = (low > np.median(low)).reshape(-1)
    return np.packbits(bits).tobytes().hex()


@F.pandas_udf(StringType())
def perceptual_hash(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
    def one(h, w, c, d):
        if d is None:
            return None
        try:
            return perceptual_hash_of(_rgb(int(h), int(w), int(c), d))
        except ValueError:
            return None

    return pd.Series([one(*row) for row in zip(height, width, channels, data)], dtype=object)


def running_variance(frames: np.ndarray) -> np.ndarray:
    """Population variance of each row by a running mean, in the order of the values.

    Databases compute ``var_pop`` in this way; another order of additions may end a last bit lower or higher,
    which tells where a variance lies on the edge of a class.
    """
    mean, squares = np.zeros(len(frames)), np.zeros(len(frames))
    for i in range(frames.shape[1]):
        value = frames[:, i].astype(np.float64)
        after = mean + (value - mean) / (i + 1)
        squares += (value - after) * (value - mean)
        mean = after
    return squares / frames.shape[1]


@F.pandas_udf(DoubleType())
def pixel_variance(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
    """Population variance over all RGB values; of small frames in the order of the buffer."""
    out = np.full(len(data), np.nan)
    small: dict[int, list[tuple[int, np.ndarray]]] = {}
    for place, (h, w, c, d) in enumerate(zip(height, width, channels, data)):
        if d is None:
            continue
        try:
            values = _rgb(int(h), int(w), int(c), d)
        except ValueError:  # a malformed buffer
            continue
        if 0 < values.size <= SMALL_FRAME:
            small.setdefault(values.size, []).append((place, values[:, :, ::-1].reshape(-1)))
        else:
            out[place] = values.astype(np.float64).var()
    for frames in small.values():
        out[[place for place, _ in frames]] = running_variance(np.stack([values for _, values in frames]))
    return pd.Series(out).astype(object).where(~np.isnan(out), None)


def compare_frames(before: np.ndarray, after: np.ndarray) -> tuple:
    """(same shape, changed pixel share, changed channel share, nine region shares)."""
    if before.shape != after.shape:
        return False, 1.0, 1.0, [0.0] * 9
    gap = np.abs(before.astype(np.int16) - after.astype(np.int16))
    changed = gap.mean(axis=2, dtype=np.float32) > D.PIXEL_CHANGE
    height, width = changed.shape
    rows = [int(cut * height) for cut in D.GRID_CUTS]
    cols = [int(cut * width) for cut in D.GRID_CUTS]
    shares = []
    for r in range(3):
        for c in range(3):
            cell = changed[rows[r]:rows[r + 1], cols[c]:cols[c + 1]]
            shares.append(float(cell.mean()) if cell.size else 0.0)
    return True, float(changed.mean()), float((gap > D.PIXEL_CHANGE).mean()), shares


@F.pandas_udf(DIFF_TYPE)
def frame_difference(h1: pd.Series, w1: pd.Series, c1: pd.Series, d1: pd.Series,
                     h2: pd.Series, w2: pd.Series, c2: pd.Series, d2: pd.Series) -> pd.DataFrame:
    rows = [
        compare_frames(_rgb(int(a), int(b), int(c), d), _rgb(int(e), int(f), int(g), h))
        for a, b, c, d, e, f, g, h in zip(h1, w1, c1, d1, h2, w2, c2, d2)
    ]
    return pd.DataFrame(rows, columns=["same_shape", "ratio", "channel_ratio", "regions"])
