"""Shannon entropy of a column's recent values, binned per window."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoscan.config import Track
from odoscan.operators.ordering import bounded


def histogram_entropy(windows: pd.Series) -> np.ndarray:
    """Entropy in bits of each window under equal bins.

    The bin width is the smaller of the Sturges width and the Freedman-Diaconis
    width, the latter at least half the square-root width. All windows of a batch
    are handled together as one padded matrix.
    """
    sizes = windows.map(len).to_numpy()
    if not len(sizes) or not sizes.max():
        return np.zeros(len(sizes))
    filled = np.arange(sizes.max()) < sizes[:, None]
    values = np.full(filled.shape, np.nan)
    values[filled] = np.concatenate([np.asarray(w, dtype=float) for w in windows])
    values.sort(axis=1)  # NaN padding stays at the end
    n = np.maximum(sizes, 1)
    rows = np.arange(len(values))
    low, high = values[:, 0], values[rows, n - 1]
    spread = high - low

    def quartile(q: float) -> np.ndarray:
        spot = q * (n - 1)
        below = np.floor(spot).astype(int)
        a, b = values[rows, below], values[rows, np.minimum(below + 1, n - 1)]
        return a + (b - a) * (spot - below)

    diaconis = 2.0 * (quartile(0.75) - quartile(0.25)) * n ** (-1.0 / 3.0)
    width = np.minimum(np.maximum(diaconis, spread / np.sqrt(n) / 2.0), spread / (np.log2(n) + 1.0))
    flat = ~(width > 0)
    bins = np.where(flat, 1, np.ceil(spread / np.where(flat, 1.0, width))).astype(int)
    inner = np.arange(1, max(bins.max(), 2))
    edges = low[:, None] + inner * (spread / bins)[:, None]
    edges = np.where(inner < bins[:, None], edges, np.inf)
    place = (values[:, :, None] >= edges[:, None, :]).sum(axis=2)
    entropy = np.zeros(len(values))
    for b in range(bins.max()):
        share = ((place == b) & filled).sum(axis=1) / n
        entropy -= np.where(share > 0, share * np.log2(np.where(share > 0, share, 1.0)), 0.0)
    return entropy + 0.0


def rolling_entropy(df: DataFrame, track: Track, column: str, window: int = 20, name: str | None = None) -> DataFrame:
    """Entropy over the last ``window`` rows; null below half as many known values."""

    @F.pandas_udf("double")
    def entropy_of(windows: pd.Series) -> pd.Series:
        return pd.Series(histogram_entropy(windows))

    name = name or f"{column}_Entropy"

    def gather(frame, order):
        return frame.withColumn("_recent", F.collect_list(column).over(order.rowsBetween(-(window - 1), 0)))

    gathered = bounded(df, track, window - 1, gather)
    enough = F.size("_recent") >= window // 2
    return gathered.withColumn(name, F.when(enough, entropy_of("_recent"))).drop("_recent")
