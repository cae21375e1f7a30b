"""Row ids, distributed ranks and vectorised text hashing shared by the operators.

Texts travel as Arrow batches. Word and byte hashes are computed for many texts at
once on the raw UTF-8 bytes, in chunks of bounded size, so a task's memory depends
on the chunk and on its longest single text only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odoscan.operators.ordering import shared_folder, stage

__all__ = ["CHUNK", "byte_chunks", "grams", "hash_words", "mix64", "numbered", "ranked", "shared_folder", "stage", "text_of"]

#: Bytes of text hashed at a time.
CHUNK = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Add a unique long and write the table once, so that the number never changes."""
    return stage(df.withColumn(name, F.monotonically_increasing_id()))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slices: int, slice_of: Column | None = None) -> DataFrame:
    """Zero-based rank within ``keys``, without bringing a key's rows into one task.

    Rows of a key are spread over ``slices`` by the hash of the ordering columns and
    ranked inside a slice; the sizes of earlier slices are added. The rank is a
    permutation that depends only on the rows, not on their partitions. Null keys
    form one group. ``order`` must tell rows apart. Where ``slice_of`` gives slices that
    follow the order, so does the rank.
    """
    cut = df.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int") if slice_of is None else slice_of)
    by = [*keys, "_slice"]
    inside = Window.partitionBy(*by).orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        *[F.col(k).alias(f"_o_{k}") for k in by], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    local = cut.withColumn("_local_rank", F.row_number().over(inside) - 1)
    match = F.lit(True)
    for k in by:
        match = match & local[k].eqNullSafe(offsets[f"_o_{k}"])
    joined = local.join(offsets, match, "left")
    return joined.withColumn(name, F.col("_local_rank") + F.col("_before")).drop(
        "_slice", "_local_rank", "_before", *[f"_o_{k}" for k in by]
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash; every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _table(seed: int, size: int) -> np.ndarray:
    return mix64((np.arange(size, dtype=np.uint64) + np.uint64(1)) * _ODD + np.uint64(seed))


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def text_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null counts as empty."""
    column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    else:
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32).astype(np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, at least one row each."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1
        high = min(rows, max(high, low + 1))
        yield low, high
        low = high


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: All ASCII but letters and digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_MULTIPLIERS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_POWERS: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < size:
        _POWERS[base] = _powers(base, max(64, 1 << int(size).bit_length()))
    return _POWERS[base]


_TABLES = [_table(seed, 256) for seed in (11, 23)]


def hash_words(raw: np.ndarray, offsets: np.ndarray, ways: int = 1, blank: np.ndarray = SPACE) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Hash every word of several texts, by default every ``[^\\x20\\x09-\\x0D]+``.

    Returns ``ways`` arrays of 64-bit hashes in text order, the first word of each text
    (one more entry than texts), and each word's first and end byte in ``raw``.
    """
    n = len(raw)
    ink = ~blank[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True  # texts never run into one another
    starts_here = ink.copy()
    if n:
        starts_here[1:] &= ~ink[:-1] | edge[1:n]
    starts = np.flatnonzero(starts_here)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in range(ways)], first, starts, starts
    where = np.flatnonzero(ink)
    heads = np.searchsorted(where, starts)
    lengths = np.diff(np.append(heads, len(where)))
    if not ways:
        return [], first, starts, starts + lengths
    place = np.arange(len(where)) - np.repeat(heads, lengths)
    longest = int(lengths.max())
    letters = raw[where]
    out = []
    for way in range(ways):
        powers = _power_table(_MULTIPLIERS[way], longest + 1)
        sums = np.add.reduceat(_TABLES[way][letters] * powers[place], heads)
        out.append(mix64(sums + lengths.astype(np.uint64) * _ODD))
    return out, first, starts, starts + lengths


_STEP = 0xF1357AEA2E62A9C5
_STEP_INVERSE = _inverse(_STEP)


def grams(values: np.ndarray, width: int, powers: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values, as ``len(values) - width + 1`` entries."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    forward = _power_table(_STEP, n)[:n]
    backward = _power_table(_STEP_INVERSE, n)[: n - width + 1]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * forward, out=sums[1:])
    return mix64((sums[width:] - sums[:-width]) * backward)
