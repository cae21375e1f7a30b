"""Exact counts of the distinct values of many columns.

A row per column and value is a wide shuffle of tiny rows. Here a task sorts some rows of every column, lets equal
values collapse, and sends them on as runs: one cell holds the values of a column and a range. The
ranges come from a sample, so that a task merges few values at once; a poor sample makes ranges uneven, not wrong.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds of columns that are counted here.
NUMBERS = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)
#: Rows that are sorted at once, rows of a range, rows of the sample, bytes that a task receives.
SORTED, RANGE_ROWS, PLACED, TASK_BYTES = 32_768, 250_000, 32_000, 128 << 20


def keys_of(column: pa.Array) -> np.ndarray:
    """A whole number for each value, the same for equal ones; all that are not numbers count as one value, the zeros as two."""
    x = column.drop_null().to_numpy(zero_copy_only=False)
    if x.dtype.kind != "f":
        return x.astype(np.int64)
    x = x.astype(np.float64)
    x[np.isnan(x)] = np.nan
    return x.view(np.int64)


def distinct_values(df: DataFrame, columns: Sequence[str], rows: int) -> list[int]:
    """How many values each column has, nulls left out; ``rows`` is the number of rows of the frame."""
    columns = list(columns)
    values = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    ranges = math.ceil(rows / RANGE_ROWS)
    bounds: list[np.ndarray] = [np.zeros(0, np.int64)] * len(columns)
    if ranges > 1:
        sample = values.sample(min(1.0, PLACED / rows), seed=1).toArrow()
        for i in range(len(columns)):
            seen = np.sort(keys_of(sample.column(i).combine_chunks()))
            bounds[i] = np.unique(seen[np.arange(1, ranges) * len(seen) // ranges]) if len(seen) else bounds[i]
    shared = values.sparkSession.sparkContext.broadcast(bounds)
    at_once = max(1, min(SORTED, (1 << 30) // (8 * len(columns))))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, held, count = shared.value, [], 0

        def out() -> pa.RecordBatch:
            numbers, places, sizes, parts = [], [], [], []
            for i, edges in enumerate(bounds):
                x = np.unique(np.concatenate([keys_of(b.column(i)) for b in held]))
                size = np.diff([0, *np.searchsorted(x, edges, side="right"), len(x)])
                used = np.flatnonzero(size)
                numbers.append(np.full(len(used), i, np.int32))
                places.append(used.astype(np.int32))
                sizes.append(size[used])
                parts.append(x)
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes)) * 8]).astype(np.int32)
            cells = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.concatenate(parts).tobytes())])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(numbers)), pa.array(np.concatenate(places)), cells], ["i", "part", "keys"])

        for batch in batches:
            for low in range(0, batch.num_rows, at_once):
                held.append(batch.slice(low, at_once))
                count += held[-1].num_rows
                if count >= at_once:
                    yield out()
                    held, count = [], 0
        if held:
            yield out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The runs of a column and range come one after the other."""
        total, current, held = np.zeros(len(columns), np.int64), None, []

        def close() -> None:
            if held:
                total[current[0]] += len(np.unique(np.concatenate(held)))
                held.clear()

        for batch in batches:
            for i, part, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if (i, part) != current:
                    close()
                    current = (i, part)
                held.append(np.frombuffer(cell.as_buffer(), np.int64))
        close()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["i", "n"])

    partitions = max(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows * len(columns) * 8 / TASK_BYTES))
    sent = values.mapInArrow(runs, "i int, part int, keys binary").repartition(partitions, "i", "part").sortWithinPartitions("i", "part")
    found = sent.mapInArrow(merge, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    counts = {r["i"]: r["n"] for r in found}
    return [counts.get(i, 0) for i in range(len(columns))]
