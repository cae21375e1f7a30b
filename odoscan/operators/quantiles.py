"""Exact quantiles with linear interpolation, for groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one task.
It serves groups up to a checked size. Quantiles of a larger table come from
two scans: a sample places buckets, near the wanted ranks if these are few; the first scan counts
the values of every bucket, the second brings the values of the buckets that hold a wanted rank. Other
large groups are answered by rank: equal
values collapse first, the distinct values are sorted across the cluster with
running counts, and only the two values around each wanted rank are kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odoscan.config import Settings
from odoscan.operators.ordering import largest_group, running_totals, stage

ANY = "_any"
#: The most quantiles that have buckets near them only, the buckets of each, and how many deviations of the sample they reach.
FEW, NEAR, REACH = 16, 64, 5
#: Rows of the sample that places buckets for more quantiles, and the buckets of a column.
PLACED, BUCKETS = 32_000, 4_000


def long_form(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key, column and value; nulls left out."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns]
    return df.select(*keys, F.explode(F.array(*entries)).alias("e")).select(
        *keys, F.col("e.column").alias("column"), F.col("e.value").alias("value")
    ).filter(F.col("value").isNotNull())


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (), settings: Settings = Settings()
) -> DataFrame:
    """One row per key (a single row without keys); each column becomes an array, one quantile per ``probs``.

    Rows with a null key are left out. Null values do not count.
    """
    keys = list(keys)
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    probs = [float(p) for p in probs]
    grouped = keys or [ANY]
    base = df if keys else df.withColumn(ANY, F.lit(0))
    biggest, _ = largest_group(base, grouped)
    if biggest * len(columns) <= settings.exact_group_rows:
        wanted = F.array(*[F.lit(p) for p in probs])
        found = (df.groupBy(*keys) if keys else df).agg(
            *[F.percentile(F.col(c).cast("double"), wanted).alias(c) for c in columns]
        )
        return found
    if not keys:
        return _between(df, columns, probs, biggest) if len(probs) <= FEW else in_buckets(df, columns, probs, biggest)
    by_rank = of_counts(value_counts(base, columns, grouped), columns, probs, grouped, settings)
    found = base.select(*grouped).distinct().join(by_rank, grouped, "left")
    return found if keys else found.drop(ANY)


def _between(df: DataFrame, columns: Sequence[str], probs: Sequence[float], rows: int | None = None) -> DataFrame:
    """One row of a few quantiles; the sample places buckets near their ranks only."""
    return in_buckets(df, columns, probs, df.count() if rows is None else rows, near=True)


def in_buckets(df: DataFrame, columns: Sequence[str], probs: Sequence[float], rows: int, near: bool = False) -> DataFrame:
    """One row of quantiles from two scans. How good the sample is does not change the result."""
    columns = list(columns)
    counts, found = _ranked(df, columns, lambda n, _: [r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))], rows, near)
    line = [[_at(found[i], p * (n - 1)) for p in probs] or None if n else None for i, n in enumerate(counts)]
    return df.sparkSession.createDataFrame([tuple(line)], ", ".join(f"`{c}` array<double>" for c in columns))


def _at(values: dict[int, float], spot: float) -> float:
    a, b = values[math.floor(spot)], values[math.ceil(spot)]
    return a if a == b else a + (b - a) * (spot - math.floor(spot))


def filled_quartiles(df: DataFrame, columns: Sequence[str], rows: int) -> tuple[list[float | None], list[list[float]]]:
    """Medians, and the quartiles of the columns whose nulls are filled with them; without any value nothing and zeros.

    The copies of the median lie behind the lower middle value, which gives the rank of every filled quartile among the values.
    """

    def places(n: int, total: int) -> list[int]:
        """Ranks that the median and the quartiles need."""
        ranks = [math.floor((n - 1) / 2), math.ceil((n - 1) / 2)]
        for p in (0.25, 0.5, 0.75):
            for r in (math.floor(p * (total - 1)), math.ceil(p * (total - 1))):
                if not _filled(r, n, total):
                    ranks.append(r if r < (n - 1) // 2 + 1 else r - (total - n))
        return ranks

    def _filled(r: int, n: int, total: int) -> bool:
        return (n - 1) // 2 + 1 <= r < (n - 1) // 2 + 1 + total - n

    counts, found = _ranked(df, list(columns), places, rows, near=True)
    medians: list[float | None] = []
    quarters = []
    for n, values in zip(counts, found, strict=True):
        if not n:
            medians.append(None)
            quarters.append([0.0, 0.0, 0.0])
            continue
        middle = _at(values, (n - 1) * 0.5)
        spots = [p * (rows - 1) for p in (0.25, 0.5, 0.75)]
        ranks = {r for spot in spots for r in (math.floor(spot), math.ceil(spot))}
        filled = {r: middle if _filled(r, n, rows) else values[r if r < (n - 1) // 2 + 1 else r - (rows - n)] for r in ranks}
        medians.append(middle)
        quarters.append([_at(filled, spot) for spot in spots])
    return medians, quarters


def _ranked(
    df: DataFrame, columns: list[str], wanted: Callable[[int, int], list[int]], rows: int, near: bool
) -> tuple[list[int], list[dict[int, float]]]:
    """For every column its number of values, and the value at each of the ranks that ``wanted`` (values, rows) gives."""
    spark = df.sparkSession
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    sample = values.sample(min(1.0, PLACED / max(rows, 1)), seed=1).toArrow()
    bounds = []
    for i in range(len(columns)):
        seen = np.sort(sample.column(i).drop_null().to_numpy())
        real = seen[~np.isnan(seen)]
        if near and len(real):
            spots = np.array(wanted(len(seen), max(sample.num_rows, len(seen))), float)[:, None]
            share = np.clip(spots / len(seen), 0, 1)
            reach = REACH * np.sqrt(share * (1 - share) * len(seen)) + 2
            at = (spots + reach * np.linspace(-1, 1, NEAR + 1)).round().astype(np.int64)
            bounds.append(np.unique(real[np.unique(at.clip(0, len(real) - 1))]))
        else:
            bounds.append(np.unique(real[:: max(1, len(real) // BUCKETS)]))
    shared = spark.sparkContext.broadcast(bounds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = shared.value
        held = [np.zeros(len(b) + 1, np.int64) for b in bounds]
        for batch in batches:
            for i, edges in enumerate(bounds):
                held[i] += np.bincount(np.searchsorted(edges, batch.column(i).drop_null().to_numpy()), minlength=len(edges) + 1)
        for i, n in enumerate(held):
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), i, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[used])], ["i", "bucket", "n"])

    sizes = values.mapInArrow(count, "i int, bucket int, n long").groupBy("i", "bucket").agg(F.sum("n").alias("n")).toArrow()
    number, bucket, n = (sizes.column(c).to_numpy() for c in ("i", "bucket", "n"))
    counts = [np.zeros(len(b) + 1, np.int64) for b in bounds]
    for i in range(len(columns)):
        counts[i][bucket[number == i]] = n[number == i]
    picks, needed = [], [np.zeros(len(c), bool) for c in counts]
    for i, held in enumerate(counts):
        upto = np.cumsum(held)
        for rank in set(wanted(int(upto[-1]), rows)) if upto[-1] else ():
            b = int(np.searchsorted(upto, rank, side="right"))
            needed[i][b] = True
            picks.append((i, b, rank, rank - int(upto[b] - held[b])))
    totals = [int(held.sum()) for held in counts]
    if not picks:
        return totals, [{} for _ in columns]
    chosen = spark.sparkContext.broadcast(needed)

    def bring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, needed = shared.value, chosen.value
        for batch in batches:
            for i, edges in enumerate(bounds):
                x = batch.column(i).drop_null().to_numpy()
                kinds, times = np.unique(x[_within(x, edges, needed[i])], return_counts=True)
                if len(kinds):
                    cells = [np.full(len(kinds), i, np.int32), np.searchsorted(edges, kinds).astype(np.int32), kinds, times]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["i", "bucket", "value", "n"])

    counted = values.mapInArrow(bring, "i int, bucket int, value double, n long").groupBy("i", "bucket", "value").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("i", "bucket").orderBy("value"))
    ranks = F.broadcast(spark.createDataFrame(picks, "i int, bucket int, rank long, here long"))
    hit = counted.withColumn("upto", upto).join(ranks, ["i", "bucket"]).filter((F.col("here") >= F.col("upto") - F.col("n")) & (F.col("here") < F.col("upto")))
    found: list[dict[int, float]] = [{} for _ in columns]
    for i, rank, value in zip(*(c.to_pylist() for c in hit.select("i", "rank", "value").toArrow().columns), strict=True):
        found[i][rank] = value
    return totals, found


def _within(x: np.ndarray, edges: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Which values lie in a needed bucket: above the edge before it, and not above its own."""
    ends = np.flatnonzero(np.diff(needed.astype(np.int8), prepend=0, append=0))
    if len(ends) > 16:
        return needed[np.searchsorted(edges, x)]
    inside = np.zeros(len(x), bool)
    for first, behind in ends.reshape(-1, 2):
        part = np.ones(len(x), bool) if first == 0 else ~(x <= edges[first - 1])  # what is not a number is the largest
        if behind <= len(edges):
            part &= x <= edges[behind - 1]
        inside |= part
    return inside


def value_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, column, value, n): every distinct value of every column with its rows; written once."""
    return stage(long_form(df, keys, columns).groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("n")))


def of_counts(counted: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (), settings: Settings = Settings()) -> DataFrame:
    """Quantiles of ``value_counts``: one row per key, or one row."""
    by = [*keys, "column"]
    ranked = running_totals(counted, by, ["value"], {"upto": F.col("n")}, settings.exact_group_rows)
    totals = counted.groupBy(*by).agg(F.sum("n").alias("total"))
    ranked = ranked.join(totals, by)

    def value_at(rank):
        return F.max(F.when((rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto")), F.col("value")))

    picks = []
    for i, p in enumerate(probs):
        spot = F.lit(p) * (F.col("total") - 1)
        picks += [
            value_at(F.floor(spot)).alias(f"low{i}"),
            value_at(F.ceil(spot)).alias(f"high{i}"),
            F.max(spot - F.floor(spot)).alias(f"share{i}"),
        ]
    found = ranked.groupBy(*by).agg(*picks)
    between = [F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * F.col(f"share{i}") for i in range(len(probs))]
    values = F.array(*[F.when(F.col(f"low{i}") == F.col(f"high{i}"), F.col(f"low{i}")).otherwise(v) for i, v in enumerate(between)])
    return found.select(*by, values.alias("q")).groupBy(*keys).agg(
        *[F.max(F.when(F.col("column") == c, F.col("q"))).alias(c) for c in columns]
    )


def medians(df: DataFrame, columns: Sequence[str], settings: Settings = Settings()) -> DataFrame:
    """One row: the median of each column."""
    found = quantiles(df, columns, [0.5], settings=settings)
    return found.select(*[F.col(f"`{c}`")[0].alias(c) for c in columns])
