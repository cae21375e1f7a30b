"""Packing token sequences by non-negative least squares over a length histogram.

Each document's ids are cut into whole windows and one remainder. Remainder lengths,
in units of a small part of the window, form a histogram of fixed size. Combinations
of at most three lengths that fill a window are its columns; non-negative least
squares finds how often to repeat each, rounding down keeps them within the stock,
and what remains is packed greedily: first by repeated best-fit patterns, then, where
those would leave a window visibly empty, end to end with cuts at window borders.

Only the histogram (one count per unit) reaches the driver. A remainder learns its
place from its rank within its length, found without gathering a length in one task,
and from a plan of a few hundred ranges. Repeated rows and equal lengths differ in
the row number given when ids are written; null texts are empty and consist of the
closing id; an empty table gives no piece.

With an order of the documents, each length's remainders are dealt in that order to all
patterns alike, what the patterns leave is laid end to end in that order by exact token
offsets, and sequences are numbered by the mean place of the documents they hold.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoscan.llm.common import byte_chunks, numbered, ranked, stage, text_of
from odoscan.llm.vocab import encoder

#: Parts of a window in which remainders are measured.
UNITS = 128
#: Remainders of at most so many parts are laid end to end, so that rounding them up to parts wastes nothing.
TINY = 8
#: Windows of a pattern that one row lists.
LISTED = 10_000
#: Free parts that a greedy pattern may leave; worse ones are laid end to end instead.
SLACK = 2


def nnls(columns: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Lawson and Hanson's active-set method: x >= 0 that minimises |columns x - target|."""
    n = columns.shape[1]
    x, active = np.zeros(n), np.zeros(n, dtype=bool)
    tolerance = 1e-10 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(6 * columns.shape[0]):
        gradient = columns.T @ (target - columns @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        active[best] = True
        while True:
            picked = np.flatnonzero(active)
            solved = np.linalg.lstsq(columns[:, picked], target, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[picked] = solved
                break
            old = x[picked]
            bad = solved <= 0
            step = float(np.min(old[bad] / (old[bad] - solved[bad])))
            x[picked] = old + step * (solved - old)
            active &= x > 1e-14
            x[~active] = 0
            if not active.any():
                break
    return x


def shallow(units: int, depth: int = 3) -> list[tuple[int, ...]]:
    """All multisets of at most ``depth`` lengths that fill ``units`` exactly."""
    out = [(units,)]
    for d in range(2, depth + 1):
        for head in combinations_with_replacement(range(1, units), d - 1):
            last = units - sum(head)
            if last >= head[-1]:
                out.append((*head, last))
    return out


def repeats(stock: np.ndarray, units: int = UNITS) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Patterns with their counts, and the stock left for laying end to end.

    ``stock[u]`` is the number of remainders of ``u`` units.
    """
    left = stock.astype(np.int64).copy()
    total = int(left.sum())
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...], most: int) -> int:
        need = np.bincount(pattern, minlength=units + 1)
        used = np.flatnonzero(need)
        times = min(most, int((left[used] // need[used]).min()))
        if times > 0:
            left[used] -= times * need[used]
            plan.append((pattern, times))
        return times

    if total:
        choices = shallow(units)
        matrix = np.zeros((units + 1, len(choices)))
        for c, pattern in enumerate(choices):
            for u in pattern:
                matrix[u, c] += 1
        solved = nnls(matrix, left / total) * total
        for c in np.argsort(-solved, kind="stable"):
            if solved[c] < 0.5:
                break
            take(choices[c], int(math.floor(solved[c] + 1e-6)))
    # Residuals: the longest first, each window topped up with the longest that fits.
    for longest in range(units, 0, -1):
        while left[longest]:
            pattern, free, spare = [longest], units - longest, left.copy()
            spare[longest] -= 1
            for u in range(units, 0, -1):
                times = min(int(spare[u]), free // u)
                pattern += [u] * times
                free -= times * u
            if free > SLACK:
                break
            take(tuple(pattern), int(left.max()))
    return plan, left


def plan_of(stock: np.ndarray) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """``repeats`` of all but tiny remainders, which are left."""
    tiny = stock.copy()
    tiny[TINY + 1 :] = 0
    plan, left = repeats(stock - tiny)
    return plan, left + tiny


def placements(plan: list[tuple[tuple[int, ...], int]], units: int = UNITS) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Ranges (units, first rank, end rank, first sequence, slot), and the sequences used."""
    used = np.zeros(units + 1, dtype=np.int64)
    ranges, sequence = [], 0
    for pattern, times in plan:
        for slot, u in enumerate(pattern):
            ranges.append((int(u), int(used[u]), int(used[u]) + times, sequence, slot))
            used[u] += times
        sequence += times
    return ranges, sequence


def token_ids(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, closing: int, more: list[str] | None = None) -> DataFrame:
    """One row per document: id, packed little-endian ids with the closing id, their number, and ``more`` columns."""
    kind, more = docs.schema[id_col].dataType, more or []
    schema = f"doc_id {kind.simpleString()}, ids binary, n_ids long"
    schema += "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary)
        for batch in batches:
            raw, offsets = text_of(batch.column(1))
            for low, high in byte_chunks(offsets):
                ids, first = known.encode(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                ids = np.insert(ids, first[1:], closing)
                first = first + np.arange(len(first))
                ends = pa.py_buffer((first * ids.itemsize).astype(np.int32))
                packed = pa.Array.from_buffers(pa.binary(), high - low, [None, ends, pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), packed, pa.array(np.diff(first)), *[c.slice(low, high - low) for c in batch.columns[2:]]],
                    ["doc_id", "ids", "n_ids", *more],
                )

    return docs.select(F.col(id_col), F.col(text_col), *more).mapInArrow(run, schema)


def place(lengths: DataFrame, window: int, rows: int) -> DataFrame:
    """(row, start, length, sequence_id, offset) for every piece of (row, n_ids)."""
    from pyspark.sql import Window

    spark = lengths.sparkSession
    unit = window // UNITS
    slices = max(16, rows // 100_000)
    sized = lengths.select(
        "row",
        F.floor(F.col("n_ids") / window).alias("n_full"),
        (F.col("n_ids") % window).alias("rest"),
    ).withColumn("units", F.ceil(F.col("rest") / unit).cast("int"))
    counts = {r["units"]: (r["n"], r["whole"]) for r in sized.groupBy("units").agg(F.count(F.lit(1)).alias("n"), F.sum("n_full").alias("whole")).collect()}
    stock = np.zeros(UNITS + 1, dtype=np.int64)
    for u, (n, _) in counts.items():
        stock[u] = n if u else 0
    plan, left = plan_of(stock)
    ranges, packed = placements(plan)
    taken = stock - left
    filled = packed + sum(int(whole) for _, whole in counts.values())  # sequences before those laid end to end

    ranks = ranked(sized, ["units"], ["row"], "rank", slices)
    schema = "r_units int, low long, high long, first long, slot int"
    table = spark.createDataFrame(ranges, schema)
    for_rest = spark.createDataFrame([(u, int(taken[u])) for u in range(1, UNITS + 1)], "l_units int, taken long")
    # Both tables have at most a few hundred rows, whatever the input.
    rest = ranks.filter("units > 0")
    in_pattern = rest.join(
        F.broadcast(table), (F.col("units") == F.col("r_units")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    ).select(
        "row", (F.col("n_full") * window).alias("start"), F.col("rest").alias("length"),
        (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "slot",
    )
    # What the patterns leave, end to end: running counts of tokens within slices, then the sums of earlier slices.
    in_slice = F.pmod(F.xxhash64("row"), F.lit(slices))
    inside = Window.partitionBy("_slice").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    left_over = rest.join(F.broadcast(for_rest), (F.col("units") == F.col("l_units")) & (F.col("rank") >= F.col("taken")))
    left_over = left_over.select("row", "n_full", "rest", in_slice.alias("_slice"))
    line_sums = left_over.groupBy("_slice").agg(F.sum("rest").alias("n"))
    line_before = line_sums.select("_slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    none = F.lit(0).cast("long")
    two = F.array(
        F.struct(none.alias("skip"), F.col("cut").alias("length"), none.alias("next")),
        F.struct(F.col("cut").alias("skip"), (F.col("rest") - F.col("cut")).alias("length"), F.lit(1).cast("long").alias("next")),
    )
    line = (
        left_over.withColumn("own", F.coalesce(F.sum("rest").over(inside), F.lit(0)))
        .join(line_before, "_slice")
        .withColumn("at", F.col("own") + F.col("before"))
        .withColumn("cut", F.least(F.col("rest"), window - F.col("at") % window))
        .withColumn("piece", F.explode(two))
        .filter("piece.length > 0")
        .select(
            "row", (F.col("n_full") * window + F.col("piece.skip")).alias("start"), F.col("piece.length").alias("length"),
            (F.floor(F.col("at") / window) + F.col("piece.next") + filled).alias("sequence_id"),
            (F.col("at") % window * (1 - F.col("piece.next"))).alias("offset"),
        )
    )
    ahead = Window.partitionBy("sequence_id").orderBy("slot", "row").rowsBetween(Window.unboundedPreceding, -1)
    shared = in_pattern.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).drop("slot").unionByName(line)

    # Whole windows: running counts within slices, then the sums of earlier slices.
    whole = sized.filter("n_full > 0").withColumn("_slice", in_slice)
    sums = whole.groupBy("_slice").agg(F.sum("n_full").alias("n"))
    offsets = sums.select("_slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    full = (
        whole.withColumn("own", F.coalesce(F.sum("n_full").over(inside), F.lit(0)))
        .join(offsets, "_slice")
        .select("row", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("n_full") - 1)).alias("k", "_"), "own", "before")
        .select(
            "row", (F.col("k").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"),
            (F.col("own") + F.col("before") + F.col("k") + packed).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )
    return shared.unionByName(full)


def place_in_order(lengths: DataFrame, window: int, rows: int) -> DataFrame:
    """The same columns as ``place``, for rows whose number follows the order; its high bits are the slice."""
    from pyspark.sql import Window

    spark, slices = lengths.sparkSession, max(16, rows // 100_000)
    by_slice = F.shiftright("row", 33).cast("int")
    sized = lengths.select(
        "row", F.floor(F.col("n_ids") / window).alias("n_full"), (F.col("n_ids") % window).alias("rest")
    ).withColumn("units", F.ceil(F.col("rest") / (window // UNITS)).cast("int"))
    stock = np.zeros(UNITS + 1, dtype=np.int64)
    for r in sized.filter("units > 0").groupBy("units").count().collect():
        stock[r["units"]] = r["count"]
    plan, left = plan_of(stock)
    packed = sum(times for _, times in plan)
    deals, at = [], 0  # patterns, then what they leave of each length
    for pattern, times in [*plan, *(((u,), int(left[u])) for u in range(1, UNITS + 1) if left[u])]:
        deals.append((at, int(times), [int(u) for u in pattern]))
        at += int(times)
    # A pattern's windows are listed in bounded pieces of its own range.
    deal = spark.createDataFrame(deals, "first long, times long, pattern array<int>")
    starts = F.sequence(F.col("first"), F.col("first") + F.col("times") - 1, F.lit(LISTED).cast("long"))
    table = deal.select("*", F.explode(starts).alias("low")).withColumn("high", F.least(F.col("low") + LISTED, F.col("first") + F.col("times")))
    table = table.withColumn("piece", F.xxhash64("low"))
    # Every place in a pattern, at the fraction of the order at which its turn comes.
    places = (
        table.repartition("piece")
        .select("*", F.explode(F.sequence("low", F.col("high") - 1)).alias("id"))
        .select("id", ((F.col("id") - F.col("first") + 0.5) / F.col("times")).alias("turn"), F.posexplode("pattern").alias("slot", "units"))
    )
    dealt = ranked(places, ["units"], ["turn", "id", "slot"], "rank", slices, F.floor(F.col("turn") * slices).cast("int"))
    ranks = ranked(sized.filter("units > 0"), ["units"], ["row"], "rank", slices, by_slice)
    given = stage(ranks.join(dealt.select("units", "rank", "id", "slot"), ["units", "rank"]).select("row", "n_full", "rest", "id", "slot"))
    start = F.col("n_full") * window
    ahead = Window.partitionBy("id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    in_pattern = given.filter(F.col("id") < packed).select(
        "row", start.alias("start"), F.col("rest").alias("length"), F.lit(-1).cast("long").alias("a"), F.col("id").alias("b"),
        F.coalesce(F.sum("rest").over(ahead), F.lit(0)).alias("offset"),
    )
    # End to end: running counts of tokens within slices, then the sums of earlier slices.
    line = given.filter(F.col("id") >= packed).withColumn("_slice", by_slice)
    inside = Window.partitionBy("_slice").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    sums = line.groupBy("_slice").agg(F.sum("rest").alias("n"))
    before = sums.select("_slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    laid = (
        line.withColumn("own", F.coalesce(F.sum("rest").over(inside), F.lit(0)))
        .join(before, "_slice")
        .withColumn("at", F.col("own") + F.col("before"))
        .withColumn("cut", F.least(F.col("rest"), window - F.col("at") % window))
    )
    none = F.lit(0).cast("long")
    two = F.array(
        F.struct(none.alias("skip"), F.col("cut").alias("length"), none.alias("next")),
        F.struct(F.col("cut").alias("skip"), (F.col("rest") - F.col("cut")).alias("length"), F.lit(1).cast("long").alias("next")),
    )
    end_to_end = laid.withColumn("piece", F.explode(two)).filter("piece.length > 0").select(
        "row", (start + F.col("piece.skip")).alias("start"), F.col("piece.length").alias("length"), F.lit(-1).cast("long").alias("a"),
        (F.floor(F.col("at") / window) + F.col("piece.next") + at).alias("b"), (F.col("at") % window * (1 - F.col("piece.next"))).alias("offset"),
    )
    whole = sized.filter("n_full > 0").select("row", F.explode(F.sequence(none, F.col("n_full") - 1)).alias("b")).select(
        "row", (F.col("b") * window).alias("start"), F.lit(window).cast("long").alias("length"), F.col("row").alias("a"), "b", none.alias("offset")
    )
    pieces = stage(in_pattern.unionByName(end_to_end).unionByName(whole))
    firsts = pieces.groupBy("a", "b").agg(F.avg("row").cast("long").alias("row"))
    numbers = ranked(firsts, [], ["row", "a", "b"], "sequence_id", slices, by_slice)
    return pieces.join(numbers.select("a", "b", "sequence_id"), ["a", "b"]).select("row", "start", "length", "sequence_id", "offset")


def pack(
    docs: DataFrame,
    vocabulary: str,
    window: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    closing: int = 1,
    order: list[str] | None = None,
    arrange: Callable[[DataFrame], tuple[DataFrame, list[str]]] | None = None,
) -> DataFrame:
    """Pieces of all documents in windows of at most ``window`` ids.

    Columns: doc_id, doc_tokens (the document's ids with the closing one), start, length,
    ids (binary, little-endian unsigned 32-bit), sequence_id, offset. Every id lies in
    exactly one piece; offsets within a sequence have no gaps. Sequences that are not
    full are padded by the reader.

    ``order`` names columns that sequences follow: they are numbered by the mean place of their documents.
    If the order is not in columns, ``arrange`` finds it: it gets doc_id, row and the ``order``
    columns of every document and returns rows with ``row`` and the columns to sort by.
    """
    if window % UNITS:
        raise ValueError(f"window must be a multiple of {UNITS}")
    tokens = numbered(token_ids(docs, id_col, text_col, vocabulary, closing, order), "row")
    rows = tokens.count()
    if order is None:
        pieces = place(tokens.select("row", "n_ids"), window, rows)
    else:
        narrow = tokens.select("doc_id", "row", "n_ids", *order)
        turned, by = arrange(narrow) if arrange else (narrow, order)
        sort = [*by, "row"]
        sorted_rows = turned.select("n_ids", *sort).repartitionByRange(max(16, rows // 100_000), *sort).sortWithinPartitions(*sort)
        turns = numbered(sorted_rows.select(F.col("row").alias("own"), "n_ids"), "row")
        found = place_in_order(turns.select("row", "n_ids"), window, rows)
        pieces = found.join(turns.select("row", "own"), "row").drop("row").withColumnRenamed("own", "row")
    kind = tokens.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long"
    # A document's pieces travel as one list, a fixed number per window of its own length.
    lists = pieces.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))

    def slice_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, lists = batch.column(1), batch.column(2).to_numpy(), batch.column(3)
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten()
            start, length = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            owner = np.repeat(np.arange(len(batch)), sizes)
            at, most = 0, 1 << 20
            while at < len(owner):
                end = int(np.searchsorted(np.cumsum(length[at:]), most)) + 1 + at
                out, last, whole = [], -1, None
                for p in range(at, min(end, len(owner))):
                    if owner[p] != last:
                        last = owner[p]
                        raw = ids[int(last)].as_buffer()
                        whole = np.frombuffer(raw, f"<u{raw.size // counts[last]}")
                    out.append(whole[start[p] : start[p] + length[p]].astype("<u4").tobytes())
                part = slice(at, at + len(out))
                rows = pa.array(owner[part])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(2).take(rows), flat.field(0)[part], flat.field(1)[part],
                        pa.array(out, pa.binary()), flat.field(2)[part], flat.field(3)[part],
                    ],
                    ["doc_id", "doc_tokens", "start", "length", "ids", "sequence_id", "offset"],
                )
                at += len(out)

    joined = tokens.join(lists, "row").select("doc_id", "ids", "n_ids", "pieces")
    return joined.mapInArrow(slice_ids, schema)
