"""Interleaving sources to target weights by proportionate-fair scheduling.

A source's rows are cut into blocks. With weight w, block i of a source is released at
slot floor(i / w) and due by slot ceil((i + 1) / w); of the released blocks the one due
first gets the next slot. Weights are exact ratios of integers and nothing repeats, so
while all sources last each is less than one block ahead of or behind its given share
at every slot, however many there are. A source that has run out takes no more slots,
and the others stay within their windows; no row is dropped or repeated.

Which block is next depends on all blocks before, so one task works the schedule out, a
step per block and not per row, and writes it as it goes; its memory holds one entry
per source. Rows then find their block's slot by a join.

A null source is a source. Sources without a given weight get the smallest given one.
Repeated rows are different rows in equal places; an empty table gives no row.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoscan.llm.common import ranked, stage


def ratios(weights: Sequence) -> list[int]:
    """Integers in exactly the proportions of the weights."""
    if any(not w > 0 for w in weights):
        raise ValueError("weights must be positive")
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*[x.denominator for x in exact])
    whole = [int(x * scale) for x in exact]
    common = math.gcd(*whole)
    return [x // common for x in whole]


def schedule(parts: Sequence[int], blocks: Sequence[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, release, deadline, slot) of every block, by slot; the earliest deadline first among released blocks.

    Source s has ``blocks[s]`` blocks and the share ``parts[s] / sum(parts)``.
    """
    total = sum(parts)
    waiting = [(0, s, 0) for s, n in enumerate(blocks) if n]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // parts[s]), s, i, release))
        deadline, s, i, release = heapq.heappop(ready)
        yield s, i, release, deadline, slot
        if i + 1 < blocks[s]:
            heapq.heappush(waiting, ((i + 1) * total // parts[s], s, i + 1))
        slot += 1


def mix(
    docs: DataFrame,
    order: list[str],
    source_col: str = "source",
    weights: Mapping | None = None,
    block: int = 64,
    cycle: int = 1000,
    power: float = 0.5,
) -> DataFrame:
    """Add _block, _release, _deadline, _slot and _place (within the block) to every row, in place of columns of that name.

    ``order`` names columns that fix the order of a source's rows. Without ``weights`` a
    source's weight is its row count to the given power. One row per source reaches the
    driver. ``cycle`` is the number of blocks of the schedule that are written at a time;
    the result does not depend on it.
    """
    spark = docs.sparkSession
    counts = docs.groupBy(source_col).count().collect()
    present = sorted(((r[source_col], r["count"]) for r in counts), key=lambda x: (str(x[0]), x[0] is None))
    if weights is None:
        targets = [float(n) ** power for _, n in present]
    else:
        smallest = min(weights.values(), default=1.0)
        targets = [weights.get(s, smallest) for s, _ in present]
    parts, blocks = ratios(targets), [-(-n // block) for _, n in present]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in (row for batch in batches for row in range(len(batch))):
            rows = schedule(parts, blocks)
            while some := list(islice(rows, cycle)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*some, strict=True)], ["_s", "_i", "_release", "_deadline", "_slot"]
                )

    table = stage(spark.range(0, 1, 1, 1).mapInArrow(run, "_s long, _i long, _release long, _deadline long, _slot long"))
    kind = docs.schema[source_col].dataType.simpleString()
    known = spark.createDataFrame([(s, i) for i, (s, _) in enumerate(present)], f"of {kind}, number long")
    rows = sum(n for _, n in present)
    # Rows travel as one column, so that no name of theirs meets another.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    by = [f"o{i}" for i in range(len(order))]
    packed = docs.select(whole, F.col(source_col).alias("source"), *[F.col(c).alias(n) for c, n in zip(order, by, strict=True)])
    placed = ranked(packed, ["source"], by, "rank", max(16, rows // 100_000))
    cut = placed.select("whole", "source", F.floor(F.col("rank") / block).alias("_block"), (F.col("rank") % block).alias("_place"))
    cut = cut.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("of")))
    due = cut.join(table, (F.col("number") == F.col("_s")) & (F.col("_block") == F.col("_i")))
    given = ["_block", "_place", "_release", "_deadline", "_slot"]
    return due.select(*[F.col("whole")[c].alias(c) for c in docs.columns if c not in given], *given)
