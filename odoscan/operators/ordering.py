"""Ordered work over groups of any size.

A window partitioned by one key puts that key's rows into one task. That is fine
until one vehicle holds a third of the table, so every ordered operator goes
through this module:

* ``running_totals`` is a prefix sum. Small groups use a window. Otherwise the
  rows are range-partitioned on (keys, order), which splits any key, each slice
  is summed on its own, and the totals of earlier slices are added.
* ``lay_out`` numbers the rows of each series and cuts long series into blocks
  of ``Track.block_rows`` rows. It adds nothing when every series is short.
* ``bounded`` runs window code that looks back a fixed number of rows; each
  block borrows that many rows from the block before it.
* ``look_around`` looks back (or ahead) without limit; each block receives the
  state of the others from a summary with one row per block.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from odoscan.config import Track

SEQ = "_seq"
BLOCK = "_block"
SLICE = "_slice"
BORROWED = "_borrowed"

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors can reach."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    # Local runs such as tests: one folder per application.
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="odoscan-")
    return _LOCAL_FOLDERS[app]


def stage(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and continue from the written table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_on(rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys match each other; the side's keys are dropped."""
    renamed = side.withColumnsRenamed({k: f"_side_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(renamed[f"_side_{k}"]) for k in keys])
    return rows.join(renamed, match, how).drop(*[f"_side_{k}" for k in keys])


#: Rows of one key that a task should receive.
ROWS_PER_TASK = 1_000_000
#: Most keys that are spread by their own number of salts.
MOST_HOT = 100_000


def salted(rows: DataFrame, side: DataFrame, key: str, record: str, rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: every key has as many salts as its count needs.

    Keys of over ``rows_per_task`` rows are listed with their counts (and at most ``MOST_HOT`` of
    them, all larger than the total divided by that number), a table small enough to broadcast.
    Rows of such a key are dealt to its salts, its row of the side is copied to each. Null keys match nothing
    and are spread.
    """
    marked = rows.withColumn("_hash", F.xxhash64(key))
    sizes = stage(marked.filter(F.col(key).isNotNull()).groupBy("_hash").count())
    total = sizes.agg(F.sum("count")).first()[0] or 0
    bound = max(rows_per_task, math.ceil(total / MOST_HOT), 1)
    hot = F.broadcast(sizes.filter(F.col("count") > bound).select("_hash", F.ceil(F.col("count") / bound).cast("int").alias("_salts")))
    dealt = F.pmod(F.xxhash64(F.lit(7), F.col(record)), F.coalesce("_salts", F.when(F.col(key).isNull(), 1000).otherwise(1)))
    spread = marked.join(hot, "_hash", "left").withColumn("_salt", dealt.cast("int")).drop("_hash", "_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    many = side.withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left").withColumn("_salt", F.explode(copies)).drop("_hash", "_salts")
    return spread, many


def lookup_join(rows: DataFrame, side: DataFrame, key: str, record: str, broadcast_rows: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Left join of a fat table with one row per key.

    The side is written once and counted. Up to ``broadcast_rows`` rows it is
    broadcast. Beyond that the join shuffles, hot keys in parts (``salted``).
    """
    side = stage(side)
    if side.count() <= broadcast_rows:
        return rows.join(F.broadcast(side), key, "left")
    spread, many = salted(rows, side, key, record, rows_per_task)
    return spread.join(many, [key, "_salt"], "left").drop("_salt")


def largest_group(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows in the biggest group, rows in total), from one partial aggregation."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    biggest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return biggest or 0, total or 0


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: dict[str, Column],
    limit: int,
) -> DataFrame:
    """Inclusive running sums in ``order`` within ``keys``, for groups of any size.

    Without keys the rows are always cut into slices, so no window holds the whole table.
    """
    if keys:
        biggest, total = largest_group(df, keys)
    else:
        df = stage(df)
        biggest = total = df.count()
    if keys and biggest <= limit:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({name: F.sum(e).over(upto) for name, e in totals.items()})
    slices = math.ceil(total / limit) + (1 if keys else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = stage(df.repartitionByRange(slices, *keys, *order).withColumn(SLICE, F.spark_partition_id()))
    by = [*keys, SLICE]
    sums = cut.groupBy(*by).agg(*[F.sum(e).alias(name) for name, e in totals.items()])
    if keys:
        before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sums.select(*by, *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"_before_{name}") for name in totals])
    else:  # one row per slice
        held, lines = dict.fromkeys(totals, 0), []
        for row in sorted(sums.collect(), key=lambda r: r[SLICE]):
            lines.append((row[SLICE], *held.values()))
            held = {name: held[name] + (row[name] or 0) for name in totals}
        kinds = ", ".join(f"_before_{name} {sums.schema[name].dataType.simpleString()}" for name in totals)
        offsets = F.broadcast(df.sparkSession.createDataFrame(lines, f"{SLICE} int, {kinds}"))
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({name: F.sum(e).over(upto) for name, e in totals.items()})
    joined = join_on(local, offsets, by)
    return joined.withColumns({name: F.col(name) + F.col(f"_before_{name}") for name in totals}).drop(
        SLICE, *[f"_before_{name}" for name in totals]
    )


def lay_out(df: DataFrame, track: Track, sized_by: DataFrame | None = None) -> DataFrame:
    """Number rows and cut long series into blocks; short series stay as they are.

    ``sized_by`` may name a frame that is cheaper to count and has at least as many
    rows per entity, such as the rows before cleaning.
    """
    if BLOCK in df.columns:
        return df
    biggest, _ = largest_group(df if sized_by is None else sized_by, [track.entity])
    if biggest > track.block_rows and sized_by is not None:
        biggest, _ = largest_group(df, [track.entity])
    if biggest <= track.block_rows:
        return df
    numbered = running_totals(df, [track.entity], track.order, {SEQ: F.lit(1).cast("long")}, track.block_rows)
    return stage(
        numbered.withColumn(SEQ, F.col(SEQ) - 1).withColumn(BLOCK, F.floor(F.col(SEQ) / track.block_rows))
    )


def clear_layout(df: DataFrame) -> DataFrame:
    return df.drop(SEQ, BLOCK)


def in_order(df: DataFrame, track: Track) -> WindowSpec:
    """The window over one series, or over one block of a laid-out series."""
    if BLOCK in df.columns:
        return Window.partitionBy(track.entity, BLOCK).orderBy(SEQ)
    return Window.partitionBy(track.entity).orderBy(*track.order)


def in_reverse(df: DataFrame, track: Track) -> WindowSpec:
    """The same window from the end: looking ahead there is a running frame, not one that starts anew at each row."""
    if BLOCK in df.columns:
        return Window.partitionBy(track.entity, BLOCK).orderBy(F.desc(SEQ))
    return Window.partitionBy(track.entity).orderBy(*[F.desc(c) for c in track.order])


def position(df: DataFrame, track: Track) -> Column:
    """Zero-based row number within the series."""
    if SEQ in df.columns:
        return F.col(SEQ)
    return (F.row_number().over(in_order(df, track)) - 1).cast("long")


def bounded(
    df: DataFrame, track: Track, reach: int, compute: Callable[[DataFrame, WindowSpec], DataFrame]
) -> DataFrame:
    """Run window code in which a row needs at most ``reach`` earlier rows."""
    if BLOCK not in df.columns:
        return compute(df, in_order(df, track))
    if reach >= track.block_rows:
        raise ValueError("block_rows must exceed the number of rows looked back")
    own = F.struct(F.col(BLOCK).alias("block"), F.lit(False).alias("borrowed"))
    lent = F.struct((F.col(BLOCK) + 1).alias("block"), F.lit(True).alias("borrowed"))
    at_end = F.col(SEQ) % track.block_rows >= track.block_rows - reach
    copies = F.explode(F.when(at_end, F.array(own, lent)).otherwise(F.array(own)))
    widened = (
        df.withColumn("_copy", copies)
        .withColumns({BLOCK: F.col("_copy.block"), BORROWED: F.col("_copy.borrowed")})
        .drop("_copy")
    )
    return compute(widened, in_order(widened, track)).filter(~F.col(BORROWED)).drop(BORROWED)


def look_around(
    df: DataFrame,
    track: Track,
    last: dict[str, Column] | None = None,
    before: dict[str, Column] | None = None,
    ahead: dict[str, Column] | None = None,
    counts: dict[str, Column] | None = None,
) -> DataFrame:
    """Look along the series without limit, everything in one pass.

    ``last``: latest non-null value up to the row; ``before``: strictly earlier;
    ``ahead``: nearest non-null value from the row on; ``counts``: rows up to this
    one that satisfy a condition. Rows without an entity form no series.

    Blocks are written first, because both the rows and their summary read them;
    chained calls would otherwise double the plan each time.
    """
    last, before, ahead, counts = last or {}, before or {}, ahead or {}, counts or {}
    cut = BLOCK in df.columns
    if cut:
        df = stage(df)
    here, back = in_order(df, track), in_reverse(df, track)
    first_row = Window.unboundedPreceding
    hits = {n: F.coalesce(c.cast("long"), F.lit(0).cast("long")) for n, c in counts.items()}
    local = {n: F.last(e, ignorenulls=True).over(here.rowsBetween(first_row, 0)) for n, e in last.items()}
    local |= {n: F.last(e, ignorenulls=True).over(here.rowsBetween(first_row, -1)) for n, e in before.items()}
    local |= {n: F.last(e, ignorenulls=True).over(back.rowsBetween(first_row, 0)) for n, e in ahead.items()}
    local |= {n: F.sum(h).over(here.rowsBetween(first_row, 0)) for n, h in hits.items()}
    if not cut:
        return df.withColumns(local)

    by = [track.entity, BLOCK]
    backward = last | before

    def at(e: Column) -> Column:
        return F.when(e.isNotNull(), F.col(SEQ))

    summary = df.groupBy(*by).agg(
        *[F.max_by(e, at(e)).alias(n) for n, e in backward.items()],
        *[F.min_by(e, at(e)).alias(n) for n, e in ahead.items()],
        *[F.sum(h).alias(n) for n, h in hits.items()],
    )
    blocks = Window.partitionBy(track.entity).orderBy(BLOCK)
    prior = blocks.rowsBetween(first_row, -1)
    later = Window.partitionBy(track.entity).orderBy(F.desc(BLOCK)).rowsBetween(first_row, -1)
    carried = summary.select(
        *by,
        *[F.last(n, ignorenulls=True).over(prior).alias(f"_carried_{n}") for n in backward],
        *[F.last(n, ignorenulls=True).over(later).alias(f"_carried_{n}") for n in ahead],
        *[F.sum(n).over(prior).alias(f"_carried_{n}") for n in hits],
    )
    joined = df.withColumns(local).join(carried, by, "left")
    whole = {n: F.coalesce(F.col(n), F.col(f"_carried_{n}")) for n in [*backward, *ahead]}
    whole |= {n: F.col(n) + F.coalesce(F.col(f"_carried_{n}"), F.lit(0)) for n in hits}
    return joined.withColumns(whole).drop(*[f"_carried_{n}" for n in whole])
