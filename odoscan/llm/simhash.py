"""SimHash fingerprints and a search through permuted block tables, in DataFrame functions only.

Terms are the blank-separated words of a text. Each occurrence votes on 64 bits with
the bits of its hash; its weight is its length, at most 16 characters, so that short
frequent words count little. Votes are summed two bits to a long, 32 bits apart, which
holds for texts of up to 268 million words. A bit is set if the votes for it exceed
those against it. Equal texts have equal fingerprints; a text without words, empty or
null, has fingerprint 0.

The search cuts fingerprints into more blocks than the radius. Two fingerprints within
the radius agree on at least ``blocks - radius`` blocks, so a table for each choice of
that many blocks, keyed by them, meets every such pair. Equal fingerprints are
collapsed first; each pair is reported once.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Two counters of 32 bits each in one long.
_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF
MOST_WEIGHT = 16


def terms(text: Column) -> Column:
    """Words of a text, split at blanks, tabs and line ends."""
    return F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " ")


def fingerprints(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, fingerprint) for each distinct key; the rows of a key are one text."""
    words = texts.select(key, F.explode(terms(F.coalesce(F.col(text), F.lit("")))).alias("_term"))
    hashed = words.select(
        key, F.xxhash64("_term").alias("_h"), F.least(F.length("_term"), F.lit(MOST_WEIGHT)).cast("long").alias("_w")
    )
    lane = F.lit(_LANES)
    votes = [F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(lane) * F.col("_w")).alias(f"_v{i}") for i in range(32)]
    summed = hashed.groupBy(key).agg(F.sum("_w").alias("_all"), *votes)
    bits = F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"_v{i}").bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(f"_v{i}", 32)
        for ones, place in ((low, i), (high, i + 32)):
            bits = bits.bitwiseOR(F.shiftleft((2 * ones > F.col("_all")).cast("long"), place))
    return summed.select(key, bits.alias("fingerprint"))


def hexed(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64.0


def block_edges(blocks: int) -> list[tuple[int, int]]:
    """(first bit, width) of each block; widths differ by at most one."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def block_tables(prints: DataFrame, column: str, radius: int, blocks: int) -> DataFrame:
    """One row per fingerprint and table: the table's number and the bits of its blocks."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("need radius < blocks <= 64")
    masks = []
    for chosen in combinations(block_edges(blocks), blocks - radius):
        mask = sum(((1 << width) - 1) << first for first, width in chosen)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    keys = F.array(*[F.col(column).bitwiseAND(F.lit(m).cast("long")) for m in masks])
    return prints.select(column, F.posexplode(keys).alias("table", "block"))


def within_radius(left: DataFrame, right: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All (fingerprint, other, distance) of distinct fingerprints in two tables within the radius.

    Both tables need a long column ``fingerprint``; nulls are left out. The number of
    rows is the number of links found, each once: a link met in several tables is
    reported by the first table in which both agree.
    """
    a = left.select("fingerprint").filter("fingerprint is not null").distinct()
    b = right.select(F.col("fingerprint").alias("other")).filter("other is not null").distinct()
    at, against = block_tables(a, "fingerprint", radius, blocks), block_tables(b, "other", radius, blocks)
    difference = F.col("fingerprint").bitwiseXOR(F.col("other"))
    edges = block_edges(blocks)
    first = F.lit(None).cast("int")
    choices = list(combinations(edges, blocks - radius))
    for number in range(len(choices) - 1, -1, -1):
        mask = sum(((1 << width) - 1) << place for place, width in choices[number])
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        first = F.when(difference.bitwiseAND(F.lit(mask).cast("long")) == 0, number).otherwise(first)
    met = at.join(against, ["table", "block"]).withColumn("distance", F.bit_count(difference))
    return met.filter((F.col("distance") <= radius) & (first == F.col("table"))).select("fingerprint", "other", "distance")


def following(rows: DataFrame, order: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """Add ``next_<column>`` from the next row in order; after the last row comes the first.

    ``rows`` must be narrow, written, and unique in ``order``. Rows are range-partitioned;
    inside a partition a window looks one row ahead, and a partition's last row gets the
    first row of the next partition that has any. Null stands before all other values.
    """
    from pyspark.sql import Window

    from odoscan.operators.ordering import stage

    slices = max(1, rows.count() // 50_000 + 1)
    cut = stage(rows.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()))
    given = F.struct(*[F.col(c) for c in carried])
    inside = Window.partitionBy("_slice").orderBy(*order)
    local = cut.withColumn("_next", F.lead(given).over(inside))
    heads = cut.groupBy("_slice").agg(F.min_by(given, F.struct(*order)).alias("_head"))  # one row per 50,000
    chain = Window.orderBy("_slice")
    first = F.first("_head").over(chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    later = heads.select("_slice", F.coalesce(F.lead("_head").over(chain), first).alias("_later"))
    joined = local.join(later, "_slice")
    picked = F.coalesce(F.col("_next"), F.col("_later"))
    return joined.select(*rows.columns, *[picked[c].alias(f"next_{c}") for c in carried])
