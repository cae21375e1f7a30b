"""Vector code compression: parts of vectors, coded through a lexicographic trie.

A vector's components become whole numbers, floor(1024 x), and are cut into equal
consecutive parts. Each part position has a codebook of at most 256 entries, fitted by
a few rounds of assigning every part to its nearest entry and replacing each entry by
the floored mean of its parts. A vector's code is its parts' entries.

Equal parts are counted first. The distinct ones are range-partitioned and sorted, so
a task holds consecutive subtrees of the trie whose levels are a part's dimensions.
``trie_nearest`` walks it depth first: a node keeps its distances to all entries, summed
over the dimensions so far, and everything below shares them. Below a bounded number of
leaves a subtree is solved level by level. Leaves take the smallest distance and
add their weighted components to their entry. Sums of entries are all that
reaches the driver; codebooks are all that is broadcast; both have a fixed size.
All arithmetic is exact.

Defined cases. Vectors that are null or hold null or non-finite components are dropped,
so are those that do not have the commonest length (of equally common ones the smallest). A length
that is no multiple of the number of parts is filled up with zeros. Codebooks start from the
smallest ids, null ids after all others, equal ids by their components; with fewer vectors than entries
there are as many entries as vectors. Equal rows get equal codes. Components are held
within +-2^62, and an error beyond a long counts as the largest long. An empty table gives
no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoscan.llm.common import stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Leaves of a subtree that is solved level by level.
LEAVES = 512
_LONGEST, _MOST = 1 << 62, (1 << 63) - 1


def first_difference(parts: np.ndarray) -> np.ndarray:
    """The dimension at which each sorted, distinct part leaves the one before it; 0 for the first."""
    out = np.zeros(len(parts), dtype=np.int64)
    out[1:] = (parts[1:] != parts[:-1]).argmax(axis=1)
    return out


def exact_kind(parts: np.ndarray, entries: np.ndarray):
    """A number type in which no sum of squared differences is rounded."""
    low = min(int(parts.min()), int(entries.min()))
    high = max(int(parts.max()), int(entries.max()))
    bound = parts.shape[1] * (high - low) ** 2
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object


def trie_nearest(parts: np.ndarray, entries: np.ndarray, leaves: int = LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of sorted, distinct parts; the lower of equally near entries.

    Both arguments are whole numbers, one row per part or entry.
    """
    size, dims = parts.shape
    if not size or not dims:
        return np.zeros(size, np.int64), np.zeros(size, np.int64)
    kind = exact_kind(parts, entries)
    rows, table, turns = parts.astype(kind), entries.T.astype(kind), first_difference(parts)
    nearest = np.empty(size, np.int64)
    distance = np.empty(size, object if kind is object else np.int64)

    def grow(above: np.ndarray, at: np.ndarray, dim: int) -> np.ndarray:
        """Distances of the nodes whose first leaves are ``at``, from those of their parents."""
        step = rows[at, dim][:, None] - table[dim]
        step *= step
        step += above
        return step

    def levels(low: int, high: int, dim: int, above: np.ndarray) -> None:
        heads, sums, turned = np.array([low]), above[None], turns[low + 1 : high]
        for d in range(dim, dims):
            now = np.concatenate([[low], low + 1 + np.flatnonzero(turned <= d)]) if len(heads) < high - low else heads
            if len(now) > len(heads):
                sums = sums[np.searchsorted(heads, now, side="right") - 1]
            heads, sums = now, grow(sums, now, d)
        best = sums.argmin(axis=1)
        nearest[low:high] = best
        distance[low:high] = sums[np.arange(len(best)), best]

    waiting = [(0, size, 0, np.zeros(len(entries), dtype=kind))]
    while waiting:  # depth first: the stack holds the children still to visit of each node on the way down
        low, high, dim, above = waiting.pop()
        while dim < dims and high - low > 1 and rows[low, dim] == rows[high - 1, dim]:
            above = grow(above[None], np.array([low]), dim)[0]  # one child only
            dim += 1
        if high - low <= leaves:
            levels(low, high, dim, above)
            continue
        cuts = [low, *(low + 1 + np.flatnonzero(turns[low + 1 : high] == dim)).tolist(), high]
        start, children = 0, []
        for i in range(1, len(cuts)):  # small neighbours go together
            if i + 1 == len(cuts) or cuts[i + 1] - cuts[start] > leaves:
                children.append((cuts[start], cuts[i], dim, above))
                start = i
        waiting.extend(reversed(children))
    return nearest, distance


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows, and where each row is among them."""
    if not rows.shape[1]:
        return rows[:1], np.zeros(len(rows), np.int64)
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    where = np.empty(len(rows), dtype=np.int64)
    where[order] = np.cumsum(new) - 1
    return ordered[new], where


def cells(column: pa.Array, width: int) -> np.ndarray:
    """A list column of ``width`` longs as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


@dataclass
class Codebooks:
    """(entries, dimensions) whole numbers for each part position."""

    books: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and dimension, joined by commas."""
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist()).encode()).hexdigest()


def usable_vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(id, label, v) of usable rows, written once; v holds the whole numbers."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    rows = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("x").isNotNull() & F.forall("x", finite))
    sizes = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    length = sizes["n"] if sizes else 0
    whole = F.transform("x", lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-float(_LONGEST))), F.lit(float(_LONGEST)))))
    filled = F.concat(whole, F.array_repeat(F.lit(0).cast("long"), -length % parts))
    return stage(rows.filter(F.size("x") == length).select("id", "label", filled.alias("v")))


def distinct_parts(rows: DataFrame, parts: int = PARTS) -> DataFrame:
    """(position, part, weight), written in lexicographic order."""
    width = (F.size("v") / parts).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("v", p * width + 1, width))
    counted = rows.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part").agg(F.count(F.lit(1)).alias("weight"))
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(counted.repartitionByRange(slices, "position", "part").sortWithinPartitions("position", "part"))


def entry_sums(table: DataFrame, books: Codebooks) -> DataFrame:
    """(position, entry, dim, total) of each entry's parts; dim -1 counts them."""
    shared = table.sparkSession.sparkContext.broadcast(books.books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), b.shape[1] + 1), dtype=object) for b in shared.value]
        for batch in batches:
            where, weights = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            every = cells(batch.column(1), shared.value[0].shape[1])
            for p in np.unique(where).tolist():
                book, mine = shared.value[p], np.flatnonzero(where == p)
                mine = mine[np.lexsort(every[mine].T[::-1])]  # a batch may reach over several files
                rows, weight = every[mine], weights[mine]
                nearest, _ = trie_nearest(rows, book)
                largest = max(1, int(rows.max(initial=0)), -int(rows.min(initial=0)))
                wide = np.concatenate([np.ones((len(rows), 1), np.int64), rows], axis=1)
                if largest * sum(weight.tolist()) > _LONGEST:
                    wide, weight = wide.astype(object), weight.astype(object)
                order = np.argsort(nearest, kind="stable")
                used, heads = np.unique(nearest[order], return_index=True)
                sums[p][used] += np.add.reduceat((wide * weight[:, None])[order], heads, axis=0).astype(object)
        for p, found in enumerate(sums):
            used = np.flatnonzero(found[:, 0] > 0)
            if len(used):
                width = found.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(used) * width, p), pa.int32()),
                        pa.array(np.repeat(used, width), pa.int32()),
                        pa.array(np.tile(np.arange(-1, width - 1), len(used)), pa.int32()),
                        pa.array([Decimal(int(x)) for x in found[used].ravel()], pa.decimal128(38, 0)),
                    ],
                    ["position", "entry", "dim", "total"],
                )

    tall = table.mapInArrow(run, "position int, entry int, dim int, total decimal(38,0)")
    return tall.groupBy("position", "entry", "dim").agg(F.sum("total").cast("decimal(38,0)").alias("total"))


def fit_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of the rows that ``usable_vectors`` gives."""
    seeds = [r["v"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()]
    start = np.array(seeds, dtype=np.int64).reshape(len(seeds), -1 if seeds and seeds[0] else 0)
    books = Codebooks(np.split(start, parts, axis=1))
    if not start.size:
        return books
    table = distinct_parts(rows, parts)
    for _ in range(rounds):
        found: dict[tuple[int, int], dict[int, int]] = {}
        for r in entry_sums(table, books).collect():  # at most parts x entries x (dimensions + 1) rows
            found.setdefault((r["position"], r["entry"]), {})[r["dim"]] = int(r["total"])
        books = Codebooks([b.copy() for b in books.books])
        for (p, e), sums in found.items():
            books.books[p][e] = [sums[d] // sums[-1] for d in range(books.books[p].shape[1])]
    return books


def assign_codes(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, code, error) of every row; a batch's parts are walked as tries of their own."""
    shared = rows.sparkSession.sparkContext.broadcast(books.books)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        digits = max(2, len(f"{max(len(books[0]) - 1, 0):x}"))
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = cells(batch.column(2), sum(b.shape[1] for b in books))
            codes, errors, at = [], np.zeros(batch.num_rows, dtype=object), 0
            for book in books:
                part, where = distinct_rows(whole[:, at : at + book.shape[1]])
                nearest, distance = trie_nearest(part, book)
                codes.append([f"{e:0{digits}x}" for e in nearest.tolist()])
                codes[-1] = [codes[-1][w] for w in where.tolist()]
                errors += distance.astype(object)[where]
                at += book.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(map("".join, zip(*codes, strict=True)), pa.string()),
                    pa.array([min(int(e), _MOST) for e in errors], pa.int64()),
                ],
                ["id", "label", "code", "error"],
            )

    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def with_group_total(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over equal keys, nulls together, within a long.

    The few keys that hold over a thousandth of the rows meet their sums in a broadcast
    of at most a thousand rows, so no task receives a hot key; the others are joined.
    """
    total = F.sum(F.col(value).cast("decimal(38,0)"))
    sums = stage(rows.groupBy(F.col(key).alias("_key")).agg(total.alias("_total"), F.count(F.lit(1)).alias("_n")))
    every = sums.agg(F.sum("_n")).first()[0] or 0
    capped = F.least(F.col("_total"), F.lit(Decimal(_MOST)).cast("decimal(38,0)")).cast("long")
    hot = F.broadcast(sums.filter(F.col("_n") > every / 1000).select(F.col("_key").alias("_hot"), capped.alias("_hot_total")))
    rest = sums.filter(F.col("_n") <= every / 1000).select(
        F.lit(0).cast("long").alias("_zero"), F.col("_key").alias("_rest"), capped.alias("_rest_total")
    )
    met = rows.join(hot, rows[key].eqNullSafe(hot["_hot"]), "left")
    # Rows that have their sum already are spread by a salt that the other side does not have.
    marked = met.withColumn("_salt", F.when(F.col("_hot_total").isNull(), F.lit(0)).otherwise(F.xxhash64(*rows.columns).bitwiseOR(1)))
    same = (marked["_salt"] == rest["_zero"]) & marked[key].eqNullSafe(rest["_rest"])
    return marked.join(rest, same, "left").select(*rows.columns, F.coalesce("_hot_total", "_rest_total").alias(name))


def compress(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """(id, label, code, error, label_error) of every usable vector, and the codebooks."""
    rows = usable_vectors(table, id_col, vector_col, label_col, parts, scale)
    books = fit_codebooks(rows, parts, entries, rounds)
    coded = stage(assign_codes(rows, books))
    return with_group_total(coded, "label", "error", "label_error"), books
