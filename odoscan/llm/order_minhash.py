"""Near copies by Order MinHash, verified by banded alignment.

A text is its sequence of grams of five lower-cased words; a shorter text with words is
one gram. The n-th occurrence of a gram is labelled n. Each sketch hashes all labelled
grams, takes the smallest few and keeps them in text order, so two texts share it only
if the same grams survive in the same order: the chance falls with edits and moves.
Texts that share a sketch meet in a bucket. Sketches of few grams tell too much, so a
short text (at the threshold 0.8, up to 14 grams) is also keyed by every sequence that
deleting the grams it may lack in a similar text can leave. Two similar short texts
have such a sequence in common and always meet.

The similarity of two texts is m / (a + b - m), where a and b are their gram counts and
m the length of a common subsequence of grams in a diagonal band that is as wide as the
threshold allows: outside it no pair reaches the threshold. Bounds settle most pairs:
the multiset intersection from above, and equality with it if the shared grams are
distinct and already in order.

Equal texts are collapsed before and share a class. Buckets that share a member form a
crowd, found as a connected component without listing pairs. A crowd is cut into blocks
of bounded size, and every two of its blocks meet in one task. There, pairs are counted
through an index of grams, never listed; a pair that can reach the threshold is aligned
unless it is connected already, so a task returns fewer links than it has texts, and no
text is left out. Classes are the connected components of these verified links, which
are those of all similar pairs that meet: every pair of short texts, and longer ones
but for the chance that no sketch is shared.

Texts without words (null, empty, blank) are copies of one another. Repeated rows are
copies. An empty table gives no classes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoscan.llm.common import LOWER, byte_chunks, grams, hash_words, mix64, numbered, stage, text_of
from odoscan.llm.components import components

GRAM, SKETCHES, KEPT, THRESHOLD = 5, 32, 5, 0.8
#: Texts and grams in a block of a crowd.
MOST_TEXTS, MOST_GRAMS = 1000, 1_000_000
#: Exact keys of a short text.
MOST_EXACT = 128

_SEEDS = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def text_grams(raw: np.ndarray, offsets: np.ndarray, gram: int = GRAM) -> list[np.ndarray]:
    """The gram hashes of each text, in order."""
    (hashes,), first, _, _ = hash_words(LOWER[raw], offsets)
    rolled = grams(hashes, gram)
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        if b - a >= gram:
            out.append(rolled[a : b - gram + 1])
        else:
            out.append(grams(hashes[a:b], b - a) if b > a else hashes[:0])
    return out


def labelled(sequence: np.ndarray) -> np.ndarray:
    """Hashes of (gram, how often it occurred before)."""
    order = np.argsort(sequence, kind="stable")
    ordered = sequence[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if new.all():
        return mix64(sequence)
    heads = np.flatnonzero(new)
    before = np.empty(len(sequence), dtype=np.uint64)
    before[order] = (np.arange(len(ordered)) - np.repeat(heads, np.diff(np.append(heads, len(ordered))))).astype(np.uint64)
    return mix64(sequence + before * np.uint64(0xD1342543DE82EF95))


def sketches(sequence: np.ndarray, count: int = SKETCHES, kept: int = KEPT) -> np.ndarray:
    """One 64-bit key per sketch; none for a text without grams."""
    if not len(sequence):
        return np.zeros(0, np.uint64)
    marks = labelled(sequence)
    few = min(kept, len(marks))
    places = np.empty((count, few), dtype=np.int64)
    for s in range(count):
        value = marks * _SEEDS[s]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        places[s] = np.argpartition(value, few - 1)[:few] if few < len(marks) else np.arange(few)
    places.sort(axis=1)
    picked = marks[places]
    keys = np.arange(count, dtype=np.uint64)
    for j in range(few):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + picked[:, j])
    return keys


def spare(n: int, threshold: float) -> int:
    """Most grams that a text of n grams may lack in a similar text."""
    return min(int((1 - threshold) * n + 1e-9), n - 1)


@lru_cache
def short(threshold: float, kept: int) -> int:
    """Most grams of a short text; texts that have fewer grams than a sketch keeps find only short ones similar."""
    n = 1
    while n < 64 and sum(comb(n + 1, d) for d in range(spare(n + 1, threshold) + 1)) <= MOST_EXACT:
        n += 1
    return max(n, int((kept - 1) / threshold + 1e-9))


@lru_cache(256)
def _left(n: int, gone: int) -> np.ndarray:
    """Places that stay when ``gone`` of n are deleted, one row per way."""
    return np.array(list(combinations(range(n), n - gone)), dtype=np.int64)


def exact_keys(sequence: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Keys of all sequences that deleting as many grams as a similar text may lack can leave."""
    out = []
    for gone in range(spare(len(sequence), threshold) + 1):
        picked = sequence[_left(len(sequence), gone)]
        keys = np.full(len(picked), len(sequence) - gone, dtype=np.uint64)
        for j in range(picked.shape[1]):
            keys = mix64((keys + picked[:, j]) * np.uint64(0xD6E8FEB86659FD93))
        out.append(keys)
    return np.unique(np.concatenate(out))


def meeting_keys(sequence: np.ndarray, count: int = SKETCHES, kept: int = KEPT, threshold: float = THRESHOLD) -> np.ndarray:
    """Sketches, exact keys, or both for a short text that longer ones may be similar to."""
    n, most = len(sequence), short(threshold, kept)
    if not n or n > most:
        return sketches(sequence, count, kept)
    exact = exact_keys(sequence, threshold)
    return exact if n + 1e-9 < threshold * (most + 1) else np.concatenate([sketches(sequence, count, kept), exact])


def needed(a: int, b: int, threshold: float) -> int:
    """Fewest common grams with which two texts of a and b grams reach the threshold."""
    return int(np.ceil(threshold * (a + b) / (1 + threshold) - 1e-9))


def banded_common(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence whose matches lie within ``band`` of the diagonal; a row is one long integer."""
    where: dict[int, int] = {}
    for j, x in enumerate(b.tolist()):
        where[x] = where.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    window = (1 << (2 * band + 1)) - 1
    rows = full
    for i, x in enumerate(a.tolist()):
        match = where.get(x, 0)
        if match:
            low = i - band
            match &= window << low if low >= 0 else window >> -low
            step = rows & match
            rows = ((rows + step) | (rows - step)) & full
    return len(b) - rows.bit_count()


def similar(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Whether the aligned similarity of two gram sequences reaches the threshold."""
    if not len(a) or not len(b):
        return len(a) == len(b)
    least = needed(len(a), len(b), threshold)
    if min(len(a), len(b)) < least:
        return False
    if len(a) == len(b) and np.array_equal(a, b):
        return True
    marked = [labelled(x) for x in (a, b)]
    _, at, against = np.intersect1d(marked[0], marked[1], assume_unique=True, return_indices=True)
    if len(at) < least:
        return False
    order = np.argsort(at)
    if (np.diff(against[order]) > 0).all() and np.abs(at - against).max() <= len(a) + len(b) - 2 * least:
        return True
    return banded_common(a, b, len(a) + len(b) - 2 * least) >= least


def _digest(text: bytes) -> tuple[int, int]:
    found = hashlib.sha256(text).digest()
    return int.from_bytes(found[:8], "big", signed=True), int.from_bytes(found[8:16], "big", signed=True)


def digest_columns(text: Column) -> list[Column]:
    """The same two longs in the engine: the first 128 bits of the SHA-256."""
    found = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    return [F.conv(F.substring(found, 1 + 16 * i, 16), 16, -10).cast("long") for i in range(2)]


def sketch_table(docs: DataFrame, id_col: str, text_col: str, gram: int = GRAM, count: int = SKETCHES, kept: int = KEPT, threshold: float = THRESHOLD) -> DataFrame:
    """(row, doc_id, k1, k2, n_grams, keys) for every row of ``docs``, written once."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = _digest(b"")
        for batch in batches:
            raw, offsets = text_of(batch.column(1))
            for low, high in byte_chunks(offsets):
                data, bounds = raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                found = text_grams(data, bounds, gram)
                keys = [meeting_keys(g, count, kept, threshold).view(np.int64) for g in found]
                digests = [_digest(data[a:b].tobytes()) if len(g) else empty for g, a, b in zip(found, bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array([d[0] for d in digests], pa.int64()),
                        pa.array([d[1] for d in digests], pa.int64()),
                        pa.array([len(g) for g in found], pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "k1", "k2", "n_grams", "keys"],
                )

    columns = docs.select(F.col(id_col), F.col(text_col))
    return numbered(columns.mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, n_grams long, keys array<long>"), "row")


class _Forest:
    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x


def links_between(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Verified links that connect whatever all similar pairs would connect.

    Pairs are (left, right) or, without ``right``, two of the left ones. Shared grams are
    counted through an index of the right side's grams; pairs that these counts allow are
    aligned, the closest first, unless earlier links connect them already.
    """
    same = right is None
    others = left if same else right
    forest, shift = _Forest(len(left) + (0 if same else len(others))), 0 if same else len(left)
    marks = [labelled(x) for x in others]
    sizes = np.array([len(x) for x in others], dtype=np.int64)
    every = np.concatenate(marks) if marks else np.zeros(0, np.uint64)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], np.repeat(np.arange(len(others)), sizes)[order]
    out = []
    for i, sequence in enumerate(left):
        own = marks[i] if same else labelled(sequence)
        low, high = np.searchsorted(every, own), np.searchsorted(every, own, side="right")
        count = high - low
        at = np.arange(count.sum()) + np.repeat(low - np.cumsum(count) + count, count)
        shared = np.bincount(owner[at], minlength=len(others))
        least = np.ceil(threshold * (len(own) + sizes) / (1 + threshold) - 1e-9)
        fit = (shared >= least) & (shared > 0)
        if same:
            fit[: i + 1] = False
        near = np.flatnonzero(fit)
        for j in near[np.argsort(-shared[near] / (len(own) + sizes[near]), kind="stable")].tolist():
            a, b = forest.root(i), forest.root(shift + j)
            if a != b and similar(sequence, others[j], threshold):
                forest.up[a] = b
                out.append((i, j))
    return out


def cell_links(cells: DataFrame, threshold: float, gram: int) -> DataFrame:
    """Links (node, leader) from cells of texts: (crowd, low, high, block, node, text)."""

    def solve(nodes: list[int], blocks: list[int], texts: list[str], cell: tuple) -> list[tuple[int, int]]:
        data = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
        raw = np.frombuffer(b"".join(data), np.uint8)
        found = [g for low, high in byte_chunks(offsets) for g in text_grams(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], gram)]
        if cell[1] == cell[2]:
            return [(nodes[a], nodes[b]) for a, b in links_between(found, None, threshold)]
        left, right = ([i for i, b in enumerate(blocks) if b == side] for side in cell[1:])
        pairs = links_between([found[i] for i in left], [found[i] for i in right], threshold)
        return [(nodes[left[a]], nodes[right[b]]) for a, b in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells come whole and one after the other."""
        cell, waiting, links = None, [], []

        def flush() -> None:
            if len(waiting) > 1:
                nodes, blocks, texts = zip(*waiting, strict=True)
                links.extend(solve(list(nodes), list(blocks), list(texts), cell))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["node", "leader"]
            )

        for batch in batches:
            heads = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            rest = zip(batch.column(4).to_pylist(), batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True)
            for head, row in zip(heads, rest, strict=True):
                if head != cell:
                    flush()
                    cell, waiting = head, []
                waiting.append(row)
            if links:
                yield out()
                links = []
        flush()
        if links:
            yield out()

    by = ["crowd", "low", "high"]
    ordered = cells.select(*by, "block", "node", "text").repartition(*by).sortWithinPartitions(*by)
    return ordered.mapInArrow(run, "node long, leader long")


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    gram: int = GRAM,
    count: int = SKETCHES,
    kept: int = KEPT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, k1 and k2 (digest), class_id, class_size, keep.

    class_id is the smallest id in the class; ``keep`` marks one row of each class.
    """
    table = sketch_table(docs, id_col, text_col, gram, count, kept, threshold)
    nodes = stage(table.groupBy("k1", "k2").agg(F.min("row").alias("node"), F.first("n_grams").alias("n_grams"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")))
    alone = table.select("row", "n_grams", "keys").join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    keyed = alone.select(F.col("row").alias("node"), "n_grams", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key")
    members = stage(keyed.join(shared, "key").select("key", "node", "n_grams"))
    # Crowds: everything that sketches connect, verified or not. Similar texts are in one crowd.
    first = members.groupBy("key").agg(F.min("node").alias("leader"))
    met = members.join(first, "key").filter("node != leader").select("node", "leader").distinct()
    crowds = stage(components(met, "node", "leader").withColumnRenamed("label", "crowd"))
    sized = crowds.join(nodes.select("node", "k1", "k2", "n_grams"), "node")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / MOST_TEXTS), F.ceil(F.sum("n_grams") / MOST_GRAMS)).cast("int")
    blocks = sized.groupBy("crowd").agg(parts.alias("blocks")).select("crowd", F.greatest("blocks", F.lit(1)).alias("blocks"))
    placed = sized.join(blocks, "crowd").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    celled = placed.select(
        "k1", "k2", "node", "crowd", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("k1", "k2", "node", "crowd", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    k1, k2 = digest_columns(F.col(text_col))
    whole = docs.select(F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2"))
    # Copies carry equal texts: one of them is enough.
    wanted = crowds.join(nodes, "node").select("k1", "k2", "node")
    texts = stage(whole.join(wanted, ["k1", "k2"]).groupBy("node").agg(F.first("text").alias("text")))
    links = stage(cell_links(celled.drop("k1", "k2").join(texts, "node"), threshold, gram))
    labels = components(links, "node", "leader")
    grouped = stage(nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    classes = grouped.groupBy("label").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    named = grouped.select("k1", "k2", "label").join(classes, "label")
    rows = table.select("row", "doc_id", "k1", "k2").join(named, ["k1", "k2"])
    return rows.select("doc_id", "k1", "k2", "class_id", "class_size", (F.col("row") == F.col("label")).alias("keep"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of each class, with all its columns; among equal rows it does not matter which stays."""
    kept = near_classes(docs, id_col, text_col, **settings).filter("keep").select("doc_id", F.col("k1").alias("c1"), F.col("k2").alias("c2")).distinct()
    k1, k2 = digest_columns(F.when(F.trim(F.translate(F.col(text_col), "\t\n\x0b\x0c\r", "     ")) != "", F.col(text_col)))
    # Rows travel as one column, so that no name of theirs meets another.
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    return marked.join(kept, same, "left_semi").dropDuplicates(["id", "k1", "k2"]).select("whole.*")
