"""Removal of word windows that occur more than once, behind a count-min prefilter.

First pass. The smallest-hashed gram of ``gram`` words inside a window is the window's
anchor. Equal windows have equal anchors at equal distances, so a window occurs at most
as often as its anchor: counting anchors, about one in fourteen words, overestimates
window counts. Each task counts its anchors in two hashed rows of a count-min sketch and
hands on only the cells it touched; the partial sketches are merged cell range by cell
range, and the cells reached at least twice come back as bits.

Second pass. Windows whose anchor has reached two in both rows are grouped exactly, by
two independent 64-bit hashes of their words. A block of texts first settles windows
that it holds twice, and sends on one row for each of its distinct windows, so a window
held by a third of all texts costs a group one row per block. Cells shared by chance
only cause more grouping; no window is lost. The bits are of fixed size, whatever the
input; when there are many more anchors than cells, more windows are grouped exactly.

Results are kept per distinct text (128 bits of its SHA-256), so that copies share them.
Null texts have no words. Ties between equal grams go to the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odoscan.llm.common import byte_chunks, grams, hash_words, mix64, text_of

#: Cells in each of the two rows of the sketch, and ranges in which partial sketches are merged.
CELLS, RANGES = 1 << 27, 64
#: Bytes of text, and windows to group, after which equal windows are settled and sent on.
BLOCK, WINDOWS = 24 << 20, 1_000_000


def text_key(text: bytes) -> tuple[int, int]:
    digest = hashlib.sha256(text).digest()
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:16], "big", signed=True)


_PLACE = np.uint64((1 << 31) - 1)
_LENGTH = (1 << 31) - 1


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value (by its high bits) in each run of ``width`` values."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    least, span = (values & ~_PLACE) | np.arange(len(values), dtype=np.uint64), 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: span - width], least[width - span :])
    return (least & _PLACE).astype(np.int64)


def cells(anchors: np.ndarray, size: int) -> list[np.ndarray]:
    """The cell of each anchor in the two rows."""
    mask = np.uint64(size - 1)
    return [(anchors & mask).astype(np.int64), (mix64(anchors + np.uint64(0x9E3779B97F4A7C15)) & mask).astype(np.int64)]


class Words:
    """Windows and anchors of the texts of one chunk."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, window: int, gram: int, ways: int):
        hashes, self.first, self.starts, self.ends = hash_words(raw, offsets, ways)
        self.window, self.hashes = window, hashes
        self.owner = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        n = len(hashes[0])
        inside = np.zeros(n, dtype=bool)  # windows that start here and end in the same text
        if n >= window:
            inside[: n - window + 1] = self.owner[: n - window + 1] == self.owner[window - 1 :]
        self.at = np.flatnonzero(inside)
        self.grams = grams(hashes[0], gram)
        self.anchor_at = window_minima(self.grams, window - gram + 1)[self.at] if len(self.at) else self.at

    def anchors(self) -> np.ndarray:
        return self.grams[np.unique(self.anchor_at)]


def count_cells(docs: DataFrame, text_col: str, anchors_of: Callable, size: int, levels: tuple[int, ...] = (2,)) -> list[bytes]:
    """For each level, bits of the cells, row after row, that anchors have reached at least so often."""
    most = max(levels)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            anchors = np.concatenate(seen)
            for row, cell in enumerate(cells(anchors, size)):
                where, times = np.unique(cell, return_counts=True)
                part = where * RANGES // size
                cuts = np.searchsorted(part, np.arange(RANGES + 1))
                some = [p for p in range(RANGES) if cuts[p] < cuts[p + 1]]
                pieces = [slice(cuts[p], cuts[p + 1]) for p in some]
                counts = np.minimum(times, most).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row * RANGES + p for p in some], pa.int32()),
                        pa.array([(where[s] - p * (size // RANGES)).astype("<u4").tobytes() for p, s in zip(some, pieces, strict=True)], pa.binary()),
                        pa.array([counts[s].tobytes() for s in pieces], pa.binary()),
                    ],
                    ["part", "cells", "counts"],
                )

        for batch in batches:
            raw, offsets = text_of(batch.column(0))
            for low, high in byte_chunks(offsets):
                seen.append(anchors_of(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]))
                held += len(seen[-1])
                if held > 4_000_000:
                    yield from flush()
                    seen, held = [], 0
        if seen:
            yield from flush()

    def merge(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size // RANGES, dtype=np.uint8)
        for part in parts:
            for where, times in zip(part.column("cells"), part.column("counts"), strict=True):
                at = np.frombuffer(where.as_buffer(), "<u4")
                total[at] = np.minimum(total[at].astype(np.uint16) + np.frombuffer(times.as_buffer(), np.uint8), most)
        bits = [np.packbits(total >= level).tobytes() for level in levels]
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([bits], pa.list_(pa.binary()))], ["part", "bits"])

    touched = docs.select(text_col).mapInArrow(count, "part int, cells binary, counts binary")
    merged = touched.groupBy("part").applyInArrow(merge, "part int, bits array<binary>")
    out = [np.zeros((2 * RANGES, size // RANGES // 8), dtype=np.uint8) for _ in levels]
    for part, bits in merged.toLocalIterator():  # 2 * size bits for each level, whatever the input
        for table, some in zip(out, bits, strict=True):
            table[part] = np.frombuffer(some, np.uint8)
    return [table.tobytes() for table in out]


def reached(bits: np.ndarray, anchors: np.ndarray, size: int) -> np.ndarray:
    """Whether both cells of each anchor are set."""
    ok = np.ones(len(anchors), dtype=bool)
    for row, cell in enumerate(cells(anchors, size)):
        ok &= (bits[row * (size // 8) + (cell >> 3)] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return ok


def repeated_spans(docs: DataFrame, text_col: str = "text", window: int = 35, gram: int = 8, size: int = CELLS) -> DataFrame:
    """(k1, k2, spans): for each distinct text with repeated windows, runs of their first words.

    A run is a long, the first window's start times 2^31 plus the number of windows; runs
    may overlap and come unordered.
    """
    spark = docs.sparkSession

    def anchors(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return Words(raw, offsets, window, gram, 1).anchors()

    (bits,) = count_cells(docs, text_col, anchors, size)
    shared = spark.sparkContext.broadcast(bits)

    def settle(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not found:
            return
        h1, h2, k1, k2, at = (np.concatenate([f[i] for f in found]) for i in range(5))
        # Copies of a text inside the block share their rows but count as often as they occur.
        order = np.lexsort((at, k2, k1, h2, h1))
        h1, h2, k1, k2, at = h1[order], h2[order], k1[order], k2[order], at[order]
        new = np.ones(len(h1), dtype=bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        group = np.cumsum(new) - 1
        times = np.bincount(group)
        alone = times[group] == 1
        # One row per distinct window: with its place if it is alone here, else for its count only.
        send = new
        settled = ~alone
        rows = [
            (h1[send], h2[send], np.minimum(times, 2), k1[send], k2[send], at[send], np.where(alone[send], at[send] + 1, at[send])),
        ]
        # Settled windows travel as runs, under a hash of their own text.
        s1, s2, sat = k1[settled], k2[settled], at[settled]
        order = np.lexsort((sat, s2, s1))
        s1, s2, sat = s1[order], s2[order], sat[order]
        if len(sat):
            keep = np.ones(len(sat), dtype=bool)
            same = (s1[1:] == s1[:-1]) & (s2[1:] == s2[:-1])
            keep[1:] = ~(same & (sat[1:] == sat[:-1]))
            s1, s2, sat = s1[keep], s2[keep], sat[keep]
            begin = np.ones(len(sat), dtype=bool)
            begin[1:] = (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1]) | (sat[1:] != sat[:-1] + 1)
            head = np.flatnonzero(begin)
            last = np.append(head[1:], len(sat)) - 1
            lone = mix64(s1[head].view(np.uint64) ^ mix64(sat[head])).view(np.int64)
            rows.append((lone, s2[head], np.full(len(head), 3), s1[head], s2[head], sat[head], sat[last] + 1))
        for h1, h2, times, k1, k2, start, end in rows:
            place = start << 33 | (end - start) << 2 | times  # one long instead of three columns
            for i in range(0, len(h1), 50_000):
                part = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (h1, h2, k1, k2, place)], ["h1", "h2", "k1", "k2", "place"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        found: list[tuple] = []
        held = 0
        for batch in batches:
            raw, offsets = text_of(batch.column(0))
            for low, high in byte_chunks(offsets):
                data = raw[offsets[low] : offsets[high]]
                bounds = offsets[low : high + 1] - offsets[low]
                words = Words(data, bounds, window, gram, 2)
                maybe = reached(bits, words.grams[words.anchor_at], size)
                at = words.at[maybe]
                if len(at):
                    h = [grams(x, window)[at].view(np.int64) for x in words.hashes]
                    owner = words.owner[at]
                    texts, which = np.unique(owner, return_inverse=True)
                    keys = np.array([text_key(data[bounds[t] : bounds[t + 1]].tobytes()) for t in texts], np.int64).reshape(-1, 2)
                    found.append((*h, keys[which, 0], keys[which, 1], (at - words.first[owner]).astype(np.int64)))
                held += len(data)
                if held > BLOCK or sum(len(f[0]) for f in found) > WINDOWS:
                    yield from settle(found)
                    found, held = [], 0
        yield from settle(found)

    met = docs.select(text_col).mapInArrow(windows, "h1 long, h2 long, k1 long, k2 long, place long")
    times, length = F.col("place").bitwiseAND(F.lit(3)), F.shiftright("place", 2).bitwiseAND(F.lit(_LENGTH))
    total = F.sum(F.when(times < 3, times).otherwise(0)).over(Window.partitionBy("h1", "h2"))
    # A run of settled windows has times 3 and needs no company; a row without a place has length 0.
    kept = met.withColumn("total", total).filter((length > 0) & ((times == 3) | (F.col("total") > 1)))
    return kept.groupBy("k1", "k2").agg(F.collect_set(F.shiftright("place", 2)).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, gram: int = 8, size: int = CELLS) -> DataFrame:
    """Texts without the words of repeated windows.

    Columns: doc_id, n_words, n_removed, kept (the kept words joined by one blank). A null
    or empty text keeps no word and becomes empty.
    """
    spans = repeated_spans(docs, text_col, window, gram, size)
    kind = docs.schema[id_col].dataType.simpleString()
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        *[F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("long").alias(f"k{i + 1}") for i in range(2)],
    )
    joined = keyed.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_of(batch.column(1))
            lists = batch.column(2)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            runs = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            begin, end = runs >> 31, (runs >> 31) + (runs & _LENGTH)
            at = np.concatenate([[0], np.cumsum(sizes)])
            for low, high in byte_chunks(offsets):
                data = raw[offsets[low] : offsets[high]]
                bounds = offsets[low : high + 1] - offsets[low]
                _, first, starts, ends = hash_words(data, bounds, 0)
                counts, removed, kept = np.diff(first), [], []
                text = data.tobytes()
                for i in range(high - low):
                    a, b = first[i], first[i + 1]
                    drop = np.zeros(b - a + 1, dtype=np.int32)
                    mine = slice(at[low + i], at[low + i + 1])
                    if mine.stop > mine.start:
                        np.add.at(drop, begin[mine], 1)
                        np.add.at(drop, end[mine] + window - 1, -1)
                    keep = np.cumsum(drop[:-1]) == 0
                    removed.append(int((~keep).sum()))
                    words = np.flatnonzero(keep) + a
                    kept.append(b" ".join([text[s:e] for s, e in zip(starts[words].tolist(), ends[words].tolist(), strict=True)]).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(counts.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return joined.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept string")
