"""Removal of byte strings that occur more than once, in documents of any size.

The dealt method sorts all suffixes externally. Its tuples alone are many times the
text, more than the disk a run may use, so this module finds the same bytes without
ordering suffixes that cannot matter (the README has the figures).

A string of ``window`` bytes is represented by its anchor, the first smallest-hashed
``gram`` bytes in it. Equal strings have equal anchors at equal distances, and every
start belongs to one anchor, so the starts of a text fall into runs, about eighty long,
one per anchor. First pass: a count-min sketch over anchors, merged from partial ones;
anchors that occur once, most of them, are done. Second pass: the other runs travel to
their anchor's key, as the bytes they cover; a block of texts first settles runs that
it holds twice. There, strings are compared by two independent 64-bit hashes of all
their bytes. Anchors reached very often travel string by string instead of run by run,
settled block by block, so that no key gathers more than a bounded number of runs or
one row per block.

Results are kept per distinct text (128 bits of its SHA-256); null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoscan.llm.common import _ODD, _STEP, _STEP_INVERSE, _TABLES, _power_table, byte_chunks, mix64, text_of
from odoscan.llm.order_minhash import digest_columns
from odoscan.llm.substring import BLOCK, count_cells, reached, text_key, window_minima

#: Bytes of an anchor; cells in each row of the sketch; occurrences from which an anchor is common.
GRAM, CELLS, COMMON = 40, 1 << 27, 200
#: Strings that a block gathers, and bytes of runs compared at a time.
STRINGS, COMPARED = 1_000_000, 500_000


class Rolling:
    """Hashes of any byte range of an array, from running sums."""

    def __init__(self, raw: np.ndarray, way: int):
        n = len(raw)
        self.back = _power_table(_STEP_INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLES[way][raw] * _power_table(_STEP, n + 1)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * _ODD)

    def every(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mix64((self.sums[width:] - self.sums[:n]) * self.back[:n] + np.uint64(width * int(_ODD) % (1 << 64)))


def runs(raw: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts with one anchor: first start, last start, the anchor's place and hash."""
    none = np.zeros(0, np.int64)
    if len(raw) < window:
        return none, none, none, none.view(np.uint64)
    hashes = Rolling(raw, 0).every(gram)
    place = window_minima(hashes, window - gram + 1)
    long = np.diff(offsets) >= window
    steps = np.zeros(len(raw) + 2, dtype=np.int32)
    np.add.at(steps, offsets[:-1][long], 1)
    np.add.at(steps, offsets[1:][long] - window + 1, -1)
    valid = np.cumsum(steps[: len(place)]) > 0
    new = valid.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    # Adjacent texts can share no anchor, as a string never leaves its text.
    last = valid.copy()
    last[:-1] &= new[1:] | ~valid[1:]
    first = np.flatnonzero(new)
    return first, np.flatnonzero(last), place[first], hashes[place[first]]


def _joined_runs(k1: np.ndarray, k2: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of ranges per text, as few ranges as possible."""
    order = np.lexsort((start, k2, k1))
    k1, k2, start, end = k1[order], k2[order], start[order], end[order]
    text = np.zeros(len(k1), dtype=np.int64)
    text[1:] = np.cumsum((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
    far = int(end.max(initial=0)) + 2
    reach = np.maximum.accumulate(end + text * far)
    new = np.ones(len(k1), dtype=bool)
    new[1:] = start[1:] + text[1:] * far > reach[:-1]
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(k1)) - 1
    return k1[head], k2[head], start[head], (reach - text * far)[tail]


def _repeats(h1: np.ndarray, h2: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's group of equal hashes, the groups' totals, and which rows come first in their group."""
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.empty(len(a), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    first = np.zeros(len(a), dtype=bool)
    first[order] = new
    return group, np.bincount(group, weights=times).astype(np.int64) if len(a) else times, first


FIELDS = [
    ("key", pa.int64()), ("h2", pa.int64()), ("times", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()),
    ("start", pa.int64()), ("end", pa.int64()), ("bytes", pa.binary()),
]
SCHEMA = "key long, h2 long, times int, k1 long, k2 long, start long, end long, bytes binary"
#: Values of ``times``: one occurrence, two or more, or a range that is already known to repeat.
ONE, MORE, KNOWN = 1, 2, 3


def _rows(columns: list, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(columns[0]), size):
        part = [c[low : low + size] if c is not None else None for c in columns]
        arrays = [pa.array(p, t) if p is not None else pa.nulls(len(part[0]), t) for p, (_, t) in zip(part, FIELDS, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, [n for n, _ in FIELDS])


def _known(k1: np.ndarray, k2: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(k1):
        k1, k2, start, end = _joined_runs(k1, k2, start, end)
        key = mix64(k1.view(np.uint64) ^ mix64(start)).view(np.int64)
        yield from _rows([key, k2, np.full(len(k1), KNOWN, np.int32), k1, k2, start, end, None])


def _settle(h1, h2, k1, k2, start, end, content: list | None, keys: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Send one row for each distinct run or string of a block; ranges that the block holds twice are known."""
    group, total, first = _repeats(h1, h2, np.ones(len(h1)))
    alone = total[group] == 1
    yield from _known(k1[~alone], k2[~alone], start[~alone], end[~alone])
    send = np.flatnonzero(first)
    times = np.where(alone[send], ONE, MORE).astype(np.int32)
    stop = np.where(alone[send], end[send], start[send])  # without a place, as its ranges are known
    key = (h1 if keys is None else keys)[send]
    yield from _rows([key, h2[send], times, k1[send], k2[send], start[send], stop, [content[i] for i in send] if content else None])


def repeated_ranges(docs: DataFrame, text_col: str, window: int, gram: int, size: int, common: int) -> DataFrame:
    """(k1, k2, spans): ranges (start, end) of starts of repeated strings, per distinct text."""
    spark = docs.sparkSession

    def anchors(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return runs(raw, offsets, window, gram)[3]

    shared = spark.sparkContext.broadcast(count_cells(docs, text_col, anchors, size, (2, common)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(b, np.uint8) for b in shared.value]
        some: list[tuple] = []
        content: list[bytes] = []
        every: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if some:
                parts = [np.concatenate([s[i] for s in some]) for i in range(7)]
                yield from _settle(*parts[:6], content, parts[6])
            if every:
                parts = [np.concatenate([s[i] for s in every]) for i in range(6)]
                yield from _settle(*parts, None, None)

        for batch in batches:
            raw, offsets = text_of(batch.column(0))
            for low, high in byte_chunks(offsets):
                data, bounds = raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                first, last, _, anchor = runs(data, bounds, window, gram)
                maybe = reached(bits[0], anchor, size)
                first, last, anchor = first[maybe], last[maybe], anchor[maybe]
                held += len(data)
                if len(first):
                    often = reached(bits[1], anchor, size)
                    owner = np.searchsorted(bounds, first, side="right") - 1
                    texts, which = np.unique(owner, return_inverse=True)
                    keys = np.array([text_key(data[bounds[t] : bounds[t + 1]].tobytes()) for t in texts], np.int64).reshape(-1, 2)
                    hashes = [Rolling(data, way) for way in (0, 1)]
                    begin = bounds[owner]
                    few = np.flatnonzero(~often)
                    if len(few):
                        a, b = first[few], last[few] + window
                        h = [x.of(a, b).view(np.int64) for x in hashes]
                        some.append((*h, keys[which[few], 0], keys[which[few], 1], a - begin[few], last[few] + 1 - begin[few], anchor[few].view(np.int64)))
                        whole = data.tobytes()
                        content += [whole[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                    many = np.flatnonzero(often)
                    if len(many):
                        count = last[many] - first[many] + 1
                        which_run = np.repeat(many, count)
                        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[which_run]
                        h = [x.of(at, at + window).view(np.int64) for x in hashes]
                        own = which[which_run]
                        every.append((*h, keys[own, 0], keys[own, 1], at - begin[which_run], at - begin[which_run] + 1))
                if held > BLOCK or sum(len(e[0]) for e in every) > STRINGS:
                    yield from flush()
                    some, content, every, held = [], [], [], 0
        yield from flush()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; keys stay whole."""

        def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            key, h2, times, k1, k2, start, end = (rows.column(i).to_numpy() for i in range(7))
            texts = rows.column(7).combine_chunks()
            known = times == KNOWN
            run = ~known & ~texts.is_null().to_numpy(zero_copy_only=False)
            single = ~known & ~run
            at = np.flatnonzero(run)
            content = texts.take(pa.array(at)).to_pylist()
            raw = np.frombuffer(b"".join(content), np.uint8)
            sizes = np.fromiter(map(len, content), np.int64, len(content))
            count = sizes - window + 1
            of = np.repeat(at, count)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            where = np.repeat(np.cumsum(sizes) - sizes, count) + place
            hashes = [Rolling(raw, way).of(where, where + window).view(np.int64) for way in (0, 1)]
            # A run that the block had twice has no place of its own: its starts equal its ends.
            lone = end[of] > start[of]
            a = np.concatenate([hashes[0], key[single]])
            b = np.concatenate([hashes[1], h2[single]])
            much = np.concatenate([times[of], times[single]])
            t1, t2 = np.concatenate([k1[of], k1[single]]), np.concatenate([k2[of], k2[single]])
            begin = np.concatenate([start[of] + place, start[single]])
            placed = np.concatenate([lone, end[single] > start[single]])
            group, total, _ = _repeats(a, b, much)
            keep = placed & (total[group] > 1) if len(a) else placed
            out = [np.concatenate([x[keep], y[known]]) for x, y in ((t1, k1), (t2, k2), (begin, start), (begin + 1, end))]
            if len(out[0]):
                spans = _joined_runs(*out)
                for low in range(0, len(spans[0]), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[low : low + 50_000]) for x in spans], ["k1", "k2", "start", "end"])

        def pieces(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            """Keys stay whole; a batch may hold far more than is compared at a time."""
            key, sizes = rows.column(0).to_numpy(), pc.fill_null(pc.binary_length(rows.column(7)), 0).to_numpy()
            upto = np.cumsum(sizes.astype(np.int64) + 1)
            low = 0
            while low < len(key):
                reach = int(np.searchsorted(upto, (upto[low - 1] if low else 0) + COMPARED, side="right"))
                high = int(np.searchsorted(key, key[reach])) if reach < len(key) else len(key)
                if high <= low:  # the first key alone is larger
                    high = int(np.searchsorted(key, key[low], side="right"))
                yield from found(rows.slice(low, high - low))
                low = high

        waiting: list[pa.RecordBatch] = []
        strings = 0
        for batch in batches:
            if not len(batch):
                continue
            waiting.append(batch)
            strings += len(batch) + batch.column(7).nbytes
            if strings > STRINGS:
                rows = pa.Table.from_batches(waiting)
                key = rows.column(0).to_numpy()
                cut = int(np.searchsorted(key, key[-1]))  # the last key may go on
                if cut:
                    yield from pieces(rows.slice(0, cut))
                    waiting = rows.slice(cut).to_batches()
                strings = sum(len(b) + b.column(7).nbytes for b in waiting)
        if waiting:
            yield from pieces(pa.Table.from_batches(waiting))

    sent = docs.select(text_col).mapInArrow(send, SCHEMA)
    kept = sent.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "k1 long, k2 long, start long, end long")
    return kept.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def remove_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 200,
    gram: int = GRAM,
    size: int = CELLS,
    common: int = COMMON,
) -> DataFrame:
    """Texts without bytes covered by a repeated string: doc_id, n_bytes, n_removed, n_spans, kept (binary)."""
    spans = repeated_ranges(docs, text_col, window, gram, size, common)
    k1, k2 = digest_columns(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2"))
    joined = keyed.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_of(batch.column(1))
            lists = batch.column(2)
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            ranges = lists.flatten()
            begin, end = ranges.field(0).to_numpy(), ranges.field(1).to_numpy()
            for low, high in byte_chunks(offsets):
                removed, pieces, kept = [], [], []
                for i in range(low, high):
                    data = raw[offsets[i] : offsets[i + 1]]
                    if at[i] == at[i + 1]:
                        removed.append(0)
                        pieces.append(0)
                        kept.append(data.tobytes())
                        continue
                    steps = np.zeros(len(data) + 1, dtype=np.int32)
                    np.add.at(steps, begin[at[i] : at[i + 1]], 1)
                    np.add.at(steps, end[at[i] : at[i + 1]] + window - 1, -1)
                    gone = np.cumsum(steps[:-1]) > 0
                    removed.append(int(gone.sum()))
                    pieces.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                    kept.append(data[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low), pa.array(np.diff(offsets[low : high + 1])), pa.array(removed, pa.int64()),
                        pa.array(pieces, pa.int64()), pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
