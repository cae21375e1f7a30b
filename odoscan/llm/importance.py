"""Importance resampling towards a target, with words found by an Aho-Corasick automaton.

Texts are lower-cased (A to Z only); everything in ASCII but letters and digits delimits
words. Spark counts the distinct words of both tables, and the commonest ones (a bounded
number) form a dictionary: each is entered between two delimiters
with its CRC-32 and its length as payload. One scan of a text by the automaton emits the
payloads of its words in order. Words outside the dictionary leave gaps in that order and
are hashed one by one, so the result does not depend on the dictionary's size.

A feature is a run of 1 to ``n`` words joined by one space. Its CRC-32 is composed from
the payloads of its words: the CRC of a joined string is the CRC of the first, carried over
the length of the second by a linear map over bits, xor the CRC of the second. A
feature's bucket is its CRC modulo the number of buckets. Buckets of each document are
written once (two bytes a feature); counting and scoring read these.

A bucket's gain is floor(1000 ln of the ratio of smoothed shares), a document's weight the
floored mean of its features' gains, and its score adds a Gumbel draw that its id decides.
The highest scores among long enough documents are drawn: a sample without replacement
by weight. Ranks come from a range partition, so no task sees all documents.

Defined cases. Null and empty texts have no features and weight 0. A null id counts as an empty
one and comes after all others among ties. Repeated rows are documents of their own; they have the same
score and ranks next to one another. Without target texts all target counts are 0. An empty
table gives no rows. Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odoscan.llm.common import LOWER, MARKS, byte_chunks, hash_words, stage, text_of

BUCKETS, SEED, LEAST_WORDS, PERCENT, SCALE = 10_000, 2024, 20, 10, 1000
#: Words of the dictionary; its size in every worker.
MOST_WORDS = 60_000

_SPACE = np.uint8(0x20)


def spaced(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts in lower case with one space for every delimiter, and one around each text.

    Returns the bytes, each word's first and end byte, and the first word of each text
    (one more entry than texts).
    """
    rows = len(offsets) - 1
    out = np.full(len(raw) + rows + 1, _SPACE)
    place = np.arange(len(raw)) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))
    out[place] = np.where(MARKS[raw], _SPACE, LOWER[raw])
    ink = out != _SPACE
    starts = np.flatnonzero(ink[1:] & ~ink[:-1]) + 1
    ends = np.flatnonzero(ink[:-1] & ~ink[1:]) + 1
    first = np.searchsorted(starts, offsets + np.arange(rows + 1))
    return out, starts, ends, first


def payload(word: bytes) -> int:
    """CRC-32 in the low 32 bits, length in bytes above."""
    return zlib.crc32(word) | len(word) << 32


class Dictionary:
    """Delimiter-bounded words in an automaton that emits their payloads."""

    def __init__(self, words: list[bytes]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for word in words:  # a byte is a character, so that places are places of bytes
            self.automaton.add_word(f" {word.decode('latin-1')} ", payload(word))
        if words:
            self.automaton.make_automaton()
        self.any = bool(words)

    def payloads(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The payload of every word, in order."""
        found = np.zeros(len(starts), dtype=np.uint64)
        data = text.tobytes()
        if self.any and len(starts):
            hits = list(self.automaton.iter(data.decode("latin-1")))
            if hits:
                at, values = np.array(hits, dtype=np.int64).T
                found[np.searchsorted(ends, at)] = values.astype(np.uint64)
        gaps = np.flatnonzero(found == 0)  # a payload holds a length and is never 0
        if len(gaps):
            found[gaps] = [payload(data[a:b]) for a, b in zip(starts[gaps].tolist(), ends[gaps].tolist(), strict=True)]
        return found


@lru_cache(1)
def _crc_steps() -> tuple[np.ndarray, np.ndarray]:
    """Table of one byte's CRC step, and for 2^k zero bytes the maps of each of a CRC's four bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    image = (bits >> np.uint32(8)) ^ table[bits & np.uint32(0xFF)]  # what one zero byte makes of each bit
    maps = []
    for _ in range(40):
        byte = np.zeros((4, 256), dtype=np.uint32)
        for b in range(32):
            byte[b // 8] ^= np.where(np.arange(256) >> (b % 8) & 1, image[b], np.uint32(0)).astype(np.uint32)
        maps.append(byte)
        image = _mapped(byte, image)  # twice as many zero bytes
    return table, np.stack(maps)


def _mapped(byte: np.ndarray, crc: np.ndarray) -> np.ndarray:
    low = np.uint32(0xFF)
    return byte[0][crc & low] ^ byte[1][crc >> 8 & low] ^ byte[2][crc >> 16 & low] ^ byte[3][crc >> 24]


def joined_crc(crc: np.ndarray, more: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of a + b from the CRCs of a and of b, and b's length in bytes."""
    _, maps = _crc_steps()
    out = crc.astype(np.uint32)
    for k in range(int(lengths.max(initial=0)).bit_length()):
        some = np.flatnonzero(lengths >> k & 1)
        out[some] = _mapped(maps[k], out[some])
    return out ^ more.astype(np.uint32)


def feature_buckets(payloads: np.ndarray, first: np.ndarray, n: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of 1 to ``n`` words, text by text, and each text's first bucket (one entry more)."""
    crc, lengths = (payloads & np.uint64(0xFFFFFFFF)).astype(np.uint32), (payloads >> np.uint64(32)).astype(np.int64)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][owner] if len(owner) else np.zeros(0, np.int64)
    runs, owners, at = [crc], [owner], np.arange(len(crc))
    table, _ = _crc_steps()
    for more in range(1, n):
        keep = at + more < end[at]
        at, crc = at[keep], runs[-1][keep]
        # One space, then the payload of the next word.
        crc = ~((~crc >> np.uint32(8)) ^ table[(~crc ^ np.uint32(_SPACE)) & np.uint32(0xFF)])
        word = payloads[at + more]
        runs.append(joined_crc(crc, word & np.uint64(0xFFFFFFFF), lengths[at + more]))
        owners.append(owner[at])
    every, owned = np.concatenate(runs) % np.uint32(buckets), np.concatenate(owners)
    if n > 1:
        order = np.argsort(owned, kind="stable")
        every, owned = every[order], owned[order]
    return every, np.searchsorted(owned, np.arange(len(first)))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of a table with a column ``text``; a chunk of texts sends each word once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_of(batch.column(0))
            for low, high in byte_chunks(offsets, 1 << 22):
                part, bounds = raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                (hashes,), _, starts, ends = hash_words(LOWER[part], bounds, 1, MARKS)
                _, at, counts = np.unique(hashes, return_index=True, return_counts=True)
                data = LOWER[part].tobytes()
                words = [data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts, pa.int64())], ["word", "n"])

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def common_words(texts: DataFrame, most: int = MOST_WORDS) -> list[bytes]:
    """All words from a count on that at most ``most`` words reach, the commonest first, equally common ones by their bytes.

    The count is the edge of one of eight bins to an octave, so a few hundred bin sizes and the
    chosen words are all that reaches the driver.
    """
    counts = stage(word_counts(texts).withColumn("bin", F.floor(F.log2("n") * 8).cast("int")))
    bound, held = None, 0
    for r in sorted(counts.groupBy("bin").count().collect(), key=lambda r: -r["bin"]):
        held += r["count"]
        if held > most:
            break
        bound = r["bin"]
    if bound is None:
        return []
    rows = counts.filter(F.col("bin") >= bound).select("word", "n").collect()
    return [bytes(r["word"]) for r in sorted(rows, key=lambda r: (-r["n"], bytes(r["word"])))]


_DICTIONARIES: dict[str, Dictionary] = {}


def bucket_table(docs: DataFrame, words: list[bytes], n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, buckets) of a table (doc_id, text); buckets are little-endian, of two bytes if that many suffice."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    mark = zlib.crc32(b" ".join(words))
    key = f"{len(words)}:{mark}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _DICTIONARIES:  # one automaton in each worker
            _DICTIONARIES.clear()
            _DICTIONARIES[key] = Dictionary(shared.value)
        known = _DICTIONARIES[key]
        for batch in batches:
            raw, offsets = text_of(batch.column(1))
            for low, high in byte_chunks(offsets):
                text, starts, ends, first = spaced(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                found, bounds = feature_buckets(known.payloads(text, starts, ends), first, n, buckets)
                packed = found.astype(kind).tobytes()
                width = np.dtype(kind).itemsize
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low), pa.array(np.diff(first), pa.int64()),
                        pa.array([packed[a * width : b * width] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)], pa.binary()),
                    ],
                    ["doc_id", "n_words", "buckets"],
                )

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_kind}, n_words long, buckets binary"))


def _packed(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch and each row's first one."""
    raw, offsets = text_of(column)
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    return np.frombuffer(raw.tobytes(), kind), offsets // kind.itemsize


def bucket_counts(table: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features each bucket holds; all that reaches the driver is one count per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_packed(batch.column(0), buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in table.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale ln((t+1)(S+B) / ((s+1)(T+B)))) of every bucket."""
    many = float(len(source))
    ratio = ((target + 1.0) * (float(source.sum()) + many)) / ((source + 1.0) * (float(target.sum()) + many))
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def weights(table: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    shared, buckets = table.sparkSession.sparkContext.broadcast(gain), len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, first = _packed(batch.column(2), buckets)
            sums = np.concatenate([[0], np.cumsum(shared.value[found])])
            size = np.diff(first)
            weight = (sums[first[1:]] - sums[first[:-1]]) // np.maximum(size, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(weight, pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.select("doc_id", "n_words", "buckets").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """floor(-scale ln(-ln u)), where u comes from the SHA-256 of the seed and the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked_highest(rows: DataFrame, order: list[Column], chosen: Column, name: str) -> DataFrame:
    """Number the ``chosen`` rows from 1 in the given order; the others get null.

    Rows are cut into ranges of the order and numbered inside; the sizes of earlier ranges
    are added from a table with one row per range.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.when(chosen, 0).otherwise(1)
    cut = stage(rows.withColumn("_last", first).repartitionByRange(slices, "_last", *order).withColumn("_range", F.spark_partition_id()))
    sizes = cut.filter("_last = 0").groupBy("_range").count().collect()  # one row per range
    before, total = [], 0
    for r in sorted(sizes, key=lambda r: r["_range"]):
        before.append((r["_range"], total))
        total += r["count"]
    offsets = F.broadcast(rows.sparkSession.createDataFrame(before, "_at int, _before long"))
    inside = Window.partitionBy("_range").orderBy("_last", *order)
    numbered = cut.withColumn("_number", F.row_number().over(inside)).join(offsets, F.col("_range") == F.col("_at"), "left")
    rank = F.when(F.col("_last") == 0, F.col("_number") + F.col("_before")).cast("long")
    return numbered.withColumn(name, rank).drop("_last", "_range", "_at", "_before", "_number")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    n: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    most_words: int = MOST_WORDS,
    scale: int = SCALE,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; rank is null where it was not drawn."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.col(target_col).alias("text"))
    words = common_words(rows.select("text").unionByName(wanted.select("text")), most_words)
    found, aim = bucket_table(rows, words, n, buckets), bucket_table(wanted, words, n, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(aim, buckets), scale)
    scored = weights(found, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed, scale))
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.asc("n_features"), F.asc("weight")]
    ranked = ranked_highest(scored, order, F.col("n_words") >= least_words, "rank")
    eligible = found.filter(F.col("n_words") >= least_words).count()
    return ranked.withColumn("rank", F.when(F.col("rank") <= percent * eligible // 100, F.col("rank")))
