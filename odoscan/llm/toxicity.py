"""A convolutional text classifier trained in numpy, with thresholds by language.

Words (runs of letters, digits and non-ASCII characters, in lower case) are hashed to
rows of an embedding table. Filters of several widths slide over a text's words, their
largest responses are kept, and a logistic unit turns them into a score. A text of any
length is scored whole. Training uses a bounded sample of labelled rows (``most_rows``),
whole texts again, with sparse adaptive gradients: only words that a filter picked
change. All rows of another part of the labelled ones set each language's threshold,
the one with the best F1 among the edges of ``BINS`` score bins, whose counts are all
that reaches the driver; languages with fewer than ``enough`` toxic rows there use the common one,
which is 0.5 if all languages together have fewer.

The score depends on the text alone. Empty and null texts are scored as one blank word.
Rows without a text of their own, ties and repeated rows are scored like any other row;
without labelled rows of both kinds every score is the share of toxic labels, or 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoscan.llm.common import LOWER, MARKS, byte_chunks, hash_words, text_of

#: Bins of equal width in which scores are counted; a power of two, so that edges are exact.
BINS = 1 << 12


@dataclass
class Plan:
    """Sizes of the model and of its training."""

    buckets: int = 1 << 18
    dim: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    most_rows: int = 8000
    enough: int = 20
    epochs: int = 6
    batch: int = 32
    rate: float = 0.08
    seed: int = 7


@dataclass
class Model:
    plan: Plan
    table: np.ndarray
    filters: list[np.ndarray] = field(default_factory=list)  # (width, dim, filters) each
    bias: np.ndarray | None = None
    top: np.ndarray | None = None
    base: float = 0.0
    thresholds: dict[str | None, float] = field(default_factory=dict)
    common: float = 0.5

    def score(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.top is None:
            return np.full(len(first) - 1, self.base)
        z = self.pooled(ids, first)[0]
        return 1 / (1 + np.exp(-(np.maximum(z, 0).astype(np.float64) @ self.top + self.base)))

    def pooled(self, ids: np.ndarray, first: np.ndarray, places: bool = False):
        """Largest response of each filter per text, and where it was found."""
        plan = self.plan
        counts = np.diff(first)
        room = np.maximum(counts, 1) + max(plan.widths) - 1  # blanks let every word start a window
        begin = np.concatenate([[0], np.cumsum(room)])
        padded = np.full(begin[-1] + max(plan.widths), plan.buckets, dtype=np.int64)
        padded[np.repeat(begin[:-1] - first[:-1], counts) + np.arange(len(ids))] = ids
        words = self.table[padded]
        ends = begin[:-1] + np.maximum(counts, 1)
        edges = np.stack([begin[:-1], ends], axis=1).ravel()
        out, found = [], []
        n = begin[-1]
        for width, kernel in zip(plan.widths, self.filters, strict=True):
            response = words[:n] @ kernel[0]
            for step in range(1, width):
                response += words[step : n + step] @ kernel[step]
            best = np.maximum.reduceat(np.concatenate([response, response[-1:]]), edges, axis=0)[::2]
            out.append(best)
            if places:
                at = np.empty(best.shape, dtype=np.int64)
                for t in range(len(counts)):
                    at[t] = response[begin[t] : ends[t]].argmax(axis=0) + begin[t]
                found.append(at)
        return np.concatenate(out, axis=1) + self.bias, found, padded


def word_ids(raw: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    (hashes,), first, _, _ = hash_words(LOWER[raw], offsets, 1, MARKS)
    return (hashes % np.uint64(buckets)).astype(np.int64), first


def word_contrast(texts: list[np.ndarray], labels: np.ndarray, buckets: int) -> np.ndarray:
    """z-score of each word's presence in toxic against other texts, less what chance explains (2.5)."""
    toxic, other = np.zeros(buckets), np.zeros(buckets)
    for ids, label in zip(texts, labels, strict=True):
        (toxic if label else other)[np.unique(ids)] += 1
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    common = (toxic + other) / (n1 + n0)
    spread = np.sqrt(np.maximum(common * (1 - common) * (1 / n1 + 1 / n0), 1e-12))
    z = (toxic / n1 - other / n0) / spread
    return np.sign(z) * np.maximum(np.abs(z) - 2.5, 0)


def fit(texts: list[np.ndarray], labels: np.ndarray, plan: Plan) -> Model:
    """Train on word ids, integers of any kind; labels are 0 or 1."""
    rng = np.random.default_rng(plan.seed)
    table = np.empty((plan.buckets + 1, plan.dim), np.float32)
    for low in range(0, len(table), 4096):  # the same draws as all at once, without their doubles
        part = table[low : low + 4096]
        part[:] = rng.normal(0, 0.1, part.shape)
    table[-1] = 0
    model = Model(plan, table)
    share = float(labels.mean()) if len(labels) else 0.0
    model.base = share
    if not len(labels) or share in (0.0, 1.0):
        return model
    count = plan.filters * len(plan.widths)
    model.filters = [rng.normal(0, 0.4, (w, plan.dim, plan.filters)).astype(np.float32) for w in plan.widths]
    model.bias = np.zeros(count, np.float32)
    model.top = rng.normal(0, 0.3, count)
    model.base = float(np.log(share / (1 - share)))
    # Start the first dimension at how far a word's share of toxic texts is from its share of others.
    table[:-1, 0] += 0.25 * word_contrast(texts, labels, plan.buckets)
    model.filters[0][0, :, 0] = 0
    model.filters[0][0, 0, 0] = 1
    model.top[0] = 1
    past = {"table": np.full(table.shape[0], 1e-2, np.float32), "bias": np.full(count, 1e-2), "top": np.full(count, 1e-2), "base": 1e-2}
    past_filters = [np.full(k.shape, 1e-2, np.float32) for k in model.filters]
    for epoch in range(plan.epochs):
        rate = plan.rate * (1 - 0.7 * epoch / plan.epochs)
        order = rng.permutation(len(texts))
        for low in range(0, len(order), plan.batch):
            rows = order[low : low + plan.batch]
            first = np.concatenate([[0], np.cumsum([len(texts[r]) for r in rows])])
            ids = np.concatenate([texts[r] for r in rows])
            z, found, padded = model.pooled(ids, first, places=True)
            hidden = np.maximum(z, 0).astype(np.float64)
            error = 1 / (1 + np.exp(-(hidden @ model.top + model.base))) - labels[rows]
            back = (error[:, None] * model.top[None, :] * (z > 0)).astype(np.float32)
            grad_top, grad_bias, grad_base = hidden.T @ error + 1e-3 * model.top, back.sum(axis=0), float(error.sum())
            changed: list[np.ndarray] = []
            by: list[np.ndarray] = []
            for w, (width, kernel) in enumerate(zip(plan.widths, model.filters, strict=True)):
                part = back[:, w * plan.filters : (w + 1) * plan.filters]
                at = found[w]
                grad_kernel = np.zeros_like(kernel)
                for step in range(width):
                    words = padded[at + step]
                    grad_kernel[step] = np.einsum("tf,tfd->df", part, model.table[words])
                    changed.append(words.ravel())
                    by.append((part[:, :, None] * kernel[step].T[None]).reshape(-1, plan.dim))
                past_filters[w] += grad_kernel**2
                kernel -= rate * 0.3 * grad_kernel / np.sqrt(past_filters[w])
            words, inverse = np.unique(np.concatenate(changed), return_inverse=True)
            grad = np.zeros((len(words), plan.dim), np.float32)
            np.add.at(grad, inverse, np.concatenate(by))
            past["table"][words] += (grad**2).mean(axis=1)
            model.table[words] -= rate * grad / np.sqrt(past["table"][words])[:, None]
            model.table[-1] = 0
            past["top"] += grad_top**2
            past["bias"] += grad_bias**2
            past["base"] += grad_base**2
            model.top -= rate * grad_top / np.sqrt(past["top"])
            model.bias -= (rate * grad_bias / np.sqrt(past["bias"])).astype(np.float32)
            model.base -= rate * grad_base / np.sqrt(past["base"])
    return model


def best_threshold(counts: np.ndarray) -> float:
    """The cut with the best F1, in the middle of the gap below it, from (score bin, label) counts."""
    filled = np.flatnonzero(counts.sum(axis=1))[::-1]
    clean, toxic = counts[filled].cumsum(axis=0).T
    at = int(np.argmax(2 * toxic / (clean + toxic + counts[:, 1].sum())))
    below = filled[at + 1] + 1 if at + 1 < len(filled) else 0
    return float(filled[at] + below) / 2 / BINS


def calibrate(model: Model, rows: DataFrame) -> None:
    """Set the thresholds from all of ``rows``, which have text, lang and toxic."""
    scored = score_texts(rows.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("toxic").cast("int").alias("toxic")), model)
    tall = scored.groupBy("lang", F.floor(F.col("score") * BINS).cast("int").alias("bin"), "toxic").count().collect()
    by_lang: dict[str, np.ndarray] = {}
    for r in tall:
        by_lang.setdefault(r["lang"], np.zeros((BINS + 1, 2), np.int64))[r["bin"], r["toxic"]] += r["count"]

    def enough(counts: np.ndarray) -> bool:
        return model.plan.enough <= counts[:, 1].sum() < counts.sum()

    every = sum(by_lang.values(), np.zeros((BINS + 1, 2), np.int64))
    if not enough(every):
        return  # too few to tell: 0.5 for all
    model.common = best_threshold(every)
    for lang, counts in by_lang.items():
        if enough(counts):
            for name in (lang,) if lang else ("", None):
                model.thresholds[name] = best_threshold(counts)


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows by a hash of the id, or all if there are fewer."""
    total = rows.count()
    share = min(1.0, most / max(total, 1))
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 62)) < F.lit(int(share * (1 << 62))))


def _ids(rows: DataFrame, plan: Plan) -> list:
    """Collect word ids of a bounded sample, one row per text, four bytes a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_of(batch.column(1))
            for low, high in byte_chunks(offsets):
                ids, first = word_ids(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], plan.buckets)
                packed = [ids[a:b].astype("<u4").tobytes() for a, b in zip(first, first[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(packed, pa.binary()), batch.column(2).slice(low, high - low)],
                    ["doc_id", "ids", "toxic"],
                )

    found = rows.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = found.mapInArrow(run, f"doc_id {kind}, ids binary, toxic int").collect()
    return sorted(out, key=lambda r: (str(r["doc_id"]), r["ids"]))


def train(docs: DataFrame, labels: DataFrame, plan: Plan | None = None, folds: tuple[int, ...] = (1, 2, 3, 4)) -> Model:
    """Fit on labelled rows whose crc32 remainder is in ``folds``; the first of them calibrates."""
    plan = plan or Plan()
    marked = labels.select("doc_id", "toxic").filter("toxic in (0, 1) and doc_id is not null").dropDuplicates(["doc_id"])
    known = marked.withColumn("fold", remainder("doc_id"))
    texts = docs.select("doc_id", "text", "lang")

    def part(which: tuple[int, ...]) -> DataFrame:
        return known.filter(F.col("fold").isin(*which))

    rows = _ids(texts.join(_sample(part(folds[1:]), plan.most_rows), "doc_id"), plan)
    toxic = np.array([r["toxic"] for r in rows], dtype=np.float64)
    rows = [np.frombuffer(r["ids"], "<u4") for r in rows]  # views: the driver holds each id once
    model = fit(rows, toxic, plan)
    del rows
    calibrate(model, texts.join(part(folds[:1]), "doc_id"))
    return model


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` that are not called so already, and score, in [0, 1]."""
    from pyspark.sql import types as T

    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, fixed by the plan
    kept = docs.drop("score") if "score" in docs.columns else docs
    at = kept.columns.index(text_col)
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            raw, offsets = text_of(batch.column(at))
            for low, high in byte_chunks(offsets, 1 << 19):
                ids, first = word_ids(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], model.plan.buckets)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(ids, first))], [*part.schema.names, "score"])

    return kept.mapInArrow(run, schema)


def threshold_of(model: Model, lang: Column) -> Column:
    """The threshold of a row's language; unknown languages use the common one."""
    out = F.lit(model.common)
    for name, cut in sorted(model.thresholds.items(), key=lambda x: str(x[0])):
        out = F.when(lang.eqNullSafe(F.lit(name)), F.lit(cut)).otherwise(out)
    return out
