"""Token counts of the sections of a text, from one encoding of the whole text.

A whole document is encoded once. The bytes of each token give its span of characters
(a token that holds part of a character spans that character), and an interval join of
sorted spans attributes tokens to sections. A token that touches several sections goes

* ``most``: to the section with most of its characters, the earlier one in a tie,
* ``first``: to the section of its first character,
* ``shared``: to all, in proportion to the characters in each.

Sections are given as a column of structs (start, end) of disjoint code-point spans in
any order, or are the lines of the text with their line feeds. Tokens outside every
section are counted under section -1, so that the counts of a text add up to its
tokens. Null and empty texts have no lines; they return one row, section -1 with 0
tokens. Null sections, and spans without characters, get 0 tokens. Rows are handled one
by one: repeated rows repeat, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoscan.llm.common import byte_chunks, text_of
from odoscan.llm.secrets import vocabulary

RULES = ("most", "first", "shared")
_WIDTHS: dict[str, np.ndarray] = {}


def token_bytes(path: str) -> np.ndarray:
    """Length in bytes of every token of a vocabulary."""
    if path not in _WIDTHS:
        known = vocabulary(path)
        widths = np.zeros(known.n_vocab, dtype=np.int64)
        for token, rank in known._mergeable_ranks.items():
            widths[rank] = len(token)
        _WIDTHS[path] = widths
    return _WIDTHS[path]


def char_spans(text: str, data: bytes, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First and end character of each token of a text."""
    widths = token_bytes(path)[vocabulary(path).encode_to_numpy(text, disallowed_special=())]
    ends = np.cumsum(widths)
    starts = ends - widths
    if len(data) == len(text):
        return starts, ends
    lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    char = np.cumsum(lead) - 1  # the character that a byte belongs to
    return char[starts], char[ends - 1] + 1


def attribute(start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray, rule: str) -> tuple[np.ndarray, float]:
    """Tokens of each section, sorted disjoint non-empty spans [low, high), and tokens of none."""
    counts = np.zeros(len(low))
    if not len(start):
        return counts, 0.0
    if not len(low):
        return counts, float(len(start))
    a = np.searchsorted(high, start, side="right")  # first section that ends behind the token's start
    b = np.searchsorted(low, end, side="left") - 1  # last section that begins before its end
    inside = (a == b) & (a < len(low))
    counts += np.bincount(a[inside], minlength=len(low))
    outside = b < a
    for t in np.flatnonzero(~inside & ~outside):
        touched = np.arange(a[t], b[t] + 1)
        shares = np.minimum(end[t], high[touched]) - np.maximum(start[t], low[touched])
        if rule == "most":
            counts[touched[np.argmax(shares)]] += 1
        elif rule == "first":
            counts[touched[0]] += 1
        else:
            counts[touched] += shares / shares.sum()
    return counts, float(outside.sum())


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    high = np.array(ends, dtype=np.int64)
    return np.concatenate([[0], high[:-1]]).astype(np.int64)[: len(high)], high


def count_tokens(
    docs: DataFrame, vocabulary_file: str, id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None, rule: str = "most"
) -> DataFrame:
    """Per document and section: doc_id, section (its place in the list), start, end, n_tokens, doc_tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = docs.schema[id_col].dataType.simpleString()
    amount = "double" if rule == "shared" else "long"
    schema = f"doc_id {kind}, section int, start long, end long, n_tokens {amount}, doc_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_of(batch.column(1))
            for first, last in byte_chunks(offsets):
                rows = []
                texts = batch.column(1).slice(first, last - first).fill_null("").to_pylist()
                given = batch.column(2).slice(first, last - first).to_pylist() if sections_col else None
                for i, text in enumerate(texts):
                    start, end = char_spans(text, text.encode(), vocabulary_file)
                    if given is None:
                        low, high = line_spans(text)
                        place = np.arange(len(low))
                    else:
                        spans = [(s["start"], s["end"]) if s and s["start"] is not None and s["end"] is not None else (0, 0) for s in given[i] or []]
                        low, high = np.array(spans, dtype=np.int64).reshape(-1, 2).T
                        place = np.argsort(low, kind="stable")
                    full = place[(high > low)[place]]
                    found, none = attribute(start, end, low[full], high[full], rule)
                    counts = np.zeros(len(low))
                    counts[full] = found
                    rows.append((np.arange(len(low)), low, high, counts, none, len(start)))
                lengths = [len(r[0]) + (r[4] > 0 or not len(r[0])) for r in rows]

                def column(k: int, extra, kind, rows=rows) -> pa.Array:
                    parts = []
                    for r in rows:
                        parts.append(r[k])
                        if r[4] > 0 or not len(r[0]):
                            parts.append(np.array([r[4] if extra is None else extra]))
                    return pa.array(np.concatenate(parts).astype(kind))

                owner = np.repeat(np.arange(first, last), lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner)), column(0, -1, np.int32), column(1, 0, np.int64), column(2, 0, np.int64),
                        column(3, None, np.float64 if rule == "shared" else np.int64),
                        pa.array(np.repeat([r[5] for r in rows], lengths).astype(np.int64)),
                    ],
                    ["doc_id", "section", "start", "end", "n_tokens", "doc_tokens"],
                )

    columns = [F.col(id_col), F.col(text_col), *([F.col(sections_col)] if sections_col else [])]
    return docs.select(*columns).mapInArrow(run, schema)
