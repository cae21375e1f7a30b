"""Secrets in texts: assignments, access keys, long hex runs, and strings that tokenise badly.

The method looks at how many characters a byte-pair vocabulary needs per token. Words
of prose and code compress well; random strings fall apart into short tokens. Strings
that are random by nature but known not to be secrets are excluded first: digests of
the usual lengths, UUIDs, numbers, dates, and identifiers whose parts themselves need
few tokens. All others, of letters only too, are decided by their characters per token.

A vocabulary breaks long rare words of prose, in particular of languages it knows little of, into
short tokens as well. Where ``letter_pairs`` of the table are given, a string of letters only is therefore prose if
its pairs of neighbouring letters are commoner in the table than under equally likely letters. Random
letters are not: half of their pairs are rare in any language.

Spans are in code points, end exclusive. Null texts are empty and have no spans. Rows
are scanned one by one, so repeated rows, ties and extra columns need no rule.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoscan.llm.common import LOWER, byte_chunks, text_of

KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of [0-9a-f]+ that are long enough
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Shortest string judged by its tokens, and the characters per token under which it is random.
SHORTEST, RATIO = 16, 2.4
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST)
_LETTER = re.compile(r"[A-Za-z]")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_UUID = re.compile(r"(?i)[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}")
_HEXES = re.compile(r"(?i)[0-9a-f]+")
#: Hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
_DIGESTS = {32, 40, 56, 64, 96, 128}

_VOCABULARIES: dict[str, object] = {}


def vocabulary(path: str):
    """The byte-pair vocabulary of a ``.tiktoken`` file, one per worker."""
    if path not in _VOCABULARIES:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _VOCABULARIES[path] = tiktoken.Encoding(
            "scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _VOCABULARIES[path]


def known_harmless(word: str) -> bool:
    """Digests, UUIDs, and what has no letter: numbers, dates, rules of dashes."""
    return bool(_UUID.fullmatch(word) or (len(word) in _DIGESTS and _HEXES.fullmatch(word)) or not _LETTER.search(word))


def identifier(word: str, path: str, ratio: float) -> bool:
    """Few, long and readable parts: camelCase, snake_case, paths, version strings."""
    parts = _PART.findall(word)
    letters = [p for p in parts if p[0].isalpha()]
    if sum(map(len, letters)) < 4.5 * len(parts):
        return False
    encode = vocabulary(path).encode_ordinary
    return sum(map(len, letters)) >= ratio * sum(len(encode(p)) for p in letters)


#: Log2 of a letter's chance after another, 26 by 26; none where the table's prose is not known.
Pairs = tuple[tuple[float, ...], ...]


def letter_pairs(docs: DataFrame, text_col: str = "text") -> Pairs:
    """How likely an ASCII letter follows another one in the texts, whatever their case; 676 counts reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(26 * 26, dtype=np.int64)
        for batch in batches:
            raw, offsets = text_of(batch.column(0))
            for low, high in byte_chunks(offsets):
                letters = LOWER[raw[offsets[low] : offsets[high]]].astype(np.int16) - 97
                inside = (letters >= 0) & (letters < 26)
                both = inside[1:] & inside[:-1]
                ends = offsets[low + 1 : high] - offsets[low] - 1
                both[ends[(ends >= 0) & (ends < len(both))]] = False  # not from one text into the next
                total += np.bincount(letters[:-1][both] * 26 + letters[1:][both], minlength=26 * 26)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(26 * 26)), pa.array(total)], ["pair", "n"])

    counts = np.ones((26, 26))
    for r in docs.select(F.col(text_col)).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[divmod(r["pair"], 26)] += r["n"]
    return tuple(map(tuple, np.log2(counts / counts.sum(axis=1, keepdims=True)).tolist()))


def prose(word: str, pairs: Pairs) -> bool:
    """Letters only, and likelier than equally likely letters."""
    if not (word.isascii() and word.isalpha()):
        return False
    places = [ord(c) - 97 for c in word.lower()]
    return sum(pairs[a][b] for a, b in zip(places, places[1:], strict=False)) > -math.log2(26) * (len(places) - 1)


@lru_cache(1 << 16)
def random_string(word: str, path: str, ratio: float, pairs: Pairs | None = None) -> bool:
    if pairs is not None and prose(word, pairs):
        return False
    if known_harmless(word) or len(word) >= ratio * len(vocabulary(path).encode_ordinary(word)):
        return False
    return not identifier(word, path, ratio)


def scan(text: str, path: str, ratio: float = RATIO, pairs: Pairs | None = None) -> list[tuple[int, str, int]]:
    """All spans of a text as (start, kind, end), by start and then kind as listed."""
    found: list[tuple[int, str, int]] = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        found += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    found += [(m.start(), "random", m.end()) for m in _CANDIDATE.finditer(text) if random_string(m[0], path, ratio, pairs)]
    found.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return found


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, str, int]], mark: str = "[SECRET]") -> str:
    """Replace every span; overlapping and touching spans become one mark."""
    out, at, covered = [], 0, 0
    for start, _, end in spans:
        if start > covered or not out:
            out += [text[at:start], mark]
        at = covered = max(covered, end)
    return "".join([*out, text[at:]])


def scan_secrets(
    docs: DataFrame, vocabulary_file: str, id_col: str = "doc_id", text_col: str = "text", ratio: float = RATIO, pairs: Pairs | None = None
) -> DataFrame:
    """Spans and a redacted text per row.

    Columns: doc_id, spans (array of kind, start, end), n_assign, n_access, n_hex,
    n_random, base (the joined spans without random ones), joined, redacted (null where
    nothing was found, so that clean texts are not copied).
    """
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = (
        f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>, n_assign long, n_access long, n_hex long, "
        "n_random long, base string, joined string, redacted string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_of(batch.column(1))
            for low, high in byte_chunks(offsets):
                texts = batch.column(1).slice(low, high - low).fill_null("").to_pylist()
                spans = [scan(t, vocabulary_file, ratio, pairs) for t in texts]
                counts = [pa.array([sum(s[1] == k for s in row) for row in spans], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array([[{"kind": k, "start": a, "end": b} for a, k, b in row] for row in spans], pa.list_(span)),
                        *counts,
                        pa.array([joined([s for s in row if s[1] != "random"]) for row in spans], pa.string()),
                        pa.array([joined(row) for row in spans], pa.string()),
                        pa.array([redact(t, row) if row else None for t, row in zip(texts, spans, strict=True)], pa.string()),
                    ],
                    ["doc_id", "spans", *[f"n_{k}" for k in KINDS], "base", "joined", "redacted"],
                )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)



def redact_secrets(docs: DataFrame, vocabulary_file: str, text_col: str = "text", ratio: float = RATIO, pairs: Pairs | None = None) -> DataFrame:
    """All rows and columns of ``docs``, with every secret in the text replaced by a mark; null texts stay null."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_of(batch.column(at))
            for low, high in byte_chunks(offsets):
                part = batch.slice(low, high - low)
                texts = part.column(at).to_pylist()
                texts = [t if t is None else redact(t, scan(t, vocabulary_file, ratio, pairs)) for t in texts]
                columns = [*part.columns[:at], pa.array(texts, part.schema.field(at).type), *part.columns[at + 1 :]]
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(run, docs.schema)
