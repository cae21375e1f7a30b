"""Importance resampling against a brute-force version, and its parts one by one."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from odoscan.llm import importance
from odoscan.llm.common import text_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, n, buckets=10_000, least=20, percent=10):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, n)[1])
    s, t = count(x for _, x in docs), count(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        words, found = features(text, n)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, len(words)])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = percent * len(able) // 100
    ranks = {id(r): k + 1 for k, r in enumerate(able[:drawn])}
    return [(*r[:4], ranks.get(id(r))) for r in rows]


def texts(n, seed):
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdeghéßЖ0") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["x" * 300, "日本語"]
    marks = [" ", ", ", "\n", "  ", "-", "\x00", "\x7f", "_"]
    make = lambda k: "".join(rng.choice(stock).title() + rng.choice(marks) for _ in range(k))
    return [make(rng.choice([0, 1, 5, 19, 20, 21, 60])) for _ in range(n)] + [make(9000)]


@pytest.mark.parametrize(("n", "most_words"), [(1, 60_000), (1, 10), (2, 0), (3, 30)])
def test_resampling_equals_brute_force(spark, n, most_words):
    docs = list(enumerate(texts(150, n))) + [(1000, None), (1001, ""), (1002, " .,"), (None, "one two " * 15)]
    docs += [docs[7], docs[7], (2000, docs[150][1])]  # repeated rows, equal texts
    docs += [(3000 + i, "same words again and again " * 6) for i in range(90)]  # a third are copies
    target = texts(20, 50) + [None, ""]
    frame = spark.createDataFrame([(i, t, "x", 1, 2.0) for i, t in docs], "doc_id long, text string, _range string, n_words int, score double")
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = importance.resample(frame.repartition(5), goal, n=n, most_words=most_words)
    rows = [tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(rows, key=key) == sorted(brute(docs, target, n), key=key)


def test_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert importance.resample(frame.limit(0), frame).count() == 0
    got = importance.resample(frame, frame.limit(0)).collect()
    assert [(r["doc_id"], r["n_features"], r["rank"]) for r in got] == [(1, 2, None)]


def test_joined_crc():
    rng = random.Random(3)
    pairs = [(rng.randbytes(rng.randint(0, 9)), rng.randbytes(rng.choice([0, 1, 2, 3, 7, 64, 1000, 70_000]))) for _ in range(200)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    a, b = zip(*pairs, strict=True)
    got = importance.joined_crc(crc(a), crc(b), np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in pairs]


def test_automaton_emits_every_word_in_order():
    rows = [*texts(40, 9), "", "tail", None]
    raw, offsets = text_of(pa.array(rows, pa.string()))
    text, starts, ends, first = importance.spaced(raw, offsets)
    every = [features(t, 1)[0] for t in rows]
    flat = [w.encode() for row in every for w in row]
    assert np.diff(first).tolist() == [len(w) for w in every]
    for words in ([], flat[:1], sorted(set(flat)), [b"ab", b"a", b"b", b"abc"]):
        got = importance.Dictionary(words).payloads(text, starts, ends)
        assert got.tolist() == [importance.payload(w) for w in flat]


def test_dictionary_holds_the_commonest_words(spark):
    frame = spark.createDataFrame([("B a a",), ("b A c",), (None,)], "text string")
    assert importance.common_words(frame, 2) == [b"a", b"b"]
    assert {bytes(r["word"]): r["n"] for r in importance.word_counts(frame).collect()} == {b"a": 3, b"b": 2, b"c": 1}


def test_draw_follows_the_weights(spark):
    """Documents that speak like the target are drawn far more often than their share."""
    rng = random.Random(1)
    like, other = [f"t{i}" for i in range(40)], [f"s{i}" for i in range(400)]
    docs = [(i, " ".join(rng.choices(like if i % 10 == 0 else other, k=30))) for i in range(2000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    goal = spark.createDataFrame([(" ".join(rng.choices(like, k=50)),) for _ in range(50)], "text string")
    drawn = importance.resample(frame, goal).filter(F.col("rank").isNotNull()).collect()
    assert len(drawn) == 200 and sorted(r["rank"] for r in drawn) == list(range(1, 201))
    assert sum(r["doc_id"] % 10 == 0 for r in drawn) > 150
