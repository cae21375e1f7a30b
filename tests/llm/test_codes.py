"""Vector codes against a brute-force version in whole numbers."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from odoscan.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, `_key` string, id long, position int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(id, code, error) by the definition, one part and one entry at a time."""
    whole = [(i, [int(np.floor(float(x) * scale)) for x in v], y) for i, v, y in rows]
    width = len(whole[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in whole]
    first = sorted(range(len(whole)), key=lambda r: (whole[r][0] is None, whole[r][0] or 0, whole[r][1]))[:entries]
    books = [[cut[r][p] for r in first] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for row in cut:
                members[nearest(row[p], books[p])[1]].append(row[p])
            for k, mine in members.items():
                books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = []
    for (i, _, y), row in zip(whole, cut, strict=True):
        found = [nearest(row[p], books[p]) for p in range(parts)]
        out.append((i, y, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    totals = defaultdict(int)
    for _, y, _, e in out:
        totals[y] += e
    text = ",".join(str(x) for book in books for e in book for x in e)
    return [(*r, totals[r[1]]) for r in out], hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "k", 1, 2) for i, v, y in rows], SCHEMA).repartition(3)


def check(spark, rows, odd=(), **settings):
    got, books = codes.compress(frame(spark, [*rows, *odd]), **settings)
    want, digest = brute(rows, entries=settings.get("entries", 256), rounds=settings.get("rounds", 4))
    key = lambda r: (str(r[0]), str(r[1]), *r[2:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key) and books.digest() == digest


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = np.round(rng.normal(0, 0.2, (60, 8)) * 4) / 4  # few distinct values: ties between entries
    rows = [(int(i), base[rng.integers(0, 60)].tolist(), None if i % 3 == 0 else int(i % 4)) for i in rng.permutation(300)]
    rows += [(5000 + i, [0.25] * 8, 1) for i in range(150)]  # a third of all rows are one vector
    rows += [(7, [9.0, -9.0] * 4, 2), (None, base[0].tolist(), 3), (None, base[1].tolist(), None)]  # repeated and null ids
    odd = [(1, None, 1), (2, [float("nan")] * 8, 1), (3, [None] * 8, 1), (4, [float("inf")] * 8, 1), (-5, [1.0] * 4, 1), (-6, [], 1)]
    check(spark, rows, odd, entries=16, rounds=3)
    check(spark, rows, odd)


def test_few_vectors_and_no_vectors(spark):
    check(spark, [(3, [0.5, -0.5, 1.0, 2.0], 0), (1, [0.1, 0.2, 0.3, 0.4], None)])
    got, books = codes.compress(frame(spark, [(1, None, 0)]))
    assert got.count() == 0 and [b.size for b in books.books] == [0] * 4
    got, _ = codes.compress(frame(spark, [(1, [], 0), (2, [], 0)]))
    assert [r["code"] for r in got.collect()] == ["00000000"] * 2
    padded, _ = codes.compress(frame(spark, [(i, [float(i)] * 6, 0) for i in range(9)]))  # filled up to 8
    assert {r["error"] for r in padded.collect()} == {0}


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 2**16 for _ in range(8)], 0) for i in range(40)]
    check(spark, rows, entries=8)  # squares beyond 2^53, sums within a long
    got, _ = codes.compress(frame(spark, [(0, [1e308] * 4, 0), (1, [-1e308] * 4, 0)]), entries=1)
    assert [r["error"] for r in got.collect()] == [2**63 - 1] * 2 and {r["label_error"] for r in got.collect()} == {2**63 - 1}


@pytest.mark.parametrize("leaves", [1, 3, 512])
@pytest.mark.parametrize("spread", [2, 30, 10**6, 10**9])
def test_trie_finds_the_nearest_entry(leaves, spread):
    rng = np.random.default_rng(spread)
    parts, _ = codes.distinct_rows(rng.integers(-spread, spread, (400, 5)))
    entries = rng.integers(-spread, spread, (23, 5))
    nearest, distance = codes.trie_nearest(parts, entries, leaves)
    every = ((parts[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
    assert nearest.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()


def test_distinct_rows():
    rows = np.array([[2, 1], [1, 5], [2, 1], [1, 4], [1, 5]])
    found, where = codes.distinct_rows(rows)
    assert found.tolist() == [[1, 4], [1, 5], [2, 1]] and found[where].tolist() == rows.tolist()


def test_a_group_of_most_rows_and_many_small_ones(spark):
    rows = [(i, [float(i % 7)] * 4, 0 if i % 2 else i) for i in range(5000)]
    got, _ = codes.compress(frame(spark, rows), entries=2)
    rows = got.collect()
    totals = defaultdict(int)
    for r in rows:
        totals[r["label"]] += r["error"]
    assert len(rows) == 5000 and all(r["label_error"] == totals[r["label"]] for r in rows)
