"""Comparison of repeated byte strings in small pieces of whole keys."""

from collections import Counter

import numpy as np
import pytest

from odoscan.llm import suffix


@pytest.mark.parametrize("compared", [1, 700])
def test_pieces_keep_keys_whole(spark, monkeypatch, compared):
    monkeypatch.setattr(suffix, "COMPARED", compared)
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    lines = [" ".join(rng.choice(words, 90)) for _ in range(12)]
    texts = [" ".join([lines[i % 12], lines[(i * 5) % 12][: 250 + i], str(i)]) for i in range(30)] + ["", None, "x" * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + 200] for b in data for k in range(len(b) - 199))
    got = {r["doc_id"]: r for r in suffix.remove_repeated_bytes(docs, size=1 << 14).collect()}
    for i, b in enumerate(data):
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        assert got[i]["n_removed"] == gone.sum() and bytes(got[i]["kept"]) == np.frombuffer(b, np.uint8)[~gone].tobytes()
