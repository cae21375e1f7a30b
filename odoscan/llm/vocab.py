"""Token ids of whole texts by a vocabulary file, remembered word by word."""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from odoscan.llm.common import hash_words

#: Words remembered per worker, at some 35 bytes each, before the memory is cleared.
REMEMBERED = 1_000_000
#: Words encoded as one text, and such texts encoded in one call.
TOGETHER = 64
CALL = 64

_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of a lower-casing, word-wise BPE vocabulary that drops white space.

    Such a vocabulary never merges across a blank or a line feed, so a text's ids are
    the ids of its blank-separated words in a row. Nor does it merge a letter or digit
    with a comma or full stop, so "word," is "word" and ",", unless the normalised letter
    ends in a combining mark, which joins the comma. Every distinct word is encoded once by ``tokenizers``; strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.kind = "<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4"
        self.marks = dict(zip(",.", self._encoded([",", "."]), strict=True))
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.kind)

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of each word; words are encoded side by side and told apart by their offsets."""
        out = []
        sets = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        encodings = (
            found for i in range(0, len(sets), CALL) for found in self.model.encode_batch([" ".join(s) for s in sets[i : i + CALL]], add_special_tokens=False)
        )
        for some, found in zip(sets, encodings, strict=True):
            ends = np.cumsum([len(w) + 1 for w in some])
            ids = np.asarray(found.ids, self.kind)
            first = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids))
            cuts = [0, *np.searchsorted(first, ends).tolist()]
            out += [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    @staticmethod
    def _core(word: str) -> tuple[str, str]:
        mark = ""
        if word[-1] in ",." and unicodedata.normalize("NFC", word[-2:-1].lower())[-1:].isalnum():
            word, mark = word[:-1], word[-1]
        return (word.lower() if word.isascii() else word), mark

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Add distinct words under their hashes."""
        split = [self._core(w) for w in words]
        new = list(dict.fromkeys(c for c, _ in split))
        cores = dict(zip(new, self._encoded(new), strict=True))
        ids = [cores[c] + self.marks[m] if m else cores[c] for c, m in split]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.flat.itemsize
        at = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), self.kind)])
        where = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.size = (np.insert(a, where, b) for a, b in ((self.keys, keys), (self.at, at), (self.size, size)))

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (one entry more than texts).

        Words are looked up by a 64-bit hash of their bytes and length.
        """
        if len(self.keys) > REMEMBERED:
            self._forget()
        (hashes,), first, starts, ends = hash_words(raw, offsets)
        keys, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        spot = np.searchsorted(self.keys, keys)
        found = np.zeros(len(keys), dtype=bool)
        inside = spot < len(self.keys)
        found[inside] = self.keys[spot[inside]] == keys[inside]
        if not found.all():
            data = raw.tobytes()
            one = example[~found]
            self._learn(keys[~found], [data[a:b].decode() for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)])
            spot = np.searchsorted(self.keys, keys)
        size, at = self.size[spot][which], self.at[spot][which]
        before = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.arange(before[-1]) + np.repeat(at - before[:-1], size)]
        return ids, before[first]


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
