"""Personal data: base patterns, and a semi-Markov conditional random field that adds what they miss.

A greedy pattern runs two numbers that follow one another together and then fails its
check, and it knows one spelling only. The field scores whole candidate segments instead:
how many digits in which groups, check digits, octets, the marks in between, what stands
before and after. A dynamic program chooses among all ways to cut the text into entities
of bounded length and single other tokens, boundaries and types at once. Base spans
stay; candidates that cross one are left out, and entities that are none are added.

An entity starts and ends at the edge of a run of ASCII letters and digits (one or two of
``+(`` may come first), has at most ``MOST_TOKENS`` tokens (runs or single characters) and
``MOST_DIGITS`` digits, and holds four digits or one at-sign. It lies within a run of the
characters such entities are made of, so the program runs over these stretches only; all other
tokens can only be outside, which gives the same best cut as running it over the whole text.

There are no labels for this in the tables. The field is fitted on windows around base spans of a
bounded sample of rows (``Plan``), on rewritten copies of them in other spellings, with
two of them next to one another, and, as counterexamples, with spoilt copies and plain numbers in their place.

Spans are in code points, end exclusive. Null and empty texts have no spans. Rows are scanned one
by one, so repeated rows, ties and extra columns need no rule. Without a base span in the sample,
as in an empty table, nothing is added. Kinds overlap where the base patterns of two kinds do.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoscan.llm.common import byte_chunks, text_of

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
MOST_TOKENS, MOST_DIGITS, FEWEST_DIGITS = 24, 24, 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts at a run's first digit or fails from each of its digits, so looking behind changes nothing.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")

_NUMERIC = re.compile(r"[+(\[]{0,2}[0-9][0-9+().\-/ \[\]]*")
_AT = re.compile(r"@|[\[(][aA][tT][\])]")
_ADDRESS = frozenset(_LOCAL | set("@[]()"))
_TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9]")
#: Marks of any entity, of numbers only, and of addresses only.
_MARKS, _NUMBER_MARKS, _ADDRESS_MARKS = frozenset("+().-[]"), frozenset("/ "), frozenset("@_%")
_HEAD = re.compile(r"[A-Za-z0-9]|[+(]{1,2}[0-9]")
_WORD_BEFORE = re.compile(r"([^\W\d_]+)\W*$")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    """The check digit of payment cards."""
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(2 * v - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def octet(digits: str) -> bool:
    least = digits.lstrip("0")
    return len(least) <= 3 and int(least or 0) <= 255


def only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at-sign takes what may stand before it, back to the last match, and the domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns by kind as listed, then start."""
    found: list[Span] = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := only_digits(m[0])) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(only_digits(m[0])) <= 15]
    return found


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that can hold entities, apart from one another."""
    found = [(m.start(), m.end()) for m in _NUMERIC.finditer(text) if m.end() - m.start() >= FEWEST_DIGITS]
    found = [(a, b) for a, b in found if sum(map(str.isdigit, text[a : min(b, a + 64)])) >= FEWEST_DIGITS or b - a > 64]
    end = 0
    for m in _AT.finditer(text):
        if m.end() > end:  # the maximal run of an address's characters around it
            start, end = m.start(), m.end()
            while start > 0 and text[start - 1] in _ADDRESS:
                start -= 1
            while end < len(text) and text[end] in _ADDRESS:
                end += 1
            found.append((start, end))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def ascii_word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and text[at].isascii() and text[at].isalnum()


@dataclass
class Lattice:
    """Tokens of a stretch and its candidates: (first token, end token, span, features)."""

    edges: list[int]
    candidates: list[tuple[int, int, int, int, list[str]]]

    @property
    def size(self) -> int:
        return len(self.edges) - 1


def lattice(text: str, low: int, high: int, fixed: list[Span] = ()) -> Lattice:
    """All candidates of a stretch that cross none of the ``fixed`` spans."""
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, low, high)]
    edges = [a for a, _ in tokens] + [high]
    barred = [(a, b) for _, a, b in fixed if a < high and b > low]
    out = []
    for i, (start, _) in enumerate(tokens):
        if not _HEAD.match(text, start) or ascii_word(text, start - 1):
            continue
        digits = ats = 0
        number = address = False  # what can only be part of one or the other
        for j in range(i, min(len(tokens), i + MOST_TOKENS)):
            a, b = tokens[j]
            mark = text[a]
            run = ascii_word(text, a)
            if run:
                plain = text[a:b].isdigit()
                digits += b - a if plain else sum(map(str.isdigit, text[a:b]))
                address |= not plain
            elif mark in _NUMBER_MARKS:
                number = True
            elif mark in _ADDRESS_MARKS:
                address, ats = True, ats + (mark == "@")
            elif mark not in _MARKS:
                break
            if digits > MOST_DIGITS or number and address or ats > 1:
                break
            if not run or ascii_word(text, b) or not address and digits < FEWEST_DIGITS:
                continue
            if address and len(_AT.findall(text, start, b)) != 1:
                continue
            if any(x < b and y > start and (x, y) != (start, b) for x, y in barred):
                continue
            out.append((i, j + 1, start, b, span_features(text[start:b], surroundings(text, start, b))))
    return Lattice(edges, out)


def surroundings(text: str, start: int, end: int) -> tuple[str, str, str]:
    """What stands before and after, and the word before."""

    def kind(at: int, beyond: int) -> str:
        if not 0 <= at < len(text):
            return "edge"
        c = text[at]
        if c.isspace():
            return "space"
        if c.isalpha():
            return "letter"
        return c + ("+" if ascii_word(text, beyond) else "")

    word = _WORD_BEFORE.search(text, max(0, start - 24), start)
    return kind(start - 1, start - 2), kind(end, end + 1), word[1].lower() if word else ""


@lru_cache(1 << 14)
def span_features(span: str, around: tuple[str, str, str]) -> list[str]:
    """Names of the features of a whole segment."""
    groups = _DIGITS.findall(span)
    marks = "".join(sorted(set(re.sub(r"[A-Za-z0-9]", "", span))))
    out = [f"before={around[0]}", f"after={around[1]}", f"word={around[2]}", f"first={'9' if span[0].isdigit() else 'a' if span[0].isalpha() else span[0]}"]
    at = _AT.search(span)
    if at:
        local, domain = span[: at.start()], span[at.end() :]
        labels = domain.split(".")
        out += [f"local={bool(local)}", f"dots={min(domain.count('.'), 3)}", f"labels={all(re.fullmatch(r'[A-Za-z0-9-]+', x) for x in labels)}"]
        out += [f"last={'letters' if labels[-1].isalpha() else 'other'}", f"whole={bool(re.fullmatch(r'[A-Za-z0-9._%+-]+', local))}"]
        return out
    digits = "".join(groups)
    shape = _DIGITS.sub("9", span)
    sizes = "-".join(str(len(g)) for g in groups)
    out += [f"digits={len(digits)}", f"groups={len(groups)}", f"marks={marks}", f"shape={shape}", f"sizes={sizes}", f"longest={max(map(len, groups))}"]
    if 13 <= len(digits) <= 19:
        out += [f"check={luhn(digits)}", f"check={luhn(digits)},sizes={sizes}"]
    if len(groups) == 4 and set(marks) <= set(".[]") and "." in marks:
        out.append(f"octets={all(map(octet, groups))}")
    if len(groups) != 4 and set(marks) == {"."}:
        out.append("dotted")
    return out


@dataclass
class Plan:
    """Sizes of the sample and of the training."""

    most_rows: int = 4000
    most_windows: int = 400
    reach: int = 32  # characters of a window on both sides of its span
    epochs: int = 5
    batch: int = 16
    rate: float = 0.4
    shrink: float = 1e-3
    seed: int = 5


@dataclass
class Field:
    """Weights of features by kind, and of a label after another."""

    names: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1, len(KINDS))))
    steps: np.ndarray = field(default_factory=lambda: np.zeros((len(KINDS) + 1, len(KINDS) + 1)))

    def indices(self, features: list[str]) -> np.ndarray:
        """Rows of the weights: 0 is the constant one; features that training has not seen count for nothing."""
        return np.array([0, *(self.names[f] for f in features if f in self.names)])

    def scores(self, graph: Lattice) -> np.ndarray:
        """(candidates, kinds)."""
        if not graph.candidates:
            return np.zeros((0, len(KINDS)))
        return np.stack([self.weights[self.indices(c[4])].sum(axis=0) for c in graph.candidates])


def _by_end(graph: Lattice) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(graph.size + 1)]
    for k, c in enumerate(graph.candidates):
        out[c[1]].append(k)
    return out


def _by_start(graph: Lattice) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(graph.size + 1)]
    for k, c in enumerate(graph.candidates):
        out[c[0]].append(k)
    return out


def best_cut(graph: Lattice, scores: np.ndarray, steps: np.ndarray) -> list[Span]:
    """Entities of the best cut. Before and after the stretch the text is outside."""
    n, lowest = graph.size, -np.inf
    best = np.full((n + 1, OUTSIDE + 1), lowest)
    best[0, OUTSIDE] = 0
    back: list[dict[int, tuple[int, int, int]]] = [{} for _ in range(n + 1)]  # label: (token, label before, candidate)
    ends = _by_end(graph)
    for e in range(1, n + 1):
        before = best[e - 1] + steps[:, OUTSIDE]
        y = int(before.argmax())
        best[e, OUTSIDE], back[e][OUTSIDE] = before[y], (e - 1, y, -1)
        for k in ends[e]:
            i = graph.candidates[k][0]
            into = best[i][:, None] + steps[:, :OUTSIDE]
            reach = into.max(axis=0) + scores[k]
            for label in np.flatnonzero(reach > best[e, :OUTSIDE]).tolist():
                best[e, label], back[e][label] = reach[label], (i, int(into[:, label].argmax()), k)
    at, label = n, int((best[n] + steps[:, OUTSIDE]).argmax())
    out = []
    while at > 0:
        i, before, k = back[at][label]
        if k >= 0:
            out.append((label, *graph.candidates[k][2:4]))
        at, label = i, before
    return out[::-1]


def _logsum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    return top + np.log(np.exp(x - top).sum(axis=0))


def marginals(graph: Lattice, scores: np.ndarray, steps: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log of the sum over all cuts, each candidate's probability by kind, expected number of each step."""
    n, low = graph.size, -1e30
    ends, starts = _by_end(graph), _by_start(graph)
    ahead = np.full((n + 1, OUTSIDE + 1), low)
    ahead[0, OUTSIDE] = 0
    into = np.full((n + 1, OUTSIDE + 1), low)  # everything up to a token, and the step into a label there
    for e in range(n + 1):
        if e:
            ahead[e, OUTSIDE] = into[e - 1, OUTSIDE]
            if ends[e]:
                ahead[e, :OUTSIDE] = _logsum(np.stack([into[graph.candidates[k][0], :OUTSIDE] + scores[k] for k in ends[e]]))
        into[e] = _logsum(ahead[e][:, None] + steps)
    total = float(into[n, OUTSIDE])
    # What follows a token once a label has begun there, and once one has ended there.
    begun, ended = np.full((n + 1, OUTSIDE + 1), low), np.full((n + 1, OUTSIDE + 1), low)
    for s in range(n, -1, -1):
        begun[s, OUTSIDE] = ended[s + 1, OUTSIDE] if s < n else 0
        if starts[s]:
            begun[s, :OUTSIDE] = _logsum(np.stack([ended[graph.candidates[k][1], :OUTSIDE] + scores[k] for k in starts[s]]))
        ended[s] = _logsum((steps + begun[s][None]).T)
    chance = np.zeros(scores.shape)
    for k, c in enumerate(graph.candidates):
        chance[k] = np.exp(into[c[0], :OUTSIDE] + scores[k] + ended[c[1], :OUTSIDE] - total)
    used = np.exp(ahead[:, :, None] + steps[None] + begun[:, None, :] - total).sum(axis=0)
    return total, chance, used


def gold_path(graph: Lattice, gold: list[Span]) -> tuple[list[tuple[int, int]], np.ndarray] | None:
    """(candidate, kind) of the wanted entities and the steps of their cut; None if some are no candidates."""
    where = {(c[2], c[3]): k for k, c in enumerate(graph.candidates)}
    chosen = []
    for kind, start, end in sorted(gold, key=lambda s: s[1]):
        if (start, end) not in where:
            return None
        chosen.append((where[(start, end)], kind))
    steps, at, label = np.zeros((OUTSIDE + 1, OUTSIDE + 1)), 0, OUTSIDE
    for k, kind in chosen:
        i, j = graph.candidates[k][:2]
        if i < at:
            return None
        for _ in range(i - at):
            steps[label, OUTSIDE] += 1
            label = OUTSIDE
        steps[label, kind] += 1
        at, label = j, kind
    for _ in range(graph.size - at):
        steps[label, OUTSIDE] += 1
        label = OUTSIDE
    steps[label, OUTSIDE] += 1
    return chosen, steps


Example = tuple[str, list[Span]]


def respelt(kind: int, span: str, rng: np.random.Generator) -> str:
    """The same entity in another spelling."""
    groups = _DIGITS.findall(span)
    if kind == 0:
        return span.replace("@", str(rng.choice(["[at]", "(at)"])))
    if kind == 1:
        return "[.]".join(groups)
    digits = "".join(groups)
    if kind == 2:
        return str(rng.choice([".", "/", "  "])).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    last = groups[1:] if len(groups) > 1 else [digits[-10:-7], digits[-7:-4], digits[-4:]]
    last = [g for g in last if g]
    spelt = [f"({last[0]}) " + "-".join(last[1:]), "-".join(last), ".".join(last), "00" + groups[0] + " " + " ".join(last), "+" + groups[0] + "/" + "/".join(last)]
    return str(rng.choice(spelt))


def spoilt(kind: int, span: str, rng: np.random.Generator) -> str:
    """Something like the entity that is none."""
    groups = _DIGITS.findall(span)
    digits = "".join(groups)
    if kind == 0:
        local, _, domain = span.partition("@")
        return str(rng.choice([f"@{local}", f"{local}@", domain, f"{local}@{domain.split('.')[0]}"]))
    if kind == 1:
        return str(rng.choice([".".join([groups[0], str(int(rng.integers(256, 999))), *groups[2:]]), ".".join(groups[:3]), ".".join([*groups, groups[0]])]))
    if kind == 2:
        at = int(rng.integers(0, len(digits)))
        wrong = digits[:at] + str((int(digits[at]) + 1 + int(rng.integers(0, 8))) % 10) + digits[at + 1 :]
        return str(rng.choice([wrong, " ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), "-".join(wrong[i : i + 4] for i in range(0, len(wrong), 4))]))
    return str(rng.choice([f"+{digits[:4]}", f"+{digits}{digits}", digits[:6], f"{groups[0]}-{digits[:5]}", f"{digits[:4]}-{digits[4:8]}"]))


def plain_number(rng: np.random.Generator) -> str:
    """Dates, times, amounts, versions and counts."""
    n = lambda low, high: int(rng.integers(low, high))
    forms = [
        f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 13):02}/{n(1, 29):02}/{n(1900, 2100)}", f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2100)}",
        f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02} {n(0, 24):02}:{n(0, 60):02}", f"{n(1000, 10**9)}", f"{n(0, 99)}.{n(1000, 10**7)}",
        f"{n(1, 20)}.{n(0, 20)}.{n(0, 99)}", f"{n(1900, 2100)}/{n(10, 99)}", f"{n(1000, 99999)} {n(1000, 99999)}", f"{n(10**11, 10**16)}",
        f"{n(1, 9)} {n(100, 999)} {n(100, 999)}", f"{n(1900, 2100)}-{n(1900, 2100)}", f"{n(10**6, 10**8)}-{n(10, 99)}", f"({n(1900, 2100)})",
    ]
    return forms[int(rng.integers(0, len(forms)))]


def put(example: Example, new: str, kind: int | None) -> Example:
    """The example with its only span replaced."""
    text, [(_, a, b)] = example
    spans = [] if kind is None else [(kind, a, a + len(new))]
    return text[:a] + new + text[b:], spans


def examples_of(windows: list[Example], plan: Plan) -> list[Example]:
    """Windows, their respelt and spoilt copies, plain numbers in their place, and pairs next to one another."""
    rng = np.random.default_rng(plan.seed)
    out = []
    for k, window in enumerate(windows):
        text, [(kind, a, b)] = window
        out += [window, put(window, respelt(kind, text[a:b], rng), kind)]
        out += [put(window, spoilt(kind, text[a:b], rng), None), put(window, plain_number(rng), None)]
        other, [(beside, c, d)] = windows[int(rng.integers(0, len(windows)))]
        between = str(rng.choice([" ", ", ", " / ", "; "]))
        joined = text[:b] + between + other[c:]
        shift = b + len(between) - c
        out.append((joined, [(kind, a, b), (beside, c + shift, d + shift)]))
        if k % 4 == 0:
            number = plain_number(rng)
            out.append((text[:a] + number + " " + text[a:], [(kind, a + len(number) + 1, b + len(number) + 1)]))
    return out


def fit(windows: list[Example], plan: Plan | None = None) -> Field:
    """Maximum likelihood over the examples by adaptive gradients; a window has one span."""
    plan, model = plan or Plan(), Field()
    if not windows:
        return model
    graphs = []
    for text, gold in examples_of(windows, plan):
        covered = 0
        for low, high in regions(text):
            graph = lattice(text, low, high)
            mine = [s for s in gold if low <= s[1] and s[2] <= high]
            covered += len(mine)
            path = gold_path(graph, mine)
            if path is not None and graph.candidates:
                graphs.append((graph, path))
    seen = Counter(f for graph, _ in graphs for c in graph.candidates for f in c[4])
    model.names = {f: k + 1 for k, f in enumerate(sorted(f for f, n in seen.items() if n > 2))}
    model.weights = np.zeros((len(model.names) + 1, len(KINDS)))
    ready = []
    for graph, (chosen, steps) in graphs:
        found = [model.indices(c[4]) for c in graph.candidates]
        wanted = np.zeros((len(found), len(KINDS)))
        for k, kind in chosen:
            wanted[k, kind] = 1
        ready.append((graph, found, wanted, steps))
    rng = np.random.default_rng(plan.seed)
    past, past_steps = np.full(model.weights.shape, 1e-2), np.full(model.steps.shape, 1e-2)
    for _ in range(plan.epochs):
        order = rng.permutation(len(ready))
        for low in range(0, len(order), plan.batch):
            slope, slope_steps = plan.shrink * model.weights, plan.shrink * model.steps
            for r in order[low : low + plan.batch].tolist():
                graph, found, wanted, steps = ready[r]
                scores = np.stack([model.weights[f].sum(axis=0) for f in found])
                _, chance, used = marginals(graph, scores, model.steps)
                gap = chance - wanted
                np.add.at(slope, np.concatenate(found), np.repeat(gap, [len(f) for f in found], axis=0))
                slope_steps += used - steps
            past += slope**2
            past_steps += slope_steps**2
            model.weights -= plan.rate * slope / np.sqrt(past)
            model.steps -= plan.rate * slope_steps / np.sqrt(past_steps)
    return model


def windows_of(text: str, reach: int) -> list[Example]:
    """Base spans with their surroundings where no other digit or at-sign stands near."""
    spans = base_spans(text)
    out = []
    for kind, a, b in spans:
        low, high = max(0, a - reach), min(len(text), b + reach)
        while low > 0 and ascii_word(text, low) and ascii_word(text, low - 1) and low < a:
            low += 1
        while high < len(text) and ascii_word(text, high) and ascii_word(text, high - 1) and high > b:
            high -= 1
        alone = not any(c.isdigit() or c == "@" for c in text[low:a] + text[b:high])
        if alone and sum(x < b and y > a for _, x, y in spans) == 1:
            out.append((text[low:high], [(kind, a - low, b - low)]))
    return out


def train(docs: DataFrame, plan: Plan | None = None, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fit on windows of about ``most_rows`` rows, chosen by a hash, at most ``most_windows`` of them."""
    plan = plan or Plan()
    share = min(1.0, plan.most_rows / max(docs.count(), 1))
    mark = F.xxhash64(F.col(id_col), F.lit(plan.seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_of(batch.column(0))
            for low, high in byte_chunks(offsets):
                texts = batch.column(0).slice(low, high - low).fill_null("").to_pylist()
                found = [(t, *s[0]) for text in texts for t, s in windows_of(text, plan.reach)]
                columns = list(zip(*found, strict=True)) or [[], [], [], []]
                kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["window", "kind", "start", "end"])

    rows = docs.filter(F.pmod(mark, F.lit(1 << 62)) < F.lit(int(share * (1 << 62)))).select(F.col(text_col))
    found = rows.mapInArrow(run, "window string, kind int, start int, end int").distinct()
    # A third of the windows may be of one kind: each kind has its own share.
    picked = [found.filter(F.col("kind") == k).orderBy(F.xxhash64("window"), "window", "start").limit(plan.most_windows // len(KINDS)) for k in range(len(KINDS))]
    windows = [(r["window"], [(r["kind"], r["start"], r["end"])]) for part in picked for r in part.collect()]
    return fit(windows, plan)


def scan(text: str, model: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans), each by kind as listed, then start."""
    base = base_spans(text)
    if not model.names:
        return base, []
    settled, added = {(a, b) for _, a, b in base}, []
    for low, high in regions(text):
        near = [s for s in base if s[1] < high and s[2] > low]
        graph = lattice(text, low, high, near)
        if graph.candidates:
            found = best_cut(graph, model.scores(graph), model.steps)
            added += [s for s in found if (s[1], s[2]) not in settled]
    return base, sorted(added)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def mask(text: str, spans: list[Span]) -> str:
    """Replace every span by its kind in brackets; spans that overlap become one, named after the first."""
    out, at, covered = [], 0, -1
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= covered:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = covered = max(covered, end)
    return "".join([*out, text[at:]])


def find_private(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans and a masked text per row.

    Columns: doc_id, spans (array of kind, start, end, base), n_email, n_ip, n_card and
    n_phone (of base spans), n_added, base and joined (base and all spans as text), masked
    (null where nothing was found, so that clean texts are not copied).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # weights of the features seen in training
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
    counts = [f"n_{k}" for k in KINDS]
    schema = (
        f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long,base:boolean>>, {', '.join(f'{c} long' for c in counts)}, "
        "n_added long, base string, joined string, masked string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_of(batch.column(1))
            for low, high in byte_chunks(offsets):
                texts = batch.column(1).slice(low, high - low).fill_null("").to_pylist()
                found = [scan(t, shared.value) for t in texts]
                every = [sorted([(*s, True) for s in base] + [(*s, False) for s in added]) for base, added in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array([[{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in row] for row in every], pa.list_(span)),
                        *[pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))],
                        pa.array([len(added) for _, added in found], pa.int64()),
                        pa.array([joined(base) for base, _ in found], pa.string()),
                        pa.array([joined([s[:3] for s in row]) for row in every], pa.string()),
                        pa.array([mask(t, [s[:3] for s in row]) if row else None for t, row in zip(texts, every, strict=True)], pa.string()),
                    ],
                    ["doc_id", "spans", *counts, "n_added", "base", "joined", "masked"],
                )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
