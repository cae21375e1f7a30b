"""Base patterns by the patterns as given, the dynamic program by all cuts, the field on held-out texts."""

import random
import re
from itertools import product

import numpy as np
import pytest

from odoscan.llm import private

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v // 10 + v % 10
    return total % 10 == 0


def plain_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and plain_luhn(digits(m))]
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def card(rng, size=16):
    body = "".join(rng.choice("0123456789") for _ in range(size - 1))
    return next(body + c for c in "0123456789" if plain_luhn(body + c))


def entity(kind, rng):
    n = lambda a, b: rng.randint(a, b)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(n(3, 8)))
    if kind == 0:
        return f"{name()}.{n(1, 99)}@{name()}{n(1, 9)}.example.com"
    if kind == 1:
        return ".".join(str(n(1, 255)) for _ in range(4))
    if kind == 2:
        return card(rng)
    return f"+{n(1, 9)} ({n(200, 999)}) {n(200, 999)}-{n(1000, 9999)}"


def prose(rng, k=12):
    return " ".join("".join(rng.choice("abcdefghéü") for _ in range(rng.randint(1, 9))) for _ in range(k))


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    pieces = ["1", "25", "256", "007", ".", ".", "-", " ", "@", "+", "(", ")", "a", "é", "x.y", "٣", "%_", "@a.b", "1.2.3.4", "+12345678", "0000000000", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) + rng.choice(["", card(rng), entity(rng.randrange(4), rng)])
        assert private.base_spans(text) == plain_base(text), text
    assert private.base_spans("9" * 5000 + ".1.1.1") == [] and private.base_spans("0" * 4400 + "1.1.1.1")[0][0] == 1


def test_long_runs_take_linear_time():
    for text in ("x" * 200_000 + "@", "1" * 200_000, "a@" * 50_000, "+1 " * 50_000, "1." * 100_000, "x." * 50_000 + "[at]", "( " * 50_000 + "1"):
        private.base_spans(text)
        private.regions(text)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(5)
    windows = []
    for k in range(240):
        before, span = prose(rng, 4) + " ", entity(k % 4, rng)
        windows.append((before + span + " " + prose(rng, 3), [(k % 4, len(before), len(before) + len(span))]))
    return private.fit(windows)


def all_cuts(graph):
    """Every cut as a list of (candidate, kind)."""

    def grow(at):
        if at == graph.size:
            yield []
            return
        for rest in grow(at + 1):
            yield rest
        for k, c in enumerate(graph.candidates):
            if c[0] == at:
                for rest, kind in product(list(grow(c[1])), range(4)):
                    yield [(k, kind), *rest]

    return grow(0)


def total_of(graph, cut, scores, steps):
    at, label, total = 0, private.OUTSIDE, 0.0
    for k, kind in [*cut, (None, None)]:
        until = graph.size if k is None else graph.candidates[k][0]
        for _ in range(until - at):
            total, label = total + steps[label, private.OUTSIDE], private.OUTSIDE
        if k is not None:
            total, label, at = total + steps[label, kind] + scores[k, kind], kind, graph.candidates[k][1]
    return total + steps[label, private.OUTSIDE]


def test_dynamic_programs_equal_all_cuts():
    rng = np.random.default_rng(2)
    for text in ("1234 5678", "12.34.56", "1 234 56", "+1234-5 678", "a.12@b.c"):
        graph = private.lattice(text, 0, len(text))
        scores = rng.normal(0, 2, (len(graph.candidates), 4))
        steps = rng.normal(0, 1, (5, 5))
        cuts = list(all_cuts(graph))
        totals = np.array([total_of(graph, c, scores, steps) for c in cuts])
        best = cuts[int(totals.argmax())]
        assert private.best_cut(graph, scores, steps) == [(y, *graph.candidates[k][2:4]) for k, y in best]
        log_sum, chance, used = private.marginals(graph, scores, steps)
        odds = np.exp(totals - totals.max())
        assert log_sum == pytest.approx(np.log(odds.sum()) + totals.max())
        odds /= odds.sum()
        want = np.zeros_like(scores)
        for c, p in zip(cuts, odds, strict=True):
            for k, y in c:
                want[k, y] += p
        assert np.allclose(chance, want)
        gold = [(y, *graph.candidates[k][2:4]) for k, y in best]
        chosen, path = private.gold_path(graph, gold)
        assert chosen == best and (path * steps).sum() + sum(scores[k, y] for k, y in chosen) == pytest.approx(totals.max())
        for at in ((0, 1), (4, 4), (2, 4)):  # the expected steps are the slope of the log sum
            moved = steps.copy()
            moved[at] += 1e-6
            assert (private.marginals(graph, scores, moved)[0] - log_sum) / 1e-6 == pytest.approx(used[at], abs=1e-4)


def test_stretches_give_the_cut_of_the_whole_text(model):
    rng = random.Random(8)
    for _ in range(60):
        text = " ".join(rng.choice([prose(rng, 3), entity(rng.randrange(4), rng), "((12 (5", "7%1234", "a/b@c.de", "x_[at]y.z", "1/2/3 44", "é12345"]) for _ in range(5))
        whole = private.lattice(text, 0, len(text))
        want = private.best_cut(whole, model.scores(whole), model.steps)
        got, reach = [], private.regions(text)
        for low, high in reach:
            graph = private.lattice(text, low, high)
            got += private.best_cut(graph, model.scores(graph), model.steps)
        assert got == want
        assert all(any(low <= c[2] and c[3] <= high for low, high in reach) for c in whole.candidates)


def test_neighbours_are_told_apart(model):
    """The greedy patterns run over both and fail; the field finds each."""
    rng, found, wanted = random.Random(11), 0, 0
    for _ in range(150):
        first, second = (entity(k, rng) for k in rng.choice([(3, 2), (2, 1), (2, 2), (3, 3)]))
        text = f"{prose(rng, 4)} {first} {second} {prose(rng, 3)}"
        base, added = private.scan(text, model)
        spans = {text[a:b] for _, a, b in [*base, *added]}
        base_text = {text[a:b] for _, a, b in base}
        for x in (first, second):
            if not any(x in t for t in base_text):
                wanted += 1
                found += x in spans
    assert wanted > 100 and found / wanted >= 0.95


def test_other_spellings_are_found_and_plain_numbers_are_not(model):
    rng, draw = random.Random(12), np.random.default_rng(12)
    hit = wrong = 0
    for k in range(400):
        kind = k % 4
        span = private.respelt(kind, entity(kind, rng), draw)
        before = prose(rng, 3) + " "
        text = before + span + " " + prose(rng, 3)
        base, added = private.scan(text, model)
        hit += any((a, b) == (len(before), len(before) + len(span)) for _, a, b in [*base, *added])
        clean = before + private.plain_number(draw) + " " + prose(rng, 3)
        wrong += bool(private.scan(clean, model)[1])
    assert hit >= 0.9 * 400 and wrong <= 8


def test_prose_and_known_harmless_strings_get_no_span(model):
    for text in ("", "no digits here", "version 1.2.3", "md5 0123456789abcdef0123456789abcdef", "123e4567-e89b-12d3-a456-426614174000", "@user", "1234567890123456"):
        assert private.scan(text, model) == ([], [])


def test_rows_of_a_table(spark, model):
    rows = [(1, None), (2, ""), (3, "mail a.b@c.de now"), (3, "mail a.b@c.de now"), (None, "é +1 (743) 555-3824 4111111111111111 end"), (5, "x" * 100_000)]
    frame = spark.createDataFrame([(*r, "s", 7) for r in rows], "doc_id long, text string, spans string, n_ip int").repartition(3)
    got = private.find_private(frame, model).collect()
    assert len(got) == 6
    by = {r["doc_id"]: r for r in got}
    assert by[3]["joined"] == by[3]["base"] == "email:5:13" and by[3]["n_email"] == 1 and by[3]["masked"] == "mail [EMAIL] now"
    assert by[1]["joined"] == "" and by[1]["masked"] is None and by[5]["n_added"] == 0
    glued = by[None]
    assert (glued["base"], glued["joined"], glued["n_added"]) == ("", "card:20:36,phone:2:19", 2) and glued["masked"] == "é [PHONE] [CARD] end"
    assert private.find_private(frame.limit(0), model).count() == 0


def test_training_on_a_table(spark):
    rng = random.Random(3)
    rows = [(i, f"{prose(rng)} {entity(i % 4, rng)} {prose(rng)}" if i % 3 else prose(rng)) for i in range(600)]
    rows += [(1000 + i, rows[1][1]) for i in range(300)] + [(None, None), (7, "")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, window int")
    plan = private.Plan(most_windows=120, epochs=3)
    one, two = private.train(frame.repartition(2), plan), private.train(frame.repartition(5), plan)
    assert one.names == two.names and np.array_equal(one.weights, two.weights)  # whatever the partitions
    assert private.scan("see +1 (743) 555-3824 4111111111111111 there", one)[1] == [(2, 22, 38), (3, 4, 21)]
    nothing = private.train(frame.limit(0))
    assert not nothing.names and private.scan("a +1 (743) 555-3824 4111111111111111", nothing) == ([], [])
