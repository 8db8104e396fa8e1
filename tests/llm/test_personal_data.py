"""Personal data: base patterns and the field against brute force, held-out accuracy, odd input."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest

from gaugeflow.llm import personal_data as P

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, kind long, base boolean"

# The dealt patterns as they are written in the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checked(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    found = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and checked(digits):
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(re.findall("[0-9]", m[0])) <= 15]
    return sorted(found)


def card(rng, digits=16):
    head = "".join(rng.choice("0123456789") for _ in range(digits - 1))
    return head + next(d for d in "0123456789" if checked(head + d))


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(30_000):
        letters = rng.choice(["a@.b1", "01.2", "0123456789 -", "+()1234 -.", "a@.b-_1 +25", "4 -0é漢.5"])
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        assert P.base_spans(text) == base(text), text
    for _ in range(300):
        text = f"{rng.choice(['x', '', 'é '])}{card(rng, rng.randrange(15, 21))}{rng.choice([' ', '', '-4', ' .'])}+1 (743) 555-38{rng.randrange(99)} 1.2.3.{rng.randrange(400)}"
        assert P.base_spans(text) == base(text), text


def small_islands(seed, number):
    """Islands of a few tokens with candidates of every kind and with random features."""
    rng = random.Random(seed)
    for _ in range(number):
        size = rng.randrange(1, 6)
        spans = [(i, j, k) for i in range(size) for j in range(i + 1, min(size, i + 3) + 1) for k in range(4)]
        chosen = rng.sample(spans, min(len(spans), rng.randrange(1, 7)))
        yield size, [(i, j, k, tuple(rng.sample(range(len(P.FEATURES)), 3)), i, j) for i, j, k in sorted(chosen)]


def segmentations(size, candidates, place=0):
    """All ways to cut the rest into candidates and single tokens outside."""
    if place == size:
        yield []
        return
    for rest in segmentations(size, candidates, place + 1):
        yield [None, *rest]
    for n, c in enumerate(candidates):
        if c[0] == place:
            for rest in segmentations(size, candidates, c[1]):
                yield [n, *rest]


def total_score(way, candidates, weights, moves):
    score, label = 0.0, P.OUTSIDE
    for n in way:
        new = P.OUTSIDE if n is None else candidates[n][2]
        score += moves[label, new] + (0 if n is None else weights[list(candidates[n][3])].sum())
        label = new
    return score


def test_decoding_and_likelihood_equal_enumeration():
    rng = np.random.default_rng(2)
    for size, candidates in small_islands(3, 150):
        weights, moves = rng.normal(size=len(P.FEATURES)), rng.normal(size=(5, 5))
        ways = list(segmentations(size, candidates))
        scores = np.array([total_score(w, candidates, weights, moves) for w in ways])
        best = ways[int(scores.argmax())]
        chosen = P.Field(weights, moves).decode(size, candidates)
        assert chosen == [(candidates[n][2], candidates[n][4], candidates[n][5]) for n in best if n is not None]
        n = int(rng.integers(len(ways)))
        right = [x for x in ways[n] if x is not None]
        value, _, _ = P.log_likelihood(weights, moves, [(size, candidates, right)])
        assert abs(value - (scores[n] - np.logaddexp.reduce(scores))) < 1e-9


def test_gradient_equals_differences():
    rng = np.random.default_rng(4)
    made = []
    for size, candidates in small_islands(5, 12):
        ways = list(segmentations(size, candidates))
        made.append((size, candidates, [x for x in ways[int(rng.integers(len(ways)))] if x is not None]))
    weights, moves, h = rng.normal(size=len(P.FEATURES)), rng.normal(size=(5, 5)), 1e-6
    _, slope, turn = P.log_likelihood(weights, moves, made)
    for f in range(0, len(weights), 5):
        step = np.zeros_like(weights)
        step[f] = h
        above, below = (P.log_likelihood(weights + s * step, moves, made)[0] for s in (1, -1))
        assert abs((above - below) / (2 * h) - slope[f]) < 1e-6
    for a in range(5):
        for b in range(5):
            step = np.zeros((5, 5))
            step[a, b] = h
            above, below = (P.log_likelihood(weights, moves + s * step, made)[0] for s in (1, -1))
            assert abs((above - below) / (2 * h) - turn[a, b]) < 1e-6


WORDS = "the quick notes of thereon about many lines dot at and sein mit la casa número".split()


def planted(rng, number):
    """Texts with one or two entities in forms the base patterns miss, and texts with other numbers only."""

    def digits(n):
        return "".join(rng.choice("23456789") for _ in range(n))

    def prose():
        return " ".join(rng.choice([w for w in WORDS if w not in ("dot", "at")]) for _ in range(rng.randrange(1, 9)))

    def entity():
        kind = rng.randrange(4)
        if kind == 0:
            at, dot = rng.choice([(" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "."), (" (at) ", " (dot) ")])
            return 0, f"{rng.choice(['ana', 'k.lopez', 'mail7'])}{at}{rng.choice(['firm', 'post-office', 'uni'])}{dot}{rng.choice(['com', 'org', 'de'])}"
        if kind == 1:
            parts = [str(rng.randrange(256)) for _ in range(4)]
            return 1, rng.choice(["[.]", "(.)"]).join(parts)
        if kind == 2:
            number = card(rng)
            return 2, rng.choice([".", "/", "  "]).join(number[i : i + 4] for i in range(0, 16, 4))
        a, b, c = digits(3), digits(3), digits(4)
        return 3, rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"{a}.{b}.{c}"])

    def other():
        wrong = card(rng)
        return rng.choice(
            [
                f"{rng.randrange(1900, 2100)}-0{rng.randrange(1, 10)}-1{rng.randrange(10)}", f"{digits(4)}-{digits(4)}", digits(9),
                wrong[:-1] + str((int(wrong[-1]) + 1) % 10), f"300.{digits(3)}.{digits(2)}.{digits(2)}", f"{digits(1)},{digits(3)},{digits(3)}",
                f"978-3-{digits(2)}-{digits(6)}-{digits(1)}", f"{digits(2)}:{digits(2)}:{digits(2)}", f"{digits(24)}",
            ]
        )

    for _ in range(number):
        if rng.random() < 0.5:
            kind, span = entity()
            text = f"{prose()} "
            yield f"{text}{span} {prose()}", [(kind, len(text), len(text) + len(span))]
        else:
            yield f"{prose()} {other()} {prose()}", []


def training_pieces(rng, number):
    pieces = []
    for _ in range(number):
        span = [
            (0, f"{rng.choice(['ann', 'bo.2'])}@{rng.choice(['mail', 'x-y'])}.{rng.choice(['com', 'net'])}"),
            (1, ".".join(str(rng.randrange(256)) for _ in range(4))),
            (2, card(rng)),
            (3, f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"),
        ][rng.randrange(4)]
        pieces.append((span[0], "some words ", span[1], " and more"))
    return pieces


@pytest.fixture(scope="module")
def field():
    return P.train(training_pieces(random.Random(6), 120))


def test_held_out_accuracy(field):
    right = wrong = held = 0
    for text, marked in planted(random.Random(7), 1500):
        found = [(k, s, e) for k, s, e, _ in P.spans(text, field)]
        right += sum(m in found for m in marked)
        held += len(marked)
        wrong += sum(f not in marked for f in found)
    assert right >= 0.95 * held and wrong <= 0.02 * held


def test_neighbours_the_patterns_join(field):
    rng = random.Random(8)
    for _ in range(50):
        a, b = card(rng), card(rng)
        text = f"x {a} {b} y"
        assert base(text) == []
        assert P.spans(text, field) == [(2, 2, 18, False), (2, 19, 35, False)]
        phone = "+1 (743) 555-3824"
        text = f"{phone} {a}"
        assert P.spans(text, field) == [(2, 18, 34, False), (3, 0, 17, False)]
    for text in ("", None, "no numbers at all, dot", "1 2 3 4 5 6 7 8 9 10 11 12", "room 12, page 300-310", "meet at example.com"):
        assert P.spans(text, field) == []


def test_base_spans_stay_and_nothing_overlaps_them(field):
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice(["1", "12", "4111", " ", "-", ".", "+1 ", "(555) ", "a@b.co", " at ", " dot ", "[at]", "x"]) for _ in range(25))
        found = P.spans(text, field)
        own = base(text)
        assert [s[:3] for s in found if s[3]] == own and found == sorted(found)
        added = [s for s in found if not s[3]]
        assert all(s[2] <= t[1] or t[2] <= s[1] for s in added for t in found if s is not t)


def test_time_follows_the_length(field):
    texts = ["1" * 200_000, "1.2.3.4" * 20_000, " at dot" * 20_000, "@" * 100_000, "a@" * 100_000, "[at]" * 50_000, "a" * 300_000 + "@"]
    texts += ["a [at] b [dot] " * 10_000, "12345678 " * 20_000, "x@y.z" * 20_000, "+1(" * 10_000, "1 " * 20_000]
    for text in texts:
        start = time.perf_counter()
        P.spans(text, field)
        assert time.perf_counter() - start < 20, text[:20]


def test_query_on_odd_rows(spark):
    rng = random.Random(10)
    texts = [None, "", " \n", "é漢 ana@firm.com, 10.1.2.3", f"{card(rng)} {card(rng)}", "+1 (743) 555-3824", "plain words"]
    texts += [t for t, _ in planted(rng, 40)] + ["word " * 40_000 + "ana@firm.com"]
    rows = [(i, t, "en", "s", 0, "x", 1, True) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "a@b.org", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    got = P.span_digests(P.find_spans(docs))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def listed(spans):
        return ",".join(f"{P.KINDS[k]}:{s}:{e}" for k, s, e in spans)

    found = got.collect()
    assert len(found) == len(rows)
    by_row = {(r.doc_id, r.base_sha256): r for r in found}
    for row in rows:
        own = base(row[1] or "")
        r = by_row[row[0], hashlib.sha256(listed(own).encode()).hexdigest()]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in own) for n in range(4)]
        assert set(filter(None, listed(own).split(","))) <= set(r.spans.split(","))
    assert by_row[4, hashlib.sha256(b"").hexdigest()].spans == "card:0:16,card:17:33"
    again = {(r.doc_id, r.base_sha256): r for r in P.span_digests(P.find_spans(docs.repartition(5))).collect()}
    assert again == by_row
    assert P.span_digests(P.find_spans(docs.limit(0))).collect() == []


def test_redaction(spark, field):
    docs = spark.createDataFrame([(1, "to ana@firm.com or (743) 555-3824!", "en", "s", 9, "x", 1, True), (2, None, "en", "s", 9, "x", 1, True)], DOCS)
    rows = sorted(P.redact(docs, field).collect())
    assert [r.text for r in rows] == ["to [email] or [phone]!", None]
    assert rows[0][2:] == ("en", "s", 9, "x", 1, True)
    assert P.redacted("a@1.2.3.4 b", field) == "[email] b"
