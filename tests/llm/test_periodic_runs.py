"""Lyndon arrays and periodic runs against brute force, and on odd input."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import pytest

from gaugeflow.llm import periodic_runs as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, runs long, g long, words string"


def longest_lyndon_words(ids):
    """The next smaller suffix ends the longest Lyndon word."""
    return [next((j for j in range(i + 1, len(ids)) if ids[j:] < ids[i:]), len(ids)) - i for i in range(len(ids))]


def all_runs(words, min_length, min_exponent):
    found = []
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            stretch = words[start : start + length]
            if i > start and length >= max(min_length, min_exponent * q):
                if not any(stretch[r:] == stretch[:-r] for r in range(1, q)):
                    found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def sequences(seed, number):
    rng = random.Random(seed)
    for _ in range(number):
        n, kinds = rng.randrange(90), rng.randrange(1, 5)
        made = [rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.7:
            a, p = rng.randrange(n), rng.randrange(1, 12)
            made = [made[min(a + (i - a) % p, n - 1)] if i >= a else w for i, w in enumerate(made)]
        yield made


def test_lyndon_arrays_equal_the_next_smaller_suffixes():
    for made in sequences(1, 1500):
        kinds = sorted(set(made))
        ids = [kinds.index(x) for x in made]
        assert P.lyndon_array(ids, len(kinds)) == longest_lyndon_words(ids)


@pytest.mark.parametrize("limits", [(24, 3), (5, 3), (4, 2), (1, 2), (1, 4)])
def test_runs_equal_brute_force(limits):
    for made in sequences(2, 500):
        assert P.find_runs(made, *limits) == all_runs(made, *limits)
    with pytest.raises(ValueError):
        P.find_runs([1, 1], 1, 1)


def test_time_follows_the_length():
    """One word, a short cycle, no repeats, and a word of Fibonacci, in which runs nest."""
    a, b = [0], [0, 1]
    while len(b) < 60_000:
        a, b = b, b + a
    for made in ([0] * 60_000, [i % 5 for i in range(60_000)], list(range(60_000)), b):
        start = time.perf_counter()
        P.find_runs(made)
        assert time.perf_counter() - start < 10
    assert P.find_runs([0] * 60_000) == [(0, 60_000, 1)]
    assert P.find_runs([9, 8, 7] + [i % 5 for i in range(50)]) == [(3, 50, 5)]


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = all_runs(words, 24, 3)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def test_query_equals_brute_force_on_odd_rows(spark):
    rng = random.Random(4)

    def prose(n, kinds):
        return " ".join(rng.choice("abcdefgh"[:kinds]) + rng.choice(["", "é", "漢"]) for _ in range(n))

    texts = [None, "", " \t\n", "one", "a " * 23, "a " * 24, "x y z " * 9, ("a b " * 20) + ("c d e " * 20)]
    texts += [prose(rng.randrange(1, 400), rng.randrange(1, 8)) for _ in range(60)]
    texts += ["  no break " * 12, "\x0b\x0cv w\r\n" * 30, prose(3000, 2)]
    rows = [(i, t, "en", "s", 0, 5, 6, "x") for i, t in enumerate(texts)]
    rows += [rows[6], (None, "q r " * 20, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    got = P.run_digests(P.periodic_runs(P.with_cycles(docs)))
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    key = repr
    assert sorted(map(tuple, got.collect()), key=key) == sorted((expected(r[0], r[1]) for r in rows), key=key)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in rows if r[0] is not None)


def test_operator_on_whole_rows(spark):
    docs = spark.createDataFrame([(1, "k l " * 20 + "end", 3)], "doc_id int, text string, n_words int")
    row = P.periodic_runs(docs).collect()[0]
    assert (row.doc_id, row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (1, 41, [(0, 40, 2)], "k l end")
    assert P.periodic_runs(spark.createDataFrame([], DOCS)).collect() == []
    assert P.run_digests(P.periodic_runs(P.with_cycles(spark.createDataFrame([], DOCS)))).collect() == []
