"""Operators against plain counterparts: exhaustive flows, a projected-gradient dual, pasted halves, planted passages."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from gaugeflow.llm import line_crf, mixing, nbsvm, windows


def all_flows(capacity, quota, repeats):
    """Most words that sources can get, and the least cost of that, over all whole-numbered allocations."""
    arcs = [(p, s) for p in capacity for s in p]
    best = (-1, 0)
    for words in itertools.product(*[range(min(repeats * capacity[p], quota[s]) + 1) for p, s in arcs]):
        given = {p: sum(w for (q, _), w in zip(arcs, words) if q == p) for p in capacity}
        got = {s: sum(w for (_, t), w in zip(arcs, words) if t == s) for s in quota}
        if all(given[p] <= repeats * capacity[p] for p in capacity) and all(got[s] <= quota[s] for s in quota):
            cost = sum(max(0, given[p] - capacity[p]) for p in capacity)
            best = max(best, (sum(words), -cost))
    return best


@pytest.mark.parametrize("seed", range(40))
def test_routing_is_the_cheapest_largest_flow(seed):
    rng = random.Random(seed)
    patterns = [("a",), ("a", "b"), ("b", "c"), ("c",), ("a", "c")]
    capacity = {p: rng.randrange(1, 4) for p in rng.sample(patterns, rng.randrange(1, 4))}
    quota = {s: rng.randrange(5) for s in sorted({s for p in capacity for s in p})}
    flow = mixing.route(capacity, {p: p for p in capacity}, quota, 2)
    total = sum(sum(own.values()) for own in flow.values())
    cost = sum(max(0, sum(flow[p].values()) - capacity[p]) for p in capacity)
    assert all(sum(flow[p].get(s, 0) for p in flow) <= quota[s] for s in quota)
    assert (total, -cost) == all_flows(capacity, quota, 2)


@pytest.mark.parametrize("seed", range(5))
def test_dual_descent_reaches_the_optimum(seed):
    """The dual value equals that of many small projected gradient steps on the same problem."""
    rng = np.random.default_rng(seed)
    rows = [np.sort(rng.choice(12, 4, replace=False)) for _ in range(30)]
    values = [rng.normal(size=4) for _ in rows]
    labels = rng.integers(0, 2, 30)
    weights, bias = nbsvm.dual_descent(rows, values, labels, epochs=3000)
    signs = np.where(labels == 1, 1.0, -1.0)
    box = np.where(labels == 1, 1 / (labels == 1).sum(), 1 / (labels == 0).sum()) * nbsvm.PENALTY * len(labels) / 2
    x = np.zeros((30, 13))
    for i, (r, v) in enumerate(zip(rows, values)):
        x[i, r], x[i, 12] = v, 1.0
    signed = x * signs[:, None]
    gram, alpha = signed @ signed.T, np.zeros(30)
    rate = 1 / np.linalg.norm(gram, 2)
    for _ in range(60_000):
        alpha = np.clip(alpha + rate * (1 - gram @ alpha), 0, box)
    plain = signed.T @ alpha

    def primal(w):
        return 0.5 * w @ w + (box * np.maximum(0, 1 - signed @ w)).sum()

    own = np.concatenate([weights[:12], [bias]])
    assert abs(primal(own) - primal(plain)) < 1e-3 * max(1.0, primal(plain))
    assert not weights[12:].any()


def lines_of(rng, good, n):
    words = ["river", "walked", "slowly", "through", "evening", "market", "their", "house", "quietly", "morning", "looked", "garden"]
    menu = ["Home", "Login", "Cart", "About", "Help", "Terms", "Contact", "FAQ"]
    if good:
        return [" ".join(rng.choice(words) for _ in range(rng.randrange(9, 18))).capitalize() + "." for _ in range(n)]
    return [" | ".join(rng.choice(menu) for _ in range(rng.randrange(2, 4))) for _ in range(n)]


def test_chain_labels_the_halves_of_pasted_texts():
    """Trained on texts of one kind each, the chain tells the two halves of mixed ones apart line by line."""
    rng = random.Random(9)
    docs = [(line_crf.analyse("\n".join(lines_of(rng, i % 2, rng.randrange(3, 9))).encode())[1], 1 - i % 2) for i in range(200)]
    chain = line_crf.train(docs)
    right = total = 0
    for _ in range(60):
        a, b = rng.randrange(4, 9), rng.randrange(4, 9)
        parts = [(True, a), (False, b)]
        rng.shuffle(parts)
        text = "\n".join(line for good, n in parts for line in lines_of(rng, good, n))
        expected = [0 if good else 1 for good, n in parts for _ in range(n)]
        found = chain.decode(line_crf.analyse(text.encode())[1])
        assert len(set(found)) == 2
        right += sum(map(int.__eq__, found, expected))
        total += len(expected)
    assert right >= 0.9 * total


def test_planted_passages_are_found(spark):
    """Copies of 60 to 200 words with some words changed, similarity 0.8 or more, between words of their own."""
    rng = random.Random(10)

    def fresh(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    def shingles(words):
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    texts, planted = [], []
    while len(planted) < 60:
        passage = fresh(rng.randrange(60, 201))
        copy = list(passage)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(10, len(copy) - 10)] = fresh(1)[0]
        a, b = shingles(passage), shingles(copy)
        if len(a & b) < 0.8 * len(a | b):
            continue
        before, after = fresh(rng.randrange(30)), fresh(rng.randrange(30))
        texts += [" ".join(fresh(rng.randrange(30)) + passage + fresh(20)), " ".join(before + copy + after)]
        planted.append((len(texts) - 1, len(before), len(before) + len(copy)))
    texts += [" ".join(fresh(150)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = windows.repeated_passages(docs).collect()
    covered = 0
    for doc, start, end in planted:
        own = {i for r in found if r.doc_id == doc and r.first_doc_id == doc - 1 for i in range(r.start_word, r.end_word)}
        covered += len(own & set(range(start, end))) >= 0.8 * (end - start)
    assert covered >= 0.95 * len(planted)
    assert {r.doc_id for r in found} <= {doc for doc, *_ in planted}
