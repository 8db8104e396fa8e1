"""Periodic runs of words: Lyndon arrays under both orders from suffix grouping, roots extended into runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import byte_words

MIN_LENGTH = 24
MIN_EXPONENT = 3

RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_DONE = -2


def lyndon_array(ids: list[int], kinds: int) -> list[int]:
    """Length of the longest Lyndon word at each place of a sequence of numbers 0 to ``kinds`` - 1, all of which occur.

    The grouping phase of a suffix sorter that never sorts: suffixes lie in groups by a common prefix, at first
    their first symbol, and groups are taken from the highest down. A place whose group is taken is struck from the
    chain of open places, and its prefix, which reaches to the next open place and is its longest Lyndon word, is
    appended to that of the open place before it. Places of one group that were given the same number of copies
    move to a new group right above their old one. Each place is struck once and each stretch struck moves one
    place, so time is linear but for the sorting of a group's moves. The end counts as lower than any symbol.
    """
    n = len(ids)
    after, before = list(range(1, n + 2)), list(range(-1, n + 1))
    length = [0] * n
    members: list[list[int]] = [[] for _ in range(kinds + 1)]
    for i, s in enumerate(ids):
        members[s].append(i)
    size = [len(m) for m in members]
    group = [*ids, -1, -1]  # the end, and last, as place -1, the start
    lower, upper = list(range(-1, kinds)), list(range(1, kinds + 2))

    def raise_members(old: int, places: list[int]) -> None:
        if size[old] == len(places):
            return  # the whole group moves: its place among the groups stays
        new, above = len(size), upper[old]
        size[old] -= len(places)
        size.append(len(places))
        members.append(places)
        for p in places:
            group[p] = new
        lower.append(old)
        upper.append(above)
        upper[old] = lower[above] = new

    taken = kinds - 1
    while taken >= 0:
        if size[taken] == 1:
            i = next(i for i in members[taken] if group[i] == taken)
            p, end = before[i], after[i]
            length[i] = end - i
            group[i] = _DONE
            after[p], before[end] = end, p
            if group[p] >= 0 and size[group[p]] > 1:
                raise_members(group[p], [p])
        else:
            moved: dict[tuple[int, int], list[int]] = {}
            for i in members[taken]:
                if group[i] != taken or group[before[i]] == taken:
                    continue  # moved away since, or not the first of neighbouring copies
                p, copies = before[i], 0
                while group[i] == taken:
                    length[i] = after[i] - i
                    i = after[i]
                    copies += 1
                after[p], before[i] = i, p
                if group[p] >= 0:
                    moved.setdefault((group[p], copies), []).append(p)
            # Most copies first: each new group goes right above the old one, so below those before it.
            for key in sorted(moved, reverse=True) if len(moved) > 1 else moved:
                raise_members(key[0], moved[key])
        members[taken] = []
        taken = lower[taken]
    return length


def _agreement(ids: np.ndarray, i: int, j: int) -> int:
    """Number of equal symbols from places i < j on, compared in blocks that double."""
    found, block = 0, 32
    while j + found < len(ids):
        size = min(block, len(ids) - j - found)
        unequal = ids[i + found : i + found + size] != ids[j + found : j + found + size]
        first = int(unequal.argmax())
        if unequal[first]:
            return found + first
        found, block = found + size, 2 * block
    return found


def find_runs(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs at least as long as both limits ask, by start and period.

    A word of a run occurs in each of its whole periods, so no run holds a word that occurs less than
    ``min_exponent`` times: those words cut the sequence, and stretches of at least ``min_length`` words are searched.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    if len(words) < min_length:
        return []
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    often = np.bincount(ids)[ids] >= min_exponent if len(ids) else np.zeros(0, bool)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], often.view(np.int8), [0]))))
    found = []
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if end - start >= min_length:
            own = np.unique(ids[start:end], return_inverse=True)[1]
            found += [(start + at, length, q) for at, length, q in _runs_of(own, min_length, min_exponent)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def _runs_of(ids: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """The runs of a sequence of numbers, all of which from 0 on occur.

    Every run has, under an order or its reverse, a longest Lyndon word of its period's length that starts in its first
    period. Such a root and what follows one period later are extended to both sides as far as they agree. Roots that lie
    in a stretch already found with their period are not extended again.
    """
    n, kinds = len(ids), int(ids.max()) + 1
    backwards, places = ids[::-1], np.arange(n)
    reach = 2 if min_exponent >= 3 else 1  # from three periods on a whole second root follows the first
    roots = set()
    for order in (ids, kinds - 1 - ids):
        period = np.array(lyndon_array(order.tolist(), kinds), np.int64)
        whole = places[places + reach * period <= n]
        if reach == 2:
            q = period[whole]
            whole = whole[(ids[whole] == ids[whole + q]) & (ids[whole + q - 1] == ids[whole + 2 * q - 1])]
        roots.update(zip(period[whole].tolist(), whole.tolist()))
    found, known = [], (0, 0)  # the period of the latest stretch, and where it ends
    for q, i in sorted(roots):
        if known[0] == q and i + q <= known[1]:
            continue
        start = i - _agreement(backwards, n - i - q, n - i)
        end = i + q + _agreement(ids, i, i + q)
        if end - start < 2 * q:
            continue
        known = (q, end)
        if end - start >= max(min_length, min_exponent * q):
            found.append((start, end - start, q))
    return found


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that lie in no run after that run's first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def _found(batches, min_length, min_exponent):
    for batch in batches:
        n_words, runs, texts = [], [], []
        for text in batch.column(1).cast(pa.binary()):
            words = byte_words(text.as_py())
            own = find_runs(words, min_length, min_exponent)
            n_words.append(len(words))
            runs.append([dict(zip(("start", "length", "period"), run)) for run in own])
            texts.append(b" ".join(collapsed(words, own)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(runs, _RUN), pa.array(texts, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed text of every row.

    A run is a stretch of words with smallest period q, at least ``min_length`` and ``min_exponent`` * q words long, that
    no neighbouring word extends. The collapsed text holds, joined by one space, the words that lie in no run after
    its first q words. Whole texts; null and empty ones have no words, no runs and an empty collapsed text. Repeated
    rows and null ids repeat as they are; no rows give none. One pass without a shuffle; memory follows the longest text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        lambda batches: _found(batches, min_length, min_exponent),
        f"doc_id long, n_words long, runs array<{RUN}>, collapsed string",
    )


def with_cycles(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which the words of every tenth document (by the CRC of its id) turn periodic from some place on.

    With h the CRC-32 of the decimal id, g = h div 10 and n words: if 10 divides h, each word from a = g mod n on becomes
    the word a + (i - a) mod p, with p = 1 + (n - a) div (3 + g mod 8). A null id, or a text without words, stays.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = named.selectExpr("*", "crc32(cast(cast(doc_id AS string) AS binary)) AS h").selectExpr(
        "*", r"if(h % 10 = 0, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), NULL) AS words", "h div 10 AS g"
    )
    placed = chosen.selectExpr("*", "g % nullif(size(words), 0) AS a").selectExpr(
        "*", "1 + (size(words) - a) div (3 + g % 8) AS p"
    )
    word = "if(i >= a, get(words, cast(a + (i - a) % p AS int)), w)"
    return placed.selectExpr(
        "doc_id", f"if(size(words) > 0, array_join(transform(words, (w, i) -> {word}), ' '), text) AS text"
    )


def run_digests(found: DataFrame) -> DataFrame:
    """The rows of periodic_runs as counts, the run with most periods, and digests of runs and collapsed text.

    Of runs with the same exact share of length and period the first wins; without a run its columns are null.
    """
    best = "reduce(runs, get(runs, 0), (x, r) -> if(r.length * x.period > x.length * r.period, r, x))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.selectExpr("*", f"{best} AS best").selectExpr(
        "doc_id",
        "cast(size(runs) AS bigint) AS n_runs",
        "best.start",
        "best.length",
        "best.period",
        "1000 * best.length div best.period AS exponent_milli",
        f"sha2({lines}, 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )
