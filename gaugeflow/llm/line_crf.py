"""Quality rules: base counts, and lines labelled content or boilerplate by a linear-chain CRF."""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import byte_words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: Labelled documents that the chain is fitted on, the first by a hash of their id.
TRAINING_DOCS = 3000
STEPS = 60
RATE = 0.5
RIDGE = 1e-3
#: A document is kept if content lines hold at least this share of its words.
CONTENT_SHARE = 0.5

# The dealt symbols.
SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_LABEL, _CONTENT, _BOILERPLATE = (0, 1), 0, 1
#: What a line can show; the order numbers the bits of its pattern.
FEATURES = (
    "bias", "one or two words", "under six words", "over thirty words", "some symbols", "many symbols", "exclamations",
    "some capitals", "mostly capitals", "digits", "ends a sentence", "starts with a capital", "few distinct words",
    "hardly any distinct words", "repeats its last word", "bars between words", "equals an earlier line", "short words", "long words",
    "first line", "address or link", "licence words",
)
#: Weights towards boilerplate before training, and with nothing to train on.
PRIOR = dict(
    zip(FEATURES, (-2.0, 0, 0, -0.5, 0.5, 2.0, 2.0, 0.3, 1.5, 0.3, -0.5, 0, 0.5, 2.0, 2.0, 1.5, 0.5, 0, 0.5, 0, 0.3, 0.3))
)


def repeated_words(words: list[bytes]) -> int:
    """Words in five-word windows that occur twice or more in the text, the first occurrence included."""
    count = len(words) - WINDOW + 1
    if count < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    windows, size = ids, len(numbers)
    for i in range(1, WINDOW):
        if windows is not ids and size * len(numbers) >= 1 << 62:
            values, windows = np.unique(windows, return_inverse=True)
            size = len(values)
        windows = windows[: len(ids) - i] * len(numbers) + ids[i:]
        size *= len(numbers)
    _, group, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[group] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def pattern(line: bytes, words: list[bytes], again: bool, first: bool) -> int:
    """The line's features as bits."""
    size, count = len(line), len(words)
    symbols = size - len(line.translate(None, SYMBOLS))
    capitals = size - len(line.translate(None, _UPPER))
    small = size - len(line.translate(None, _LOWER))
    distinct = len(set(words))
    letters = sum(map(len, words))
    lowered = line.lower()
    shown = (
        True, count <= 2, count < 6, count > 30, symbols * 100 > 2 * size, symbols * 100 > 8 * size,
        line.count(b"!") * 3 > count, capitals * 10 > 3 * (capitals + small), capitals * 10 > 7 * (capitals + small),
        (size - len(line.translate(None, _DIGITS))) * 10 > size, words[-1][-1:] in b".!?:;", words[0][:1].isupper(),
        count > 4 and distinct * 10 < 6 * count, count > 4 and distinct * 10 < 3 * count,
        sum(map(eq, words, words[1:])) * 3 > count, line.count(b" | ") * 4 > count, again, letters < 2 * count, letters > 14 * count,
        first, b"http" in lowered or b"@" in line or b"www." in lowered, b"licen" in lowered or b"copyright" in lowered,
    )
    return sum(1 << i for i, x in enumerate(shown) if x)


def analyse(text: bytes | None) -> tuple[tuple[int, int, int, int, int], list[int], list[int]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), and pattern and word count of each line with a word."""
    text = text or b""
    words = byte_words(text)
    chars = sum(map(len, words)) if text.isascii() else sum(len(w.decode()) for w in words)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen, patterns, sizes, repeats = set(), [], [], 0
    for line in text.split(b"\n"):
        own = line.split()
        if not own:
            continue
        again = line in seen
        seen.add(line)
        repeats += again
        patterns.append(pattern(line, own, again, not patterns))
        sizes.append(len(own))
    return (len(words), chars, symbols, repeats, repeated_words(words)), patterns, sizes


def _bits(patterns) -> np.ndarray:
    return (np.asarray(patterns, np.int64)[..., None] >> np.arange(len(FEATURES)) & 1).astype(np.float64)


class Chain:
    """Linear chain over two labels: ``weights`` towards boilerplate for each feature, ``moves`` between labels."""

    def __init__(self, weights=None, moves=None):
        self.weights = np.array([PRIOR[f] for f in FEATURES]) if weights is None else weights
        self.moves = np.array([[0.5, -0.5], [-0.5, 0.5]]) if moves is None else moves
        self.known: dict[int, float] = {}

    def emission(self, found: int) -> float:
        score = self.known.get(found)
        if score is None:
            score = self.known[found] = float(sum(w for i, w in enumerate(self.weights) if found >> i & 1))
        return score

    def decode(self, patterns: list[int]) -> list[int]:
        """Most likely labels by Viterbi; ties go to content."""
        if not patterns:
            return []
        (cc, cb), (bc, bb) = self.moves.tolist()
        content, other, back = 0.0, self.emission(patterns[0]), []
        for p in patterns[1:]:
            from_c, from_b = content + cc, other + bc
            to_c, to_b = content + cb, other + bb
            back.append((from_b > from_c, to_b > to_c))
            content, other = max(from_c, from_b), max(to_c, to_b) + self.emission(p)
        label = int(other > content)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]


def log_likelihood(weights, moves, features, labels, held):
    """Mean log-likelihood of label sequences (padded to one length; ``held`` marks lines) and its gradient.

    Sequences are handled side by side, one step of the chain at a time, forwards and backwards in log space.
    """
    score = features @ weights
    score = np.stack([np.zeros_like(score), score], axis=2)
    docs, length = labels.shape
    forward, backward = np.zeros((docs, length, 2)), np.zeros((docs, length, 2))
    forward[:, 0] = score[:, 0]
    for t in range(1, length):
        step = np.logaddexp(forward[:, t - 1, :1] + moves[0], forward[:, t - 1, 1:] + moves[1]) + score[:, t]
        forward[:, t] = np.where(held[:, t, None], step, forward[:, t - 1])
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    for t in range(length - 2, -1, -1):
        ahead = backward[:, t + 1] + score[:, t + 1]
        step = np.logaddexp(ahead[:, :1] + moves[:, 0], ahead[:, 1:] + moves[:, 1])
        backward[:, t] = np.where(held[:, t + 1, None], step, 0.0)
    chance = np.exp(forward + backward - total[:, None, None])[..., 1] * held
    weight_slope = np.einsum("dt,dtf->f", (labels - chance) * held, features)
    move_slope, told = np.zeros((2, 2)), np.where(held, np.take_along_axis(score, labels[..., None], 2)[..., 0], 0).sum()
    both = held[:, 1:]
    for a in _LABEL:
        for b in _LABEL:
            joint = np.exp(forward[:, :-1, a] + moves[a, b] + score[:, 1:, b] + backward[:, 1:, b] - total[:, None]) * both
            seen = ((labels[:, :-1] == a) & (labels[:, 1:] == b) & both).sum()
            move_slope[a, b] = seen - joint.sum()
            told += seen * moves[a, b]
    return (told - total.sum()) / docs, weight_slope / docs, move_slope / docs


def train(sequences: list[tuple[list[int], int]], steps: int = STEPS) -> Chain:
    """Gradient ascent, each weight with a step size of its own, from the prior weights and towards them.

    All lines of a document take its label: quality 1 content, 0 boilerplate. Both labels weigh as they occur.
    """
    sequences = [s for s in sequences if s[0]]
    chain = Chain()
    if len({label for _, label in sequences}) < 2:
        return chain
    sequences.sort(key=lambda s: len(s[0]))
    groups = []
    for start in range(0, len(sequences), 200):
        part = sequences[start : start + 200]
        length = max(len(p) for p, _ in part)
        padded = np.array([p + [0] * (length - len(p)) for p, _ in part])
        held = np.arange(length) < np.array([len(p) for p, _ in part])[:, None]
        labels = np.where(held, np.array([label for _, label in part])[:, None], 0)
        groups.append((_bits(padded), labels, held, len(part)))
    values = np.concatenate([chain.weights, chain.moves.ravel()])
    prior, squares = values.copy(), np.full(len(values), 1e-8)
    for _ in range(steps):
        slope = -RIDGE * (values - prior)
        for features, labels, held, count in groups:
            _, a, b = log_likelihood(values[: len(FEATURES)], values[len(FEATURES) :].reshape(2, 2), features, labels, held)
            slope += np.concatenate([a, b.ravel()]) * (count / len(sequences))
        squares = squares + slope * slope
        values = values + RATE * slope / np.sqrt(squares)
    return Chain(values[: len(FEATURES)], values[len(FEATURES) :].reshape(2, 2))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


def judge(chain: Chain, text: bytes | None):
    """Base counts, whether they fail, and whether the text is kept."""
    counts, patterns, sizes = analyse(text)
    failed = base_failed(counts[0], counts[4])
    if failed:
        return counts, True, False
    content = sum(n for label, n in zip(chain.decode(patterns), sizes) if label == _CONTENT)
    return counts, False, content >= CONTENT_SHARE * counts[0]


def _sequences(batches):
    for batch in batches:
        lines = [analyse(t.as_py())[1] for t in batch.column(1).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.list_(pa.int64()))], ["quality", "lines"])


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCS) -> Chain:
    """Learns from at most ``limit`` labelled documents."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "doc_id is not null and quality in (0, 1)"
    )
    chosen = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    taken = texts.join(F.broadcast(chosen), "doc_id")  # at most ``limit`` rows
    one = taken.groupBy("doc_id").agg(F.min(F.struct("text", "quality")).alias("one")).orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = one.select("one.quality", "one.text").mapInArrow(_sequences, "quality int, lines array<long>").toArrow().to_pylist()
    return train([(r["lines"], _CONTENT if r["quality"] == 1 else _BOILERPLATE) for r in rows])


def _judged(batches, chain):
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    for batch in batches:
        found = [judge(chain, t.as_py()) for t in batch.column(1).cast(pa.binary())]
        columns = zip(*[(*counts, failed, kept) for counts, failed, kept in found]) if found else [()] * 7
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)


def judge_documents(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row.

    The counts are over the whole text, null as empty. A text that passes the base rules has its lines labelled
    by the chain; it is kept if content lines hold at least half of its words. Lines without a word carry no label.
    Without labels of both classes the prior weights decide. Repeated rows repeat; no rows give none.
    """
    chain = fit(docs, labels, limit)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        lambda batches: _judged(batches, chain),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean",
    )


def _filtered(batches, chain):
    for batch in batches:
        kept = [judge(chain, t.as_py())[2] for t in batch.column("text").cast(pa.binary())]
        yield batch.filter(pa.array(kept, pa.bool_()))


def keep_good(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCS) -> DataFrame:
    """The rows of ``docs`` that judge_documents keeps, all columns as they are."""
    chain = fit(docs, labels, limit)
    return docs.mapInArrow(lambda batches: _filtered(batches, chain), docs.schema)
