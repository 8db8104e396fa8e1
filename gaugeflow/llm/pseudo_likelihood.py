"""Masked pseudo-likelihood: a window network in numpy predicts every word from both sides."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import byte_words, with_row_id
from gaugeflow.session import materialize

#: The network sees words as so many kinds, by hash; counts are kept for every distinct word.
KINDS = 1 << 16
#: So many of the commonest words' counts reach the tasks as they are; all others are joined by word.
COMMON = 1 << 16
#: The network predicts classes of kinds: the commonest alone, the rest in bands of like frequency.
CLASSES = 128
ALONE = 96
SIDE = 2
WIDTH = 8
HIDDEN = 24
BATCH = 1024
#: Words that a task holds at once, whole documents of them; one longer document is held alone.
HELD = 1 << 18
ROUNDS = 2
RATE = 0.05
SEED = 11
PAD = CLASSES
#: Logits up to here have exponentials, and sums of them, that single precision holds.
SAFE = 60


class _Digests(dict):
    """64-bit hash of a word."""

    def __missing__(self, word):
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def _portions(batches, column: int, width: int):
    """Batches cut between rows, so that a portion has at most HELD words of ``width`` bytes in a column, or one row."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64) // width
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > HELD:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def _joined(column) -> tuple[np.ndarray, np.ndarray]:
    """The words of a column's rows one after another, and how many each row has."""
    rows = [np.frombuffer(r.as_py(), "<u8") for r in column]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.concatenate([*rows, np.zeros(0, "<u8")]).view(np.int64), sizes


def _places(words: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word is or would be in the ordered ``common``, and whether it is there."""
    if not len(common):
        return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
    at = np.minimum(np.searchsorted(common, words), len(common) - 1)
    return at, common[at] == words


def _tokens(batches):
    known = _Digests()
    for batch in _portions(batches, 1, 6):  # a word and its space take some six bytes
        rows = []
        for text in batch.column(1).cast(pa.binary()):
            words = byte_words((text.as_py() or b"").lower())
            if len(known) > 200_000:
                known.clear()
            rows.append(np.fromiter(map(known.__getitem__, words), "<u8", len(words)))
        kinds = pa.array([(r % KINDS).astype("<u2").tobytes() for r in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), kinds, pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "kinds", "words"])


def tokenised(docs: DataFrame) -> DataFrame:
    """row (its number), doc_id, kinds (two bytes a word), words (64-bit hashes) of every row, stored once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_row_id(rows.mapInArrow(_tokens, "doc_id long, kinds binary, words binary"), "row", "kinds")


def _counted(batches):
    total = np.zeros(KINDS, np.int64)
    for batch in batches:
        for row in batch.column(0):
            total += np.bincount(np.frombuffer(row.as_py(), "<u2"), minlength=KINDS)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["kind", "n"])


def count_kinds(tokens: DataFrame) -> np.ndarray:
    """Occurrences of each kind in all documents; one row a kind reaches the driver."""
    sums = tokens.select("kinds").mapInArrow(_counted, "kind int, n long").groupBy("kind").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(KINDS, np.int64)
    counts[sums.column("kind").to_numpy()] = sums.column("n").to_numpy()
    return counts


def _words_counted(batches):
    for batch in _portions(batches, 0, 8):
        word, n = np.unique(_joined(batch.column(0))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n.astype(np.int64))], ["word", "n"])


def count_words(tokens: DataFrame) -> DataFrame:
    """word, n: occurrences of every distinct word, a table that grows with the corpus."""
    counted = tokens.select("words").mapInArrow(_words_counted, "word long, n long")
    return materialize(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")


def rare_sums(scored: DataFrame, counts: DataFrame) -> DataFrame:
    """row, rare: sum of the log counts of a row's words that it lists as rare."""
    listed = scored.select("row", F.explode("rare").alias("word"))
    return listed.join(counts, "word").groupBy("row").agg(F.sum(F.log("n")).alias("rare"))


class Vocabulary:
    """Class of each kind, and the log of the occurrences in its class; unseen kinds count as half an occurrence."""

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        self.classes = np.zeros(KINDS, np.uint8)
        self.classes[order[:ALONE]] = np.arange(ALONE)
        rest = order[ALONE:]
        held = np.cumsum(counts[rest] + 0.5)
        band = np.minimum((held / held[-1] * (CLASSES - ALONE)).astype(int), CLASSES - ALONE - 1)
        self.classes[rest] = ALONE + band
        totals = np.bincount(self.classes, counts, CLASSES)
        self.held = np.log(np.maximum(totals, 1))


SHAPES = {
    "embedding": (CLASSES + 1, WIDTH),
    "inner": (2 * SIDE * WIDTH, HIDDEN),
    "inner_bias": (HIDDEN,),
    "outer": (HIDDEN, CLASSES),
    "outer_bias": (CLASSES,),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    found, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        found[name] = flat[at : at + size].reshape(shape)
        at += size
    return found


def first_parameters() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return np.concatenate(
        [np.zeros(s).ravel() if len(s) == 1 else (rng.standard_normal(s) / np.sqrt(s[0] if n != "embedding" else 4)).ravel() for n, s in SHAPES.items()]
    ).astype(np.float32)


def contexts(classes: np.ndarray) -> np.ndarray:
    """The classes of two words before and two after each word; PAD beyond the ends. The word itself is masked."""
    padded = np.concatenate([np.full(SIDE, PAD, np.uint8), classes, np.full(SIDE, PAD, np.uint8)])
    count = len(classes)
    return np.stack([padded[i : i + count] for i in range(2 * SIDE + 1) if i != SIDE], axis=1)


def _row_max(values: np.ndarray) -> np.ndarray:
    """Largest value of each row, by halves: whole columns at once instead of row by row."""
    while (width := values.shape[1]) > 1:
        half = (width + 1) // 2
        values = np.maximum(values[:, :half], values[:, width - half :])
    return values


def forward(p: dict, context: np.ndarray, target: np.ndarray):
    """Inputs and values of the hidden layer, and per row the target's logit, all exponentials and their sum."""
    joined = p["embedding"].take(context, axis=0).reshape(len(context), -1)
    hidden = joined @ p["inner"]
    hidden += p["inner_bias"]
    np.tanh(hidden, out=hidden)
    logits = hidden @ p["outer"]
    logits += p["outer_bias"]
    # hidden values lie in -1 to 1, so the weights bound the logits: only large ones need shifting before the exponential
    if (np.abs(p["outer"]).sum(axis=0) + np.abs(p["outer_bias"])).max() > SAFE:
        logits -= _row_max(logits)
    own = logits[np.arange(len(target)), target]
    chance = np.exp(logits, out=logits)
    return joined, hidden, own, chance, chance @ np.ones((CLASSES, 1), chance.dtype)


def loss_and_slope(flat: np.ndarray, context: np.ndarray, target: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean negative log-probability of the masked classes, and its gradient."""
    p, rows = unpack(flat), np.arange(len(target))
    joined, hidden, own, error, total = forward(p, context, target)
    loss = float((np.log(total[:, 0]) - own).mean())
    error *= 1 / (total * len(target))
    error[rows, target] -= 1 / len(target)
    back = (error @ p["outer"].T) * (1 - hidden * hidden)
    spread = (back @ p["inner"].T).reshape(-1, WIDTH)
    embedding = np.empty((CLASSES + 1, WIDTH), flat.dtype)
    places = context.ravel()
    for i in range(WIDTH):
        embedding[:, i] = np.bincount(places, spread[:, i], CLASSES + 1)
    slope = [embedding, joined.T @ back, back.sum(axis=0), hidden.T @ error, np.ones(len(target), error.dtype) @ error]
    return loss, np.concatenate([s.ravel() for s in slope]).astype(flat.dtype)


def _blocks(batches, classes):
    """Contexts and targets of whole documents, gathered into blocks."""
    held_c, held_t, size = [], [], 0
    for batch in batches:
        for row in batch.column(0):
            own = classes[np.frombuffer(row.as_py(), "<u2")]
            if not len(own):
                continue
            held_c.append(contexts(own))
            held_t.append(own)
            size += len(own)
            if size >= 16 * BATCH:
                yield np.concatenate(held_c), np.concatenate(held_t)
                held_c, held_t, size = [], [], 0
    if size:
        yield np.concatenate(held_c), np.concatenate(held_t)


def _trained(batches, classes, flat, rate):
    values, squares, seen = flat.copy(), np.full(SIZE, 1e-6, np.float32), 0
    for context, target in _blocks(batches, classes):
        order = np.random.default_rng(SEED).permutation(len(target))
        for start in range(0, len(target), BATCH):
            part = order[start : start + BATCH]
            _, slope = loss_and_slope(values, context[part], target[part])
            squares += slope * slope
            values -= rate * slope / np.sqrt(squares)
        seen += len(target)
    if seen:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SIZE), pa.int32()), pa.array(values.astype(np.float64) * seen), pa.array(np.full(SIZE, seen), pa.int64())],
            ["at", "weighted", "words"],
        )


def train(tokens: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Each round every task goes over all its documents from the same start; the mean by words is the next start."""
    flat, classes = first_parameters(), vocabulary.classes
    for r in range(rounds):
        start, rate = flat, RATE / (1 + r)
        sums = tokens.select("kinds").mapInArrow(
            lambda batches, start=start, rate=rate: _trained(batches, classes, start, rate), "at int, weighted double, words long"
        )
        mean = sums.groupBy("at").agg((F.sum("weighted") / F.sum("words")).alias("value")).toArrow()
        if mean.num_rows:
            flat = np.zeros(SIZE, np.float32)
            flat[mean.column("at").to_numpy()] = mean.column("value").to_numpy()
    return flat


def _scored(batches, flat, vocabulary, common, log_counts):
    """row, doc_id, n_words, known: the log-probabilities of all words, less the log counts of ``rare`` ones, not in ``common``."""
    p = unpack(flat)
    for batch in _portions(batches, 2, 8):
        rows = [np.frombuffer(r.as_py(), "<u2") for r in batch.column(1)]
        kinds = np.concatenate(rows) if rows else np.zeros(0, "<u2")
        own = vocabulary.classes[kinds]
        logs = np.zeros(len(kinds) + 1)
        context = np.concatenate([contexts(vocabulary.classes[r]) for r in rows]) if rows else np.zeros((0, 2 * SIDE), np.uint8)
        for start in range(0, len(own), BATCH):
            part = slice(start, start + BATCH)
            _, _, chosen, _, total = forward(p, context[part], own[part])
            logs[:-1][part] = chosen - np.log(total[:, 0])
        words, sizes = _joined(batch.column(2))
        at, held = _places(words, common)
        logs[:-1][held] += log_counts[at[held]]
        logs[:-1] -= vocabulary.held[own]
        ends = np.cumsum(sizes)
        sums = np.array([logs[e - n : e].sum() for e, n in zip(ends, sizes)])
        offsets = np.concatenate(([0], np.cumsum(~held)))[np.concatenate(([0], ends))]
        rare = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(words[~held]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(3), batch.column(0), pa.array(sizes), pa.array(sums, pa.float64()), rare],
            ["row", "doc_id", "n_words", "known", "rare"],
        )


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, pseudo_log_likelihood, mean_log_probability of every row.

    Every word is predicted from the two words on each side of it, itself masked; the document's score is the sum
    of the words' conditional log-probabilities, and their mean. A word's probability is that of its class, from
    a network trained on all documents, times its share in the class, from the counts of every distinct word over all
    documents: a distributed table that grows with them. The commonest words' counts go to all tasks, the others are
    joined by word. Classes are bands of hashed kinds, so the network itself is of fixed size. Each task trains on
    its own documents and Spark averages the parameters.
    Null, empty and wordless texts score 0 with a null mean. Repeated rows repeat; no rows give none.
    """
    tokens = tokenised(docs)
    vocabulary = Vocabulary(count_kinds(tokens))
    flat = train(tokens, vocabulary, rounds)
    counts = count_words(tokens)
    top = counts.orderBy(F.desc("n"), "word").limit(COMMON).toArrow()
    common, n = top.column("word").to_numpy(), top.column("n").to_numpy()
    order = np.argsort(common)
    common, log_counts = common[order], np.log(n[order])
    scored = tokens.select("doc_id", "kinds", "words", "row").mapInArrow(
        lambda batches: _scored(batches, flat, vocabulary, common, log_counts),
        "row long, doc_id long, n_words long, known double, rare array<long>",
    )
    scored = materialize(scored, "scored")
    total = F.col("known") + F.coalesce("sums.rare", F.lit(0.0))
    return scored.drop("rare").join(rare_sums(scored, counts).alias("sums"), "row", "left").select(
        "doc_id", "n_words", total.alias("pseudo_log_likelihood"), F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_probability")
    )
