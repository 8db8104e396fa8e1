"""Packing token pieces into sequences by bounded-space online best-fit."""

from __future__ import annotations

import functools
import json
import math
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.session import materialize

SEQUENCE = 2048
END = 0
OPEN_BINS = 1024
PIECES_PER_TASK = 250_000
#: Chunks whose ids a Python worker remembers; further ones are encoded each time they occur.
CACHED_CHUNKS = 300_000

_PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


class _Chunks(dict):
    """Ids, as little-endian bytes, of `` `` + chunk."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk):
        found = self.encode(" " + chunk)
        if len(self) < CACHED_CHUNKS:
            self[chunk] = found
        return found


def _byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file -> byte: printable bytes stand for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """Text -> ids as little-endian unsigned 32-bit bytes, equal to what the tokenizer file gives.

    A byte-level BPE never joins what stands before and after a single space that follows a visible
    character, so texts are cut there, and the ids of frequent chunks are looked up. The merges of other chunks
    come from the same vocabulary and ranks. Texts with runs of white space before a space, or with a special
    token's string, go through the tokenizer itself as a whole.
    """
    import numpy as np
    import regex
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as handle:
        spec = json.load(handle)
    special = [t["content"] for t in spec.get("added_tokens", ())]
    whole = Tokenizer.from_file(path)
    letters = _byte_alphabet()
    ranks = {
        bytes(letters[c] for c in token): number
        for token, number in spec["model"]["vocab"].items()
        if token not in special
    }
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    merges = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    crossing = regex.compile(r"\s |  |" + "|".join(map(regex.escape, special)) if special else r"\s |  ")

    def of_ids(ids):
        return np.asarray(ids, dtype="<u4").tobytes()

    chunks = _Chunks(lambda text: of_ids(merges.encode_ordinary(text)))

    def encode(text: str) -> bytes:
        if not text:
            return b""
        if text[0].isspace() or text[-1].isspace() or crossing.search(text):
            return of_ids(whole.encode(text, add_special_tokens=False).ids)
        first, *rest = text.split(" ")
        return of_ids(merges.encode_ordinary(first)) + b"".join([chunks[c] for c in rest])

    return encode


def cut(length: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the remainder first, then whole sequences."""
    head = length % size
    pieces = [(0, head)] if head else []
    return pieces + [(start, size) for start in range(head, length, size)]


def _pieces_of(batches, path, size):
    encode = encoder(path)
    end = END.to_bytes(4, "little")
    for batch in batches:
        columns = [[] for _ in range(6)]
        for doc_id, row, text in zip(*(batch.column(i) for i in range(3))):
            ids = encode(text.as_py() or "") + end
            doc_id, row = doc_id.as_py(), row.as_py()
            for piece, (start, length) in enumerate(cut(len(ids) // 4, size)):
                values = (doc_id, row, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]))
                for column, value in zip(columns, values):
                    column.append(value)
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            ["doc_id", "row", "piece", "start", "length", "ids_crc32"],
        )


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE) -> DataFrame:
    """doc_id, row, piece, start, length, ids_crc32; ``row`` tells rows with the same doc_id apart."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(lambda batches: _pieces_of(batches, tokenizer, size), _PIECES)


class OpenBins:
    """Up to ``limit`` open bins; a bit of ``free`` is set where a bin with so much space is open.

    The tightest open bin that holds a piece is the lowest set bit from the piece's length on. When a new bin
    is needed and the limit is reached, the fullest bin, the lowest set bit of all, is closed for good.
    """

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.free, self.open, self.bins, self.made = 0, 0, {}, 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin number, offset) for a piece of 1 to ``size`` tokens."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.open >= self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
            space, number = self.size, self.made
            self.made += 1
        if space > length:
            self.bins.setdefault(space - length, []).append(number)
            self.free |= 1 << (space - length)
            self.open += 1
        return number, self.size - space

    def _take(self, space: int) -> int:
        stack = self.bins[space]
        number = stack.pop()
        if not stack:
            del self.bins[space]
            self.free &= ~(1 << space)
        self.open -= 1
        return number


def _pack(batches, size, limit):
    from pyspark import TaskContext

    base, bins = TaskContext.get().partitionId() << 40, OpenBins(size, limit)
    for batch in batches:
        placed = [bins.place(n) for n in batch.column("length").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            + [pa.array((base + n for n, _ in placed), pa.int64()), pa.array((o for _, o in placed), pa.int64())],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def pack(found: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Adds sequence_id and offset to stored pieces.

    Pieces are dealt out by a hash into tasks of about ``per_task``, each with its own open bins, and arrive in
    the order of that hash. Only the pieces' numbers move, never tokens. The number of tasks follows the number
    of pieces; each can leave at most ``open_bins`` sequences unfilled.
    """
    tasks = max(1, math.ceil(found.count() / per_task))
    order = F.xxhash64("doc_id", "row", "piece")
    dealt = found.withColumn("deal", order).repartition(tasks, "deal").sortWithinPartitions("deal", "row", "piece")
    return dealt.drop("row", "deal").mapInArrow(
        lambda batches: _pack(batches, size, open_bins),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SEQUENCE) -> DataFrame:
    """Token pieces of all documents in sequences of at most ``size``.

    Null and empty texts are one piece holding the end id alone. Repeated rows are packed as often as they occur;
    a null doc_id is kept. Texts of any length are cut into whole sequences after a shorter first piece. An
    empty table gives no rows. Further columns are not read.
    """
    return pack(materialize(pieces(docs, tokenizer, size), "pieces"), size)
