"""SimHash near duplicates through an inverted index of byte positions with count filtering."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import byte_words, components, with_row_id
from gaugeflow.session import materialize

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
BYTES = 8
#: Postings hold four of the eight byte positions: two of four neighbouring pairs.
PAIRS = [(0, 1), (2, 3), (4, 5), (6, 7)]
COMBINATIONS = [a + b for a, b in itertools.combinations(PAIRS, 2)]
#: A list of n fingerprints costs n * (n - 1) / 2 pairs, or 65 * n shared neighbours; beyond this the second is cheaper.
LIST_PAIRS = 130


def fingerprint_of(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash; 0 for a text without words."""
    words = byte_words(text.lower()) if text else []
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<i8")[0])


def _fingerprints(batches, shingle_words):
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        found = pa.array((fingerprint_of(t.as_py(), shingle_words) for t in texts), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp of every row; whole texts, in Arrow batches."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: _fingerprints(batches, shingle_words), "doc_id long, fp long"
    )


def _byte(column, position: int):
    return F.shiftrightunsigned(F.col(column) if isinstance(column, str) else column, 8 * position).bitwiseAND(F.lit(255))


def _posting_key(fp: str, positions, number: int):
    key = F.lit(number).cast("long")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(_byte(fp, p))
    return key


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """src, dst: enough links between the distinct fingerprints ``fp`` to give the right components.

    A difference of at most two bits leaves at least six of the eight positional bytes equal, hence two of
    the four byte pairs; so the index holds six postings a fingerprint, each of four positional bytes. Two
    fingerprints that meet in a list have their equal positional bytes tallied; pairs reaching
    ``8 - max_bits`` are verified bit by bit. Lists longer than LIST_PAIRS, as a big family of near copies
    makes them, aren't paired: each of their members is linked with the smallest member that shares a
    neighbour at one bit. Two fingerprints share such a neighbour exactly if they differ in two bits or fewer,
    so this loses nothing and stays linear. For ``max_bits`` below 2 the neighbours are as many bits narrower.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the index guarantees its minimum for at most two differing bits")
    postings = distinct.select(
        "fp", F.explode(F.array(*[_posting_key("fp", c, i) for i, c in enumerate(COMBINATIONS)])).alias("posting")
    )
    lists = postings.groupBy("posting").agg(F.count("*").alias("members")).where("members > 1")
    met = materialize(postings.join(lists, "posting"), "postings")
    short = met.where(F.col("members") <= LIST_PAIRS).select("posting", "fp")
    pairs = short.alias("a").join(short.alias("b"), F.expr("a.posting = b.posting and a.fp < b.fp")).select(
        F.col("a.fp").alias("src"), F.col("b.fp").alias("dst")
    )
    equal = sum(
        (_byte("src", p) == _byte("dst", p)).cast("int") for p in range(BYTES)
    )
    paired = pairs.where(equal >= BYTES - max_bits).where(
        F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits
    )
    crowded = met.where(F.col("members") > LIST_PAIRS).select("fp").distinct()
    if max_bits == 0:
        return paired
    masks = [0] + [(1 << b) - (1 << 64 if b == 63 else 0) for b in range(64)]
    near = crowded.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("near")
    )
    if max_bits == 1:  # only a fingerprint that is itself a neighbour of another
        linked = near.join(crowded.select(F.col("fp").alias("near")), "near").select(
            F.col("fp").alias("src"), F.col("near").alias("dst")
        )
    else:
        first = near.groupBy("near").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high")
        linked = near.join(first, "near").where("fp <> low").select(
            F.col("low").alias("src"), F.col("fp").alias("dst")
        )
    return paired.union(linked)


def labelled(found: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp, component_id of every distinct fingerprint in ``found`` (doc_id, fp)."""
    distinct = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "fingerprints")
    roots = components(links(distinct.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("grouped")
    )
    alone = rooted.where("not grouped").select("fp", F.col("first_doc").alias("component_id"))
    grouped = rooted.where("grouped")
    least = grouped.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return alone.union(grouped.join(least, "root").select("fp", "component_id"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable through links.

    One row for every input row, repeated rows included. Null and wordless texts have the fingerprint zero and
    link like any other. A null doc_id counts for no component; a component without any other has a null id.
    Further columns of ``docs`` are not read. Equal fingerprints are one node, so copies add no links.
    """
    found = materialize(fingerprints(docs, shingle_words), "simhash")
    return found.join(labelled(found, max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of each component, all columns kept.

    Of several rows with that same id, or of a component whose ids are all null, one stays.
    """
    rows = with_row_id(docs, "__row", "numbered")
    keyed = rows.select(F.col("__row").alias("doc_id"), "text")
    found = materialize(fingerprints(keyed, shingle_words), "simhash")
    ids = rows.select(F.col("__row").alias("row"), F.col("doc_id").cast("long").alias("id"))
    held = found.select(F.col("doc_id").alias("row"), "fp").join(ids, "row").join(
        labelled(found, max_bits), "fp"
    )
    # of each component: known ids first, then the smallest id, then the first stored row
    best = held.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("best"))
    return rows.join(best.select(F.col("best.row").alias("__row")), "__row", "left_semi").drop("__row")
