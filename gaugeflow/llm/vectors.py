"""Near-duplicate vectors: random-hyperplane sign tables, exact cosine, distributed components."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import components
from gaugeflow.session import materialize

THRESHOLD = 0.9
#: Chance that a pair exactly at the threshold meets in at least one table.
RECALL = 0.999
#: Vectors expected in a bucket of unrelated vectors; buckets above twice that are compared block by block.
BUCKET = 256
BLOCK = 512
SEED = 1


def plan_tables(count: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(sign bits, tables): bits follow the number of vectors, tables follow from bits, threshold and recall."""
    bits = max(0, math.ceil(math.log2(max(count, 1) / BUCKET))) if count > BUCKET else 0
    if bits == 0:
        return 0, 1
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


@functools.lru_cache(maxsize=8)
def _planes(dimension: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, max(bits * tables, 1)))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def signatures(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Bucket number of every vector in every table."""
    if bits == 0:
        return np.zeros((len(unit), tables), dtype=np.int64)
    signs = (unit @ _planes(unit.shape[1], bits, tables) >= 0).reshape(len(unit), tables, bits)
    return (signs << np.arange(bits)).sum(axis=2, dtype=np.int64)


def _emit(batches, bits, tables, dtype):
    for batch in batches:
        raw = [v.as_py() for v in batch.column(1)]
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(raw):
            by_size.setdefault(len(v), []).append(i)
        for size, at in by_size.items():
            values = np.array([raw[i] for i in at], dtype=dtype)
            found = signatures(_unit(values), bits, tables)
            nodes = batch.column(0).take(pa.array(at))
            packed = pa.array([v.tobytes() for v in values], pa.binary())
            signed = pa.array([s.tobytes() for s in found], pa.binary())
            copies = batch.column(2).take(pa.array(at))
            for t in range(tables):
                same = [pa.array(np.full(len(at), x), pa.int32()) for x in (size, t)]
                bucket = pa.array(np.ascontiguousarray(found[:, t]), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*same, bucket, nodes, copies, packed, signed],
                    ["size", "table", "bucket", "node", "copies", "vector", "signature"],
                )


def _forest(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """Smallest position reachable from each position over the links a-b."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def compare_block(nodes, copies, unit, signed, block, low, high, table, threshold):
    """node, links, root: for one pair of blocks of a bucket, its links not met in an earlier table."""
    left = np.flatnonzero(block == low)
    right = np.flatnonzero(block == high)
    links = np.zeros(len(nodes), dtype=np.int64)
    near_a, near_b = [], []
    for start in range(0, len(left), BLOCK):
        part = left[start : start + BLOCK]
        i, j = np.nonzero(unit[part] @ unit[right].T >= threshold)
        a, b = part[i], right[j]
        if low == high:
            a, b = a[a < b], b[a < b]
        fresh = np.ones(len(a), dtype=bool)
        for t in range(table):
            fresh &= signed[a, t] != signed[b, t]
        a, b = a[fresh], b[fresh]
        links += np.bincount(a, copies[b], len(nodes)).astype(np.int64) + np.bincount(b, copies[a], len(nodes)).astype(np.int64)
        near_a.append(a)
        near_b.append(b)
    a, b = np.concatenate(near_a or [left[:0]]), np.concatenate(near_b or [left[:0]])
    label = _forest(a, b, len(nodes))
    return links, label


def _compare(key, group: pa.Table, threshold, dtype) -> pa.Table:
    size, table, _, low, high = (k.as_py() for k in key)
    nodes = group.column("node").to_numpy()
    values = np.frombuffer(b"".join(group.column("vector").to_pylist()), dtype=dtype).reshape(len(nodes), size)
    signed = np.frombuffer(b"".join(group.column("signature").to_pylist()), dtype=np.int64).reshape(len(nodes), -1)
    order = np.argsort(nodes, kind="stable")
    nodes, values, signed = nodes[order], values[order], signed[order]
    copies = group.column("copies").to_numpy()[order]
    block = group.column("block").to_numpy()[order]
    links, label = compare_block(nodes, copies, _unit(values), signed, block, low, high, table, threshold)
    told = np.flatnonzero((links > 0) | (label != np.arange(len(nodes))))
    return pa.table({"node": nodes[told], "links": links[told], "root": nodes[label[told]]})


def _valid():
    return F.expr(
        "embedding is not null and size(embedding) > 0"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
        " and exists(embedding, x -> x <> 0)"
    )


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Equal vectors are one node with a number of copies (told apart by 128 bits of hash). Null, empty and zero
    vectors, and those with null or non-finite components, link with nothing; vectors of different length don't
    link. Each node goes to one bucket in each table. A bucket is compared by itself, a large one as pairs of
    blocks of about BLOCK vectors in separate tasks, so a hot bucket is neither gathered nor sent out as pairs. A
    link counts in the first table where its ends meet; a block reports a number of links and one root per vector,
    never its pairs. Nothing is linked below the threshold; a pair at the threshold is found with probability
    ``recall``, a closer one with more. Null ids take no part in the smallest id. Empty tables give no rows.
    """
    double = dict(vectors.dtypes)["embedding"] != "array<float>"
    dtype = "<f8" if double else "<f4"
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>" if double else "array<float>").alias("embedding"),
    ).withColumn("valid", _valid())
    keyed = rows.select("vec_id", "valid", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    counted = rows.where("valid").groupBy(F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    classes = counted.agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")
    ).withColumn("node", F.monotonically_increasing_id())
    classes = materialize(classes, "vectors")
    bits, tables = plan_tables(classes.count(), threshold, recall)
    placed = classes.select("node", "embedding", "copies").mapInArrow(
        lambda batches: _emit(batches, bits, tables, dtype),
        "size int, table int, bucket long, node long, copies long, vector binary, signature binary",
    )
    placed = materialize(placed, "tables")
    crowded = placed.groupBy("size", "table", "bucket").agg(F.count("*").alias("members")).where(F.col("members") > 2 * BUCKET)
    split = placed.join(crowded, ["size", "table", "bucket"], "left").withColumn(
        "blocks", F.coalesce(F.ceil(F.col("members") / BLOCK), F.lit(1)).cast("int")
    )
    split = split.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    pairs = split.select(
        "size", "table", "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "node", "copies", "vector", "signature", "block",
    )
    told = pairs.groupBy("size", "table", "bucket", "low", "high").applyInArrow(
        lambda key, group: _compare(key, group, threshold, dtype), "node long, links long, root long"
    )
    told = materialize(told, "links")
    links = told.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(told.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    whole = classes.drop("embedding").join(links, "node", "left").join(roots, "node", "left").select(
        "h1", "h2", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")
    )
    least = whole.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = whole.join(least, "root").select("h1", "h2", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = keyed.where("valid").join(known, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = keyed.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
