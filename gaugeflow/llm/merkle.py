"""Merkle manifest of a dataset: a hash tree per source and one over the sources, proofs, and their check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.operators.indexing import with_row_index
from gaugeflow.session import materialize

#: Children of a node.
FAN = 16
#: Rows of one source that share a join key while ranks are attached.
BLOCK = 65_536

# The fields of a leaf in order, and the share of tampered documents.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hash(text: str) -> str:
    return f"sha2({text}, 256)"


def leaf_digest(values: dict[str, str]) -> str:
    """SQL for a row's leaf: each field as its size in bytes, a colon and its text, or a dash for null."""
    texts = [f"cast({values[c]} AS string)" for c in FIELDS]
    return _hash(f"concat({', '.join(f'''if({t} IS NULL, '-', concat(octet_length({t}), ':', {t}))''' for t in texts)})")


def with_leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, and as ``claimed`` the leaf of the row as tampered, null where nothing was done to it.

    Tampering puts A-Z of the text in lower case where 5 divides the CRC-32 of the decimal id; a null id is left alone.
    """
    own = {c: f"`{c}`" for c in FIELDS}
    lowered = own | {"text": f"translate(`text`, '{_UPPER}', '{_LOWER}')"}
    hit = f"crc32(cast(cast(doc_id AS string) AS binary)) % {TAMPERED} = 0"
    return docs.selectExpr(
        "cast(doc_id AS bigint) AS doc_id",
        "cast(source AS string) AS source",
        f"{leaf_digest(own)} AS leaf",
        f"if({hit}, {leaf_digest(lowered)}, NULL) AS claimed",
    )


def ranked(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves with ``tree`` (their source's place), ``size`` (its leaves) and ``lo`` (their rank in it); and the sources.

    Leaves of a source ascend by doc_id, nulls first; equal ids are told apart by their leaf, equal leaves can't be.
    Places come from range partitions of all leaves, so no task holds a source; a source's first place is joined back
    in blocks of its leaves, so a hot one doesn't meet on one key either.
    """
    numbered = leaves.withColumn("_tie", F.monotonically_increasing_id())
    placed = with_row_index(numbered, ["source", "doc_id", "leaf", "_tie"], "place").drop("_tie")
    placed = placed.withColumn("block", F.expr(f"place div {BLOCK}"))
    cells = materialize(placed.groupBy("block", "source").agg(F.min("place").alias("first"), F.count("*").alias("n")), "cells")
    held = cells.groupBy("source").agg(F.min("first").alias("start"), F.sum("n").alias("size"))
    sources = materialize(with_row_index(held, ["source"], "tree"), "sources")
    starts = cells.alias("c").join(sources.alias("s"), F.expr("c.source <=> s.source"))
    starts = starts.selectExpr("c.block", "c.source", "s.tree", "s.size", "s.start")
    rows = placed.alias("p").join(starts.alias("c"), F.expr("p.block = c.block AND p.source <=> c.source"))
    return rows.selectExpr("c.tree", "c.size", "p.place - c.start AS lo", "p.doc_id", "p.source", "p.leaf", "p.claimed"), sources


def _joined(children: str) -> str:
    return f"array_join(transform({children}, x -> x.digest), '')"


def grow(members: DataFrame, payload: list[str]) -> list[DataFrame]:
    """The levels of the trees over ``members`` (tree, size, lo, digest and ``payload``), each stored.

    A node is (tree, size, lo, hi, children, digest) and covers the ranks from lo to below hi; its children, with their
    own intervals, are in order. The first level holds the members themselves; a lone member's node has that member's
    digest. A level lists the trees of which the level before has several nodes.
    """
    nodes, width, levels = members.selectExpr("*", "lo + 1 AS hi"), FAN, []
    fields = ["lo", "hi", "digest", *payload]
    while True:
        runs = nodes.groupBy("tree", "size", F.expr(f"lo div {width}").alias("run")).agg(
            F.array_sort(F.collect_list(F.struct(*fields))).alias("children")  # at most FAN
        )
        made = runs.selectExpr(
            "tree", "size", f"run * {width} AS lo", f"least((run + 1) * {width}, size) AS hi", "children",
            f"if(size = 1, children[0].digest, {_hash(_joined('children'))}) AS digest",
        )
        levels.append(materialize(made, f"level-{len(levels) + 1}"))
        if not levels[-1].where(f"size > {width}").limit(1).count():
            return levels
        nodes, fields = levels[-1].where(f"size > {width}").drop("children"), ["lo", "hi", "digest"]
        width *= FAN


def tops(levels: list[DataFrame]) -> DataFrame:
    """tree and digest of every tree's top: the one node that covers all its ranks."""
    whole = [nodes.where("lo = 0 AND hi = size").select("tree", "digest") for nodes in levels]
    found = whole[0]
    for nodes in whole[1:]:
        found = found.unionByName(nodes)
    return found


_STEP = "struct<left: string, right: string>"
_CHILDREN = "array<struct<lo: bigint, hi: bigint, digest: string>>"


def _step(children: str, lo: str, hi: str) -> str:
    """What a node's parent hashes around it: the parent's interval without the node's own, left and right of it."""
    left, right = (_joined(f"filter({children}, s -> {test})") for test in (f"s.hi <= {lo}", f"s.lo >= {hi}"))
    return f"struct({left} AS left, {right} AS right)"


def attach(levels: list[DataFrame], roots: DataFrame, payload: list[str]) -> DataFrame:
    """The members with ``steps``, from their own run up to the top of the tree and then the steps of ``roots``.

    ``roots`` has tree, steps and columns that go along to every member of the tree. From the top level down, each
    node is joined to the node one level up that contains its interval: the key is the tree and the interval's bucket
    at that level. What is carried is one row per node, so the members, which the first level holds, are never
    joined to their ancestors one by one.
    """
    along = [c for c in roots.columns if c not in ("tree", "steps")]
    above = None
    for depth in range(len(levels) - 1, -1, -1):
        nodes, upper = levels[depth], FAN ** (depth + 2)
        # A tree that ends at this level is contained in what is known of it as a whole.
        ending = nodes.where("lo = 0 AND hi = size").select("tree", "size").join(roots, "tree")
        parents = ending.selectExpr("tree", "0L AS lo", "size AS hi", f"CAST(NULL AS {_CHILDREN}) AS children", "steps", *along)
        if above is not None:
            parents = parents.unionByName(above.select(*parents.columns))
        contains = f"n.tree = p.tree AND n.lo div {upper} = p.lo div {upper} AND p.lo <= n.lo AND n.hi <= p.hi"
        step = _step("p.children", "n.lo", "n.hi")
        above = nodes.alias("n").join(parents.alias("p"), F.expr(contains)).selectExpr(
            "n.*", f"if(p.children IS NULL, p.steps, concat(array({step}), p.steps)) AS steps", *[f"p.{c}" for c in along]
        )
    each = above.selectExpr("tree", "size", "children", "steps", *along, "explode(children) AS own")
    own = _step("children", "own.lo", "own.hi")
    return each.selectExpr(
        "tree", "own.digest", *[f"own.{c}" for c in payload], *along,
        f"if(size = 1, steps, concat(array({own}), steps)) AS steps",
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Every row's doc_id, source, leaf, claimed leaf (see with_leaves), subroot, root and ``steps``.

    A leaf hashes the row's five fields. Per source, nodes of a level are hashed sixteen by sixteen until one is left,
    the subroot; subroots in order of their sources, null first, likewise give the root. ``steps`` has one entry per
    hash on the way up, with the digests to the left and to the right of the node. Nulls are values of their own;
    repeated rows are leaves of their own; no rows give none.
    """
    # Stored before they are ordered: range partitions sample their input, which would hash every text twice.
    leaves, sources = ranked(materialize(with_leaves(docs), "leaves"))
    payload = ["doc_id", "source", "claimed"]
    levels = grow(leaves.withColumnRenamed("leaf", "digest"), payload)
    subroots = sources.select("tree").join(tops(levels), "tree").selectExpr("tree AS source_tree", "digest")
    count = sources.count()
    over = subroots.selectExpr("0L AS tree", f"{count}L AS size", "source_tree AS lo", "digest", "source_tree")
    sources_levels = grow(over, ["source_tree"])
    root = tops(sources_levels).selectExpr("tree", f"CAST(array() AS array<{_STEP}>) AS steps", "digest AS root")
    known = attach(sources_levels, root, ["source_tree"])
    known = materialize(known.selectExpr("source_tree AS tree", "digest AS subroot", "root", "steps"), "subroots")
    return attach(levels, known, payload).selectExpr(
        "doc_id", "source", "digest AS leaf", "claimed", "subroot", "root", "steps"
    )


def fold(leaf: str, steps: str = "steps") -> str:
    """SQL for the root that a leaf and its steps give."""
    return f"aggregate({steps}, {leaf}, (own, s) -> {_hash('concat(s.left, own, s.right)')})"


def verify(rows: DataFrame) -> DataFrame:
    """The manifest's rows with a digest of the proof, the root folded from the claimed leaf, and whether it is the root."""
    siblings = "array_join(transform(steps, s -> concat(s.left, s.right)), '')"
    return rows.selectExpr(
        "doc_id", "leaf", "subroot", "root", f"{_hash(siblings)} AS proof_sha256", f"{fold('coalesce(claimed, leaf)')} AS folded_root"
    ).selectExpr("*", "folded_root = root AS verified")
