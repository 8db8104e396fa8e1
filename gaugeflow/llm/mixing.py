"""Mixing overlapping sources to target weights by min-cost flow over membership patterns."""

from __future__ import annotations

from collections import deque
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeflow.llm.common import word_count
from gaugeflow.session import materialize

#: The flow is solved on the driver; more membership patterns than this are refused, not cut.
MAX_PATTERNS = 20_000
#: Bits of the seeded hash that one histogram level resolves.
LEVEL_BITS = 12


def share_out(sizes: dict, weights: dict, total, ceiling: int) -> dict:
    """Targets in proportion to weights, none above ``ceiling`` times its source's size; exact fractions.

    What a source cannot take is shared again by weight among the others, until none is above its limit.
    """
    targets, free, left = {}, {k for k in sizes}, Fraction(total)
    while free:
        weight = sum(Fraction(weights[k]) for k in free)
        full = {k for k in free if left * Fraction(weights[k]) > weight * ceiling * sizes[k]}
        if not full:
            return targets | {k: left * Fraction(weights[k]) / weight for k in free}
        for k in full:
            targets[k] = Fraction(ceiling * sizes[k])
            left -= targets[k]
        free -= full
    return targets


def route(capacity: dict, members: dict, quota: dict, repeats: int) -> dict:
    """Words each pattern gives: min-cost flow from patterns to source quotas.

    A pattern offers its words once at no cost, a second time at cost 1, a third time at cost 2, and so on. As
    only these arcs cost anything, successive shortest paths open one layer after the other and augment within it.
    Returns pattern -> {source: words}.
    """
    flow = {p: dict.fromkeys(members[p], 0) for p in capacity}
    left, holders = dict(quota), {}
    for p, sources in members.items():
        for s in sources:
            holders.setdefault(s, []).append(p)
    for _ in range(repeats):
        supply = dict(capacity)
        for p in capacity:
            while supply[p] and (path := _path(p, members, holders, flow, left)):
                amount = min(supply[p], left[path[-1]], *(flow[b][a] for a, b in zip(path[1:-1:2], path[2:-1:2])))
                supply[p] -= amount
                left[path[-1]] -= amount
                for a, b in zip(path[::2], path[1::2]):
                    flow[a][b] += amount
                for a, b in zip(path[1:-1:2], path[2:-1:2]):
                    flow[b][a] -= amount
    return flow


def _path(start, members, holders, flow, left):
    """Shortest residual path pattern, source, pattern, source ... ending at a source with quota left."""
    queue, seen_patterns, before = deque([start]), {start}, {}
    while queue:
        p = queue.popleft()
        for s in members[p]:
            if ("s", s) in before:
                continue
            before["s", s] = p
            if left.get(s, 0) > 0:
                path, at = [s], p
                while True:
                    path.append(at)
                    if at == start and ("p", at) not in before:
                        return path[::-1]
                    s = before["p", at]
                    path.append(s)
                    at = before["s", s]
            for q in holders[s]:
                if q not in seen_patterns and flow[q][s] > 0:
                    seen_patterns.add(q)
                    before["p", q] = s
                    queue.append(q)
    return None


def mix(rows: DataFrame, quotas_of, repeats: int = 2, seed: int = 7) -> DataFrame:
    """``rows`` (doc_id, size, members: sorted array of sources) with taken: words of the mix, repeats counted.

    ``quotas_of`` maps {pattern: words} to {source: words wanted}. Every document of a pattern is taken as
    often as its flow covers all of them; for the rest a seeded choice of documents is taken once more, in the
    order of a hash, up to the words the flow still has. Rows without members or of size 0 are taken 0 words.
    """
    spark = rows.sparkSession
    sums = rows.groupBy("members").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    capacity = {tuple(r.members): r.size for r in sums if r.size and r.members}
    quota = {s: int(round(q)) for s, q in quotas_of(capacity).items()}
    flow = route(capacity, {p: p for p in capacity}, quota, repeats)
    cuts = [
        (list(p), *divmod(sum(flow[p].values()), capacity[p]))
        for p in sorted(capacity, key=lambda p: [(x is None, x or "") for x in p])
    ]
    cut = spark.createDataFrame(cuts, "pattern array<string>, times long, rest long")
    drawn = rows.join(F.broadcast(cut), F.col("members").eqNullSafe(F.col("pattern")), "left").select(
        *rows.columns, F.coalesce("times", F.lit(0)).alias("times"), F.coalesce("rest", F.lit(0)).alias("rest"),
        F.xxhash64("doc_id", "size", F.lit(seed)).alias("draw"),
    )
    return _choose(drawn).select(*rows.columns, (F.col("size") * (F.col("times") + F.col("more").cast("long"))).alias("taken"))


def _cell(level: int):
    return F.shiftrightunsigned("draw", 64 - LEVEL_BITS * (level + 1)).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))


def _edge(counted: DataFrame, keys: list[str]) -> DataFrame:
    """The cell of each pattern in which the running sum of words reaches its room, and the room left there."""
    running = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    return before.where("before < room and before + words >= room").withColumn("room", F.col("room") - F.col("before"))


def _choose(drawn: DataFrame) -> DataFrame:
    """Adds ``more``: whether the row is among the first of its pattern, by hash, that fill ``rest`` words.

    Two histograms of hash cells find the cell where the limit falls; only that cell's rows are put in order.
    """
    at = drawn.withColumn("cell", _cell(0)).withColumn("inner", _cell(1))
    coarse = at.where("rest > 0").groupBy("members", "cell").agg(F.sum("size").alias("words"), F.first("rest").alias("room"))
    coarse = _edge(coarse, ["members"]).select(F.col("members").alias("m"), F.col("cell").alias("c"), "room")
    coarse = materialize(coarse, "cut")  # one row a pattern, as is the next
    here = F.col("members").eqNullSafe(F.col("m")) & (F.col("cell") == F.col("c"))
    fine = at.join(F.broadcast(coarse), here).groupBy("m", "c", "room", F.col("inner").alias("cell")).agg(F.sum("size").alias("words"))
    fine = _edge(fine, ["m", "c"]).select("m", "c", F.col("cell").alias("i"), "room")
    fine = materialize(fine, "cut")
    placed = at.join(F.broadcast(fine), F.col("members").eqNullSafe(F.col("m")), "left")
    on_edge = F.coalesce((F.col("cell") == F.col("c")) & (F.col("inner") == F.col("i")), F.lit(False))
    below = F.coalesce(F.struct("cell", "inner") < F.struct(F.col("c").alias("cell"), F.col("i").alias("inner")), F.lit(False))
    order = Window.partitionBy("members", "cell", "inner").orderBy("draw", "doc_id", "size")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = placed.where(on_edge).withColumn("sum", F.sum("size").over(order))
    # the document on the limit is taken if at least half of it fits
    last = last.withColumn("more", 2 * F.col("sum") - F.col("size") <= 2 * F.col("room")).drop("sum")
    return placed.where(~on_edge).withColumn("more", below).unionByName(last)


#: The dealt mix: weights by position in code point order, share of all words, most repeats.
WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
CEILING = 2


def dealt_targets(sizes: dict) -> dict:
    """source -> target for {source: words}; code point order, null last."""
    named = sorted(sizes, key=lambda s: (s is None, [] if s is None else [ord(c) for c in s]))
    weights = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(named)}
    return share_out(sizes, weights, SHARE * sum(sizes.values()), CEILING)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size of each row, stored once."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count("text").alias("size"))
    return materialize(found, "sizes")


def _mixed(rows: DataFrame, seed: int) -> tuple[DataFrame, list]:
    per_source = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(per_source) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sources")
    sizes = {r.source: int(r.size or 0) for r in per_source}
    targets = dealt_targets(sizes)
    taken = mix(rows.withColumn("members", F.array("source")), lambda _: targets, CEILING, seed)
    return taken, [(s, sizes[s], float(targets[s])) for s in sizes]


def mix_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row.

    A null source is a source of its own; null and empty texts have size 0 and are taken 0 words. Repeated
    rows are rows of their own. Documents are taken whole, 0, 1 or 2 times. An empty table gives no rows.
    """
    taken, sources = _mixed(sized(docs), seed)
    spark = docs.sparkSession
    known = spark.createDataFrame(sources, "source string, source_size long, target double")
    return taken.join(F.broadcast(known), taken["source"].eqNullSafe(known["source"]), "left").select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def mixture(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; columns unchanged. Wordless rows carry no words and go."""
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    sizes = rows.select(F.col("__row").alias("doc_id"), "source", word_count("text").alias("size"))
    taken, _ = _mixed(materialize(sizes, "sizes"), seed)
    times = taken.where("taken > 0").select(
        F.col("doc_id").alias("__row"), F.expr("explode(sequence(1, int(taken div greatest(size, 1))))").alias("__time")
    )
    return rows.join(times, "__row").drop("__row", "__time")
