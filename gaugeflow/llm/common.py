"""What several operators share: table reads, byte words, stored intermediates, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.session import materialize

# The dealt word pattern.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_words(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text; ``bytes.split`` cuts at exactly the white space of WORD_PATTERN."""
    return text.split() if text else []


def word_count(column) -> F.Column:
    """Number of words, null texts as 0, on the JVM."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def with_row_id(df: DataFrame, name: str, label: str) -> DataFrame:
    """The rows stored once with a number each; reading the stored table repeats the numbers."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), label)


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node that has an edge.

    ``edges`` has the 64-bit columns src and dst; direction, repeats and loops do not matter. Nulls are
    ignored. Returns node, root; empty for no edges. Alternates the large-star and small-star steps until the
    edges no longer change. Each step takes a minimum per node, which combines before its shuffle, and joins
    it back, which adaptive execution can split: no task gathers the neighbours of a hub. Every round is
    stored in the shared folder, so a lost executor costs one round at most.
    """
    spark = edges.sparkSession
    clean = edges.select("src", "dst").where("src is not null and dst is not null and src <> dst").distinct()
    current, seen = materialize(clean, "edges"), None
    while True:
        now = _fingerprint(current)
        if now[0] == 0:
            return spark.createDataFrame([], "node bigint, root bigint")
        if now == seen:
            return current.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(
                current.select(F.col("dst").alias("node"), F.col("dst").alias("root"))
            ).distinct()
        seen = now
        current = materialize(_small_star(_large_star(current)), "edges")


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("low"))
    return both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    least = down.groupBy("src").agg(F.min("dst").alias("low"))
    others = down.join(least, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return others.union(least.select("src", F.col("low").alias("dst"))).where("src <> dst").distinct()
