"""URL rules through a cascade of Bloom filters that is exact over the corpus's keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.session import materialize

#: Bits and hash functions for an encoded key.
BITS_PER_KEY = 12
HASHES = 4
#: A level is one value that every task holds: 16 million keys take 24 MB. Longer lists are refused.
MAX_KEYS = 16_000_000
#: Shapes (labels in the host, characters in the path) that listed keys may have.
MAX_SHAPES = 256

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The dealt rules.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _key_of(shape: tuple[int, int]) -> Column:
    """The candidate key of a shape, null where host or path is too short."""
    labels, chars = shape
    suffix = F.substring_index("host", ".", -labels)
    fits = (F.size(F.split("host", r"\.")) >= labels) & (F.length("path") >= chars) & (F.col("host") != "")
    return F.when(fits, F.concat(suffix, F.substring(F.col("path"), 1, chars)))


def _bits(level: int, key: Column, width: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level), F.lit(j), key), F.lit(width)) for j in range(HASHES)]


def _encode(keys: DataFrame, level: int, count: int) -> tuple[DataFrame, int]:
    """One row holding the filter of the keys as 64-bit words, and its width in bits."""
    words = max(1, -(-count * BITS_PER_KEY // 64))
    width = 64 * words
    set_bits = keys.select(F.explode(F.array(*_bits(level, F.col("key"), width))).alias("bit"))
    found = set_bits.groupBy(F.expr("bit div 64").alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("word")
    )
    dense = keys.sparkSession.range(words).join(found, "id", "left").select("id", F.coalesce("word", F.lit(0)).alias("word"))
    one = dense.agg(F.array_sort(F.collect_list(F.struct("id", "word"))).alias("pairs")).select(
        F.col("pairs.word").alias("words")
    )
    return materialize(one, f"level{level}"), width


def _passes(level: int, filtered: DataFrame, width: int, key: Column) -> Column:
    words, passed = filtered.scalar(), F.lit(True)
    for bit in _bits(level, key, width):
        word = F.get(words, F.floor(bit / 64).cast("int"))
        passed = passed & (
            F.call_function("shiftrightunsigned", word, F.pmod(bit, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1
        )
    return passed


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe``; both have a column key.

    Level 1 encodes the listed keys, level 2 those other keys of the universe that pass level 1, level 3 the
    listed keys that pass level 2, and so on until nothing passes wrongly. A key is listed if the number of
    levels it passes in a row is odd. Applying the cascade is an expression on rows, without a join.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame, salt: int = 0):
        self.levels: list[tuple[int, DataFrame, int]] = []
        inside = materialize(listed.select("key").where("key is not null").distinct(), "listed")
        others = universe.select("key").where("key is not null").distinct().join(inside, "key", "left_anti")
        encode, against = inside, materialize(others, "universe")
        while (count := encode.count()) > 0:
            if count > MAX_KEYS:
                raise ValueError(f"a level would hold {count} keys, more than {MAX_KEYS}")
            number = salt + len(self.levels)
            level = (number, *_encode(encode, number, count))
            self.levels.append(level)
            wrong = materialize(against.where(_passes(*level, F.col("key"))), f"passing{number}")
            encode, against = wrong, encode

    def holds(self, key: Column) -> Column:
        """Whether the key is listed; false for null keys."""
        found = F.lit(len(self.levels) % 2 == 1)
        for depth, level in reversed(list(enumerate(self.levels))):
            found = F.when(_passes(*level, key), found).otherwise(F.lit(depth % 2 == 1))
        return F.coalesce(key.isNotNull() & found, F.lit(False))


def rules_frame(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame(RULES if rules is None else rules, "host string, path string, verdict string")


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every row.

    ``rules`` (host, path, verdict allow or block) is the list. A page's candidate keys are its host's last
    labels joined with its path's first characters, in the shapes that listed keys have, so a rule fits its host
    and all subdomains, and paths that start with its own. The longest fitting key wins; where the same key is
    listed twice, block does. Where no rule fits, the cascade says that no key of the page is listed: rule null,
    verdict allow. Null urls and those without ``://`` have an empty host and path and fit no rule. Repeated
    rows are judged each; an empty table gives no rows. Runs on DataFrame functions alone.
    """
    listed = rules.select(F.concat("host", "path").alias("key"), "verdict", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"))
    shapes = sorted(tuple(r) for r in listed.select("labels", "chars").distinct().limit(MAX_SHAPES + 1).collect())
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"listed keys have more than {MAX_SHAPES} shapes")
    host, path = host_and_path(F.col("url").cast("string"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    candidates = split.select(F.explode(F.array(*[_key_of(s) for s in shapes])).alias("key")) if shapes else None
    universe = (candidates if shapes else listed).select("key").where("key is not null").distinct()
    universe = materialize(universe, "keys")
    block = Cascade(listed.where("verdict = 'block'"), universe, salt=0)
    allow = Cascade(listed.where("verdict = 'allow'"), universe, salt=100)
    fitting = []
    for i, shape in enumerate(shapes):
        split = split.withColumn(f"__key{i}", _key_of(shape))
        key = F.col(f"__key{i}")
        verdict = F.when(block.holds(key), "block").when(allow.holds(key), "allow")
        fitting.append(F.when(verdict.isNotNull(), F.struct(F.length(key).alias("n"), key.alias("rule"), verdict.alias("verdict"))))
    if not fitting:
        return split.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    best = F.array_max(F.array(*fitting))
    return split.withColumn("__best", best).select(
        "page_id", "host", "path", F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit("allow")).alias("verdict")
    )
