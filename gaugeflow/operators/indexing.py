"""A global row index without a global window, and what is built on it: ids and buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import name
from gaugeflow.session import materialize

# monotonically_increasing_id() keeps the partition above, and the position in it below, bit 33.
_SHIFT, _MASK = 33, 2**33 - 1
#: Widest domain whose histogram one task puts in order.
MAX_DOMAIN = 100_000


def with_row_index(df: DataFrame, order_by: list[str], into: str, total: str | None = None) -> DataFrame:
    """Add the zero-based position of each row in the global order of ``order_by``.

    The columns must be unique together, which also lets range partitioning split any hot value.
    Rows are range-partitioned, sorted inside each partition and written once, so that every later
    use sees the same partitions; only one count per partition is added up in a single place.
    ``total`` optionally names a column for the number of rows.
    """
    keep = list(map(name, df.columns))
    ordered = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .selectExpr("*", "monotonically_increasing_id() AS _seq")
    )
    stored = materialize(ordered, "row-index").selectExpr(
        *keep, f"shiftright(_seq, {_SHIFT}) AS _part", f"_seq & {_MASK}L AS _pos"
    )
    offsets = (
        stored.groupBy("_part")
        .agg(F.expr("count(*) AS _n"))
        .selectExpr(
            "_part",
            "coalesce(sum(_n) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
            " AS _before",
            "sum(_n) OVER () AS _total",
        )
    )
    extra = [] if total is None else [f"_total AS {name(total)}"]
    # One row per shuffle partition, however large the data: safe to broadcast.
    return stored.join(F.broadcast(offsets), "_part").selectExpr(
        *keep, f"_before + _pos AS {name(into)}", *extra
    )


def with_ids(df: DataFrame, order_by: list[str], into: str, after: int = 0) -> DataFrame:
    """Dense surrogate ids, the first one being ``after + 1``, in the order of the natural key."""
    indexed = with_row_index(df, order_by, "_index")
    return indexed.selectExpr(*map(name, df.columns), f"cast(_index + {after + 1} AS bigint) AS {name(into)}")


def bucket_of(index: str, total: str, k: int) -> str:
    """1-based bucket of a zero-based position when ``total`` rows are cut into ``k`` buckets.

    The first ``total mod k`` buckets hold one row more than the others.
    """
    small, big = f"({total} div {k})", f"({total} % {k})"
    edge = f"({big} * ({small} + 1))"
    return (
        f"cast(1 + CASE WHEN {index} < {edge} THEN {index} div ({small} + 1)"
        f" ELSE {big} + ({index} - {edge}) div greatest({small}, 1L) END AS bigint)"
    )


def with_ntile(df: DataFrame, order_by: list[str], k: int, into: str) -> DataFrame:
    """Add the ``ntile(k)`` bucket of each row in a global order that is unique."""
    indexed = with_row_index(df, order_by, "_index", total="_rows")
    return indexed.selectExpr(*map(name, df.columns), f"{bucket_of('_index', '_rows', k)} AS {name(into)}")


def ntile_summary(
    df: DataFrame, value: str, flag: str, tiebreak: list[str], k: int, domain: tuple[float, float]
) -> DataFrame:
    """Per ``ntile(k)`` bucket of ``value``: lowest and highest value, rows, rows with ``flag``.

    ``value`` is a column of whole numbers within ``domain`` (tool wear: 0 to 1000 by contract), so its
    histogram is small and tells the buckets of nearly all rows without sorting them. Only the at
    most ``k - 1`` values cut by a bucket boundary need their rows ordered. Other types, and values
    outside the domain, are errors; ``with_ntile`` takes any column.
    """
    v, (low, high) = name(value), domain
    if dict(df.dtypes)[value] not in ("tinyint", "smallint", "int", "bigint") or high - low > MAX_DOMAIN:
        raise ValueError(f"{value} is not a column of whole numbers with a small domain")
    checked = f"if({v} NOT BETWEEN {low} AND {high}, raise_error('{value} outside its domain'), {v})"
    rows = df.selectExpr(f"{checked} AS _v", f"coalesce({flag}, false) AS _hit", *map(name, tiebreak))
    histogram = rows.groupBy("_v").agg(F.expr("count(*) AS _n"), F.expr("count_if(_hit) AS _hits"))
    placed = histogram.selectExpr(
        "*",
        "coalesce(sum(_n) OVER (ORDER BY _v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _start",
        "sum(_n) OVER () AS _rows",
    ).selectExpr(
        "*",
        f"{bucket_of('_start', '_rows', k)} AS _bucket",
        f"{bucket_of('(_start + _n - 1)', '_rows', k)} AS _last",
    )
    whole = placed.filter("_bucket = _last").select("_bucket", "_v", "_n", "_hits")

    cut = placed.filter("_bucket < _last").selectExpr(
        "_v AS _cut",
        "_start",
        "_rows",
        "coalesce(sum(_n) OVER (ORDER BY _v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _skip",
    )
    # At most k - 1 values are cut, whatever the data: safe to broadcast.
    split_rows = rows.join(F.broadcast(cut), F.expr("_v = _cut")).drop("_cut")
    split = (
        with_row_index(split_rows, ["_v", *tiebreak], "_index")
        .selectExpr("_v", "_hit", f"{bucket_of('(_start + _index - _skip)', '_rows', k)} AS _bucket")
        .groupBy("_bucket", "_v")
        .agg(F.expr("count(*) AS _n"), F.expr("count_if(_hit) AS _hits"))
    )
    return (
        whole.unionByName(split)
        .groupBy("_bucket")
        .agg(
            F.expr("min(_v) AS menor"),
            F.expr("max(_v) AS maior"),
            F.expr("sum(_n) AS linhas"),
            F.expr("sum(_hits) AS com_marca"),
        )
        .withColumnRenamed("_bucket", "faixa")
    )
