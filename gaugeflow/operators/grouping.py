"""Group-level operators: ordered text aggregates, ranks and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import name, quote
from gaugeflow.functions.numbers import ratio


def ordered_text(
    df: DataFrame, keys: list[str], text: str, separator: str, into: str, count: str, distinct: bool = False,
    few: bool = False,
) -> DataFrame:
    """Per group: its texts in order, joined, and the number of its rows.

    Equal texts of a group are counted first, with a combine before the shuffle; so what is put in
    order per group is its distinct texts, however many rows share a key. With ``few`` the caller states
    that no group has many rows, and one grouping does. Null when a group has no text.
    """
    t, sep = name(text), quote(separator)
    if few:
        only = "DISTINCT " if distinct else ""
        return df.groupBy(*keys).agg(
            F.expr(f"listagg({only}{t}, {sep}) WITHIN GROUP (ORDER BY {t}) AS {name(into)}"),
            F.expr(f"count(*) AS {name(count)}"),
        )
    copies = "1" if distinct else "cast(_n AS int)"
    piece = f"CASE WHEN {t} IS NOT NULL THEN array_join(array_repeat({t}, {copies}), {sep}) END"
    counted = df.groupBy(*keys, text).agg(F.expr("count(*) AS _n"))
    return counted.groupBy(*keys).agg(
        F.expr(f"listagg({piece}, {sep}) WITHIN GROUP (ORDER BY {t}) AS {name(into)}"),
        F.expr(f"sum(_n) AS {name(count)}"),
    )


def rank_and_share(grouped: DataFrame, metric: str, rank: str, share: str, places: int = 1) -> DataFrame:
    """Add ``rank()`` by a count, highest first, and each row's percentage of the total.

    A window over all groups would put them in one task. Rows with the same count share a rank, so
    it is enough to rank the distinct counts: there are fewer than sqrt(2 x total) of them.
    """
    m = name(metric)
    ranks = (
        grouped.groupBy(metric)
        .agg(F.expr("count(*) AS _n"))
        .selectExpr(
            f"{m} AS _metric",
            f"1L + coalesce(sum(_n) OVER (ORDER BY {m} DESC"
            f" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS {name(rank)}",
            f"sum(_n * {m}) OVER () AS _total",
        )
    )
    return grouped.join(ranks, F.expr(f"{m} = _metric")).selectExpr(
        *map(name, grouped.columns), name(rank), f"{ratio(f'100 * {m}', '_total', places)} AS {name(share)}"
    )
