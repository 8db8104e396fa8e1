"""Keep-first duplicate marking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import name


def mark_repeats(
    df: DataFrame,
    key: list[str],
    arrival: str,
    eligible: str = "true",
    into: str = "repetida",
) -> DataFrame:
    """Add a flag that is true on every row of a key but the one that arrived first.

    Only ``eligible`` rows take part, null key parts are equal to each other, and the ordinal must
    be unique within a key. A ranking window would pull all copies of a key into one task. Here
    the first arrival of each repeated key comes from an aggregate that combines before the
    shuffle, and joining it back is a left join whose big side the adaptive skew join may split.
    """
    # Rows that cannot match are spread by their ordinal instead of meeting on one (null) key.
    rows = df.selectExpr(
        *map(name, df.columns),
        f"CASE WHEN coalesce({eligible}, false) THEN 0L ELSE xxhash64({arrival}) | 1L END AS _probe",
    )
    firsts = (
        rows.filter("_probe = 0")
        .groupBy(*key)
        .agg({"*": "count", arrival: "min", "_probe": "max"})
        .filter("`count(1)` > 1")
        .selectExpr(
            *[f"{name(c)} AS _f{i}" for i, c in enumerate(key)],
            f"`min({arrival})` AS _first",
            "`max(_probe)` AS _zero",
        )
    )
    same = " AND ".join(f"r.{name(c)} <=> f._f{i}" for i, c in enumerate(key))
    return (
        rows.alias("r")
        .join(firsts.alias("f"), F.expr(f"r._probe = f._zero AND {same}"), "left")
        .selectExpr(
            *[f"r.{name(c)}" for c in df.columns],
            f"coalesce(r.{name(arrival)} > f._first, false) AS {name(into)}",
        )
    )
