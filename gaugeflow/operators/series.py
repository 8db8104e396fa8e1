"""Row-based windows over time series whose longest series may be a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import name
from gaugeflow.functions.times import epoch_minute

#: A series is cut at weeks. The contract's instants are whole seconds and unique within a machine, so no
#: piece has more than 604 800 rows, however long its series is.
BUCKET_MINUTES = 7 * 24 * 60


def series_window(
    df: DataFrame,
    key: str,
    time: str,
    columns: dict[str, str],
    reach: int,
    bucket_minutes: int = BUCKET_MINUTES,
) -> DataFrame:
    """Add window columns that look at most ``reach`` rows back in the series of ``key``.

    ``columns`` maps a new name to an expression in which ``{over}`` stands for the partitioning and
    ordering, e.g. ``lag(x) OVER ({over})``. (key, time) must be unique. Every series is cut at fixed
    instants, ``bucket_minutes`` apart. Only the first ``reach`` rows of a piece see rows of earlier ones; they are
    windowed again beside the last ``reach`` rows of each piece, so the result does not depend on the cuts. The plan is
    the same for all sizes: nothing is counted first, no task holds a whole series but the few rows at its cuts, and
    rows without a key are cut like any other series.
    """
    k, t = name(key), name(time)
    # Other names below the shuffle: the optimizer then leaves its plan alike in both branches, which read it once.
    below = df.selectExpr(*[f"{name(c)} AS {name('_in_' + c)}" for c in df.columns], f"{epoch_minute(t)} div {bucket_minutes} AS _bucket")
    dealt = below.repartition(F.col(name(f"_in_{key}")), F.col("_bucket"))
    cut = dealt.selectExpr(*[f"{name('_in_' + c)} AS {name(c)}" for c in df.columns], "_bucket")
    of_piece, of_series = f"PARTITION BY {k}, _bucket ORDER BY {t}", f"PARTITION BY {k} ORDER BY {t}"

    def windowed(rows: DataFrame, over: str, *more: str) -> DataFrame:
        return rows.selectExpr("*", *[f"{expr.format(over=over)} AS {name(c)}" for c, expr in columns.items()], *more)

    place = f"row_number() OVER ({of_piece}) AS _place"
    near_end = f"lead({t}, {reach}) OVER ({of_piece}) IS NULL AS _near_end"
    inner = windowed(cut, of_piece, place).filter(f"_place > {reach}")
    # Both branches read the one shuffle of the rows. Before a piece's first rows lie exactly the last ones of the pieces
    # before it, so among these edges alone the windows over a whole series see what they would among all rows.
    edges = cut.selectExpr("*", place, near_end).filter(f"_place <= {reach} OR _near_end")
    heads = windowed(edges, of_series).filter(f"_place <= {reach}").drop("_near_end")
    return inner.unionByName(heads).drop("_bucket", "_place")
