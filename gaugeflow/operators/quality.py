"""Data-quality checks. Each returns the offending rows: a check passes when it returns none."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import contract as C
from gaugeflow.functions import name, quote
from gaugeflow.operators.merge import repeated, violations


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values (or key combinations) that occur more than once; nulls are left out."""
    return repeated(df, list(columns))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """(coluna, n) for each column that holds nulls; one pass for all of them."""
    counts = violations(df, {c: f"{name(c)} IS NULL" for c in columns})
    return counts.filter("n > 0").withColumnRenamed("regra", "coluna")


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list, with their number of rows; nulls are left out."""
    listed = ", ".join(map(quote, values))
    return (
        df.filter(f"{name(column)} NOT IN ({listed})").groupBy(column).agg(F.expr("count(*) AS n_registros"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values without a parent row, with their number of rows; nulls are left out.

    The child is reduced to its distinct values first, so a hot value is one row in the join.
    """
    held = child.filter(f"{name(column)} IS NOT NULL").groupBy(column).agg(F.expr("count(*) AS n_registros"))
    known = parent.selectExpr(f"{name(field)} AS _field")
    return held.join(known, F.expr(f"{name(column)} = _field"), "left_anti")


def row_parity(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row with both counts when they differ."""
    left = expected.selectExpr("count(*) AS qtd_esperada")
    right = actual.selectExpr("count(*) AS qtd_obtida")
    return left.crossJoin(right).filter("qtd_esperada <> qtd_obtida")  # one row each


def min_volume(df: DataFrame, minimum: int) -> DataFrame:
    """One row when there are fewer rows than the minimum."""
    return df.selectExpr("count(*) AS linhas", f"{minimum}L AS minimo_esperado").filter(
        "linhas < minimo_esperado"
    )


def latest_two(history: DataFrame, order: str, value: str) -> DataFrame:
    """The latest two rows of a history table, numbered from the latest."""
    last = history.selectExpr(f"{name(value)} AS _value", f"{name(order)} AS _order")
    return last.orderBy(F.desc("_order")).limit(2).selectExpr(
        "_value", "row_number() OVER (ORDER BY _order DESC) AS ordem"
    )


def volume_drop(history: DataFrame, max_drop: float = C.MAX_DROP) -> DataFrame:
    """One row when the latest total fell by more than the allowed share; a first load passes."""
    last = latest_two(history, "carga_id", "total_leituras")
    now = last.filter("ordem = 1").selectExpr("_value AS total_atual")
    before = last.filter("ordem = 2").selectExpr("_value AS total_anterior")
    kept = 1 - max_drop
    return before.crossJoin(now).filter(f"total_atual < total_anterior * {kept}D")  # one row each


def freshness(
    history: DataFrame,
    now: dt.datetime,
    warn_hours: int = C.FRESH_WARN_HOURS,
    error_hours: int = C.FRESH_ERROR_HOURS,
) -> DataFrame:
    """One row: last load, age in seconds, and pass, warn or error. No load at all is an error."""
    moment = F.lit(now)
    last = history.agg(F.max("carregado_em").alias("ultima_carga"))
    aged = last.select(
        "ultima_carga",
        (F.unix_seconds(moment.cast("timestamp")) - F.unix_seconds(F.col("ultima_carga").cast("timestamp"))).alias(
            "idade_s"
        ),
    )
    status = (
        f"CASE WHEN idade_s IS NULL OR idade_s > {error_hours * 3600} THEN 'error'"
        f" WHEN idade_s > {warn_hours * 3600} THEN 'warn' ELSE 'pass' END"
    )
    return aged.selectExpr("ultima_carga", "idade_s", f"{status} AS situacao")
