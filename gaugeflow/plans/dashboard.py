"""Dashboard reads over the marts; aggregation stays in Spark, only small results leave it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.numbers import percent
from gaugeflow.functions.text import listed_modes


def of_sources(dim: DataFrame, fontes: list[str] | None) -> DataFrame:
    """Machines of the given sources; none given means all."""
    return dim.filter(F.col("fonte").isin(list(fontes))) if fontes else dim


def machine_totals(dim: DataFrame, fontes: list[str] | None = None) -> DataFrame:
    return of_sources(dim, fontes).orderBy(F.desc("total_falhas"), "id_maquina")


def daily_with_source(diarias: DataFrame, dim: DataFrame, fontes: list[str] | None = None) -> DataFrame:
    machines = of_sources(dim, fontes).select("id_maquina", "fonte")
    return (
        diarias.join(machines, "id_maquina")
        .select("id_maquina", "fonte", "data_ref", "qtd_falhas", "modos_falha")
        .orderBy("data_ref", "id_maquina")
    )


def reading_sample(
    fato: DataFrame, dim: DataFrame, fontes: list[str] | None = None, limit: int = 200
) -> DataFrame:
    """The newest readings, failures first; ties by id. Only the ``limit`` rows get their source joined."""
    machines = of_sources(dim, fontes).select("id_maquina", "fonte")
    columns = [c for c in fato.columns if c not in ("id_leitura", "id_maquina")]
    order = [F.desc("houve_falha"), F.desc("medido_em"), "id_leitura"]
    newest = fato.join(machines, "id_maquina", "left_semi").orderBy(*order).limit(limit)
    return newest.join(machines, "id_maquina").select("id_leitura", "id_maquina", "fonte", *columns).orderBy(*order)


def kpis(dim: DataFrame) -> DataFrame:
    """One row: machines, readings, failures and the failure rate; zeros when there are none."""
    sums = dim.selectExpr(
        "count(*) AS maquinas",
        "coalesce(sum(total_leituras), 0L) AS leituras",
        "coalesce(sum(total_falhas), 0L) AS falhas",
    )
    return sums.selectExpr("*", f"coalesce({percent('falhas', 'leituras')}, 0D) AS taxa_falha_pct")


def daily_series(diarias: DataFrame) -> DataFrame:
    """Failures per day over all machines."""
    return diarias.groupBy("data_ref").agg(F.expr("sum(qtd_falhas) AS qtd_falhas")).orderBy("data_ref")


def mode_distribution(diarias: DataFrame) -> DataFrame:
    """Machine-days on which each mode appears."""
    return (
        diarias.selectExpr(f"explode({listed_modes('modos_falha')}) AS modo")
        .groupBy("modo")
        .agg(F.expr("count(*) AS ocorrencias"))
        .orderBy(F.desc("ocorrencias"), "modo")
    )
