"""The analytical queries, over loaded readings, machines and failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import contract as C
from gaugeflow.functions import name, quote
from gaugeflow.functions.numbers import exact, percent
from gaugeflow.functions.times import epoch_micros
from gaugeflow.operators.grouping import rank_and_share
from gaugeflow.operators.indexing import ntile_summary
from gaugeflow.operators.series import BUCKET_MINUTES, series_window


def _of_prefix(df: DataFrame, prefix: str | None) -> DataFrame:
    return df if prefix is None else df.filter(F.startswith("maquina_id", F.lit(prefix)))


def failure_rate(leituras: DataFrame, maquinas: DataFrame) -> DataFrame:
    """Failure rate by source and product type.

    Readings are counted per machine before the join, so what is joined is one row per machine and
    type, however unevenly readings are spread over machines.
    """
    per_machine = leituras.groupBy("maquina_id", "tipo_produto").agg(
        F.expr("count(*) AS n"), F.expr("count_if(falha) AS f")
    )
    return (
        per_machine.join(maquinas.select("maquina_id", "fonte"), "maquina_id")
        .groupBy("fonte", "tipo_produto")
        .agg(F.expr("sum(n) AS leituras"), F.expr("sum(f) AS falhas"))
        .selectExpr("*", f"{percent('falhas', 'leituras')} AS taxa_falha_pct")
        .orderBy("fonte", "tipo_produto")
    )


def machine_ranking(leituras: DataFrame) -> DataFrame:
    """Machines by number of failures, with their rate, rank and share of all failures."""
    per_machine = (
        leituras.groupBy("maquina_id")
        .agg(F.expr("count(*) AS leituras"), F.expr("count_if(falha) AS falhas"))
        .selectExpr("*", f"{percent('falhas', 'leituras')} AS taxa_falha_pct")
    )
    return rank_and_share(per_machine, "falhas", "posicao", "pct_das_falhas_totais").orderBy(
        "posicao", "maquina_id"
    )


def moving_average(
    leituras: DataFrame,
    value: str = "temp_processo_k",
    rows: int = 12,
    bucket_minutes: int = BUCKET_MINUTES,
) -> DataFrame:
    """For every reading, the mean of its machine's last ``rows`` readings, itself included.

    Summed as decimals: the mean is exact before it is rounded to two places, half away from zero.
    """
    frame = f"OVER ({{over}} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    # A column before the cut: both branches of the series then read one shuffle.
    series = leituras.selectExpr("maquina_id", "ts", name(value), f"{exact(name(value))} AS _exact")
    mean = {"_mean": f"avg(_exact) {frame}"}
    averaged = series_window(series, "maquina_id", "ts", mean, rows - 1, bucket_minutes)
    return averaged.selectExpr("maquina_id", "ts", name(value), "cast(round(_mean, 2) AS double) AS media_movel")


def first_moving_averages(
    leituras: DataFrame, machine: str, value: str = "temp_processo_k", rows: int = 12, k: int = 50
) -> DataFrame:
    """The first ``k`` readings of one machine with their moving average.

    The average only looks back, so the first ``k`` rows are all it needs: the top-k comes first.
    """
    head = leituras.filter(f"maquina_id = {quote(machine)}").orderBy("ts").limit(k)
    return moving_average(head, value, rows).orderBy("ts")


def jumps(
    leituras: DataFrame,
    prefix: str | None = None,
    value: str = "torque_nm",
    threshold: float = 25,
    k: int = 20,
    bucket_minutes: int = BUCKET_MINUTES,
) -> DataFrame:
    """The ``k`` largest changes from one reading to the next that exceed the threshold."""
    v = name(value)
    series = _of_prefix(leituras, prefix).selectExpr("maquina_id", "ts", v)
    # Subtracted as decimal: the threshold and the order must not hang on a double's last bit.
    previous = {"_previous": f"lag({v}) OVER ({{over}})"}
    changed = series_window(series, "maquina_id", "ts", previous, 1, bucket_minutes).selectExpr(
        "maquina_id", "ts", v, f"{exact(v)} - {exact('_previous')} AS _delta"
    )
    return (
        changed.filter(f"abs(_delta) > {threshold}")
        .orderBy(F.expr("abs(_delta)").desc(), "maquina_id", "ts")
        .limit(k)
        .selectExpr("maquina_id", "ts", v, "cast(round(_delta, 1) AS decimal(28,1)) AS delta")
    )


def mode_ranking(falhas: DataFrame, leituras: DataFrame) -> DataFrame:
    """Failure modes of each machine by frequency, with their position inside the machine."""
    counted = (
        falhas.select("leitura_id", "modo")
        .join(leituras.select("leitura_id", "maquina_id"), "leitura_id")
        .groupBy("maquina_id", "modo")
        .agg(F.expr("count(*) AS ocorrencias"))
    )
    # One row per machine and mode: a machine's window is as long as the list of modes.
    position = "row_number() OVER (PARTITION BY maquina_id ORDER BY ocorrencias DESC, modo)"
    return counted.selectExpr("*", f"cast({position} AS bigint) AS posicao_na_maquina").orderBy(
        "maquina_id", "posicao_na_maquina"
    )


def time_between_failures(leituras: DataFrame, bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Per machine with at least two failures: gaps, their mean and the shortest, in seconds."""
    failing = leituras.filter("falha").selectExpr("maquina_id", "ts", f"{epoch_micros('ts')} AS _us")
    previous = {"_previous": "lag(_us) OVER ({over})"}
    gaps = series_window(failing, "maquina_id", "ts", previous, 1, bucket_minutes)
    return (
        gaps.groupBy("maquina_id")
        .agg(
            F.expr("count(_previous) AS intervalos"),
            F.expr("cast(sum(_us - _previous) AS double) / count(_previous) / 1e6D AS tempo_medio_s"),
            F.expr("min(_us - _previous) / 1e6D AS menor_intervalo_s"),
        )
        .filter("intervalos > 0")
        .orderBy("tempo_medio_s", "maquina_id")
    )


def wear_quantiles(
    leituras: DataFrame, value: str = "desgaste_min", tiebreak: tuple[str, ...] = ("maquina_id", "ts"), k: int = 4
) -> DataFrame:
    """Failure rate by quantile of tool wear, or of another whole-numbered sensor."""
    return (
        ntile_summary(leituras, value, "falha", list(tiebreak), k, C.RANGES[value])
        .selectExpr(
            "faixa AS quartil_desgaste",
            "menor AS desgaste_min_do_quartil",
            "maior AS desgaste_max_do_quartil",
            "linhas AS leituras",
            f"{percent('com_marca', 'linhas')} AS taxa_falha_pct",
        )
        .orderBy("quartil_desgaste")
    )


def daily_failures(leituras: DataFrame, prefix: str | None = None) -> DataFrame:
    """Failures per day and their running total."""
    daily = (
        _of_prefix(leituras, prefix)
        .groupBy(F.expr("cast(ts AS date) AS dia"))
        .agg(F.expr("count_if(falha) AS falhas"))
    )
    # One row per calendar day: small enough for a single task at any volume of readings.
    return daily.selectExpr(
        "*", "sum(falhas) OVER (ORDER BY dia ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS falhas_acumuladas"
    ).orderBy("dia")


def totals_by_source(fato: DataFrame, dim: DataFrame) -> DataFrame:
    """Readings and failures per source, from the marts."""
    per_machine = fato.groupBy("id_maquina").agg(F.expr("count(*) AS n"), F.expr("count_if(houve_falha) AS f"))
    return (
        per_machine.join(dim.select("id_maquina", "fonte"), "id_maquina")
        .groupBy("fonte")
        .agg(F.expr("sum(n) AS leituras"), F.expr("sum(f) AS falhas"))
    )


def daily_totals(diarias: DataFrame) -> DataFrame:
    """Machine-days with failures and the failing readings in them."""
    return diarias.selectExpr("count(*) AS n_dias_maquina", "coalesce(sum(qtd_falhas), 0L) AS soma_falhas")


def several_modes(enriquecidas: DataFrame) -> DataFrame:
    """Readings with more than one failure mode."""
    return enriquecidas.filter("qtd_modos_falha > 1").select("id_leitura", "modos_falha", "qtd_modos_falha")
