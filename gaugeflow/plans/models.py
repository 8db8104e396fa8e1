"""Staging, enriched and mart models as functions from DataFrames to DataFrames.

Staging and enriched stay lazy, so one plan reaches from the mart down to the scan; only marts are
written, see ``plans.marts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.numbers import celsius
from gaugeflow.operators.grouping import ordered_text
from gaugeflow.contract import FACT_COLUMNS


def stg_maquinas(maquinas: DataFrame) -> DataFrame:
    return maquinas.selectExpr("maquina_id AS id_maquina", "fonte", "criada_em")


def stg_leituras(leituras: DataFrame) -> DataFrame:
    """Readings with standard names and temperatures also in Celsius."""
    return leituras.selectExpr(
        "leitura_id AS id_leitura",
        "maquina_id AS id_maquina",
        "ts AS medido_em",
        "tipo_produto",
        "temp_ar_k AS temperatura_ar_k",
        f"{celsius('temp_ar_k')} AS temperatura_ar_c",
        "temp_processo_k AS temperatura_processo_k",
        f"{celsius('temp_processo_k')} AS temperatura_processo_c",
        "rotacao_rpm",
        "torque_nm",
        "desgaste_min",
        "falha AS houve_falha",
    )


def stg_falhas(falhas: DataFrame, *more: str) -> DataFrame:
    return falhas.selectExpr("falha_id AS id_falha", "leitura_id AS id_leitura", "modo AS modo_falha", *more)


def int_leituras_enriquecidas(leituras: DataFrame, maquinas: DataFrame, falhas: DataFrame) -> DataFrame:
    """One row per staged reading, with its machine's source and its modes as one text.

    Failures are brought down to one row per reading before the join, so a reading with several
    modes is not repeated; it has a handful by contract. The sizes of both joins are left to the optimizer: the machine table is
    broadcast while it is small and shuffled beyond that.
    """
    modes = ordered_text(falhas, ["id_leitura"], "modo_falha", ", ", "modos_falha", "qtd_modos_falha", few=True)
    return (
        leituras.join(maquinas.select("id_maquina", "fonte"), "id_maquina")
        .join(modes, "id_leitura", "left")
        .selectExpr(
            "id_leitura",
            "id_maquina",
            "fonte",
            "medido_em",
            "houve_falha",
            "modos_falha",
            "coalesce(qtd_modos_falha, 0L) AS qtd_modos_falha",
            "tipo_produto",
            "temperatura_ar_c",
            "temperatura_processo_c",
            "rotacao_rpm",
            "torque_nm",
            "desgaste_min",
        )
    )


def dim_maquina(maquinas: DataFrame, leituras: DataFrame) -> DataFrame:
    """One row per machine with its totals; machines without readings have zeros.

    ``leituras`` is the enriched model or the readings fact: both have one row per reading. It should
    be stored: grouped straight after a join on the machine, a hot machine could not be split.
    """
    totals = leituras.groupBy("id_maquina").agg(
        F.expr("count(id_leitura) AS total_leituras"), F.expr("count_if(houve_falha) AS total_falhas")
    )
    return maquinas.join(totals, "id_maquina", "left").selectExpr(
        "id_maquina",
        "fonte",
        "criada_em",
        "coalesce(total_leituras, 0L) AS total_leituras",
        "coalesce(total_falhas, 0L) AS total_falhas",
    )


def fct_leituras(enriquecidas: DataFrame) -> DataFrame:
    return enriquecidas.select(*FACT_COLUMNS)


def fct_falhas_diarias(fato: DataFrame) -> DataFrame:
    """Per machine and day with failures: failing readings and the distinct sets of modes."""
    failing = fato.filter("houve_falha").selectExpr(
        "id_maquina", "cast(medido_em AS date) AS data_ref", "modos_falha"
    )
    return ordered_text(
        failing, ["id_maquina", "data_ref"], "modos_falha", "; ", "modos_falha", "qtd_falhas", distinct=True
    ).select("id_maquina", "data_ref", "qtd_falhas", "modos_falha")
