"""Failure labels from physical rules, for any readings table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeflow import contract as C
from gaugeflow.functions import quote
from gaugeflow.functions.numbers import power_watts


def overstrain_limit(tipo: str) -> str:
    """The limit of wear times torque for a product type; null for unknown types."""
    cases = " ".join(f"WHEN {quote(t)} THEN {limit}" for t, limit in C.OSF_LIMITS.items())
    return f"CASE {tipo} {cases} END"


def label_rules() -> dict[str, str]:
    power = power_watts("torque_nm", "rotacao_rpm")
    return {
        "HDF": f"temp_processo_k - temp_ar_k < {C.HDF_MAX_DELTA_K}D AND rotacao_rpm < {C.HDF_MAX_RPM}",
        "PWF": f"{power} NOT BETWEEN {C.PWF_MIN_W} AND {C.PWF_MAX_W}",
        "OSF": f"desgaste_min * torque_nm > {overstrain_limit('tipo_produto')}",
    }


def label_readings(leituras: DataFrame) -> DataFrame:
    """Add the modes that fire, as pipe-separated text (null when none), and whether any does."""
    fired = ", ".join(f"CASE WHEN {test} THEN '{mode}' END" for mode, test in label_rules().items())
    labelled = leituras.drop("modo_falha", "falha").selectExpr(
        "*", f"nullif(concat_ws('|', {fired}), '') AS modo_falha"
    )
    return labelled.selectExpr("*", "modo_falha IS NOT NULL AS falha")
