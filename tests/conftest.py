from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gaugeflow import contract as C  # noqa: E402
from gaugeflow.session import local_session  # noqa: E402

DEFAULT = {
    "fonte": "simulado",
    "maquina_id": "P-7",
    "timestamp": "2031-05-20 06:30:00",
    "tipo": "M",
    "temp_ar_k": "296.4",
    "temp_processo_k": "307.9",
    "rotacao_rpm": "1720",
    "torque_nm": "33.5",
    "desgaste_min": "84",
    "falha": "0",
    "modo_falha": None,
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, partitions=4, **{"spark.checkpoint.dir": str(shared)})
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw frame from changes to one default row; arrival follows the argument order."""

    def build(*changes: dict):
        rows = [
            tuple({**DEFAULT, **change}[c] for c in C.RAW_COLUMNS) + (i,)
            for i, change in enumerate(changes)
        ]
        return spark.createDataFrame(rows, C.RAW_SCHEMA)

    return build


#: Rows that must be rejected, by reason; every one is on a machine of its own unless the defect says otherwise.
DEFECTS = {
    "duplicada": [{"torque_nm": "90.25"}, {"falha": "?"}],
    "maquina_ausente": [{"maquina_id": "\t"}, {"maquina_id": ""}, {"maquina_id": None, "torque_nm": None}],
    "timestamp_invalido": [{"timestamp": "2031-13-01 00:00:00"}, {"timestamp": None}],
    "tipo_invalido": [{"tipo": "l"}],
    "falha_invalida": [{"falha": "2"}, {"falha": None}],
    "sensor_nulo": [{"desgaste_min": " "}, {"temp_ar_k": None, "rotacao_rpm": "rápida"}],
    "sensor_nao_numerico": [{"temp_processo_k": "31,5"}],
    "fora_da_faixa_fisica": [{"desgaste_min": "1001"}, {"temp_ar_k": "249.99"}, {"torque_nm": "-0.1"}, {"rotacao_rpm": "1e6"}],
}


@pytest.fixture
def mixed(raw):
    """Four valid rows, two of them failing with three modes together, and the rows of DEFECTS."""
    good = [
        {},
        {"maquina_id": "P-8", "falha": "1", "modo_falha": "OSF|RNF"},
        {"maquina_id": "P-8", "timestamp": "2031-05-21 23:59:59"},
        {"maquina_id": "P-9", "falha": "1", "modo_falha": "nenhum"},
    ]
    bad = [
        row if "maquina_id" in row or reason == "duplicada" else {"maquina_id": f"R-{reason}-{i}", **row}
        for reason, rows in DEFECTS.items()
        for i, row in enumerate(rows)
    ]
    return raw(*good, *bad)
