"""Classify raw text rows, split them, and type what is accepted."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeflow import contract as C
from gaugeflow.functions import one_of, quote
from gaugeflow.functions.numbers import NUMBER_CHARACTERS, parse_number, round_to_long
from gaugeflow.functions.text import VISIBLE_ASCII, all_match, is_blank, known_modes, strip
from gaugeflow.functions.times import parse_timestamp
from gaugeflow.operators.dedup import mark_repeats
from gaugeflow.session import materialize
from gaugeflow.sources.arrival import with_arrival


IDENTITY = ["fonte", "maquina_id"]
OTHER_CELLS = ["tipo", *C.SENSORS, "falha", "modo_falha"]


def _parsed(raw: DataFrame) -> DataFrame:
    """Add stripped text (``_s_*``), then the parsed instant and numbers (``_ts``, ``_n_*``).

    The originals stay beside them: a rejected row must show the text as it came. Most rows hold
    plain cells only; two tests per row find them and spare the costly expressions. The identity
    cells have their own test, so that plans on the key alone read no other column.
    """
    tested = raw.selectExpr(
        "*",
        f"{all_match(IDENTITY, VISIBLE_ASCII)} AS _plain_key",
        f"{all_match(OTHER_CELLS, VISIBLE_ASCII)} AS _plain",
        f"{all_match(C.SENSORS, NUMBER_CHARACTERS)} AS _numeric",
    )
    stripped = tested.selectExpr(
        "*",
        f"{strip('timestamp')} AS _s_timestamp",
        *[f"{strip(c, '_plain_key')} AS _s_{c}" for c in IDENTITY],
        *[f"{strip(c, '_plain')} AS _s_{c}" for c in OTHER_CELLS],
    )
    return stripped.selectExpr(
        "*",
        f"{parse_timestamp('_s_timestamp')} AS _ts",
        *[f"{parse_number(f'_s_{c}', '_numeric')} AS _n_{c}" for c in C.SENSORS],
    )


SENSOR_REASONS = ["sensor_nulo", "sensor_nao_numerico", "fora_da_faixa_fisica"]


def _sensor_state(sensor: str) -> str:
    """Position of the first of ``SENSOR_REASONS`` that a sensor shows, or one past the last."""
    text, number, (low, high) = f"_s_{sensor}", f"_n_{sensor}", C.RANGES[sensor]
    return (
        f"CASE WHEN {is_blank(text)} THEN 1 WHEN {number} IS NULL THEN 2"
        f" WHEN {number} NOT BETWEEN {low}D AND {high}D THEN 3 ELSE 4 END"
    )


def first_defect() -> str:
    """The first reason, by priority, for which a row must be rejected by itself; null if none.

    No test is ever null: a missing product type is as invalid as a wrong one. The lowest state
    over all sensors decides among the sensor reasons. (The expression is kept this small on
    purpose: a generated method beyond 8000 bytes of bytecode is never compiled by the JVM.)
    """
    tests = {
        "maquina_ausente": is_blank("_s_maquina_id"),
        "timestamp_invalido": "_ts IS NULL",
        "tipo_invalido": f"NOT {one_of('_s_tipo', C.PRODUCT_TYPES)}",
        "falha_invalida": f"NOT {one_of('_s_falha', ['0', '1'])}",
    }
    by_row = " ".join(f"WHEN {test} THEN '{reason}'" for reason, test in tests.items())
    worst = f"least({', '.join(map(_sensor_state, C.SENSORS))})"
    by_sensor = f"element_at(array({', '.join(map(quote, SENSOR_REASONS))}, NULL), {worst})"
    return f"CASE {by_row} ELSE {by_sensor} END"


#: Beside the text of a classified row: its values as parsed, null if the row has a defect.
TYPED = "lido"


def _typed_values() -> str:
    """The parsed values as one struct, read by column from stored rows, so that no text is parsed twice."""
    values = {
        "fonte": "_s_fonte",
        "maquina_id": "_s_maquina_id",
        "ts": "_ts",
        "tipo_produto": "_s_tipo",
        **{c: round_to_long(f"_n_{c}") if c in C.INTEGER_SENSORS else f"_n_{c}" for c in C.SENSORS},
        "falha": "_s_falha = '1'",
        "modos": f"if(_s_falha = '1', {known_modes('_s_modo_falha')}, NULL)",
    }
    return f"named_struct({', '.join(f'{quote(c)}, {e}' for c, e in values.items())})"


def classify(raw: DataFrame) -> DataFrame:
    """Raw rows as they came, plus ``motivo``: the first reject reason that applies, or null; and the parsed values.

    A repeat is rejected whatever became of the first copy, so repeats are marked over all rows
    that have a machine and a valid instant, before any other reason is looked at. "First" is the
    lowest arrival ordinal; rows without one are numbered here, in the order they are read.
    """
    key = [f"_s_{c}" for c in C.DEDUP_KEY]
    if C.ARRIVAL not in raw.columns:
        raw = materialize(with_arrival(raw), "arrival")  # both uses below must see one numbering
    arrival = f"coalesce({C.ARRIVAL}, raise_error('{C.ARRIVAL} is null')) AS {C.ARRIVAL}"
    rows = _parsed(raw).selectExpr(
        *C.RAW_COLUMNS,
        arrival,
        *key,
        f"{first_defect()} AS _defeito",
        f"{_typed_values()} AS _values",
        f"NOT {is_blank('_s_maquina_id')} AND _ts IS NOT NULL AS _com_chave",
    )
    return mark_repeats(rows, key=key, arrival=C.ARRIVAL, eligible="_com_chave").selectExpr(
        *C.RAW_COLUMNS,
        C.ARRIVAL,
        "CASE WHEN repetida THEN 'duplicada' ELSE _defeito END AS motivo",
        f"if(repetida OR _defeito IS NOT NULL, NULL, _values) AS {TYPED}",
    )


def rejected(classified: DataFrame) -> DataFrame:
    """Rejected rows: the eleven original texts and the reason."""
    return classified.filter("motivo IS NOT NULL").select(*C.RAW_COLUMNS, "motivo")


def readings(classified: DataFrame) -> DataFrame:
    """Accepted rows with their types."""
    return classified.filter("motivo IS NULL").selectExpr(*[f"{TYPED}.{c} AS {c}" for c in C.CLEAN_READINGS.names])


def failures(classified: DataFrame) -> DataFrame:
    """One row per (machine, instant, mode) of the accepted readings that failed."""
    failing = classified.filter(f"motivo IS NULL AND {TYPED}.falha")
    return failing.selectExpr(
        f"{TYPED}.maquina_id AS maquina_id", f"{TYPED}.ts AS ts", f"explode({TYPED}.modos) AS modo"
    ).distinct()
