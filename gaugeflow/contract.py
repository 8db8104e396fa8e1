"""The data contract: schemas, domains, ranges, keys and thresholds.

Every stage (cleaning masks, load checks, quality checks) derives from this one module, so a
range or a domain can never differ between the place that cleans and the place that enforces.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values ---------------------------------------------------------------------------
# These must equal the established data contract; they are stated here and nowhere else.

SENSORS = ["temp_ar_k", "temp_processo_k", "rotacao_rpm", "torque_nm", "desgaste_min"]

RAW_COLUMNS = ["fonte", "maquina_id", "timestamp", "tipo", *SENSORS, "falha", "modo_falha"]

FAILURE_MODES = ["TWF", "HDF", "PWF", "OSF", "RNF"]
UNKNOWN_MODE = "DESCONHECIDO"
PRODUCT_TYPES = ["L", "M", "H"]
VALID_SOURCES = ["ai4i", "simulado"]

# Inclusive physical ranges.
RANGES = {
    "temp_ar_k": (250.0, 350.0),
    "temp_processo_k": (250.0, 400.0),
    "rotacao_rpm": (0.0, 10000.0),
    "torque_nm": (0.0, 200.0),
    "desgaste_min": (0.0, 1000.0),
}

# Reject reasons; a rejected row gets the first one that applies.
REASONS = [
    "duplicada",
    "maquina_ausente",
    "timestamp_invalido",
    "tipo_invalido",
    "falha_invalida",
    "sensor_nulo",
    "sensor_nao_numerico",
    "fora_da_faixa_fisica",
]

DEDUP_KEY = ["fonte", "maquina_id", "timestamp"]
NATURAL_KEY = ["maquina_id", "ts"]
NO_DATE = "sem_data"
NO_MACHINE = "sem_maquina"

# The public AI4I file has neither machine nor time: row numbers rotate over virtual machines.
AI4I_MACHINES = 10
AI4I_START = "2020-01-01 00:00:00"
AI4I_STEP_MINUTES = 10
AI4I_COLUMNS = {
    "tipo": "Type",
    "temp_ar_k": "Air temperature [K]",
    "temp_processo_k": "Process temperature [K]",
    "rotacao_rpm": "Rotational speed [rpm]",
    "torque_nm": "Torque [Nm]",
    "desgaste_min": "Tool wear [min]",
    "falha": "Machine failure",
}

# Rule labels: heat dissipation, power and overstrain limits.
HDF_MAX_DELTA_K = 8.6
HDF_MAX_RPM = 1380
PWF_MIN_W = 3500
PWF_MAX_W = 9000
OSF_LIMITS = {"L": 11000, "M": 12000, "H": 13000}

# Freshness and volume thresholds.
FRESH_WARN_HOURS = 24
FRESH_ERROR_HOURS = 48
MIN_READINGS = 24000
MIN_DAILY_ROWS = 1
MAX_DROP = 0.1

# Cells read as null from CSV: the default missing-value tokens of pandas.read_csv.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- Schemas --------------------------------------------------------------------------------

ARRIVAL = "chegada"  # arrival ordinal we add to raw rows: DataFrames have no row order
# As scans and the raw layer give it: source, file, place of the split in the file, row; it orders by itself.
ORDINAL = T.StructType(
    [
        T.StructField("fonte", T.IntegerType()),
        T.StructField("arquivo", T.StringType()),
        T.StructField("trecho", T.LongType()),
        T.StructField("linha", T.LongType()),
    ]
)

# Rows numbered by hand have whole numbers for ordinals.
RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in RAW_COLUMNS] + [T.StructField(ARRIVAL, T.LongType())]
)

INTEGER_SENSORS = ["rotacao_rpm", "desgaste_min"]
MODE_DOMAIN = [*FAILURE_MODES, UNKNOWN_MODE]
VALUE_COLUMNS = ["tipo_produto", *SENSORS, "falha"]


def _sensor_fields(integer: T.DataType) -> list[T.StructField]:
    return [T.StructField(c, integer if c in INTEGER_SENSORS else T.DoubleType()) for c in SENSORS]


CLEAN_READINGS = T.StructType(
    [
        T.StructField("fonte", T.StringType()),
        T.StructField("maquina_id", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("tipo_produto", T.StringType()),
        *_sensor_fields(T.LongType()),
        T.StructField("falha", T.BooleanType()),
    ]
)

CLEAN_FAILURES = T.StructType(
    [
        T.StructField("maquina_id", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("modo", T.StringType()),
    ]
)

REJECTED = T.StructType([T.StructField(c, T.StringType()) for c in [*RAW_COLUMNS, "motivo"]])

MACHINES = T.StructType(
    [
        T.StructField("maquina_id", T.StringType()),
        T.StructField("fonte", T.StringType()),
        T.StructField("criada_em", T.TimestampType()),
    ]
)

READINGS = T.StructType(
    [
        T.StructField("leitura_id", T.LongType()),
        T.StructField("maquina_id", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("tipo_produto", T.StringType()),
        *_sensor_fields(T.IntegerType()),
        T.StructField("falha", T.BooleanType()),
    ]
)

# The stored failures carry the natural key of their reading beside its id, so that the merge
# joins them on the same key as the readings and needs no lookup of surrogate ids.
FAILURES = T.StructType(
    [
        T.StructField("falha_id", T.LongType()),
        T.StructField("leitura_id", T.LongType()),
        T.StructField("modo", T.StringType()),
        T.StructField("maquina_id", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

# Row counts are long: a total beyond two billion readings is an ordinary case here.
LOADS = T.StructType(
    [
        T.StructField("carga_id", T.LongType()),
        T.StructField("carregado_em", T.TimestampType()),
        T.StructField("leituras_inseridas", T.LongType()),
        T.StructField("leituras_atualizadas", T.LongType()),
        T.StructField("total_leituras", T.LongType()),
    ]
)

# The columns of the bulk-load files and of the reading fact, in order.
EXPORT_READINGS = [
    "maquina_id", "fonte", "ts", "tipo_produto", "temp_ar_k", "temp_processo_k",
    "rotacao_rpm", "torque_nm", "desgaste_min", "falha",
]
EXPORT_FAILURES = ["maquina_id", "ts", "modo"]
FACT_COLUMNS = [
    "id_leitura", "id_maquina", "medido_em", "tipo_produto", "temperatura_ar_c",
    "temperatura_processo_c", "rotacao_rpm", "torque_nm", "desgaste_min", "houve_falha",
    "modos_falha", "qtd_modos_falha",
]
