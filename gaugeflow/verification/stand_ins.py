"""The given tables seen through the sensor contract.

Each stand-in is a table and a list of column expressions, written so that both SQL dialects give
them the same meaning. ``{ntz}`` is the name of the timestamp type without zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Dirty text rows from lineitem: few machines and day texts, every kind of defect, real repeats.
_DAY = "substring(cast(cast(l_shipdate AS date) AS string), 1, 8) || '01'"
_CLOCK = (
    "lpad(cast((l_orderkey * 7 + l_partkey) % 24 AS string), 2, '0') || ':'"
    " || lpad(cast(l_partkey % 60 AS string), 2, '0') || ':'"
    " || lpad(cast((l_suppkey % 4) * 15 AS string), 2, '0')"
)
RAW = (
    "lineitem",
    {
        "fonte": "CASE WHEN l_linenumber <= 2 THEN 'ai4i' WHEN l_partkey % 107 = 0 THEN chr(9) || 'simulado '"
        " ELSE 'simulado' END",
        "maquina_id": "CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 101 = 0 THEN ' '"
        " WHEN l_partkey % 103 = 0 THEN '' WHEN l_partkey % 109 = 0 THEN chr(160) || 'M-0' || cast(l_linenumber AS string)"
        " ELSE 'M-0' || cast(l_linenumber AS string) END",
        "timestamp": f"CASE WHEN l_partkey % 83 = 0 THEN 'ontem' WHEN l_partkey % 79 = 0 THEN {_DAY}"
        f" WHEN l_partkey % 113 = 0 THEN '2001-02-30 10:00:00' ELSE {_DAY} || ' ' || {_CLOCK} END",
        "tipo": "CASE WHEN l_partkey % 73 = 0 THEN 'X' WHEN l_partkey % 71 = 0 THEN NULL"
        " WHEN l_suppkey % 3 = 0 THEN 'L' WHEN l_suppkey % 3 = 1 THEN 'M' ELSE 'H' END",
        "temp_ar_k": "CASE WHEN l_partkey % 37 = 0 THEN '25.0' WHEN l_partkey % 31 = 0 THEN ' 300.0' || chr(9)"
        " ELSE cast(cast(290 + l_quantity / 5 AS decimal(12,1)) AS string) END",
        "temp_processo_k": "cast(cast(298 + l_quantity / 5 + l_tax * 50 AS decimal(12,1)) AS string)",
        "rotacao_rpm": "CASE WHEN l_partkey % 43 = 0 THEN '10001' WHEN l_partkey % 41 = 0 THEN '1500.5'"
        " ELSE cast(1200 + l_partkey % 800 AS string) END",
        "torque_nm": "CASE WHEN l_partkey % 67 = 0 THEN NULL WHEN l_partkey % 61 = 0 THEN '   ' WHEN l_partkey % 59 = 0 THEN 'ERRO'"
        " WHEN l_partkey % 53 = 0 THEN '-5.0' WHEN l_partkey % 47 = 0 THEN 'NaN'"
        " ELSE cast(cast(20 + l_quantity AS decimal(12,1)) AS string) END",
        "desgaste_min": "cast(cast(floor(l_extendedprice) AS bigint) % 260 AS string)",
        "falha": "CASE WHEN l_partkey % 89 = 0 THEN 'talvez' WHEN l_returnflag = 'R' THEN '1' ELSE '0' END",
        "modo_falha": "CASE l_suppkey % 7 WHEN 0 THEN 'HDF|PWF' WHEN 1 THEN 'OSF' WHEN 2 THEN 'HDF | PWF' WHEN 3 THEN 'TWF|xyz|TWF'"
        " WHEN 4 THEN 'RNF|OSF|HDF' WHEN 5 THEN NULL ELSE '' END",
        "chegada": "l_partkey * 100000000 + cast(floor(l_extendedprice * 100 + 0.5) AS bigint)",
    },
)

MACHINES = (
    "customer",
    {
        "maquina_id": "'C-' || cast(c_custkey AS string)",
        "fonte": "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'ai4i' ELSE 'simulado' END",
        "criada_em": "cast('2024-01-01 00:00:00' AS {ntz})",
    },
)

READINGS = (
    "orders",
    {
        "leitura_id": "o_orderkey",
        "maquina_id": "'C-' || cast(o_custkey AS string)",
        "ts": "o_orderdate",
        "tipo_produto": "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'H' WHEN '2' THEN 'M' ELSE 'L' END",
        "temp_ar_k": "290 + cast(o_custkey % 200 AS double) / 10",
        "temp_processo_k": "300 + cast(o_orderkey % 130 AS double) / 10",
        "rotacao_rpm": "cast(1300 + o_orderkey % 400 AS int)",
        "torque_nm": "cast(cast(floor(o_totalprice) AS bigint) % 700 AS double) / 10",
        "desgaste_min": "cast(cast(floor(o_totalprice) AS bigint) % 250 AS int)",
        "falha": "o_orderstatus = 'F'",
    },
)

# Line items as failure records: orders with many, one and no record all occur.
FAILURES = (
    "lineitem",
    {
        "falha_id": "l_orderkey * 10 + l_linenumber",
        "leitura_id": "l_orderkey",
        "modo": "CASE l_returnflag WHEN 'A' THEN 'HDF' WHEN 'N' THEN 'OSF' ELSE 'PWF' END",
    },
)

SERIES = (
    "events",
    {
        "leitura_id": "event_id",
        "maquina_id": "'U-' || cast(user_id AS string)",
        "ts": "ts",
        "temp_processo_k": "value",
        "torque_nm": "value",
        "falha": "event_type = 'error'",
    },
)

# Half of the events in one series; the id is added as seconds, as instants must differ within a series.
ONE_SERIES = (
    "events",
    {
        "maquina_id": "CASE WHEN user_id % 2 = 0 THEN 'U' ELSE 'U-' || cast(user_id AS string) END",
        "ts": "cast('2020-01-01 00:00:00' AS {ntz}) + event_id * INTERVAL '7' SECOND",
        "temp_processo_k": "value",
    },
)

WIDE_SERIES = (
    "events",
    {
        "maquina_id": "'U-' || cast(user_id AS string)",
        "ts": "ts",
        "temp_processo_k": "CASE WHEN event_id % 3 = 0 THEN floor(value) * cast('1e10' AS double) + cast('0.5' AS double)"
        " ELSE value / cast('7' AS double) END",
    },
)

# Modes of orders: some orders twice, some under an instant that no order has.
MODES_OF_ORDERS = (
    "orders",
    {
        "maquina_id": "'C-' || cast(o_custkey AS string)",
        "ts": "CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate + INTERVAL '3' SECOND ELSE o_orderdate END",
        "modo": "CASE WHEN o_orderkey % 5 = 0 THEN 'HDF' WHEN o_orderkey % 5 = 1 THEN 'PWF' ELSE o_orderstatus END",
    },
)

SERIES_MODES = ("events", {"leitura_id": "event_id", "modo": "event_type"})

WEAR = (
    "lineitem",
    {
        "desgaste_min": "cast(l_quantity AS int)",
        "falha": "l_returnflag = 'R'",
        "l_orderkey": "l_orderkey",
        "l_linenumber": "l_linenumber",
        "l_partkey": "l_partkey",
        "l_extendedprice": "l_extendedprice",
    },
)

NOTES = (
    "orders",
    {
        "k": "cast(o_orderkey AS string)",
        "nota": "CASE WHEN o_custkey % 4 = 0 THEN o_orderpriority || chr(10) || chr(34) || o_orderstatus || chr(34) || ',' || chr(10)"
        " WHEN o_custkey % 4 = 1 THEN chr(10) || chr(10) WHEN o_custkey % 4 = 2 THEN 'NA' ELSE chr(34) || o_orderpriority END",
    },
)

AI4I = (
    "orders",
    {
        "UDI": "cast(o_orderkey + 1 AS string)",
        "Type": "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'H' WHEN '2' THEN 'M' ELSE 'L' END",
        "Air temperature [K]": "cast(cast(290 + o_custkey % 100 AS decimal(12,1)) AS string)",
        "Process temperature [K]": "cast(cast(300 + o_custkey % 100 AS decimal(12,1)) AS string)",
        "Rotational speed [rpm]": "cast(1300 + o_orderkey % 400 AS string)",
        "Torque [Nm]": "cast(cast(floor(o_totalprice) AS bigint) % 70 AS string)",
        "Tool wear [min]": "cast(cast(floor(o_totalprice) AS bigint) % 250 AS string)",
        "Machine failure": "CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END",
        "TWF": "CASE WHEN o_custkey % 5 = 0 THEN '1' ELSE '0' END",
        "HDF": "CASE WHEN o_custkey % 7 = 0 THEN '1' ELSE '0' END",
        "PWF": "CASE WHEN o_custkey % 11 = 0 THEN '1' END",
        "OSF": "CASE WHEN o_custkey % 13 = 0 THEN '1' ELSE '0' END",
        "RNF": "'0'",
    },
)

# An earlier and a later state of the orders: they overlap in time, and in the overlap some rows
# differ, some became null, some are null in both.
_ORDER = {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_orderdate": "o_orderdate"}
EARLIER = (
    "orders",
    {
        **_ORDER,
        "leitura_id": "o_orderkey + 1",
        "o_totalprice": "o_totalprice",
        "o_orderstatus": "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END",
    },
)
LATER = (
    "orders",
    {
        **_ORDER,
        "o_totalprice": "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END",
        "o_orderstatus": "CASE WHEN o_orderpriority NOT IN ('2-HIGH', '5-LOW') THEN o_orderstatus END",
    },
)
EARLIER_WHERE = "o_orderdate < cast('1999-01-01 00:00:00' AS {ntz})"
LATER_WHERE = "o_orderdate >= cast('1997-01-01 00:00:00' AS {ntz})"


def _quoted(column: str, mark: str) -> str:
    return f"{mark}{column}{mark}"


def in_spark(spark: SparkSession, sf_dir: str, stand_in, where: str = "true") -> DataFrame:
    table, columns = stand_in
    exprs = [f"{e.format(ntz='timestamp_ntz')} AS {_quoted(c, '`')}" for c, e in columns.items()]
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").filter(where.format(ntz="timestamp_ntz"))
    if stand_in is RAW:
        rows = rows.hint("rebalance")  # a table of one row group is one task; its expressions are costly
    return rows.selectExpr(*exprs)


def in_sql(stand_in, where: str = "true") -> str:
    table, columns = stand_in
    mark = '"'
    exprs = ", ".join(f"{e.format(ntz='timestamp')} AS {_quoted(c, mark)}" for c, e in columns.items())
    return f"SELECT {exprs} FROM {table} WHERE {where.format(ntz='timestamp')}"
