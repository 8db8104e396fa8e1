"""The raw layer: unmodified text rows in Parquet, partitioned by day text and machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeflow import contract as C
from gaugeflow.functions import name, quote
from gaugeflow.functions.text import day_text
from gaugeflow.sources.arrival import by_file, with_arrival

PARTITIONS = ["data", "maquina_id"]
# A directory name cannot tell null, empty and the sentinel's own text apart: the true machine text
# is stored beside it, one repeated value per file.
_MACHINE_TEXT = "maquina_texto"

_STORED = T.StructType(
    [T.StructField(c, T.StringType()) for c in C.RAW_COLUMNS if c != "maquina_id"]
    + [T.StructField(C.ARRIVAL, C.ORDINAL)]
    + [T.StructField(c, T.StringType()) for c in (_MACHINE_TEXT, *PARTITIONS)]
)


def write_raw(df: DataFrame, path: str) -> int:
    """Replace the dataset at ``path``; returns the number of partitions.

    The rebalance hint brings each partition's rows together so that a small one is one file, and
    lets adaptive execution spread an oversized one over several tasks and files.
    """
    stored = with_arrival(df).selectExpr(
        *[c for c in C.RAW_COLUMNS if c != "maquina_id"],
        C.ARRIVAL,
        f"maquina_id AS {_MACHINE_TEXT}",
        f"{day_text('timestamp')} AS data",
        f"coalesce(nullif(maquina_id, ''), {quote(C.NO_MACHINE)}) AS maquina_id",
    )
    stored.hint("rebalance", *PARTITIONS).write.mode("overwrite").partitionBy(*PARTITIONS).parquet(path)
    return count_partitions(df.sparkSession, path)


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(path)


def count_partitions(spark: SparkSession, path: str) -> int:
    return _scan(spark, path).select(*PARTITIONS).distinct().count()


def read_raw(spark: SparkSession, path: str, where: str = "true", numbered: bool = True) -> DataFrame:
    """Raw rows with their arrival ordinal, partition values as text.

    ``where`` is a condition on the partition columns ``data`` and ``maquina_id`` as stored; it
    prunes directories. Datasets written elsewhere have neither ordinal nor machine text: with
    ``numbered=False`` rows arrive in file order, and the sentinel means a missing machine.
    """
    machine = f"coalesce({_MACHINE_TEXT}, nullif(maquina_id, {quote(C.NO_MACHINE)})) AS maquina_id"
    columns = [machine if c == "maquina_id" else name(c) for c in C.RAW_COLUMNS]
    scan = _scan(spark, path)
    if numbered:
        return scan.filter(where).selectExpr(*columns, C.ARRIVAL)
    placed = scan.filter(where).selectExpr(
        *columns, "input_file_name() AS _file", "0L AS _split", "_metadata.row_index AS _seq"
    )
    return by_file(placed, scan.inputFiles())
