"""The clean layer: readings, failures, rejected rows and the audit report; bulk-load export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import contract as C
from gaugeflow.contract import EXPORT_FAILURES, EXPORT_READINGS  # noqa: F401
from gaugeflow.functions import name
from gaugeflow.functions.text import true_false_text
from gaugeflow.functions.times import format_timestamp
from gaugeflow.operators import audit, cleaning


def _write_ordered(df: DataFrame, order: list[str], path: str) -> None:
    """Range partitions in order, each sorted: ordered files that no hot machine can unbalance."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_clean(classified: DataFrame, path: str) -> DataFrame:
    """Write the three tables and the report under ``path``; returns the report rows.

    ``classified`` is used five times and should be materialised by the caller.
    """
    spark = classified.sparkSession
    _write_ordered(cleaning.readings(classified), ["maquina_id", "ts"], f"{path}/leituras")
    _write_ordered(cleaning.failures(classified), ["maquina_id", "ts", "modo"], f"{path}/falhas")
    cleaning.rejected(classified).write.mode("overwrite").parquet(f"{path}/descartadas")
    report = audit.audit(classified, read_failures(spark, path))
    audit.check_accounting(report)
    return write_report(report, f"{path}/relatorio")


def order_breaks(spark: SparkSession, path: str, order: list[str]) -> DataFrame:
    """Places where stored rows are not in order: rows (arquivo, posicao, anterior, atual), none if all are.

    Files count in the order of their names. Inside a file each row is compared with the one before, by a window that
    holds one file; the first row of a file with the last one of the file before, by a window over one row per file.
    """
    key = f"struct({', '.join(map(name, order))}) AS atual"
    rows = spark.read.parquet(path).selectExpr("_metadata.file_path AS arquivo", "_metadata.row_index AS posicao", key)
    inner = rows.selectExpr("*", "lag(atual) OVER (PARTITION BY arquivo ORDER BY posicao) AS anterior")
    edges = rows.groupBy("arquivo").agg(F.expr("min_by(atual, posicao) AS atual"), F.expr("max_by(atual, posicao) AS ultimo"))
    between = edges.selectExpr("arquivo", "0L AS posicao", "atual", "lag(ultimo) OVER (ORDER BY arquivo) AS anterior")
    return inner.unionByName(between).filter("anterior > atual").select("arquivo", "posicao", "anterior", "atual")


def write_report(report: DataFrame, path: str) -> DataFrame:
    """The report as rows, and as lines of JSON beside them."""
    spark = report.sparkSession
    report.write.mode("overwrite").parquet(f"{path}/linhas")
    rows = spark.read.schema(report.schema).parquet(f"{path}/linhas")
    audit.document(rows).write.mode("overwrite").text(f"{path}/json")
    return rows


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(C.CLEAN_READINGS).parquet(f"{path}/leituras")


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(C.CLEAN_FAILURES).parquet(f"{path}/falhas")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(C.REJECTED).parquet(f"{path}/descartadas")


def export_fields(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns rendered for bulk load: instants as text, booleans as ``t`` and ``f``."""
    render = {"timestamp_ntz": format_timestamp, "boolean": true_false_text}
    types = dict(df.dtypes)
    return df.selectExpr(
        *[f"{render[types[c]](name(c))} AS {name(c)}" if types[c] in render else name(c) for c in columns]
    )


def export_csv(df: DataFrame, columns: list[str], path: str) -> None:
    """Headerless CSV files in fixed column order."""
    export_fields(df, columns).write.mode("overwrite").csv(path, header=False)
