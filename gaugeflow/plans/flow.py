"""The whole flow: sources to raw layer, clean layer, published tables, checked marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.operators import cleaning, quality
from gaugeflow.operators.audit import check_accounting
from gaugeflow.plans import checks, marts
from gaugeflow.plans.load import load
from gaugeflow.session import materialize
from gaugeflow.sources import clean_layer, raw_layer, tables, text_files


def run_etl(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    path: str,
    with_load: bool = True,
    now: dt.datetime | None = None,
    selected: list[str] | None = None,
    keep: int | None = None,
) -> dict[str, dict[str, int]]:
    """Ingest, clean and (optionally) load under ``path``; returns the counts of each stage.

    Cleaning starts from the raw layer as stored, not from the frames that were ingested. With ``keep`` only so many
    versions of the tables stay on disk, else all do.
    """
    partitions = raw_layer.write_raw(text_files.union_sources(sources, selected), f"{path}/bruto")
    classified = materialize(cleaning.classify(raw_layer.read_raw(spark, f"{path}/bruto")), "classified")
    report = clean_layer.write_clean(classified, f"{path}/limpo")
    counts = check_accounting(report)
    summary = {"ingestao": {"linhas": counts["entrada"], "particoes": partitions}, "limpeza": counts}
    if with_load:
        summary["carga"] = load(
            spark,
            f"{path}/tabelas",
            clean_layer.read_readings(spark, f"{path}/limpo"),
            clean_layer.read_failures(spark, f"{path}/limpo"),
            now,
            stored=True,
        )
        if keep is not None:
            tables.remove_old(spark, f"{path}/tabelas", keep)
    return summary


def build_marts(
    spark: SparkSession,
    path: str,
    now: dt.datetime | None = None,
    min_readings: int | None = None,
    keep: int | None = None,
    full: bool = False,
) -> DataFrame:
    """Check that the tables are fresh, build the models of the days that changed, run the suite; returns its results.

    Stale tables stop the build before any model is written. What is made is written beside the current marts and
    published after the suite, so a failed check raises and leaves those as they were. With ``full`` all days are made
    anew; with ``keep`` only the files of so many published versions stay on disk, else all do.
    """
    root = f"{path}/tabelas"
    fresh = quality.freshness(tables.read_history(spark, root), now or dt.datetime.now(dt.timezone.utc)).collect()[0]
    if fresh["situacao"] == "error":
        raise checks.QualityError(f"tables are stale: last load {fresh['ultima_carga']}")
    results, _ = marts.build(spark, root, f"{path}/marts", min_readings, full)
    if keep is not None:
        marts.remove_old(spark, f"{path}/marts", keep)
    return results
