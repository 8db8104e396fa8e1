"""The registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import contract as C
from gaugeflow.functions.numbers import celsius
from gaugeflow.functions.text import day_text
from gaugeflow.functions.times import epoch_micros
from gaugeflow.operators import audit, cleaning, indexing, merge, quality
from gaugeflow.operators.dedup import mark_repeats
from gaugeflow.plans import checks, dashboard, flow, labels, marts, models, queries
from gaugeflow.plans import load as loading
from gaugeflow.session import materialize, scratch_path
from gaugeflow.sources import clean_layer, raw_layer, tables, text_files
from gaugeflow.verification import stand_ins as S

Query = Callable[[SparkSession, str], DataFrame]
NOW = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
REGISTERED: dict[str, Query] = {}


def register(fn: Query) -> Query:
    REGISTERED[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- Cleaning ---------------------------------------------------------------------------------


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning starts from stored raw rows, as it does in the flow."""
    return cleaning.classify(materialize(S.in_spark(spark, sf_dir, S.RAW), "raw"))


@register
def clean_reason_counts(spark, sf_dir):
    return classified(spark, sf_dir).groupBy("motivo").agg(F.expr("count(*) AS n"))


def clean_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Readings and failures; the classified rows are stored first, as they are in the flow."""
    rows = materialize(classified(spark, sf_dir), "classified")
    return cleaning.readings(rows), cleaning.failures(rows)


@register
def clean_accepted(spark, sf_dir):
    return clean_batch(spark, sf_dir)[0]


@register
def clean_rejected(spark, sf_dir):
    return cleaning.rejected(classified(spark, sf_dir))


@register
def modes_exploded(spark, sf_dir):
    return clean_batch(spark, sf_dir)[1]


@register
def audit_report(spark, sf_dir):
    rows = materialize(classified(spark, sf_dir), "classified")
    return audit.audit(rows, cleaning.failures(rows))


@register
def audit_document(spark, sf_dir):
    rows = materialize(classified(spark, sf_dir), "classified")
    return audit.document(audit.audit(rows, cleaning.failures(rows)))


@register
def accounting_by_source(spark, sf_dir):
    return audit.accounting_by_source(classified(spark, sf_dir))


@register
def dedup_keep_first(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", f"{S.RAW[1]['chegada']} AS chegada"
    )
    return mark_repeats(rows, ["l_orderkey", "l_linenumber"], "chegada").filter("NOT repetida").drop("repetida")


@register
def csv_export_lines(spark, sf_dir):
    rows, _ = clean_batch(spark, sf_dir)
    fields = clean_layer.export_fields(rows, clean_layer.EXPORT_READINGS)
    return fields.selectExpr(f"concat_ws(',', {', '.join(fields.columns)}) AS linha")


@register
def clean_layer_order(spark, sf_dir):
    """Stored readings and failures: their rows, and how many of them are out of order."""
    path = scratch_path(spark, "clean")
    clean_layer.write_clean(materialize(classified(spark, sf_dir), "classified"), path)
    found = []
    for t, order in (("leituras", ["maquina_id", "ts"]), ("falhas", ["maquina_id", "ts", "modo"])):
        rows = spark.read.parquet(f"{path}/{t}").selectExpr(f"'{t}' AS tabela", "count(*) AS linhas")
        breaks = clean_layer.order_breaks(spark, f"{path}/{t}", order).selectExpr("count(*) AS fora_de_ordem")
        found.append(rows.crossJoin(breaks))  # one row each
    return found[0].union(found[1])


# --- Sources and the raw layer ------------------------------------------------------------------


@register
def ai4i_mapping(spark, sf_dir):
    return text_files.ai4i_to_raw(S.in_spark(spark, sf_dir, S.AI4I))


@register
def union_sources(spark, sf_dir):
    wide = text_files.ai4i_to_raw(S.in_spark(spark, sf_dir, S.AI4I))
    other = S.in_spark(spark, sf_dir, S.RAW).drop("chegada")
    return text_files.union_sources({"ai4i": wide, "simulado": other}).drop("chegada")


@register
def raw_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "raw")
    raw_layer.write_raw(S.in_spark(spark, sf_dir, S.RAW), path)
    return raw_layer.read_raw(spark, path).withColumn("chegada", F.col("chegada.linha"))


@register
def raw_written_elsewhere(spark, sf_dir):
    """A raw layer without ordinals, one sorted file a folder: read in file order, with each row's place in its folder."""
    path = scratch_path(spark, "raw")
    rows = S.in_spark(spark, sf_dir, S.RAW).withColumns(
        {"data": F.expr(day_text("timestamp")), "maquina_id": F.expr(f"coalesce(nullif(maquina_id, ''), '{C.NO_MACHINE}')")}
    )
    laid_out = rows.repartition("data", "maquina_id").sortWithinPartitions("data", "maquina_id", "chegada").drop("chegada")
    laid_out.write.partitionBy("data", "maquina_id").parquet(path)
    back = raw_layer.read_raw(spark, path, numbered=False)
    folder = f"PARTITION BY {day_text('timestamp')}, maquina_id ORDER BY {C.ARRIVAL}"
    return back.selectExpr(*C.RAW_COLUMNS, f"row_number() OVER ({folder}) AS posicao")


@register
def csv_quoted_breaks(spark, sf_dir):
    """Cells with line breaks, quotes and commas, in files cut into small and into large splits: their rows in order."""
    path, setting = scratch_path(spark, "csv"), "spark.sql.files.maxPartitionBytes"
    rows = S.in_spark(spark, sf_dir, S.NOTES)
    by_key = F.expr("cast(k AS bigint)")
    ordered = rows.repartitionByRange(3, by_key).sortWithinPartitions(by_key)
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    ordered.write.options(escape='"', **kept).csv(path, header=True)
    found, before = [], spark.conf.get(setting)
    for size in (300_000, 8_000_000):
        try:
            spark.conf.set(setting, size)
            read = text_files.read_text_csv(spark, path, ["k", "nota"]).withColumn("trecho", F.lit(size))
            found.append(indexing.with_row_index(read, [C.ARRIVAL], "posicao").drop(C.ARRIVAL))
        finally:
            spark.conf.set(setting, before)
    return found[0].union(found[1])


@register
def raw_partitions(spark, sf_dir):
    path = scratch_path(spark, "raw")
    n = raw_layer.write_raw(S.in_spark(spark, sf_dir, S.RAW), path)
    return spark.range(1).selectExpr(f"{n}L AS particoes")


# --- Analytical queries -------------------------------------------------------------------------


@register
def rate_by_group(spark, sf_dir):
    return queries.failure_rate(S.in_spark(spark, sf_dir, S.READINGS), S.in_spark(spark, sf_dir, S.MACHINES))


@register
def rank_share(spark, sf_dir):
    return queries.machine_ranking(S.in_spark(spark, sf_dir, S.SERIES))


@register
def moving_avg_12(spark, sf_dir):
    return queries.moving_average(S.in_spark(spark, sf_dir, S.SERIES))


@register
def moving_avg_12_hot_series(spark, sf_dir):
    """Every series is cut at each hour instead of each week; the result must not change."""
    return queries.moving_average(S.in_spark(spark, sf_dir, S.SERIES), bucket_minutes=60)


@register
def moving_avg_one_series(spark, sf_dir):
    """All rows but those of odd users are one series; instants that collide are told apart by the id."""
    rows = S.in_spark(spark, sf_dir, S.ONE_SERIES)
    return queries.moving_average(rows)


@register
def moving_avg_wide_values(spark, sf_dir):
    """Values with many decimals beside values above 1e12."""
    return queries.moving_average(S.in_spark(spark, sf_dir, S.WIDE_SERIES))


@register
def first_moving_averages(spark, sf_dir):
    """The first 50 readings of one series, with their position in the result: one partition after the limit."""
    rows = queries.first_moving_averages(S.in_spark(spark, sf_dir, S.SERIES), "U-7")
    return rows.limit(50).selectExpr("*", "1 + monotonically_increasing_id() AS posicao")


@register
def jump_topk(spark, sf_dir):
    return queries.jumps(S.in_spark(spark, sf_dir, S.SERIES), prefix="U-")


@register
def jump_topk_of_prefix(spark, sf_dir):
    """A prefix that leaves machines out."""
    return queries.jumps(S.in_spark(spark, sf_dir, S.SERIES), prefix="U-1", k=50)


@register
def mode_rank_in_key(spark, sf_dir):
    return queries.mode_ranking(S.in_spark(spark, sf_dir, S.SERIES_MODES), S.in_spark(spark, sf_dir, S.SERIES))


@register
def mean_time_between_events(spark, sf_dir):
    return queries.time_between_failures(S.in_spark(spark, sf_dir, S.SERIES))


@register
def ntile_rate(spark, sf_dir):
    tiebreak = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return queries.wear_quantiles(S.in_spark(spark, sf_dir, S.WEAR), tiebreak=tiebreak)


@register
def ntile_buckets(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    return indexing.with_ntile(rows, ["value", "event_id"], 7, "faixa")


@register
def daily_running_total(spark, sf_dir):
    return queries.daily_failures(S.in_spark(spark, sf_dir, S.SERIES), prefix="U-")


# --- Models ---------------------------------------------------------------------------------------


def staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        models.stg_maquinas(S.in_spark(spark, sf_dir, S.MACHINES)),
        models.stg_leituras(S.in_spark(spark, sf_dir, S.READINGS)),
        models.stg_falhas(S.in_spark(spark, sf_dir, S.FAILURES)),
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    maquinas, leituras, falhas = staged(spark, sf_dir)
    return models.int_leituras_enriquecidas(leituras, maquinas, falhas)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings fact, stored as the models build stores it."""
    return materialize(models.fct_leituras(enriched(spark, sf_dir)), "fact")


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    maquinas, leituras, _ = staged(spark, sf_dir)
    return models.dim_maquina(maquinas, leituras)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.fct_falhas_diarias(models.fct_leituras(enriched(spark, sf_dir)))


@register
def staging_machines(spark, sf_dir):
    return staged(spark, sf_dir)[0]


@register
def staging_readings(spark, sf_dir):
    return staged(spark, sf_dir)[1]


@register
def staging_failures(spark, sf_dir):
    return staged(spark, sf_dir)[2]


@register
def unit_conversion(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{celsius('value')} AS celsius")


@register
def enriched_no_fanout(spark, sf_dir):
    return enriched(spark, sf_dir)


@register
def dim_totals(spark, sf_dir):
    maquinas, _, _ = staged(spark, sf_dir)
    return models.dim_maquina(maquinas, fact(spark, sf_dir))


@register
def fact_projection(spark, sf_dir):
    return models.fct_leituras(enriched(spark, sf_dir))


@register
def daily_fact_distinct_modes(spark, sf_dir):
    return daily(spark, sf_dir)


@register
def source_totals(spark, sf_dir):
    return queries.totals_by_source(fact(spark, sf_dir), dimension(spark, sf_dir))


@register
def mart_totals(spark, sf_dir):
    return queries.daily_totals(daily(spark, sf_dir))


@register
def multi_mode_readings(spark, sf_dir):
    return queries.several_modes(enriched(spark, sf_dir))


# --- Dashboard -----------------------------------------------------------------------------------


@register
def totals_by_source(spark, sf_dir):
    return dashboard.machine_totals(dimension(spark, sf_dir))


@register
def totals_of_one_source(spark, sf_dir):
    return dashboard.machine_totals(dimension(spark, sf_dir), ["ai4i"])


@register
def daily_by_source(spark, sf_dir):
    return dashboard.daily_with_source(daily(spark, sf_dir), dimension(spark, sf_dir))


@register
def sample_topn(spark, sf_dir):
    return dashboard.reading_sample(models.fct_leituras(enriched(spark, sf_dir)), dimension(spark, sf_dir))


@register
def kpis(spark, sf_dir):
    return dashboard.kpis(dimension(spark, sf_dir))


@register
def daily_series(spark, sf_dir):
    return dashboard.daily_series(daily(spark, sf_dir))


@register
def mode_distribution(spark, sf_dir):
    return dashboard.mode_distribution(daily(spark, sf_dir))


@register
def rule_labels(spark, sf_dir):
    rows = labels.label_readings(S.in_spark(spark, sf_dir, S.READINGS))
    return rows.select("leitura_id", "modo_falha", "falha")


# --- Merge ---------------------------------------------------------------------------------------

VALUES = ["o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"]


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = S.in_spark(spark, sf_dir, S.EARLIER, S.EARLIER_WHERE)
    batch = S.in_spark(spark, sf_dir, S.LATER, S.LATER_WHERE)
    return merge.merge_rows(target, batch, ["o_orderkey"], VALUES)


@register
def upsert_actions(spark, sf_dir):
    return merged(spark, sf_dir).groupBy("acao").agg(F.expr("count(*) AS n"))


@register
def upsert_counts(spark, sf_dir):
    return merge.action_counts(merged(spark, sf_dir))


@register
def upsert_result(spark, sf_dir):
    return merged(spark, sf_dir)


@register
def upsert_second_run(spark, sf_dir):
    batch = S.in_spark(spark, sf_dir, S.LATER, S.LATER_WHERE)
    again = merge.merge_rows(merged(spark, sf_dir).drop("acao"), batch, ["o_orderkey"], VALUES)
    return again.groupBy("acao").agg(F.expr("count(*) AS n"))


@register
def insert_if_absent(spark, sf_dir):
    target = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'").selectExpr("c_custkey AS chave")
    batch = table(spark, sf_dir, "orders").selectExpr("o_custkey AS chave", "o_orderpriority AS fonte")
    return merge.insert_absent(target, batch, ["chave"], ["fonte"])


def modes_of(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    rows = rows if status is None else rows.filter(F.col("l_linestatus") == status)
    return rows.selectExpr("l_orderkey AS leitura_id", "l_returnflag AS modo").distinct()


@register
def obsolete_removed(spark, sf_dir):
    scope = S.in_spark(spark, sf_dir, S.LATER, S.LATER_WHERE).selectExpr("o_orderkey AS leitura_id")
    return merge.obsolete(
        modes_of(spark, sf_dir), scope, modes_of(spark, sf_dir, "O"), ["leitura_id"], ["leitura_id", "modo"]
    )


@register
def new_failure_modes(spark, sf_dir):
    return merge.missing(modes_of(spark, sf_dir, "F"), modes_of(spark, sf_dir, "O"), ["leitura_id", "modo"])


@register
def surrogate_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return indexing.with_ids(rows, ["o_custkey", "o_orderdate", "o_orderkey"], "leitura_id", after=1000)


@register
def contract_violations(spark, sf_dir):
    readings = S.in_spark(spark, sf_dir, S.READINGS).withColumn(
        "fonte", F.expr("CASE WHEN falha THEN 'ai4i' WHEN desgaste_min > 0 THEN 'outra' END")
    )
    return loading.contract_violations(readings, S.in_spark(spark, sf_dir, S.MODES_OF_ORDERS))


@register
def load_ids_not_reused(spark, sf_dir):
    """The modes of the last failures are removed, then come back: they get new ids."""
    root = scratch_path(spark, "tables")
    readings, modes = clean_batch(spark, sf_dir)
    for batch in (modes, modes.filter("modo <> 'PWF'"), modes):
        loading.load(spark, root, readings, batch, NOW)
    return tables.read_table(spark, root, "falhas").drop("leitura_id")


@register
def csv_arrival_order(spark, sf_dir):
    """Two CSV folders of unequal size, several files each: the order of their rows."""
    root = scratch_path(spark, "csv")
    wide = S.in_spark(spark, sf_dir, S.AI4I)
    for folder in "ab":
        rows = wide.filter(f"(UDI LIKE '%7') = {str(folder == 'a').lower()}")
        by_udi = F.expr("cast(UDI AS bigint)")
        rows.repartitionByRange(3, by_udi).sortWithinPartitions(by_udi).write.csv(f"{root}/{folder}", header=True)
    rows = text_files.union_sources({"ai4i": text_files.read_ai4i(spark, [f"{root}/b", f"{root}/a"])})
    placed = indexing.with_row_index(rows.select("maquina_id", "timestamp", C.ARRIVAL), [C.ARRIVAL], "posicao")
    return placed.drop(C.ARRIVAL)


def changed(readings: DataFrame, modes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same batch with another torque on one product type and without one mode."""
    torque = "CASE WHEN tipo_produto = 'H' THEN torque_nm + 0.5D ELSE torque_nm END"
    return readings.withColumn("torque_nm", F.expr(torque)), modes.filter("modo <> 'PWF'")


@register
def load_changes(spark, sf_dir):
    """A first load, the same again, and a changed batch: what each of them did."""
    root = scratch_path(spark, "tables")
    readings, modes = clean_batch(spark, sf_dir)
    done = [
        loading.load(spark, root, *batch, NOW)
        for batch in ((readings, modes), (readings, modes), changed(readings, modes))
    ]
    rows = [(i + 1, *changes.values()) for i, changes in enumerate(done)]
    return spark.createDataFrame(rows, f"carga long, {', '.join(f'{c} long' for c in done[0])}")


@register
def load_partitions_written(spark, sf_dir):
    """A full load, the same again, and one day changed: partitions and rows that each load wrote, and what it carried over."""
    root = scratch_path(spark, "tables")
    readings, modes = (materialize(df, "batch") for df in clean_batch(spark, sf_dir))
    first_day = readings.agg(F.expr("cast(min(ts) AS date) AS d")).collect()[0].d
    on_day = F.expr(f"cast(ts AS date) = date'{first_day}'")
    one_day = readings.filter(on_day).withColumn("torque_nm", F.expr("torque_nm + 0.5D")), modes.filter(on_day)
    rows = []
    for i, batch in enumerate(((readings, modes), (readings, modes), one_day)):
        loading.load(spark, root, *batch, NOW, stored=True)
        state = tables.current(spark, root)
        for t, parts in state.parts.items():
            written = [p for p in parts.values() if p.folder.startswith(f"{state.version}/")]
            rows.append((i + 1, t, len(written), len(parts) - len(written), sum(p.rows for p in written)))
    return spark.createDataFrame(rows, "carga long, tabela string, escritas long, mantidas long, linhas long")


@register
def load_two_writers(spark, sf_dir):
    """Two loads of parts of the batch at the same time: whichever commits second starts over; no id is given twice."""
    root = scratch_path(spark, "tables")
    readings, modes = (materialize(df, "batch") for df in clean_batch(spark, sf_dir))
    parts = [readings.filter(test) for test in ("tipo_produto = 'H'", "tipo_produto <> 'H'")]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda r: loading.load(spark, root, r, modes.join(r, C.NATURAL_KEY, "left_semi"), NOW), parts))
    ids = {"maquinas": "maquina_id", "leituras": "leitura_id", "falhas": "falha_id"}
    loads = tables.read_history(spark, root).selectExpr("'cargas' AS tabela", "count(*) AS n", "count(DISTINCT carga_id) AS ids")
    for t, key in ids.items():
        own = tables.read_table(spark, root, t)
        loads = loads.union(own.selectExpr(f"'{t}' AS tabela", "count(*) AS n", f"count(DISTINCT {key}) AS ids"))
    return loads


@register
def load_instants(spark, sf_dir):
    """The instants a load stamps on new machines and on its history row, in microseconds."""
    root = scratch_path(spark, "tables")
    batch = clean_batch(spark, sf_dir)
    for days in (0, 1):
        loading.load(spark, root, *batch, NOW + dt.timedelta(days=days))
    machines = tables.read_table(spark, root, "maquinas").selectExpr("maquina_id AS chave", "unix_micros(criada_em) AS instante_us")
    loads = tables.read_history(spark, root)
    return machines.union(loads.selectExpr("cast(carga_id AS string) AS chave", "unix_micros(carregado_em) AS instante_us"))


@register
def history_row(spark, sf_dir):
    root = scratch_path(spark, "tables")
    batch = clean_batch(spark, sf_dir)
    loading.load(spark, root, *batch, NOW)
    loading.load(spark, root, *batch, NOW)
    return tables.read_history(spark, root).drop("carregado_em")


@register
def table_totals(spark, sf_dir):
    root = scratch_path(spark, "tables")
    loading.load(spark, root, *clean_batch(spark, sf_dir), NOW)
    return loading.table_totals(spark, root)


@register
def published_readings(spark, sf_dir):
    root = scratch_path(spark, "tables")
    loading.load(spark, root, *clean_batch(spark, sf_dir), NOW)
    return tables.read_table(spark, root, "leituras")


@register
def published_failures(spark, sf_dir):
    root = scratch_path(spark, "tables")
    loading.load(spark, root, *clean_batch(spark, sf_dir), NOW)
    return tables.read_table(spark, root, "falhas")


@register
def whole_flow_daily_fact(spark, sf_dir):
    """Raw text to checked marts: ingest, clean, load, build; the daily fact at the end."""
    path = scratch_path(spark, "flow")
    raw = S.in_spark(spark, sf_dir, S.RAW).orderBy(C.ARRIVAL)
    flow.run_etl(spark, {"simulado": raw}, path, now=NOW)
    flow.build_marts(spark, path, now=NOW, min_readings=1)
    return marts.read_marts(spark, f"{path}/marts")["fct_falhas_diarias"]


def kept_up(spark: SparkSession, sf_dir: str, again: int = 0) -> tuple[str, list[tuple[DataFrame, int]]]:
    """Marts kept up over loads: everything, the same so many times again, and the first day with another torque."""
    path = scratch_path(spark, "flow")
    readings, modes = (materialize(df, "batch") for df in clean_batch(spark, sf_dir))
    first_day = readings.agg(F.expr("cast(min(ts) AS date) AS d")).collect()[0].d
    on_day = F.expr(f"cast(ts AS date) = date'{first_day}'")
    one_day = readings.filter(on_day).withColumn("torque_nm", F.expr("torque_nm + 0.5D")), modes.filter(on_day)
    done = []
    for batch in (*[(readings, modes)] * (1 + again), one_day):
        loading.load(spark, f"{path}/tabelas", *batch, NOW, stored=True)
        done.append(marts.build(spark, f"{path}/tabelas", f"{path}/marts", min_readings=1))
    return f"{path}/marts", done


@register
def marts_by_day(spark, sf_dir):
    """The fact after two loads and builds, of which the last made one day."""
    path, _ = kept_up(spark, sf_dir)
    return marts.read_marts(spark, path)["fct_leituras"]


@register
def marts_by_day_totals(spark, sf_dir):
    """The dimension put together from the states of all days."""
    path, _ = kept_up(spark, sf_dir)
    return marts.read_marts(spark, path)["dim_maquina"].drop("criada_em")


@register
def marts_days_made(spark, sf_dir):
    """Days that each of three builds made."""
    _, done = kept_up(spark, sf_dir, again=1)
    return spark.createDataFrame([(i + 1, days) for i, (_, days) in enumerate(done)], "construcao long, dias long")


@register
def dq_suite_by_day(spark, sf_dir):
    """The suite after the second build, from the states of the days."""
    _, done = kept_up(spark, sf_dir)
    return done[-1][0]


# --- Quality -------------------------------------------------------------------------------------


@register
def dq_unique(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@register
def dq_composite_key(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@register
def dq_not_null(spark, sf_dir):
    return quality.not_null(S.in_spark(spark, sf_dir, S.RAW), *C.RAW_COLUMNS)


@register
def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(S.in_spark(spark, sf_dir, S.RAW), "tipo", C.PRODUCT_TYPES)


@register
def dq_relationships(spark, sf_dir):
    return quality.relationships(
        table(spark, sf_dir, "orders"), "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey"
    )


@register
def dq_row_parity(spark, sf_dir):
    return quality.row_parity(table(spark, sf_dir, "orders"), modes_of(spark, sf_dir))


@register
def dq_min_volume(spark, sf_dir):
    return quality.min_volume(table(spark, sf_dir, "customer"), 10**12)


def yearly_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per year as a load history; the last year is incomplete."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.expr("cast(year(o_orderdate) AS bigint) AS carga_id"))
        .agg(
            F.expr("count(*) AS total_leituras"),
            F.expr(f"timestamp_micros(max({epoch_micros('o_orderdate')})) AS carregado_em"),
        )
    )


@register
def dq_drop(spark, sf_dir):
    return quality.volume_drop(yearly_history(spark, sf_dir))


@register
def dq_latest_two(spark, sf_dir):
    last = quality.latest_two(yearly_history(spark, sf_dir), "carga_id", "total_leituras")
    return last.selectExpr("_value AS total_leituras", "cast(ordem AS bigint) AS ordem")


@register
def dq_freshness(spark, sf_dir):
    now = dt.datetime(2001, 8, 2, 12, 0, tzinfo=dt.timezone.utc)
    return quality.freshness(yearly_history(spark, sf_dir), now).select("idade_s", "situacao")


@register
def dq_suite(spark, sf_dir):
    maquinas, leituras, falhas = staged(spark, sf_dir)
    whole = materialize(enriched(spark, sf_dir), "enriched")
    built = {
        "stg_maquinas": maquinas,
        "stg_leituras": leituras,
        "stg_falhas": falhas,
        "int_leituras_enriquecidas": whole,
        "dim_maquina": materialize(models.dim_maquina(maquinas, whole), "dim"),
        "fct_leituras": models.fct_leituras(whole),
        "fct_falhas_diarias": materialize(models.fct_falhas_diarias(whole), "daily"),
    }
    return checks.run_checks(built, yearly_history(spark, sf_dir))
