"""Marts and their checks kept up by day: what a load did not touch is neither read nor written again.

Facts are kept by the day of the reading. A build compares the tables' manifest with the one the last build started
from, makes the days that differ, and writes beside their facts what a whole needs of them: totals per machine, sums of
the checks, and the stretches their ids cover. The dimension and the suite are put together from those states of all days.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import contract as C
from gaugeflow.functions import quote
from gaugeflow.plans import checks, models
from gaugeflow.session import file_system, materialize, remove
from gaugeflow.sources import tables

FACTS = ("fct_leituras", "fct_falhas_diarias")
STATES = ("por_maquina", "somas", "faixas")
DIM = "dim_maquina"
#: Ids whose stretches share a task.
ID_BLOCK = 1 << 20
_DATED_MODELS = ("stg_leituras", "stg_falhas", "int_leituras_enriquecidas", "fct_leituras", "fct_falhas_diarias")
_COUNTED = ("stg_leituras", "int_leituras_enriquecidas", "fct_leituras", "fct_falhas_diarias")
_IDS = {m: c for m, c in checks.UNIQUE if c in ("id_leitura", "id_falha")}


@dataclass
class Build:
    """One version of the marts.

    ``sources`` has the files of the tables each day was made from, ``made`` the version that made it, ``folders`` the files
    of each fact by day; ``schemas`` those of facts, states and dimension. A version's states are one folder each.
    """

    number: int = 0
    version: str | None = None
    sources: dict[str, list] = field(default_factory=dict)
    made: dict[str, str] = field(default_factory=dict)
    folders: dict[str, dict[str, str]] = field(default_factory=dict)
    dim: str | None = None
    schemas: dict[str, str] = field(default_factory=dict)


class MartsMissing(RuntimeError):
    """The marts have not been built yet."""


def _builds(spark: SparkSession, path: str) -> list[str]:
    system, folder = file_system(spark, f"{path}/publicadas")
    if not system.exists(folder):
        return []
    return sorted(n for n in (s.getPath().getName() for s in system.listStatus(folder)) if not n.startswith("."))


def _load(spark: SparkSession, path: str, commit: str) -> Build:
    version = json.loads(tables.read_text(spark, f"{path}/publicadas/{commit}"))["versao"]
    return Build(**json.loads(tables.read_text(spark, f"{path}/manifestos/{version}.json")))


def current(spark: SparkSession, path: str) -> Build:
    """The published version; an empty one before the first build."""
    builds = _builds(spark, path)
    return _load(spark, path, builds[-1]) if builds else Build()


def _read(spark: SparkSession, path: str, build: Build, name: str, days: list[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(build.schemas[name]))
    held = build.folders.get(name, {})
    paths = [f"{path}/{held[d]}" for d in (held if days is None else days) if d in held]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_marts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The current marts by name, after checking that there are any."""
    build = current(spark, path)
    if build.version is None:
        raise MartsMissing(f"build the models first: nothing was published under {path}")
    dim = spark.read.schema(T.StructType.fromJson(json.loads(build.schemas[DIM]))).parquet(f"{path}/{build.dim}")
    return {DIM: dim, **{m: _read(spark, path, build, m) for m in FACTS}}


def _write_state(df: DataFrame, path: str, build: Build, name: str) -> None:
    rows = df.withColumn("versao", F.lit(build.version))
    build.schemas[name] = rows.schema.json()
    rows.write.parquet(f"{path}/{build.version}/{name}")


def _read_state(spark: SparkSession, path: str, build: Build, name: str) -> DataFrame:
    """A state of all days, each from the version that made it."""
    schema = T.StructType.fromJson(json.loads(build.schemas[name]))
    if not build.made:
        return spark.createDataFrame([], schema).drop("versao")
    rows = spark.read.schema(schema).parquet(*[f"{path}/{v}/{name}" for v in sorted(set(build.made.values()))])
    held = spark.createDataFrame(list(build.made.items()), f"{tables.DAY} string, versao string")  # one row per day
    return rows.join(F.broadcast(held), [tables.DAY, "versao"], "left_semi").drop("versao")


def _with_day(df: DataFrame, instant: str) -> DataFrame:
    return df.withColumn(tables.DAY, F.expr(tables.day_of(instant)))


def _write_days(df: DataFrame, path: str, build: Build, name: str, order: list[str]) -> None:
    """Write rows by day, those of a day together and in order, and enter the folders that came to be."""
    spark, folder = df.sparkSession, f"{build.version}/{name}"
    build.schemas[name] = df.drop(tables.DAY).schema.json()
    laid_out = df.hint("rebalance", tables.DAY).sortWithinPartitions(tables.DAY, *order)
    laid_out.write.partitionBy(tables.DAY).parquet(f"{path}/{folder}")
    system, root = file_system(spark, f"{path}/{folder}")
    for status in system.listStatus(root):
        key, _, day = status.getPath().getName().partition("=")
        if key == tables.DAY:
            build.folders.setdefault(name, {})[day] = f"{folder}/{key}={day}"


def day_states(dated: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Of models with their day, what the whole needs to know: rows by day, all of them far fewer than readings.

    ``por_maquina`` counts each model's rows and the failing readings per machine, ``somas`` the offending rows of every
    check that needs one day only, and ``faixas`` lists the stretches of ids without gaps, with how often they occur.
    """
    counted = [
        df.selectExpr(
            tables.DAY, "id_maquina", *[f"{'1L' if m == c else '0L'} AS {c}" for c in _COUNTED],
            f"{'if(houve_falha, 1L, 0L)' if m == 'fct_leituras' else '0L'} AS total_falhas",
        )
        for m, df in dated.items()
        if m in _COUNTED
    ]
    per_machine = reduce(DataFrame.unionAll, counted).groupBy(tables.DAY, "id_maquina")
    per_machine = per_machine.agg(*[F.sum(c).alias(c) for c in (*_COUNTED, "total_falhas")])

    def stacked(df: DataFrame, model: str, tests: dict[str, str]) -> DataFrame:
        counts = df.groupBy(tables.DAY).agg(*[F.expr(f"{e} AS _t{i}") for i, e in enumerate(tests.values())])
        entries = ", ".join(
            f"{quote(model)}, {quote(t.partition('|')[0])}, {quote(t.partition('|')[2])}, _t{i}" for i, t in enumerate(tests)
        )
        return counts.selectExpr(tables.DAY, f"stack({len(tests)}, {entries}) AS (modelo, teste, coluna, violacoes)")

    sums = []
    for model, df in dated.items():
        rules = {label: f"count_if({test})" for label, test in checks.value_rules(model).items()}
        sums.append(stacked(df, model, rules))
    day_key = ["id_maquina", "data_ref"]
    daily = dated["fct_falhas_diarias"].filter("id_maquina IS NOT NULL AND data_ref IS NOT NULL")
    repeated = daily.groupBy(tables.DAY, *day_key).agg(F.expr("count(*) AS _n"))
    sums.append(stacked(repeated, "fct_falhas_diarias", {f"unique|{', '.join(day_key)}": "count_if(_n > 1)"}))
    # A failure lies in the day of its reading.
    refs = dated["stg_falhas"].filter("id_leitura IS NOT NULL").select(tables.DAY, "id_leitura").distinct()
    orphans = refs.join(dated["stg_leituras"].select(tables.DAY, "id_leitura"), [tables.DAY, "id_leitura"], "left_anti")
    sums.append(stacked(orphans, "stg_falhas", {"relationships|id_leitura": "count(*)"}))
    return {
        "por_maquina": per_machine,
        "somas": reduce(DataFrame.unionAll, sums),
        "faixas": reduce(DataFrame.unionAll, [id_stretches(dated[m], m, c) for m, c in _IDS.items()]),
    }


def id_stretches(df: DataFrame, model: str, column: str) -> DataFrame:
    """Per day, the stretches ``de`` to ``ate`` of consecutive ids that occur ``n`` times each, cut at blocks of ids."""
    ids = df.filter(f"{column} IS NOT NULL").groupBy(tables.DAY, column).agg(F.expr("count(*) AS n"))
    placed = ids.selectExpr(tables.DAY, f"{column} AS id", "n", f"{column} div {ID_BLOCK} AS bloco")
    over = f"PARTITION BY {tables.DAY}, bloco, n ORDER BY id"
    return (
        placed.selectExpr("*", f"id - row_number() OVER ({over}) AS _run")
        .groupBy(tables.DAY, "bloco", "n", "_run")
        .agg(F.expr("min(id) AS de"), F.expr("max(id) AS ate"))
        .selectExpr(tables.DAY, f"{quote(model)} AS modelo", "bloco", "de", "ate", "n")
    )


def repeated_ids(stretches: DataFrame) -> DataFrame:
    """Rows (modelo, teste, coluna, violacoes): ids that stretches cover more than once, block by block."""
    ends = stretches.selectExpr("modelo", "bloco", "inline(array(struct(de AS at, n AS d), struct(ate + 1 AS at, -n AS d)))")
    steps = ends.groupBy("modelo", "bloco", "at").agg(F.expr("sum(d) AS d"))
    over = "PARTITION BY modelo, bloco ORDER BY at"
    depth = steps.selectExpr("modelo", f"sum(d) OVER ({over}) AS depth", f"lead(at) OVER ({over}) - at AS ids")
    found = depth.groupBy("modelo").agg(F.expr("coalesce(sum(if(depth > 1, ids, 0L)), 0L) AS violacoes"))
    column = " ".join(f"WHEN {quote(m)} THEN {quote(c)}" for m, c in _IDS.items())
    return found.selectExpr("modelo", "'unique' AS teste", f"CASE modelo {column} END AS coluna", "violacoes")


def dimension(machines: DataFrame, per_machine: DataFrame) -> DataFrame:
    """The machines with their totals over all days."""
    totals = per_machine.groupBy("id_maquina").agg(
        F.expr("sum(stg_leituras) AS total_leituras"), F.expr("sum(total_falhas) AS total_falhas")
    )
    return machines.join(totals, "id_maquina", "left").selectExpr(
        "id_maquina", "fonte", "criada_em", "coalesce(total_leituras, 0L) AS total_leituras", "coalesce(total_falhas, 0L) AS total_falhas"
    )


def run_checks(
    machines: DataFrame, dim: DataFrame, states: dict[str, DataFrame], history: DataFrame,
    min_readings: int = C.MIN_READINGS, max_drop: float = C.MAX_DROP,
) -> DataFrame:
    """The rows of checks.run_checks, from the states of all days, the machines and the history: no fact is read."""
    rules = {m: {t: f"if({e}, 1L, 0L)" for t, e in checks.value_rules(m).items()} for m in ("stg_maquinas", DIM)}
    frames = {"stg_maquinas": machines, DIM: dim}
    for model in _COUNTED:
        frames[model] = states["por_maquina"].selectExpr("id_maquina", f"{model} AS _rows").filter("_rows > 0")
        rules[model] = {"rows|": "_rows"}
    references = [(m, parent) for m, column, parent in checks.REFERENCES if column == "id_maquina"]
    by_machine = checks.by_key("id_maquina", frames, ["stg_maquinas", DIM], references, rules)
    of_days = states["somas"].select("modelo", "teste", "coluna", "violacoes").unionByName(_no_sums(states["somas"].sparkSession))
    of_days = of_days.groupBy("modelo", "teste", "coluna").agg(F.expr("sum(violacoes) AS violacoes"))
    zero = [(m, "unique", c, 0) for m, c in _IDS.items()]
    spark = machines.sparkSession
    ids = repeated_ids(states["faixas"]).unionAll(spark.createDataFrame(zero, of_days.schema))
    ids = ids.groupBy("modelo", "teste", "coluna").agg(F.expr("sum(violacoes) AS violacoes"))
    return checks.with_derived(by_machine, of_days.unionAll(ids), history, list(frames), min_readings, max_drop)


def _no_sums(spark: SparkSession) -> DataFrame:
    """A zero for every check of ``somas``, also where no day has rows."""
    rows = [(m, *label.split("|"), 0) for m in _DATED_MODELS for label in checks.value_rules(m)]
    rows += [("fct_falhas_diarias", "unique", "id_maquina, data_ref", 0), ("stg_falhas", "relationships", "id_leitura", 0)]
    return spark.createDataFrame(rows, "modelo string, teste string, coluna string, violacoes long")


def build(
    spark: SparkSession,
    root: str,
    path: str,
    min_readings: int | None = None,
    full: bool = False,
) -> tuple[DataFrame, int]:
    """Make and check the marts of the tables under ``root``, and publish them; results of the suite, and days made.

    Days whose files are those of the last build are carried over (none with ``full``). A failed check raises and
    publishes nothing; of two builds that started from one version the later is refused.
    """
    source, old = tables.current(spark, root), current(spark, path)
    files = {
        d: [source.parts["leituras"][d].folder, p.folder if (p := source.parts["falhas"].get(d)) else None]
        for d in source.parts["leituras"]
    }
    days = [d for d in files if full or old.sources.get(d) != files[d]]
    number = old.number + 1
    new = Build(number, f"v{number:06d}-{uuid.uuid4().hex[:8]}", files, {}, {}, None, dict(old.schemas))
    new.made = {d: v for d, v in old.made.items() if d in files} | {d: new.version for d in days}
    for name in FACTS:
        new.folders[name] = {d: f for d, f in old.folders.get(name, {}).items() if d in files and d not in days}
    try:
        results = _make(spark, root, path, source, new, days, min_readings)
        checks.require(results)
        tables.write_text(spark, f"{path}/manifestos/{new.version}.json", json.dumps(vars(new)))
        commit = json.dumps({"ordem": number, "versao": new.version})
        if not tables.create_once(spark, f"{path}/publicadas/{number:012d}.json", commit):
            raise tables.Conflict(f"build {number} was published by another writer")
    except BaseException:
        tables.discard(spark, path, new.version)
        raise
    return results, len(days)


def _make(spark, root, path, source: tables.State, new: Build, days: list[str], min_readings: int | None) -> DataFrame:
    machines = models.stg_maquinas(tables.read_parts(spark, root, source, "maquinas"))
    if days or not new.schemas:
        readings = models.stg_leituras(tables.read_parts(spark, root, source, "leituras", days))
        stored = tables.read_parts(spark, root, source, "falhas", days)
        failures = models.stg_falhas(stored)
        enriched = materialize(_with_day(models.int_leituras_enriquecidas(readings, machines, failures), "medido_em"), "enriched")
        fact = models.fct_leituras(enriched)
        _write_days(_with_day(fact, "medido_em"), path, new, "fct_leituras", ["medido_em", "id_maquina"])
        fact = _read(spark, path, new, "fct_leituras", days)
        daily = _with_day(models.fct_falhas_diarias(fact), "data_ref")
        _write_days(daily, path, new, "fct_falhas_diarias", ["id_maquina"])
        dated = {
            "stg_leituras": _with_day(readings, "medido_em"),
            "stg_falhas": models.stg_falhas(stored, f"{tables.day_of('ts')} AS {tables.DAY}"),
            "int_leituras_enriquecidas": enriched,
            "fct_leituras": _with_day(fact, "medido_em"),
            "fct_falhas_diarias": _with_day(_read(spark, path, new, "fct_falhas_diarias", days), "data_ref"),
        }
        for name, rows in day_states(dated).items():
            _write_state(rows, path, new, name)
    states = {name: _read_state(spark, path, new, name) for name in STATES}
    new.dim = f"{new.version}/{DIM}"
    dim = dimension(machines, states["por_maquina"])
    new.schemas[DIM] = dim.schema.json()
    dim.write.parquet(f"{path}/{new.dim}")
    limit = {} if min_readings is None else {"min_readings": min_readings}
    history = tables.read_history(spark, root)
    written = spark.read.schema(dim.schema).parquet(f"{path}/{new.dim}")
    return materialize(run_checks(machines, written, states, history, **limit), "checks")


def remove_old(spark: SparkSession, path: str, keep: int) -> None:
    """Delete the files that none of the newest ``keep`` versions of the marts refers to."""
    if keep < 1:
        raise ValueError("the current version has to stay")

    def held(build: Build) -> set[str]:
        states = {f"{v}/{name}" for v in build.made.values() for name in STATES}
        return {f for parts in build.folders.values() for f in parts.values()} | states | {build.dim}

    builds = _builds(spark, path)
    needed = set().union(*[held(_load(spark, path, b)) for b in builds[-keep:]])
    for commit in builds[:-keep]:
        version = json.loads(tables.read_text(spark, f"{path}/publicadas/{commit}"))["versao"]
        system, manifest = file_system(spark, f"{path}/manifestos/{version}.json")
        if system.exists(manifest):
            for folder in held(_load(spark, path, commit)) - needed:
                remove(spark, f"{path}/{folder}")
            system.delete(manifest, False)
