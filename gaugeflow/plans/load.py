"""The idempotent load of a cleaned batch into the published tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import contract as C
from gaugeflow.functions import one_of
from gaugeflow.operators import merge
from gaugeflow.operators.indexing import with_ids
from gaugeflow.session import materialize
from gaugeflow.sources import tables

MODE_KEY = [*C.NATURAL_KEY, "modo"]


class ContractError(ValueError):
    """The batch breaks the contract; nothing was published. ``broken`` maps rules to counts."""

    def __init__(self, broken: dict[str, int]):
        super().__init__(f"load rejected: {broken}")
        self.broken = broken


def reading_rules() -> dict[str, str]:
    """Conditions that must hold on no row of a readings batch."""
    needed = [*C.NATURAL_KEY, "fonte", *C.VALUE_COLUMNS]
    return {
        **{f"{c}_nulo": f"{c} IS NULL" for c in needed},
        **{f"{c}_fora_da_faixa": f"{c} NOT BETWEEN {lo}D AND {hi}D" for c, (lo, hi) in C.RANGES.items()},
        "tipo_produto_invalido": f"tipo_produto IS NOT NULL AND NOT {one_of('tipo_produto', C.PRODUCT_TYPES)}",
        "fonte_invalida": f"fonte IS NOT NULL AND NOT {one_of('fonte', C.VALID_SOURCES)}",
    }


def failure_rules() -> dict[str, str]:
    return {"modo_invalido": f"NOT {one_of('modo', C.MODE_DOMAIN)}"}


def contract_violations(readings: DataFrame, failures: DataFrame) -> DataFrame:
    """Rows (regra, n) for every rule: values in one pass, then keys.

    Rows meet once by their natural key: repeated readings, repeated modes and failures without a reading are counted in
    one aggregate. A null key is equal to none.
    """
    present = " AND ".join(f"{k} IS NOT NULL" for k in C.NATURAL_KEY)
    modes = failures.groupBy(*MODE_KEY).agg(F.expr("count(*) AS _rows")).selectExpr(
        *C.NATURAL_KEY, "0L AS _readings", "_rows", "if(modo IS NOT NULL AND _rows > 1, 1L, 0L) AS _again"
    )
    per_key = (
        readings.selectExpr(*C.NATURAL_KEY, "1L AS _readings", "0L AS _rows", "0L AS _again")
        .unionAll(modes)
        .groupBy(*C.NATURAL_KEY)
        .agg(*[F.expr(f"sum({c}) AS {c}") for c in ("_readings", "_rows", "_again")])
    )
    of_keys = per_key.selectExpr(
        f"count_if({present} AND _readings > 1) AS a",
        f"coalesce(sum(if({present}, _again, 0L)), 0L) AS b",
        f"coalesce(sum(if({present} AND _readings > 0, 0L, _rows)), 0L) AS c",
    ).selectExpr("stack(3, 'chave_repetida', a, 'falha_repetida', b, 'falha_sem_leitura', c) AS (regra, n)")
    machines = readings.filter("maquina_id IS NOT NULL").select("maquina_id", "fonte").distinct()
    mixed = merge.repeated(machines, ["maquina_id"]).selectExpr("'maquina_com_duas_fontes' AS regra", "count(*) AS n")
    found = merge.violations(readings, reading_rules()).union(merge.violations(failures, failure_rules()))
    return found.union(of_keys).union(mixed)


def enforce(readings: DataFrame, failures: DataFrame) -> None:
    """Raise if the batch breaks any rule."""
    rows = contract_violations(readings, failures).filter("n > 0").collect()  # one row per rule
    if rows:
        raise ContractError({r["regra"]: r["n"] for r in rows})


def load(
    spark: SparkSession,
    root: str,
    readings: DataFrame,
    failures: DataFrame,
    now: dt.datetime | None = None,
    stored: bool = False,
    attempts: int = 5,
) -> dict[str, int]:
    """Merge a batch into the tables under ``root``; returns what changed.

    The batch is checked, the days it changes are written beside the current ones, and only then made current; days
    without a change, and days the batch does not mention, are neither read nor written. Loading the same batch again
    changes nothing but the history. If another load is published meanwhile, this one starts over from its version, at
    most ``attempts`` times. The batch is read several times; unless it comes straight from files (``stored``), it is
    written once first.
    """
    now = now or dt.datetime.now(dt.timezone.utc)
    if not stored:
        readings, failures = materialize(readings, "batch"), materialize(failures, "batch")
    enforce(readings, failures)
    for attempt in range(attempts):
        version = uuid.uuid4().hex[:8]
        try:
            return _merge(spark, root, readings, failures, now, version)
        except tables.Conflict:
            if attempt == attempts - 1:
                raise
    raise ValueError("no attempt allowed")


def _merge(
    spark: SparkSession, root: str, readings: DataFrame, failures: DataFrame, now: dt.datetime, label: str
) -> dict[str, int]:
    old = tables.current(spark, root)
    version = f"v{old.load_id + 1:06d}-{label}"
    new = tables.State(old.load_id + 1, version, old.last_reading, old.last_failure)
    new.parts = {t: dict(parts) for t, parts in old.parts.items()}
    try:
        changes = _write_changes(spark, root, readings, failures, now, old, new)
        tables.publish(spark, root, new, now, changes["leituras_inseridas"], changes["leituras_atualizadas"])
    except BaseException:
        tables.discard(spark, root, version)
        raise
    return changes


def _write_changes(spark, root, readings, failures, now, old: tables.State, new: tables.State) -> dict[str, int]:
    """Write the changed partitions of all tables and enter them into ``new``."""
    typed = readings.selectExpr(
        *C.NATURAL_KEY,
        *[f"cast({c} AS {C.READINGS[c].dataType.simpleString()}) AS {c}" for c in C.VALUE_COLUMNS],
        f"{tables.day_of('ts')} AS {tables.DAY}",
    )
    days = [r[0] for r in typed.select(tables.DAY).distinct().collect()]  # one row per day

    # Machines: existing rows stay as they are, new ones are files of their own.
    known = tables.read_parts(spark, root, old, "maquinas")
    fresh = materialize(merge.insert_absent(known, readings, ["maquina_id"], ["fonte"]), "new-machines")
    n_machines = fresh.count()
    if n_machines:
        stamped = fresh.selectExpr("maquina_id", "fonte", f"timestamp_micros({_micros(now)}) AS criada_em")
        tables.write_parts(stamped, root, new.version, "maquinas")
        new.parts["maquinas"][new.version] = tables.Part(tables.folder_of(new.version, "maquinas", ""), n_machines)

    # Readings: only what differs is stored; new rows are numbered in the order of their key.
    before = tables.read_parts(spark, root, old, "leituras", days)
    differing = materialize(merge.changed_rows(before, typed, C.NATURAL_KEY, C.VALUE_COLUMNS), "changed")
    per_day = differing.groupBy("acao", tables.DAY).agg(F.expr("count(*)")).collect()  # two rows per day at most
    inserted, updated = ({d: n for a, d, n in per_day if a == action} for action in (merge.INSERT, merge.UPDATE))
    fresh, replaced = (differing.filter(f"acao = '{action}'") for action in (merge.INSERT, merge.UPDATE))
    columns = [*C.READINGS.names, tables.DAY]
    numbered = fresh.drop("leitura_id").where("false").withColumn("leitura_id", F.lit(0).cast("long"))
    if inserted:
        numbered = with_ids(fresh.drop("leitura_id"), C.NATURAL_KEY, "leitura_id", after=old.last_reading)
    new.last_reading += sum(inserted.values())
    rows = numbered.select(*columns).union(replaced.select(*columns))
    _rewrite(spark, root, old, new, "leituras", rows, inserted, replaced if updated else None, "leitura_id", updated, {})

    # Failures: modes gone from the batch's readings are removed, new ones added.
    modes = failures.select(*MODE_KEY)
    stored_modes = tables.read_parts(spark, root, old, "falhas", days)
    gone, removed = None, {}
    if any(d in old.parts["falhas"] for d in days):
        obsolete = merge.obsolete(stored_modes, typed, modes, C.NATURAL_KEY, MODE_KEY)
        gone = materialize(obsolete.selectExpr("falha_id", f"{tables.day_of('ts')} AS {tables.DAY}"), "obsolete")
        removed = _per_day(gone)
    key_ids = ["leitura_id", *C.NATURAL_KEY]
    ids = before.select(*key_ids).union(numbered.select(*key_ids))
    missing = merge.missing(stored_modes, modes, MODE_KEY).join(ids, C.NATURAL_KEY)
    missing = missing.withColumn(tables.DAY, F.expr(tables.day_of("ts")))
    new_modes = with_ids(missing, MODE_KEY, "falha_id", after=old.last_failure)
    added = _per_day(new_modes)
    new.last_failure += sum(added.values())
    columns = [*C.FAILURES.names, tables.DAY]
    _rewrite(spark, root, old, new, "falhas", new_modes.select(*columns), added, gone, "falha_id", {}, removed)
    return {
        "maquinas_novas": n_machines,
        "leituras_inseridas": sum(inserted.values()),
        "leituras_atualizadas": sum(updated.values()),
        "falhas_inseridas": sum(added.values()),
        "falhas_removidas": sum(removed.values()),
    }


def _per_day(rows: DataFrame) -> dict[str, int]:
    """Rows per day: at most one entry per calendar day."""
    return {r[0]: r[1] for r in rows.groupBy(tables.DAY).agg(F.expr("count(*)")).collect()}


def _rewrite(
    spark, root, old: tables.State, new: tables.State, table: str, rows: DataFrame,
    inserted: dict[str, int], replaced: DataFrame | None, id_column: str, updated: dict[str, int], removed: dict[str, int],
) -> None:
    """Write the days that change: their stored rows without the replaced ids, and the new rows."""
    days = sorted({*inserted, *updated, *removed})
    if not days:
        return
    kept = tables.read_parts(spark, root, old, table, days)
    if replaced is not None:
        kept = kept.join(replaced.select(id_column), id_column, "left_anti")
    kept = kept.withColumn(tables.DAY, F.expr(tables.day_of("ts")))
    tables.write_parts(kept.select(*rows.columns).union(rows), root, new.version, table)
    held = old.parts[table]
    for day in days:
        n = (held[day].rows if day in held else 0) + inserted.get(day, 0) - removed.get(day, 0)
        if n:
            new.parts[table][day] = tables.Part(tables.folder_of(new.version, table, day), n)
        else:
            new.parts[table].pop(day, None)


def _micros(moment: dt.datetime) -> int:
    aware = moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    return round(aware.timestamp() * 1_000_000)


def table_totals(spark: SparkSession, root: str) -> DataFrame:
    """Rows (tabela, n) of the current version, from its manifest."""
    state = tables.current(spark, root)
    return spark.createDataFrame([(t, state.rows(t)) for t in tables.SCHEMAS], "tabela string, n long")
