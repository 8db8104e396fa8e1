"""The steps of an idempotent merge of a batch into keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import name

INSERT, UPDATE, SAME, KEEP = "insert", "update", "same", "keep"


def merge_rows(target: DataFrame, batch: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Match target and batch on a key that is unique in each, and tell what becomes of each row.

    Batch rows without a partner are inserted, rows whose values differ (null-safely) are updated,
    the others stay, as do target rows the batch does not mention. The result has the target's
    columns, carrying along those that are neither key nor value, and ``acao``.
    """
    carried = [c for c in target.columns if c not in keys and c not in values]
    t = target.selectExpr(*names_of(target.columns), "true AS _here").alias("t")
    b = batch.selectExpr(*names_of([*keys, *values]), "true AS _here").alias("b")
    on = " AND ".join(f"t.{name(k)} = b.{name(k)}" for k in keys)
    mine, theirs = (", ".join(f"{side}.{name(v)}" for v in values) for side in "tb")
    action = (
        f"CASE WHEN t._here IS NULL THEN '{INSERT}' WHEN b._here IS NULL THEN '{KEEP}'"
        f" WHEN struct({mine}) <=> struct({theirs}) THEN '{SAME}' ELSE '{UPDATE}' END"
    )
    picked = {
        **{k: f"coalesce(t.{name(k)}, b.{name(k)})" for k in keys},
        **{v: f"if(b._here IS NULL, t.{name(v)}, b.{name(v)})" for v in values},
        **{c: f"t.{name(c)}" for c in carried},
    }
    return t.join(b, F.expr(on), "full_outer").selectExpr(
        *[f"{picked[c]} AS {name(c)}" for c in target.columns], f"{action} AS acao"
    )


def changed_rows(target: DataFrame, batch: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The batch rows that are new to the target or differ from it, with ``acao`` and the target's other columns.

    As merge_rows tells them, but rows of the target that stay as they are do not come out, so what follows grows with
    the change and not with the target. Columns of the batch beside keys and values come along.
    """
    carried = [c for c in target.columns if c not in batch.columns]
    t = target.selectExpr(*names_of([*keys, *values, *carried]), "true AS _here").alias("t")
    on = " AND ".join(f"t.{name(k)} = b.{name(k)}" for k in keys)
    mine, theirs = (", ".join(f"{side}.{name(v)}" for v in values) for side in "tb")
    joined = batch.alias("b").join(t, F.expr(on), "left")
    differs = joined.filter(f"t._here IS NULL OR NOT (struct({mine}) <=> struct({theirs}))")
    return differs.selectExpr(
        "b.*", *[f"t.{name(c)}" for c in carried], f"if(t._here IS NULL, '{INSERT}', '{UPDATE}') AS acao"
    )


def names_of(columns: list[str]) -> list[str]:
    return [name(c) for c in columns]


def action_counts(merged: DataFrame) -> DataFrame:
    """One row: rows inserted, updated, and in total."""
    return merged.selectExpr(
        f"count_if(acao = '{INSERT}') AS inseridas",
        f"count_if(acao = '{UPDATE}') AS atualizadas",
        "count(*) AS total",
    )


def insert_absent(target: DataFrame, batch: DataFrame, keys: list[str], others: list[str]) -> DataFrame:
    """Batch rows whose key the target does not have, one per key (the least of the others).

    Equal rows are merged first, by hash and before the shuffle; a minimum of text needs a sort.
    """
    fresh = batch.select(*keys, *others).distinct().groupBy(*keys).agg(*[F.expr(f"min({name(c)}) AS {name(c)}") for c in others])
    return fresh.join(target.select(*keys), keys, "left_anti")


def obsolete(target: DataFrame, scope: DataFrame, batch: DataFrame, scope_keys: list[str], keys: list[str]) -> DataFrame:
    """Target rows inside the batch's scope that the batch no longer has."""
    in_scope = target.join(scope.select(*scope_keys), scope_keys, "left_semi")
    return in_scope.join(batch.select(*keys), keys, "left_anti")


def missing(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct batch keys that the target does not have."""
    return batch.select(*keys).distinct().join(target.select(*keys), keys, "left_anti")


def violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows (regra, n) counting, in one pass, where each condition holds; zero counts included."""
    if not rules:
        raise ValueError("no rules given")
    ordered = list(rules.items())
    counts = df.selectExpr(*[f"count_if({test}) AS _r{i}" for i, (_, test) in enumerate(ordered)])
    pairs = ", ".join(f"'{rule}', _r{i}" for i, (rule, _) in enumerate(ordered))
    return counts.selectExpr(f"stack({len(ordered)}, {pairs}) AS (regra, n)")


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; keys with a null part are left out."""
    present = " AND ".join(f"{name(k)} IS NOT NULL" for k in keys)
    counted = df.filter(present).groupBy(*keys).agg(F.expr("count(*) AS n_registros"))
    return counted.filter("n_registros > 1")
