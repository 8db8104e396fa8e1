"""The cleaning audit: every count needed to account for each input row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import contract as C
from gaugeflow.functions import quote
from gaugeflow.functions.text import is_blank, strip
from gaugeflow.operators.cleaning import TYPED

# Sections and keys that are reported even when their count is zero.
FIXED_ROWS = [
    *[("linhas", k) for k in ("entrada", "validas", "descartadas")],
    *[("descartadas_por_motivo", k) for k in C.REASONS],
    *[("avisos", k) for k in ("modo_ignorado_sem_falha", "falhas_sem_modo_informado")],
    *[("falhas", k) for k in ("leituras_com_falha", "registros_de_falha")],
]


class AccountingError(ValueError):
    """Input rows and valid plus rejected rows do not add up."""


def _as_rows(entries: list[tuple[str, str, str]]) -> str:
    """(section, key expression, count expression) triples as rows (secao, chave, n)."""
    structs = [
        f"named_struct('secao', {quote(s)}, 'chave', {key}, 'n', cast({n} AS bigint))" for s, key, n in entries
    ]
    return f"inline(array({', '.join(structs)}))"


def audit(classified: DataFrame, failures: DataFrame) -> DataFrame:
    """Counts as rows (secao, chave, n).

    One pass over the classified rows down to (source, reason) cells; everything else is arithmetic
    on those few cells. Rows, not one nested value, because sources are not checked at this stage
    and there may be any number of them.
    """
    failed, has_mode = f"{TYPED}.falha", f"NOT {is_blank(strip('modo_falha'))}"
    cells = classified.groupBy(F.expr(f"{strip('fonte')} AS fonte"), "motivo").agg(
        F.expr("count(*) AS n"),
        F.expr(f"count_if(motivo IS NULL AND {failed}) AS com_falha"),
        F.expr(f"count_if(motivo IS NULL AND NOT ({failed}) AND {has_mode}) AS modo_ignorado"),
    )
    valid = "if(motivo IS NULL, n, 0)"
    of_rows = cells.selectExpr(
        _as_rows(
            [
                ("linhas", "'entrada'", "n"),
                ("linhas", "'validas'", valid),
                ("linhas", "'descartadas'", f"n - {valid}"),
                ("descartadas_por_motivo", "motivo", "n"),
                ("avisos", "'modo_ignorado_sem_falha'", "modo_ignorado"),
                ("falhas", "'leituras_com_falha'", "com_falha"),
                ("entrada_por_fonte", "fonte", "n"),
                ("validas_por_fonte", "fonte", valid),
            ]
        )
    ).filter("chave IS NOT NULL")
    of_modes = failures.selectExpr(
        "count(*) AS total", f"count_if(modo = {quote(C.UNKNOWN_MODE)}) AS sem_modo"
    ).selectExpr(
        _as_rows(
            [
                ("falhas", "'registros_de_falha'", "total"),
                ("avisos", "'falhas_sem_modo_informado'", "sem_modo"),
            ]
        )
    )
    zeros = classified.sparkSession.range(1).selectExpr(
        _as_rows([(s, quote(k), "0") for s, k in FIXED_ROWS])
    )
    return of_rows.union(of_modes).union(zeros).groupBy("secao", "chave").agg(F.expr("sum(n) AS n"))


def accounting_by_source(classified: DataFrame) -> DataFrame:
    """Per source: input, valid and rejected rows."""
    return classified.groupBy(F.expr(f"{strip('fonte')} AS fonte")).agg(
        F.expr("count(*) AS entrada"),
        F.expr("count_if(motivo IS NULL) AS validas"),
        F.expr("count_if(motivo IS NOT NULL) AS descartadas"),
    )


def document(report: DataFrame) -> DataFrame:
    """The report as lines of JSON: the totals by section first, then one line per source in order.

    There may be any number of sources, so they are never brought together in one value.
    """

    def total(section: str, key: str) -> str:
        return f"coalesce(sum(if(secao = {quote(section)} AND chave = {quote(key)}, n, 0L)), 0L)"

    def block(section: str) -> str:
        pairs = [f"{quote(k)}, {total(s, k)}" for s, k in FIXED_ROWS if s == section]
        return f"named_struct({', '.join(pairs)}) AS {section}"

    body = report.selectExpr(
        f"{total('linhas', 'entrada')} AS linhas_entrada",
        f"{total('linhas', 'validas')} AS linhas_validas",
        f"{total('linhas', 'descartadas')} AS linhas_descartadas",
        block("descartadas_por_motivo"),
        block("avisos"),
        f"{total('falhas', 'leituras_com_falha')} AS leituras_com_falha",
        f"{total('falhas', 'registros_de_falha')} AS registros_de_falha",
    )
    sources = report.filter("secao IN ('entrada_por_fonte', 'validas_por_fonte')").groupBy("chave").agg(
        F.expr("sum(if(secao = 'entrada_por_fonte', n, 0)) AS entrada"),
        F.expr("sum(if(secao = 'validas_por_fonte', n, 0)) AS validas"),
    )
    lines = body.selectExpr("CAST(NULL AS string) AS _fonte", "to_json(struct(*)) AS value").union(
        sources.selectExpr("chave", "to_json(struct(chave AS fonte, entrada, validas))")
    )
    return lines.orderBy(F.asc_nulls_first("_fonte")).select("value")


def check_accounting(report: DataFrame) -> dict[str, int]:
    """Raise unless input = valid + rejected; returns the three counts."""
    rows = report.filter("secao = 'linhas'").collect()  # three rows
    counts = {r["chave"]: r["n"] for r in rows}
    if counts["entrada"] != counts["validas"] + counts["descartadas"]:
        raise AccountingError(f"rows do not add up: {counts}")
    return counts
