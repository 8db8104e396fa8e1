"""The suite of data-quality checks on the seven models and the load history."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import contract as C
from gaugeflow.functions import name, quote
from gaugeflow.operators import quality

NOT_NULL = {
    "stg_maquinas": ["id_maquina", "fonte"],
    "stg_leituras": [
        "id_leitura", "id_maquina", "medido_em", "tipo_produto", "temperatura_ar_k", "temperatura_ar_c",
        "temperatura_processo_k", "temperatura_processo_c", "rotacao_rpm", "torque_nm", "desgaste_min",
        "houve_falha",
    ],
    "stg_falhas": ["id_falha", "id_leitura", "modo_falha"],
    "int_leituras_enriquecidas": ["id_leitura", "id_maquina", "fonte"],
    "dim_maquina": ["id_maquina", "fonte", "criada_em", "total_leituras", "total_falhas"],
    "fct_leituras": ["id_leitura", "id_maquina", "medido_em", "tipo_produto"],
    "fct_falhas_diarias": ["id_maquina", "data_ref", "qtd_falhas"],
}

ACCEPTED = {
    "stg_maquinas": ("fonte", C.VALID_SOURCES),
    "stg_leituras": ("tipo_produto", C.PRODUCT_TYPES),
    "stg_falhas": ("modo_falha", C.MODE_DOMAIN),
    "int_leituras_enriquecidas": ("fonte", C.VALID_SOURCES),
    "dim_maquina": ("fonte", C.VALID_SOURCES),
    "fct_leituras": ("tipo_produto", C.PRODUCT_TYPES),
}

UNIQUE = [
    ("stg_maquinas", "id_maquina"),
    ("stg_leituras", "id_leitura"),
    ("stg_falhas", "id_falha"),
    ("int_leituras_enriquecidas", "id_leitura"),
    ("dim_maquina", "id_maquina"),
    ("fct_leituras", "id_leitura"),
    ("fct_falhas_diarias", "id_maquina, data_ref"),
]

REFERENCES = [
    ("stg_leituras", "id_maquina", "stg_maquinas"),
    ("stg_falhas", "id_leitura", "stg_leituras"),
    ("int_leituras_enriquecidas", "id_maquina", "stg_maquinas"),
    ("fct_leituras", "id_maquina", "dim_maquina"),
    ("fct_falhas_diarias", "id_maquina", "dim_maquina"),
]

PARITY = [
    ("stg_leituras", "int_leituras_enriquecidas"),
    ("stg_maquinas", "dim_maquina"),
    ("stg_leituras", "fct_leituras"),
]


class QualityError(RuntimeError):
    """At least one check found offending rows."""


def value_rules(model: str) -> dict[str, str]:
    """test|column -> condition that must hold on no row, for the null and domain checks of one model."""
    rules = {f"not_null|{c}": f"{name(c)} IS NULL" for c in NOT_NULL[model]}
    if model in ACCEPTED:
        column, values = ACCEPTED[model]
        rules[f"accepted_values|{column}"] = f"{name(column)} NOT IN ({', '.join(map(quote, values))})"
    return rules


def by_key(
    key: str,
    models: dict[str, DataFrame],
    unique: list[str],
    references: list[tuple[str, str]],
    sums: dict[str, dict[str, str]],
) -> DataFrame:
    """Rows (modelo, teste, coluna, violacoes) of all checks that need one key, and ``rows`` with each model's size.

    Every model is read once and reduced by key before the one shuffle: its rows, and the sums asked for
    (test|column -> expression per row). ``unique`` names models in which no key may repeat, ``references``
    (child, parent) pairs. Null keys count in sums and sizes only.
    """
    parts, totals = [], {}
    for i, (model, df) in enumerate(models.items()):
        wanted = {"rows|": "1L", **sums.get(model, {})}
        names = {label: f"_m{i}_{j}" for j, label in enumerate(wanted)}
        parts.append(df.selectExpr(f"{name(key)} AS _key", *[f"cast({wanted[x]} AS bigint) AS {c}" for x, c in names.items()]))
        totals |= {(model, label): f"coalesce(sum({c}), 0L)" for label, c in names.items()}
    held = {model: f"coalesce(_m{i}_0, 0L)" for i, model in enumerate(models)}
    totals |= {(m, f"unique|{key}"): f"count_if(_key IS NOT NULL AND {held[m]} > 1)" for m in unique}
    totals |= {
        (child, f"relationships|{key}"): f"count_if(_key IS NOT NULL AND {held[child]} > 0 AND {held[parent]} = 0)"
        for child, parent in references
    }
    rows = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)
    per_key = rows.groupBy("_key").agg(*[F.sum(c).alias(c) for c in rows.columns if c != "_key"])
    entries = [
        f"{quote(m)}, {quote(test)}, {quote(column)}, _t{i}"
        for i, (m, (test, _, column)) in enumerate((m, label.partition("|")) for m, label in totals)
    ]
    summed = per_key.selectExpr(*[f"{expr} AS _t{i}" for i, expr in enumerate(totals.values())])
    return summed.selectExpr(f"stack({len(entries)}, {', '.join(entries)}) AS (modelo, teste, coluna, violacoes)")


def run_checks(
    models: dict[str, DataFrame],
    history: DataFrame,
    min_readings: int = C.MIN_READINGS,
    max_drop: float = C.MAX_DROP,
) -> DataFrame:
    """One row per check: model, test, column, number of offending rows or values.

    Twelve reads in all: six models by machine, four by reading, the failures by their id, and the history. Nulls,
    domains and sizes are summed on the way; parity and volume are arithmetic on the sizes.
    """
    rules = {model: value_rules(model) for model in models}
    sums = {model: {label: f"if({test}, 1L, 0L)" for label, test in own.items()} for model, own in rules.items()}
    # The daily fact has a key of two columns: its repeats are counted where its rows are reduced by that key.
    machine_day = ["id_maquina", "data_ref"]
    per_day = models["fct_falhas_diarias"].groupBy(*machine_day).agg(
        F.expr("count(*) AS _rows"),
        *[F.expr(f"count_if({test}) AS {name(label)}") for label, test in rules["fct_falhas_diarias"].items()],
    )
    sums["fct_falhas_diarias"] = {
        "rows|": "_rows",
        **{label: name(label) for label in rules["fct_falhas_diarias"]},
        f"unique|{', '.join(machine_day)}": "if(id_maquina IS NOT NULL AND data_ref IS NOT NULL AND _rows > 1, 1L, 0L)",
    }

    def family(key: str, frames: dict[str, DataFrame], with_sums: bool) -> DataFrame:
        unique = [m for m, columns in UNIQUE if columns == key and m in frames]
        references = [(m, parent) for m, column, parent in REFERENCES if column == key]
        return by_key(key, frames, unique, references, sums if with_sums else {})

    machines = {m: df for m, df in models.items() if m != "stg_falhas"} | {"fct_falhas_diarias": per_day}
    readings = {m: models[m] for m in ("stg_leituras", "int_leituras_enriquecidas", "fct_leituras", "stg_falhas")}
    by_machine = family("id_maquina", machines, True)
    others = family("id_leitura", readings, False).unionAll(family("id_falha", {"stg_falhas": models["stg_falhas"]}, True))
    return with_derived(by_machine, others, history, list(machines), min_readings, max_drop)


def with_derived(
    by_machine: DataFrame, others: DataFrame, history: DataFrame, counted: list[str], min_readings: int, max_drop: float
) -> DataFrame:
    """All results: those given, and what follows from the sizes of the ``counted`` models and from the history."""
    dropped = quality.volume_drop(history, max_drop).selectExpr(
        "'cargas' AS modelo", "'volume_drop' AS teste", "'total_leituras' AS coluna", "count(*) AS violacoes"
    )

    # From here on it is one row per check.
    size = {m: f"_sizes[{quote(m)}]" for m in counted}
    derived = [
        *[(actual, "row_parity", expected, f"{size[expected]} <> {size[actual]}") for expected, actual in PARITY],
        ("fct_leituras", "min_volume", "", f"{size['fct_leituras']} < {min_readings}"),
        ("fct_falhas_diarias", "min_volume", "", f"{size['fct_falhas_diarias']} < {C.MIN_DAILY_ROWS}"),
    ]
    structs = [
        f"named_struct('modelo', {quote(m)}, 'teste', {quote(t)}, 'coluna', {quote(c)}, 'violacoes', if({test}, 1L, 0L))"
        for m, t, c, test in derived
    ]
    found = by_machine.selectExpr("collect_list(struct(*)) AS _found").selectExpr(
        "filter(_found, x -> x.teste <> 'rows') AS _checks",
        "map_from_entries(transform(filter(_found, x -> x.teste = 'rows'), x -> struct(x.modelo, x.violacoes))) AS _sizes",
    )
    found = found.selectExpr(f"inline(concat(_checks, array({', '.join(structs)})))")
    return found.unionAll(others.filter("teste <> 'rows'")).unionAll(dropped)


def require(results: DataFrame) -> None:
    """Raise when any check found something."""
    failed = results.filter("violacoes > 0").collect()  # at most one row per check
    if failed:
        raise QualityError(
            "; ".join(f"{r.modelo}.{r.teste}({r.coluna}): {r.violacoes}" for r in failed)
        )
