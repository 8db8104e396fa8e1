"""What each registered query must return, as plain SQL over the given tables."""

from __future__ import annotations

from gaugeflow import contract as C
from gaugeflow.plans import checks
from gaugeflow.verification import stand_ins as S


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


SPACE = "chr(9) || chr(10) || chr(13) || ' ' || chr(160)"
NUMBER = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
INSTANT = "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"


def _cleaning() -> str:
    """CTEs raw, s (stripped), p (parsed), m (with reason), ok (typed), modes (exploded)."""
    stripped = ", ".join(f'trim("{c}", {SPACE}) AS s_{c}' for c in C.RAW_COLUMNS)
    parsed = ", ".join(
        f"CASE WHEN regexp_full_match(s_{c}, '{NUMBER}') THEN try_cast(s_{c} AS DOUBLE) END AS n_{c}"
        for c in C.SENSORS
    )
    blank = " OR ".join(f"coalesce(s_{c}, '') = ''" for c in C.SENSORS)
    garbage = " OR ".join(f"(coalesce(s_{c}, '') <> '' AND n_{c} IS NULL)" for c in C.SENSORS)
    outside = " OR ".join(
        f"coalesce(n_{c} < {lo} OR n_{c} > {hi}, false)" for c, (lo, hi) in C.RANGES.items()
    )
    numbers = ", ".join(
        f"CAST(round_even(n_{c}, 0) AS BIGINT) AS {c}" if c in C.INTEGER_SENSORS else f"n_{c} AS {c}"
        for c in C.SENSORS
    )
    return f"""
    WITH raw AS ({S.in_sql(S.RAW)}),
    s AS (SELECT *, {stripped} FROM raw),
    p AS (SELECT *, {parsed},
                 CASE WHEN regexp_full_match(s_timestamp, '{INSTANT}')
                      THEN try_strptime(s_timestamp, '%Y-%m-%d %H:%M:%S') END AS ts FROM s),
    k AS (SELECT *, coalesce(s_maquina_id, '') <> '' AND ts IS NOT NULL AS com_chave FROM p),
    r AS (SELECT *, row_number() OVER (PARTITION BY com_chave, s_fonte, s_maquina_id, s_timestamp
                                       ORDER BY chegada) AS copia FROM k),
    m AS (SELECT *, CASE WHEN com_chave AND copia > 1 THEN 'duplicada'
                         WHEN coalesce(s_maquina_id, '') = '' THEN 'maquina_ausente'
                         WHEN ts IS NULL THEN 'timestamp_invalido'
                         WHEN coalesce(s_tipo, '') NOT IN {_list(C.PRODUCT_TYPES)} THEN 'tipo_invalido'
                         WHEN coalesce(s_falha, '') NOT IN ('0', '1') THEN 'falha_invalida'
                         WHEN {blank} THEN 'sensor_nulo'
                         WHEN {garbage} THEN 'sensor_nao_numerico'
                         WHEN {outside} THEN 'fora_da_faixa_fisica' END AS motivo FROM r),
    ok AS (SELECT s_fonte AS fonte, s_maquina_id AS maquina_id, ts, s_tipo AS tipo_produto, {numbers},
                  s_falha = '1' AS falha FROM m WHERE motivo IS NULL),
    known AS (SELECT s_maquina_id AS maquina_id, ts,
                     list_filter(string_split(coalesce(s_modo_falha, ''), '|'),
                                 lambda t: t IN {_list(C.FAILURE_MODES)}) AS modos
              FROM m WHERE motivo IS NULL AND s_falha = '1'),
    modes AS (SELECT DISTINCT maquina_id, ts,
                     unnest(CASE WHEN len(modos) = 0 THEN ['{C.UNKNOWN_MODE}'] ELSE modos END) AS modo
              FROM known)
    """


def _models() -> str:
    """CTEs stg_maquinas, stg_leituras, stg_falhas, enriched, dim, daily over the stand-ins."""
    return f"""
    WITH stg_maquinas AS (SELECT maquina_id AS id_maquina, fonte, criada_em FROM ({S.in_sql(S.MACHINES)})),
    stg_leituras AS (
        SELECT leitura_id AS id_leitura, maquina_id AS id_maquina, ts AS medido_em, tipo_produto,
               temp_ar_k AS temperatura_ar_k, {_celsius('temp_ar_k')} AS temperatura_ar_c,
               temp_processo_k AS temperatura_processo_k, {_celsius('temp_processo_k')} AS temperatura_processo_c,
               rotacao_rpm, torque_nm, desgaste_min, falha AS houve_falha FROM ({S.in_sql(S.READINGS)})),
    stg_falhas AS (SELECT falha_id AS id_falha, leitura_id AS id_leitura, modo AS modo_falha
                   FROM ({S.in_sql(S.FAILURES)})),
    {_marts()}
    """


def _marts() -> str:
    return """
    per_reading AS (SELECT id_leitura, string_agg(modo_falha, ', ' ORDER BY modo_falha) AS modos_falha,
                           count(*) AS qtd FROM stg_falhas GROUP BY id_leitura),
    enriched AS (
        SELECT l.id_leitura, l.id_maquina, m.fonte, l.medido_em, l.houve_falha, f.modos_falha,
               coalesce(f.qtd, 0) AS qtd_modos_falha, l.tipo_produto, l.temperatura_ar_c,
               l.temperatura_processo_c, l.rotacao_rpm, l.torque_nm, l.desgaste_min
        FROM stg_leituras l JOIN stg_maquinas m ON m.id_maquina = l.id_maquina
        LEFT JOIN per_reading f ON f.id_leitura = l.id_leitura),
    dim AS (SELECT m.id_maquina, m.fonte, m.criada_em, count(e.id_leitura) AS total_leituras,
                   count(*) FILTER (WHERE e.houve_falha) AS total_falhas
            FROM stg_maquinas m LEFT JOIN enriched e ON e.id_maquina = m.id_maquina
            GROUP BY m.id_maquina, m.fonte, m.criada_em),
    fact AS (SELECT id_leitura, id_maquina, medido_em, tipo_produto, temperatura_ar_c, temperatura_processo_c,
                    rotacao_rpm, torque_nm, desgaste_min, houve_falha, modos_falha, qtd_modos_falha FROM enriched),
    daily AS (SELECT id_maquina, CAST(medido_em AS DATE) AS data_ref, count(*) AS qtd_falhas,
                     string_agg(DISTINCT modos_falha, '; ' ORDER BY modos_falha) AS modos_falha
              FROM fact WHERE houve_falha GROUP BY 1, 2)
    """


def _celsius(k: str) -> str:
    return f"CAST(round(CAST({k} AS DECIMAL(28,10)) - 273.15, 2) AS DECIMAL(14,2))"


def _percent(hits: str, n: str, places: int = 2) -> str:
    """100 * hits / n rounded half up, by integer division."""
    unit = 10**places
    return f"CAST((200 * {unit} * {hits} + {n}) // nullif(2 * {n}, 0) AS DOUBLE) / {unit}"


def _merged() -> str:
    """CTE merged: the outcome of the orders merge, row by row."""
    values = ["o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"]
    picked = ", ".join(f"CASE WHEN b.o_orderkey IS NULL THEN t.{v} ELSE b.{v} END AS {v}" for v in values)
    differs = " OR ".join(f"t.{v} IS DISTINCT FROM b.{v}" for v in values)
    return f"""
    WITH t AS ({S.in_sql(S.EARLIER, S.EARLIER_WHERE)}), b AS ({S.in_sql(S.LATER, S.LATER_WHERE)}),
    merged AS (
        SELECT coalesce(t.o_orderkey, b.o_orderkey) AS o_orderkey, t.leitura_id, {picked},
               CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'keep'
                    WHEN {differs} THEN 'update' ELSE 'same' END AS acao
        FROM t FULL OUTER JOIN b ON t.o_orderkey = b.o_orderkey)
    """


def _suite() -> str:
    """The suite of checks, one SELECT per check."""
    alias = {
        "int_leituras_enriquecidas": "enriched", "dim_maquina": "dim", "fct_leituras": "fact",
        "fct_falhas_diarias": "daily",
    }

    def row(model: str, test: str, column: str, count: str) -> str:
        return f"SELECT '{model}' AS modelo, '{test}' AS teste, '{column}' AS coluna, {count} AS violacoes"

    out = []
    for model, columns in checks.NOT_NULL.items():
        for c in columns:
            n = f"(SELECT count(*) FROM {alias.get(model, model)} WHERE {c} IS NULL)"
            out.append(row(model, "not_null", c, n))
    for model, (c, values) in checks.ACCEPTED.items():
        n = f"(SELECT count(*) FROM {alias.get(model, model)} WHERE {c} NOT IN {_list(values)})"
        out.append(row(model, "accepted_values", c, n))
    for model, c in checks.UNIQUE:
        grouped = f"SELECT {c} FROM {alias.get(model, model)} GROUP BY {c} HAVING count(*) > 1"
        out.append(row(model, "unique", c, f"(SELECT count(*) FROM ({grouped}))"))
    for model, c, parent in checks.REFERENCES:
        held = f"SELECT DISTINCT {c} FROM {alias.get(model, model)}"
        n = f"(SELECT count(*) FROM ({held}) WHERE {c} NOT IN (SELECT {c} FROM {alias.get(parent, parent)}))"
        out.append(row(model, "relationships", c, n))
    for expected, actual in checks.PARITY:
        counts = [f"(SELECT count(*) FROM {alias.get(x, x)})" for x in (expected, actual)]
        out.append(row(actual, "row_parity", expected, f"CAST({counts[0]} <> {counts[1]} AS BIGINT)"))
    for model, least in (("fct_leituras", C.MIN_READINGS), ("fct_falhas_diarias", C.MIN_DAILY_ROWS)):
        n = f"CAST((SELECT count(*) FROM {alias[model]}) < {least} AS BIGINT)"
        out.append(row(model, "min_volume", "", n))
    years = "SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1"
    drop = (
        f"(SELECT count(*) FROM ({years}) a, ({years}) b WHERE a.y = (SELECT max(year(o_orderdate)) FROM orders)"
        f" AND b.y = (SELECT max(year(o_orderdate)) FROM orders WHERE year(o_orderdate) < a.y) AND a.n < b.n * 0.9)"
    )
    out.append(row("cargas", "volume_drop", "total_leituras", drop))
    return _models() + " UNION ALL ".join(out)


#: Results whose order counts: the rows are compared in it. Without keys the statement is in order itself.
ORDERED = {
    "rate_by_group": "fonte, tipo_produto",
    "rank_share": "posicao, maquina_id",
    "first_moving_averages": "ts",
    "jump_topk": "",
    "jump_topk_of_prefix": "",
    "mode_rank_in_key": "maquina_id, posicao_na_maquina",
    "mean_time_between_events": "tempo_medio_s, maquina_id",
    "ntile_rate": "quartil_desgaste",
    "daily_running_total": "dia",
    "totals_by_source": "total_falhas DESC, id_maquina",
    "totals_of_one_source": "total_falhas DESC, id_maquina",
    "daily_by_source": "data_ref, id_maquina",
    "sample_topn": "houve_falha DESC, medido_em DESC, id_leitura",
    "daily_series": "data_ref",
    "mode_distribution": "ocorrencias DESC, modo",
}


def oracle() -> dict[str, str]:
    return {
        name: f"SELECT * FROM ({sql}) ORDER BY {ORDERED[name]}" if ORDERED.get(name) else sql
        for name, sql in _statements().items()
    }


def _statements() -> dict[str, str]:
    clean, model, merged = _cleaning(), _models(), _merged()
    series, readings, machines = S.in_sql(S.SERIES), S.in_sql(S.READINGS), S.in_sql(S.MACHINES)
    raw_columns = ", ".join(f'"{c}"' for c in C.RAW_COLUMNS)
    raw = f"({S.in_sql(S.RAW)})"
    latest = "SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 2"
    modes = "SELECT DISTINCT l_orderkey AS leitura_id, l_returnflag AS modo FROM lineitem"
    ai4i = f"""
        SELECT 'ai4i' AS fonte, 'AI4I-' || lpad(CAST((CAST("UDI" AS BIGINT) - 1) % 10 + 1 AS VARCHAR), 2, '0') AS maquina_id,
               strftime(TIMESTAMP '2020-01-01 00:00:00' + to_minutes(10 * ((CAST("UDI" AS BIGINT) - 1) // 10)),
                        '%Y-%m-%d %H:%M:%S') AS "timestamp",
               "Type" AS tipo, "Air temperature [K]" AS temp_ar_k, "Process temperature [K]" AS temp_processo_k,
               "Rotational speed [rpm]" AS rotacao_rpm, "Torque [Nm]" AS torque_nm, "Tool wear [min]" AS desgaste_min,
               "Machine failure" AS falha,
               nullif(concat_ws('|', CASE WHEN "TWF" = '1' THEN 'TWF' END, CASE WHEN "HDF" = '1' THEN 'HDF' END,
                                CASE WHEN "PWF" = '1' THEN 'PWF' END, CASE WHEN "OSF" = '1' THEN 'OSF' END,
                                CASE WHEN "RNF" = '1' THEN 'RNF' END), '') AS modo_falha
        FROM ({S.in_sql(S.AI4I)})"""

    def jumps(prefix: str, k: int) -> str:
        return f"""SELECT maquina_id, ts, torque_nm, CAST(round(d, 1) AS DECIMAL(28,1)) AS delta FROM (
            SELECT *, CAST(torque_nm AS DECIMAL(28,10)) - CAST(lag(torque_nm) OVER (PARTITION BY maquina_id ORDER BY ts)
            AS DECIMAL(28,10)) AS d FROM ({series}) WHERE maquina_id LIKE '{prefix}%')
            WHERE abs(d) > 25 ORDER BY abs(d) DESC, maquina_id, ts LIMIT {k}"""

    def moving(rows: str) -> str:
        """The mean in integers: units of 1e-10 from the value's text, then cents half away from zero."""
        units = "CAST(replace(CAST(CAST(CAST(temp_processo_k AS VARCHAR) AS DECIMAL(28,10)) AS VARCHAR), '.', '') AS HUGEINT)"
        return f"""
        SELECT maquina_id, ts, temp_processo_k,
               sign(s) * CAST((2 * abs(s) + n * 100000000) // (2 * n * 100000000) AS DOUBLE) / 100 AS media_movel
        FROM (SELECT *, sum({units}) OVER w AS s, count(*) OVER w AS n
              FROM ({rows})
              WINDOW w AS (PARTITION BY maquina_id ORDER BY ts ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))"""

    sums = """
        SELECT 'linhas' AS secao, 'entrada' AS chave, count(*) AS n FROM m
        UNION ALL SELECT 'linhas', 'validas', count(*) FILTER (WHERE motivo IS NULL) FROM m
        UNION ALL SELECT 'linhas', 'descartadas', count(motivo) FROM m
        UNION ALL SELECT 'avisos', 'modo_ignorado_sem_falha',
                         count(*) FILTER (WHERE motivo IS NULL AND s_falha = '0' AND coalesce(s_modo_falha, '') <> '') FROM m
        UNION ALL SELECT 'avisos', 'falhas_sem_modo_informado', count(*) FILTER (WHERE modo = 'DESCONHECIDO') FROM modes
        UNION ALL SELECT 'falhas', 'leituras_com_falha', count(*) FILTER (WHERE falha) FROM ok
        UNION ALL SELECT 'falhas', 'registros_de_falha', count(*) FROM modes
        UNION ALL SELECT 'entrada_por_fonte', s_fonte, count(*) FROM m WHERE s_fonte IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'validas_por_fonte', s_fonte, count(*) FILTER (WHERE motivo IS NULL) FROM m
                  WHERE s_fonte IS NOT NULL GROUP BY 2
        """ + "".join(
        f" UNION ALL SELECT 'descartadas_por_motivo', '{r}', count(*) FILTER (WHERE motivo = '{r}') FROM m"
        for r in C.REASONS
    )

    def total(section: str, key: str) -> str:
        return f"(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM report WHERE secao = '{section}' AND chave = '{key}')"

    def block(section: str, keys: list[str]) -> str:
        return f"'{section}': {{{', '.join(f"'{k}': {total(section, k)}" for k in keys)}}}"

    totals = ", ".join(
        [
            *[f"'linhas_{k}': {total('linhas', k)}" for k in ("entrada", "validas", "descartadas")],
            block("descartadas_por_motivo", C.REASONS),
            block("avisos", ["modo_ignorado_sem_falha", "falhas_sem_modo_informado"]),
            *[f"'{k}': {total('falhas', k)}" for k in ("leituras_com_falha", "registros_de_falha")],
        ]
    )
    n_ok, n_modes = "(SELECT count(*) FROM ok)", "(SELECT count(*) FROM modes)"
    n_machines = "(SELECT count(DISTINCT maquina_id) FROM ok)"
    modes_of_orders = S.in_sql(S.MODES_OF_ORDERS)
    violations = " UNION ALL ".join(
        [
            *[
                f"SELECT '{c}_nulo' AS regra, count(*) FILTER (WHERE {c} IS NULL) AS n FROM v"
                for c in [*C.NATURAL_KEY, "fonte", *C.VALUE_COLUMNS]
            ],
            *[
                f"SELECT '{c}_fora_da_faixa', count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) FROM v"
                for c, (lo, hi) in C.RANGES.items()
            ],
            f"SELECT 'tipo_produto_invalido', count(*) FILTER (WHERE tipo_produto NOT IN {_list(C.PRODUCT_TYPES)}) FROM v",
            f"SELECT 'fonte_invalida', count(*) FILTER (WHERE fonte NOT IN {_list(C.VALID_SOURCES)}) FROM v",
            f"SELECT 'modo_invalido', count(*) FROM ({modes_of_orders}) WHERE modo NOT IN {_list(C.MODE_DOMAIN)}",
            f"SELECT 'falha_repetida', count(*) FROM (SELECT maquina_id, ts, modo FROM ({modes_of_orders}) GROUP BY ALL HAVING count(*) > 1)",
            f"SELECT 'falha_sem_leitura', count(*) FROM ({modes_of_orders}) m WHERE NOT EXISTS"
            " (SELECT 1 FROM v WHERE v.maquina_id = m.maquina_id AND v.ts = m.ts)",
            "SELECT 'chave_repetida', count(*) FROM (SELECT maquina_id, ts FROM v GROUP BY ALL HAVING count(*) > 1)",
            "SELECT 'maquina_com_duas_fontes', count(*) FROM (SELECT maquina_id FROM (SELECT DISTINCT maquina_id, fonte FROM v)"
            " GROUP BY 1 HAVING count(*) > 1)",
        ]
    )
    published = f"""
    {clean},
    leituras AS (SELECT row_number() OVER (ORDER BY maquina_id, ts) AS leitura_id, maquina_id, ts, tipo_produto, temp_ar_k,
                        temp_processo_k, CAST(rotacao_rpm AS INTEGER) AS rotacao_rpm, torque_nm,
                        CAST(desgaste_min AS INTEGER) AS desgaste_min, falha FROM ok),
    falhas AS (SELECT row_number() OVER (ORDER BY g.maquina_id, g.ts, g.modo) AS falha_id, l.leitura_id, g.modo,
                      g.maquina_id, g.ts FROM modes g JOIN leituras l ON l.maquina_id = g.maquina_id AND l.ts = g.ts)
    """
    flow = f"""
    {published},
    stg_maquinas AS (SELECT maquina_id AS id_maquina, min(fonte) AS fonte, CAST(NULL AS TIMESTAMP) AS criada_em FROM ok GROUP BY 1),
    stg_leituras AS (SELECT leitura_id AS id_leitura, maquina_id AS id_maquina, ts AS medido_em, tipo_produto,
                            {_celsius('temp_ar_k')} AS temperatura_ar_c, {_celsius('temp_processo_k')} AS temperatura_processo_c,
                            rotacao_rpm, torque_nm, desgaste_min, falha AS houve_falha FROM leituras),
    stg_falhas AS (SELECT falha_id AS id_falha, leitura_id AS id_leitura, modo AS modo_falha FROM falhas),
    {_marts()}
    """
    return {
        "clean_reason_counts": f"{clean} SELECT motivo, count(*) AS n FROM m GROUP BY motivo",
        "clean_accepted": f"{clean} SELECT * FROM ok",
        "clean_rejected": f"{clean} SELECT {raw_columns}, motivo FROM m WHERE motivo IS NOT NULL",
        "modes_exploded": f"{clean} SELECT * FROM modes",
        "audit_report": clean + sums,
        "audit_document": f"""{clean}, report AS ({sums})
            SELECT CAST(to_json({{{totals}}}) AS VARCHAR) AS value
            UNION ALL SELECT CAST(to_json({{'fonte': chave, 'entrada': CAST(sum(n) FILTER (WHERE secao = 'entrada_por_fonte') AS BIGINT),
                'validas': CAST(sum(n) FILTER (WHERE secao = 'validas_por_fonte') AS BIGINT)}}) AS VARCHAR)
            FROM report WHERE secao LIKE '%_por_fonte' GROUP BY chave""",
        "accounting_by_source": f"""{clean} SELECT s_fonte AS fonte, count(*) AS entrada,
            count(*) FILTER (WHERE motivo IS NULL) AS validas, count(motivo) AS descartadas FROM m GROUP BY 1""",
        "dedup_keep_first": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, chegada FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY chegada) AS r
            FROM (SELECT *, {S.RAW[1]['chegada']} AS chegada FROM lineitem)) WHERE r = 1""",
        "csv_export_lines": f"""{clean} SELECT concat_ws(',', maquina_id, fonte, strftime(ts, '%Y-%m-%d %H:%M:%S'), tipo_produto,
            CAST(temp_ar_k AS VARCHAR), CAST(temp_processo_k AS VARCHAR), CAST(rotacao_rpm AS VARCHAR), CAST(torque_nm AS VARCHAR),
            CAST(desgaste_min AS VARCHAR), CASE WHEN falha THEN 't' ELSE 'f' END) AS linha FROM ok""",
        "ai4i_mapping": ai4i,
        "union_sources": f"""SELECT {raw_columns} FROM ({ai4i}) UNION ALL SELECT {raw_columns} FROM {raw}""",
        "raw_roundtrip": f"SELECT * FROM {raw}",
        "clean_layer_order": f"""{clean} SELECT 'leituras' AS tabela, {n_ok} AS linhas, 0 AS fora_de_ordem
            UNION ALL SELECT 'falhas', {n_modes}, 0""",
        "raw_written_elsewhere": f"""SELECT * EXCLUDE (chegada, d), row_number() OVER (PARTITION BY d, maquina_id ORDER BY chegada) AS posicao
            FROM (SELECT * REPLACE (nullif(maquina_id, '') AS maquina_id), coalesce(CASE WHEN length("timestamp") >= 10
                  THEN substring("timestamp", 1, 10) END, 'sem_data') AS d FROM {raw})""",
        "csv_quoted_breaks": f"""SELECT k, nullif(nota, 'NA') AS nota, row_number() OVER (PARTITION BY trecho ORDER BY CAST(k AS BIGINT)) - 1 AS posicao, trecho
            FROM ({S.in_sql(S.NOTES)}), (VALUES (300000), (8000000)) t(trecho)""",
        "raw_partitions": f"""SELECT count(*) AS particoes FROM (SELECT DISTINCT
            CASE WHEN length(substring("timestamp", 1, 10)) = 10 THEN substring("timestamp", 1, 10) ELSE 'sem_data' END AS data,
            coalesce(nullif(maquina_id, ''), 'sem_maquina') AS maquina FROM {raw})""",
        "rate_by_group": f"""SELECT m.fonte, l.tipo_produto, count(*) AS leituras, count(*) FILTER (WHERE l.falha) AS falhas,
            {_percent('count(*) FILTER (WHERE l.falha)', 'count(*)')} AS taxa_falha_pct
            FROM ({readings}) l JOIN ({machines}) m USING (maquina_id) GROUP BY 1, 2""",
        "rank_share": f"""WITH g AS (SELECT maquina_id, count(*) AS leituras, count(*) FILTER (WHERE falha) AS falhas
            FROM ({series}) GROUP BY 1)
            SELECT maquina_id, leituras, falhas, {_percent('falhas', 'leituras')} AS taxa_falha_pct,
            rank() OVER (ORDER BY falhas DESC) AS posicao,
            {_percent('falhas', 'CAST((SELECT sum(falhas) FROM g) AS BIGINT)', 1)} AS pct_das_falhas_totais FROM g""",
        "moving_avg_12": moving(series),
        "moving_avg_12_hot_series": moving(series),
        "moving_avg_one_series": moving(S.in_sql(S.ONE_SERIES)),
        "moving_avg_wide_values": moving(S.in_sql(S.WIDE_SERIES)),
        "first_moving_averages": f"""SELECT *, row_number() OVER (ORDER BY ts) AS posicao FROM ({moving(series)})
            WHERE maquina_id = 'U-7' ORDER BY ts LIMIT 50""",
        "csv_arrival_order": f"""SELECT maquina_id, "timestamp",
            row_number() OVER (ORDER BY CASE WHEN udi % 10 = 7 THEN 1 ELSE 2 END, udi) - 1 AS posicao
            FROM (SELECT 'AI4I-' || lpad(CAST((o_orderkey) % 10 + 1 AS VARCHAR), 2, '0') AS maquina_id, o_orderkey + 1 AS udi,
                  strftime(TIMESTAMP '2020-01-01 00:00:00' + to_minutes(10 * (o_orderkey // 10)), '%Y-%m-%d %H:%M:%S') AS "timestamp"
                  FROM orders)""",
        "jump_topk": jumps("U-", 20),
        "jump_topk_of_prefix": jumps("U-1", 50),
        "mode_rank_in_key": f"""WITH g AS (SELECT l.maquina_id, f.modo, count(*) AS ocorrencias
            FROM ({S.in_sql(S.SERIES_MODES)}) f JOIN ({series}) l USING (leitura_id) GROUP BY 1, 2)
            SELECT *, row_number() OVER (PARTITION BY maquina_id ORDER BY ocorrencias DESC, modo) AS posicao_na_maquina FROM g""",
        "mean_time_between_events": f"""SELECT maquina_id, count(g) AS intervalos,
            CAST(sum(g) AS DOUBLE) / count(g) / 1e6 AS tempo_medio_s, CAST(min(g) AS DOUBLE) / 1e6 AS menor_intervalo_s FROM (
            SELECT maquina_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY maquina_id ORDER BY ts)) AS g
            FROM ({series}) WHERE falha) GROUP BY 1 HAVING count(g) > 0""",
        "ntile_rate": f"""SELECT q AS quartil_desgaste, min(desgaste_min) AS desgaste_min_do_quartil,
            max(desgaste_min) AS desgaste_max_do_quartil, count(*) AS leituras,
            {_percent('count(*) FILTER (WHERE falha)', 'count(*)')} AS taxa_falha_pct FROM (
            SELECT *, ntile(4) OVER (ORDER BY desgaste_min, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS q
            FROM ({S.in_sql(S.WEAR)})) GROUP BY 1""",
        "ntile_buckets": "SELECT event_id, value, ntile(7) OVER (ORDER BY value, event_id) AS faixa FROM events",
        "daily_running_total": f"""WITH d AS (SELECT CAST(ts AS DATE) AS dia, count(*) FILTER (WHERE falha) AS falhas
            FROM ({series}) WHERE maquina_id LIKE 'U-%' GROUP BY 1)
            SELECT dia, falhas, CAST(sum(falhas) OVER (ORDER BY dia) AS BIGINT) AS falhas_acumuladas FROM d""",
        "staging_machines": f"{model} SELECT * FROM stg_maquinas",
        "staging_readings": f"{model} SELECT * FROM stg_leituras",
        "staging_failures": f"{model} SELECT * FROM stg_falhas",
        "unit_conversion": f"SELECT event_id, {_celsius('value')} AS celsius FROM events",
        "enriched_no_fanout": f"{model} SELECT * FROM enriched",
        "dim_totals": f"{model} SELECT * FROM dim",
        "fact_projection": f"{model} SELECT * FROM fact",
        "daily_fact_distinct_modes": f"{model} SELECT * FROM daily",
        "source_totals": f"""{model} SELECT d.fonte, count(*) AS leituras, count(*) FILTER (WHERE f.houve_falha) AS falhas
            FROM fact f JOIN dim d USING (id_maquina) GROUP BY 1""",
        "mart_totals": f"""{model} SELECT count(*) AS n_dias_maquina, CAST(sum(qtd_falhas) AS BIGINT) AS soma_falhas FROM daily""",
        "multi_mode_readings": f"{model} SELECT id_leitura, modos_falha, qtd_modos_falha FROM enriched WHERE qtd_modos_falha > 1",
        "totals_by_source": f"{model} SELECT * FROM dim",
        "totals_of_one_source": f"{model} SELECT * FROM dim WHERE fonte IN ('ai4i')",
        "daily_by_source": f"""{model} SELECT f.id_maquina, d.fonte, f.data_ref, f.qtd_falhas, f.modos_falha
            FROM daily f JOIN dim d USING (id_maquina)""",
        "sample_topn": f"""{model} SELECT f.*, d.fonte FROM fact f JOIN dim d USING (id_maquina)
            ORDER BY f.houve_falha DESC, f.medido_em DESC, f.id_leitura LIMIT 200""",
        "kpis": f"""{model} SELECT count(*) AS maquinas, CAST(sum(total_leituras) AS BIGINT) AS leituras,
            CAST(sum(total_falhas) AS BIGINT) AS falhas,
            {_percent('CAST(sum(total_falhas) AS BIGINT)', 'CAST(sum(total_leituras) AS BIGINT)')} AS taxa_falha_pct FROM dim""",
        "daily_series": f"""{model} SELECT data_ref, CAST(sum(qtd_falhas) AS BIGINT) AS qtd_falhas FROM daily GROUP BY 1""",
        "mode_distribution": f"""{model} SELECT modo, count(*) AS ocorrencias FROM (
            SELECT DISTINCT id_maquina, data_ref, trim(unnest(regexp_split_to_array(modos_falha, '[;,]'))) AS modo FROM daily)
            WHERE modo <> '' GROUP BY 1""",
        "rule_labels": f"""SELECT leitura_id, modo_falha, modo_falha IS NOT NULL AS falha FROM (
            SELECT leitura_id, nullif(concat_ws('|',
                CASE WHEN temp_processo_k - temp_ar_k < 8.6::DOUBLE AND rotacao_rpm < 1380 THEN 'HDF' END,
                CASE WHEN torque_nm * rotacao_rpm * 2 * pi() / 60 < 3500 OR torque_nm * rotacao_rpm * 2 * pi() / 60 > 9000 THEN 'PWF' END,
                CASE WHEN desgaste_min * torque_nm > CASE tipo_produto WHEN 'L' THEN 11000 WHEN 'M' THEN 12000 WHEN 'H' THEN 13000 END
                     THEN 'OSF' END), '') AS modo_falha FROM ({readings}))""",
        "upsert_actions": f"{merged} SELECT acao, count(*) AS n FROM merged GROUP BY 1",
        "upsert_counts": f"""{merged} SELECT count(*) FILTER (WHERE acao = 'insert') AS inseridas,
            count(*) FILTER (WHERE acao = 'update') AS atualizadas, count(*) AS total FROM merged""",
        "upsert_result": f"{merged} SELECT * FROM merged",
        "upsert_second_run": f"""{merged} SELECT CASE WHEN acao = 'keep' THEN 'keep' ELSE 'same' END AS acao, count(*) AS n
            FROM merged GROUP BY 1""",
        "insert_if_absent": """SELECT o_custkey AS chave, min(o_orderpriority) AS fonte FROM orders
            WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1""",
        "obsolete_removed": f"""{modes} WHERE l_orderkey IN (SELECT o_orderkey FROM orders
            WHERE {S.LATER_WHERE.format(ntz='timestamp')}) EXCEPT {modes} WHERE l_linestatus = 'O'""",
        "new_failure_modes": f"{modes} WHERE l_linestatus = 'O' EXCEPT {modes} WHERE l_linestatus = 'F'",
        "surrogate_ids": """SELECT o_custkey, o_orderdate, o_orderkey,
            1000 + row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS leitura_id FROM orders""",
        "contract_violations": f"""WITH v AS (SELECT *, CASE WHEN falha THEN 'ai4i' WHEN desgaste_min > 0 THEN 'outra' END AS fonte
            FROM ({readings})) {violations}""",
        "load_changes": f"""{clean} SELECT 1 AS carga, {n_machines} AS maquinas_novas, {n_ok} AS leituras_inseridas,
            0 AS leituras_atualizadas, {n_modes} AS falhas_inseridas, 0 AS falhas_removidas
            UNION ALL SELECT 2, 0, 0, 0, 0, 0
            UNION ALL SELECT 3, 0, 0, (SELECT count(*) FROM ok WHERE tipo_produto = 'H'), 0,
                             (SELECT count(*) FROM modes WHERE modo = 'PWF')""",
        "load_ids_not_reused": f"""{clean}, first AS (SELECT *, row_number() OVER (ORDER BY maquina_id, ts, modo) AS falha_id FROM modes)
            SELECT falha_id, maquina_id, ts, modo FROM first WHERE modo <> 'PWF'
            UNION ALL SELECT {n_modes} + row_number() OVER (ORDER BY maquina_id, ts), maquina_id, ts, modo FROM modes WHERE modo = 'PWF'""",
        "load_partitions_written": f"""{clean}, per_day AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM ok GROUP BY 1),
            days AS (SELECT (SELECT count(*) FROM per_day) AS r, (SELECT count(DISTINCT CAST(ts AS DATE)) FROM modes) AS f)
            SELECT 1 AS carga, 'maquinas' AS tabela, 1 AS escritas, 0 AS mantidas, {n_machines} AS linhas
            UNION ALL SELECT 1, 'leituras', r, 0, {n_ok} FROM days UNION ALL SELECT 1, 'falhas', f, 0, {n_modes} FROM days
            UNION ALL SELECT c, 'maquinas', 0, 1, 0 FROM range(2, 4) t(c)
            UNION ALL SELECT c, 'falhas', 0, f, 0 FROM days, range(2, 4) t(c)
            UNION ALL SELECT 2, 'leituras', 0, r, 0 FROM days
            UNION ALL SELECT 3, 'leituras', 1, r - 1, (SELECT n FROM per_day ORDER BY d LIMIT 1) FROM days""",
        "load_two_writers": f"""{clean} SELECT 'cargas' AS tabela, 2 AS n, 2 AS ids UNION ALL SELECT 'maquinas', {n_machines}, {n_machines}
            UNION ALL SELECT 'leituras', {n_ok}, {n_ok} UNION ALL SELECT 'falhas', {n_modes}, {n_modes}""",
        "load_instants": f"""{clean}, t AS (SELECT epoch_us(TIMESTAMP '2026-01-01 00:00:00') AS us)
            SELECT maquina_id AS chave, us AS instante_us FROM (SELECT DISTINCT maquina_id FROM ok), t
            UNION ALL SELECT '1', us FROM t UNION ALL SELECT '2', us + 86400000000 FROM t""",
        "history_row": f"""{clean} SELECT 1 AS carga_id, {n_ok} AS leituras_inseridas, 0 AS leituras_atualizadas, {n_ok} AS total_leituras
            UNION ALL SELECT 2, 0, 0, {n_ok}""",
        "table_totals": f"""{clean} SELECT 'maquinas' AS tabela, {n_machines} AS n UNION ALL SELECT 'leituras', {n_ok}
            UNION ALL SELECT 'falhas', {n_modes}""",
        "published_readings": f"{published} SELECT * FROM leituras",
        "published_failures": f"{published} SELECT * FROM falhas",
        "whole_flow_daily_fact": f"{flow} SELECT * FROM daily",
        "marts_by_day": f"""{flow} SELECT * REPLACE (CASE WHEN CAST(medido_em AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM ok)
            THEN torque_nm + 0.5 ELSE torque_nm END AS torque_nm) FROM fact""",
        "marts_by_day_totals": f"{flow} SELECT id_maquina, fonte, total_leituras, total_falhas FROM dim",
        "marts_days_made": f"""{clean} SELECT 1 AS construcao, count(DISTINCT CAST(ts AS DATE)) AS dias FROM ok
            UNION ALL SELECT 2, 0 UNION ALL SELECT 3, 1""",
        "dq_suite_by_day": " UNION ALL ".join(
            f"SELECT '{model}' AS modelo, '{test}' AS teste, '{column}' AS coluna, 0 AS violacoes"
            for model, test, column in [
                *[(m, "not_null", c) for m, columns in checks.NOT_NULL.items() for c in columns],
                *[(m, "accepted_values", c) for m, (c, _) in checks.ACCEPTED.items()],
                *[(m, "unique", c) for m, c in checks.UNIQUE],
                *[(m, "relationships", c) for m, c, _ in checks.REFERENCES],
                *[(actual, "row_parity", expected) for expected, actual in checks.PARITY],
                ("fct_leituras", "min_volume", ""), ("fct_falhas_diarias", "min_volume", ""), ("cargas", "volume_drop", "total_leituras"),
            ]
        ),
        "dq_unique": "SELECT l_orderkey, count(*) AS n_registros FROM lineitem GROUP BY 1 HAVING count(*) > 1",
        "dq_composite_key": "SELECT l_orderkey, l_linenumber, count(*) AS n_registros FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
        "dq_not_null": " UNION ALL ".join(
            f"""SELECT '{c}' AS coluna, count(*) AS n FROM {raw} WHERE "{c}" IS NULL HAVING count(*) > 0""" for c in C.RAW_COLUMNS
        ),
        "dq_accepted_values": f"SELECT tipo, count(*) AS n_registros FROM {raw} WHERE tipo NOT IN {_list(C.PRODUCT_TYPES)} GROUP BY 1",
        "dq_relationships": """SELECT o_orderkey, count(*) AS n_registros FROM orders
            WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""",
        "dq_row_parity": f"""SELECT * FROM (SELECT (SELECT count(*) FROM orders) AS qtd_esperada,
            (SELECT count(*) FROM ({modes})) AS qtd_obtida) WHERE qtd_esperada <> qtd_obtida""",
        "dq_min_volume": """SELECT count(*) AS linhas, 1000000000000 AS minimo_esperado FROM customer
            HAVING count(*) < 1000000000000""",
        "dq_drop": f"""SELECT b.n AS total_anterior, a.n AS total_atual FROM ({latest}) a JOIN ({latest}) b ON b.y < a.y
            WHERE a.n < b.n * 0.9""",
        "dq_latest_two": f"SELECT n AS total_leituras, row_number() OVER (ORDER BY y DESC) AS ordem FROM ({latest})",
        "dq_freshness": """SELECT age AS idade_s, CASE WHEN age > 172800 THEN 'error' WHEN age > 86400 THEN 'warn' ELSE 'pass' END AS situacao
            FROM (SELECT CAST(epoch(TIMESTAMP '2001-08-02 12:00:00') - epoch(max(o_orderdate)) AS BIGINT) AS age FROM orders)""",
        "dq_suite": _suite(),
    }
