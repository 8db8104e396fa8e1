"""Load, models, checks and the whole flow on the hand-written batches."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeflow import contract as C
from gaugeflow.operators import cleaning, quality
from gaugeflow.plans import checks, dashboard, flow, models
from gaugeflow.plans import marts as building
from gaugeflow.plans.load import ContractError, load, table_totals
from gaugeflow.sources import clean_layer, tables

from conftest import DEFECTS

NOW = dt.datetime(2031, 6, 1, 8, 30, tzinfo=dt.timezone.utc)


@pytest.fixture
def batch(spark, raw):
    """Three machines, six readings; P-8 fails twice, once with two modes, and P-9 once without a known mode."""
    classified = cleaning.classify(
        raw(
            *[{"timestamp": f"2031-05-20 06:{m}:00"} for m in (30, 40)],
            {"maquina_id": "P-8", "falha": "1", "modo_falha": "RNF|TWF"},
            {"maquina_id": "P-8", "timestamp": "2031-05-22 00:00:00", "falha": "1", "modo_falha": "RNF"},
            {"maquina_id": "P-9", "torque_nm": "71.5"},
            {"maquina_id": "P-9", "timestamp": "2031-05-20 06:30:01", "falha": "1"},
        )
    )
    return cleaning.readings(classified), cleaning.failures(classified)


def totals(spark, root):
    return {r.tabela: r.n for r in table_totals(spark, root).collect()}


def stored(spark, root, table):
    return sorted(tables.read_table(spark, root, table).collect(), key=str)


def test_load_twice_changes_nothing(spark, batch, tmp_path):
    root = str(tmp_path)
    assert list(load(spark, root, *batch, NOW).values()) == [3, 6, 0, 4, 0]
    assert totals(spark, root) == {"maquinas": 3, "leituras": 6, "falhas": 4}
    before = {t: stored(spark, root, t) for t in tables.SCHEMAS}
    later = NOW + dt.timedelta(days=3)
    assert not any(load(spark, root, *batch, later).values())
    assert {t: stored(spark, root, t) for t in tables.SCHEMAS} == before
    history = tables.read_history(spark, root).orderBy("carga_id").collect()
    assert [tuple(r)[2:] for r in history] == [(6, 0, 6), (0, 0, 6)]
    assert [r.carregado_em.timestamp() for r in history] == [NOW.timestamp(), later.timestamp()]
    assert {r.criada_em.timestamp() for r in before["maquinas"]} == {NOW.timestamp()}
    assert sorted(r.leitura_id for r in before["leituras"]) == list(range(1, 7))


def test_updates_keep_ids_and_new_rows_follow(spark, batch, tmp_path):
    root = str(tmp_path)
    readings, modes = batch
    load(spark, root, readings, modes, NOW)
    ids = {(r.maquina_id, r.ts): r.leitura_id for r in stored(spark, root, "leituras")}
    warmer = readings.withColumn("temp_ar_k", F.expr("if(maquina_id = 'P-9', temp_ar_k + 1.25D, temp_ar_k)"))
    earlier = readings.filter("maquina_id = 'P-7'").withColumn("ts", F.expr("ts - INTERVAL '400' DAY"))
    done = load(spark, root, warmer.union(earlier), modes, NOW)
    assert list(done.values()) == [0, 2, 2, 0, 0]
    now = {(r.maquina_id, r.ts): r for r in stored(spark, root, "leituras")}
    assert {k: now[k].leitura_id for k in ids} == ids
    assert sorted(r.leitura_id for r in now.values()) == list(range(1, 9))
    assert {r.temp_ar_k for k, r in now.items() if k[0] == "P-9"} == {296.4 + 1.25}


def test_ids_of_removed_failures_are_not_given_again(spark, batch, tmp_path):
    """Even when the last ones went, and a load without any change lies between."""
    root = str(tmp_path)
    readings, modes = batch
    load(spark, root, readings, modes, NOW)
    assert [r.falha_id for r in stored(spark, root, "falhas")] == [1, 2, 3, 4]
    few = modes.filter("maquina_id = 'P-8' AND modo = 'TWF'")
    assert load(spark, root, readings, few, NOW)["falhas_removidas"] == 3
    load(spark, root, readings, few, NOW)
    assert load(spark, root, readings, modes, NOW)["falhas_inseridas"] == 3
    found = sorted(r.falha_id for r in stored(spark, root, "falhas"))
    assert found[1:] == [5, 6, 7] and found[0] in (1, 2, 3, 4)


def test_rows_absent_from_the_batch_stay(spark, batch, tmp_path):
    root = str(tmp_path)
    readings, modes = batch
    load(spark, root, readings, modes, NOW)
    done = load(spark, root, readings.filter("maquina_id = 'P-8'"), modes.filter("modo = 'TWF'"), NOW)
    assert done["falhas_removidas"] == 2  # both RNF of P-8; the failure of P-9 is not in the batch's readings
    assert totals(spark, root) == {"maquinas": 3, "leituras": 6, "falhas": 2}


@pytest.mark.parametrize(
    ("change", "rule", "n"),
    [
        ("-0.5D AS torque_nm", "torque_nm_fora_da_faixa", 6),
        ("if(falha, NULL, rotacao_rpm) AS rotacao_rpm", "rotacao_rpm_nulo", 3),
        ("concat(fonte, '2') AS fonte", "fonte_invalida", 6),
        ("lower(tipo_produto) AS tipo_produto", "tipo_produto_invalido", 6),
        ("cast(date_trunc('DAY', ts) AS timestamp_ntz) AS ts", "chave_repetida", 2),
        ("if(ts > timestamp_ntz'2031-05-21 00:00:00', 'ai4i', fonte) AS fonte", "maquina_com_duas_fontes", 1),
        ("concat('X', maquina_id) AS maquina_id", "falha_sem_leitura", 4),
    ],
)
def test_a_broken_rule_rejects_the_whole_load(spark, batch, tmp_path, change, rule, n):
    readings, modes = batch
    column = change.split(" AS ")[-1]
    bad = readings.selectExpr(*[change if c == column else c for c in readings.columns])
    with pytest.raises(ContractError) as err:
        load(spark, str(tmp_path), bad, modes, NOW)
    assert err.value.broken[rule] == n
    assert totals(spark, str(tmp_path)) == {"maquinas": 0, "leituras": 0, "falhas": 0}


@pytest.mark.parametrize(
    ("change", "broken"),
    [("lower(modo)", {"modo_invalido": 4}), ("'HDF'", {"falha_repetida": 1}), ("NULL", {"modo_invalido": 4})],
)
def test_failures_that_break_a_rule(spark, batch, tmp_path, change, broken):
    readings, modes = batch
    with pytest.raises(ContractError) as err:
        load(spark, str(tmp_path), readings, modes.selectExpr("maquina_id", "ts", f"{change} AS modo"), NOW)
    assert err.value.broken == broken


def test_export_lines(spark, batch, tmp_path):
    readings, modes = batch
    out = str(tmp_path / "csv")
    clean_layer.export_csv(readings.filter("maquina_id = 'P-9'"), clean_layer.EXPORT_READINGS, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == [
        "P-9,simulado,2031-05-20 06:30:00,M,296.4,307.9,1720,71.5,84,f",
        "P-9,simulado,2031-05-20 06:30:01,M,296.4,307.9,1720,33.5,84,t",
    ]
    out = str(tmp_path / "modes")
    clean_layer.export_csv(modes.filter("modo = 'TWF'"), clean_layer.EXPORT_FAILURES, out)
    assert [r.value for r in spark.read.text(out).collect()] == ["P-8,2031-05-20 06:30:00,TWF"]


def test_order_of_stored_files(spark, tmp_path):
    """Rows swapped inside a file, and two files that changed places, are found; equal keys are in order."""
    path = tmp_path / "t"
    rows = spark.range(400).selectExpr("concat('P-', id div 100) AS maquina_id", "id div 2 AS ts")
    rows.repartitionByRange(4, "maquina_id", "ts").sortWithinPartitions("maquina_id", "ts").write.parquet(str(path))
    breaks = lambda: clean_layer.order_breaks(spark, str(path), ["maquina_id", "ts"]).collect()
    assert breaks() == []
    files = sorted(path.glob("part-*.parquet"))
    (path / "_x").write_bytes(files[1].read_bytes())
    files[1].write_bytes(files[2].read_bytes())
    files[2].write_bytes((path / "_x").read_bytes())
    for f in (files[1], files[2]):
        (path / f".{f.name}.crc").unlink()
    found = breaks()
    assert {r.arquivo.rpartition("/")[2] for r in found} == {files[2].name} or len(found) == 1 and found[0].posicao == 0
    rows.coalesce(1).sortWithinPartitions("ts", F.desc("maquina_id")).write.parquet(str(tmp_path / "u"))
    swapped = clean_layer.order_breaks(spark, str(tmp_path / "u"), ["ts", "maquina_id"]).collect()
    assert all(r.anterior.ts == r.atual.ts and r.anterior.maquina_id > r.atual.maquina_id for r in swapped)
    down = rows.coalesce(1).sortWithinPartitions(F.desc("ts"))
    down.write.parquet(str(tmp_path / "v"))
    assert len(clean_layer.order_breaks(spark, str(tmp_path / "v"), ["ts"]).collect()) == 199


def test_whole_flow(spark, mixed, raw, tmp_path):
    """Four good rows of conftest beside three of the other source."""
    path = str(tmp_path)
    other = raw(
        {"fonte": "ai4i", "maquina_id": "AI4I-04", "timestamp": "2031-05-20 01:00:00"},
        {"fonte": "ai4i", "maquina_id": "AI4I-04", "falha": "1", "modo_falha": "PWF"},
        {"fonte": "ai4i", "maquina_id": "AI4I-04", "timestamp": "2031-05-20 09:00:00", "falha": "1", "modo_falha": "PWF|HDF"},
    )
    bad = sum(map(len, DEFECTS.values()))
    summary = flow.run_etl(spark, {"ai4i": other, "simulado": mixed}, path, now=NOW)
    assert summary["limpeza"] == {"entrada": 7 + bad, "validas": 7, "descartadas": bad}
    assert (summary["carga"]["leituras_inseridas"], summary["carga"]["falhas_inseridas"]) == (7, 6)
    assert clean_layer.read_rejected(spark, f"{path}/limpo").count() == bad

    results = flow.build_marts(spark, path, now=NOW, min_readings=7).collect()
    assert len(results) == 56
    assert {r.violacoes for r in results} == {0}

    marts = building.read_marts(spark, f"{path}/marts")
    daily = {(r.id_maquina, str(r.data_ref)): (r.qtd_falhas, r.modos_falha) for r in marts["fct_falhas_diarias"].collect()}
    assert daily == {
        ("AI4I-04", "2031-05-20"): (2, "HDF, PWF; PWF"),
        ("P-8", "2031-05-20"): (1, "OSF, RNF"),
        ("P-9", "2031-05-20"): (1, "DESCONHECIDO"),
    }
    k = dashboard.kpis(marts["dim_maquina"]).collect()[0]
    assert (k.maquinas, k.leituras, k.falhas, k.taxa_falha_pct) == (4, 7, 4, 57.14)
    assert dashboard.machine_totals(marts["dim_maquina"], ["simulado"]).count() == 3
    sample = dashboard.reading_sample(marts["fct_leituras"], marts["dim_maquina"], limit=3).collect()
    assert [(r.id_maquina, r.houve_falha) for r in sample] == [("AI4I-04", True), ("AI4I-04", True), ("P-8", True)]

    with pytest.raises(checks.QualityError, match="min_volume"):
        flow.build_marts(spark, path, now=NOW)
    assert building.read_marts(spark, f"{path}/marts")["fct_leituras"].inputFiles() == marts["fct_leituras"].inputFiles()
    flow.build_marts(spark, path, now=NOW, min_readings=7, keep=1, full=True)
    newest = building.read_marts(spark, f"{path}/marts")
    assert newest["fct_leituras"].count() == 7 and newest["fct_leituras"].inputFiles() != marts["fct_leituras"].inputFiles()
    assert not any(Path(f.removeprefix("file://")).exists() for f in marts["fct_leituras"].inputFiles())
    with pytest.raises(checks.QualityError, match="stale"):
        flow.build_marts(spark, path, now=NOW + dt.timedelta(hours=49))


def files_of(tmp_path, table):
    return {p for p in tmp_path.glob(f"v*/{table}/**/*.parquet")}


def test_a_load_writes_only_the_days_it_changes(spark, batch, tmp_path):
    """Days: 2031-05-20 (five readings, three failures) and 2031-05-22 (one of each)."""
    root = str(tmp_path)
    readings, modes = batch
    load(spark, root, readings, modes, NOW)
    first = {t: files_of(tmp_path, t) for t in tables.SCHEMAS}
    assert {p.parent.name for p in first["leituras"]} == {"dia=2031-05-20", "dia=2031-05-22"}
    load(spark, root, readings, modes, NOW)
    assert {t: files_of(tmp_path, t) for t in tables.SCHEMAS} == first
    late = readings.filter("ts > timestamp_ntz'2031-05-21 00:00:00'")
    warmer = late.withColumn("torque_nm", F.lit(12.5))
    assert load(spark, root, warmer, modes.join(late, C.NATURAL_KEY, "left_semi"), NOW)["leituras_atualizadas"] == 1
    added = {t: files_of(tmp_path, t) - first[t] for t in tables.SCHEMAS}
    assert {t: [p.parent.name for p in found] for t, found in added.items()} == {
        "maquinas": [], "leituras": ["dia=2031-05-22"], "falhas": [],
    }
    state = tables.current(spark, root)
    assert {d: p.folder[:7] for d, p in state.parts["leituras"].items()} == {"2031-05-20": "v000001", "2031-05-22": "v000003"}
    assert totals(spark, root) == {t: tables.read_table(spark, root, t).count() for t in tables.SCHEMAS}
    plan = tables.read_parts(spark, root, state, "leituras", ["2031-05-22"]).inputFiles()
    assert len(plan) == 1 and "v000003" in plan[0]


def test_a_day_whose_failures_all_went(spark, batch, tmp_path):
    root = str(tmp_path)
    readings, modes = batch
    load(spark, root, readings, modes, NOW)
    done = load(spark, root, readings, modes.filter("ts < timestamp_ntz'2031-05-21 00:00:00'"), NOW)
    assert list(done.values()) == [0, 0, 0, 0, 1]
    assert set(tables.current(spark, root).parts["falhas"]) == {"2031-05-20"}
    assert totals(spark, root)["falhas"] == tables.read_table(spark, root, "falhas").count() == 3
    load(spark, root, readings, modes.limit(0), NOW)
    assert tables.read_table(spark, root, "falhas").collect() == [] and totals(spark, root)["falhas"] == 0


def test_the_later_of_two_writers_starts_over(spark, batch, tmp_path, monkeypatch):
    """Both start from no version; the one that commits second merges into what the first has published."""
    root, publish, others = str(tmp_path), tables.publish, []
    readings, modes = batch

    def interrupted(*args):
        if not others:
            others.append(True)
            load(spark, root, readings.filter("maquina_id <> 'P-9'"), modes.filter("maquina_id <> 'P-9'"), NOW)
        publish(*args)

    monkeypatch.setattr(tables, "publish", interrupted)
    done = load(spark, root, readings, modes, NOW)
    assert list(done.values()) == [1, 2, 0, 1, 0]  # only P-9 is new by then
    assert totals(spark, root) == {"maquinas": 3, "leituras": 6, "falhas": 4}
    assert sorted(r.leitura_id for r in stored(spark, root, "leituras")) == list(range(1, 7))
    assert sorted(r.falha_id for r in stored(spark, root, "falhas")) == list(range(1, 5))
    assert [r.carga_id for r in tables.read_history(spark, root).orderBy("carga_id").collect()] == [1, 2]
    assert tables.unpublished(spark, root, dt.timedelta(0)) == []  # what the refused attempt wrote is gone
    others.clear()
    with pytest.raises(tables.Conflict):
        load(spark, root, readings.filter("maquina_id = 'P-7'"), modes.limit(0), NOW, attempts=1)


def test_a_commit_is_created_once(spark, tmp_path):
    file = str(tmp_path / "cargas" / "1.json")
    assert tables.create_once(spark, file, "a") and not tables.create_once(spark, file, "b")
    assert Path(file).read_text() == "a" and [p.name for p in Path(file).parent.iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_a_commit_is_created_once_in_a_store_that_only_spark_reads(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./m", tmp_path.as_uri())
    file = "viewfs://store/m/cargas/1.json"
    assert tables.create_once(spark, file, "a") and not tables.create_once(spark, file, "b")
    assert tables.read_text(spark, file) == (tmp_path / "cargas" / "1.json").read_text() == "a"


def test_leftovers_are_found_and_removed(spark, batch, tmp_path, monkeypatch):
    root = str(tmp_path)
    load(spark, root, *batch, NOW)
    monkeypatch.setattr(tables, "discard", lambda *args: None)  # a writer that was killed
    monkeypatch.setattr(tables, "publish", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load(spark, root, batch[0].withColumn("torque_nm", F.lit(3.5)), batch[1], NOW)
    monkeypatch.undo()
    assert tables.unpublished(spark, root) == []  # too young to be a leftover
    found = tables.remove_unpublished(spark, root, dt.timedelta(0))
    assert [v[:7] for v in found] == ["v000002"] and [p.name[:7] for p in tmp_path.glob("v*")] == ["v000001"]
    assert totals(spark, root) == {"maquinas": 3, "leituras": 6, "falhas": 4}


def test_old_versions_go(spark, batch, tmp_path):
    """Files that a kept version refers to stay, whichever version wrote them."""
    root = str(tmp_path)
    readings, modes = batch
    for i in range(3):
        day = "2031-05-22" if i else "2031-05-20"
        load(spark, root, readings.withColumn("torque_nm", F.expr(f"if(cast(ts AS date) = date'{day}', {i}.5D, torque_nm)")), modes, NOW)
    with pytest.raises(ValueError):
        tables.remove_old(spark, root, 0)
    written = [{p.parts[-4][:7] + p.parent.name for p in files_of(tmp_path, "leituras")}]
    tables.remove_old(spark, root, 1)
    tables.remove_old(spark, root, 1)
    written.append({p.parts[-4][:7] + p.parent.name for p in files_of(tmp_path, "leituras")})
    held = {p.folder[:7] + f"dia={d}" for d, p in tables.current(spark, root).parts["leituras"].items()}
    assert written[1] == held < written[0]
    assert tables.read_table(spark, root, "leituras").count() == batch[0].count()
    assert tables.read_table(spark, root, "maquinas").count() == 3
    assert tables.read_history(spark, root).count() == 3


def test_marts_missing(spark, tmp_path):
    with pytest.raises(building.MartsMissing):
        building.read_marts(spark, str(tmp_path / "nothing"))


def all_rows(marts):
    return {m: sorted(map(str, df.collect())) for m, df in marts.items()}


def test_builds_make_only_the_days_that_changed(spark, batch, tmp_path):
    """After four loads the marts equal those of a full build; the suite has the same rows, all zero."""
    root, path = str(tmp_path / "t"), str(tmp_path / "m")
    readings, modes = batch
    day = readings.filter("ts > timestamp_ntz'2031-05-21 00:00:00'")
    new = day.selectExpr(*["ts + INTERVAL '3' DAY AS ts" if c == "ts" else "'P-11' AS maquina_id" if c == "maquina_id" else c for c in day.columns])
    batches = [(readings, modes), batch, (day.withColumn("falha", F.lit(False)), modes.limit(0)), (new, modes.limit(0))]
    made = []
    for one in batches:
        load(spark, root, *one, NOW)
        results, days = building.build(spark, root, path, min_readings=1)
        made.append(days)
        found = sorted(map(tuple, results.collect()))
        assert len(found) == 56 and not any(r[-1] for r in found)
    whole, _ = building.build(spark, root, str(tmp_path / "whole"), min_readings=1, full=True)
    assert found == sorted(map(tuple, whole.collect()))
    assert all_rows(building.read_marts(spark, path)) == all_rows(building.read_marts(spark, str(tmp_path / "whole")))
    assert made == [2, 0, 1, 1]
    assert {f.split("/")[0][:7] for f in building.current(spark, path).folders["fct_leituras"].values()} == {"v000001", "v000003", "v000004"}
    before = all_rows(building.read_marts(spark, path))
    building.remove_old(spark, path, 1)
    assert all_rows(building.read_marts(spark, path)) == before


def test_the_later_of_two_builds_is_refused(spark, batch, tmp_path, monkeypatch):
    root, path, make = str(tmp_path / "t"), str(tmp_path / "m"), building._make
    load(spark, root, *batch, NOW)

    def interrupted(*args):
        monkeypatch.setattr(building, "_make", make)
        building.build(spark, root, path, min_readings=1)
        return make(*args)

    monkeypatch.setattr(building, "_make", interrupted)
    with pytest.raises(tables.Conflict):
        building.build(spark, root, path, min_readings=1)
    assert len(list((tmp_path / "m" / "publicadas").glob("[0-9]*.json"))) == 1 and len(list((tmp_path / "m").glob("v*"))) == 1


def test_states_find_what_the_whole_suite_finds(spark):
    """Ids repeated within and across days and blocks, nulls, wrong values, orphans, repeated machine days."""
    rows = [
        ("A", "2031-01-01", 1, "L"), ("A", "2031-01-01", 2, "L"), ("A", "2031-01-02", 2, "L"), ("B", "2031-01-02", None, "X"),
        ("Z", "2031-01-03", building.ID_BLOCK, "L"), ("Z", "2031-01-03", building.ID_BLOCK, "L"), (None, "2031-01-03", building.ID_BLOCK + 1, None),
        ("B", "2031-01-04", 2, "M"), ("B", "2031-01-04", 7, "M"), ("B", "2031-01-04", 9, "M"),
    ]
    lt = spark.createDataFrame(rows, "id_maquina string, dia string, id_leitura long, tipo_produto string").selectExpr(
        "*", "cast(dia AS timestamp_ntz) + INTERVAL '5' HOUR AS medido_em", "300D AS temperatura_ar_k", "27D AS temperatura_ar_c",
        "310D AS temperatura_processo_k", "37D AS temperatura_processo_c", "1500 AS rotacao_rpm", "40D AS torque_nm",
        "cast(NULL AS int) AS desgaste_min", "id_leitura < 3 AS houve_falha", "'ai4i' AS fonte", "'TWF' AS modos_falha", "1L AS qtd_modos_falha",
    )
    machines = spark.createDataFrame([("A", "ai4i"), ("B", "x"), ("B", None)], "id_maquina string, fonte string").selectExpr("*", "cast(NULL AS timestamp) AS criada_em")
    f = spark.createDataFrame([("2031-01-01", 1, 1, "TWF"), ("2031-01-01", 1, 50, "?"), ("2031-01-02", 2, None, None)], "dia string, id_falha long, id_leitura long, modo_falha string")
    daily = spark.createDataFrame([("A", "2031-01-01", 1), ("A", "2031-01-01", 2), ("Q", "2031-01-02", None)], "id_maquina string, dia string, qtd_falhas long")
    daily = daily.selectExpr("*", "cast(dia AS date) AS data_ref", "'TWF' AS modos_falha")
    dated = {"stg_leituras": lt, "stg_falhas": f, "int_leituras_enriquecidas": lt, "fct_leituras": lt, "fct_falhas_diarias": daily}
    states = building.day_states(dated)
    dim = building.dimension(machines, states["por_maquina"])
    history = spark.createDataFrame([(1, NOW, 0, 0, 100), (2, NOW, 0, 0, 50)], C.LOADS)
    whole = {m: df.drop("dia") for m, df in dated.items()} | {"stg_maquinas": machines, "dim_maquina": dim}
    expected = {tuple(r) for r in checks.run_checks(whole, history, min_readings=20).collect()}
    found = {tuple(r) for r in building.run_checks(machines, dim, states, history, min_readings=20).collect()}
    assert found == expected and len(found) == 56 and sum(r[3] > 0 for r in found) > 15


def test_enriched_model_does_not_repeat_readings(spark):
    lt = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "leitura_id long, maquina_id string").selectExpr(
        "*", "timestamp_ntz'2026-01-01 00:00:00' AS ts", "'L' AS tipo_produto", "298.15D AS temp_ar_k",
        "308.155D AS temp_processo_k", "1500 AS rotacao_rpm", "40D AS torque_nm", "1 AS desgaste_min", "true AS falha",
    )
    m = spark.createDataFrame([("A", "ai4i"), ("B", "ai4i"), ("C", "ai4i")], "maquina_id string, fonte string")
    m = m.withColumn("criada_em", F.current_timestamp())
    f = spark.createDataFrame([(1, 1, "PWF"), (2, 1, "HDF"), (3, 1, "TWF")], "falha_id long, leitura_id long, modo string")
    sm, sl, sf = models.stg_maquinas(m), models.stg_leituras(lt), models.stg_falhas(f)
    e = models.int_leituras_enriquecidas(sl, sm, sf)
    rows = {r.id_leitura: (r.modos_falha, r.qtd_modos_falha, str(r.temperatura_ar_c), str(r.temperatura_processo_c)) for r in e.collect()}
    assert rows == {
        1: ("HDF, PWF, TWF", 3, "25.00", "35.01"),
        2: (None, 0, "25.00", "35.01"),
        3: (None, 0, "25.00", "35.01"),
    }
    dim = {r.id_maquina: (r.total_leituras, r.total_falhas) for r in models.dim_maquina(sm, e).collect()}
    assert dim == {"A": (2, 2), "B": (1, 1), "C": (0, 0)}
    daily = {r.id_maquina: (r.qtd_falhas, r.modos_falha) for r in models.fct_falhas_diarias(models.fct_leituras(e)).collect()}
    assert daily == {"A": (2, "HDF, PWF, TWF"), "B": (1, None)}


def test_freshness(spark):
    def status(hours):
        history = spark.createDataFrame([(1, NOW - dt.timedelta(hours=hours), 1, 0, 1)], C.LOADS)
        return quality.freshness(history, NOW).collect()[0].situacao

    assert [status(h) for h in (1, 24, 25, 48, 49)] == ["pass", "pass", "warn", "warn", "error"]
    assert quality.freshness(spark.createDataFrame([], C.LOADS), NOW).collect()[0].situacao == "error"


@pytest.mark.parametrize(("totals_seen", "fails"), [([100], False), ([100, 90], False), ([100, 89], True), ([50, 100, 89], True)])
def test_volume_drop(spark, totals_seen, fails):
    rows = [(i, NOW, 0, 0, n) for i, n in enumerate(totals_seen)]
    history = spark.createDataFrame(rows, C.LOADS)
    assert (quality.volume_drop(history).count() == 1) is fails


def test_dashboard_reads(spark):
    dim = spark.createDataFrame([("K", 7, 0), ("L", 33, 13), ("N", 0, 0)], "id_maquina string, total_leituras long, total_falhas long")
    assert tuple(dashboard.kpis(dim).collect()[0]) == (3, 40, 13, 32.5)
    assert tuple(dashboard.kpis(dim.limit(0)).collect()[0]) == (0, 0, 0, 0.0)
    texts = ["OSF", "OSF, TWF; RNF", None, "DESCONHECIDO; OSF"]
    daily = spark.createDataFrame([(t,) for t in texts], "modos_falha string")
    found = {r.modo: r.ocorrencias for r in dashboard.mode_distribution(daily).collect()}
    assert found == {"OSF": 3, "TWF": 1, "RNF": 1, "DESCONHECIDO": 1}
    assert dashboard.mode_distribution(daily.limit(0)).count() == 0
