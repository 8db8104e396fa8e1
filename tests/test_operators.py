"""Operators against brute force on small data, with skew and with forced splitting."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import grouping, indexing, merge, quality
from gaugeflow.operators.dedup import mark_repeats
from gaugeflow.operators.series import series_window
from gaugeflow.plans import labels, queries
from gaugeflow.session import materialize


@pytest.fixture(scope="module")
def series(spark):
    """A hot series with bursts and gaps, short ones, and one of a single row."""
    rnd = random.Random(7)
    rows, t = [], 0
    for _ in range(400):
        t += rnd.choice([1, 5, 20, 59, 60, 61, 4000])
        rows.append(("hot", t, rnd.randint(0, 3000) / 10))
    for key in ("a", "b"):
        rows += [(key, i * 300, rnd.randint(0, 3000) / 10) for i in range(30)]
    rows.append(("one", 0, 1.0))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "maquina_id string, s long, v double").selectExpr(
        "maquina_id", "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS ts", "s", "v"
    )
    return sorted(rows), df


@pytest.mark.parametrize("minutes", [10**9, 10_080, 60, 1])
def test_windows_do_not_depend_on_the_cuts(series, minutes):
    rows, df = series
    by_key = defaultdict(list)
    for k, s, v in rows:
        by_key[k].append((s, v))
    expected = {}
    for k, points in by_key.items():
        for i, (s, v) in enumerate(points):
            last = [p[1] for p in points[max(0, i - 4) : i + 1]]
            expected[k, s] = (points[i - 1][1] if i else None, round(sum(last), 6), len(last))
    columns = {
        "anterior": "lag(v) OVER ({over})",
        "soma": "round(sum(v) OVER ({over} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6)",
        "n": "count(v) OVER ({over} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)",
    }
    out = series_window(df, "maquina_id", "ts", columns, reach=4, bucket_minutes=minutes)
    found = {(r.maquina_id, r.s): (r.anterior, r.soma, r.n) for r in out.collect()}
    assert found == expected
    assert out.count() == len(rows)


def test_a_series_is_read_and_shuffled_once(spark, tmp_path):
    """One scan and one shuffle of all rows; the second shuffle holds the rows next to cuts only."""
    spark.range(5000).selectExpr(
        "concat('U-', id % 7) AS maquina_id", "timestamp_ntz'2031-01-01 00:00:00' + id * INTERVAL '3' MINUTE AS ts", "id / 7 AS temp_processo_k"
    ).write.parquet(str(tmp_path / "s"))
    df = queries.moving_average(spark.read.parquet(str(tmp_path / "s")))
    assert df.count() == 5000
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Scan parquet") == 1 and plan.count("ReusedExchange") == 1 and plan.count("- Exchange hash") == 2


def test_first_moving_averages_equal_the_full_ones(spark, series):
    _, df = series
    readings = df.withColumnRenamed("v", "temp_processo_k")
    head = queries.first_moving_averages(readings, "hot", k=50).collect()
    full = queries.moving_average(readings).filter("maquina_id = 'hot'").orderBy("ts").limit(50).collect()
    assert head == full and len(head) == 50


def test_row_index_and_buckets(spark):
    n = 103
    df = spark.range(n).selectExpr("id", "if(id % 3 = 0, 5, id % 10) AS v").repartition(7, "id")
    order = sorted(((r.v, r.id) for r in df.collect()))
    indexed = {r.id: (r.i, r.n) for r in indexing.with_row_index(df, ["v", "id"], "i", total="n").collect()}
    assert indexed == {i: (pos, n) for pos, (_, i) in enumerate(order)}
    for k in (1, 4, 7, 103, 200):
        small, big = divmod(n, k)
        sizes = [small + 1] * big + [small] * (k - big)
        bucket = [b + 1 for b, size in enumerate(sizes) for _ in range(size)]
        found = {r.id: r.b for r in indexing.with_ntile(df, ["v", "id"], k, "b").collect()}
        assert found == {i: bucket[pos] for pos, (_, i) in enumerate(order)}


@pytest.mark.parametrize("k", [1, 4, 10])
def test_ntile_summary_equals_row_level_buckets(spark, k):
    df = spark.range(500).selectExpr("id", "if(id % 3 = 0, 40, id % 50) AS v", "id % 11 = 0 AS falha")
    rows = indexing.with_ntile(df, ["v", "id"], k, "faixa")
    expected = rows.groupBy("faixa").agg(
        F.min("v").alias("menor"), F.max("v").alias("maior"), F.count("*").alias("linhas"),
        F.count_if("falha").alias("com_marca"),
    )
    found = indexing.ntile_summary(df, "v", "falha", ["id"], k, (0, 1000))
    key = lambda r: r.faixa
    assert sorted(found.select(expected.columns).collect(), key=key) == sorted(expected.collect(), key=key)


def test_ids_are_dense_and_start_after_the_last(spark):
    out = indexing.with_ids(spark.range(50).selectExpr("50 - id AS k"), ["k"], "novo", after=9).collect()
    assert sorted((r.k, r.novo) for r in out) == [(i, i + 9) for i in range(1, 51)]
    assert indexing.with_ids(spark.range(0), ["id"], "novo").count() == 0


def test_rank_and_share(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 3), ("d", 0), ("e", 1)], "k string, n long")
    out = {r.k: (r.p, r.s) for r in grouping.rank_and_share(df, "n", "p", "s").collect()}
    assert out == {"a": (1, 37.5), "c": (1, 37.5), "b": (3, 12.5), "e": (3, 12.5), "d": (5, 0.0)}
    zero = {r.k: (r.p, r.s) for r in grouping.rank_and_share(df.filter("n = 0"), "n", "p", "s").collect()}
    assert zero == {"d": (1, None)}


def test_ordered_text_counts_copies(spark):
    rows = [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)]
    df = spark.createDataFrame(rows, "k long, t string")
    out = {r.k: (r.x, r.n) for r in grouping.ordered_text(df, ["k"], "t", ", ", "x", "n").collect()}
    assert out == {1: ("a, b, b", 4), 2: (None, 1)}
    out = {r.k: (r.x, r.n) for r in grouping.ordered_text(df, ["k"], "t", "; ", "x", "n", distinct=True).collect()}
    assert out == {1: ("a; b", 4), 2: (None, 1)}


def test_repeats_with_a_hot_key_and_null_parts(spark):
    rows = [(None if i % 3 == 0 else i // 4, "x", i) for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b string, i long")
    seen, expected = set(), {}
    for a, _, i in rows:
        expected[i] = a in seen
        seen.add(a)
    assert {r.i: r.repetida for r in mark_repeats(df, ["a", "b"], "i").collect()} == expected
    spared = {r.i: r.repetida for r in mark_repeats(df, ["a", "b"], "i", eligible="a IS NOT NULL").collect()}
    assert spared == {i: flag and rows[i][0] is not None for i, flag in expected.items()}


def test_merge_is_null_safe(spark):
    t = spark.createDataFrame([(1, 10, None), (2, 20, 5), (3, 30, 6), (4, 40, 7)], "k long, id long, v long")
    b = spark.createDataFrame([(1, None), (2, None), (3, 6), (9, 1)], "k long, v long")
    out = merge.merge_rows(t, b, ["k"], ["v"])
    assert {r.k: (r.id, r.v, r.acao) for r in out.collect()} == {
        1: (10, None, "same"), 2: (20, None, "update"), 3: (30, 6, "same"), 4: (40, 7, "keep"), 9: (None, 1, "insert"),
    }
    again = merge.merge_rows(out.drop("acao"), b, ["k"], ["v"])
    assert {r.acao for r in again.collect()} == {"same", "keep"}


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", None)], "k string, n long")
    assert [tuple(r) for r in quality.unique(df, "k").collect()] == [("a", 2)]
    assert quality.unique(df, "k", "n").count() == 0
    assert {tuple(r) for r in quality.not_null(df, "k", "n").collect()} == {("k", 2), ("n", 1)}
    assert [tuple(r) for r in quality.accepted_values(df, "k", ["a"]).collect()] == [("b", 1)]
    parents = spark.createDataFrame([("a",)], "f string")
    assert [tuple(r) for r in quality.relationships(df, "k", parents, "f").collect()] == [("b", 1)]
    assert [tuple(r) for r in quality.row_parity(df, parents).collect()] == [(5, 1)]
    assert quality.row_parity(df, df).count() == 0
    assert [tuple(r) for r in quality.min_volume(df, 6).collect()] == [(5, 6)]
    assert quality.min_volume(df, 5).count() == 0


def test_rule_labels(spark):
    rows = [
        (1, "L", 300.0, 308.0, 1300, 40.0, 10),  # delta 8.0, slow: HDF
        (2, "L", 300.0, 310.0, 1500, 20.0, 10),  # 3142 W: PWF
        (3, "L", 300.0, 310.0, 1500, 50.0, 230),  # 11500 > 11000: OSF
        (4, "M", 300.0, 310.0, 1500, 50.0, 230),  # 11500 < 12000
        (5, "L", 300.0, 308.0, 1300, 70.0, 200),  # 9529 W and 14000: all three
    ]
    df = spark.createDataFrame(
        rows, "leitura_id int, tipo_produto string, temp_ar_k double, temp_processo_k double,"
        " rotacao_rpm int, torque_nm double, desgaste_min int"
    )
    out = {r.leitura_id: (r.modo_falha, r.falha) for r in labels.label_readings(df).collect()}
    assert out == {1: ("HDF", True), 2: ("PWF", True), 3: ("OSF", True), 4: (None, False), 5: ("HDF|PWF|OSF", True)}


def test_prefix_and_threshold(spark):
    df = spark.createDataFrame(
        [("SIM-01", i, 40.0 + 30 * (i % 2)) for i in range(4)] + [("AI4I-01", i, 100.0 * i) for i in range(3)],
        "maquina_id string, i int, torque_nm double",
    ).selectExpr("maquina_id", "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, i, 0, 0) AS ts", "torque_nm", "i = 2 AS falha")
    found = queries.jumps(df, prefix="SIM-").collect()
    assert [float(r.delta) for r in found] == [30.0, -30.0, 30.0]
    assert queries.jumps(df, prefix="SIM-", threshold=30).count() == 0
    assert queries.jumps(df, k=2).count() == 2
    assert [r.falhas_acumuladas for r in queries.daily_failures(df, prefix="SIM-").collect()] == [1]


def test_time_between_failures(spark):
    df = spark.createDataFrame(
        [("A", 0, True), ("A", 10, False), ("A", 60, True), ("A", 90, True), ("B", 5, True)],
        "maquina_id string, s int, falha boolean",
    ).selectExpr("maquina_id", "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS ts", "falha")
    assert [tuple(r) for r in queries.time_between_failures(df).collect()] == [("A", 2, 45.0, 30.0)]


@pytest.mark.parametrize("minutes", [10**9, 60])
def test_latest_row_before_a_cut(spark, series, minutes):
    """One row back, rows without a key included."""
    rows, df = series
    some = df.withColumn("maquina_id", F.expr("nullif(maquina_id, 'a')"))
    out = series_window(some, "maquina_id", "ts", {"anterior": "lag(v) OVER ({over})"}, 1, minutes)
    found = {(r.maquina_id or "a", r.s): r.anterior for r in out.collect()}
    assert found == {(k, s): rows[i - 1][2] if i and rows[i - 1][0] == k else None for i, (k, s, _) in enumerate(rows)}


def test_one_series_plan_reads_its_input_twice_and_runs_no_job(spark, series):
    _, df = series
    stored = materialize(df.withColumnRenamed("v", "temp_processo_k"), "series")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "plans only")
    try:
        plan = queries.moving_average(stored)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") <= 2 and "Broadcast" not in plan
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_exact_mean_of_wide_and_fine_values(spark):
    rows = [("A", i, v) for i, v in enumerate([1e13, 0.0000004, 3e12 + 0.5, -0.004])]
    df = spark.createDataFrame(rows, "maquina_id string, i int, temp_processo_k double").selectExpr(
        "maquina_id", "timestamp_ntz'2031-01-01 00:00:00' + make_dt_interval(0, i, 0, 0) AS ts", "temp_processo_k"
    )
    found = [r.media_movel for r in queries.moving_average(df, rows=2).orderBy("ts").collect()]
    assert found == [1e13, 5e12, 1.5e12 + 0.25, 1.5e12 + 0.25]


def test_no_row_level_plan_ends_in_one_partition(spark, series):
    """Only counts per partition, per value or per day may meet in a single partition."""
    _, df = series
    readings = df.selectExpr("maquina_id", "ts", "v AS torque_nm", "v > 100 AS falha")
    for query in (queries.jumps(readings), queries.time_between_failures(readings)):
        plan = query._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "Python" not in plan
