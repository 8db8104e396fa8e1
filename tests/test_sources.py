import random

import pytest
from pyspark.sql import functions as F

from gaugeflow import contract as C
from gaugeflow.operators import cleaning
from gaugeflow.sources import csv_records, raw_layer, text_files
from gaugeflow.sources.arrival import in_source_order, ordinal, with_arrival

from conftest import DEFAULT

WIDE = ["UDI", "Product ID", *C.AI4I_COLUMNS.values(), *C.FAILURE_MODES]


def wide_row(udi, **cells) -> dict:
    """A row of the wide file: plausible numbers that follow from its number, no failure."""
    plain = {c: str(300 + udi % 7) for c in C.AI4I_COLUMNS.values()} | {c: "0" for c in C.FAILURE_MODES}
    return plain | {"UDI": str(udi), "Product ID": f"x{udi}"} | cells


def write_wide(path, rows) -> str:
    lines = [",".join(WIDE), *(",".join(r[c] for c in WIDE) for r in rows)]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def write_raw_csv(path, rows) -> str:
    body = [",".join(C.RAW_COLUMNS), *(",".join(({**DEFAULT, **r})[c] or "" for c in C.RAW_COLUMNS) for r in rows)]
    path.write_text("\n".join(body) + "\n")
    return str(path)


def test_ai4i_file(spark, tmp_path):
    """Row numbers rotate over the machines; a full turn is one time step."""
    numbers = [5, 10, 15, 10 * 6 * 24 + 5]
    flags = {10: {"TWF": "1", "RNF": "1"}, 15: {"OSF": "1"}}
    path = write_wide(tmp_path / "w.csv", [wide_row(n, **flags.get(n, {})) for n in numbers])
    df = text_files.read_ai4i(spark, path)
    assert df.columns == [*C.RAW_COLUMNS, C.ARRIVAL]
    found = [(r.maquina_id, r.timestamp, r.modo_falha) for r in df.orderBy(C.ARRIVAL).collect()]
    assert found == [
        ("AI4I-05", "2020-01-01 00:00:00", None),
        ("AI4I-10", "2020-01-01 00:00:00", "TWF|RNF"),
        ("AI4I-05", "2020-01-01 00:10:00", "OSF"),
        ("AI4I-05", "2020-01-02 00:00:00", None),
    ]


@pytest.mark.parametrize(("number", "message"), [("sete", "CAST_INVALID_INPUT"), ("", "UDI is missing")])
def test_ai4i_row_numbers_must_be_numbers(spark, tmp_path, number, message):
    path = write_wide(tmp_path / "w.csv", [wide_row(6), wide_row(7, UDI=number)])
    with pytest.raises(Exception, match=message):
        text_files.read_ai4i(spark, path).collect()


def test_missing_columns_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("tipo,torque_nm\nH,1\n")
    with pytest.raises(text_files.SourceError, match="maquina_id"):
        text_files.read_raw_csv(spark, str(tmp_path / "a.csv"))


def test_null_tokens_and_quotes(spark, tmp_path):
    cells = ["", "NA", "None", "nan", "N/A", "null", "#N/A", "n/a", "na", " NA", '"a,""b"""', "01"]
    body = "".join(f"{i},{c}\n" for i, c in enumerate(cells))
    (tmp_path / "a.csv").write_text(f"other,k,v\n{''.join(f'z,{line}' for line in body.splitlines(True))}")
    rows = text_files.read_text_csv(spark, str(tmp_path / "a.csv"), ["k", "v"]).orderBy(C.ARRIVAL).collect()
    assert [r.v for r in rows] == [None] * 8 + ["na", " NA", 'a,"b"', "01"]


def test_records_of_other_lengths(spark, tmp_path):
    """Missing cells are null, also beside quoted commas; surplus cells are an error, even empty ones."""
    (tmp_path / "short.csv").write_text('k,v,w\n1,a\n2,"b,c,d"\n3,x,y\n')
    rows = text_files.read_text_csv(spark, str(tmp_path / "short.csv"), ["k", "v", "w"]).orderBy("k").collect()
    assert [(r.k, r.v, r.w) for r in rows] == [("1", "a", None), ("2", "b,c,d", None), ("3", "x", "y")]
    for i, line in enumerate(("1,a,b,c", "1,a,,", '1,"a,b",c,d')):
        (tmp_path / f"long{i}.csv").write_text(f"k,v,w\n0,x,y\n{line}\n")
        with pytest.raises(Exception, match="more cells than the header"):
            text_files.read_text_csv(spark, str(tmp_path / f"long{i}.csv"), ["k"]).collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"two\nlines"\n2,one\n')
    for multi_line in (None, True):
        rows = text_files.read_text_csv(spark, str(tmp_path / "a.csv"), ["k", "v"], multi_line)
        assert [(r.k, r.v) for r in rows.orderBy(C.ARRIVAL).collect()] == [("1", "two\nlines"), ("2", "one")]


def test_state_at_the_end_of_a_line():
    states = {'a,b': (0, 1), 'a,"b"': (0, 0), '"b': (1, 0), 'b"': (0, 0), '5" pipe,x': (0, 0), 'a,"say ""x""",c': (0, 0), '""': (0, 1),
              'x,"""': (1, 0), '","': (0, 1), ',"': (1, 0), '"",""': (0, 1), "": (0, 1)}
    for line, (outside, inside) in states.items():
        assert (csv_records.ends_inside(line, False), csv_records.ends_inside(line, True)) == (bool(outside), bool(inside)), line


@pytest.mark.parametrize("split_bytes", ["7", "64", "500", "100000"])
def test_quoted_line_breaks_across_splits(spark, tmp_path, split_bytes):
    """Cells longer than a split, quotes at its edges, blank lines, commas and doubled quotes, Windows line ends, two files."""
    rng = random.Random(int(split_bytes))
    pieces = ["x", "a b", "\n", "\n\n", ",", '"', '""', "é", "9" * 40, "", "z\n" * 30, ' "q",\n"']
    expected = []
    for f in ("a", "b"):
        rows = [[f"{f}{i}", "".join(rng.choice(pieces) for _ in range(rng.randrange(5))), rng.choice(["t", "u\nv"])] for i in range(25)]
        with open(tmp_path / f"{f}.csv", "w", newline="") as out:
            end = "\r\n" if f == "b" else "\n"
            out.write(f"k,v,w{end}{end}")
            out.write(end.join(",".join('"' + c.replace('"', '""') + '"' if set(c) & set('",\n') else c for c in r) for r in rows))
        expected += [tuple(c or None for c in r) for r in rows]
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, split_bytes)
        rows = text_files.read_text_csv(spark, [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")], ["k", "v", "w"])
        found = [(r.k, r.v, r.w) for r in rows.orderBy(C.ARRIVAL).collect()]
    finally:
        spark.conf.set(setting, before)
    assert found == expected


def test_quotes_that_do_not_end(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"two\n3,4\n')
    with pytest.raises(csv_records.CsvError, match="does not end"):
        text_files.read_text_csv(spark, str(tmp_path / "a.csv"), ["k"])
    (tmp_path / "b.csv").write_text('k,v\n1,"two\nlines"\n')
    (tmp_path / "c.csv").write_text('v,k\n1,"two\nlines"\n')
    with pytest.raises(Exception, match="the header is"):
        text_files.read_text_csv(spark, [str(tmp_path / "b.csv"), str(tmp_path / "c.csv")], ["k"]).collect()


@pytest.mark.parametrize("split_bytes", [None, "2000", "100000"])
def test_rows_of_files_arrive_in_file_order(spark, tmp_path, split_bytes):
    """A small first file, a big second one that repeats its key: the first file's row stays for any split size."""
    folder = tmp_path / "with space"
    folder.mkdir()
    many = [{"maquina_id": f"Q-{i:03}", "torque_nm": str(i % 90)} for i in range(600)]
    second = write_raw_csv(folder / "part-2.csv", [*many[:300], {"torque_nm": "2"}, *many[300:]])
    first = write_raw_csv(folder / "part-1.csv", [{"torque_nm": "1"}])
    other = write_raw_csv(tmp_path / "other.csv", [{"fonte": "ai4i", "maquina_id": "Z"}])
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, split_bytes or before)
        sources = {"ai4i": text_files.read_raw_csv(spark, other), "simulado": text_files.read_raw_csv(spark, [second, first])}
        rows = text_files.union_sources(sources)
        order = [(r.maquina_id, r.torque_nm) for r in rows.orderBy(C.ARRIVAL).collect()]
        classified = cleaning.classify(rows).collect()
    finally:
        spark.conf.set(setting, before)
    expected = [(r["maquina_id"], r["torque_nm"]) for r in many]
    assert order == [("Z", "33.5"), ("P-7", "1"), *expected[:300], ("P-7", "2"), *expected[300:]]
    assert [(r.torque_nm, r.motivo) for r in classified if r.motivo] == [("2", "duplicada")]


def test_rows_without_an_ordinal_arrive_last(spark, raw):
    """The union numbers them; cleaning itself refuses a missing ordinal."""
    rows = raw({"torque_nm": "5"}, {"torque_nm": "6"}, {"torque_nm": "7"})
    late = rows.withColumn(C.ARRIVAL, F.expr(f"if(torque_nm = '7', {C.ARRIVAL}, NULL)"))
    kept = cleaning.readings(cleaning.classify(text_files.union_sources({"simulado": late}))).collect()
    assert [r.torque_nm for r in kept] == [7.0]
    with pytest.raises(Exception, match="chegada is null"):
        cleaning.classify(late).collect()


def test_ordinals_of_many_files_and_sources(spark):
    """The order holds beyond 2^20 files, 2^40 bytes a file and 2^31 rows; late rows and the next source come after."""
    rows = [(0, f"/f{i:09}", s, n) for i in (0, 2**20 - 1, 2**20, 10**8) for s, n in ((0, 2**31), (2**50, 0), (2**50, 7))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "at int, s int, f string, p long, n long")
    own = df.selectExpr("at", f"{ordinal('s', 'f', 'p', 'n')} AS {C.ARRIVAL}")
    late = with_arrival(spark.createDataFrame([(50,), (51,)], "at int").coalesce(1).withColumn(C.ARRIVAL, F.lit(None).cast("long")))
    both = own.union(late).repartition(3)
    other = in_source_order(own.withColumn("at", F.col("at") + 100), 1)
    found = [r.at for r in both.union(other).orderBy(C.ARRIVAL).collect()]
    assert found == [*range(len(rows)), 50, 51, *range(100, 100 + len(rows))]


def test_rows_from_files_are_not_shuffled_before_they_are_classified(spark, tmp_path):
    path = write_raw_csv(tmp_path / "a.csv", [{"maquina_id": "K"}, {"maquina_id": "L"}])
    plan = text_files.union_sources({"simulado": text_files.read_raw_csv(spark, path)})
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    raw_layer.write_raw(plan, str(tmp_path / "b"))
    again = raw_layer.read_raw(spark, str(tmp_path / "b"), numbered=False)
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()


def test_union_keeps_order_and_validates_names(spark, raw):
    both = {"simulado": raw({"torque_nm": "8"}, {"torque_nm": "9"}), "ai4i": raw({"fonte": "ai4i"})}
    rows = text_files.union_sources(both).orderBy(C.ARRIVAL).collect()
    assert [(r.fonte, r.torque_nm) for r in rows] == [("simulado", "8"), ("simulado", "9"), ("ai4i", "33.5")]
    assert text_files.union_sources(both, ["ai4i"]).count() == 1
    for wrong in (["sensores"], []):
        with pytest.raises(text_files.SourceError):
            text_files.union_sources(both, wrong)


def test_raw_partitions(raw, tmp_path):
    """One directory per day text and machine, however many rows it has."""
    days = ["1999-12-31 23:00:00", "2031-05-20 00:00:00", "2031-05-20 12:00:00"]
    df = raw(*[{"maquina_id": m, "timestamp": d} for m in ("K", "L", "N") for d in days])
    assert raw_layer.write_raw(df, str(tmp_path / "b")) == 6
    found = {p.relative_to(tmp_path / "b").as_posix() for p in (tmp_path / "b").glob("data=*/*")}
    assert found == {f"data={d[:10]}/maquina_id={m}" for m in ("K", "L", "N") for d in days}


def test_raw_round_trip_keeps_everything(spark, raw, tmp_path):
    machines = [None, "", "  ", "sem_maquina", "a/b=c%", "007", "çã", "K"]
    instants = ["2031-05-20 06:30:00", "amanhã, cedo", None, "0123456789"]
    df = raw(*[{"maquina_id": m, "timestamp": t, "torque_nm": "?"} for m in machines for t in instants])
    path = str(tmp_path / "b")
    raw_layer.write_raw(df, path)
    back = raw_layer.read_raw(spark, path)
    assert back.columns == df.columns
    key = lambda r: r[C.ARRIVAL]
    assert sorted(back.collect(), key=key) == sorted(with_arrival(df).collect(), key=key)
    assert (tmp_path / "b" / "data=0123456789" / "maquina_id=K").is_dir()
    # Text too short to hold a day counts as no day.
    assert raw_layer.read_raw(spark, path, "data = 'sem_data'").filter("timestamp IS NULL").count() == len(machines)


def test_directory_conditions_prune(spark, raw, tmp_path):
    raw_layer.write_raw(raw({"maquina_id": "K"}, {"maquina_id": "L"}), str(tmp_path / "b"))
    one = raw_layer.read_raw(spark, str(tmp_path / "b"), "maquina_id = 'L'")
    assert [r.maquina_id for r in one.collect()] == ["L"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(maquina_id" in plan


def test_a_second_write_replaces_the_first(spark, raw, tmp_path):
    path = str(tmp_path / "b")
    raw_layer.write_raw(raw({"maquina_id": "K"}, {"maquina_id": "L"}, {"maquina_id": "L"}), path)
    assert raw_layer.write_raw(raw({"maquina_id": "N"}), path) == 1
    assert [r.maquina_id for r in raw_layer.read_raw(spark, path).collect()] == ["N"]


def test_a_dataset_without_helper_columns(spark, raw, tmp_path):
    """Written elsewhere: the first file in the order of names wins, and the sentinel means no machine."""
    path = str(tmp_path / "b")
    for i, torque in enumerate(("50", "51", "52")):
        rows = raw({"maquina_id": "K", "torque_nm": torque}, {"maquina_id": None, "torque_nm": torque})
        laid_out = rows.drop(C.ARRIVAL).withColumns(
            {"data": F.lit("2031-05-20"), "maquina_id": F.coalesce("maquina_id", F.lit("sem_maquina"))}
        )
        laid_out.coalesce(1).write.partitionBy("data", "maquina_id").parquet(f"{path}-{i}")
        for machine in ("K", "sem_maquina"):
            folder = tmp_path / "b" / "data=2031-05-20" / f"maquina_id={machine}"
            folder.mkdir(parents=True, exist_ok=True)
            part = next((tmp_path / f"b-{i}" / "data=2031-05-20" / f"maquina_id={machine}").glob("*.parquet"))
            (folder / f"{2 - i}.parquet").write_bytes(part.read_bytes())
    found = {(r.maquina_id, r.torque_nm): r.motivo for r in cleaning.classify(raw_layer.read_raw(spark, path, numbered=False)).collect()}
    assert {k: m for k, m in found.items() if k[0]} == {("K", "52"): None, ("K", "51"): "duplicada", ("K", "50"): "duplicada"}
    assert {m for (machine, _), m in found.items() if machine is None} == {"maquina_ausente"}


def test_empty_raw_layer(spark, raw, tmp_path):
    assert raw_layer.write_raw(raw(), str(tmp_path / "b")) == 0
    assert raw_layer.read_raw(spark, str(tmp_path / "b")).count() == 0
