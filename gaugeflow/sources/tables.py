"""Published tables: files by day, named by one manifest per version, made current by numbered commits.

A load writes only the days it changes, below a folder of its own. The version's manifest lists every partition of
every table with its folder and rows; partitions that did not change keep the folder of an earlier version. The version
becomes current when its commit, a small file numbered one above the last, is created: that happens in one step and
only if no other writer has created it, so of two loads that started from one version the later is refused and starts
over. What a failed or refused load wrote is named by no commit, and ``unpublished`` lists it.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeflow import contract as C
from gaugeflow.functions import name
from gaugeflow.session import file_system, remove

SCHEMAS = {"maquinas": C.MACHINES, "leituras": C.READINGS, "falhas": C.FAILURES}
#: Readings and failures are kept by the day of their instant, machines by the version that added them.
DAY = "dia"
_DATED = ("leituras", "falhas")

# Beside the public columns: the version, and the highest ids ever given out, so that none is given twice.
_COMMIT = T.StructType(
    [
        *[f for f in C.LOADS if f.name != "carregado_em"],
        T.StructField("carregado_us", T.LongType()),
        T.StructField("versao", T.StringType()),
        T.StructField("ultima_leitura", T.LongType()),
        T.StructField("ultima_falha", T.LongType()),
    ]
)


class Conflict(RuntimeError):
    """Another writer published the version that this one was about to."""


@dataclass(frozen=True)
class Part:
    """Files of one partition, as a folder below the root, and the rows they hold."""

    folder: str
    rows: int


@dataclass
class State:
    """One version: its load, the highest ids given out, and its partitions by table and value."""

    load_id: int = 0
    version: str | None = None
    last_reading: int = 0
    last_failure: int = 0
    parts: dict[str, dict[str, Part]] = field(default_factory=lambda: {t: {} for t in SCHEMAS})

    def rows(self, table: str) -> int:
        return sum(p.rows for p in self.parts[table].values())


def day_of(instant: str) -> str:
    """SQL for the partition of an instant."""
    return f"cast(cast({instant} AS date) AS string)"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored at ``path``; looks at the listing only."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_text(spark: SparkSession, file: str) -> str:
    system, path = file_system(spark, file)
    stream = system.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, file: str, text: str) -> None:
    system, path = file_system(spark, file)
    stream = system.create(path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def create_once(spark: SparkSession, file: str, text: str) -> bool:
    """Create a file with this content unless there is one; tells whether it did.

    The content is written beside it first. Then a local file is linked, any other renamed without overwriting: both
    fail if the name is taken, and no reader sees half a file. A store whose rename isn't atomic can't do this.
    """
    folder, _, last = file.rpartition("/")
    beside = f"{folder}/.{last}-{uuid.uuid4().hex}"
    system, path = file_system(spark, file)
    write_text(spark, beside, text)
    _, source = file_system(spark, beside)
    try:
        if system.getUri().getScheme() == "file":
            os.link(source.toUri().getPath(), path.toUri().getPath())
        else:
            jvm = spark.sparkContext._jvm
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context.rename(context.makeQualified(source), context.makeQualified(path), none)
    except Exception:
        if system.exists(path):
            return False
        raise
    finally:
        system.delete(source, False)
    return True


def _commits(spark: SparkSession, root: str) -> list[str]:
    """Names of the commits, oldest first."""
    system, path = file_system(spark, f"{root}/cargas")
    if not system.exists(path):
        return []
    found = [s.getPath().getName() for s in system.listStatus(path)]
    return sorted(f for f in found if not f.startswith("."))


def _committed(spark: SparkSession, root: str, commit: str) -> State:
    row = json.loads(read_text(spark, f"{root}/cargas/{commit}"))
    state = State(row["carga_id"], row["versao"], row["ultima_leitura"], row["ultima_falha"])
    for line in read_text(spark, f"{root}/manifestos/{row['versao']}.json").splitlines():
        part = json.loads(line)
        state.parts[part["tabela"]][part["particao"]] = Part(part["pasta"], part["linhas"])
    return state


def current(spark: SparkSession, root: str) -> State:
    """The current version: one listing and two small files, no table is read. Without a load it is empty."""
    commits = _commits(spark, root)
    return _committed(spark, root, commits[-1]) if commits else State()


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """The load history, one row per successful load."""
    if not _commits(spark, root):
        return spark.createDataFrame([], C.LOADS)
    rows = spark.read.schema(_COMMIT).json(f"{root}/cargas")
    made = {c: name(c) for c in C.LOADS.names} | {"carregado_em": "timestamp_micros(carregado_us)"}
    return rows.selectExpr(*[f"{e} AS {name(c)}" for c, e in made.items()])


def read_parts(spark: SparkSession, root: str, state: State, table: str, values: list[str] | None = None) -> DataFrame:
    """The partitions with these values (all, if None) of a table; empty where there are none."""
    held = state.parts[table]
    folders = [f"{root}/{held[v].folder}" for v in (held if values is None else values) if v in held]
    if not folders:  # known to be empty while the plan is made, so joins with it go
        nulls = [f"cast(NULL AS {f.dataType.simpleString()}) AS {name(f.name)}" for f in SCHEMAS[table]]
        return spark.range(1).selectExpr(*nulls).where("false")
    return spark.read.schema(SCHEMAS[table]).parquet(*folders)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the current version, or the history."""
    if table == "cargas":
        return read_history(spark, root)
    return read_parts(spark, root, current(spark, root), table)


def write_parts(df: DataFrame, root: str, version: str, table: str) -> None:
    """Write rows of a table below the folder of a version that is not yet published.

    Dated tables come with their DAY column: the rows of a day are brought together, and adaptive execution splits a
    large day over several tasks and files.
    """
    casts = [f"cast({name(f.name)} AS {f.dataType.simpleString()}) AS {name(f.name)}" for f in SCHEMAS[table]]
    path = f"{root}/{version}/{table}"
    if table in _DATED:
        df.selectExpr(*casts, DAY).hint("rebalance", DAY).write.mode("error").partitionBy(DAY).parquet(path)
    else:
        df.selectExpr(*casts).write.mode("error").parquet(path)


def folder_of(version: str, table: str, value: str) -> str:
    """Where write_parts puts a partition, below the root."""
    return f"{version}/{table}/{DAY}={value}" if table in _DATED else f"{version}/{table}"


def publish(spark: SparkSession, root: str, state: State, now: dt.datetime, inserted: int, updated: int) -> None:
    """Write the manifest of a version and make it current; Conflict if its number is taken."""
    lines = [
        json.dumps({"tabela": t, "particao": v, "pasta": p.folder, "linhas": p.rows})
        for t, parts in state.parts.items()
        for v, p in sorted(parts.items())
    ]
    write_text(spark, f"{root}/manifestos/{state.version}.json", "\n".join(lines))
    aware = now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)
    row = (
        state.load_id, inserted, updated, state.rows("leituras"), round(aware.timestamp() * 1_000_000),
        state.version, state.last_reading, state.last_failure,
    )
    commit = json.dumps(dict(zip(_COMMIT.names, row)))
    if not create_once(spark, f"{root}/cargas/{state.load_id:012d}.json", commit):
        raise Conflict(f"load {state.load_id} was published by another writer")


def discard(spark: SparkSession, root: str, version: str) -> None:
    """Delete what a version that no commit names has written."""
    remove(spark, f"{root}/{version}")
    remove(spark, f"{root}/manifestos/{version}.json")


def remove_old(spark: SparkSession, root: str, keep: int) -> None:
    """Delete the files that none of the newest ``keep`` versions refers to; the history keeps its rows."""
    if keep < 1:
        raise ValueError("the current version has to stay")
    commits = _commits(spark, root)
    held = [_committed(spark, root, c) for c in commits[-keep:]]
    needed = {p.folder for s in held for parts in s.parts.values() for p in parts.values()}
    for commit in commits[:-keep]:
        version = json.loads(read_text(spark, f"{root}/cargas/{commit}"))["versao"]
        system, manifest = file_system(spark, f"{root}/manifestos/{version}.json")
        if not system.exists(manifest):
            continue  # went before
        old = _committed(spark, root, commit)
        for folder in {p.folder for parts in old.parts.values() for p in parts.values()} - needed:
            remove(spark, f"{root}/{folder}")
        system.delete(manifest, False)


def unpublished(spark: SparkSession, root: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Version folders that no commit names and that were last touched so long ago: failed loads, not running ones."""
    system, path = file_system(spark, root)
    if not system.exists(path):
        return []
    named = {json.loads(read_text(spark, f"{root}/cargas/{c}"))["versao"] for c in _commits(spark, root)}
    before = (dt.datetime.now(dt.timezone.utc) - older_than).timestamp() * 1000
    found = [(s.getPath().getName(), s.getModificationTime()) for s in system.listStatus(path) if s.isDirectory()]
    return sorted(n for n, touched in found if n.startswith("v") and n not in named and touched <= before)


def remove_unpublished(spark: SparkSession, root: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Delete what ``unpublished`` lists; returns it."""
    found = unpublished(spark, root, older_than)
    for version in found:
        discard(spark, root, version)
    return found
