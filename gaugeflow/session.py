"""Session settings for local runs, and the shared folder for intermediate results."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Spark's setting by which a query's shuffle files go when it ends.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session as tests and the benchmark use it; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gaugeflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session whose executors are threads of the driver may leave that unset; then it is a folder below the
    warehouse. Any other session must name it, ``local-cluster`` included.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    name = f"{shared_dir(spark)}/gaugeflow/{label}-{uuid.uuid4().hex}"
    system, path = file_system(spark, name)
    system.mkdirs(path.getParent())
    system.mkdirs(path)
    system.deleteOnExit(path)
    system.delete(path, True)
    return name


def file_system(spark: SparkSession, folder: str):
    """The file system of a path, and the path as it knows it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a stored folder, if it is there."""
    system, path = file_system(spark, folder)
    system.delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: a result that several plans use.

    Cuts the lineage and survives the loss of executors; readers still prune columns. The shuffles of the write go when it
    ends, as nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete a stored intermediate that no plan reads any more; ``df`` is what ``materialize`` returned."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        remove(df.sparkSession, folder)
