"""Hot groups are spread over tasks; thresholds are lowered so that small data shows it."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from gaugeflow import contract as C
from gaugeflow.operators.dedup import mark_repeats
from gaugeflow.session import materialize
from gaugeflow.sources import raw_layer

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_copies_of_a_hot_key_are_split(spark):
    """A third of all rows share a key: the join that marks them is divided."""
    rows = spark.range(150_000).repartition(6).selectExpr("id", "if(id % 3 = 0, 7, id) AS k", "uuid() AS pad")
    rows = materialize(rows, "hot")
    with settings(spark, SMALL):
        counted = mark_repeats(rows, ["k"], "id").groupBy("repetida").count()
        assert {r.repetida: r["count"] for r in counted.collect()} == {False: 100_000, True: 50_000}
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()


def test_a_hot_raw_partition_is_several_files(spark, raw, tmp_path):
    row = raw({}).drop(C.ARRIVAL).collect()[0].asDict()
    n = 30_000
    frame = spark.range(n).select(
        *[F.lit(v).alias(c) for c, v in row.items() if c not in ("maquina_id", "torque_nm")],
        F.when(F.col("id") % 3 != 0, F.lit("quente")).otherwise(F.concat(F.lit("m"), F.col("id") % 5)).alias("maquina_id"),
        F.expr("uuid()").alias("torque_nm"),
        F.col("id").alias(C.ARRIVAL),
    )
    path = str(tmp_path / "bruto")
    with settings(spark, SMALL):
        assert raw_layer.write_raw(frame.repartition(4), path) == 6
    hot = list((tmp_path / "bruto" / "data=2031-05-20" / "maquina_id=quente").glob("*.parquet"))
    assert len(hot) > 1
    back = raw_layer.read_raw(spark, path)
    assert back.count() == n and back.select(C.ARRIVAL).distinct().count() == n
