from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lavra import scratch, sinks
from tests.helpers import plan, rows


def data_files(path):
    return [p for p in Path(path).rglob("*.parquet")]


def test_write_table_replaces_and_honours_the_codec(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(5), path)
    sinks.write_table(spark.range(3), path, codec="snappy")
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]
    assert all(p.name.endswith(".snappy.parquet") for p in data_files(path))


def test_files_hold_at_most_so_many_records(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(0, 100, 1, 1), path, max_records=30)
    counts = [spark.read.parquet(str(p)).count() for p in data_files(path)]
    assert sorted(counts) == [10, 30, 30, 30]


def test_partitioned_write_makes_few_files_and_splits_a_hot_value(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 80_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "quente")
        .otherwise(F.concat(F.lit("A"), (F.col("id") % 5).cast("string")))
        .alias("estacao"),
        F.sha2(F.col("id").cast("string"), 256).alias("texto"),
    )
    assert "RebalancePartitions" in df.hint("rebalance", "estacao")._jdf.queryExecution().optimizedPlan().toString()
    sinks.write_partitioned(df, path, ["estacao"])
    assert spark.read.parquet(path).count() == 80_000
    assert len(data_files(path)) <= 8
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        sinks.write_partitioned(df, path, ["estacao"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(data_files(f"{path}/estacao=quente")) > 1
    assert rows(spark.read.parquet(path).groupBy("estacao").count()) == rows(
        df.groupBy("estacao").count()
    )


def test_a_rerun_replaces_only_its_periods(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(2023, 1, "a"), (2023, 2, "b"), (2024, 1, "c")], "ano int, mes int, v string"
    )
    sinks.write_periods(df, path)
    sinks.write_periods(df.filter("mes = 2").withColumn("v", F.lit("B")), path)
    sinks.write_periods(df.filter("mes = 2").withColumn("v", F.lit("B")), path)
    found = spark.read.parquet(path).select("ano", "mes", "v")
    assert rows(found) == [(2023, 1, "a"), (2023, 2, "B"), (2024, 1, "c")]


def test_materialized_tables_live_in_the_shared_folder(spark):
    df = spark.range(10).selectExpr("id", "cast(null as string) v")
    stored = scratch.materialize(df, "t")
    assert rows(stored) == rows(df)
    assert scratch.shared_folder(spark) in plan(stored)
    assert "Range" not in plan(stored)


def session(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: settings.get(name.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_shared_folder_is_the_one_the_cluster_names():
    named = session("spark://x", spark_checkpoint_dir="hdfs:///shared/")
    assert scratch.shared_folder(named) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(session("spark://x"))
    assert Path(scratch.shared_folder(session("local[2]"))).is_dir()
