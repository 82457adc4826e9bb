"""Batches of bounded files: how many there are, and how many tasks share one."""

import pytest
from pyspark.sql import functions as F

from hexflow.sources.tables import path_exists
from hexflow.streaming import jobs as S


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_bronze_of_bounded_batches_has_no_more_files_than_landed(small_splits, tmp_path):
    """A landed file of many splits doesn't become as many files, of which later streams take two a batch."""
    spark, landing, bronze = small_splits, f"{tmp_path}/landing", f"{tmp_path}/bronze"
    rows = spark.range(400).select(F.concat(F.lit('{"event_id":'), F.col("id").cast("string"), F.lit(',"currentSpeed":7,"pulled_at":"'), F.col("id").cast("string"), F.lit('"}')).alias("value"))
    rows.repartition(4).write.text(landing)
    schema = S.landing_schema(["event_id"])
    S.run_bronze(spark, landing, bronze, f"{tmp_path}/ckpt", schema, max_files=2)
    table = spark.read.schema(schema).parquet(bronze)
    assert sorted(int(r.event_id) for r in table.collect()) == list(range(400))
    assert len(table.inputFiles()) <= 4


def test_a_batch_of_one_file_takes_all_slots(spark, tmp_path):
    path, seen = f"{tmp_path}/table", []
    spark.range(1000).coalesce(1).write.parquet(path)

    def look(batch, _):
        seen.append((batch.select(F.spark_partition_id().alias("p")).distinct().count(), batch.agg(F.sum("id")).first()[0]))
    q = S.stream_table(spark, path, "id long", 1).writeStream.foreachBatch(look).option("checkpointLocation", f"{tmp_path}/ckpt").trigger(availableNow=True).start()
    S._drain(q)
    assert seen == [(spark.sparkContext.defaultParallelism, 499500)]


def test_streams_that_run_together_fail_as_one(spark, tmp_path):
    """The other's rows stay where its checkpoint says; both go on in the next run."""
    src = f"{tmp_path}/src"
    spark.range(8).repartition(4).write.parquet(src)
    good = lambda: S.stream_table(spark, src, "id long", 1)
    bad = good().select(F.when(F.col("id") < 99, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception):
        S.append_streams((good(), f"{tmp_path}/a", f"{tmp_path}/ca"), (bad, f"{tmp_path}/b", f"{tmp_path}/cb"))
    S.append_streams((good(), f"{tmp_path}/a", f"{tmp_path}/ca"), (good(), f"{tmp_path}/b", f"{tmp_path}/cb"))
    for t in "ab":
        assert path_exists(spark, f"{tmp_path}/{t}")
        assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/{t}").collect()) == list(range(8))
