"""Upsert, delete and compaction on plain Parquet."""

import datetime as dt

from pyspark.sql import functions as F

from hexflow.plans.maintenance import compact, range_layout, table_detail
from hexflow.session import scratch_path
from hexflow.sources.tables import delete_where, upsert

SCHEMA = ("road_name string, window_start timestamp, window_end timestamp, avg_congestion_index double, "
          "traffic_status string, total_observations int")


def _g(spark, rows):
    return spark.createDataFrame([(r, dt.datetime(2024, 1, d, 10, m), dt.datetime(2024, 1, d, 10, m + 1), v,
                                   "CLEAR", n) for r, d, m, v, n in rows], SCHEMA)


def test_upsert_latest_wins_and_is_idempotent(spark):
    target = scratch_path(spark, "t-upsert")
    upsert(spark, target, _g(spark, [("A", 1, 0, 0.1, 1), ("B", 1, 0, 0.2, 1), ("A", 2, 0, 0.3, 1)]))
    batch = _g(spark, [("A", 1, 0, 0.5, 2), ("C", 1, 5, 0.6, 1)])
    upsert(spark, target, batch)
    upsert(spark, target, batch)   # replay of the same batch
    got = sorted((r.road_name, r.window_start.day, r.avg_congestion_index, r.total_observations)
                 for r in spark.read.parquet(target).collect())
    assert got == [("A", 1, 0.5, 2), ("A", 2, 0.3, 1), ("B", 1, 0.2, 1), ("C", 1, 0.6, 1)]


def test_upsert_dedupes_keys_within_a_batch(spark):
    target = scratch_path(spark, "t-upsert-dup")
    b = _g(spark, [("A", 1, 0, 0.1, 1), ("A", 1, 0, 0.9, 5)])
    upsert(spark, target, b, order_col="total_observations")
    assert [(r.avg_congestion_index) for r in spark.read.parquet(target).collect()] == [0.9]


def test_delete_where_counts_and_drops_empty_partitions(spark):
    target = scratch_path(spark, "t-delete")
    upsert(spark, target, _g(spark, [("A", 1, 0, 0.1, 1), ("B", 1, 0, 0.2, 1), ("A", 2, 0, 0.3, 1)]))
    assert delete_where(spark, target, "road_name = 'A'") == 2
    got = [(r.road_name, r.window_date.day) for r in spark.read.parquet(target).collect()]
    assert got == [("B", 1)]
    assert delete_where(spark, target, "road_name = 'Z'") == 0


def test_compact_keeps_rows_and_reduces_files(spark):
    target = scratch_path(spark, "t-compact")
    spark.range(1000).withColumn("k", F.col("id") % 7).repartition(20).write.parquet(target)
    before = table_detail(spark, target).first()
    res = compact(spark, target)
    assert before.num_files == 20 and res["files_after"] == 1
    assert spark.read.parquet(target).count() == 1000


def test_range_layout_narrows_file_ranges(spark):
    target = scratch_path(spark, "t-range")
    range_layout(spark.range(1000).withColumn("key", (F.col("id") * 7919) % 1000), "key", 4).write.parquet(target)
    ranges = (spark.read.parquet(target).groupBy(F.col("_metadata.file_path"))
              .agg(F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("lo").collect())
    assert len(ranges) == 4
    assert all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))


def test_ddl_insert_truncate_drop(spark):
    from hexflow.sources.tables import ensure_tables
    db = "hexflow_t_" + scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'db')}'")
    made = ensure_tables(spark, db)
    assert made == ensure_tables(spark, db)                   # IF NOT EXISTS: idempotent
    spark.sql(f"INSERT INTO {db}.gold_traffic_stats VALUES ('Main', TIMESTAMP'2024-01-01 10:00:00', "
              "TIMESTAMP'2024-01-01 10:01:00', 0.92, 'GRIDLOCK', 1, DATE'2024-01-01')")
    assert spark.table(f"{db}.gold_traffic_stats").count() == 1
    spark.sql(f"CREATE TABLE {db}.gold_copy USING parquet AS SELECT * FROM {db}.gold_traffic_stats")
    assert spark.table(f"{db}.gold_copy").first().traffic_status == "GRIDLOCK"
    spark.sql(f"TRUNCATE TABLE {db}.gold_copy")
    assert spark.table(f"{db}.gold_copy").count() == 0
    spark.sql(f"DROP TABLE IF EXISTS {db}.gold_copy")
    assert not spark.catalog.tableExists(f"{db}.gold_copy")
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_upsert_leaves_no_staging(spark):
    import os
    target = scratch_path(spark, "t-upsert-clean")
    root = os.path.dirname(target)
    before = set(os.listdir(root))
    upsert(spark, target, _g(spark, [("A", 1, 0, 0.1, 1)]))
    new = set(os.listdir(root)) - before
    assert [n for n in new if n.startswith("upsert-")] == []


def test_append_with_schema_widening(spark):
    from hexflow.sources.tables import read_merged
    target = scratch_path(spark, "t-widen")
    spark.createDataFrame([("a", 1)], "h3_id string, currentSpeed int").write.parquet(target)
    spark.createDataFrame([("b", 2, "Main")], "h3_id string, currentSpeed int, full_road_name string") \
        .write.mode("append").parquet(target)
    got = sorted((r.h3_id, r.full_road_name) for r in read_merged(spark, target).collect())
    assert got == [("a", None), ("b", "Main")]


def test_reduction_percent():
    from hexflow.plans.maintenance import reduction
    assert reduction(29, 1) == (29 - 1) * 100.0 / 29
    assert reduction(0, 0) == 0.0


def test_upsert_keeps_one_row_per_key_and_null_partitions(spark):
    target = scratch_path(spark, "t-upsert-null")
    schema = "road_name string, window_start timestamp, v int, window_date date"
    t = dt.datetime(2024, 1, 1)
    df = lambda rows: spark.createDataFrame(rows, schema)
    upsert(spark, target, df([("A", t, 1, None), ("B", t, 2, None), ("C", t, 3, t.date())]))
    upsert(spark, target, df([("C", t, 4, t.date()), ("C", t, 5, t.date()), ("D", t, 6, None), (None, t, 7, None)]))
    upsert(spark, target, df([(None, t, 8, None)]))
    rows = sorted((str(r.road_name), r.v) for r in spark.read.parquet(target).collect())
    assert rows == [("A", 1), ("B", 2), ("C", 5), ("D", 6), ("None", 8)]
    assert delete_where(spark, target, "v <> 5") == 4
    assert [r.road_name for r in spark.read.parquet(target).collect()] == ["C"]


def test_compact_splits_a_large_day_and_refuses_stream_sinks(spark):
    import pytest
    from hexflow.plans.maintenance import recover_compaction
    from hexflow.plans import maintenance as MT
    target = scratch_path(spark, "t-compact-day")
    big = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"),
                                     F.when(F.col("id") < 59_000, "d1").otherwise("d2").alias("day"))
    big.repartition(12).write.partitionBy("day").parquet(target)
    res = compact(spark, target, target_bytes=500_000, partition_col="day")
    files = {r.day: r["count"] for r in spark.read.parquet(target).select("day", F.col("_metadata.file_path").alias("f")).distinct().groupBy("day").count().collect()}
    assert files["d1"] >= 4 and files["d2"] == 1 and res["files_after"] < res["files_before"]
    assert spark.read.parquet(target).count() == 60_000
    MT._rename(spark, target, MT._old(target))          # a crash between the two renames
    recover_compaction(spark, target)
    assert spark.read.parquet(target).count() == 60_000
    spark.createDataFrame([("x",)], "v string").write.text(f"{target}/_spark_metadata")
    with pytest.raises(ValueError):
        compact(spark, target)
