"""Catalog tables, changing roads, hot cells, partial sums, replay order, pruning."""

import pytest
from pyspark.sql import functions as F

from hexflow.operators.enrich import enrich, hot_cells, join_crosswalk, join_crosswalk_salted
from hexflow.plans import dashboard as D
from hexflow.plans import medallion as M
from hexflow.session import scratch_path
from hexflow.sources import catalog as C
from hexflow.sources.fixtures import FIXTURE_AS_OF, bronze_view, landing_records
from hexflow.sources.tables import delete_matching, delete_path, with_window_date
from hexflow.streaming import jobs as S
from hexflow.streaming import sums as SU

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def db(spark):
    name = f"t_{scratch_path(spark, 'x').rsplit('-', 1)[-1]}"
    yield C.ensure_database(spark, name, scratch_path(spark, name))
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---------------------------------------------------------------- catalog

def test_replace_reads_the_table_it_replaces(spark, db):
    t = f"{db}.a"
    C.create_or_replace_as(spark.range(3), t)
    C.create_or_replace_as(spark.table(t).selectExpr("id * 2 AS x", "'s' AS y"), t)
    assert rows(C.read(spark, t)) == [(0, "s"), (2, "s"), (4, "s")]
    assert not C.exists(spark, t + C.STAGED) and not C.exists(spark, t + C.OLD)


def test_interrupted_swap_is_undone(spark, db):
    t = f"{db}.a"
    C.create_or_replace_as(spark.range(3), t)
    spark.sql(f"ALTER TABLE {t} RENAME TO {t}{C.OLD}")                  # a crash between the two renames
    C.recover(spark, t)
    assert rows(C.read(spark, t)) == [(0,), (1,), (2,)]
    C.create_or_replace_as(spark.range(1), t)
    assert rows(C.read(spark, t)) == [(0,)]


def test_failed_replacement_leaves_the_table(spark, db):
    t = f"{db}.a"
    C.create_or_replace_as(spark.range(3), t)
    with pytest.raises(Exception, match="boom"):
        C.create_or_replace_as(spark.range(3).select(F.raise_error(F.lit("boom")).alias("x")), t)
    assert rows(C.read(spark, t)) == [(0,), (1,), (2,)]
    C.create_or_replace_as(spark.range(2), t)
    assert rows(C.read(spark, t)) == [(0,), (1,)]


def test_insert_widens_and_overwrite_keeps_the_schema(spark, db):
    t = f"{db}.a"
    C.create_typed(spark, t, "id long, day string", "day")
    C.insert_into(spark.sql("SELECT 'd' AS day, 1L AS id"), t)
    C.overwrite(spark.sql("SELECT id + 1 AS id, day FROM " + t), t)
    assert rows(C.read(spark, t).select("id", "day")) == [(2, "d")]
    u = f"{db}.b"
    C.create_typed(spark, u, "id long")
    C.insert_into(spark.range(1), u)
    C.insert_into(spark.sql("SELECT 'n' AS note, 5L AS id"), u)
    assert sorted((r.id, r.note) for r in C.read(spark, u).collect()) == [(0, None), (5, "n")]
    C.truncate(spark, u)
    assert C.read(spark, u).count() == 0 and C.read(spark, u).columns == ["id", "note"]


def test_stream_between_tables(spark, db):
    base = scratch_path(spark, "tables")
    landing_records(bronze_view(spark, SMALL)).repartition(3).write.text(f"{base}/landing")
    C.create_typed(spark, f"{db}.bronze", "pulled_at string")
    C.stream_into(S.stream_landing(spark, f"{base}/landing", S.landing_schema(["event_id"])), f"{db}.bronze", f"{base}/c1")
    C.stream_into(C.stream_from(spark, f"{db}.bronze", 1).select("event_id"), f"{db}.ids", f"{base}/c2")
    C.stream_into(C.stream_from(spark, f"{db}.bronze", 1).select("event_id"), f"{db}.ids", f"{base}/c2")
    assert C.read(spark, f"{db}.ids").select("event_id").distinct().count() == C.read(spark, f"{db}.ids").count() == 1000


# ---------------------------------------------------------------- roads, cells

def _index(spark, data):
    return spark.createDataFrame(data, "h3_id string, osm_id string, full_road_name string")


def test_changed_roads_reach_the_crosswalk(spark):
    base = scratch_path(spark, "cw")
    p = {k: f"{base}/{k}" for k in ("cw", "seen", "roads")}
    old = [("a", "1", "Old"), ("a", "2", "Gone"), ("b", "3", None), ("b", "4", "Moves"), ("z", "5", "Unseen"), ("a", None, "NoId")]
    new = [("a", "1", "New"), ("b", "3", None), ("a", "4", "Moves"), ("z", "5", "Still unseen"), ("a", None, "NoId"), ("b", "6", "Added")]
    spark.createDataFrame([("a", 0), ("b", 1)], "h3_id string, batch_id long").write.partitionBy("batch_id").parquet(p["seen"])
    first = _index(spark, old).where("h3_id <> 'z'").withColumn("batch_id", F.when(F.col("h3_id") == "a", 0).otherwise(1).cast("long"))
    first.write.partitionBy("batch_id").parquet(p["cw"])
    _index(spark, old).write.parquet(p["roads"])
    assert S.refresh_crosswalk(spark, _index(spark, new), p["cw"], p["seen"], p["roads"]) > 0
    want = sorted(map(str, [r for r in new if r[0] != "z"]))
    got = S.read_crosswalk(spark, p["cw"]).select("h3_id", "osm_id", "full_road_name")
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert S.refresh_crosswalk(spark, _index(spark, new), p["cw"], p["seen"], p["roads"]) == 0
    # a crash before the kept index was replaced: the same changes once more
    _index(spark, old).write.mode("overwrite").parquet(p["roads"])
    S.refresh_crosswalk(spark, _index(spark, new), p["cw"], p["seen"], p["roads"])
    assert sorted(str(tuple(r)) for r in S.read_crosswalk(spark, p["cw"]).select("h3_id", "osm_id", "full_road_name").collect()) == want


def test_delete_matching_leaves_other_partitions(spark):
    target = scratch_path(spark, "dm")
    spark.createDataFrame([(i, i % 3) for i in range(9)], "k long, p long").write.partitionBy("p").parquet(target)
    assert delete_matching(spark, target, spark.createDataFrame([(0,), (3,), (6,), (1,)], "k long"), ("k",), "p", "k long, p long") == 2
    assert rows(spark.read.parquet(target).select("k")) == [(2,), (4,), (5,), (7,), (8,)]


def test_salted_join_equals_plain_and_spreads_the_hot_cell(spark):
    reads = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'HOT' WHEN id % 100 = 1 THEN NULL ELSE concat('c', id % 900) END AS h3_id",
                                           "CAST(id % 90 AS int) AS currentSpeed", "30 AS freeFlowSpeed", "timestamp_seconds(id) AS ingest_time")
    side = spark.range(0, 900, 2).selectExpr("concat('C', id) AS h3_id", "CAST(id AS string) AS osm_id", "'r' AS full_road_name").unionByName(
        spark.range(5).selectExpr("'hot' AS h3_id", "concat('h', id) AS osm_id", "'hot road' AS full_road_name"))
    assert set(hot_cells(reads, 8)) == {"hot"} and hot_cells(reads, 8)["hot"] == 3
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = join_crosswalk_salted(reads, side, 24).cache()
        assert rows(salted.select("h3_id", "currentSpeed", "osm_id").where("h3_id IS NOT NULL")) == rows(
            join_crosswalk(reads, side).select("h3_id", "currentSpeed", "osm_id").where("h3_id IS NOT NULL"))
        assert salted.count() == join_crosswalk(reads, side).count()
        parts = sorted(r["count"] for r in join_crosswalk_salted(reads, side, 64).groupBy(F.spark_partition_id()).count().collect())
        plain = sorted(r["count"] for r in join_crosswalk(reads, side).groupBy(F.spark_partition_id()).count().collect())
        assert parts[-1] < 0.6 * plain[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" not in enrich(reads, side, max_broadcast_rows=0)._jdf.queryExecution().optimizedPlan().toString()


# ---------------------------------------------------------------- gold

def test_sums_streamed_in_parts_equal_the_batch(spark):
    """Batches that touch the same windows again, tumbling and sliding."""
    base = scratch_path(spark, "sums")
    xw, bronze = M.crosswalk_of(spark, SMALL), bronze_view(spark, SMALL)
    schema = S.landing_schema(["event_id"])
    for size, slide in (("1 minute", None), ("10 minutes", "5 minutes")):
        b = f"{base}/{size.split()[0]}"
        for i in range(2):
            landing_records(bronze.where(f"event_id % 2 = {i}")).coalesce(2).write.mode("append").text(f"{b}/landing")
            S.run_bronze(spark, f"{b}/landing", f"{b}/bronze", f"{b}/c/bronze", schema)
            SU.run_gold_sums(S.stream_table(spark, f"{b}/bronze", schema), xw, f"{b}/sums", f"{b}/gold", f"{b}/c/gold", size, slide,
                             watermark="60 days", as_of=FIXTURE_AS_OF)
        want = M.gold_of(spark, SMALL, size, slide)
        columns = ("road_name", "window_start", "traffic_status", "total_observations")
        assert rows(spark.read.parquet(f"{b}/gold").select(*columns)) == rows(want.select(*columns))


def test_recent_queries_open_their_days_only(spark):
    target = scratch_path(spark, "gold-days")
    with_window_date(M.gold_of(spark, SMALL)).write.partitionBy("window_date").parquet(target)
    gold = spark.read.parquet(target)
    from hexflow.operators.alerts import recent_gridlocks
    for df in (D.avg_ci_last_2h(gold, FIXTURE_AS_OF), D.kpi_24h_pop(gold, FIXTURE_AS_OF), D.active_gridlocks(gold, FIXTURE_AS_OF),
               recent_gridlocks(gold, FIXTURE_AS_OF)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters"):].split("]")[0]
        assert "window_date" in filters and ">=" in filters


# ---------------------------------------------------------------- replay

def test_lost_tables_and_checkpoints_are_refused(spark):
    base = scratch_path(spark, "lost")
    p, index = S.scheduled_paths(base), M.road_index_of(spark, SMALL)
    parts = [bronze_view(spark, SMALL).where(f"event_id % 2 = {i}") for i in range(2)]
    landing_records(parts[0]).coalesce(2).write.text(p["landing"])
    S.run_scheduled(spark, base, index, as_of=FIXTURE_AS_OF)
    before = spark.read.parquet(p["gold"]).count()
    for table in ("gold", "silver", "crosswalk"):
        delete_path(spark, p[table])
        with pytest.raises(RuntimeError, match="replay"):
            S.run_scheduled(spark, base, index, as_of=FIXTURE_AS_OF)
        S.replay(spark, base, index, "crosswalk", as_of=FIXTURE_AS_OF)
        assert spark.read.parquet(p["gold"]).count() == before
    # a replay that stops after its first deletion is refused too, then run again
    delete_path(spark, f"{p['ckpt']}/gold")
    with pytest.raises(RuntimeError, match="replay"):
        S.run_scheduled(spark, base, index, as_of=FIXTURE_AS_OF)
    landing_records(parts[1]).coalesce(2).write.mode("append").text(p["landing"])
    S.replay(spark, base, index, as_of=FIXTURE_AS_OF)
    assert spark.read.parquet(p["gold"]).count() == M.gold_of(spark, SMALL).count()
