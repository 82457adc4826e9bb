"""Registered queries over catalog tables, changing roads, hot cells and
sliding streams, with their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.parse import as_timestamp, parse_bronze
from ..operators.alerts import read_alert_log
from ..operators.enrich import MAX_SPEED, enrich, readings
from ..operators.roads import load_roads, road_index
from ..session import scratch_path
from ..sources import catalog as C
from ..sources.fixtures import bronze_view, landing_records, roads_view
from ..sources.tables import ensure_tables, with_window_date
from ..streaming import jobs as S
from ..streaming import sums as SU
from ..streaming import table_jobs as T
from . import maintenance as MT
from . import medallion as M
from . import oracle as O
from .registry import AS_OF, GOLD_OUT, LATE_SPLIT, LOOKUP_CELL, _alert_out, _alert_out_sql, _gold, _picks_sql, _two_landings, gold_out, gsql, register


def _database(spark, name: str) -> str:
    """A database of its own for one query, on the shared folder."""
    path = scratch_path(spark, name)
    return C.ensure_database(spark, f"{name}_{uuid.uuid4().hex[:8]}", path)


def _land(rows, path: str, files: int = 4) -> None:
    landing_records(rows).repartition(files).write.mode("append").text(path)


# ---------------------------------------------------------------- catalog tables

def _table_run(spark, sf_dir, name: str, second=None) -> str:
    """Roads loaded, all readings landed in two parts, a scheduled run after each."""
    db, base = _database(spark, name), scratch_path(spark, name)
    ensure_tables(spark, db)
    T.load_road_table(spark, db, roads_view(spark, sf_dir), as_of=AS_OF)
    for i, part in enumerate(_two_landings(spark, sf_dir, base)):
        part.write.mode("append").text(f"{base}/landing")
        T.run_scheduled_tables(spark, db, f"{base}/landing", f"{base}/ckpt", as_of=AS_OF, silver_columns=second if i else None)
    return db


# the gold stream's watermark moves between the two runs, so the second one's late windows are dropped
_LATE = ("valid_ev AS (SELECT e.full_road_name, e.ingest_time, ev.ts AS ets, e.currentSpeed, e.freeFlowSpeed, e.h3_id, e.osm_id, "
         "CASE WHEN 1.0::DOUBLE - e.currentSpeed::DOUBLE / nullif(e.freeFlowSpeed, 0) < 0 THEN 0.0::DOUBLE "
         "ELSE 1.0::DOUBLE - e.currentSpeed::DOUBLE / nullif(e.freeFlowSpeed, 0) END AS ci "
         "FROM enriched e JOIN events ev ON ev.event_id = e.event_id "
         f"WHERE e.currentSpeed <= {MAX_SPEED} AND e.full_road_name IS NOT NULL AND e.osm_id IS NOT NULL)")
_KEPT = (_LATE, f"run1 AS (SELECT * FROM valid_ev WHERE ets < {O.ts(LATE_SPLIT)})",
         "wm AS (SELECT max(ingest_time) - INTERVAL 1 SECOND AS w FROM run1)",
         f"kept AS (SELECT * FROM run1 UNION ALL SELECT v.* FROM valid_ev v, wm WHERE v.ets >= {O.ts(LATE_SPLIT)} "
         "AND time_bucket(INTERVAL '1 minute', v.ingest_time) + INTERVAL '1 minute' > wm.w)")


@register("stream_tables_gold", O.with_stages(f"SELECT {GOLD_OUT} FROM gold_k", (
    *_KEPT, O.gold_cte("gold_k").replace("FROM silver_ci", "FROM kept"))))
def stream_tables_gold(spark, sf_dir):
    """Two scheduled runs that read and write catalog tables only;
    the gold table, its partitions registered."""
    return gold_out(C.read(spark, f"{_table_run(spark, sf_dir, 'gold_tables')}.gold_traffic_stats"))


@register("silver_widen", O.with_stages(
    "SELECT h3_id, currentSpeed, freeFlowSpeed, CAST(NULL AS VARCHAR) AS road_name, osm_id, full_road_name, ingest_time, "
    f"CASE WHEN ets >= {O.ts(LATE_SPLIT)} THEN freeFlowSpeed - currentSpeed END AS speed_gap FROM valid_ev", (_LATE,)))
def silver_widen(spark, sf_dir):
    """K2: the second run's silver rows have a column more; the table is widened and
    rows of the first run read back NULL there."""
    db = _table_run(spark, sf_dir, "widened", {"speed_gap": F.col("freeFlowSpeed") - F.col("currentSpeed")})
    return C.read(spark, f"{db}.silver_traffic")


@register("table_ctas", O.with_stages(
    "SELECT h3_id, count(*) AS roads, count(full_road_name) AS named FROM crosswalk GROUP BY h3_id"))
def table_ctas(spark, sf_dir):
    """K4/K6: a table made as select, then replaced by one of another schema that reads it."""
    t = f"{_database(spark, 'ctas')}.crosswalk"
    C.create_or_replace_as(M.crosswalk_of(spark, sf_dir), t)
    C.create_or_replace_as(spark.table(t).groupBy("h3_id").agg(F.count(F.lit(1)).alias("roads"), F.count("full_road_name").alias("named")), t)
    return C.read(spark, t)


@register("table_statements", gsql(f"SELECT {GOLD_OUT} FROM gold WHERE traffic_status <> 'CLEAR'"))
def table_statements(spark, sf_dir):
    """Rows inserted, all truncated, others inserted by name (a column
    short), and a table dropped beside it."""
    db = _database(spark, "statements")
    ensure_tables(spark, db)
    t, gold = f"{db}.gold_traffic_stats", with_window_date(_gold(spark, sf_dir))
    gold.write.saveAsTable(f"{db}.gold_copy")
    C.insert_into(spark.table(f"{db}.gold_copy"), t)
    C.truncate(spark, t)
    C.insert_into(spark.table(f"{db}.gold_copy").where("traffic_status = 'HEAVY'"), t)
    C.insert_into(spark.table(f"{db}.gold_copy").where("traffic_status = 'GRIDLOCK'"), t)
    C.drop(spark, f"{db}.gold_copy")
    return gold_out(C.read(spark, t))


@register("road_load", O.with_stages(
    f"SELECT r.osm_id, r.name, r.fclass, i.h3_id, {O.dround('i.lon', 9)} AS lon FROM roads r JOIN road_index i ON i.osm_id = r.osm_id"))
def road_load(spark, sf_dir):
    """Extracted roads (with a column to drop) loaded into the road table, which feeds the index table."""
    db = _database(spark, "roads")
    ensure_tables(spark, db)
    T.load_road_table(spark, db, roads_view(spark, sf_dir).withColumn("geometry", F.col("geometry_wkt").cast("binary")), as_of=AS_OF)
    roads, index = C.read(spark, f"{db}.bronze_osm_roads"), C.read(spark, f"{db}.silver_osm_enriched")
    if "geometry" in roads.columns:
        raise AssertionError("the binary geometry is to be dropped")
    return roads.join(index, "osm_id").select("osm_id", "name", "fclass", "h3_id", F.round("lon", 9).alias("lon"))


@register("layout_on_write", O.with_stages(
    f"SELECT h3_id, osm_id, full_road_name, TRUE AS in_few_files FROM crosswalk WHERE h3_id = '{LOOKUP_CELL}'"))
def layout_on_write(spark, sf_dir):
    """M3: the crosswalk table written clustered on the cell into eight files; the
    lookup's cell lies within the bounds of at most two of them."""
    db = _database(spark, "layout")
    ensure_tables(spark, db)
    t = f"{db}.silver_road_crosswalk"
    C.overwrite(M.crosswalk_of(spark, sf_dir), t, cluster_by="h3_id", files=8)
    rows = C.read(spark, t)
    bounds = rows.groupBy(F.input_file_name().alias("file")).agg(F.min("h3_id").alias("a"), F.max("h3_id").alias("b"))
    few = bounds.agg((F.count_if((F.col("a") <= LOOKUP_CELL) & (F.col("b") >= LOOKUP_CELL)) <= 2).alias("in_few_files"), F.max(F.lit(LOOKUP_CELL)).alias("h3_id"))
    return rows.where(F.col("h3_id") == LOOKUP_CELL).join(F.broadcast(few), "h3_id").select("h3_id", "osm_id", "full_road_name", "in_few_files")


@register("compact_reduction", "SELECT TRUE AS fewer_files, TRUE AS smaller, TRUE AS percent_fits, count(*) > 0 AS any_rows FROM events")
def compact_reduction(spark, sf_dir):
    """M6: percent reduction of files and bytes by compaction."""
    target = scratch_path(spark, "reduction")
    with_window_date(_gold(spark, sf_dir)).repartition(16).write.partitionBy("window_date").parquet(target)
    r = MT.compact(spark, target, partition_col="window_date")
    files, size = (MT.reduction(r[f"{k}_before"], r[f"{k}_after"]) for k in ("files", "bytes"))
    left = spark.read.parquet(target).agg((F.count(F.lit(1)) > 0).alias("any_rows"))
    return left.select(F.lit(files > 0).alias("fewer_files"), F.lit(size > 0).alias("smaller"),
                       F.lit(round(r["files_before"] * (1 - files / 100)) == r["files_after"]).alias("percent_fits"), "any_rows")


# ---------------------------------------------------------------- joins

@register("enrich_hot_cell", O.with_stages(
    "SELECT h.h3_id, h.currentSpeed, h.freeFlowSpeed, m.osm_id, m.full_road_name, h.ingest_time "
    "FROM hot h LEFT JOIN crosswalk m ON lower(h.h3_id) = lower(m.h3_id)",
    (f"hot AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '{LOOKUP_CELL}' ELSE h3_id END AS h3_id, currentSpeed, freeFlowSpeed, ingest_time FROM readings)",)))
def enrich_hot_cell(spark, sf_dir):
    """A third of the readings on one cell, the crosswalk beyond the broadcast bound: salted join."""
    rows = readings(bronze_view(spark, sf_dir), as_of=AS_OF, keep=("event_id",))
    hot = rows.select(F.when(F.col("event_id") % 3 == 0, F.lit(LOOKUP_CELL)).otherwise(F.col("h3_id")).alias("h3_id"),
                      "currentSpeed", "freeFlowSpeed", "ingest_time")
    return enrich(hot, M.crosswalk_of(spark, sf_dir), max_broadcast_rows=0)


# ---------------------------------------------------------------- streams

@register("crosswalk_changed_roads", O.with_stages("SELECT h3_id, osm_id, full_road_name FROM crosswalk"))
def crosswalk_changed_roads(spark, sf_dir):
    """Between two runs roads are renamed, moved, added and removed; the
    crosswalk equals a rebuild."""
    base = scratch_path(spark, "changed-roads")
    p, roads = S.scheduled_paths(base), roads_view(spark, sf_dir)
    k = F.col("osm_id").cast("long")
    gone = roads.where(k % 7 == 1).withColumn("osm_id", F.concat(F.lit("gone"), "osm_id"))
    before = (roads.where(k % 5 != 4).withColumn("name", F.when(k % 3 == 0, F.concat(F.lit("OLD_"), F.coalesce("name", F.lit("x")))).otherwise(F.col("name")))
              .withColumn("geometry_wkt", F.when(k % 11 == 2, F.lit("LINESTRING (-74.11 40.11, -74.1102 40.11)")).otherwise(F.col("geometry_wkt"))))
    first, second = _two_landings(spark, sf_dir, base)
    first.write.text(p["landing"])
    S.run_scheduled(spark, base, road_index(before.unionByName(gone), as_of=AS_OF), as_of=AS_OF)
    second.write.mode("append").text(p["landing"])
    S.run_scheduled(spark, base, road_index(roads, as_of=AS_OF), as_of=AS_OF)
    return S.read_crosswalk(spark, p["crosswalk"])


@register("stream_gold_sliding", O.with_stages(f"SELECT {GOLD_OUT} FROM gold_s", (O.gold_cte("gold_s", 10, 1),)))
def stream_gold_sliding(spark, sf_dir):
    """10-minute windows sliding by 1 minute as a stream: sums per bucket, windows of whole buckets."""
    base = scratch_path(spark, "sliding")
    _land(bronze_view(spark, sf_dir), f"{base}/landing")
    schema = S.landing_schema(["event_id"])
    S.run_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ckpt/bronze", schema)
    SU.run_gold_sums(S.stream_table(spark, f"{base}/bronze", schema), M.crosswalk_of(spark, sf_dir), f"{base}/sums", f"{base}/gold",
                     f"{base}/ckpt/gold", "10 minutes", "1 minute", as_of=AS_OF)
    return gold_out(spark.read.parquet(f"{base}/gold"))


@register("stream_gold_silver", gsql(f"SELECT {GOLD_OUT} FROM gold"))
def stream_gold_silver(spark, sf_dir):
    """The gold stream over stored silver rows, in update mode."""
    base = scratch_path(spark, "gold-silver")
    p = S.scheduled_paths(base)
    _land(bronze_view(spark, sf_dir), p["landing"], 8)
    S.run_scheduled(spark, base, M.road_index_of(spark, sf_dir), as_of=AS_OF, gold_from="silver")
    return gold_out(spark.read.parquet(p["gold"]))


@register("stream_reader_options", O.with_stages(
    "SELECT event_id, lat, lon, currentSpeed, freeFlowSpeed, ingest_time FROM parsed WHERE event_id % 2 = 0"))
def stream_reader_options(spark, sf_dir):
    """A reader option (a glob on file names) reaches the landing stream."""
    base = scratch_path(spark, "options")
    p, b = S.scheduled_paths(base), bronze_view(spark, sf_dir)
    _land(b.where("event_id % 2 = 0"), p["landing"])
    landing_records(b.where("event_id % 2 = 1")).write.mode("append").option("compression", "gzip").text(p["landing"])
    S.run_scheduled(spark, base, M.road_index_of(spark, sf_dir), as_of=AS_OF, reader_options={"pathGlobFilter": "*.txt"})
    return parse_bronze(spark.read.parquet(p["bronze"]), as_of=AS_OF).select(
        F.col("event_id").cast("long").alias("event_id"), "lat", "lon", "currentSpeed", "freeFlowSpeed", "ingest_time")


@register("stream_replay_alerts", O.with_stages(
    f"SELECT * EXCLUDE (batch_id) FROM ({_alert_out_sql('picks1', AS_OF, 0)}) UNION ALL "
    f"SELECT * EXCLUDE (batch_id) FROM ({_alert_out_sql('(SELECT * FROM picks2 WHERE road_name NOT IN (SELECT road_name FROM picks1))', AS_OF, 0)})",
    (_LATE, f"run1 AS (SELECT * FROM valid_ev WHERE ets < {O.ts(LATE_SPLIT)})", O.gold_cte("gold1").replace("FROM silver_ci", "FROM run1"), O.gold_cte("gold"),
     _picks_sql("picks1", AS_OF, 30, "gold1"), _picks_sql("picks2", AS_OF, 30))))
def stream_replay_alerts(spark, sf_dir):
    """A run, more landed files, then a replay with new checkpoints and other
    batches: roads alerted before stay in their cooldown, nothing is sent twice."""
    base = scratch_path(spark, "replay-alerts")
    p, index = S.scheduled_paths(base), M.road_index_of(spark, sf_dir)
    first, second = _two_landings(spark, sf_dir, base)
    first.write.text(p["landing"])
    S.run_scheduled(spark, base, index, as_of=AS_OF)
    second.write.mode("append").text(p["landing"])
    S.replay(spark, base, index, "bronze", as_of=AS_OF, max_files=2)
    return _alert_out(read_alert_log(spark, p["alerts"])).drop("run_id", "batch_id")
