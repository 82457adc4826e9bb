"""The query registry: Spark plans and their DuckDB twins, by name.

Every query reads the driver tables (``events`` as landed readings,
``customer`` as roads) whole, and derives everything else with Spark. Keys
(``stable_round`` / ``oracle.rnd``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.congestion import STATUS_DECIMALS, stable_round
from ..functions.geo import add_cell, cell_of, wkt_centroid
from ..functions.parse import as_timestamp, parse_bronze, parse_ctime
from ..operators.alerts import ALERT_TEXT, gridlock_alerts, replay_alerts
from ..operators.enrich import (MAX_SPEED, REASON_NO_MATCH, REASON_SPEED, REASON_UNNAMED, REASON_UNPARSED,
                                SILVER_COLUMNS)
from ..operators.joins import materialize
from ..operators.roads import build_crosswalk, reading_cells, traffic_cells
from ..operators.windows import congestion_windows, gold_from_readings
from ..session import scratch_path
from ..sources.fixtures import FIXTURE_AS_OF, bronze_view, landing_records, roads_view
from ..sources.tables import delete_where, upsert
from ..streaming import jobs as S
from . import dashboard as D
from . import maintenance as MT
from . import medallion as M
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

AS_OF = FIXTURE_AS_OF
TZ = D.LOCAL_TZ
# Parameters of the registered dashboard/alert queries (fixed values).
TREND_ROAD = "ROAD_1"
AREA_LIKE = "ROAD_1%"
FILTER_ROADS = ("ROAD_1", "ROAD_2")
FILTER_STATUSES = ("GRIDLOCK", "HEAVY")
FILTER_START, FILTER_END = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
ALERT_RECENCY_MIN = 24 * 60          # alerts over the last day of windows
# Cooldown check: a first micro-batch (readings before FIRST_BATCH_END) alerts
# at FIRST_BATCH_END; the next batch (all readings) alerts 20 minutes later.
FIRST_BATCH_END, SECOND_RUN = "2024-01-30 12:00:00", "2024-01-30 12:20:00"
COOLDOWN_RECENCY_MIN = 60
LOOKUP_CELL = cell_of(-74.11000, 40.11000)   # the traffic point of spot 5
UPSERT_FIRST_BEFORE, UPSERT_SECOND_FROM = "2024-01-16 00:00:00", "2024-01-10 00:00:00"
LATE_SPLIT = "2024-01-16 00:00:00"   # landing of run 1: events before; run 2: the rest


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c, name: str | None = None):
    col = stable_round(c, 6)
    return col.alias(name) if name else col


def loc(c: str = "window_start") -> str:
    return f"timezone('{TZ}', timezone('UTC', {c}))"


def gsql(final: str, *extra: str) -> str:
    """SQL over the stage CTEs plus the 1-minute ``gold`` CTE."""
    return O.with_stages(final, (O.gold_cte("gold"), *extra))


GOLD_OUT = (f"road_name, window_start, window_end, {O.rnd('avg_congestion_index', 6)} AS avg_congestion_index, "
            "traffic_status, total_observations")


def gold_out(df: DataFrame) -> DataFrame:
    return df.select("road_name", "window_start", "window_end", r6("avg_congestion_index", "avg_congestion_index"),
                     "traffic_status", "total_observations")


def _gold(spark, sf_dir):
    return M.gold_of(spark, sf_dir)


# ---------------------------------------------------------------- bronze / parse

@register("bronze_parse", O.with_stages(
    "SELECT event_id, lat, lon, currentSpeed, freeFlowSpeed, ingest_time FROM parsed"))
def bronze_parse(spark, sf_dir):
    """Three payload shapes, safe casts, event time with fallback."""
    return parse_bronze(bronze_view(spark, sf_dir), as_of=AS_OF).select(
        "event_id", "lat", "lon", "currentSpeed", "freeFlowSpeed", "ingest_time")


@register("ctime_parse", O.with_stages(
    "SELECT event_id, pulled_at, try_strptime(regexp_replace(substring(pulled_at, 5), ' +', ' ', 'g'), "
    "'%b %d %H:%M:%S %Y') AS parsed_time FROM bronze"))
def ctime_parse(spark, sf_dir):
    """Space-padded ctime text to TIMESTAMP, NULL when unparseable."""
    return bronze_view(spark, sf_dir).select("event_id", "pulled_at", parse_ctime("pulled_at").alias("parsed_time"))


@register("geo_cell", O.with_stages("SELECT event_id, lon, lat, h3_id FROM readings_all"))
def geo_cell_q(spark, sf_dir):
    """Hexagonal cell of every parsed reading (NULL without a point)."""
    return add_cell(parse_bronze(bronze_view(spark, sf_dir), as_of=AS_OF)).select("event_id", "lon", "lat", "h3_id")


@register("bronze_range", O.with_stages(
    "SELECT count(*) AS total_rows, "
    f"{loc('min(t)')} AS oldest_record_est, {loc('max(t)')} AS newest_record_est "
    "FROM (SELECT try_strptime(regexp_replace(substring(pulled_at, 5), ' +', ' ', 'g'), '%b %d %H:%M:%S %Y') AS t "
    "FROM bronze)"))
def bronze_range(spark, sf_dir):
    """Row count and oldest/newest reading in local time (parsed first, hazard H3 of SURVEY §7.1)."""
    t = parse_ctime("pulled_at")
    return bronze_view(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.from_utc_timestamp(F.min(t), TZ).alias("oldest_record_est"),
        F.from_utc_timestamp(F.max(t), TZ).alias("newest_record_est"))


# ---------------------------------------------------------------- roads

@register("road_centroid", O.with_stages(
    f"SELECT osm_id, {O.dround('lon', 9)} AS lon, {O.dround('lat', 9)} AS lat FROM road_c"))
def road_centroid(spark, sf_dir):
    """WKT line centroid (length-weighted segment midpoints)."""
    c = wkt_centroid("geometry_wkt")
    return roads_view(spark, sf_dir).select("osm_id", F.round(c["lon"], 9).alias("lon"),
                                            F.round(c["lat"], 9).alias("lat"))


@register("road_index", O.with_stages(
    f"SELECT osm_id, full_road_name, {O.dround('lat', 9)} AS lat, {O.dround('lon', 9)} AS lon, h3_id, "
    f"{O.ts(AS_OF)} AS ingest_time FROM road_index"))
def road_index_q(spark, sf_dir):
    """S7/C:133-147: every road with centroid, cell and load time."""
    return M.road_index_of(spark, sf_dir).select(
        "osm_id", "full_road_name", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"), "h3_id",
        "ingest_time")


def _crosswalk(strategy):
    def q(spark, sf_dir):
        return M.crosswalk_of(spark, sf_dir, strategy, materialized=False)
    return q


_XW_SQL = O.with_stages("SELECT h3_id, osm_id, full_road_name FROM crosswalk")
register("road_crosswalk", _XW_SQL)(_crosswalk("auto"))        # J1, broadcast of checked size
register("crosswalk_smj", _XW_SQL)(_crosswalk("merge"))        # J4
register("crosswalk_shj", _XW_SQL)(_crosswalk("shuffle_hash"))  # J5


@register("road_cells", O.with_stages("SELECT DISTINCT h3_id FROM readings_all WHERE h3_id IS NOT NULL"))
def road_cells(spark, sf_dir):
    """Distinct cells with traffic."""
    return reading_cells(M.readings_of(spark, sf_dir)).where(F.col("h3_id").isNotNull())


@register("cell_lookup", O.with_stages(
    f"SELECT h3_id, osm_id, full_road_name FROM crosswalk WHERE h3_id = '{LOOKUP_CELL}'"))
def cell_lookup(spark, sf_dir):
    """equality lookup of one cell in the crosswalk."""
    return M.crosswalk_of(spark, sf_dir).where(F.col("h3_id") == F.lit(LOOKUP_CELL))


# ---------------------------------------------------------------- silver

def _enriched(strategy):
    def q(spark, sf_dir):
        return M.enriched_of(spark, sf_dir, strategy)
    return q


_ENR_SQL = O.with_stages("SELECT h3_id, currentSpeed, freeFlowSpeed, osm_id, full_road_name, ingest_time FROM enriched")
register("silver_enrich", _ENR_SQL)(_enriched("auto"))         # J2/J3
register("enrich_smj", _ENR_SQL)(_enriched("merge"))           # J4
register("enrich_shj", _ENR_SQL)(_enriched("shuffle_hash"))    # J5


@register("silver_valid", O.with_stages("SELECT * FROM silver"))
def silver_valid(spark, sf_dir):
    """matched, named, speed within the limit."""
    return M.silver_of(spark, sf_dir)


@register("quarantine", O.with_stages("SELECT * FROM quarantine"))
def quarantine(spark, sf_dir):
    """The complement with its reason."""
    return M.quarantine_of(spark, sf_dir)


@register("quarantine_reasons", O.with_stages(
    "SELECT error_reason, count(*) AS row_count FROM quarantine GROUP BY error_reason"))
def quarantine_reasons(spark, sf_dir):
    """rows per reason, from counts per cell (no pairs are built)."""
    c = M.quality_counts_of(spark, sf_dir)
    names = ((REASON_NO_MATCH, "no_match"), (REASON_UNNAMED, "unnamed"), (REASON_SPEED, "speed"))
    rows = F.array(*[F.struct(F.lit(r).alias("error_reason"), F.col(n).alias("row_count")) for r, n in names])
    return c.select(F.inline(rows)).where("row_count > 0")


@register("data_quality_summary", O.with_stages(
    "SELECT 'Silver Data' AS source_table, count(*) AS row_count FROM silver UNION ALL "
    "SELECT 'Quarantined Errors' AS source_table, count(*) AS row_count FROM quarantine"))
def data_quality_summary(spark, sf_dir):
    """Silver vs quarantine counts, from counts per cell (no pairs are built).
    The two labels are fixed values."""
    counts = M.quality_counts_of(spark, sf_dir).select(F.col("silver").alias("v"), F.expr("no_match + unnamed + speed").alias("q"))
    return counts.select(F.expr("stack(2, 'Silver Data', v, 'Quarantined Errors', q) AS (source_table, row_count)"))


@register("silver_preview", O.with_stages(
    "SELECT full_road_name, currentSpeed, freeFlowSpeed, ingest_time FROM silver "
    "WHERE currentSpeed IS NOT NULL AND full_road_name IS NOT NULL "
    "ORDER BY ingest_time DESC, full_road_name, currentSpeed, freeFlowSpeed LIMIT 20"))
def silver_preview(spark, sf_dir):
    """O2: 20 most recent silver rows (top-k, no global sort)."""
    return (M.silver_of(spark, sf_dir)
            .where(F.col("currentSpeed").isNotNull() & F.col("full_road_name").isNotNull())
            .select("full_road_name", "currentSpeed", "freeFlowSpeed", "ingest_time")
            .orderBy(F.col("ingest_time").desc(), "full_road_name", "currentSpeed", "freeFlowSpeed").limit(20))


@register("table_counts", O.with_stages(
    "SELECT 'bronze' AS table_name, count(*) AS row_count FROM bronze UNION ALL "
    "SELECT 'roads', count(*) FROM roads UNION ALL SELECT 'crosswalk', count(*) FROM crosswalk UNION ALL "
    "SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'quarantine', count(*) FROM quarantine UNION ALL "
    "SELECT 'gold', count(*) FROM gold", (O.gold_cte("gold"),)))
def table_counts(spark, sf_dir):
    """Row count of every stage: one crosswalk, silver and quarantine
    from counts per cell."""
    xw = M.crosswalk_of(spark, sf_dir)
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
    quality = M.quality_counts_of(spark, sf_dir, xw).select(F.expr(
        "stack(2, 'silver', silver, 'quarantine', no_match + unnamed + speed) AS (table_name, row_count)"))
    return (one(bronze_view(spark, sf_dir), "bronze").unionByName(one(roads_view(spark, sf_dir), "roads"))
            .unionByName(one(xw, "crosswalk")).unionByName(quality).unionByName(one(_gold(spark, sf_dir), "gold")))


# ---------------------------------------------------------------- gold

@register("gold_windows", gsql(f"SELECT {GOLD_OUT} FROM gold"))
def gold_windows(spark, sf_dir):
    """1-minute tumbling windows per road (pre-aggregated plan)."""
    return gold_out(_gold(spark, sf_dir))


@register("gold_from_silver", gsql(f"SELECT {GOLD_OUT} FROM gold"))
def gold_from_silver(spark, sf_dir):
    """G1 over the silver rows as stored (the plan the gold stream runs)."""
    return gold_out(congestion_windows(M.silver_of(spark, sf_dir)))


@register("gold_windows_sliding", O.with_stages(f"SELECT {GOLD_OUT} FROM gold_s", (O.gold_cte("gold_s", 10, 1),)))
def gold_windows_sliding(spark, sf_dir):
    """10-minute windows sliding by 1 minute."""
    return gold_out(M.gold_of(spark, sf_dir, "10 minutes", "1 minute"))


@register("avg_ci_last_2h", gsql(
    f"SELECT road_name, {O.rnd('avg(avg_congestion_index)', 4)} AS avg_ci, count(*) AS windows FROM gold "
    f"WHERE window_start > {O.ts(AS_OF)} - INTERVAL 2 HOURS AND road_name IS NOT NULL GROUP BY road_name"))
def avg_ci_last_2h(spark, sf_dir):
    """Per road average over the last two hours."""
    return D.avg_ci_last_2h(_gold(spark, sf_dir), AS_OF)


@register("gridlock_heavy_events", gsql(
    f"SELECT {loc()} AS window_start_local, road_name, {O.rnd('avg_congestion_index', 4)} AS avg_congestion_index, "
    "traffic_status, total_observations FROM gold WHERE traffic_status IN ('GRIDLOCK', 'HEAVY')"))
def gridlock_heavy_events(spark, sf_dir):
    """F12/O1/L7/L8."""
    return D.gridlock_heavy_events(_gold(spark, sf_dir))


@register("recent_windows", gsql(
    f"SELECT window_start, window_end, road_name, {O.rnd('avg_congestion_index', 6)} AS avg_congestion_index, "
    "total_observations FROM gold ORDER BY window_start DESC, road_name LIMIT 20"))
def recent_windows(spark, sf_dir):
    """O2: the 20 most recent windows."""
    r = D.recent_windows(_gold(spark, sf_dir))
    return r.withColumn("avg_congestion_index", r6("avg_congestion_index"))


@register("road_trend", gsql(
    f"SELECT {loc()} AS time_est, road_name, {O.rnd('avg_congestion_index', 4)} AS congestion_index, "
    f"traffic_status, total_observations FROM gold WHERE road_name = '{TREND_ROAD}'"))
def road_trend(spark, sf_dir):
    """U16: one road's windows, newest first."""
    return D.road_trend(_gold(spark, sf_dir), TREND_ROAD)


# ---------------------------------------------------------------- dashboard

@register("kpi_all_time", gsql(
    "SELECT CAST(sum(total_observations) AS BIGINT) AS observations, count(*) AS windows, "
    f"CAST(count_if(traffic_status = 'GRIDLOCK') AS BIGINT) AS gridlock_windows, {O.rnd('max(avg_congestion_index)', 6)} AS peak_ci "
    "FROM gold"))
def kpi_all_time(spark, sf_dir):
    k = D.kpi_all_time(_gold(spark, sf_dir))
    return k.withColumn("peak_ci", r6("peak_ci"))


@register("congestion_trend", gsql(
    f"SELECT date_trunc('hour', {loc()}) AS bucket_local, {O.rnd('avg(avg_congestion_index)', 6)} AS avg_ci, "
    "CAST(sum(total_observations) AS BIGINT) AS observations, count(*) AS windows FROM gold GROUP BY 1"))
def congestion_trend(spark, sf_dir):
    t = D.congestion_trend(_gold(spark, sf_dir))
    return t.withColumn("avg_ci", r6("avg_ci"))


@register("road_comparison", gsql(
    f"SELECT road_name, {O.rnd('avg(avg_congestion_index)', 6)} AS avg_ci, "
    f"{O.rnd('max(avg_congestion_index)', 6)} AS max_ci, CAST(sum(total_observations) AS BIGINT) AS observations, "
    "CAST(count_if(traffic_status = 'GRIDLOCK') AS BIGINT) AS gridlock_windows FROM gold GROUP BY road_name"))
def road_comparison(spark, sf_dir):
    t = D.road_comparison(_gold(spark, sf_dir))
    return t.withColumn("avg_ci", r6("avg_ci")).withColumn("max_ci", r6("max_ci"))


@register("daily_summary", gsql(
    f"SELECT CAST({loc()} AS DATE) AS day_local, count(*) AS windows, "
    f"CAST(sum(total_observations) AS BIGINT) AS observations, {O.rnd('avg(avg_congestion_index)', 6)} AS avg_ci, "
    "CAST(count_if(traffic_status = 'GRIDLOCK') AS BIGINT) AS gridlock_windows, CAST(count_if(traffic_status = 'HEAVY') AS BIGINT) AS heavy_windows "
    "FROM gold GROUP BY 1"))
def daily_summary(spark, sf_dir):
    t = D.daily_summary(_gold(spark, sf_dir))
    return t.withColumn("avg_ci", r6("avg_ci"))


_A = O.ts(AS_OF)


@register("kpi_24h_pop", gsql(
    "SELECT CAST(sum(CASE WHEN cur THEN total_observations END) AS BIGINT) AS cur_observations, "
    "CAST(sum(CASE WHEN prev THEN total_observations END) AS BIGINT) AS prev_observations, "
    f"{O.rnd('avg(CASE WHEN cur THEN avg_congestion_index END)', 6)} AS cur_avg_ci, "
    f"{O.rnd('avg(CASE WHEN prev THEN avg_congestion_index END)', 6)} AS prev_avg_ci, "
    "CAST(count_if(cur AND traffic_status = 'GRIDLOCK') AS BIGINT) AS cur_gridlock_windows, "
    "CAST(count_if(prev AND traffic_status = 'GRIDLOCK') AS BIGINT) AS prev_gridlock_windows, "
    f"{O.rnd('avg(CASE WHEN cur THEN avg_congestion_index END) - avg(CASE WHEN prev THEN avg_congestion_index END)', 6)}"
    " AS avg_ci_change "
    f"FROM (SELECT *, window_start > {_A} - INTERVAL 24 HOURS AND window_start <= {_A} AS cur, "
    f"window_start > {_A} - INTERVAL 48 HOURS AND window_start <= {_A} - INTERVAL 24 HOURS AS prev "
    f"FROM gold WHERE window_start > {_A} - INTERVAL 48 HOURS)"))
def kpi_24h_pop(spark, sf_dir):
    k = D.kpi_24h_pop(_gold(spark, sf_dir), AS_OF)
    for c in ("cur_avg_ci", "prev_avg_ci", "avg_ci_change"):
        k = k.withColumn(c, r6(c))
    return k


@register("active_gridlocks", gsql(
    "SELECT count(DISTINCT road_name) AS active_gridlocks, "
    "CASE WHEN count(DISTINCT road_name) > 0 THEN 'red' ELSE 'green' END AS indicator FROM gold "
    f"WHERE traffic_status = 'GRIDLOCK' AND window_start > {_A} - INTERVAL 60 MINUTES AND window_start <= {_A}"))
def active_gridlocks(spark, sf_dir):
    return D.active_gridlocks(_gold(spark, sf_dir), AS_OF)


@register("road_status_latest", gsql(
    f"SELECT {GOLD_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY road_name ORDER BY window_start DESC) AS rn "
    "FROM gold) WHERE rn = 1"))
def road_status_latest(spark, sf_dir):
    """Latest window per road, by a partial max over a struct."""
    return gold_out(D.road_status_latest(_gold(spark, sf_dir)))


@register("street_congestion", gsql(
    f"SELECT road_name, {O.rnd('avg(avg_congestion_index)', 6)} AS avg_ci, "
    "CAST(sum(total_observations) AS BIGINT) AS observations, count(*) AS windows FROM gold "
    f"WHERE road_name LIKE '{AREA_LIKE}' GROUP BY road_name"))
def street_congestion(spark, sf_dir):
    t = D.street_congestion(_gold(spark, sf_dir), AREA_LIKE)
    return t.withColumn("avg_ci", r6("avg_ci"))


@register("heatmap_road_hour", gsql(
    f"SELECT road_name, CAST(hour({loc()}) AS INTEGER) AS hour_local, {O.rnd('avg(avg_congestion_index)', 6)} AS avg_ci, "
    "count(*) AS windows FROM gold GROUP BY 1, 2"))
def heatmap_road_hour(spark, sf_dir):
    t = D.heatmap_road_hour(_gold(spark, sf_dir))
    return t.withColumn("avg_ci", r6("avg_ci"))


@register("hourly_pattern", gsql(
    f"SELECT CAST(hour({loc()}) AS INTEGER) AS hour_local, {O.rnd('avg(avg_congestion_index)', 6)} AS avg_ci, "
    "CAST(sum(total_observations) AS BIGINT) AS observations FROM gold GROUP BY 1"))
def hourly_pattern(spark, sf_dir):
    t = D.hourly_pattern(_gold(spark, sf_dir))
    return t.withColumn("avg_ci", r6("avg_ci"))


@register("freshness", gsql(
    f"SELECT latest_window, (epoch({_A}) - epoch(latest_window)) / 60.0 AS age_minutes, "
    f"CASE WHEN (epoch({_A}) - epoch(latest_window)) / 60.0 <= {D.FRESH_GREEN_MIN} THEN 'green' "
    f"WHEN (epoch({_A}) - epoch(latest_window)) / 60.0 <= {D.FRESH_ORANGE_MIN} THEN 'orange' ELSE 'red' END AS level "
    "FROM (SELECT max(window_start) AS latest_window FROM gold)"))
def freshness(spark, sf_dir):
    return D.freshness(_gold(spark, sf_dir), AS_OF)


@register("gridlock_history", gsql(
    f"SELECT {loc()} AS window_start_local, road_name, {O.rnd('avg_congestion_index', 4)} AS avg_congestion_index, "
    "total_observations FROM gold WHERE traffic_status = 'GRIDLOCK'"))
def gridlock_history(spark, sf_dir):
    return D.gridlock_history(_gold(spark, sf_dir))


@register("dow_congestion", gsql(
    f"SELECT CAST(dayofweek({loc()}) + 1 AS INTEGER) AS dow_local, {O.rnd('avg(avg_congestion_index)', 6)} AS avg_ci, "
    "count(*) AS windows FROM gold GROUP BY 1"))
def dow_congestion(spark, sf_dir):
    t = D.dow_congestion(_gold(spark, sf_dir))
    return t.withColumn("avg_ci", r6("avg_ci"))


@register("heatmap_road_day", gsql(
    "SELECT c.road_name, c.dow_local, c.avg_ci, w.dow_local AS worst_dow, w.avg_ci AS worst_ci, "
    "b.dow_local AS best_dow, b.avg_ci AS best_ci FROM cells c "
    "JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY road_name ORDER BY avg_ci DESC, dow_local DESC) "
    "AS rn FROM cells) WHERE rn = 1) w ON c.road_name = w.road_name "
    "JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY road_name ORDER BY avg_ci ASC, dow_local ASC) "
    "AS rn FROM cells) WHERE rn = 1) b ON c.road_name = b.road_name",
    f"cells AS (SELECT road_name, CAST(dayofweek({loc()}) + 1 AS INTEGER) AS dow_local, "
    f"{O.dround('avg(avg_congestion_index)', STATUS_DECIMALS)} AS avg_ci FROM gold GROUP BY 1, 2)"))
def heatmap_road_day(spark, sf_dir):
    return D.heatmap_road_day(_gold(spark, sf_dir))


@register("global_filters", gsql(
    f"SELECT {GOLD_OUT} FROM gold WHERE road_name IN {FILTER_ROADS} AND traffic_status IN {FILTER_STATUSES} "
    f"AND window_start >= {O.ts(FILTER_START)} AND window_start < {O.ts(FILTER_END)}"))
def global_filters(spark, sf_dir):
    """Road, status and date-range filters composed onto gold."""
    return gold_out(D.apply_filters(_gold(spark, sf_dir), FILTER_ROADS, FILTER_STATUSES, FILTER_START, FILTER_END))


# ---------------------------------------------------------------- alerts

def _alert_text_sql(ci: str) -> str:
    head, rest = ALERT_TEXT.split("%s")
    mid = rest.split("%.2f")[0]
    num = f"CAST(CAST(round(CAST(CAST({O.dround(ci, STATUS_DECIMALS)} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DECIMAL(38, 2)) AS VARCHAR)"
    return f"concat('{head}', road_name, '{mid}', {num})"


def _picks_sql(name: str, as_of: str, recency_min: int, src: str = "gold") -> str:
    return (f"{name} AS (SELECT road_name, window_start, avg_congestion_index FROM ("
            "SELECT *, row_number() OVER (PARTITION BY road_name ORDER BY window_start DESC, avg_congestion_index DESC) "
            f"AS rn FROM {src} WHERE traffic_status = 'GRIDLOCK' AND window_start >= {O.ts(as_of)} - "
            f"INTERVAL {recency_min} MINUTES) WHERE rn = 1)")


def _alert_out_sql(src: str, as_of: str, batch_id: int) -> str:
    return (f"SELECT road_name, window_start, {O.rnd('avg_congestion_index', 6)} AS avg_congestion_index, "
            f"{_alert_text_sql('avg_congestion_index')} AS text, {O.ts(as_of)} AS alerted_at, "
            f"CAST({batch_id} AS BIGINT) AS batch_id FROM {src}")


def _alert_out(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_congestion_index", r6("avg_congestion_index"))


@register("alerts_recent", gsql(
    f"SELECT road_name, window_start, {O.rnd('avg_congestion_index', 6)} AS avg_congestion_index FROM gold "
    f"WHERE traffic_status = 'GRIDLOCK' AND window_start >= {_A} - INTERVAL {ALERT_RECENCY_MIN} MINUTES"))
def alerts_recent(spark, sf_dir):
    """GRIDLOCK windows that pass the recency guard."""
    from ..operators.alerts import recent_gridlocks
    r = recent_gridlocks(_gold(spark, sf_dir), AS_OF, ALERT_RECENCY_MIN)
    return r.select("road_name", "window_start", r6("avg_congestion_index", "avg_congestion_index"))


@register("gridlock_alerts", gsql(_alert_out_sql("picks", AS_OF, 0), _picks_sql("picks", AS_OF, ALERT_RECENCY_MIN)))
def gridlock_alerts_q(spark, sf_dir):
    """One alert row per road (latest window), empty alert log."""
    return _alert_out(gridlock_alerts(_gold(spark, sf_dir), None, AS_OF, 0, ALERT_RECENCY_MIN))


@register("alerts_cooldown", O.with_stages(
    _alert_out_sql("(SELECT * FROM picks2 WHERE road_name NOT IN (SELECT road_name FROM picks1))", SECOND_RUN, 1),
    (O.gold_cte("gold"), O.gold_cte("gold1", where=f"ingest_time < {O.ts(FIRST_BATCH_END)}"),
     _picks_sql("picks1", FIRST_BATCH_END, COOLDOWN_RECENCY_MIN, "gold1"),
     _picks_sql("picks2", SECOND_RUN, COOLDOWN_RECENCY_MIN))))
def alerts_cooldown(spark, sf_dir):
    """Batch 1 (readings before 12:00) alerts at 12:00; batch 2 (all
    readings) alerts at 12:20 with the 30-minute cooldown, so roads alerted
    by batch 1 are held back."""
    xw = M.crosswalk_of(spark, sf_dir)
    reads = M.readings_of(spark, sf_dir)
    first = gold_from_readings(reads.where(F.col("ingest_time") < as_timestamp(FIRST_BATCH_END)), xw)
    log = gridlock_alerts(first, None, FIRST_BATCH_END, 0, COOLDOWN_RECENCY_MIN)
    second = gold_from_readings(reads, xw)
    return _alert_out(gridlock_alerts(second, log, SECOND_RUN, 1, COOLDOWN_RECENCY_MIN))


@register("replay_alerts", O.with_stages(
    f"SELECT r.road_name, r.t AS window_start, {O.rnd('g.avg_congestion_index', 6)} AS avg_congestion_index "
    "FROM r JOIN gold g ON g.road_name = r.road_name AND g.window_start = r.t",
    (O.gold_cte("gold"),
     "gl AS (SELECT road_name, window_start FROM gold WHERE traffic_status = 'GRIDLOCK')",
     "nx AS (SELECT road_name, window_start, min(window_start) OVER (PARTITION BY road_name ORDER BY window_start "
     "RANGE BETWEEN INTERVAL '1801 seconds' FOLLOWING AND UNBOUNDED FOLLOWING) AS next_t FROM gl)",
     "r AS (SELECT road_name, min(window_start) AS t FROM gl GROUP BY road_name UNION ALL "
     "SELECT n.road_name, n.next_t FROM r JOIN nx n ON n.road_name = r.road_name AND n.window_start = r.t "
     "WHERE n.next_t IS NOT NULL)"), recursive=True))
def replay_alerts_q(spark, sf_dir):
    """T12 replay form: one alert per road per 30-minute cooldown over the
    whole GRIDLOCK history (greedy on emitted alerts)."""
    return _alert_out(replay_alerts(_gold(spark, sf_dir)))


# ---------------------------------------------------------------- table writes

@register("gold_merge", gsql(f"SELECT {GOLD_OUT} FROM gold"))
def gold_merge(spark, sf_dir):
    """K9: two overlapping batches upserted on (road_name, window_start)."""
    target = scratch_path(spark, "gold_merge")
    xw = M.crosswalk_of(spark, sf_dir)
    reads = M.readings_of(spark, sf_dir)
    first = gold_from_readings(reads.where(F.col("ingest_time") < as_timestamp(UPSERT_FIRST_BEFORE)), xw)
    second = gold_from_readings(reads.where(F.col("ingest_time") >= as_timestamp(UPSERT_SECOND_FROM)), xw)
    upsert(spark, target, first)
    upsert(spark, target, second)
    return gold_out(spark.read.parquet(target))


@register("delete_where", gsql(f"SELECT {GOLD_OUT} FROM gold WHERE traffic_status <> 'CLEAR'"))
def delete_where_q(spark, sf_dir):
    """DELETE of the CLEAR windows from a partitioned gold table."""
    target = scratch_path(spark, "gold_delete")
    upsert(spark, target, _gold(spark, sf_dir))
    delete_where(spark, target, "traffic_status = 'CLEAR'")
    return gold_out(spark.read.parquet(target))


@register("compact", gsql(f"SELECT {GOLD_OUT} FROM gold"))
def compact_q(spark, sf_dir):
    """M1: many small files compacted; contents unchanged."""
    target = scratch_path(spark, "gold_compact")
    from ..sources.tables import with_window_date
    with_window_date(_gold(spark, sf_dir)).repartition(16).write.partitionBy("window_date").parquet(target)
    MT.compact(spark, target, partition_col="window_date")
    return gold_out(spark.read.parquet(target))


@register("table_detail", gsql("SELECT count(*) AS num_rows, count(DISTINCT CAST(window_start AS DATE)) AS days, TRUE AS a_file_a_day, TRUE AS sized FROM gold"))
def table_detail_q(spark, sf_dir):
    """M4: the gold table as written: rows and days; files (listed, also those
    without rows) and bytes as bounds, since their numbers are the writer's."""
    target = scratch_path(spark, "gold_detail")
    from ..sources.tables import with_window_date
    with_window_date(_gold(spark, sf_dir)).write.partitionBy("window_date").parquet(target)
    d = MT.table_detail(spark, target)
    days = spark.read.parquet(target).agg(F.count_distinct("window_date").alias("days"))
    none = F.lit(0).cast("long")
    both = d.withColumn("days", none).unionByName(days.select(*[none.alias(c) for c in d.columns], "days"))
    return both.agg(*[F.sum(c).alias(c) for c in both.columns]).select(
        "num_rows", "days", (F.col("num_files") >= F.col("days")).alias("a_file_a_day"), (F.col("size_in_bytes") > F.col("num_files")).alias("sized"))


@register("table_sizes", O.with_stages(
    "SELECT 'crosswalk' AS table_name, count(*) AS num_rows, TRUE AS has_files FROM crosswalk UNION ALL "
    "SELECT 'silver', count(*), TRUE FROM silver UNION ALL SELECT 'quarantine', count(*), TRUE FROM quarantine UNION ALL "
    "SELECT 'gold', count(*), TRUE FROM gold", (O.gold_cte("gold"),)))
def table_sizes_q(spark, sf_dir):
    """M5: rows of the crosswalk, silver, quarantine and gold tables as written,
    and whether files and bytes were listed for them."""
    from ..sources.tables import with_window_date
    base = scratch_path(spark, "tables")
    paths = {n: f"{base}/{n}" for n in ("crosswalk", "silver", "quarantine", "gold")}
    # the crosswalk and the parsed readings feed all four tables, so both are computed once
    xw, size = M.crosswalk_of(spark, sf_dir, with_size=True)
    reads = materialize(M.readings_of(spark, sf_dir), "table-reads")
    enriched = M.enriched_of(spark, sf_dir, reads=reads, crosswalk=xw, size=size)
    xw.write.parquet(paths["crosswalk"])
    M.silver_of(spark, sf_dir, enriched=enriched).write.parquet(paths["silver"])
    M.quarantine_of(spark, sf_dir, enriched=enriched).write.parquet(paths["quarantine"])
    with_window_date(M.gold_of(spark, sf_dir, reads=reads, crosswalk=xw)).write.partitionBy("window_date").parquet(paths["gold"])
    return MT.table_sizes(spark, paths).select(
        "table_name", "num_rows", ((F.col("num_files") > 0) & (F.col("size_in_bytes") > 0)).alias("has_files"))


@register("range_layout", O.with_stages(
    f"SELECT h3_id, osm_id, full_road_name FROM crosswalk WHERE h3_id = '{LOOKUP_CELL}'"))
def range_layout_q(spark, sf_dir):
    """M2: crosswalk written range-partitioned and sorted on the cell, then
    looked up (file min/max statistics skip the other files)."""
    target = scratch_path(spark, "crosswalk_layout")
    MT.range_layout(M.crosswalk_of(spark, sf_dir), "h3_id", 4).write.parquet(target)
    return spark.read.parquet(target).where(F.col("h3_id") == F.lit(LOOKUP_CELL))


# ---------------------------------------------------------------- streams

def _stream_chain(spark: SparkSession, sf_dir: str, upto: str) -> dict:
    """Land every reading as JSON, then run the availableNow streams in order
    (``upto="gold"`` is exactly one ``run_scheduled``)."""
    base = scratch_path(spark, "stream")
    p = S.scheduled_paths(base)
    landing_records(bronze_view(spark, sf_dir)).repartition(8).write.text(p["landing"])
    if upto == "gold":
        S.run_scheduled(spark, base, M.road_index_of(spark, sf_dir), as_of=AS_OF)
        return p
    schema = S.infer_landing_schema(spark, p["landing"], p["schema"])
    S.run_bronze(spark, p["landing"], p["bronze"], f"{p['ckpt']}/bronze", schema)
    p["schema"] = schema
    if upto == "bronze":
        return p
    bronze = spark.read.schema(schema).parquet(p["bronze"])
    xw = build_crosswalk(traffic_cells(bronze), M.road_index_of(spark, sf_dir))
    S.run_silver(spark, p["bronze"], schema, xw, p["silver"], p["quarantine"], f"{p['ckpt']}/silver", as_of=AS_OF)
    return p


@register("crosswalk_incremental", O.with_stages("SELECT h3_id, osm_id, full_road_name FROM crosswalk"))
def crosswalk_incremental(spark, sf_dir):
    """§3.1: the crosswalk kept current by a stream over bronze, new cells only
    (landing split into several files, several micro-batches)."""
    p = _stream_chain(spark, sf_dir, "bronze")
    S.run_crosswalk(spark, p["bronze"], p["schema"], M.road_index_of(spark, sf_dir), p["crosswalk"],
                    p["cells_seen"], f"{p['ckpt']}/crosswalk", max_files=2)
    return S.read_crosswalk(spark, p["crosswalk"])


@register("stream_late_drop", O.with_stages(
    f"SELECT {GOLD_OUT} FROM gold_k",
    ("valid_ev AS (SELECT e.full_road_name, e.ingest_time, ev.ts AS ets, "
     "CASE WHEN 1.0::DOUBLE - e.currentSpeed::DOUBLE / nullif(e.freeFlowSpeed, 0) < 0 THEN 0.0::DOUBLE "
     "ELSE 1.0::DOUBLE - e.currentSpeed::DOUBLE / nullif(e.freeFlowSpeed, 0) END AS ci "
     "FROM enriched e JOIN events ev ON ev.event_id = e.event_id "
     f"WHERE e.currentSpeed <= {MAX_SPEED} AND e.full_road_name IS NOT NULL AND e.osm_id IS NOT NULL)",
     f"run1 AS (SELECT * FROM valid_ev WHERE ets < {O.ts(LATE_SPLIT)})",
     "wm AS (SELECT max(ingest_time) - INTERVAL 1 SECOND AS w FROM run1)",
     f"kept AS (SELECT * FROM run1 UNION ALL SELECT v.* FROM valid_ev v, wm WHERE v.ets >= {O.ts(LATE_SPLIT)} "
     "AND time_bucket(INTERVAL '1 minute', v.ingest_time) + INTERVAL '1 minute' > wm.w)",
     O.gold_cte("gold_k").replace("FROM silver_ci", "FROM kept"))))
def stream_late_drop(spark, sf_dir):
    """Two scheduled runs of the bronze -> silver -> gold streams over the
    same checkpoints; run 2 lands the later events. Windows of run 2 that end
    at or before run 1's watermark (max event time - 1 s) are dropped as late."""
    base = scratch_path(spark, "late")
    b = bronze_view(spark, sf_dir, with_event_ts=True)
    split = F.col("ts") < as_timestamp(LATE_SPLIT).cast("timestamp_ntz")
    schema = S.landing_schema(["event_id"])
    xw = M.crosswalk_of(spark, sf_dir)
    for i, part in enumerate((b.where(split), b.where(~split))):
        landing_records(part.drop("ts")).repartition(4).write.mode("append").text(f"{base}/landing")
        S.run_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ckpt/bronze", schema)
        S.run_silver(spark, f"{base}/bronze", schema, xw, f"{base}/silver", f"{base}/quarantine",
                     f"{base}/ckpt/silver", as_of=AS_OF)
        S.run_gold(spark, f"{base}/silver", f"{base}/gold", f"{base}/ckpt/gold", as_of=AS_OF)
    return gold_out(spark.read.parquet(f"{base}/gold"))


@register("stream_bronze", O.with_stages(
    "SELECT event_id, lat, lon, currentSpeed, freeFlowSpeed, ingest_time FROM parsed"))
def stream_bronze(spark, sf_dir):
    """Landing JSON -> bronze Parquet stream, read back parsed."""
    p = _stream_chain(spark, sf_dir, "bronze")
    b = spark.read.schema(p["schema"]).parquet(p["bronze"])
    return parse_bronze(b, as_of=AS_OF).select(
        F.col("event_id").cast("long").alias("event_id"), "lat", "lon", "currentSpeed", "freeFlowSpeed", "ingest_time")


@register("stream_silver", O.with_stages("SELECT * FROM silver"))
def stream_silver(spark, sf_dir):
    """Bronze stream enriched by a stream-static broadcast join."""
    p = _stream_chain(spark, sf_dir, "silver")
    return spark.read.schema(S.SILVER_SCHEMA).parquet(p["silver"])


@register("stream_quarantine", O.with_stages("SELECT * FROM quarantine"))
def stream_quarantine(spark, sf_dir):
    p = _stream_chain(spark, sf_dir, "silver")
    return spark.read.schema(S.QUARANTINE_SCHEMA).parquet(p["quarantine"])


@register("stream_gold", gsql(f"SELECT {GOLD_OUT} FROM gold"))
def stream_gold(spark, sf_dir):
    """Windowed stream in update mode, upserted per micro-batch."""
    p = _stream_chain(spark, sf_dir, "gold")
    return gold_out(spark.read.parquet(p["gold"]))


@register("stream_alerts", gsql(_alert_out_sql("picks", AS_OF, 0), _picks_sql("picks", AS_OF, 30)))
def stream_alerts(spark, sf_dir):
    """T11-T13 inside the gold micro-batch (30-minute recency at the fixture's now)."""
    p = _stream_chain(spark, sf_dir, "gold")
    from ..operators.alerts import read_alert_log
    return _alert_out(read_alert_log(spark, p["alerts"]).drop("run_id"))


# ------------------------------------------------- runs that repeat, widen, replay

def _two_landings(spark, sf_dir, base):
    """The readings' JSON in two parts, by event time."""
    b = bronze_view(spark, sf_dir, with_event_ts=True)
    split = F.col("ts") < as_timestamp(LATE_SPLIT).cast("timestamp_ntz")
    for part in (b.where(split), b.where(~split)):
        yield landing_records(part.drop("ts")).repartition(4)


def _replayed(spark, sf_dir, from_stage: str, one_pass: bool) -> dict:
    """A run over the first landing, then more landed files, then a replay with
    new checkpoints and another batch size."""
    base = scratch_path(spark, "replay")
    p, idx = S.scheduled_paths(base), M.road_index_of(spark, sf_dir)
    first, second = _two_landings(spark, sf_dir, base)
    first.write.mode("append").text(p["landing"])
    S.run_scheduled(spark, base, idx, as_of=AS_OF, one_pass=one_pass)
    second.write.mode("append").text(p["landing"])
    S.replay(spark, base, idx, from_stage, as_of=AS_OF, one_pass=one_pass, max_files=2)
    return p


@register("stream_replay_bronze", O.with_stages(
    "SELECT event_id, lat, lon, currentSpeed, freeFlowSpeed, ingest_time FROM parsed"))
def stream_replay_bronze(spark, sf_dir):
    """Bronze after a replay holds every landed record once."""
    p = _replayed(spark, sf_dir, "bronze", False)
    return parse_bronze(spark.read.parquet(p["bronze"]), as_of=AS_OF).select(
        F.col("event_id").cast("long").alias("event_id"), "lat", "lon", "currentSpeed", "freeFlowSpeed", "ingest_time")


@register("stream_replay_silver", O.with_stages("SELECT * FROM silver"))
def stream_replay_silver(spark, sf_dir):
    """Silver after a replay of silver in one pass with other batches."""
    p = _replayed(spark, sf_dir, "silver", True)
    return spark.read.parquet(p["silver"]).select(*SILVER_COLUMNS)


@register("stream_replay_gold", gsql(f"SELECT {GOLD_OUT} FROM gold"))
def stream_replay_gold(spark, sf_dir):
    """Gold after a full replay equals the batch result; no window is late."""
    return gold_out(spark.read.parquet(_replayed(spark, sf_dir, "bronze", False)["gold"]))


@register("stream_schema_widen", "SELECT event_id, CASE WHEN event_id < 50 THEN 'f' || CAST(event_id AS VARCHAR) END AS rare FROM events")
def stream_schema_widen(spark, sf_dir):
    """A field of only the oldest files, in a sub-folder, keeps its column."""
    base = scratch_path(spark, "widen")
    p = S.scheduled_paths(base)
    b = bronze_view(spark, sf_dir)
    rare = F.concat(F.regexp_replace("value", r"\}$", ""), F.lit(',"rare":"f'), F.get_json_object("value", "$.event_id"), F.lit('"}'))
    landing_records(b.where("event_id < 50")).select(rare.alias("value")).coalesce(1).write.text(f"{p['landing']}/old")
    landing_records(b.where("event_id >= 50")).repartition(6).write.mode("append").text(f"{p['landing']}/new")
    schema = S.infer_landing_schema(spark, p["landing"], p["schema"])
    S.run_bronze(spark, p["landing"], p["bronze"], f"{p['ckpt']}/bronze", schema, 2)
    return spark.read.parquet(p["bronze"]).select(F.col("event_id").cast("long").alias("event_id"), "rare")


@register("stream_unparsed", O.with_stages(
    "SELECT 'landed' AS kind, count(*) AS n FROM bronze UNION ALL "
    "SELECT 'unparsed', count(*) FROM parsed WHERE lon IS NULL OR lat IS NULL OR currentSpeed IS NULL UNION ALL "
    "SELECT 'silver', count(*) FROM silver"))
def stream_unparsed(spark, sf_dir):
    """With keep_unparsed, readings without a point or speed reach quarantine."""
    base = scratch_path(spark, "unparsed")
    p = S.scheduled_paths(base)
    landing_records(bronze_view(spark, sf_dir)).repartition(4).write.text(p["landing"])
    S.run_scheduled(spark, base, M.road_index_of(spark, sf_dir), as_of=AS_OF, keep_unparsed=True, max_files=2)
    one = lambda df, k: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n")
    unparsed = spark.read.parquet(p["quarantine"]).where(F.col("error_reason") == F.lit(REASON_UNPARSED))
    return (one(spark.read.parquet(p["bronze"]), "landed").unionByName(one(unparsed, "unparsed"))
            .unionByName(one(spark.read.parquet(p["silver"]), "silver")))


@register("gold_merge_duplicates", gsql(f"SELECT {GOLD_OUT} FROM gold"))
def gold_merge_duplicates(spark, sf_dir):
    """K9: every key twice in the batch, and a batch applied twice, leave one row a key."""
    target = scratch_path(spark, "merge-dup")
    g = materialize(_gold(spark, sf_dir), "merge-batch")       # three times in the batches, derived once
    upsert(spark, target, g.unionByName(g))
    upsert(spark, target, g)
    return gold_out(spark.read.parquet(target))


@register("delete_null_partition", gsql("SELECT * FROM (SELECT " + GOLD_OUT + " FROM gold) WHERE minute(window_start) % 3 <> 0 AND traffic_status <> 'GRIDLOCK'"))
def delete_null_partition(spark, sf_dir):
    """Rows of the NULL partition are upserted beside old ones and deleted."""
    target = scratch_path(spark, "null-part")
    day = F.when(F.minute("window_start") % 2 == 0, F.to_date("window_start"))
    g = _gold(spark, sf_dir).withColumn("window_date", day)
    upsert(spark, target, g.where("minute(window_start) < 30"))
    upsert(spark, target, g.where("minute(window_start) >= 30"))
    delete_where(spark, target, "minute(window_start) % 3 = 0")
    delete_where(spark, target, "traffic_status = 'GRIDLOCK'")
    return gold_out(spark.read.parquet(target))


@register("crosswalk_new_roads", O.with_stages("SELECT h3_id, osm_id, full_road_name FROM crosswalk"))
def crosswalk_new_roads(spark, sf_dir):
    """Roads arrive in two runs: the second run adds those of cells already seen."""
    base = scratch_path(spark, "new-roads")
    p, idx = S.scheduled_paths(base), M.road_index_of(spark, sf_dir)
    landing_records(bronze_view(spark, sf_dir)).repartition(4).write.text(p["landing"])
    S.run_scheduled(spark, base, idx.where("osm_id % 2 = 0"), as_of=AS_OF)
    S.run_scheduled(spark, base, idx, as_of=AS_OF)
    return S.read_crosswalk(spark, p["crosswalk"])


@register("unwrap_flow", O.with_stages(
    "SELECT event_id, json_extract_string(flowSegmentData, '$.currentSpeed') AS currentSpeed, "
    "json_extract_string(flowSegmentData, '$.freeFlowSpeed') AS freeFlowSpeed, "
    "json_extract(flowSegmentData, '$.coordinates')::VARCHAR AS coordinates, "
    "'Wed Jan 31 00:00:00 2024' AS pulled_at FROM bronze"))
def unwrap_flow_q(spark, sf_dir):
    """API envelopes to landing records, the flow's fields at top level; an
    envelope without a flow gives a record without fields."""
    from ..functions.parse import unwrap_flow
    envelope = F.concat(F.lit("{"), F.coalesce(F.concat(F.lit('"flowSegmentData":'), F.col("flowSegmentData")), F.lit("")), F.lit("}"))
    raw = bronze_view(spark, sf_dir).select("event_id", envelope.alias("raw"))
    return unwrap_flow(raw, AS_OF, "raw", "event_id").drop("flowSegmentData")


from . import registry_jobs  # noqa: E402,F401  registers the queries over tables and jobs
