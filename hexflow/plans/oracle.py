"""DuckDB twins of the Spark plans, for the correctness gate.

Each query's SQL is ``WITH <stages> <final select>`` over the raw driver
tables (``events``, ``customer``). The stages spell out the naive semantics
(the reading x road fan-out is materialised here), so the Spark plans, which
pre-aggregate and broadcast, are checked against the straightforward form.
"""

from __future__ import annotations

from ..functions.geo import DEFAULT_REF_LAT, DEFAULT_RES, VERTEX_PATTERN, cell_constants
from ..functions.parse import LAT_PATHS, LON_PATHS
from ..operators.enrich import MAX_SPEED, REASON_NO_MATCH, REASON_SPEED, REASON_UNNAMED
from ..sources.fixtures import FIXTURE_AS_OF as AS_OF


def dbl(x: float) -> str:
    """An exact DOUBLE literal (never DECIMAL)."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


BRONZE = """
bronze_a AS (
  SELECT event_id,
    concat('40.', CAST(10000 + (user_id % 400) * 200 AS VARCHAR)) AS la,
    concat('-74.', CAST(11000 + (user_id // 400) * 300 AS VARCHAR)) AS lo,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(CAST(floor(value * 3) AS INTEGER) % 170 AS VARCHAR) END AS cs,
    CASE WHEN event_id % 97 = 0 THEN '0' ELSE CAST(20 + (user_id % 4) * 10 AS VARCHAR) END AS ff,
    CASE WHEN event_id % 71 = 0 THEN 'unknown'
         ELSE concat(strftime(ts, '%a %b '), lpad(CAST(day(ts) AS VARCHAR), 2, ' '), strftime(ts, ' %H:%M:%S %Y')) END AS pulled_at
  FROM events),
bronze_b AS (SELECT *, concat('{"latitude":', la, ',"longitude":', lo, '}') AS pt FROM bronze_a),
bronze AS (
  SELECT event_id,
    CASE WHEN event_id % 4 >= 2 THEN cs END AS currentSpeed,
    CASE WHEN event_id % 4 >= 2 THEN ff END AS freeFlowSpeed,
    CASE WHEN event_id % 4 >= 2 THEN concat('{"coordinate":[', pt, ']}') END AS coordinates,
    CASE WHEN event_id % 4 < 2 THEN concat('{"currentSpeed":', coalesce(cs, 'null'), ',"freeFlowSpeed":', ff,
      ',"coordinates":{"coordinate":', CASE WHEN event_id % 4 = 0 THEN concat('[', pt, ']') ELSE pt END, '}}') END AS flowSegmentData,
    pulled_at
  FROM bronze_b)"""

ROADS = """
roads_a AS (SELECT c_custkey AS k, 5 + c_custkey // 10 AS i, c_nationkey AS n, c_mktsegment AS m FROM customer),
roads AS (
  SELECT CAST(k AS VARCHAR) AS osm_id,
    CASE WHEN k % 13 = 0 THEN NULL ELSE concat('ROAD_', CAST(n AS VARCHAR)) END AS name, m AS fclass,
    concat('LINESTRING (-74.', CAST(11000 + (i // 400) * 300 - 20 AS VARCHAR), ' 40.', CAST(10000 + (i % 400) * 200 AS VARCHAR),
           ', -74.', CAST(11000 + (i // 400) * 300 AS VARCHAR), ' 40.', CAST(10000 + (i % 400) * 200 AS VARCHAR),
           ', -74.', CAST(11000 + (i // 400) * 300 + 20 AS VARCHAR), ' 40.', CAST(10000 + (i % 400) * 200 AS VARCHAR), ')') AS geometry_wkt
  FROM roads_a)"""


def _paths(paths) -> str:
    return "coalesce(" + ", ".join(f"json_extract_string({src}, '{p}')" for src, p in paths) + ")"


def parsed_cte(as_of: str = AS_OF) -> str:
    return f"""
parsed AS (
  SELECT event_id,
    TRY_CAST({_paths(LAT_PATHS)} AS DOUBLE) AS lat,
    TRY_CAST({_paths(LON_PATHS)} AS DOUBLE) AS lon,
    TRY_CAST(coalesce(json_extract_string(flowSegmentData, '$.currentSpeed'), currentSpeed) AS INTEGER) AS currentSpeed,
    TRY_CAST(coalesce(json_extract_string(flowSegmentData, '$.freeFlowSpeed'), freeFlowSpeed) AS INTEGER) AS freeFlowSpeed,
    coalesce(try_strptime(regexp_replace(substring(pulled_at, 5), ' +', ' ', 'g'), '%b %d %H:%M:%S %Y'),
             {ts(as_of)}) AS ingest_time
  FROM bronze)"""


def cell_ctes(name: str, src: str, keep: str, res: int = DEFAULT_RES, ref_lat: float = DEFAULT_REF_LAT) -> str:
    """CTE ``name`` = ``keep`` columns of ``src`` plus ``h3_id`` from ``lon, lat``."""
    a, b, c = cell_constants(res, ref_lat)
    return f"""
{name}_q AS (SELECT *, lon * {dbl(a)} - lat * {dbl(b)} AS qf, lat * {dbl(c)} AS rf FROM {src}),
{name}_r AS (SELECT *, floor(qf + {dbl(0.5)}) AS rq, floor(rf + {dbl(0.5)}) AS rr, floor(-qf - rf + {dbl(0.5)}) AS rs,
             -qf - rf AS sf FROM {name}_q),
{name}_d AS (SELECT *, abs(rq - qf) AS dq, abs(rr - rf) AS dr, abs(rs - sf) AS ds FROM {name}_r),
{name} AS (
  SELECT {keep},
    CASE WHEN lon IS NULL OR lat IS NULL THEN NULL ELSE
      concat('{res}:', CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS VARCHAR), ':',
             CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS VARCHAR))
    END AS h3_id
  FROM {name}_d)"""


def road_index_ctes(as_of: str = AS_OF) -> str:
    p = VERTEX_PATTERN
    return f"""
road_pts AS (
  SELECT osm_id, name,
    list_transform(list_zip(regexp_extract_all(geometry_wkt, '{p}', 1), regexp_extract_all(geometry_wkt, '{p}', 2)),
                   lambda v: {{'x': TRY_CAST(v[1] AS DOUBLE), 'y': TRY_CAST(v[2] AS DOUBLE)}}) AS pts
  FROM roads),
road_seg AS (
  SELECT osm_id, name, pts,
    list_transform(range(1, len(pts)), lambda i: {{
      'l': sqrt((pts[i + 1].x - pts[i].x) * (pts[i + 1].x - pts[i].x) + (pts[i + 1].y - pts[i].y) * (pts[i + 1].y - pts[i].y)),
      'mx': (pts[i].x + pts[i + 1].x) / {dbl(2.0)}, 'my': (pts[i].y + pts[i + 1].y) / {dbl(2.0)}}}) AS segs
  FROM road_pts),
road_acc AS (
  SELECT osm_id, name, len(pts) AS npts,
    coalesce(list_sum(list_transform(segs, lambda s: s.l)), 0) AS sl,
    list_sum(list_transform(segs, lambda s: s.l * s.mx)) AS sx,
    list_sum(list_transform(segs, lambda s: s.l * s.my)) AS sy,
    list_sum(list_transform(pts, lambda v: v.x)) AS px, list_sum(list_transform(pts, lambda v: v.y)) AS py
  FROM road_seg),
road_c AS (
  SELECT osm_id, name AS full_road_name,
    CASE WHEN sl > 0 THEN sx / sl WHEN npts > 0 THEN px / npts END AS lon,
    CASE WHEN sl > 0 THEN sy / sl WHEN npts > 0 THEN py / npts END AS lat
  FROM road_acc),
{cell_ctes("road_index", "road_c", "osm_id, full_road_name, lat, lon").strip()}"""


def stage_ctes(as_of: str = AS_OF, max_speed: int = MAX_SPEED) -> str:
    """bronze -> readings, road_index, crosswalk, enriched, silver, quarantine, silver_ci."""
    return ",\n".join(s.strip() for s in (
        BRONZE, ROADS, parsed_cte(as_of),
        cell_ctes("readings_all", "parsed", "event_id, lat, lon, currentSpeed, freeFlowSpeed, ingest_time"),
        "readings AS (SELECT * FROM readings_all WHERE h3_id IS NOT NULL AND currentSpeed IS NOT NULL)",
        road_index_ctes(as_of),
        """crosswalk AS (
  SELECT DISTINCT r.h3_id, r.osm_id, r.full_road_name
  FROM (SELECT DISTINCT h3_id FROM readings_all WHERE h3_id IS NOT NULL) c JOIN road_index r ON c.h3_id = r.h3_id)""",
        """enriched AS (
  SELECT s.h3_id, s.currentSpeed, s.freeFlowSpeed, m.osm_id, m.full_road_name, s.ingest_time, s.event_id
  FROM readings s LEFT JOIN crosswalk m ON lower(s.h3_id) = lower(m.h3_id))""",
        f"""silver AS (
  SELECT h3_id, currentSpeed, freeFlowSpeed, CAST(NULL AS VARCHAR) AS road_name, osm_id, full_road_name, ingest_time
  FROM enriched WHERE currentSpeed <= {max_speed} AND full_road_name IS NOT NULL AND osm_id IS NOT NULL)""",
        f"""quarantine AS (
  SELECT h3_id, currentSpeed, osm_id,
    CASE WHEN osm_id IS NULL THEN '{REASON_NO_MATCH}' WHEN full_road_name IS NULL THEN '{REASON_UNNAMED}'
         ELSE '{REASON_SPEED}' END AS error_reason, ingest_time
  FROM enriched WHERE currentSpeed > {max_speed} OR osm_id IS NULL OR full_road_name IS NULL)""",
        """silver_ci AS (
  SELECT *, CASE WHEN 1.0::DOUBLE - currentSpeed::DOUBLE / nullif(freeFlowSpeed, 0) < 0 THEN 0.0::DOUBLE
                 ELSE 1.0::DOUBLE - currentSpeed::DOUBLE / nullif(freeFlowSpeed, 0) END AS ci
  FROM silver)""",
    ))


def dround(x: str, n: int) -> str:
    """Spark's ``round`` on a DOUBLE: half-up on the shortest decimal text of
    the value (DuckDB also prints doubles in shortest form)."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


def rnd(x: str, n: int) -> str:
    """Twin of ``hexflow.functions.congestion.stable_round``."""
    return dround(dround(x, 9), n)


def status_sql(avg: str, heavy: float = 0.4, gridlock: float = 0.8) -> str:
    return (f"CASE WHEN {dround(avg, 9)} > {dbl(gridlock)} THEN 'GRIDLOCK' "
            f"WHEN {dround(avg, 9)} > {dbl(heavy)} THEN 'HEAVY' ELSE 'CLEAR' END")


def gold_cte(name: str = "gold", size_min: int = 1, slide_min: int | None = None, where: str | None = None) -> str:
    """Gold windows over ``silver_ci``. Sliding windows: the ``size/slide``
    windows holding a row start at its slide bucket minus k*slide."""
    slide = slide_min or size_min
    base = f"(SELECT * FROM silver_ci WHERE {where})" if where else "silver_ci"
    if slide == size_min:
        win = (f"time_bucket(INTERVAL '{size_min} minutes', ingest_time) AS window_start, "
               f"time_bucket(INTERVAL '{size_min} minutes', ingest_time) + INTERVAL '{size_min} minutes' AS window_end")
        src = base
    else:
        n = -(-size_min // slide)
        win = "ws AS window_start, ws + INTERVAL '" + str(size_min) + " minutes' AS window_end"
        src = (f"(SELECT *, time_bucket(INTERVAL '{slide} minutes', ingest_time) - to_minutes(o * {slide}) AS ws "
               f"FROM {base}, range({n}) r(o)) x WHERE ingest_time < ws + INTERVAL '{size_min} minutes'")
    return f"""{name}_a AS (
  SELECT full_road_name AS road_name, {win}, avg(ci) AS avg_ci, count(*) AS total
  FROM {src} GROUP BY ALL),
{name} AS (
  SELECT road_name, window_start, window_end, avg_ci AS avg_congestion_index,
    {status_sql("avg_ci")} AS traffic_status, CAST(total AS INTEGER) AS total_observations
  FROM {name}_a)"""


def with_stages(final_select: str, extra_ctes: tuple[str, ...] = (), as_of: str = AS_OF,
                recursive: bool = False) -> str:
    ctes = [stage_ctes(as_of), *extra_ctes]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(c.strip() for c in ctes) + "\n" + final_select.strip()
