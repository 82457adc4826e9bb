"""Hand-sized cases: worked values of the reference and the hazards of SURVEY §7.1."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hexflow.functions.congestion import congestion_index, traffic_status
from hexflow.functions.geo import cell_of, geo_cell, wkt_centroid
from hexflow.functions.parse import parse_bronze, parse_ctime
from hexflow.operators.alerts import gridlock_alerts, recent_gridlocks
from hexflow.operators.enrich import enrich, quarantine_rows, silver_rows
from hexflow.operators.windows import congestion_windows, gold_from_readings


def test_congestion_index_cases(spark):
    df = spark.createDataFrame([(2, 25), (4, 25), (30, 25), (4, 0), (None, 25)], "cs int, ff int")
    got = [r[0] for r in df.select(congestion_index("cs", "ff")).collect()]
    assert got[0] == pytest.approx(0.92)
    assert got[1] == pytest.approx(0.84)
    assert got[2] == 0.0          # 1 - 1.2 = -0.2 capped to 0
    assert got[3] is None         # zero free flow
    assert got[4] is None


def test_status_bounds_are_strict(spark):
    df = spark.createDataFrame([(0.8,), (0.4,), (0.81,), (0.41,), (None,), (0.8000000000000002,)], "v double")
    got = [r[0] for r in df.select(traffic_status("v")).collect()]
    assert got == ["HEAVY", "CLEAR", "GRIDLOCK", "HEAVY", "CLEAR", "HEAVY"]


def test_ctime_parse(spark):
    df = spark.createDataFrame([("Mon Mar 23 01:10:28 2026",), ("Thu Mar  5 01:10:28 2026",), ("unknown",), (None,)],
                               "p string")
    got = [r[0] for r in df.select(parse_ctime("p")).collect()]
    assert got[0] == dt.datetime(2026, 3, 23, 1, 10, 28)
    assert got[1] == dt.datetime(2026, 3, 5, 1, 10, 28)
    assert got[2] is None and got[3] is None


def test_parse_three_shapes_and_fallback(spark):
    rows = [
        (None, None, None, '{"currentSpeed":27,"freeFlowSpeed":30,"coordinates":{"coordinate":[{"latitude":40.71,"longitude":-74.0}]}}', "Mon Mar 23 01:10:28 2026"),
        (None, None, None, '{"currentSpeed":5,"freeFlowSpeed":30,"coordinates":{"coordinate":{"latitude":40.72,"longitude":-74.1}}}', "unknown"),
        ("4", "25", '{"coordinate":[{"latitude":40.73,"longitude":-74.2}]}', None, None),
        ("27.5", "25", '{"coordinate":[{"latitude":40.73,"longitude":-74.2}]}', None, None),
    ]
    df = spark.createDataFrame(rows, "currentSpeed string, freeFlowSpeed string, coordinates string, "
                                     "flowSegmentData string, pulled_at string")
    out = parse_bronze(df, as_of="2024-01-31 00:00:00").collect()
    assert [(r.lat, r.lon, r.currentSpeed) for r in out[:3]] == [(40.71, -74.0, 27), (40.72, -74.1, 5), (40.73, -74.2, 4)]
    assert out[0].ingest_time == dt.datetime(2026, 3, 23, 1, 10, 28)
    assert out[1].ingest_time == dt.datetime(2024, 1, 31) == out[2].ingest_time
    assert out[3].currentSpeed == 28       # decimal text rounds half up


def test_cell_column_equals_python_twin(spark):
    pts = [(-74.115, 40.71), (-73.98, 40.75), (-74.0, 40.7), (-74.1720, 40.748), (2.35, 48.85)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    got = [r[0] for r in df.select(geo_cell("lon", "lat")).collect()]
    assert got == [cell_of(x, y) for x, y in pts]
    assert df.select(geo_cell(F.lit(None).cast("double"), "lat")).first()[0] is None


def test_neighbouring_points_share_or_split_cells():
    # ~10 m apart: same cell; ~500 m apart: different cells
    assert cell_of(-74.0, 40.7) == cell_of(-74.0001, 40.7)
    assert cell_of(-74.0, 40.7) != cell_of(-74.006, 40.7)


def test_centroid_of_lines(spark):
    df = spark.createDataFrame([("LINESTRING (0 0, 2 0, 2 2)",), ("LINESTRING (1 1, 1 1)",), ("POINT (3 4)",),
                                ("MULTILINESTRING ((0 0, 2 0), (10 0, 10 4))",)], "w string")
    got = [(r.c.lon, r.c.lat) for r in df.select(wkt_centroid("w").alias("c")).collect()]
    assert got[0] == (1.5, 0.5)
    assert got[1] == (1.0, 1.0)
    assert got[2] == (3.0, 4.0)
    assert got[3][0] == pytest.approx((2 * 1 + 4 * 10) / 6) and got[3][1] == pytest.approx(4 * 2 / 6)


def _reads(spark, rows):
    return spark.createDataFrame(rows, "h3_id string, currentSpeed int, freeFlowSpeed int, ingest_time timestamp")


def test_quarantine_reasons_and_complement(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 5)
    reads = _reads(spark, [("c1", 150, 30, t), ("c1", 151, 30, t), ("c2", 10, 30, t), ("c3", 10, 30, t)])
    xw = spark.createDataFrame([("c1", "1", "Main"), ("c2", "2", None)], "h3_id string, osm_id string, full_road_name string")
    e = enrich(reads, xw)
    assert e.count() == 4
    assert [r.currentSpeed for r in silver_rows(e).collect()] == [150]
    reasons = sorted((r.currentSpeed, r.error_reason) for r in quarantine_rows(e).collect())
    assert reasons == [(10, "Map Matching Failed (NULL osm_id)"), (10, "Unnamed Road Segment (NULL name)"),
                       (151, "Invalid Speed (> 150mph)")]


def test_pre_aggregated_gold_equals_fan_out_gold(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 5)
    rows = [("c1", s, ff, t0 + dt.timedelta(seconds=17 * i)) for i, (s, ff) in
            enumerate([(2, 25), (4, 25), (20, 40), (60, 40), (3, 0), (170, 30), (5, 20)])]
    rows.append(("C2", 4, 20, t0))
    reads = _reads(spark, rows)
    xw = spark.createDataFrame([("c1", "1", "Main"), ("c1", "2", "Main"), ("c1", "3", "Oak"), ("c2", "4", "Elm"),
                                ("c1", "5", None)], "h3_id string, osm_id string, full_road_name string")
    a = {(r.road_name, r.window_start): (round(r.avg_congestion_index or -1, 9), r.traffic_status, r.total_observations)
         for r in gold_from_readings(reads, xw).collect()}
    b = {(r.road_name, r.window_start): (round(r.avg_congestion_index or -1, 9), r.traffic_status, r.total_observations)
         for r in congestion_windows(silver_rows(enrich(reads, xw))).collect()}
    assert a == b and len(a) == 5


def test_sliding_windows(spark):
    reads = _reads(spark, [("c1", 5, 25, dt.datetime(2024, 1, 1, 10, 3, 30))])
    xw = spark.createDataFrame([("c1", "1", "Main")], "h3_id string, osm_id string, full_road_name string")
    g = gold_from_readings(reads, xw, "10 minutes", "1 minute").collect()
    starts = sorted(r.window_start.minute for r in g)
    assert starts == [0, 1, 2, 3, 54, 55, 56, 57, 58, 59]
    assert all(r.window_start <= dt.datetime(2024, 1, 1, 10, 3, 30) < r.window_end for r in g)


def _gold(spark, rows):
    return spark.createDataFrame(rows, "road_name string, window_start timestamp, window_end timestamp, "
                                       "avg_congestion_index double, traffic_status string, total_observations int")


def test_recency_and_cooldown_boundaries(spark):
    now = dt.datetime(2024, 1, 1, 12, 0)
    w = lambda m: now - dt.timedelta(minutes=m)
    gold = _gold(spark, [("A", w(30), w(29), 0.9, "GRIDLOCK", 3), ("B", w(31), w(30), 0.9, "GRIDLOCK", 3),
                         ("C", w(5), w(4), 0.85, "GRIDLOCK", 3), ("C", w(10), w(9), 0.95, "GRIDLOCK", 3),
                         ("D", w(1), w(0), 0.5, "HEAVY", 3)])
    assert sorted(r.road_name for r in recent_gridlocks(gold, now).collect()) == ["A", "C", "C"]
    log = spark.createDataFrame([("A", w(40), 0.9, "x", w(30), 0), ("C", w(40), 0.9, "x", w(31), 0)],
                                "road_name string, window_start timestamp, avg_congestion_index double, text string, "
                                "alerted_at timestamp, batch_id long")
    out = {r.road_name: r for r in gridlock_alerts(gold, log, now, batch_id=7).collect()}
    assert sorted(out) == ["C"]                      # A cooled down (exactly 30 min), C sent (31 min)
    assert out["C"].window_start == w(5)             # latest window of the road
    assert out["C"].text.endswith("Road: C\n\U0001f4c9 Congestion Index: 0.85") and out["C"].batch_id == 7


def test_replay_alerts_greedy_across_days(spark):
    from hexflow.operators.alerts import replay_alerts
    t = lambda day, h, m: dt.datetime(2024, 1, day, h, m)
    rows = [("A", t(1, 23, 50)), ("A", t(2, 0, 10)), ("A", t(2, 0, 25)), ("A", t(2, 0, 40)), ("A", t(2, 1, 0)),
            ("A", t(2, 1, 30)), ("A", t(2, 1, 31)), ("B", t(5, 12, 0)), ("B", t(7, 0, 0))]
    gold = _gold(spark, [(r, w, w + dt.timedelta(minutes=1), 0.9, "GRIDLOCK", 1) for r, w in rows]
                 + [("A", t(2, 0, 30), t(2, 0, 31), 0.5, "HEAVY", 1)])
    got = sorted((r.road_name, r.window_start) for r in replay_alerts(gold).collect())
    # 00:25 is 35 min after 23:50; 01:30 is exactly 30 min after 01:00 (held), 01:31 is 31 min after
    assert got == [("A", t(1, 23, 50)), ("A", t(2, 0, 25)), ("A", t(2, 1, 0)), ("A", t(2, 1, 31)),
                   ("B", t(5, 12, 0)), ("B", t(7, 0, 0))]


def test_unwrap_flow_envelope(spark):
    from hexflow.functions.parse import unwrap_flow
    raw = spark.createDataFrame([('{"flowSegmentData":{"currentSpeed":4,"freeFlowSpeed":25}}',), ('{"error":"x"}',)],
                                "raw string")
    out = unwrap_flow(raw, "2026-03-05 01:10:28").collect()
    assert (out[0].currentSpeed, out[0].freeFlowSpeed, out[0].flowSegmentData) == ("4", "25", None)
    assert (out[1].currentSpeed, out[1].coordinates) == (None, None)
    assert out[0].pulled_at == "Thu Mar  5 01:10:28 2026"


def test_hot_cell_holding_a_third_of_rows(spark):
    """Skew: one cell and one minute carry a third of the readings; the
    pre-aggregated plan still equals the fan-out plan, row for row."""
    base = dt.datetime(2024, 1, 1, 8, 0, 0)
    hot = spark.range(3000).select(F.lit("hot").alias("h3_id"), (F.col("id") % 40).cast("int").alias("currentSpeed"),
                                   F.lit(40).alias("freeFlowSpeed"), F.lit(base).alias("ingest_time"))
    cold = spark.range(6000).select(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("h3_id"),
                                    (F.col("id") % 60).cast("int").alias("currentSpeed"), F.lit(30).alias("freeFlowSpeed"),
                                    (F.lit(base) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") % 90)).alias("ingest_time"))
    reads = hot.unionByName(cold)
    roads = [("hot", str(i), f"R{i % 3}") for i in range(12)] + [(f"c{i}", f"x{i}", f"R{i % 5}") for i in range(50)]
    xw = spark.createDataFrame(roads, "h3_id string, osm_id string, full_road_name string")
    a = {(r.road_name, r.window_start): (round(r.avg_congestion_index, 9), r.traffic_status, r.total_observations)
         for r in gold_from_readings(reads, xw).collect()}
    b = {(r.road_name, r.window_start): (round(r.avg_congestion_index, 9), r.traffic_status, r.total_observations)
         for r in congestion_windows(silver_rows(enrich(reads, xw))).collect()}
    assert a == b
    assert a[("R0", base)][2] == 3000 * 4 + sum(1 for i in range(6000) if i % 90 == 0 and (i % 50) % 5 == 0)


def test_unparsed_readings_kept_with_a_fourth_reason(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 5)
    reads = _reads(spark, [("c1", None, 30, t), (None, 10, 30, t), ("c1", 10, 30, t)])
    xw = spark.createDataFrame([("c1", "1", "Main")], "h3_id string, osm_id string, full_road_name string")
    e = enrich(reads, xw)
    # default: a NULL-speed row reaches neither table; a NULL cell finds no road
    assert [(r.h3_id, r.error_reason) for r in quarantine_rows(e).collect()] == [(None, "Map Matching Failed (NULL osm_id)")]
    assert silver_rows(e).count() == 1
    got = sorted((str(r.h3_id), r.error_reason) for r in quarantine_rows(e, unparsed=True).collect())
    assert got == [("None", "Unparsed Reading (NULL point or speed)"), ("c1", "Unparsed Reading (NULL point or speed)")]


def test_distinct_readings_counts_pings(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 5)
    reads = _reads(spark, [("c1", 10, 30, t), ("c1", 20, 30, t)])
    xw = spark.createDataFrame([("c1", "1", "Main"), ("c1", "2", "Main"), ("c1", "3", "Oak")],
                               "h3_id string, osm_id string, full_road_name string")
    joined = {r.road_name: r.total_observations for r in gold_from_readings(reads, xw).collect()}
    pings = {r.road_name: r.total_observations for r in gold_from_readings(reads, xw, distinct_readings=True).collect()}
    assert joined == {"Main": 4, "Oak": 2} and pings == {"Main": 2, "Oak": 2}


def test_strict_crosswalk_cells_skip_single_point_objects(spark):
    from hexflow.operators.roads import traffic_cells
    rows = [(None, None, None, '{"coordinates":{"coordinate":{"latitude":40.72,"longitude":-74.1}}}', None),
            (None, None, '{"coordinate":[{"latitude":40.73,"longitude":-74.2}]}', None, None)]
    b = spark.createDataFrame(rows, "currentSpeed string, freeFlowSpeed string, coordinates string, "
                                    "flowSegmentData string, pulled_at string")
    assert {r.h3_id for r in traffic_cells(b).collect()} == {cell_of(-74.1, 40.72), cell_of(-74.2, 40.73)}
    assert {r.h3_id for r in traffic_cells(b, strict=True).collect()} - {None} == {cell_of(-74.2, 40.73)}


def test_global_filters_compose_onto_dashboards(spark):
    from hexflow.plans import dashboard as D
    t = lambda d, h: dt.datetime(2024, 1, d, h, 0)
    gold = _gold(spark, [("A", t(1, 10), t(1, 10) + dt.timedelta(minutes=1), 0.9, "GRIDLOCK", 2),
                         ("A", t(5, 10), t(5, 10) + dt.timedelta(minutes=1), 0.5, "HEAVY", 3),
                         ("B", t(5, 11), t(5, 11) + dt.timedelta(minutes=1), 0.1, "CLEAR", 4)])
    f = D.apply_filters(gold, roads=["A"], statuses=["HEAVY", "GRIDLOCK"], start="2024-01-02", end="2024-01-06")
    assert [(r.road_name, r.window_start) for r in f.collect()] == [("A", t(5, 10))]
    comp = {r.road_name: r.observations for r in D.road_comparison(f).collect()}
    assert comp == {"A": 3}
    assert D.apply_filters(gold).count() == 3          # no filter given: unchanged
