"""Property checks (hypothesis): Column expressions against plain Python."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from hexflow.functions.geo import cell_of, geo_cell, wkt_centroid

lon_s = st.floats(min_value=-74.3, max_value=-73.7, allow_nan=False)
lat_s = st.floats(min_value=40.5, max_value=40.95, allow_nan=False)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(lon_s, lat_s), min_size=1, max_size=200))
def test_cell_column_matches_python(spark, pts):
    df = spark.createDataFrame(pts, "lon double, lat double")
    got = [r[0] for r in df.select(geo_cell("lon", "lat")).collect()]
    assert got == [cell_of(x, y) for x, y in pts]


def _centroid(pts):
    segs = [(math.sqrt((b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2), (a[0] + b[0]) / 2, (a[1] + b[1]) / 2)
            for a, b in zip(pts, pts[1:])]
    total = sum(s[0] for s in segs)
    if total > 0:
        return sum(s[0] * s[1] for s in segs) / total, sum(s[0] * s[2] for s in segs) / total
    return sum(p[0] for p in pts) / len(pts), sum(p[1] for p in pts) / len(pts)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(lon_s, lat_s), min_size=2, max_size=8), min_size=1, max_size=30))
def test_centroid_matches_python(spark, lines):
    wkts = [("LINESTRING (" + ", ".join(f"{x!r} {y!r}" for x, y in pts) + ")",) for pts in lines]
    got = [(r.c.lon, r.c.lat) for r in spark.createDataFrame(wkts, "w string")
           .select(wkt_centroid("w").alias("c")).collect()]
    for (gx, gy), pts in zip(got, lines):
        ex, ey = _centroid(pts)
        assert math.isclose(gx, ex, rel_tol=1e-12, abs_tol=1e-12) and math.isclose(gy, ey, rel_tol=1e-12, abs_tol=1e-12)
