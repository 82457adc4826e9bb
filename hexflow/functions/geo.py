"""Geometry as Column expressions: WKT points, line centroid, hexagonal cell.

No geometry library and no UDF: WKT text is split with regular expressions
into ``ARRAY<STRUCT<x DOUBLE, y DOUBLE>>`` and reduced with higher-order
functions, so everything runs in the JVM next to the scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of our hexagonal grid (pointy-top axial coordinates on a local
# equirectangular plane). Edge length at resolution 10, aperture sqrt(7) per
# level, metres per degree of latitude, metres per degree of longitude at the
# equator, default reference latitude.
EDGE_M_RES10 = 75.863
APERTURE = math.sqrt(7.0)
M_PER_DEG_LAT = 111194.9
M_PER_DEG_LON_EQUATOR = 111320.0
DEFAULT_REF_LAT = 40.7
DEFAULT_RES = 10


def cell_constants(res: int = DEFAULT_RES, ref_lat: float = DEFAULT_REF_LAT) -> tuple[float, float, float]:
    """(a, b, c) with q = lon*a - lat*b, r = lat*c in fractional axial units."""
    edge = EDGE_M_RES10 * APERTURE ** (DEFAULT_RES - res)
    mx = M_PER_DEG_LON_EQUATOR * math.cos(math.radians(ref_lat))
    my = M_PER_DEG_LAT
    return (math.sqrt(3.0) / 3.0 * mx / edge, my / 3.0 / edge, 2.0 * my / 3.0 / edge)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _cube_round(qf: Column, rf: Column, sf: Column, rq: Column, rr: Column, rs: Column) -> tuple[Column, Column]:
    dq, dr, ds = F.abs(rq - qf), F.abs(rr - rf), F.abs(rs - sf)
    q_off = (dq > dr) & (dq > ds)
    q = F.when(q_off, -rr - rs).otherwise(rq)
    r = F.when(q_off, rr).when(dr > ds, -rq - rs).otherwise(rr)
    return q, r


def _cell_text(res: int, q: Column, r: Column) -> Column:
    return F.concat(F.lit(f"{res}:"), q.cast("string"), F.lit(":"), r.cast("string"))


def geo_cell(lon, lat, res: int = DEFAULT_RES, ref_lat: float = DEFAULT_REF_LAT) -> Column:
    """Cell id text ``res:q:r`` of the hexagon holding (lon, lat); NULL if either is NULL.

    Constants are DOUBLE literals (never DECIMAL) so every engine computing
    the same IEEE products lands on the same cell. The fractional axial pair
    is bound once through a one-element ``transform`` so the rounding refers
    to lambda variables: when Catalyst inlines the cell into a pushed-down or
    inferred ``IS NOT NULL`` filter, lon/lat (and whatever computes them)
    appear once, and generated code stays small.
    """
    a, b, c = cell_constants(res, ref_lat)
    lon, lat = _c(lon), _c(lat)
    frac = F.struct((lon * F.lit(a) - lat * F.lit(b)).alias("qf"), (lat * F.lit(c)).alias("rf"))

    def to_text(v: Column) -> Column:
        qf, rf = v["qf"], v["rf"]
        sf = -qf - rf
        rq, rr, rs = (F.floor(x + F.lit(0.5)) for x in (qf, rf, sf))
        return _cell_text(res, *_cube_round(qf, rf, sf, rq, rr, rs))

    return F.transform(F.array(frac), to_text).getItem(0)


def add_cell(df, lon: str = "lon", lat: str = "lat", out: str = "h3_id", res: int = DEFAULT_RES,
             ref_lat: float = DEFAULT_REF_LAT):
    """``df`` plus the cell id column ``out`` (see ``geo_cell``)."""
    return df.withColumn(out, geo_cell(lon, lat, res, ref_lat))


# Fixed value: one WKT vertex "x y" (decimal or exponent notation).
_NUM = r"-?[0-9]+(?:\.[0-9]*)?(?:[eE][-+]?[0-9]+)?"
VERTEX_PATTERN = rf"({_NUM})\s+({_NUM})"


def wkt_points(wkt) -> Column:
    """All vertices of a POINT / LINESTRING / MULTILINESTRING as structs, in order."""
    w = _c(wkt)
    xs = F.regexp_extract_all(w, F.lit(VERTEX_PATTERN), 1)
    ys = F.regexp_extract_all(w, F.lit(VERTEX_PATTERN), 2)
    return F.zip_with(xs, ys, lambda x, y: F.struct(x.try_cast("double").alias("x"),
                                                    y.try_cast("double").alias("y")))


def _parts(wkt) -> Column:
    """Vertex arrays per line part (MULTILINESTRING parts are kept apart)."""
    body = F.regexp_replace(_c(wkt), r"^\s*[A-Za-z]+\s*", "")
    parts = F.split(body, r"\)\s*,\s*\(")
    return F.transform(parts, lambda p: wkt_points(p))


def wkt_centroid(wkt) -> Column:
    """Centroid struct ``{lon, lat}`` of the geometry.

    Lines: midpoints of the segments weighted by segment length (planar, in
    degrees, as a geometry centroid does). Zero total length falls back to
    the mean vertex, which also covers POINT.
    """
    def seg_stats(pts):
        n = F.size(pts)
        segs = F.zip_with(F.slice(pts, 1, F.greatest(n - 1, F.lit(0))),
                          F.slice(pts, 2, F.greatest(n - 1, F.lit(0))),
                          lambda a, b: F.struct(
                              F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"])).alias("l"),
                              ((a["x"] + b["x"]) / 2.0).alias("mx"),
                              ((a["y"] + b["y"]) / 2.0).alias("my")))
        return segs

    segs = F.flatten(F.transform(_parts(wkt), seg_stats))
    zero = F.struct(F.lit(0.0).alias("l"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    acc = F.aggregate(segs, zero, lambda s, g: F.struct(
        (s["l"] + g["l"]).alias("l"), (s["x"] + g["l"] * g["mx"]).alias("x"), (s["y"] + g["l"] * g["my"]).alias("y")))
    pts = wkt_points(wkt)
    npts = F.size(pts).cast("double")
    mean = F.aggregate(pts, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")),
                       lambda s, p: F.struct((s["x"] + p["x"]).alias("x"), (s["y"] + p["y"]).alias("y")))
    weighted = acc["l"] > 0
    lon = F.when(weighted, acc["x"] / acc["l"]).when(npts > 0, mean["x"] / npts)
    lat = F.when(weighted, acc["y"] / acc["l"]).when(npts > 0, mean["y"] / npts)
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def cell_of(lon: float, lat: float, res: int = DEFAULT_RES, ref_lat: float = DEFAULT_REF_LAT) -> str:
    """Plain-Python twin of ``geo_cell`` for one point (same IEEE operations),
    used to name a cell in a parameter and to check the Column form."""
    a, b, c = cell_constants(res, ref_lat)
    qf = lon * a - lat * b
    rf = lat * c
    sf = -qf - rf
    rq, rr, rs = (math.floor(x + 0.5) for x in (qf, rf, sf))
    dq, dr, ds = abs(rq - qf), abs(rr - rf), abs(rs - sf)
    if dq > dr and dq > ds:
        q, r = -rr - rs, rr
    elif dr > ds:
        q, r = rq, -rq - rs
    else:
        q, r = rq, rr
    return f"{res}:{q}:{r}"
