"""Road index (roads -> centroid + cell) and the cell-to-road crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import DEFAULT_REF_LAT, DEFAULT_RES, add_cell, geo_cell, wkt_centroid
from ..functions.parse import LAT_PATHS, LON_PATHS, _first_path, as_timestamp
from .joins import MAX_BROADCAST_ROWS, small_side

ROAD_INDEX_COLUMNS = ("osm_id", "full_road_name", "lat", "lon", "h3_id", "ingest_time")
CROSSWALK_COLUMNS = ("h3_id", "osm_id", "full_road_name")
NO_CELL = "\u0000"


def load_roads(roads: DataFrame) -> DataFrame:
    """Typed road table from extracted road rows (WKT text kept, no binary geometry)."""
    keep = [c for c in ("osm_id", "name", "fclass", "ref", "maxspeed", "geometry_wkt") if c in roads.columns]
    return roads.select(*[F.col(c).cast("string") if c in ("osm_id", "name") else F.col(c) for c in keep])


def road_index(roads: DataFrame, res: int = DEFAULT_RES, ref_lat: float = DEFAULT_REF_LAT,
               as_of=None) -> DataFrame:
    """``osm_id, full_road_name, lat, lon, h3_id, ingest_time`` per road.

    A pure projection: no shuffle, scales linearly with the road table.
    """
    c = wkt_centroid("geometry_wkt")
    stamped = F.current_timestamp() if as_of is None else as_timestamp(as_of)
    located = (roads.select(F.col("osm_id").cast("string").alias("osm_id"),
                            F.col("name").alias("full_road_name"), c.alias("c"))
               .select("osm_id", "full_road_name", F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon")))
    return add_cell(located, "lon", "lat", "h3_id", res, ref_lat).withColumn("ingest_time", stamped)


def reading_cells(readings: DataFrame, cell_col: str = "h3_id") -> DataFrame:
    """Distinct cells seen in the readings (partial distinct map-side); a NULL
    cell never matches the equi-join that follows."""
    return readings.select(cell_col).distinct()


def traffic_cells(bronze: DataFrame, res: int = DEFAULT_RES, ref_lat: float = DEFAULT_REF_LAT,
                  strict: bool = False) -> DataFrame:
    """Distinct cells of every landed reading that has a point (speed or time
    not needed): only the point paths are parsed. ``strict`` reads only the
    two point-array shapes, as the original crosswalk build did (a single
    point object then never adds its cell)."""
    lat_paths, lon_paths = (LAT_PATHS[::2], LON_PATHS[::2]) if strict else (LAT_PATHS, LON_PATHS)
    pts = bronze.select(_first_path(lat_paths).try_cast("double").alias("lat"),
                        _first_path(lon_paths).try_cast("double").alias("lon"))
    # through a generator, so that a filter on the cells is not pushed into the parse (which would run twice)
    return pts.select(F.explode(F.array(geo_cell("lon", "lat", res, ref_lat))).alias("h3_id")).distinct()


def build_crosswalk(readings: DataFrame, index: DataFrame, strategy: str = "auto",
                    max_broadcast_rows: int = MAX_BROADCAST_ROWS, size: tuple[int, int] | None = None) -> DataFrame:
    """``h3_id, osm_id, full_road_name`` for every road whose cell has traffic.

    ``readings`` is anything with an ``h3_id`` column: parsed readings, or
    ``traffic_cells(bronze)``; with ``size`` (rows, bytes), distinct cells
    already materialised.

    The distinct traffic cells are the small side: they are materialised,
    counted and broadcast when within the bound, so the (large) road index is
    scanned once without a shuffle. The final ``distinct`` removes duplicate
    road rows, as the reference's distinct does.
    """
    cells = readings.select("h3_id") if size else reading_cells(readings)
    cells, _ = small_side(cells.withColumnRenamed("h3_id", "_cell"), strategy, max_broadcast_rows, checked=size is not None,
                          where=F.col("_cell").isNotNull(), size=size)
    # Non-nullable key on the road side: a road without a cell gets a NUL
    # sentinel no printable cell id equals. Nothing is left for Catalyst to
    # infer and push into the centroid / cell computation of every road (a
    # comparison filter on the cells would be carried across the equi-join).
    roads = index.select(*CROSSWALK_COLUMNS).withColumn("_cell", F.coalesce(F.col("h3_id"), F.lit(NO_CELL)))
    return roads.join(cells, "_cell").select(*CROSSWALK_COLUMNS).distinct()
