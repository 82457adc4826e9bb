"""Congestion windows: tumbling or sliding windows per road.

Two plans give the same gold rows:

* ``congestion_windows(silver)`` aggregates the silver table as stored (one
  row per reading x matched road). This is the form the gold *stream* runs.
* ``gold_from_readings(readings, crosswalk)`` never builds the
  reading x road pairs. Readings are pre-aggregated per (window, cell) and
  the crosswalk per (cell, road name); the join then carries one row per
  (window, cell, road) and the final aggregate re-weights by the number of
  roads. Counts are exact; sums differ only in float association, which the
  status rounding absorbs. A cell holding a third of all readings costs one
  row per window after the map-side partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.congestion import congestion_index, traffic_status
from .enrich import MAX_SPEED
from .joins import MAX_BROADCAST_ROWS, small_side

GOLD_COLUMNS = ("road_name", "window_start", "window_end", "avg_congestion_index", "traffic_status",
                "total_observations")


def time_window(time_col: str, size: str, slide: str | None) -> Column:
    if slide and slide != size:
        return F.window(time_col, size, slide)
    return F.window(time_col, size)


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(duration: str) -> int | None:
    """Seconds of a simple duration string ("10 minutes"); None if not simple."""
    parts = duration.strip().lower().split()
    if len(parts) != 2 or not parts[0].isdigit():
        return None
    unit = _UNITS.get(parts[1].rstrip("s"))
    return None if unit is None else int(parts[0]) * unit


def _sliding_multiple(size: str, slide: str | None) -> bool:
    if not slide or slide == size:
        return False
    a, b = _seconds(size), _seconds(slide)
    return bool(a and b and a > b and a % b == 0)


def to_gold(agg: DataFrame) -> DataFrame:
    """Flatten the ``window`` struct and type the gold columns."""
    return agg.select("road_name", F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), "avg_congestion_index", "traffic_status",
                      F.col("total_observations").cast("int").alias("total_observations"))


def congestion_windows(silver: DataFrame, size: str = "1 minute", slide: str | None = None,
                       watermark: str | None = None, time_col: str = "ingest_time",
                       keep_window: bool = False) -> DataFrame:
    """``groupBy(window, road).agg(avg(ci), count(*))`` plus the status label."""
    df = silver.withWatermark(time_col, watermark) if watermark else silver
    agg = (df.groupBy(time_window(time_col, size, slide).alias("window"),
                      F.col("full_road_name").alias("road_name"))
           .agg(F.avg(congestion_index()).alias("avg_congestion_index"),
                F.count(F.lit(1)).alias("total_observations"))
           .withColumn("traffic_status", traffic_status()))
    return agg if keep_window else to_gold(agg)


def road_weights(crosswalk: DataFrame, distinct_readings: bool = False) -> DataFrame:
    """Named, matched roads per (cell, road name): the fan-out weight ``k``
    (1 when each reading counts once per road name)."""
    k = F.max(F.lit(1)).cast("long") if distinct_readings else F.count(F.lit(1))
    return (crosswalk.where(F.col("osm_id").isNotNull() & F.col("full_road_name").isNotNull()
                            & F.col("h3_id").isNotNull() & (F.col("h3_id") != F.lit("")))
            .groupBy(F.lower("h3_id").alias("cell"), F.col("full_road_name").alias("road_name"))
            .agg(k.alias("k")))


def bucket_windows(sums: DataFrame, weights: DataFrame, bucket: str, window: Column) -> DataFrame:
    """Windows per road of sums per (bucket, cell): cells meet the roads' weights and
    are added up per (bucket, road) before buckets are dealt to the windows that hold
    them, so a sliding window copies sums of roads, never of cells."""
    k = F.col("k")
    per_road = (sums.join(weights, "cell").groupBy(bucket, "road_name")
                .agg(F.sum(F.col("s") * k).alias("s"), F.sum(F.col("nci") * k).alias("nci"), F.sum(F.col("n") * k).alias("n")))
    return (per_road.groupBy(window.alias("window"), "road_name")
            .agg(F.try_divide(F.sum("s"), F.sum("nci")).alias("avg_congestion_index"), F.sum("n").alias("total_observations"))
            .withColumn("traffic_status", traffic_status()))


def gold_from_readings(reads: DataFrame, crosswalk: DataFrame, size: str = "1 minute",
                       slide: str | None = None, max_speed: int = MAX_SPEED, strategy: str = "auto",
                       max_broadcast_rows: int = MAX_BROADCAST_ROWS, time_col: str = "ingest_time",
                       keep_window: bool = False, distinct_readings: bool = False) -> DataFrame:
    """Gold windows straight from readings, equal to
    ``congestion_windows(silver_rows(enrich(reads, crosswalk)))``.

    ``distinct_readings``: count each reading once per road name (pings),
    instead of once per matched road segment of that name (joined rows, the
    original's ``total_observations``)."""
    # The key is made non-nullable (a NULL cell becomes '', which no crosswalk
    # cell equals), so the inner join infers no IS NOT NULL filter that would
    # evaluate the cell expression a second time per reading.
    r = reads.where(F.col("currentSpeed") <= max_speed).select(
        F.coalesce(F.lower("h3_id"), F.lit("")).alias("cell"), time_col, congestion_index().alias("ci"))
    sums = (F.sum("ci").alias("s"), F.count("ci").alias("nci"), F.count(F.lit(1)).alias("n"))
    weights, _ = small_side(road_weights(crosswalk, distinct_readings), strategy, max_broadcast_rows)
    if _sliding_multiple(size, slide):
        # Sliding: readings are summed per (slide bucket, cell) first, then per
        # (slide bucket, road); only those partial sums are expanded into the
        # size/slide windows holding each bucket (buckets are slide-aligned, so
        # a bucket lies wholly in every window that holds its start). Sums and
        # counts are additive.
        per_bucket = (r.groupBy(F.window(time_col, slide).start.alias("b"), "cell").agg(*sums))
        agg = bucket_windows(per_bucket, weights, "b", F.window("b", size, slide))
        return agg if keep_window else to_gold(agg)
    per_cell = r.groupBy(time_window(time_col, size, slide).alias("window"), "cell").agg(*sums)
    k = F.col("k")
    agg = (per_cell.join(weights, "cell")
           .groupBy("window", "road_name")
           .agg(F.try_divide(F.sum(F.col("s") * k), F.sum(F.col("nci") * k)).alias("avg_congestion_index"),
                F.sum(F.col("n") * k).alias("total_observations"))
           .withColumn("traffic_status", traffic_status()))
    return agg if keep_window else to_gold(agg)
