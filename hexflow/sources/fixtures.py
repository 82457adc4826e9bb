"""Traffic-domain views derived from the driver's test tables.

``bronze`` turns every ``events`` row into one landed reading in one of the
three payload shapes; ``roads`` turns every ``customer`` row into one road
segment with WKT geometry. No row is dropped or capped: the work of every
query grows with the given tables.

Mapping (fixed values shared with the DuckDB oracle):
  * point index ``i = user_id``: latitude text ``40.(10000 + 200*(i % 400))``,
    longitude text ``-74.(11000 + 300*(i div 400))``; points grow with the data
    on two axes (five digits for up to 120,000 points)
  * speed text ``floor(value*3) % 170``, NULL on every 53rd event
  * free-flow text ``20 + 10*(user_id % 4)``, ``0`` on every 97th event
  * ``pulled_at`` ctime text of ``ts``, ``unknown`` on every 71st event
  * payload shape by ``event_id % 4``: 0 nested with a point array, 1 nested
    with a single point object, 2 and 3 top level
  * road spot ``5 + c_custkey div 10``, a three-point LINESTRING centred on the
    spot, name ``ROAD_<nationkey>``, NULL on every 13th road: ten roads per
    cell at every scale, so readings x roads grows as the readings do
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the processing time the fixture stands for ("now" of the
# queries), just after the last event; unparseable timestamps fall back to it.
FIXTURE_AS_OF = "2024-01-31 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer input splits than task slots.

    A file written as one row group is one split, so its (CPU-heavy) JSON and
    geometry parsing would run in one task. Large inputs have many splits and
    pass through unchanged; the check reads only file metadata.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def _ctime(ts: Column) -> Column:
    # "Mon Jan  1 00:00:07 2024": the day is space padded, as C's ctime does.
    return F.concat(F.date_format(ts, "EEE MMM "), F.lpad(F.dayofmonth(ts).cast("string"), 2, " "),
                    F.date_format(ts, " HH:mm:ss yyyy"))


def _lat(i: Column) -> Column:
    return F.concat(F.lit("40."), (F.lit(10000) + (i % 400) * 200).cast("string"))


def _lon(i: Column, off: int = 0) -> Column:
    return F.concat(F.lit("-74."), (F.lit(11000 + off) + F.floor(i / 400) * 300).cast("string"))


def bronze_view(spark: SparkSession, sf_dir: str, with_event_ts: bool = False) -> DataFrame:
    """Landed readings: ``event_id`` plus the five all-STRING bronze fields
    (and the event's ``ts`` when asked, to split landings by time)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    la, lo = _lat(F.col("user_id")), _lon(F.col("user_id"))
    cs = F.when(F.col("event_id") % 53 == 0, F.lit(None).cast("string")).otherwise(
        (F.floor(F.col("value") * 3).cast("int") % 170).cast("string"))
    ff = F.when(F.col("event_id") % 97 == 0, F.lit("0")).otherwise(
        (F.lit(20) + (F.col("user_id") % 4) * 10).cast("string"))
    pulled = F.when(F.col("event_id") % 71 == 0, F.lit("unknown")).otherwise(_ctime(F.col("ts")))
    pt = F.concat(F.lit('{"latitude":'), la, F.lit(',"longitude":'), lo, F.lit("}"))
    shape = F.col("event_id") % 4
    top = shape >= 2
    nested = F.concat(
        F.lit('{"currentSpeed":'), F.coalesce(cs, F.lit("null")), F.lit(',"freeFlowSpeed":'), ff,
        F.lit(',"coordinates":{"coordinate":'),
        F.when(shape == 0, F.concat(F.lit("["), pt, F.lit("]"))).otherwise(pt), F.lit("}}"))
    null = F.lit(None).cast("string")
    return ev.select(
        "event_id",
        F.when(top, cs).otherwise(null).alias("currentSpeed"),
        F.when(top, ff).otherwise(null).alias("freeFlowSpeed"),
        F.when(top, F.concat(F.lit('{"coordinate":['), pt, F.lit("]}"))).otherwise(null).alias("coordinates"),
        F.when(~top, nested).otherwise(null).alias("flowSegmentData"),
        pulled.alias("pulled_at"),
        *([F.col("ts")] if with_event_ts else []),
    )


def roads_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road segments: ``osm_id, name, fclass, geometry_wkt`` (one per customer)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    i = F.lit(5) + F.floor(k / 10)
    lat = _lat(i)
    wkt = F.concat(F.lit("LINESTRING ("), _lon(i, -20), F.lit(" "), lat, F.lit(", "), _lon(i), F.lit(" "), lat,
                   F.lit(", "), _lon(i, 20), F.lit(" "), lat, F.lit(")"))
    return c.select(
        k.cast("string").alias("osm_id"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("ROAD_"), F.col("c_nationkey").cast("string"))).alias("name"),
        F.col("c_mktsegment").alias("fclass"),
        wkt.alias("geometry_wkt"),
    )


def landing_records(bronze: DataFrame) -> DataFrame:
    """One JSON object per bronze row (``value`` text), as the poller lands it:
    speeds as JSON numbers, payload objects nested (not quoted), absent
    fields left out."""
    def field(name: str, raw: bool) -> Column:
        v = F.col(name)
        body = v if raw else F.concat(F.lit('"'), v, F.lit('"'))
        return F.when(v.isNotNull(), F.concat(F.lit(f'"{name}":'), body))

    parts = [F.concat(F.lit('"event_id":'), F.col("event_id").cast("string")),
             field("currentSpeed", True), field("freeFlowSpeed", True), field("coordinates", True),
             field("flowSegmentData", True), field("pulled_at", False)]
    return bronze.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value"))
