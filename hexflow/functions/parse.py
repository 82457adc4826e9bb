"""Bronze payload parsing: three JSON shapes, ctime text, safe casts.

All functions return Columns (JVM-side, codegen'd); they serve batch and
streaming DataFrames alike.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ctime layout after the weekday is dropped and runs of spaces
# are collapsed ("Mar  5 01:10:28 2026" -> "Mar 5 01:10:28 2026").
CTIME_PATTERN = "MMM d HH:mm:ss yyyy"

# JSON paths tried in order (first non-null wins), per field.
LAT_PATHS = (("flowSegmentData", "$.coordinates.coordinate[0].latitude"),
             ("flowSegmentData", "$.coordinates.coordinate.latitude"),
             ("coordinates", "$.coordinate[0].latitude"))
LON_PATHS = (("flowSegmentData", "$.coordinates.coordinate[0].longitude"),
             ("flowSegmentData", "$.coordinates.coordinate.longitude"),
             ("coordinates", "$.coordinate[0].longitude"))


def as_timestamp(value) -> Column:
    """A TIMESTAMP literal read in the session time zone (UTC by contract)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp(F.lit(str(value)))


def parse_ctime(c) -> Column:
    """ctime text ``Mon Mar  5 01:10:28 2026`` to TIMESTAMP; NULL when unparseable."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.regexp_replace(F.substr(c, F.lit(5)), " +", " ")
    return F.try_to_timestamp(text, F.lit(CTIME_PATTERN))


def _first_path(paths) -> Column:
    return F.coalesce(*[F.get_json_object(F.col(src), path) for src, path in paths])


def speed(c: Column) -> Column:
    """Speed text to INT; decimals round half up, bad text gives NULL."""
    return F.round(c.try_cast("double")).try_cast("int")


def parse_bronze(df: DataFrame, as_of=None, time_col: str = "ingest_time") -> DataFrame:
    """Adds ``lat, lon, currentSpeed, freeFlowSpeed`` and the event time.

    * nested payload (``flowSegmentData``) wins over top-level fields
    * a point array yields its first point; a single point object is read as is
    * speeds are text first, then numbers rounded to INT (bad text gives NULL)
    * an unparseable or missing ``pulled_at`` falls back to ``as_of``
      (processing time when ``as_of`` is None)
    """
    fallback = F.current_timestamp() if as_of is None else as_timestamp(as_of)
    # Direct JSON paths: from_json would build structs and write nested objects
    # back to text.
    return df.withColumns({
        "lat": _first_path(LAT_PATHS).try_cast("double"),
        "lon": _first_path(LON_PATHS).try_cast("double"),
        "currentSpeed": speed(F.coalesce(F.get_json_object("flowSegmentData", "$.currentSpeed"), F.col("currentSpeed"))),
        "freeFlowSpeed": speed(F.coalesce(F.get_json_object("flowSegmentData", "$.freeFlowSpeed"), F.col("freeFlowSpeed"))),
        time_col: F.coalesce(parse_ctime("pulled_at"), fallback),
    })


def unwrap_flow(raw: DataFrame, as_of, raw_col: str = "raw", *keep: str) -> DataFrame:
    """API envelope to landing record: the fields of its ``flowSegmentData`` at
    top level (NULL where there is none) and ``pulled_at``, ctime text of
    ``as_of`` (a time, or a column of ``raw``). ``keep`` columns stay in front."""
    body = F.get_json_object(F.col(raw_col), "$.flowSegmentData")
    ts = as_timestamp(as_of)
    pulled = F.concat(F.date_format(ts, "EEE MMM "), F.lpad(F.dayofmonth(ts).cast("string"), 2, " "),
                      F.date_format(ts, " HH:mm:ss yyyy"))
    field = lambda name: F.get_json_object(body, f"$.{name}").alias(name)
    return raw.select(*keep, field("currentSpeed"), field("freeFlowSpeed"), field("coordinates"),
                      F.lit(None).cast("string").alias("flowSegmentData"), pulled.alias("pulled_at"))
