"""Dashboard and analysis queries over gold windows.

Every function takes the gold DataFrame (``road_name, window_start,
window_end, avg_congestion_index, traffic_status, total_observations``) and
returns a DataFrame; ``as_of`` stands for "now" and ``tz`` for the local zone
(timestamps are stored in UTC). Per-road picks ("latest", "worst day") use
``max`` over a struct, a partial aggregate, never a window over the road: a
road holding a third of all rows is combined map-side, not sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.congestion import GRIDLOCK, HEAVY, STATUS_DECIMALS, stable_round
from ..functions.parse import as_timestamp

# The local zone of the dashboards and the freshness thresholds.
LOCAL_TZ = "America/New_York"
FRESH_GREEN_MIN = 15
FRESH_ORANGE_MIN = 60


def local(c: str = "window_start", tz: str = LOCAL_TZ) -> Column:
    return F.from_utc_timestamp(F.col(c), tz)


def _is(status: str) -> Column:
    return F.col("traffic_status") == F.lit(status)


def apply_filters(gold: DataFrame, roads=None, statuses=None, start=None, end=None) -> DataFrame:
    """U15 global filters: optional road list, status list and [start, end) range."""
    out = gold
    if roads:
        out = out.where(F.col("road_name").isin(list(roads)))
    if statuses:
        out = out.where(F.col("traffic_status").isin(list(statuses)))
    if start is not None:
        out = out.where(F.col("window_start") >= as_timestamp(start))
    if end is not None:
        out = out.where(F.col("window_start") < as_timestamp(end))
    return out


def kpi_all_time(gold: DataFrame) -> DataFrame:
    """Observations, windows, GRIDLOCK windows, peak CI."""
    return gold.agg(F.sum("total_observations").alias("observations"), F.count(F.lit(1)).alias("windows"),
                    F.count_if(_is(GRIDLOCK)).alias("gridlock_windows"),
                    F.max("avg_congestion_index").alias("peak_ci"))


def congestion_trend(gold: DataFrame, unit: str = "hour", tz: str = LOCAL_TZ) -> DataFrame:
    """Average CI per local time bucket."""
    return (gold.groupBy(F.date_trunc(unit, local(tz=tz)).alias("bucket_local"))
            .agg(F.avg("avg_congestion_index").alias("avg_ci"), F.sum("total_observations").alias("observations"),
                 F.count(F.lit(1)).alias("windows")))


def road_comparison(gold: DataFrame) -> DataFrame:
    """Per road average and peak CI, observations, GRIDLOCK windows."""
    return (gold.groupBy("road_name")
            .agg(F.avg("avg_congestion_index").alias("avg_ci"), F.max("avg_congestion_index").alias("max_ci"),
                 F.sum("total_observations").alias("observations"),
                 F.count_if(_is(GRIDLOCK)).alias("gridlock_windows")))


def daily_summary(gold: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """U4: per local day windows, observations, average CI, GRIDLOCK and HEAVY windows."""
    return (gold.groupBy(F.to_date(local(tz=tz)).alias("day_local"))
            .agg(F.count(F.lit(1)).alias("windows"), F.sum("total_observations").alias("observations"),
                 F.avg("avg_congestion_index").alias("avg_ci"), F.count_if(_is(GRIDLOCK)).alias("gridlock_windows"),
                 F.count_if(_is(HEAVY)).alias("heavy_windows")))


def days(gold: DataFrame, after=None, until=None) -> DataFrame:
    """``gold`` with bounds on its partition column, which follow from bounds on
    ``window_start``, so that a scan opens those days only. As it is where the
    rows do not carry the column."""
    if "window_date" not in gold.columns:
        return gold
    if after is not None:
        gold = gold.where(F.col("window_date") >= F.to_date(after))
    return gold if until is None else gold.where(F.col("window_date") <= F.to_date(until))


def kpi_24h_pop(gold: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Last ``hours`` against the ``hours`` before, in one pass of conditional aggregates."""
    now = as_timestamp(as_of)
    span = F.make_dt_interval(F.lit(0), F.lit(hours))
    cur = (F.col("window_start") > now - span) & (F.col("window_start") <= now)
    prev = (F.col("window_start") > now - span - span) & (F.col("window_start") <= now - span)
    ci = F.col("avg_congestion_index")
    out = days(gold, now - span - span).where(F.col("window_start") > now - span - span).agg(
        F.sum(F.when(cur, F.col("total_observations"))).alias("cur_observations"),
        F.sum(F.when(prev, F.col("total_observations"))).alias("prev_observations"),
        F.avg(F.when(cur, ci)).alias("cur_avg_ci"), F.avg(F.when(prev, ci)).alias("prev_avg_ci"),
        F.count_if(cur & _is(GRIDLOCK)).alias("cur_gridlock_windows"),
        F.count_if(prev & _is(GRIDLOCK)).alias("prev_gridlock_windows"))
    return out.withColumn("avg_ci_change", F.col("cur_avg_ci") - F.col("prev_avg_ci"))


def active_gridlocks(gold: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    """Roads with a GRIDLOCK window in the last ``minutes``; red when any."""
    now = as_timestamp(as_of)
    since = now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    recent = days(gold, since, now).where(_is(GRIDLOCK) & (F.col("window_start") > since) & (F.col("window_start") <= now))
    return (recent.agg(F.count_distinct("road_name").alias("active_gridlocks"))
            .withColumn("indicator", F.when(F.col("active_gridlocks") > 0, F.lit("red")).otherwise(F.lit("green"))))


def road_status_latest(gold: DataFrame) -> DataFrame:
    """Each road's most recent window (window_start is unique per road)."""
    latest = gold.groupBy("road_name").agg(F.max(F.struct(
        "window_start", "window_end", "avg_congestion_index", "traffic_status", "total_observations")).alias("w"))
    return latest.select("road_name", "w.*")


def street_congestion(gold: DataFrame, road_like: str | None = None) -> DataFrame:
    """U8: congestion by street, optionally within an area given as a name pattern."""
    g = gold.where(F.col("road_name").like(road_like)) if road_like else gold
    return (g.groupBy("road_name").agg(F.avg("avg_congestion_index").alias("avg_ci"),
                                       F.sum("total_observations").alias("observations"),
                                       F.count(F.lit(1)).alias("windows")))


def heatmap_road_hour(gold: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Road x local hour."""
    return (gold.groupBy("road_name", F.hour(local(tz=tz)).alias("hour_local"))
            .agg(F.avg("avg_congestion_index").alias("avg_ci"), F.count(F.lit(1)).alias("windows")))


def hourly_pattern(gold: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Local hour of day."""
    return (gold.groupBy(F.hour(local(tz=tz)).alias("hour_local"))
            .agg(F.avg("avg_congestion_index").alias("avg_ci"), F.sum("total_observations").alias("observations")))


def freshness(gold: DataFrame, as_of, green_min: int = FRESH_GREEN_MIN, orange_min: int = FRESH_ORANGE_MIN) -> DataFrame:
    """Minutes since the newest window, with a green/orange/red level."""
    now = as_timestamp(as_of)
    out = gold.agg(F.max("window_start").alias("latest_window"))
    age = (F.unix_timestamp(now) - F.unix_timestamp("latest_window")) / F.lit(60.0)
    out = out.withColumn("age_minutes", age)
    return out.withColumn("level", F.when(F.col("age_minutes") <= green_min, F.lit("green"))
                          .when(F.col("age_minutes") <= orange_min, F.lit("orange")).otherwise(F.lit("red")))


def gridlock_history(gold: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Every GRIDLOCK window, newest first."""
    return (gold.where(_is(GRIDLOCK))
            .select(local(tz=tz).alias("window_start_local"), "road_name",
                    stable_round("avg_congestion_index", 4).alias("avg_congestion_index"), "total_observations")
            .orderBy(F.col("window_start_local").desc(), "road_name"))


def dow_congestion(gold: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Local day of week (Sunday = 1)."""
    return (gold.groupBy(F.dayofweek(local(tz=tz)).alias("dow_local"))
            .agg(F.avg("avg_congestion_index").alias("avg_ci"), F.count(F.lit(1)).alias("windows")))


def heatmap_road_day(gold: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Road x day of week, with each road's worst and best day.

    Day averages are compared at ``STATUS_DECIMALS`` so ties do not depend on
    summation order; a tie goes to the later day for worst, the earlier day for best.
    """
    cells = (gold.groupBy("road_name", F.dayofweek(local(tz=tz)).alias("dow_local"))
             .agg(F.round(F.avg("avg_congestion_index"), STATUS_DECIMALS).alias("avg_ci")))
    picks = cells.groupBy("road_name").agg(
        F.max(F.struct("avg_ci", "dow_local")).alias("worst"),
        F.min(F.struct("avg_ci", "dow_local")).alias("best"))
    return (cells.join(picks, "road_name")
            .select("road_name", "dow_local", "avg_ci", F.col("worst.dow_local").alias("worst_dow"),
                    F.col("worst.avg_ci").alias("worst_ci"), F.col("best.dow_local").alias("best_dow"),
                    F.col("best.avg_ci").alias("best_ci")))


def avg_ci_last_2h(gold: DataFrame, as_of, hours: int = 2) -> DataFrame:
    """Per road average of window CIs over the last ``hours`` (strictly after)."""
    now = as_timestamp(as_of)
    since = now - F.make_dt_interval(F.lit(0), F.lit(hours))
    return (days(gold, since).where((F.col("window_start") > since) & F.col("road_name").isNotNull())
            .groupBy("road_name")
            .agg(stable_round(F.avg("avg_congestion_index"), 4).alias("avg_ci"), F.count(F.lit(1)).alias("windows"))
            .orderBy(F.col("avg_ci").desc(), "road_name"))


def gridlock_heavy_events(gold: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """GRIDLOCK and HEAVY windows, newest first."""
    return (gold.where(F.col("traffic_status").isin(GRIDLOCK, HEAVY))
            .select(local(tz=tz).alias("window_start_local"), "road_name",
                    stable_round("avg_congestion_index", 4).alias("avg_congestion_index"), "traffic_status",
                    "total_observations")
            .orderBy(F.col("window_start_local").desc(), "road_name"))


def recent_windows(gold: DataFrame, n: int = 20) -> DataFrame:
    """O2: the ``n`` most recent windows (ties broken by road name)."""
    return (gold.select("window_start", "window_end", "road_name", "avg_congestion_index", "total_observations")
            .orderBy(F.col("window_start").desc(), F.col("road_name").asc()).limit(n))


def road_trend(gold: DataFrame, road: str, tz: str = LOCAL_TZ) -> DataFrame:
    """U16: one road's windows, newest first."""
    return (gold.where(F.col("road_name") == F.lit(road))
            .select(local(tz=tz).alias("time_est"), "road_name",
                    stable_round("avg_congestion_index", 4).alias("congestion_index"), "traffic_status",
                    "total_observations")
            .orderBy(F.col("time_est").desc()))
