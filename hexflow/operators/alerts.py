"""GRIDLOCK alerts as rows: recency guard, cooldown guard, one alert per road.

The alert log is a table (``road_name, window_start, avg_congestion_index,
text, alerted_at, batch_id``) instead of process memory, so the cooldown
holds across job restarts. Delivery (a chat webhook, say) is left to a
consumer of the alert table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.congestion import GRIDLOCK, STATUS_DECIMALS
from ..functions.parse import as_timestamp

# Fixed value: the alert message, with the road name and the congestion index
# at two decimals.
ALERT_TEXT = "\U0001f6a8 *GRIDLOCK ALERT* \U0001f6a8\n\U0001f4cd Road: %s\n\U0001f4c9 Congestion Index: %.2f"

RECENCY_MINUTES = 30
COOLDOWN_MINUTES = 30
ALERT_COLUMNS = ("road_name", "window_start", "avg_congestion_index", "text", "alerted_at", "batch_id")
ALERT_SCHEMA = ("road_name string, window_start timestamp, avg_congestion_index double, text string, "
                "alerted_at timestamp, batch_id long")


def _minutes(n: int):
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(n)))


def recent_gridlocks(gold: DataFrame, as_of, recency_minutes: int = RECENCY_MINUTES) -> DataFrame:
    """GRIDLOCK windows not older than ``recency_minutes`` at ``as_of``
    (an event exactly that old is kept; only older ones are skipped)."""
    now = as_timestamp(as_of)
    since = now - _minutes(recency_minutes)
    if "window_date" in gold.columns:               # opens the days it may lie in only
        gold = gold.where(F.col("window_date") >= F.to_date(since))
    return gold.where((F.col("traffic_status") == F.lit(GRIDLOCK)) & (F.col("window_start") >= since))


def empty_alert_log(spark) -> DataFrame:
    return spark.createDataFrame([], ALERT_SCHEMA)


def read_alert_log(spark, path: str) -> DataFrame:
    """The alert table, partitioned by ``run_id`` (a checkpoint's identity) and
    ``batch_id``; empty when nothing was written."""
    return spark.read.schema(f"{ALERT_SCHEMA}, run_id string").parquet(path)


def gridlock_alerts(gold: DataFrame, alert_log: DataFrame | None, as_of, batch_id: int = 0,
                    recency_minutes: int = RECENCY_MINUTES, cooldown_minutes: int = COOLDOWN_MINUTES) -> DataFrame:
    """Alerts to emit for one batch of gold windows.

    * recency: see ``recent_gridlocks``
    * one alert per road: its latest window, then the highest CI
    * cooldown: skip a road alerted within ``cooldown_minutes`` before
      ``as_of`` (strictly more than that must have passed)
    """
    now = as_timestamp(as_of)
    cand = recent_gridlocks(gold, as_of, recency_minutes)
    pick = (cand.groupBy("road_name")
            .agg(F.max(F.struct("window_start", "avg_congestion_index")).alias("p"))
            .select("road_name", "p.window_start", "p.avg_congestion_index"))
    if alert_log is not None:
        # only alerts young enough to block matter, so older ones are never aggregated
        blocked = alert_log.where(F.col("alerted_at") >= now - _minutes(cooldown_minutes)).select("road_name").distinct()
        pick = pick.join(blocked, "road_name", "left_anti")
    return pick.select(
        "road_name", "window_start", "avg_congestion_index",
        F.format_string(ALERT_TEXT, F.col("road_name"),
                        F.round("avg_congestion_index", STATUS_DECIMALS)).alias("text"),
        now.alias("alerted_at"), F.lit(int(batch_id)).cast("long").alias("batch_id"))


def replay_alerts(gold: DataFrame, cooldown_minutes: int = COOLDOWN_MINUTES, grid_seconds: int = 60,
                  chunk_seconds: int = 86400) -> DataFrame:
    """Greedy cooldown over the whole history (T12, replay form).

    Per road, in window order: the first GRIDLOCK window alerts, and a later
    one alerts when more than ``cooldown_minutes`` have passed since the last
    *alert* (not the last window), so it is a fold, not a ``lag``.

    Computed without gathering a road: windows lie on a grid of
    ``grid_seconds`` (the window slide), so a road-day holds at most
    ``chunk_seconds / grid_seconds`` windows (1,440). At a day boundary all
    that matters is how many grid steps ago the last alert was, capped at the
    cooldown: ``C + 1`` states. Level 1 folds each road-day once per entry
    state (a bounded ``collect_list`` + ``aggregate``) into an exit-state map;
    level 2 composes the maps of consecutive days by pointer doubling
    (self-joins, log2(longest run of days) rounds, each round materialised);
    a final fold per road-day emits the alerts from its now known entry state.
    """
    from .joins import materialize

    if (cooldown_minutes * 60) % grid_seconds or chunk_seconds % grid_seconds:
        raise ValueError("cooldown and chunk must be whole multiples of the window grid")
    # one boundary state must tell the last alert, so a chunk is never shorter than the cooldown
    chunk_seconds *= max(1, -(-cooldown_minutes * 60 // chunk_seconds))
    c = cooldown_minutes * 60 // grid_seconds        # cooldown in grid steps: alert when gap > c
    d = chunk_seconds // grid_seconds                # grid steps per chunk (day)
    spark = gold.sparkSession
    t = F.unix_seconds(F.col("window_start"))
    u = F.when(t % grid_seconds == 0, F.floor(t / grid_seconds)).otherwise(
        F.raise_error(F.lit("a window does not start on the grid; pass the slide as grid_seconds")).cast("long"))
    g = (gold.where(F.col("traffic_status") == F.lit(GRIDLOCK))
         .select("road_name", u.alias("u"))
         .select("road_name", F.floor(F.col("u") / d).alias("day"), F.pmod(F.col("u"), F.lit(d)).alias("o")))
    chunks = g.groupBy("road_name", "day").agg(F.array_sort(F.collect_list("o")).alias("os"))

    def start_last(s):
        # entry state s: last alert s steps before the chunk; 0 = free
        return F.when(s == 0, F.lit(-(c + 1))).otherwise(-s).cast("long")

    def last_alert(os, s):
        return F.aggregate(os, start_last(s), lambda acc, o: F.when(o - acc > c, o.cast("long")).otherwise(acc))

    def exit_state(last):
        return F.when(F.lit(d) - last <= c, (F.lit(d) - last).cast("int")).otherwise(F.lit(0))

    states = F.sequence(F.lit(0), F.lit(c))
    level1 = materialize(chunks.withColumn(
        "f", F.transform(states, lambda s: exit_state(last_alert(F.col("os"), s)))), "replay-l1")

    span = level1.groupBy("road_name").agg((F.max("day") - F.min("day") + 1).alias("n")).agg(F.max("n")).first()[0]
    rounds = max(1, int(span or 1).bit_length())
    comp = level1.select("road_name", "day", "f")
    for j in range(rounds):
        step = 1 << j
        prev = comp.select("road_name", (F.col("day") + step).alias("day"), F.col("f").alias("pf"))
        # f after pf; a missing chunk means no alert that day, i.e. state 0 out
        joined = comp.join(prev, ["road_name", "day"], "left")
        composed = F.when(F.col("pf").isNull(), F.array_repeat(F.element_at("f", 1), c + 1)).otherwise(
            F.transform("pf", lambda x: F.element_at("f", x + 1)))
        comp = materialize(joined.select("road_name", "day", composed.alias("f")), "replay-l2")
    exits = comp.select("road_name", (F.col("day") + 1).alias("day"), F.element_at("f", 1).alias("entry"))
    fin = level1.join(exits, ["road_name", "day"], "left").withColumn("entry", F.coalesce("entry", F.lit(0)))
    emitted = F.aggregate(
        "os", F.struct(start_last(F.col("entry")).alias("last"), F.array().cast("array<long>").alias("out")),
        lambda acc, o: F.when(o - acc["last"] > c, F.struct(o.cast("long").alias("last"),
                                                            F.array_append(acc["out"], o.cast("long")).alias("out")))
        .otherwise(acc))["out"]
    alerts = (fin.select("road_name", "day", F.explode(emitted).alias("o"))
              .select("road_name", F.timestamp_seconds((F.col("day") * d + F.col("o")) * grid_seconds)
                      .alias("window_start")))
    return alerts.join(gold.select("road_name", "window_start", "avg_congestion_index"),
                       ["road_name", "window_start"])
