"""Gold windows streamed from readings, by mergeable partial sums.

The stream's state holds one row per (bucket, cell): sum of the congestion
index, its count, and the number of readings. Reading x road pairs are never built.
A micro-batch upserts the changed sums into a sums table and derives again only
the windows that hold a changed bucket: cells meet the roads' weights
(``road_weights``) after their sums are added up.

A bucket is as long as the slide (the window, if it tumbles), so a sliding window
is a sum of whole buckets, and a bucket's sums are stored once, not once per
window that holds it. Repeating a micro-batch rewrites the same sums and windows.

Windows that a run touches carry the road names of the crosswalk as it is then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.congestion import congestion_index
from ..operators.enrich import MAX_SPEED, readings
from ..operators.joins import MAX_BROADCAST_ROWS, materialize, small_side, stream_side
from ..operators.windows import _seconds, bucket_windows, road_weights, time_window, to_gold
from ..sources.tables import upsert

SUMS_KEYS = ("cell", "bucket")


def bucket_sums(reads: DataFrame, bucket: str, watermark: str | None = None, time_col: str = "ingest_time") -> DataFrame:
    """``bucket, cell, s, nci, n`` of readings within the speed limit, batch or stream."""
    df = reads.where(F.col("currentSpeed") <= MAX_SPEED).select(
        F.coalesce(F.lower("h3_id"), F.lit("")).alias("cell"), F.col(time_col).alias("t"), congestion_index().alias("ci"))
    if watermark:
        df = df.withWatermark("t", watermark)
    return (df.groupBy(F.window("t", bucket).alias("w"), "cell")
            .agg(F.sum("ci").alias("s"), F.count("ci").alias("nci"), F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("bucket"), "cell", "s", "nci", "n"))


def windows_of(sums: DataFrame, weights: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Gold rows of the windows that the sums' buckets lie in."""
    return to_gold(bucket_windows(sums, weights, "bucket", time_window("bucket", size, slide)))


def touched_sums(spark: SparkSession, sums_path: str, changed: DataFrame, size: str, slide: str | None) -> DataFrame:
    """All stored sums whose bucket lies in a window that holds a changed bucket.
    Only the days around the changed buckets are opened."""
    seconds = _seconds(size)
    if seconds is None or slide and _seconds(slide) is None:
        raise ValueError(f"give size and slide as whole seconds, minutes, hours or days, not {size!r}, {slide!r}")
    lo, hi = changed.agg(F.min("bucket"), F.max("bucket")).first()
    reach = F.make_interval(secs=F.lit(seconds))
    stored = spark.read.parquet(sums_path)
    near = stored.where(F.col("window_date").between(F.to_date(F.lit(lo) - reach), F.to_date(F.lit(hi) + reach)))
    starts, _ = small_side(changed.select("bucket").distinct())         # as many as a batch's times, not its readings
    if not slide or slide == size:
        return near.join(starts, "bucket", "left_semi")
    # the windows of a changed bucket hold the buckets less than a window's length away
    step = _seconds(slide)
    away = F.sequence(F.lit(-(seconds - step)), F.lit(seconds - step), F.lit(step))
    around = starts.select(F.explode(F.transform(away, lambda d: F.timestamp_seconds(F.unix_timestamp("bucket") + d))).alias("bucket")).distinct()
    return near.join(small_side(around)[0], "bucket", "left_semi")


def sums_batch_writer(sums_path: str, gold_path: str, crosswalk: DataFrame, size: str, slide: str | None = None,
                      then=None, max_broadcast_rows: int = MAX_BROADCAST_ROWS):
    """``foreachBatch`` callback: upsert the changed sums, then the windows they
    touch. ``then(gold, batch_id)`` sees the windows derived (alerts)."""
    weights = stream_side(road_weights(crosswalk), "auto", max_broadcast_rows)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = materialize(batch, "changed-sums")
        if changed.isEmpty():
            return
        upsert(spark, sums_path, changed.withColumn("window_date", F.to_date("bucket")), keys=SUMS_KEYS, unique=True, staged=True)
        windows = windows_of(touched_sums(spark, sums_path, changed, size, slide), weights, size, slide)
        if slide and slide != size:
            # buckets at the edge also lie in windows without a changed bucket, which they give only in part
            w = F.window("bucket", size, slide)
            windows = windows.join(changed.select(w.start.alias("window_start")).distinct(), "window_start", "left_semi").select(*windows.columns)
        gold = materialize(windows, "touched-windows")
        upsert(spark, gold_path, gold, unique=True, staged=True)
        if then:
            then(gold, batch_id)
    return write


def run_gold_sums(bronze: DataFrame, crosswalk: DataFrame, sums_path: str, gold_path: str, checkpoint: str, size: str = "1 minute",
                  slide: str | None = None, watermark: str = "1 second", as_of=None, then=None) -> None:
    """Drain a bronze stream into the sums and gold tables."""
    sums = bucket_sums(readings(bronze, as_of=as_of), slide or size, watermark)
    q = (sums.writeStream.foreachBatch(sums_batch_writer(sums_path, gold_path, crosswalk, size, slide, then))
         .outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
