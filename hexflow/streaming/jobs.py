"""Structured Streaming jobs: landing JSON -> bronze -> silver/quarantine -> gold.

Every job is ``availableNow`` (drain what is there, then stop) with its own
checkpoint, so a scheduled run resumes exactly where the last one stopped and
a lost executor only re-runs tasks. The transforms are the batch ones of
``hexflow.operators``; only sources and sinks differ.

* bronze: file source over landing JSON (schema fixed per run, widened
  between runs by ``infer_landing_schema``) -> Parquet file sink (exactly once).
* silver: bronze as a stream, parse + cell, stream-static LEFT join with the
  crosswalk (broadcast only if small: it is sent again for every batch), two Parquet sinks (valid and
  quarantine) as two independent queries.
* gold: silver as a stream, watermark, windowed aggregate in update mode,
  ``foreachBatch`` upsert into the partitioned gold table and alert rows
  into an alert table partitioned by ``batch_id`` (idempotent on replay).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.alerts import COOLDOWN_MINUTES, RECENCY_MINUTES, gridlock_alerts, read_alert_log
from ..operators.enrich import join_crosswalk, quarantine_rows, readings, silver_rows
from ..operators.joins import MAX_BROADCAST_ROWS, materialize, stream_side
from ..operators.roads import build_crosswalk, traffic_cells
from ..operators.windows import congestion_windows, to_gold
from ..session import owned_scratch
from ..sources.tables import QUARANTINE_SCHEMA, SILVER_SCHEMA, delete_matching, delete_path, path_exists, upsert  # noqa: F401
from .sums import run_gold_sums

# Fields every landing record may carry (read as text; absent ones are NULL).
LANDING_FIELDS = ("currentSpeed", "freeFlowSpeed", "coordinates", "flowSegmentData", "pulled_at")
CORRUPT = "_corrupt_record"      # the text of a malformed line, so that bronze can be replayed
MAX_FILE_AGE_DAYS = 7            # the file stream's own maxFileAge


def landing_schema(extra=()) -> T.StructType:
    """All-STRING landing schema: nested objects arrive as their JSON text."""
    names = list(dict.fromkeys([*LANDING_FIELDS, CORRUPT, *extra]))
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def landed_fields(spark: SparkSession, landing_dir: str, since: str | None = None) -> list[str]:
    """Top-level field names of the landed JSON, in order of the name: a Spark
    job over every file (sub-folders included) modified after ``since``."""
    r = spark.read.option("recursiveFileLookup", "true")
    if since:
        r = r.option("modifiedAfter", since)
    keys = r.text(landing_dir).select(F.explode(F.json_object_keys("value")).alias("k"))
    return [row["k"] for row in keys.distinct().orderBy("k").collect()]     # as many as the API has fields


def infer_landing_schema(spark: SparkSession, landing_dir: str, store_path: str | None = None) -> T.StructType:
    """The landing schema of every file that a stream may still consume, every
    field typed STRING.

    Without a stored schema all files are read. The stored one (at
    ``store_path``) is widened with new names, never narrowed; then only files
    modified after the last reading less MAX_FILE_AGE_DAYS are read, the age
    beyond which the file stream itself ignores files.
    """
    names: list[str] = []
    since = None
    started = spark.sql("SELECT date_format(current_timestamp() - make_interval(0, 0, 0, "
                        f"{MAX_FILE_AGE_DAYS}), \"yyyy-MM-dd'T'HH:mm:ss\")").first()[0]
    if store_path and path_exists(spark, store_path):
        stored = json.loads(spark.read.text(store_path).first()[0])
        names = T.StructType.fromJson(stored["schema"]).fieldNames()
        since = stored["since"]
    names = [*names, *[n for n in landed_fields(spark, landing_dir, since) if n not in names]]
    schema = landing_schema(names)
    if store_path:
        stored = json.dumps({"schema": json.loads(schema.json()), "since": started})
        spark.createDataFrame([(stored,)], "v string").coalesce(1).write.mode("overwrite").text(store_path)
    return schema


def stream_landing(spark: SparkSession, landing_dir: str, schema: T.StructType | None = None,
                   max_files: int | None = None, **options) -> DataFrame:
    """New-file JSON stream; the seen-file log lives in the query checkpoint."""
    r = spark.readStream.schema(schema or landing_schema()).option("columnNameOfCorruptRecord", CORRUPT)
    r = r.option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    for k, v in options.items():
        r = r.option(k, v)
    return r.json(landing_dir)


def stream_table(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A Parquet table (file-sink output) read as a stream, ``max_files`` per batch.
    Batches of fewer files than task slots are dealt over all slots: a file is
    one task, which would parse all of its payloads."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    rows, slots = r.parquet(path), spark.sparkContext.defaultParallelism
    return rows.repartition(slots) if max_files and max_files < slots else rows


def refuse_new_checkpoint(spark: SparkSession, path: str, checkpoint: str) -> None:
    """A stream without a checkpoint starts at batch 0; a table that an earlier
    checkpoint wrote would skip or repeat its rows. ``replay`` starts over."""
    if path_exists(spark, path) and not path_exists(spark, f"{checkpoint.rstrip('/')}/metadata"):
        raise RuntimeError(f"{path} was written from another checkpoint than {checkpoint}; use replay()")


def _mark(path: str, checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-tables/{path.rstrip('/').rsplit('/', 1)[-1]}"


def refuse_lost_table(spark: SparkSession, path: str, checkpoint: str) -> None:
    """A checkpoint whose table is gone would go on after the lost rows without an error."""
    if path_exists(spark, _mark(path, checkpoint)) and not path_exists(spark, path):
        raise RuntimeError(f"{path}, written from checkpoint {checkpoint}, is gone; use replay()")


def mark_table(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Note beside the checkpoint that it has written the table."""
    if path_exists(spark, path):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(_mark(path, checkpoint))
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def _drain(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def append_stream(df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> None:
    """Append to a Parquet table, exactly once, draining what is available."""
    append_streams((df, path, checkpoint), partition_by=partition_by)


def append_streams(*streams: tuple[DataFrame, str, str], partition_by: str | None = None) -> None:
    """The same of several (rows, path, checkpoint) at once: while one plans and
    commits its small batches, the others use the slots."""
    for df, path, checkpoint in streams:
        refuse_new_checkpoint(df.sparkSession, path, checkpoint)
        refuse_lost_table(df.sparkSession, path, checkpoint)
    queries = []
    try:
        for df, path, checkpoint in streams:
            w = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True))
            queries.append((w.partitionBy(partition_by) if partition_by else w).start(path))
        for query, (df, path, checkpoint) in zip(queries, streams, strict=True):
            _drain(query)
            mark_table(df.sparkSession, path, checkpoint)
    finally:
        for query in queries:           # after a failure the others end too; their checkpoints tell where
            query.stop()


def run_bronze(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint: str,
               schema: T.StructType | None = None, max_files: int | None = None, **options) -> None:
    """With ``max_files``, a batch is written in no more files than it may have read:
    later streams take as many files a batch, and would need a batch for every few tasks."""
    rows, slots = stream_landing(spark, landing_dir, schema, max_files, **options), spark.sparkContext.defaultParallelism
    if max_files and max_files < slots:
        rows = rows.repartition(max_files)
    append_stream(rows, bronze_path, checkpoint)


def run_silver(spark: SparkSession, bronze_path: str, bronze_schema, crosswalk: DataFrame, silver_path: str,
               quarantine_path: str, checkpoint: str, as_of=None, watermark: str | None = "15 minutes",
               strategy: str = "auto", max_broadcast_rows: int = MAX_BROADCAST_ROWS, max_files: int | None = None,
               keep_unparsed: bool = False) -> None:
    """Two queries over the same bronze stream: valid rows and quarantined rows."""
    side = stream_side(crosswalk.select("h3_id", "osm_id", "full_road_name"), strategy, max_broadcast_rows)

    def enriched():
        r = readings(stream_table(spark, bronze_path, bronze_schema, max_files), as_of=as_of, watermark=watermark,
                     keep_unparsed=keep_unparsed)
        return join_crosswalk(r, side)

    append_streams((silver_rows(enriched()), silver_path, f"{checkpoint}/silver"),
                   (quarantine_rows(enriched(), unparsed=keep_unparsed), quarantine_path, f"{checkpoint}/quarantine"))


def run_silver_one_pass(spark: SparkSession, bronze_path: str, bronze_schema, crosswalk: DataFrame,
                        silver_path: str, quarantine_path: str, checkpoint: str, as_of=None,
                        strategy: str = "auto", max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                        max_files: int | None = None, keep_unparsed: bool = False) -> None:
    """One query, one parse per micro-batch: the parsed batch is persisted, then
    enriched and split into both tables inside ``foreachBatch`` (its readings
    are kept, not the several times as many reading x road rows).

    ``foreachBatch`` is at-least-once, so both tables are partitioned by
    ``batch_id`` and written with dynamic partition overwrite: a replayed
    batch replaces its own rows. The batch size is bounded by the source
    (``max_files`` per trigger), which bounds what is persisted.
    """
    side = stream_side(crosswalk.select("h3_id", "osm_id", "full_road_name"), strategy, max_broadcast_rows)
    for path in (silver_path, quarantine_path):
        refuse_new_checkpoint(spark, path, checkpoint)
        refuse_lost_table(spark, path, checkpoint)
    parsed = readings(stream_table(spark, bronze_path, bronze_schema, max_files), as_of=as_of, keep_unparsed=keep_unparsed)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        enriched = join_crosswalk(batch, side)
        try:
            for rows, path in ((silver_rows(enriched), silver_path), (quarantine_rows(enriched, unparsed=keep_unparsed), quarantine_path)):
                (rows.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_id").parquet(path))
        finally:
            batch.unpersist()

    q = (parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    _drain(q)
    for path in (silver_path, quarantine_path):
        mark_table(spark, path, checkpoint)


def crosswalk_batch_writer(road_index: DataFrame, crosswalk_path: str, seen_path: str,
                           strategy: str = "auto", max_broadcast_rows: int = MAX_BROADCAST_ROWS):
    """``foreachBatch`` callback keeping the crosswalk current on *new* cells.

    Cells of the batch not seen before are joined with the road index and
    appended; every new cell (matched or not) is recorded in ``seen_path`` so
    it is never looked up again, and a batch without new cells leaves the road
    index alone. Both tables are partitioned by ``batch_id``
    and written with dynamic overwrite, and a replayed batch ignores its own
    earlier partition, so replays are idempotent.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cells = traffic_cells(batch).where(F.col("h3_id").isNotNull())
        if path_exists(spark, seen_path):
            seen = spark.read.schema("h3_id string, batch_id long").parquet(seen_path)
            cells = cells.join(seen.where(F.col("batch_id") != F.lit(int(batch_id))).select("h3_id"),
                               "h3_id", "left_anti")
        bid = F.lit(int(batch_id)).cast("long").alias("batch_id")
        new_cells, size = materialize(cells, "crosswalk-new-cells", with_count=True)
        if not size[0] and path_exists(spark, seen_path) and path_exists(spark, crosswalk_path):
            return
        xw = build_crosswalk(new_cells, road_index, strategy, max_broadcast_rows, size=size)
        for df, path in ((xw.select("*", bid), crosswalk_path), (new_cells.select("h3_id", bid), seen_path)):
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(path))
    return write


def run_crosswalk(spark: SparkSession, bronze_path: str, bronze_schema, road_index: DataFrame,
                  crosswalk_path: str, seen_path: str, checkpoint: str, max_files: int | None = None) -> None:
    """Incremental crosswalk: only the new bronze files of each run are read."""
    refuse_new_checkpoint(spark, seen_path, checkpoint)
    for path in (seen_path, crosswalk_path):
        refuse_lost_table(spark, path, checkpoint)
    q = (stream_table(spark, bronze_path, bronze_schema, max_files).writeStream.foreachBatch(crosswalk_batch_writer(road_index, crosswalk_path, seen_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _drain(q)
    for path in (seen_path, crosswalk_path):
        mark_table(spark, path, checkpoint)


ROAD_KEY = ("h3_id", "osm_id", "full_road_name")


def _without(left: DataFrame, right: DataFrame, columns=ROAD_KEY) -> DataFrame:
    """Rows of ``left`` that ``right`` lacks; NULLs are equal."""
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in columns]
    return left.alias("l").join(right.alias("r"), same, "left_anti")


def road_changes(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gone, added): (cell, road, name) rows of one road index that the other
    lacks. A renamed or moved road is gone under its old row and added under its new one."""
    old, new = (i.select(*ROAD_KEY).distinct() for i in (old, new))
    return _without(old, new), _without(new, old)


def _fingerprint(roads: DataFrame) -> tuple:
    return tuple(roads.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*ROAD_KEY).cast("decimal(38,0)"))).first())


def refresh_crosswalk(spark: SparkSession, road_index: DataFrame, crosswalk_path: str, seen_path: str, roads_path: str) -> int:
    """Apply the road index's changes since the last run to the crosswalk of the
    cells seen so far; the number of changes.

    ``roads_path`` keeps the road index as last applied. Only changed roads meet the
    seen cells: rows of roads that are gone, renamed or moved leave the partitions that
    hold them, rows of new ones go to a partition of their own (-1, -2, ...). The
    kept index is replaced last, so a run that fails is simply run again."""
    now = road_index.select(*ROAD_KEY)
    if not path_exists(spark, roads_path) or not path_exists(spark, crosswalk_path):
        if path_exists(spark, crosswalk_path):          # an index was never kept: compare with what stands there
            seen = spark.read.schema("h3_id string, batch_id long").parquet(seen_path).select("h3_id").distinct()
            old = read_crosswalk(spark, crosswalk_path)
            gone, added = road_changes(old, build_crosswalk(seen, road_index))
        else:
            now.write.mode("overwrite").parquet(roads_path)
            return 0
    else:
        old = spark.read.schema(now.schema).parquet(roads_path)
        if _fingerprint(old) == _fingerprint(now):
            return 0
        gone, added = road_changes(old, now)
    gone, (n_gone, _) = materialize(gone, "roads-gone", with_count=True)
    added, (n_added, _) = materialize(added, "roads-added", with_count=True)
    if n_gone:
        delete_matching(spark, crosswalk_path, gone, ROAD_KEY, "batch_id", "h3_id string, osm_id string, full_road_name string, batch_id long")
    if n_added:
        seen = spark.read.schema("h3_id string, batch_id long").parquet(seen_path).select("h3_id").distinct()
        have = spark.read.schema("h3_id string, osm_id string, full_road_name string, batch_id long").parquet(crosswalk_path)
        new = _without(build_crosswalk(seen, added), have)
        least = have.agg(F.least(F.min("batch_id"), F.lit(0))).first()[0] or 0
        (materialize(new, "crosswalk-new-roads").withColumn("batch_id", F.lit(int(least) - 1).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(crosswalk_path))
    if n_gone or n_added:
        kept, path = materialize(now, "roads-kept", with_path=True)
        kept.write.mode("overwrite").parquet(roads_path)
        delete_path(spark, path)
    elif not path_exists(spark, roads_path):
        now.write.mode("overwrite").parquet(roads_path)
    return n_gone + n_added


def read_crosswalk(spark: SparkSession, crosswalk_path: str) -> DataFrame:
    return spark.read.schema("h3_id string, osm_id string, full_road_name string, batch_id long") \
        .parquet(crosswalk_path).drop("batch_id")


def gold_batch_writer(gold_path: str, alert_path: str | None, as_of=None,
                      recency_minutes: int = RECENCY_MINUTES, cooldown_minutes: int = COOLDOWN_MINUTES):
    """``foreachBatch`` callback: upsert the changed windows, then write alerts.

    Alerts of batch N go to ``run_id=<checkpoint>/batch_id=N`` with dynamic
    overwrite, so a repeated batch rewrites its own alerts instead of adding
    copies, and a query with another checkpoint (whose batches count from 0
    again) never overwrites the log that the cooldown reads.
    """
    alert = alert_writer(alert_path, as_of, recency_minutes, cooldown_minutes)

    def write(batch: DataFrame, batch_id: int) -> None:
        # staged: both the table and the alerts read it, and a micro-batch's plan would run again for each
        gold, path = materialize(to_gold(batch), "gold-batch", with_path=True)
        upsert(batch.sparkSession, gold_path, gold, unique=True, staged=True)
        alert(gold, batch_id)
        delete_path(batch.sparkSession, path)
    return write


def alert_writer(alert_path: str | None, as_of=None, recency_minutes: int = RECENCY_MINUTES, cooldown_minutes: int = COOLDOWN_MINUTES):
    """Writes the alerts of a batch's gold rows to its own partition of the log."""
    def write(gold: DataFrame, batch_id: int) -> None:
        spark = gold.sparkSession
        run_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        if alert_path is None:
            return
        now = F.current_timestamp() if as_of is None else as_of
        log = None
        if path_exists(spark, alert_path):
            log = read_alert_log(spark, alert_path).where(
                (F.col("run_id") != F.lit(run_id)) | (F.col("batch_id") != F.lit(int(batch_id))))
        alerts = gridlock_alerts(gold, log, now, batch_id, recency_minutes, cooldown_minutes)
        (alerts.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "batch_id").parquet(alert_path))
    return write


def run_gold(spark: SparkSession, silver_path: str, gold_path: str, checkpoint: str, alert_path: str | None = None,
             size: str = "1 minute", slide: str | None = None, watermark: str = "1 second", as_of=None,
             max_files: int | None = None) -> None:
    refuse_lost_table(spark, gold_path, checkpoint)
    agg = congestion_windows(stream_table(spark, silver_path, SILVER_SCHEMA, max_files), size, slide, watermark,
                             keep_window=True)
    q = (agg.writeStream.foreachBatch(gold_batch_writer(gold_path, alert_path, as_of))
         .outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _drain(q)
    mark_table(spark, gold_path, checkpoint)


def scheduled_paths(base: str) -> dict:
    """Folder layout of one deployment under ``base`` (shared storage)."""
    names = ("landing", "bronze", "crosswalk", "cells_seen", "silver", "quarantine", "gold", "alerts", "roads", "sums")
    p = {k: f"{base.rstrip('/')}/{k}" for k in names}
    p["schema"] = f"{base.rstrip('/')}/_landing_schema"
    p["ckpt"] = f"{base.rstrip('/')}/_checkpoints"
    return p


def run_scheduled(spark: SparkSession, base: str, road_index: DataFrame, as_of=None, one_pass: bool = False,
                  max_files: int | None = None, keep_unparsed: bool = False, reader_options: dict | None = None,
                  gold_from: str = "readings", size: str = "1 minute", slide: str | None = None) -> dict:
    """One scheduled run (every few minutes): every stage drains what is new.

    landing JSON -> bronze; bronze -> crosswalk (new cells, and new roads of
    seen cells); bronze -> silver + quarantine (stream-static join with the
    crosswalk as it is now); silver -> gold (upsert) + alerts. Each stage has
    its own checkpoint, so a run resumes where the previous one stopped, and a
    failed run is re-run. ``max_files`` bounds the batches of the stages without
    event-time state; gold takes a run's rows as one batch, since its watermark
    moves between batches and would drop what lies out of order within a run.
    ``reader_options`` go to the landing reader. ``gold_from``: "readings" streams
    partial sums per cell (``streaming.sums``), "silver" aggregates the stored
    silver rows. Scratch folders are removed.
    """
    p = scheduled_paths(base)
    with owned_scratch(spark):
        schema = infer_landing_schema(spark, p["landing"], p["schema"])
        run_bronze(spark, p["landing"], p["bronze"], f"{p['ckpt']}/bronze", schema, max_files, **(reader_options or {}))
        road_index = materialize(road_index.select(*ROAD_KEY), "road-index")       # centroids once a run
        refresh_crosswalk(spark, road_index, p["crosswalk"], p["cells_seen"], p["roads"])
        run_crosswalk(spark, p["bronze"], schema, road_index, p["crosswalk"], p["cells_seen"], f"{p['ckpt']}/crosswalk",
                      max_files)
        crosswalk = read_crosswalk(spark, p["crosswalk"])
        silver = run_silver_one_pass if one_pass else run_silver
        silver(spark, p["bronze"], schema, crosswalk, p["silver"], p["quarantine"], f"{p['ckpt']}/silver",
               as_of=as_of, max_files=max_files, keep_unparsed=keep_unparsed)
        if gold_from == "silver":
            run_gold(spark, p["silver"], p["gold"], f"{p['ckpt']}/gold", p["alerts"], size, slide, as_of=as_of)
        else:
            for path in (p["gold"], p["sums"]):
                refuse_new_checkpoint(spark, path, f"{p['ckpt']}/gold")
                refuse_lost_table(spark, path, f"{p['ckpt']}/gold")
            run_gold_sums(stream_table(spark, p["bronze"], schema), crosswalk, p["sums"], p["gold"], f"{p['ckpt']}/gold", size, slide,
                          as_of=as_of, then=alert_writer(p["alerts"], as_of))
            for path in (p["gold"], p["sums"]):
                mark_table(spark, path, f"{p['ckpt']}/gold")
    return p


STAGE_TABLES = {"bronze": ("bronze",), "crosswalk": ("crosswalk", "cells_seen", "roads"), "silver": ("silver", "quarantine"), "gold": ("gold", "sums")}


def replay(spark: SparkSession, base: str, road_index: DataFrame, from_stage: str = "bronze", **kwargs) -> dict:
    """Rebuild every table from ``from_stage`` on with new checkpoints, after a
    change of logic or batch size. Tables and checkpoints of those stages are
    dropped together and derived again from the stage before (the landing
    folder keeps every record), so nothing is lost or doubled; a replay that
    fails is run again. The alert log stays: alerts sent are not sent again
    within their cooldown."""
    p = scheduled_paths(base)
    stages = list(STAGE_TABLES)
    for stage in stages[stages.index(from_stage):]:
        # checkpoints go first: a table without one is refused, a checkpoint without its table would lose rows
        for path in (f"{p['ckpt']}/{stage}", f"{p['ckpt']}/{stage}-tables", *[p[t] for t in STAGE_TABLES[stage]]):
            if path_exists(spark, path):
                delete_path(spark, path)
    return run_scheduled(spark, base, road_index, **kwargs)
