"""Table sinks on plain Parquet: typed DDL, overwrite, upsert, delete.

Open Spark has no MERGE / DELETE on Parquet, so both are written as Spark
jobs over the *touched partitions only*:

* ``upsert``: old rows of the touched partitions minus the keys of the
  update (``left_anti``), plus the update, written back with dynamic
  partition overwrite. The batch and the merged partitions are first staged
  as Parquet in the shared checkpoint folder (removed afterwards), so the
  write never reads the files it replaces and a lost executor only re-runs
  tasks. Re-applying a batch is harmless.
* ``delete_where``: counts the matches, rewrites the touched partitions with
  the negated predicate, and removes partitions left empty.

Single writer per table; a batch spanning several partitions is not atomic
across them (each partition is replaced whole).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.joins import materialize
from ..session import scratch_path

GOLD_SCHEMA = ("road_name string, window_start timestamp, window_end timestamp, avg_congestion_index double, "
               "traffic_status string, total_observations int")
SILVER_SCHEMA = ("h3_id string, currentSpeed int, freeFlowSpeed int, road_name string, osm_id string, "
                 "full_road_name string, ingest_time timestamp")
QUARANTINE_SCHEMA = "h3_id string, currentSpeed int, osm_id string, error_reason string, ingest_time timestamp"
ROAD_INDEX_SCHEMA = ("osm_id string, full_road_name string, lat double, lon double, h3_id string, "
                     "ingest_time timestamp")
CROSSWALK_SCHEMA = "h3_id string, osm_id string, full_road_name string"

BRONZE_SCHEMA = "currentSpeed string, freeFlowSpeed string, coordinates string, flowSegmentData string, pulled_at string"

TABLE_DDL = {
    "bronze_traffic": BRONZE_SCHEMA,
    "silver_osm_enriched": ROAD_INDEX_SCHEMA,
    "silver_road_crosswalk": CROSSWALK_SCHEMA,
    "silver_traffic": SILVER_SCHEMA,
    "bronze_errors": QUARANTINE_SCHEMA,
    "gold_traffic_stats": GOLD_SCHEMA + ", window_date date",
}
PARTITIONS = {"gold_traffic_stats": "window_date"}


def ensure_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` for every typed table."""
    made = []
    for name, cols in TABLE_DDL.items():
        full = f"{database}.{name}" if database else name
        part = f" PARTITIONED BY ({PARTITIONS[name]})" if name in PARTITIONS else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({cols}) USING parquet{part}")
        made.append(full)
    return made


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table whose appends widened the schema (K2): columns
    missing from older files come back NULL."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def with_window_date(df: DataFrame, partition_col: str = "window_date") -> DataFrame:
    return df.withColumn(partition_col, F.to_date("window_start"))


def _in_partitions(col: str, values: list):
    """Rows of the given partitions; None names the NULL partition."""
    some = [v for v in values if v is not None]
    cond = F.col(col).isin(some) if some else F.lit(False)
    return cond | F.col(col).isNull() if None in values else cond


def upsert(spark: SparkSession, target: str, updates: DataFrame, keys=("road_name", "window_start"),
           partition_col: str = "window_date", order_col: str | None = None, stored: DataFrame | None = None,
           unique: bool = False, staged: bool = False) -> int:
    """MERGE semantics: a matched key is replaced by the update row, a new key
    is inserted. NULL keys match NULL keys. Keys repeated within ``updates`` keep
    one row: the greatest ``order_col`` when given, and the greatest of the
    other columns among equals. ``stored``: the target's rows where they aren't
    read from its path (a catalog table, empty perhaps). ``unique``: no key repeats
    within ``updates`` (they are grouped by them). ``staged``: ``updates`` are read
    from files that this doesn't write. Returns the number of partitions rewritten."""
    keys = list(keys)
    if partition_col not in updates.columns:
        updates = with_window_date(updates, partition_col)
    if not unique:
        # Bounded: only duplicates of one key compete, never a whole road.
        first = [order_col] if order_col else []
        rest = [c for c in updates.columns if c not in keys and c != order_col]
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in first + rest] or [F.lit(1)])
        updates = updates.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    scratch = []
    if unique and staged:
        touched = [r[0] for r in updates.select(partition_col).distinct().collect()]      # the days one batch spans
    else:
        # Stage the batch once; the touched partitions are observed during that write
        # (a set bounded by the days one batch spans), not by another job.
        scratch.append(scratch_path(spark, "upsert-batch"))
        obs = Observation("upsert-days")
        updates.observe(obs, F.collect_set(partition_col).alias("days"),
                        F.count_if(F.col(partition_col).isNull()).alias("none")).write.parquet(scratch[0])
        updates = spark.read.parquet(scratch[0])
        touched = [*(obs.get["days"] or []), *([None] if obs.get["none"] else [])]
    if touched:
        merged = updates
        if stored is not None or path_exists(spark, target):
            old = (spark.read.parquet(target) if stored is None else stored).where(_in_partitions(partition_col, touched)).alias("old")
            merged = updates.select(*old.columns)
            if not old.isEmpty():               # the files that are read are replaced, so the result is staged
                new = updates.select(*[F.col(k).alias(f"_{k}") for k in keys])
                same = reduce(lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"_{k}")) for k in keys])
                merged, path = materialize(old.join(new, same, "left_anti").unionByName(merged), "upsert-merged", with_path=True)
                scratch.append(path)
        # rebalanced: a day comes in files of the advisory size, a large day in several
        (merged.hint("rebalance", F.col(partition_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col).parquet(target))
    for path in scratch:   # staged copies are only needed until the target is rewritten
        delete_path(spark, path)
    return len(touched)


def delete_where(spark: SparkSession, target: str, predicate: str, partition_col: str = "window_date") -> int:
    """DELETE FROM target WHERE predicate; returns the number of rows deleted."""
    table = spark.read.parquet(target)
    cond = F.coalesce(F.expr(predicate), F.lit(False))
    # one row per touched partition, with its folder as Spark wrote it (escaped, or the NULL folder)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    counts = (table.withColumn("_folder", folder).where(cond).groupBy(partition_col)
              .agg(F.count(F.lit(1)).alias("n"), F.first("_folder").alias("folder")).collect())
    deleted = sum(r["n"] for r in counts)
    if not deleted:
        return 0
    touched = _in_partitions(partition_col, [r[partition_col] for r in counts])
    rest, staged = materialize(table.where(touched & ~cond), "delete-rest", with_path=True)
    keep = {r[0] for r in rest.select(partition_col).distinct().collect()}     # touched partitions that keep rows
    if keep:
        (rest.hint("rebalance", F.col(partition_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col).parquet(target))
    for r in counts:
        if r[partition_col] not in keep:
            delete_path(spark, r["folder"])
    delete_path(spark, staged)
    return deleted


def delete_matching(spark: SparkSession, target: str, rows: DataFrame, keys, partition_col: str, schema: str) -> int:
    """DELETE the rows of ``target`` whose keys (NULLs equal) stand in ``rows``; the
    number of partitions rewritten. Only partitions that hold such a row are."""
    table = spark.read.schema(schema).parquet(target).alias("t")
    same = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys])
    found = table.join(rows.select(*keys).distinct().alias("d"), same, "left_semi")
    touched = [r[0] for r in found.select(partition_col).distinct().collect()]      # partitions, not rows
    if not touched:
        return 0
    part = table.where(_in_partitions(partition_col, touched))
    rest, staged = materialize(part.join(rows.select(*keys).distinct().alias("d"), same, "left_anti").select("t.*"), "delete-rest", with_path=True)
    keep = {r[0] for r in rest.select(partition_col).distinct().collect()}
    if keep:
        (rest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(target))
    for value in touched:
        if value not in keep:
            delete_path(spark, f"{target.rstrip('/')}/{partition_col}={value}")
    delete_path(spark, staged)
    return len(touched)
