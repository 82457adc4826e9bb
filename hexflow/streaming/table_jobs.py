"""The scheduled run over catalog tables.

The same stages as ``jobs.run_scheduled``, reading and writing tables by name:
road load -> road index -> bronze (stream) -> crosswalk (rebuilt, clustered on the
cell) -> silver and quarantine (streams) -> gold (stream, upserted). Streams
append with ``toTable`` and read with ``readStream.table``; tables whose writer has
new columns are widened first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.enrich import join_crosswalk, quarantine_rows, readings, silver_rows
from ..operators.joins import stream_side
from ..operators.roads import build_crosswalk, load_roads, road_index, traffic_cells
from ..operators.windows import congestion_windows, to_gold
from ..sources import catalog as C
from ..sources.tables import ensure_tables, upsert
from .jobs import infer_landing_schema, stream_landing


def load_road_table(spark: SparkSession, database: str, roads: DataFrame, as_of=None) -> None:
    """The road table and its index, replaced as a whole (one-time or on a new extract)."""
    C.create_or_replace_as(load_roads(roads), f"{database}.bronze_osm_roads")
    C.overwrite(road_index(C.read(spark, f"{database}.bronze_osm_roads"), as_of=as_of), f"{database}.silver_osm_enriched", cluster_by="h3_id")


def upsert_table(spark: SparkSession, table: str, rows: DataFrame, **kwargs) -> int:
    """MERGE into a partitioned catalog table; its new partitions are registered."""
    n = upsert(spark, C.location(spark, table), rows, stored=C.read(spark, table), **kwargs)
    if n:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        spark.catalog.refreshTable(table)
    return n


def run_scheduled_tables(spark: SparkSession, database: str, landing: str, checkpoints: str, as_of=None,
                         max_files: int | None = None, silver_columns=None) -> None:
    """One scheduled run: every stage drains what is new. ``silver_columns``
    (name -> expression over the enriched rows) are added to the silver rows; the
    silver table is widened by those it lacks."""
    ensure_tables(spark, database)
    bronze, silver, errors, gold = (f"{database}.{t}" for t in ("bronze_traffic", "silver_traffic", "bronze_errors", "gold_traffic_stats"))
    schema = infer_landing_schema(spark, landing, f"{checkpoints}/landing_schema")
    C.stream_into(stream_landing(spark, landing, schema, max_files), bronze, f"{checkpoints}/bronze")
    crosswalk = f"{database}.silver_road_crosswalk"
    C.overwrite(build_crosswalk(traffic_cells(C.read(spark, bronze)), C.read(spark, f"{database}.silver_osm_enriched")), crosswalk, cluster_by="h3_id")
    side = stream_side(C.read(spark, crosswalk))

    def enriched() -> DataFrame:
        return join_crosswalk(readings(C.stream_from(spark, bronze, max_files), as_of=as_of), side)

    valid = enriched()
    extra = silver_columns or {}
    C.stream_into(silver_rows(valid, more=extra), silver, f"{checkpoints}/silver")
    C.stream_into(quarantine_rows(enriched()), errors, f"{checkpoints}/quarantine")
    windows = congestion_windows(C.stream_from(spark, silver), watermark="1 second", keep_window=True)
    q = (windows.writeStream.foreachBatch(lambda batch, _: upsert_table(batch.sparkSession, gold, to_gold(batch), unique=True) and None)
         .outputMode("update").option("checkpointLocation", f"{checkpoints}/gold").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
