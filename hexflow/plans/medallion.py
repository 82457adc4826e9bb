"""Batch stages bronze -> silver -> gold over the driver tables.

Each function reads the given tables (or data Spark derives from them) and
returns a lazy DataFrame; the shared stages are materialised only where a
size check needs them (the crosswalk before it is broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import MAX_SPEED, enrich, quarantine_rows, readings, silver_rows
from ..operators.joins import MAX_BROADCAST_ROWS, materialize
from ..operators.roads import build_crosswalk, road_index, traffic_cells
from ..operators.windows import gold_from_readings
from ..sources.fixtures import FIXTURE_AS_OF, bronze_view, roads_view


def bronze_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_view(spark, sf_dir)


def readings_of(spark: SparkSession, sf_dir: str, as_of=FIXTURE_AS_OF) -> DataFrame:
    return readings(bronze_view(spark, sf_dir), as_of=as_of)


def road_index_of(spark: SparkSession, sf_dir: str, as_of=FIXTURE_AS_OF) -> DataFrame:
    return road_index(roads_view(spark, sf_dir), as_of=as_of)


def crosswalk_of(spark: SparkSession, sf_dir: str, strategy: str = "auto", as_of=FIXTURE_AS_OF,
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS, materialized: bool = True, with_size: bool = False):
    """The crosswalk, materialised in the checkpoint folder (it is read by
    every later stage and its size decides the enrichment join)."""
    xw = build_crosswalk(traffic_cells(bronze_view(spark, sf_dir)), road_index_of(spark, sf_dir, as_of),
                         strategy, max_broadcast_rows)
    return materialize(xw, with_count=with_size) if materialized else xw


def quality_counts_of(spark: SparkSession, sf_dir: str, crosswalk: DataFrame | None = None, as_of=FIXTURE_AS_OF) -> DataFrame:
    """One row: ``silver, no_match, unnamed, speed``, the rows of the silver
    table and of each quarantine reason, without building reading x road pairs:
    readings are counted per (cell, speed in bounds) and multiplied by the
    cell's named and unnamed roads."""
    xw = crosswalk if crosswalk is not None else crosswalk_of(spark, sf_dir, as_of=as_of)
    per_cell = (readings_of(spark, sf_dir, as_of).groupBy("h3_id", (F.col("currentSpeed") <= MAX_SPEED).alias("ok"))
                .agg(F.count(F.lit(1)).alias("m")))
    roads = xw.groupBy(F.col("h3_id").alias("cell")).agg(F.count("full_road_name").alias("named"), F.count(F.lit(1)).alias("all"))
    both = per_cell.join(roads, F.col("h3_id") == F.col("cell"), "left")
    m, named, unnamed = F.col("m"), F.col("named"), F.col("all") - F.col("named")
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    return both.agg(total(F.when(F.col("ok"), m * named), "silver"), total(F.when(F.col("cell").isNull(), m), "no_match"),
                    total(m * unnamed, "unnamed"), total(F.when(~F.col("ok"), m * named), "speed"))


def enriched_of(spark: SparkSession, sf_dir: str, strategy: str = "auto", as_of=FIXTURE_AS_OF, reads: DataFrame | None = None,
                crosswalk: DataFrame | None = None, size: tuple[int, int] | None = None) -> DataFrame:
    """``reads`` and ``crosswalk`` with its ``size``: those already materialised."""
    xw, size = (crosswalk, size) if crosswalk is not None else crosswalk_of(spark, sf_dir, as_of=as_of, with_size=True)
    return enrich(readings_of(spark, sf_dir, as_of) if reads is None else reads, xw, strategy, crosswalk_checked=True, size=size)


def silver_of(spark: SparkSession, sf_dir: str, strategy: str = "auto", as_of=FIXTURE_AS_OF, enriched: DataFrame | None = None) -> DataFrame:
    return silver_rows(enriched_of(spark, sf_dir, strategy, as_of) if enriched is None else enriched)


def quarantine_of(spark: SparkSession, sf_dir: str, strategy: str = "auto", as_of=FIXTURE_AS_OF, enriched: DataFrame | None = None) -> DataFrame:
    return quarantine_rows(enriched_of(spark, sf_dir, strategy, as_of) if enriched is None else enriched)


def gold_of(spark: SparkSession, sf_dir: str, size: str = "1 minute", slide: str | None = None,
            as_of=FIXTURE_AS_OF, keep_window: bool = False, reads: DataFrame | None = None, crosswalk: DataFrame | None = None) -> DataFrame:
    """Gold windows from bronze without materialising the reading x road fan-out.
    (The road weights are computed from the written crosswalk: on top of its
    plan, their filters would be pushed into the road centroid computation.)"""
    xw = crosswalk_of(spark, sf_dir, as_of=as_of) if crosswalk is None else crosswalk
    reads = readings_of(spark, sf_dir, as_of) if reads is None else reads
    return gold_from_readings(reads, xw, size, slide, keep_window=keep_window)
