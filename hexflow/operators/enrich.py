"""Readings, map matching against the crosswalk, and the quality split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import DEFAULT_REF_LAT, DEFAULT_RES, add_cell
from ..functions.parse import parse_bronze
from .joins import MAX_BROADCAST_ROWS, materialize, small_side

# Quarantine reasons, in precedence order, and the speed limit.
REASON_NO_MATCH = "Map Matching Failed (NULL osm_id)"
REASON_UNNAMED = "Unnamed Road Segment (NULL name)"
REASON_SPEED = "Invalid Speed (> 150mph)"
MAX_SPEED = 150
# Our own fourth reason, used only when unparsed readings are kept.
REASON_UNPARSED = "Unparsed Reading (NULL point or speed)"

SILVER_COLUMNS = ("h3_id", "currentSpeed", "freeFlowSpeed", "road_name", "osm_id", "full_road_name", "ingest_time")
QUARANTINE_COLUMNS = ("h3_id", "currentSpeed", "osm_id", "error_reason", "ingest_time")


def readings(bronze: DataFrame, as_of=None, res: int = DEFAULT_RES, ref_lat: float = DEFAULT_REF_LAT,
             watermark: str | None = None, keep_unparsed: bool = False, keep: tuple = ()) -> DataFrame:
    """Parsed readings with a cell id: ``h3_id, currentSpeed, freeFlowSpeed, ingest_time``
    (and the columns ``keep`` of ``bronze``).

    Rows without a cell or a speed are dropped before the join (they reach
    neither silver nor quarantine) unless ``keep_unparsed``. The watermark is
    optional: no stateful operator follows it in the silver stage, so it
    drops nothing there.
    """
    cols = ["h3_id", "currentSpeed", "freeFlowSpeed", "ingest_time", *keep]
    p = add_cell(parse_bronze(bronze, as_of=as_of), "lon", "lat", "h3_id", res, ref_lat)
    # Rows are emitted through ``inline``, those without a point or a speed as a
    # NULL array instead of a Filter: Catalyst pushes Filters (also those that a
    # later join or split brings) below the parse projection and inlines it,
    # parsing every payload and computing every cell again; a generator keeps
    # both to once per row. (The cell is NULL exactly when lon or lat is NULL.)
    row = F.array(F.struct(*cols))
    ok = F.col("h3_id").isNotNull() & F.col("currentSpeed").isNotNull()
    p = p.select(F.inline(row if keep_unparsed else F.when(ok, row)))
    return p.withWatermark("ingest_time", watermark) if watermark else p


def join_crosswalk(reads: DataFrame, side: DataFrame) -> DataFrame:
    """Every reading with the roads of its cell (one row with NULL roads where
    there are none), ``side`` joined as hinted by the caller. Cell ids compare
    without case; a reading without a speed (kept as unparsed) meets no road,
    so it stays one row."""
    roads = side.select(F.lower("h3_id").alias("_cell"), "osm_id", "full_road_name")
    keyed = reads.withColumn("_cell", F.when(F.col("currentSpeed").isNotNull(), F.lower("h3_id")))
    return keyed.join(roads, "_cell", "left").select(
        "h3_id", "currentSpeed", "freeFlowSpeed", "osm_id", "full_road_name", "ingest_time")


def hot_cells(reads: DataFrame, slots: int) -> dict[str, int]:
    """Cells that hold more than a slot's share of the readings, with the slices
    that cut them down to it: at most ``slots`` cells, counted map-side."""
    counts = reads.groupBy(F.lower("h3_id").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts.where("cell IS NOT NULL"), "cell-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r["cell"]: -(-r["n"] * slots // total) for r in counts.where(F.col("n") * slots > total).collect()}


def join_crosswalk_salted(reads: DataFrame, side: DataFrame, slots: int | None = None) -> DataFrame:
    """``join_crosswalk`` for a crosswalk too large to broadcast: readings of a hot
    cell are dealt over slices by a running number, and the roads of that cell alone
    are copied to each slice, so no task takes more than about a slot's share."""
    slots = slots or int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reads = materialize(reads, "salted-reads")          # counted, then joined
    hot = hot_cells(reads, slots)
    if not hot:
        return join_crosswalk(reads, side)
    slices = F.create_map(*[x for c, n in hot.items() for x in (F.lit(c), F.lit(n))])
    of = lambda cell: F.coalesce(F.element_at(slices, cell), F.lit(1))
    keyed = (reads.withColumn("_cell", F.when(F.col("currentSpeed").isNotNull(), F.lower("h3_id")))
             .withColumn("_slice", F.pmod(F.monotonically_increasing_id(), of(F.coalesce("_cell", F.lit("")))).cast("int")))
    roads = side.select(F.lower("h3_id").alias("_cell"), "osm_id", "full_road_name")
    roads = roads.withColumn("_slice", F.explode(F.sequence(F.lit(0), of(F.coalesce("_cell", F.lit(""))) - 1)))
    return keyed.join(roads, ["_cell", "_slice"], "left").select(
        "h3_id", "currentSpeed", "freeFlowSpeed", "osm_id", "full_road_name", "ingest_time")


def enrich(reads: DataFrame, crosswalk: DataFrame, strategy: str = "auto",
           max_broadcast_rows: int = MAX_BROADCAST_ROWS, crosswalk_checked: bool = False,
           size: tuple[int, int] | None = None) -> DataFrame:
    """LEFT join of readings to every road of their cell (case-insensitive cell id).

    One reading matches every road in its cell, so a reading yields one row
    per matched road (or one row with NULL road columns). The crosswalk is
    broadcast only after its row count is measured within the bound; beyond
    it hot cells are salted.
    """
    side, chosen = small_side(crosswalk.select("h3_id", "osm_id", "full_road_name"), strategy,
                              max_broadcast_rows, checked=crosswalk_checked, size=size)
    return join_crosswalk_salted(reads, side) if chosen == "shuffle" else join_crosswalk(reads, side)


def valid_condition(max_speed: int = MAX_SPEED):
    return ((F.col("currentSpeed") <= max_speed) & F.col("full_road_name").isNotNull()
            & F.col("osm_id").isNotNull())


def error_reason(max_speed: int = MAX_SPEED, unparsed: bool = False):
    """Quarantine reason, NULL for a valid row. Precedence: (unparsed,) no
    match, unnamed, speed."""
    rules = [(F.col("osm_id").isNull(), REASON_NO_MATCH), (F.col("full_road_name").isNull(), REASON_UNNAMED),
             (F.col("currentSpeed") > max_speed, REASON_SPEED)]
    if unparsed:
        rules.insert(0, (F.col("h3_id").isNull() | F.col("currentSpeed").isNull(), REASON_UNPARSED))
    out = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, reason in rules[1:]:
        out = out.when(cond, F.lit(reason))
    return out


def silver_rows(enriched: DataFrame, max_speed: int = MAX_SPEED, more: dict | None = None) -> DataFrame:
    """Valid rows; ``more`` (name -> expression over the enriched row) columns follow the fixed ones."""
    return (enriched.where(valid_condition(max_speed))
            .withColumn("road_name", F.lit(None).cast("string"))
            .select(*SILVER_COLUMNS, *[c.alias(n) for n, c in (more or {}).items()]))


def quarantine_rows(enriched: DataFrame, max_speed: int = MAX_SPEED, unparsed: bool = False) -> DataFrame:
    """Rows failing the quality check, with their reason. With ``unparsed``
    (readings built with ``keep_unparsed=True``), rows without a cell or a
    speed are kept here too instead of being dropped."""
    bad = (F.col("currentSpeed") > max_speed) | F.col("osm_id").isNull() | F.col("full_road_name").isNull()
    no_speed = F.col("currentSpeed").isNull()
    bad = bad | F.col("h3_id").isNull() | no_speed if unparsed else bad & ~no_speed
    return (enriched.where(bad).withColumn("error_reason", error_reason(max_speed, unparsed))
            .select(*QUARANTINE_COLUMNS))


def split_quality(enriched: DataFrame, max_speed: int = MAX_SPEED) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): exact complements over rows with a non-NULL speed."""
    return silver_rows(enriched, max_speed), quarantine_rows(enriched, max_speed)
