"""Join strategy selection with a checked broadcast.

A side is broadcast only after its row count has been *measured* below a
bound; beyond the bound the join falls back to a shuffled join, where AQE
(``spark.sql.adaptive.skewJoin.enabled``) splits skewed partitions. The
measured side is first materialised as a Parquet table in the shared
checkpoint folder (one job; ``checkpoint()`` would compute the plan once to
count and again to write), so the size check and the join both read files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path

# Default bounds on what is broadcast: rows, and bytes as measured from the
# data (string bytes + fixed widths), far under Spark's 8 GB broadcast limit
# and a driver's memory.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 512 * 1024 * 1024

# A stream collects and sends a broadcast side again for every micro-batch (and
# query), so only a side of few bytes is worth it there.
STREAM_BROADCAST_BYTES = 4 * 1024 * 1024

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")


def row_bytes(df: DataFrame):
    """Per-row size estimate: UTF-8 bytes of strings plus 8 per other field."""
    parts = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if f.dataType.typeName() == "string" else F.lit(8)
             for f in df.schema.fields]
    out = F.lit(16)
    for p in parts:
        out = out + p
    return out


def materialize(df: DataFrame, name: str = "stage", with_path: bool = False, with_count: bool = False):
    """Cut the lineage of ``df``: write it once as Parquet under the shared
    checkpoint folder and read it back. Survives the loss of any executor
    (the files are on shared storage), and later jobs re-read files instead
    of recomputing the plan. ``with_path`` also returns the folder, for a
    caller that removes it once done; ``with_count`` also returns
    ``(rows, bytes)``, observed during the write (no extra job)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"{name}-size")
    df.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes")).write.parquet(path)
    out = spark.read.parquet(path)
    size = (int(obs.get["rows"]), int(obs.get["bytes"] or 0))
    extra = ((path,) if with_path else ()) + ((size,) if with_count else ())
    return (out, *extra) if extra else out


def bounded_size(df: DataFrame, bound: int) -> tuple[int, int]:
    """``(rows, bytes)`` of ``df``, summed in its tasks; ``bound`` is what the caller compares with."""
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes")).first()
    return int(r["rows"]), int(r["bytes"] or 0)


def small_side(df: DataFrame, strategy: str = "auto", max_rows: int = MAX_BROADCAST_ROWS,
               checked: bool = False, where=None, max_bytes: int = MAX_BROADCAST_BYTES,
               size: tuple[int, int] | None = None) -> tuple[DataFrame, str]:
    """Prepare the small side of a join and say which strategy it gets.

    ``auto``: materialise, measure rows and bytes (observed during the write),
    broadcast if both are within bounds, else shuffle join. ``broadcast`` is honoured only when the check passes (the
    bound is never skipped). ``merge`` / ``shuffle_hash`` hint as asked.
    ``checked=True`` means the caller already materialised ``df``, ``size`` the
    (rows, bytes) it observed doing so.
    ``where`` is applied to the materialised files: a filter on a computed
    column written on top of the plan would be pushed down and inlined into
    the computation (even into the scan), evaluating it twice.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy in ("merge", "shuffle_hash"):
        side = materialize(df, "small-side") if where is not None and not checked else df
        side = side.where(where) if where is not None else side
        return side.hint(strategy), strategy
    if checked:
        side, (n, size) = df, size or bounded_size(df, max_rows)
    else:
        side, (n, size) = materialize(df, "small-side", with_count=True)
    if where is not None:
        side = side.where(where)     # n and size stay upper bounds
    if n <= max_rows and size <= max_bytes:
        return F.broadcast(side), "broadcast"
    return side, "shuffle"


def stream_side(df: DataFrame, strategy: str = "auto", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``small_side`` for a stream-static join: broadcast within STREAM_BROADCAST_BYTES,
    else a merge join by hint, as Spark would broadcast a side whose files are small."""
    side, chosen = small_side(df, strategy, max_rows, max_bytes=STREAM_BROADCAST_BYTES)
    return side.hint("merge") if chosen == "shuffle" else side
