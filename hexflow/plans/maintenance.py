"""Layout and maintenance as Spark jobs: table detail, compaction, range layout.

* ``table_detail``: files and bytes of a Parquet table from a listing, rows from
  the footers (no data column is read).
* ``compact``: rewrites a table into files of about ``target_bytes`` in a new
  folder, then swaps the folders; a crash between is recoverable.
* ``range_layout``: range-partition and sort on the lookup columns, so the
  Parquet min/max statistics of each file cover a narrow key range and an
  equality filter skips most files (the effect of a one-column ZORDER).
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.layout import range_layout  # noqa: F401
from ..sources.tables import delete_path, path_exists

DEFAULT_TARGET_BYTES = 128 * 1024 * 1024


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """``file_path, file_size`` of every data file, those without rows included: a
    listing by Spark's binary file source, of which only path and length are read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
            .select(F.col("path").alias("file_path"), F.col("length").alias("file_size")))


def table_detail(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``num_files, size_in_bytes, num_rows``; rows are counted from the files' footers."""
    files = table_files(spark, path).select(F.lit(1).alias("f"), F.col("file_size").alias("b"), F.lit(0).cast("long").alias("r"))
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("r")).select(F.lit(0).alias("f"), F.lit(0).cast("long").alias("b"), "r")
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    return files.unionByName(rows).agg(total("f", "num_files"), total("b", "size_in_bytes"), total("r", "num_rows"))


def table_sizes(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """M5: ``table_name, num_files, size_in_bytes, num_rows`` for each named path."""
    out = None
    for name, path in tables.items():
        d = table_detail(spark, path).select(F.lit(name).alias("table_name"), "*")
        out = d if out is None else out.unionByName(d)
    return out


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    jvm = spark.sparkContext._jvm
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(s, d):
        raise RuntimeError(f"rename {src} -> {dst} failed")


def _old(path: str) -> str:
    return f"{path.rstrip('/')}.compact-old"


def recover_compaction(spark: SparkSession, path: str) -> None:
    """Finish a swap that a crash cut short: the table's folder is back, old or new."""
    if path_exists(spark, _old(path)):
        if path_exists(spark, path):
            delete_path(spark, _old(path))
        else:
            _rename(spark, _old(path), path)


def compact(spark: SparkSession, path: str, target_bytes: int = DEFAULT_TARGET_BYTES,
            partition_col: str | None = None) -> dict:
    """Rewrite ``path`` into files of about ``target_bytes``; returns before/after
    detail. A partition value larger than that is split into several files.

    Refuses a stream's sink: its file log names the files to be replaced. The
    swap is two renames with fixed names, which ``recover_compaction`` (also run
    first) finishes or undoes; no other job may write the table meanwhile.
    """
    recover_compaction(spark, path)
    if path_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{path} is the sink of a stream; compact a copy of it")
    before = table_detail(spark, path).first().asDict()
    df = spark.read.parquet(path)
    tmp = f"{path.rstrip('/')}.compact-{uuid.uuid4().hex[:8]}"
    if partition_col:
        # pieces per partition value from the bytes of its files; rows are dealt over them by a hash of the row
        files = (df.select(F.col(partition_col), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
                 .groupBy(partition_col, "f").agg(F.max("b").alias("b"))
                 .groupBy(partition_col).agg(F.ceil(F.sum("b") / target_bytes).cast("int").alias("_pieces")))
        pieces = {r[0]: r[1] for r in files.collect()}                # one row per partition value
        n = F.lit(1)
        for value, k in pieces.items():
            if k > 1:
                n = F.when(F.col(partition_col).eqNullSafe(F.lit(value)), F.lit(k)).otherwise(n)
        rest = [c for c in df.columns if c != partition_col] or df.columns
        dealt = df.withColumn("_piece", F.pmod(F.xxhash64(*rest), n))
        (dealt.repartition(max(1, sum(pieces.values())), partition_col, "_piece").drop("_piece")
         .write.partitionBy(partition_col).parquet(tmp))
    else:
        df.repartition(max(1, math.ceil(before["size_in_bytes"] / target_bytes))).write.parquet(tmp)
    _rename(spark, path, _old(path))
    _rename(spark, tmp, path)
    delete_path(spark, _old(path))
    after = table_detail(spark, path).first().asDict()
    return {"files_before": before["num_files"], "files_after": after["num_files"],
            "bytes_before": before["size_in_bytes"], "bytes_after": after["size_in_bytes"]}


def reduction(before: float, after: float) -> float:
    """Percent reduction from ``before`` to ``after`` (M6)."""
    return 0.0 if not before else (before - after) * 100.0 / before
