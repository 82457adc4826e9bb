"""Catalog tables: typed creation, widening, replacement, and statements.

Tables are Parquet tables of the session catalog. A database is made with its
location on shared storage, so no table depends on a machine's working folder.

* ``widen`` adds columns that a writer has and the table lacks; files written
  before read back as NULL there.
* ``create_or_replace_as`` writes the new contents beside the old table and swaps
  names at the end, so the old table stays readable until then. A swap that
  was interrupted is finished or undone by the next call (``recover``).
* ``overwrite`` replaces contents within the table's schema, staged first, so a
  query may read the table that it overwrites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import materialize
from ..session import scratch_path
from .layout import range_layout
from .tables import delete_path

STAGED, OLD = "__staged", "__old"
TARGET_BYTES = 256 * 1024 * 1024        # raw bytes a clustered file


def ensure_database(spark: SparkSession, name: str, location: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def create_typed(spark: SparkSession, table: str, columns: str, partition_by: str | None = None) -> None:
    part = f" PARTITIONED BY ({partition_by})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{part}")


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def read(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now: a stream's sink adds files behind the catalog's back."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def widen(spark: SparkSession, table: str, schema) -> list[str]:
    """Add the columns of ``schema`` that the table lacks; their names."""
    have = {f.name.lower() for f in spark.table(table).schema}
    new = [f for f in schema if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    return [f.name for f in new]


def conformed(df: DataFrame, schema) -> DataFrame:
    """``df`` with the columns of ``schema`` in order, typed, absent ones NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def insert_into(df: DataFrame, table: str) -> None:
    """INSERT INTO by name: columns that the table lacks are added first."""
    spark = df.sparkSession
    widen(spark, table, df.schema)
    conformed(df, spark.table(table).schema).write.mode("append").insertInto(table)


def overwrite(df: DataFrame, table: str, cluster_by: str | None = None, files: int | None = None) -> None:
    """Replace the contents; the schema is widened where ``df`` has more columns.
    ``cluster_by``: the files hold narrow ranges of that column, sorted, so a lookup
    by it opens the one that its footer statistics admit (``files`` of them; as many as
    the size asks for if not given)."""
    spark = df.sparkSession
    widen(spark, table, df.schema)
    rows, path, (_, size) = materialize(conformed(df, spark.table(table).schema), "overwrite", with_path=True, with_count=True)
    if cluster_by:
        rows = range_layout(rows, cluster_by, files or max(1, -(-size // TARGET_BYTES)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").insertInto(table)
    delete_path(spark, path)


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def recover(spark: SparkSession, table: str) -> None:
    """Finish or undo a swap that did not end: a table without its name gets the
    old contents back; leftovers beside it go."""
    if not exists(spark, table) and exists(spark, table + OLD):
        spark.sql(f"ALTER TABLE {table}{OLD} RENAME TO {table}")
    for leftover in (table + STAGED, table + OLD):
        drop(spark, leftover)


def create_or_replace_as(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    """CREATE OR REPLACE TABLE ... AS SELECT: contents and schema of ``df``, which
    may read the table itself."""
    spark = df.sparkSession
    recover(spark, table)
    w = df.write.format("parquet")
    if partition_by:
        w = w.partitionBy(partition_by)
    db, name = table.rsplit(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
    # a folder of its own per version: renaming the table never moves files
    folder = spark.sql(f"DESCRIBE DATABASE {db}").where("info_name = 'Location'").first()[1]
    w.option("path", scratch_version(spark, folder, name)).saveAsTable(table + STAGED)
    if not exists(spark, table):
        spark.sql(f"ALTER TABLE {table}{STAGED} RENAME TO {table}")
        return
    old = location(spark, table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{OLD}")
    spark.sql(f"ALTER TABLE {table}{STAGED} RENAME TO {table}")
    drop(spark, table + OLD)
    delete_path(spark, old)


def scratch_version(spark: SparkSession, folder: str, name: str) -> str:
    """A new folder name for a version of a table."""
    return f"{folder.rstrip('/')}/_versions/{scratch_path(spark, name).rsplit('/', 1)[-1]}"


def stream_from(spark: SparkSession, table: str, max_files: int | None = None) -> DataFrame:
    """A catalog table as a stream, ``max_files`` per batch."""
    spark.catalog.refreshTable(table)
    r = spark.readStream
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    return r.table(table)


def stream_into(df: DataFrame, table: str, checkpoint: str) -> None:
    """Append a stream to a catalog table, exactly once, draining what is there;
    the table is made, or widened where the stream has more columns."""
    spark = df.sparkSession
    if exists(spark, table):
        widen(spark, table, df.schema)
        df = conformed(df, spark.table(table).schema)
    q = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).toTable(table))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    spark.catalog.refreshTable(table)
