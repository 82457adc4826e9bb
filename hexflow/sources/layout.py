"""Physical layout of table files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def range_layout(df: DataFrame, cols, num_files: int) -> DataFrame:
    """Range-partition on ``cols`` into ``num_files`` partitions, sorted within each."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.repartitionByRange(num_files, *cols).sortWithinPartitions(*cols)
