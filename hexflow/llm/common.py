"""Shared pieces: word and space patterns, defensive column handling, and the
bounded-broadcast helper."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import sys

import pyarrow
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Fixed patterns: a word is a maximal run of anything but space and 09-0D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
ARROW_ROWS, ARROW_BYTES = 1_000, 4_000_000
BLANKS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file; HEXFLOW_TOKENIZERS names another folder."""
    folder = os.environ.get("HEXFLOW_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def text_of(name: str = "text") -> Column:
    """The text column, NULL read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """``row``, all columns of ``docs`` as one struct, beside columns of our own,
    so that none of theirs can clash; ``select("row.*")`` gives them back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *more)


def in_small_batches(rows: DataFrame) -> DataFrame:
    """Before mapInArrow over texts: at most ARROW_ROWS rows and about ARROW_BYTES
    go to Python at once, which bounds a worker's memory (texts may be long)."""
    conf = rows.sparkSession.conf
    for name, most in (("Records", ARROW_ROWS), ("Bytes", ARROW_BYTES)):
        key = f"spark.sql.execution.arrow.max{name}PerBatch"
        now = conf.get(key).rstrip("bB")
        if not (now.isdigit() and 0 < int(now) <= most):
            conf.set(key, str(most))
    return rows


def trimmed(work):
    """``work`` for mapInArrow, giving its memory back at the end of a task: the
    Python worker lives on and waits for the next one."""
    def run(batches):
        yield from work(batches)
        gc.collect()
        pyarrow.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)
    return run


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda variable
    of a one-element array, which Catalyst never inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_words(text: Column) -> Column:
    """Words in a text: the pieces between runs of blanks, without the empty
    ones that a leading or trailing run makes. NULL counts none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, SPACE))).cast("long")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    back: cuts the lineage, and survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes tables of ``written`` that nothing will read any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_below(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """``df`` hinted for broadcast only when its measured ``rows`` are within
    the bound; beyond it the join is shuffled."""
    return F.broadcast(df) if rows <= max_rows else df


def by_value(module_name: str) -> None:
    """Send a module's functions to the Python workers by value, so executors
    need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


by_value(__name__)
