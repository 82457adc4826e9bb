"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes every stage's result as Parquet under the shared checkpoint
folder and reads it back as the next one's input.

ORACLE_SQL is None: learned scores, hash thresholds and BPE can't be said in
SQL; tests/llm compares the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexflow.llm import op3_toxicity, op4_bpe, op5_exact_dedup, op8_jaccard_join, op10_mixing
from hexflow.llm.common import documents, tokenizer, written

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay; the labels' training fold teaches."""
    return op3_toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (blanks normalised) the row with the least doc_id stays."""
    return op5_exact_dedup.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles, Jaccard 0.8) the least doc_id stays."""
    return op8_jaccard_join.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (none, once or twice)."""
    return op10_mixing.taken_rows(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row: doc_id, source, n_tokens, ids."""
    out = op4_bpe.encode(docs, tokenizer("word_bpe_49k.json"), "doc_id", "source")
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mixing),
    ("BPE encoding and decoding", bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return written(STAGES[-1][1](spark, docs, sf_dir), "pipeline")
