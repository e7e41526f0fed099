"""The training-corpus pipeline: documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the runner writes it as Parquet and
hands what it reads back to the next stage.  All stages but the last return the columns of ``documents``.
When a stage begins, the result of the one before is written, so its intermediate tables are deleted then.
"""

from __future__ import annotations

import functools
import gc
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roispark.llm import decontam, neardup, packing, pii, toxicity
from roispark.llm.common import table
from roispark.session import collecting, discard, scratch_dir

# Bytes that a Python worker gets at once (at least one row): the default is many times that, held on both sides.
BATCH_BYTES = 2 << 20

_held: list[DataFrame] = []


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of the last stage, whose result must be written."""
    discard(*_held)
    _held.clear()
    # Spark removes the shuffle files of plans that nothing refers to any more.
    gc.collect()
    spark._jvm.System.gc()


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]):
    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        with collecting(_held):
            return work(spark, docs, sf_dir)
    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go; the labels are those of the given tables."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, similarity 0.8)."""
    return neardup.drop_near_duplicates(docs)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@stage
def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kinds; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence, with its ids (little-endian unsigned 32-bit)."""
    return packing.pack(docs).select(
        "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", redact_pii),
    ("packing", pack),
]

# The models, signatures and the tokenizer have no SQL form; tests/llm compares the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        path = f"{scratch_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
        work(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    release(spark)
    return docs
