"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(*taken: DataFrame, stem: str = "c") -> str:
    """A column name that no given table uses."""
    names = {c.lower() for df in taken for c in df.columns}
    while (name := f"_{stem}_{uuid.uuid4().hex[:8]}") in names:
        pass
    return name


def crc_bucket(column: str | Column, buckets: int) -> Column:
    """crc32 of the value as text, modulo ``buckets``."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % buckets


def released(run):
    """The work of a task, which gives Arrow's unused memory back at its end: a worker is used again by other stages."""

    def work(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return work


def append_columns(df: DataFrame, work, fields: list) -> DataFrame:
    """``df`` with the columns that ``work(batch) -> arrays`` computes for each Arrow batch."""
    names = [f.name for f in fields]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *work(batch)], [*batch.schema.names, *names])

    return df.mapInArrow(released(run), T.StructType([*df.schema.fields, *fields]))


def text_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    return batch.column(name).cast(pa.large_string())
