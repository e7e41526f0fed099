"""Session set-up and the one way this library cuts lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "roispark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    Cluster sizing (executors, memory, shuffle partitions) stays with the
    submitter; only semantics-relevant settings are fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Sorting is skipped only where every partition of the smaller side was measured to fit.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Where the cluster names none, a local folder is acceptable only in local
    mode; on a cluster an intermediate table must outlive the executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = os.path.join(tempfile.gettempdir(), f"spark-roispark-{uuid.uuid4().hex[:8]}")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


_owners: list[list[DataFrame]] = []


def own(df: DataFrame, path: str) -> DataFrame:
    """``df`` reads the files in ``path``, which the innermost owner deletes."""
    df._scratch_path = path
    if _owners:
        _owners[-1].append(df)
    return df


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that no later job reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def collecting(tables: list[DataFrame]) -> Iterator[None]:
    """Tables that ``materialize`` writes inside are added to ``tables``; whoever holds the list discards them."""
    _owners.append(tables)
    try:
        yield
    finally:
        _owners.pop()


def settled(build: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``build``, written; the tables that were written on the way are deleted."""
    inner: list[DataFrame] = []
    with collecting(inner):
        df = build()
    written = materialize(df)
    discard(*inner)
    return written


def materialize(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This is a durable lineage cut: a lost executor re-reads files instead of
    re-running the upstream plan, the values are frozen (needed wherever a row
    position is derived), and the file sizes give the planner true statistics
    for its broadcast decisions.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/t-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return own(spark.read.schema(df.schema).parquet(path), path)
