"""Incremental processing of arriving inventory files.

The batch form of resuming is ``inventory.pending``; this is the same step driven
by a file-source stream: every micro-batch keeps only groups whose fingerprint has
no completed run, processes them, and records them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roispark.operators import inventory
from roispark.session import materialize


def process_arrivals(spark: SparkSession, source: str, schema, runs_path: str, checkpoint: str,
                     process: Callable[[DataFrame], None], config: str = "", files_path: str | None = None) -> StreamingQuery:
    """Process all new inventory files once and stop (``availableNow``).

    Every file seen is kept in ``files_path`` (one partition per batch, overwritten when a batch is replayed), so a
    folder that arrives in several batches is fingerprinted and processed whole, as the batch form would.  ``process``
    receives all inventory rows of the touched folders that are unfinished; their fingerprints are appended to
    ``runs_path`` afterwards.  A replayed batch whose fingerprints are there does nothing; one that failed in between
    is processed again, so ``process`` should replace what it wrote for a folder.
    """
    files_path = files_path or runs_path.rstrip("/") + "_files"

    def one_batch(batch: DataFrame, epoch: int) -> None:
        batch.select("path", "size").write.mode("overwrite").parquet(f"{files_path}/batch={epoch}")
        seen = inventory.path_parts(spark.read.parquet(files_path).select("path", "size").distinct())
        touched = inventory.path_parts(spark.read.parquet(f"{files_path}/batch={epoch}")).select("folder").distinct()
        files = materialize(seen.join(touched, "folder", "left_semi"))
        now = inventory.fingerprints(files, ["folder"], ["path", "size"], config)
        done = spark.read.schema("folder string, fingerprint string").parquet(runs_path)
        todo = materialize(inventory.pending(now, done, ["folder"]))
        process(files.join(todo.select("folder"), "folder", "left_semi"))
        todo.select("folder", "fingerprint").write.mode("append").parquet(runs_path)

    spark.createDataFrame([], "folder string, fingerprint string").write.mode("append").parquet(runs_path)
    stream = spark.readStream.schema(schema).parquet(source).select(F.col("path"), F.col("size"))
    return (stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
