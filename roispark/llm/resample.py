"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k (operator 7)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.llm.common import append_columns, fresh, text_of
from roispark.llm.text import ALNUM, Slice, slices
from roispark.session import materialize

# Buckets that words and word pairs are hashed to: the size of both models.
BUCKETS = 1 << 16
SMOOTHING = 0.5
FRACTION = 0.5
SEED = 7
_BINS, _FEW = 1024, 10_000


def grams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and pairs of neighbouring words, and the row that each belongs to."""
    out, rows = [], []
    for k in (1, 2):
        value, start = part.shingles(k)
        size = np.diff(start)
        row = np.repeat(np.arange(len(size)), size)
        if k == 2:
            # A text of one word has no pair.
            value, row = value[np.diff(part.first)[row] > 1], row[np.diff(part.first)[row] > 1]
        out.append((value & np.uint64(BUCKETS - 1)).astype(np.int64))
        rows.append(row)
    return np.concatenate(out), np.concatenate(rows)


def bucket_counts(rows: DataFrame) -> DataFrame:
    """``(bucket, n, n_target)`` over all of ``rows(text, target)``: one dense table a task, summed by bucket."""

    def run(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            target = np.asarray(batch.column("target").cast(pa.int8()))
            for part in slices(text_of(batch), ALNUM):
                bucket, row = grams(part)
                total[0] += np.bincount(bucket, minlength=BUCKETS)
                mine = target[part.rows.start:part.rows.stop][row] == 1
                total[1] += np.bincount(bucket[mine], minlength=BUCKETS)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(total[0][some]), pa.array(total[1][some])], ["bucket", "n", "n_target"])

    return rows.mapInArrow(run, "bucket int, n long, n_target long").groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


def log_ratio(counts: DataFrame) -> np.ndarray:
    """log of target to raw probability for every bucket (BUCKETS numbers, whatever the corpus)."""
    table = counts.toPandas()
    raw, target = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    raw[table.bucket] += table.n
    target[table.bucket] += table.n_target
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def gumbel(*columns: str | Column, seed: int) -> Column:
    """Standard Gumbel noise that depends on the given columns and the seed only."""
    uniform = (F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(2**53))
    return -F.log(-F.log(uniform))


def kth_largest(rows: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value, by histograms over ever narrower ranges; no row order and no collected rows."""
    lowest, highest, total = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if not total or k < 1:
        return None
    k, low, high = min(k, total), lowest, highest
    while True:
        inside = rows.where(F.col(column).between(low, high))
        few = inside.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc(column)).limit(_FEW + 1).collect()
        if len(few) <= _FEW:
            for r in few:
                k -= r["n"]
                if k <= 0:
                    return r[column]
        bin_ = F.least(F.lit(_BINS - 1), F.floor((F.col(column) - low) / ((high - low) / _BINS))).alias("b")
        parts = {r["b"]: (r["n"], r["lo"], r["hi"]) for r in inside.groupBy(bin_).agg(
            F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()}
        for b in sorted(parts, reverse=True):
            n, low, high = parts[b]
            if k <= n:
                break
            k -= n


def resample(docs: DataFrame, labels: DataFrame, fraction: float = FRACTION, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_grams, log_weight, gumbel_key, kept)`` for every row of ``docs(doc_id, text)``.

    The target model is learned from the documents labelled ``quality`` 1, the raw model from all documents.
    A document's log weight is the sum of its n-grams' log ratios; with Gumbel noise added, the largest
    ``fraction`` of keys is a sample without replacement in proportion to the weights.

    Defined cases: texts without words have weight 0 (log) and take part; rows that repeat doc_id and text have
    the same key and fare alike; of repeated label rows the larger quality counts; without target documents all
    weights are 0 and the sample is uniform; an empty table gives no rows; other columns are ignored.
    """
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # The same plan at every size: documents are counted where they are, the labelled ones once more.
    target = rows.join(good.hint("merge"), rows["doc_id"] == good["_id"]).select("text", F.lit(1).alias("target"))
    counts = materialize(bucket_counts(rows.select("text", F.lit(0).alias("target"))).select("bucket", "n").join(
        bucket_counts(target).select("bucket", "n_target"), "bucket", "left").fillna(0))
    ratio = log_ratio(counts)
    if not counts.where("n_target > 0").limit(1).count():
        ratio[:] = 0
    known = docs.sparkSession.sparkContext.broadcast(ratio)
    size, weight = fresh(rows, stem="n"), fresh(rows, stem="w")

    def work(batch):
        n, w = [np.zeros(0, np.int64)], [np.zeros(0)]
        for part in slices(text_of(batch), ALNUM):
            bucket, row = grams(part)
            n.append(np.bincount(row, minlength=len(part.rows)))
            w.append(np.bincount(row, known.value[bucket], minlength=len(part.rows)))
        return [pa.array(np.concatenate(n), pa.int64()), pa.array(np.concatenate(w), pa.float64())]

    scored = append_columns(rows.withColumn("noise", gumbel("doc_id", "text", seed=seed)), work,
                            [T.StructField(size, T.LongType()), T.StructField(weight, T.DoubleType())])
    scored = materialize(scored.select(
        "doc_id", F.col(size).alias("n_grams"), F.col(weight).alias("log_weight"),
        (F.col(weight) + F.col("noise")).alias("gumbel_key")))
    limit = kth_largest(scored, "gumbel_key", round(fraction * scored.count()))
    return scored.withColumn("kept", F.lit(False) if limit is None else F.col("gumbel_key") >= F.lit(limit))
