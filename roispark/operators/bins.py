"""Rank bins, histograms, exemplars and deterministic samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roispark.functions.ranking import first_rows, group_quantiles, ranked
from roispark.schema import K, KP, OBJ

# Report constants.
PERCENTILE_BINS = 20
PER_BIN = 5
SEED = 42
HISTOGRAM_BINS = 50
OVERLAP_BIN_WIDTH = 5
OVERLAP_BINS = 20
QUARTILE_EXEMPLARS = 10
PAIR_SAMPLE = 15


def chunk_of(rank: Column, total: Column, chunks: int) -> tuple[Column, Column, Column]:
    """0-based chunk, position in the chunk and chunk size when ``total`` ranks are
    split into ``chunks`` nearly equal runs, the longer ones first."""
    size, longer = F.floor(total / chunks), F.pmod(total, F.lit(chunks))
    i = rank - 1
    edge = longer * (size + 1)
    in_long = i < edge
    chunk = F.when(in_long, F.floor(i / (size + 1))).otherwise(
        longer + F.floor((i - edge) / F.greatest(size, F.lit(1))))
    start = F.when(in_long, F.floor(i / (size + 1)) * (size + 1)).otherwise(
        edge + F.floor((i - edge) / F.greatest(size, F.lit(1))) * size)
    return (chunk.cast("long"), (i - start).cast("long"),
            F.when(in_long, size + 1).otherwise(size).cast("long"))


def rank_bins(metrics: DataFrame, metric: str, bins: int = PERCENTILE_BINS,
              keys: list[str] = K) -> DataFrame:
    """B1: rank bins of a non-negative metric, ties ordered by object id."""
    use = metrics.where(F.col(metric).isNotNull() & (F.col(metric) >= 0)).select(
        *keys, "object_id", metric)
    chunk, _, _ = chunk_of(F.col("rn"), F.col("n"), bins)
    width = 100 // bins
    return ranked(use, keys, [metric, "object_id"]).withColumn("bin", chunk).select(
        *keys, "object_id", metric, "bin",
        F.concat((F.col("bin") * width).cast("string"), F.lit("–"),
                 ((F.col("bin") + 1) * width).cast("string"), F.lit("th percentile")).alias("bin_label"))


def sample_rows(df: DataFrame, groups: list[str], ids: list[str], size: int,
                seed: int = SEED) -> DataFrame:
    """At most ``size`` rows per group without replacement, repeatable.

    Order is a digest of seed and key.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in [*groups, *ids]]))
    return first_rows(df.withColumn("_digest", digest), groups, ["_digest", *ids], size).drop("_digest")


def histogram(metrics: DataFrame, metric: str, bins: int = HISTOGRAM_BINS,
              keys: list[str] = K) -> DataFrame:
    """Equal-width bins on [min, max], last bin closed, empty bins reported."""
    use = metrics.where(F.col(metric).isNotNull()).select(*keys, metric)
    spans = use.groupBy(*keys).agg(F.min(metric).alias("_lo"), F.max(metric).alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    spans = spans.select(*keys, F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                         F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    place = F.least(F.floor((F.col(metric) - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))),
                    F.lit(bins - 1).cast("long"))
    counts = use.join(spans, keys).groupBy(*keys, place.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    grid = spans.select(*keys, "_lo", "_hi", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
    step = (F.col("_hi") - F.col("_lo")) / bins
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("_lo") + step * F.col("bin")).alias("bin_start"),
        (F.col("_lo") + step * (F.col("bin") + 1)).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"))


def percentile_boundaries(metrics: DataFrame, metric: str, keys: list[str] = K) -> DataFrame:
    """The 5, 10, ..., 95 percentiles."""
    return group_quantiles(metrics, keys, metric, {f"p{p:02d}": p / 100 for p in range(5, 100, 5)})


def quartile_exemplars(df: DataFrame, metric: str, ids: list[str], groups: list[str] = K,
                       per_quartile: int = QUARTILE_EXEMPLARS) -> DataFrame:
    """Four rank chunks, per chunk up to ten rows at evenly spaced ranks."""
    use = df.where(F.col(metric).isNotNull()).select(*groups, *ids, metric)
    chunk, place, size = chunk_of(F.col("rn"), F.col("n"), 4)
    placed = ranked(use, groups, [metric, *ids]).select(
        *groups, *ids, metric, (chunk + 1).alias("quartile"), place.alias("_i"),
        size.alias("quartile_count"))
    spans = placed.groupBy(*groups, "quartile").agg(
        F.min(metric).alias("quartile_min"), F.max(metric).alias("quartile_max"))
    last, steps = F.col("quartile_count") - 1, per_quartile - 1
    # The j-th pick is rank floor(j * last / steps); a rank is picked when its j exists.
    j = F.ceil(F.col("_i") * steps / F.greatest(last, F.lit(1)))
    picked = (F.col("quartile_count") <= per_quartile) | (
        F.floor(j * last / steps) == F.col("_i"))
    return placed.where(picked).join(spans, [*groups, "quartile"]).select(
        *groups, *ids, metric, "quartile", "quartile_count", "quartile_min", "quartile_max",
        (F.col("_i") + 1).alias("rank_in_quartile"))


def overlap_bins(rows: DataFrame, runs: DataFrame, percent: str, view: str,
                 groups: list[str] = KP, below: float | None = None) -> DataFrame:
    """Fixed 5 % bins with available and selected counts; empty bins are kept.

    ``runs`` lists the groups to report; ``below`` keeps only bins that start below it.
    """
    place = F.least(F.floor(F.coalesce(F.col(percent), F.lit(0.0)) / OVERLAP_BIN_WIDTH),
                    F.lit(OVERLAP_BINS - 1).cast("long"))
    counts = rows.groupBy(*groups, place.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    grid = runs.select(*groups).distinct().select(*groups, F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(OVERLAP_BINS - 1).cast("long"))).alias("bin"))
    out = grid.join(counts, [*groups, "bin"], "left").select(
        *groups, F.lit(view).alias("view"), "bin",
        (F.col("bin") * OVERLAP_BIN_WIDTH).alias("bin_start"),
        ((F.col("bin") + 1) * OVERLAP_BIN_WIDTH).alias("bin_end"),
        F.coalesce("_n", F.lit(0)).alias("available"),
        F.least(F.coalesce("_n", F.lit(0)), F.lit(PER_BIN)).alias("selected"))
    return out if below is None else out.where(F.col("bin_start") < below)


def restrict_to_matched(metrics: DataFrame, matched: DataFrame, pixels: DataFrame) -> DataFrame:
    """Eligibility of B5: stable-matched ids that exist in the pixel table too."""
    return metrics.join(matched.select(*OBJ).distinct(), OBJ, "left_semi").join(
        pixels.select(*OBJ).distinct(), OBJ, "left_semi")
