"""Percentile gates over object metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roispark.functions.ranking import quantile_columns, value_positions
from roispark.schema import INTENSITY_METRICS, K, OBJ, SHAPE_METRICS, Rule, validate_rules
from roispark.session import materialize
from roispark.sources.io import finite


def _long(metrics: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """One row per (group, metric, finite value)."""
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), finite(n).alias("value")) for n in names])
    return metrics.select(*keys, F.explode(cells).alias("_c")).select(*keys, "_c.*").where(
        "value IS NOT NULL")


def cutoffs(metrics: DataFrame, rules: list[Rule], keys: list[str] = K) -> DataFrame:
    """Exact percentile per channel over all finite objects, one column per rule.

    All rules share one positional pass; a channel with a third of all objects is
    spread over the range partitions of that pass.
    """
    names = [r.metric for r in rules]
    positions = value_positions(_long(metrics, names, keys), [*keys, "metric"], "value")
    share = reduce(lambda c, r: c.when(F.col("metric") == r.metric, F.lit(r.percentile / 100.0)),
                   rules[1:], F.when(F.col("metric") == rules[0].metric, F.lit(rules[0].percentile / 100.0)))
    # `share` is constant inside a (group, metric), so any row's value serves.
    cut = positions.withColumn("_p", share).groupBy(*keys, "metric").agg(
        *quantile_columns("value", {"cut": F.col("_p")}))
    return cut.groupBy(*keys).agg(*[
        F.max(F.when(F.col("metric") == n, F.col("cut"))).alias(f"cutoff_{n}") for n in names])


def apply_gate(metrics: DataFrame, rules: list[Rule], allowed: tuple[str, ...],
               keys: list[str] = K) -> DataFrame:
    """Status columns; comparison inclusive, missing values fail an enabled rule."""
    enabled = validate_rules(rules, allowed)
    out = metrics
    if enabled:
        # One row per channel; written, so that its true size decides how it is joined.
        out = out.join(materialize(cutoffs(metrics, enabled, keys)), keys, "left")
    passes = []
    for rule in rules:
        name = f"pass_{rule.metric}"
        if rule.percentile == 0:
            out = out.withColumn(name, F.lit(True))
        else:
            value, cut = finite(rule.metric), F.col(f"cutoff_{rule.metric}")
            ok = value >= cut if rule.keep == "above" else value <= cut
            out = out.withColumn(name, F.coalesce(ok, F.lit(False)))
        passes.append(F.col(name))
    return out.withColumn("pass_all_filters", reduce(lambda a, b: a & b, passes, F.lit(True)))


def missing_values(metrics: DataFrame, rules: list[Rule], keys: list[str] = K) -> DataFrame:
    """Check rows: channels where an enabled rule has no finite value at all."""
    counts = metrics.groupBy(*keys).agg(*[F.count(finite(r.metric)).alias(r.metric) for r in rules])
    cells = F.array(*[F.struct(F.lit(r.metric).alias("metric"), F.col(r.metric).alias("finite"))
                      for r in rules])
    return counts.select(*keys, F.explode(cells).alias("_c")).select(*keys, "_c.*").where("finite = 0")


def split_gate(gated: DataFrame, words: DataFrame) -> dict[str, DataFrame]:
    """Kept and removed ids, kept metrics, pixels of kept objects."""
    ids = gated.where("pass_all_filters").select(*OBJ)
    return {
        "kept_ids": ids,
        "removed_ids": gated.where("NOT pass_all_filters").select(*OBJ),
        "kept_metrics": gated.where("pass_all_filters"),
        "filtered_words": words.join(ids, OBJ, "left_semi"),
        "removed_words": words.join(ids, OBJ, "left_anti"),
    }


def two_pass_gate(metrics: DataFrame, intensity_rules: list[Rule],
                  shape_rules: list[Rule]) -> DataFrame:
    """Intensity first, then shape with percentiles over the survivors.

    The metrics do not depend on the gate and are computed once.
    """
    first = apply_gate(metrics, intensity_rules, INTENSITY_METRICS)
    survivors = first.where("pass_all_filters").select(*metrics.columns)
    second = apply_gate(survivors, shape_rules, SHAPE_METRICS)
    passed = second.select(*OBJ, F.col("pass_all_filters").alias("pass_second"))
    return (
        first.select(*OBJ, F.col("pass_all_filters").alias("pass_first"))
        .join(passed, OBJ, "left")
        .withColumn("kept", F.coalesce("pass_second", F.lit(False)))
    )
