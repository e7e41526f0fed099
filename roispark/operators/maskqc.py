"""Mask quality control (Q1-Q5) on bit-row words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roispark.functions import bits
from roispark.operators.graph import mask_components
from roispark.schema import K


def mask_statistics(organoid: DataFrame, cells: DataFrame, reference: DataFrame,
                    dims: DataFrame) -> DataFrame:
    """Q1/Q3: agreement of organoid, cell and reference masks per channel.

    ``organoid`` and ``cells`` are keyed by ``K``, the reference by acquisition and
    joined to every channel listed in ``dims (K, height, width)``.
    """
    zero = F.lit(0).cast("long")

    def tagged(df, tag):
        return df.select(*K, "y", "seg", *[
            (F.col("bits") if t == tag else zero).alias(t) for t in ("o", "c", "r")])

    ref = reference.join(dims.select(*K), "acquisition_id")
    merged = tagged(organoid, "o").unionByName(tagged(cells, "c")).unionByName(tagged(ref, "r")).groupBy(
        *K, "y", "seg").agg(*[F.bit_or(t).alias(t) for t in ("o", "c", "r")])
    o, c, r = F.col("o"), F.col("c"), F.col("r")

    def minus(a, b):
        return a.bitwiseAND(F.bitwise_not(b))

    def total(word, name):
        return F.sum(bits.size(word)).alias(name)

    last = bits.SEGMENT - 1
    edge = F.when((o != 0) & ((F.col("y") == 0) | (F.col("y") == F.col("height") - 1)
                              | ((F.col("seg") == 0) & (o.bitwiseAND(F.lit(1)) != 0))
                              | ((F.col("seg") == F.floor((F.col("width") - 1) / bits.SEGMENT))
                                 & (F.expr(f"getbit(o, cast((width - 1) & {last} as int))") == 1))), True
                  ).otherwise(False)
    sums = merged.join(dims, K).groupBy(*K).agg(
        total(o, "organoid_mask_area_px"), total(c, "segmented_cell_px"),
        total(minus(c, o), "cell_px_outside_organoid"), total(r, "reference_mask_area_px"),
        total(o.bitwiseXOR(r), "organoid_mask_disagreement_px"),
        total(minus(o, r), "organoid_mask_px_outside_reference"),
        total(minus(r, o), "reference_mask_px_missing_from_organoid"),
        total(minus(c, r), "cell_px_outside_reference"),
        F.bool_or(edge).alias("touches_image_border"))
    out = dims.join(sums, K, "left")
    fields = [f for f in sums.columns if f not in (*K, "touches_image_border")]
    out = out.select(*K, "height", "width", *[F.coalesce(f, zero).alias(f) for f in fields],
                     F.coalesce("touches_image_border", F.lit(False)).alias("touches_image_border"))

    def pct(n, d):
        return F.when(F.col(d) > 0, 100.0 * F.col(n) / F.col(d)).otherwise(F.lit(0.0))

    return out.select(
        "*", pct("cell_px_outside_organoid", "segmented_cell_px").alias("cell_px_outside_organoid_percent"),
        pct("organoid_mask_disagreement_px", "reference_mask_area_px").alias(
            "organoid_mask_disagreement_percent_of_reference"),
        pct("cell_px_outside_reference", "segmented_cell_px").alias("cell_px_outside_reference_percent"))


def component_summary(organoid: DataFrame, dims: DataFrame) -> DataFrame:
    """Q2: number of 4-connected components and the largest one's area (0 when empty)."""
    parts = mask_components(organoid, K).groupBy(*K).agg(
        F.count(F.lit(1)).alias("connected_components"), F.max("area_px").alias("largest_component_area_px"))
    return dims.select(*K).join(parts, K, "left").select(
        *K, F.coalesce("connected_components", F.lit(0)).alias("connected_components"),
        F.coalesce("largest_component_area_px", F.lit(0)).alias("largest_component_area_px"))


def mask_violations(stats: DataFrame) -> DataFrame:
    """Q4: masks must be non-empty, equal to the reference and contain every cell."""
    rules = {
        "reference_mask_empty": F.col("reference_mask_area_px") == 0,
        "organoid_mask_empty": F.col("organoid_mask_area_px") == 0,
        "organoid_differs_from_reference": F.col("organoid_mask_disagreement_px") > 0,
        "cells_outside_organoid": F.col("cell_px_outside_organoid") > 0,
    }
    found = F.filter(F.array(*[F.when(bad, F.lit(n)) for n, bad in rules.items()]), lambda v: v.isNotNull())
    return stats.select(*K, F.explode(found).alias("check"))


def max_disagreement(stats: DataFrame) -> DataFrame:
    """Q5: the largest disagreement over the channels of an acquisition must be 0."""
    return stats.groupBy("acquisition_id").agg(
        F.max("organoid_mask_disagreement_px").alias("max_disagreement_px"),
        (F.max("organoid_mask_disagreement_px") == 0).alias("masks_agree"))
