"""Registered queries Q1-Q5 and R1-R8."""

from __future__ import annotations

from pyspark.sql import functions as F

from roispark.catalog import base
from roispark.catalog.base import query
from roispark.operators import maskqc, registration
from roispark.sources import fixtures

GATE = 12.0
SUBSAMPLE = 100


def masks(spark, d):
    """Channel 1 has the organoid mask of its own, channel 2 the reference mask."""
    m = base.mask_words(spark, d)
    organoid = m.where("kind <> 'cell'").select("acquisition_id", F.when(
        F.col("kind") == "organoid", 1).otherwise(2).cast("long").alias("channel"), "y", "seg", "bits")
    cells = m.where("kind = 'cell'").select(
        "acquisition_id", F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("channel"),
        "y", "seg", "bits")
    reference = m.where("kind = 'reference'").select("acquisition_id", "y", "seg", "bits")
    dims = base.sizes(spark, d).select(
        "acquisition_id", F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("channel"),
        F.lit(64).cast("long").alias("height"), F.lit(64).cast("long").alias("width"))
    return organoid, cells, reference, dims


@query("q1_mask_statistics")
def _(spark, d):
    return maskqc.mask_statistics(*masks(spark, d)).drop("touches_image_border")


@query("q2_connected_components")
def _(spark, d):
    organoid, _, _, dims = masks(spark, d)
    return maskqc.component_summary(organoid, dims)


@query("q3_touches_border")
def _(spark, d):
    return maskqc.mask_statistics(*masks(spark, d)).select("acquisition_id", "channel", "touches_image_border")


@query("q4_mask_violations")
def _(spark, d):
    return maskqc.mask_violations(maskqc.mask_statistics(*masks(spark, d)))


@query("q5_max_disagreement")
def _(spark, d):
    return maskqc.max_disagreement(maskqc.mask_statistics(*masks(spark, d)))


# --- registration --------------------------------------------------------------
def noisy_anchors(spark, d):
    """Known correspondences with a deterministic error, some of them large."""
    m = fixtures.centroids_moving(spark, d).selectExpr(
        "acquisition_id", "object_id", "x * 1.002D + (object_id * 7 % 13 - 6) * 0.05D AS mx",
        "y + (object_id * 5 % 11 - 5) * 0.05D + CASE WHEN object_id % 37 = 0 THEN 15.0D ELSE 0.0D END AS my")
    f = fixtures.centroids_fixed(spark, d).selectExpr("acquisition_id", "object_id", "x AS fx", "y AS fy")
    return m.join(f, ["acquisition_id", "object_id"]).selectExpr(
        "acquisition_id", "object_id AS moving_id", "object_id AS fixed_id", "mx", "my", "fx", "fy")


@base.shared_table("noisy_anchors")
def anchors(spark, d):
    return noisy_anchors(spark, d)


@query("r1_spatial_subsample")
def _(spark, d):
    return registration.spatial_subsample(fixtures.centroids_fixed(spark, d), SUBSAMPLE)


@query("r2_gated_pairs")
def _(spark, d):
    return registration.gated_pairs(fixtures.centroids_moving(spark, d), fixtures.centroids_fixed(spark, d),
                                    GATE).select("acquisition_id", "moving_id", "fixed_id", "d2")


@query("r3_assignment")
def _(spark, d):
    pairs = registration.gated_pairs(fixtures.centroids_moving(spark, d), fixtures.centroids_fixed(spark, d), GATE)
    return registration.assign_pairs(pairs, GATE).select(
        "acquisition_id", "moving_id", "fixed_id", "d2")


@query("r3_mutual_nearest")
def _(spark, d):
    pairs = registration.gated_pairs(fixtures.centroids_moving(spark, d), fixtures.centroids_fixed(spark, d), GATE)
    return registration.mutual_nearest(pairs).select("acquisition_id", "moving_id", "fixed_id", "d2")


@query("r4_rigid_fit")
def _(spark, d):
    return registration.fit_rigid(anchors(spark, d))


@query("r5_trim_anchors")
def _(spark, d):
    a = anchors(spark, d)
    trimmed = registration.trim_anchors(registration.residuals(a, registration.fit_rigid(a)), GATE)
    return trimmed.select("acquisition_id", "moving_id", "residual_px", "cutoff_px", "keep")


@query("r6_register", 5)
def _(spark, d):
    out = registration.register(fixtures.centroids_moving(spark, d), fixtures.centroids_fixed(spark, d), GATE)
    return out["transform"].select("acquisition_id", "a", "b", "tx", "ty")


@query("r7_affine")
def _(spark, d):
    a = anchors(spark, d)
    moved = registration.residuals(a, registration.fit_rigid(a))
    affine = registration.fit_affine(moved)
    return registration.choose_model(moved, affine).join(affine, "acquisition_id")


@query("r8_anchor_table")
def _(spark, d):
    a = anchors(spark, d)
    moved = registration.residuals(a, registration.fit_rigid(a))
    table = registration.anchor_table(moved, base.sizes(spark, d))
    return table.join(registration.residual_summary(moved), "acquisition_id")
