"""Registered queries K8-K19."""

from __future__ import annotations

from pyspark.sql import functions as F

from roispark.catalog import base
from roispark.catalog.base import THRESHOLD, query
from roispark.catalog.q_objects import single_positive
from roispark.catalog.q_overlap import counts, matched_pixel_rows
from roispark.functions import bits
from roispark.operators import classes, identity, matching, metrics, overlap
from roispark.schema import K, OBJ
from roispark.sources import fixtures, io

PAIR_STAGE = [(1, 2)]


@base.shared_table("mapping")
def mapping(spark, d):
    """Cell id, marker and nucleus of every marker-versus-nucleus match."""
    return base.cells(spark, d).where("channel_b = 0").selectExpr(
        "acquisition_id", "channel_a AS channel", "cell_id", "object_a AS marker_id", "object_b AS nucleus_id")


@base.shared_table("current_pixels")
def current_pixels(spark, d):
    """Marker pixels exported by the nucleus stage; some objects were altered afterwards."""
    px = matched_pixel_rows(spark, d, "a").where("channel_b = 0").where(
        "NOT (roi % 17 = 0 AND (x + y) % 7 = 0)")
    return px.selectExpr(
        "acquisition_id", "channel_a AS channel", "roi AS object_id", "roi", "x", "y",
        "CASE WHEN roi % 19 = 0 THEN cell_id + 1 WHEN roi % 23 = 0 AND (x + y) % 2 = 0 THEN cell_id + 1 "
        "ELSE cell_id END AS cell_id")


@base.shared_table("current_words")
def current_words(spark, d):
    return bits.pack(current_pixels(spark, d), OBJ)


@base.shared_table("assignments")
def assignments(spark, d):
    return identity.resolve_identities(current_words(spark, d), current_pixels(spark, d),
                                       base.words(spark, d), mapping(spark, d), "roi")


@base.shared_table("stage_overlap")
def stage_overlap(spark, d):
    return overlap.mark_eligible(overlap.overlap_counts(current_words(spark, d), PAIR_STAGE), THRESHOLD)


@base.shared_table("audit")
def audit(spark, d):
    return identity.constraint_audit(stage_overlap(spark, d), assignments(spark, d))


@base.shared_table("free_matches")
def free_matches(spark, d):
    return matching.stable_matching(stage_overlap(spark, d).where("eligible"))


@base.shared_table("bound_matches")
def bound_matches(spark, d):
    eligible = identity.constrained_eligible(stage_overlap(spark, d), audit(spark, d))
    return matching.stable_matching(eligible.where("eligible"))


@query("k8_nuclear_assignment")
def _(spark, d):
    return identity.resolve_identities(current_words(spark, d), current_pixels(spark, d),
                                       base.words(spark, d), mapping(spark, d), "roi")


@query("k9_source_violations")
def _(spark, d):
    m = mapping(spark, d).withColumn("nucleus_id", F.expr(
        "CASE WHEN marker_id % 29 = 0 THEN nucleus_id + 1 ELSE nucleus_id END"))
    filtered = matching.matched_words(base.words(spark, d), base.cells(spark, d), "a").where(
        "channel_b = 0 AND NOT (cell_id % 31 = 0 AND y % 2 = 0)").withColumnRenamed("channel_a", "channel")
    return identity.source_violations(m, base.words(spark, d), filtered,
                                      base.areas(spark, d).where("channel = 0"))


@query("k10_context_violations")
def _(spark, d):
    acq = base.sizes(spark, d).selectExpr("acquisition_id", "'DAPI' AS nuclear_name", "256L AS width",
                                          "256L AS height", "px", "py")
    other = acq.selectExpr(
        "acquisition_id", "CASE WHEN acquisition_id % 10 = 3 THEN 'HOECHST' ELSE 'DAPI' END AS nuclear_name",
        "256L AS width", "256L + CASE WHEN acquisition_id % 8 = 2 THEN 1 ELSE 0 END AS height",
        "px * CASE WHEN acquisition_id % 6 = 1 THEN 1.001D ELSE 1.000000001D END AS px", "py")
    n = base.words(spark, d).where("channel = 0")
    moved = n.withColumn("y", F.expr("CASE WHEN object_id % 300 = 0 AND acquisition_id % 5 = 4 THEN y + 1 ELSE y END"))
    return identity.context_violations(acq, other, n, moved)


@query("k11_constraint_audit")
def _(spark, d):
    return identity.finish_audit(audit(spark, d), bound_matches(spark, d))


@query("k12_constrained_matching")
def _(spark, d):
    eligible = identity.constrained_eligible(stage_overlap(spark, d), audit(spark, d))
    found = matching.stable_matching(eligible.where("eligible"))
    return matching.match_table(found, eligible, matching.preferences(eligible.where("eligible")))


def details(spark, d):
    return identity.compare_pairs(audit(spark, d), free_matches(spark, d), bound_matches(spark, d))


@query("k13_compare_pairs")
def _(spark, d):
    return details(spark, d).select(
        "acquisition_id", "channel_a", "channel_b", "object_a", "object_b", "in_unconstrained", "in_constrained",
        "pair_category", "nuclear_identity_discordant", "a_nucleus_id", "b_nucleus_id")


@query("k13_compare_variants")
def _(spark, d):
    areas = metrics.object_areas(current_words(spark, d))
    a = areas.where("channel = 1").groupBy("acquisition_id").agg(F.count(F.lit(1)).alias("a_rois"))
    b = areas.where("channel = 2").groupBy("acquisition_id").agg(F.count(F.lit(1)).alias("b_rois"))
    rois = a.join(b, "acquisition_id").select(
        "acquisition_id", F.lit(1).cast("long").alias("channel_a"), F.lit(2).cast("long").alias("channel_b"),
        "a_rois", "b_rois")
    return identity.compare_variants(audit(spark, d), details(spark, d), rois)


@query("k13_variant_violations")
def _(spark, d):
    """The constrained table lacks some candidates, the audit others."""
    found = stage_overlap(spark, d)
    return identity.variant_violations(found, found.where("object_a % 29 <> 0"), audit(spark, d).where("object_b % 31 <> 0"))


@query("k14_unmatched_classes")
def _(spark, d):
    return single_positive(spark, d)


@query("k14_unmatched_metrics")
def _(spark, d):
    return classes.unmatched_metrics(
        single_positive(spark, d), base.pair_overlap(spark, d), base.roi_metrics(spark, d), base.sizes(spark, d),
        base.words(spark, d), base.images(spark, d), base.PAIRS, base.shared_words(spark, d))


@query("k15_class_composition")
def _(spark, d):
    return classes.class_composition(counts(spark, d))


@query("k16_headline_summary")
def _(spark, d):
    return classes.headline_summary(counts(spark, d), overlap.union_area(base.words(spark, d)),
                                    io.organoid_area(fixtures.organoids(spark, d), True), base.sizes(spark, d))


def nuclei(spark, d):
    ids = base.areas(spark, d).where("channel = 0").selectExpr("acquisition_id", "object_id AS nucleus_id")
    a = ids.where("NOT (acquisition_id % 3 = 2 AND nucleus_id % 40 = 1)")
    b = ids.where("NOT (acquisition_id % 3 <> 0 AND nucleus_id % 50 = 0)")
    m = mapping(spark, d)
    return classes.classify_nuclei(a, b, m.where("channel = 1"), m.where("channel = 2"))


@query("k17_classify_nuclei")
def _(spark, d):
    return nuclei(spark, d)


@query("k17_nuclei_class_counts")
def _(spark, d):
    return classes.nuclei_class_counts(nuclei(spark, d))


@query("k18_link_to_nuclei")
def _(spark, d):
    m = mapping(spark, d)
    # Three kinds of exports: by marker id, by preserved cell id, by cell id alone.
    current = m.selectExpr(
        "acquisition_id", "channel",
        "CASE WHEN acquisition_id % 3 = 0 THEN marker_id WHEN acquisition_id % 3 = 1 THEN -marker_id ELSE cell_id END AS object_id",
        "CASE WHEN acquisition_id % 3 = 2 THEN NULL ELSE cell_id END AS cell_id")
    return classes.link_to_nuclei(current, m)


@query("k19_matched_ids")
def _(spark, d):
    return classes.matched_ids(base.matches(spark, d))
