"""Registered queries S1-S5, L1-L13, M1-M11, G2-G5, B1-B8."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from roispark.catalog import base
from roispark.catalog.base import PAIRS, THRESHOLD, query
from roispark.functions import bits
from roispark.operators import bins, classes, gates, labels, metrics, overlap
from roispark.schema import INTENSITY_METRICS, K, KP, OBJ, SHAPE_METRICS, Rule
from roispark.sources import fixtures, io

INTENSITY_RULES = [Rule("mean_intensity", 20, "above"), Rule("intensity_sd", 95, "below"),
                   Rule("max_intensity", 0, "below")]
SHAPE_RULES = [Rule("area_px", 10, "above"), Rule("circularity", 15, "above"),
               Rule("eccentricity", 90, "below")]


# --- sources -------------------------------------------------------------------
@query("s1_read_roi_pixels")
def _(spark, d):
    px = fixtures.roi_pixels(spark, d).withColumnRenamed("object_id", "roi").withColumn(
        "cell_id", F.col("roi") + 7)
    doubled = px.unionByName(px.where("roi % 5 = 0"))
    return io.read_roi_pixels(doubled)


@query("s2_read_organoids")
def _(spark, d):
    return io.read_objects(fixtures.organoids(spark, d), ["acquisition_id"])


@query("s3_read_centroids")
def _(spark, d):
    c = fixtures.roi_pixels(spark, d).groupBy(*OBJ).agg(
        F.when(F.col("object_id") % 10 != 0, F.avg("x")).otherwise(F.lit(float("nan"))).alias("Location_CenterMass_X"),
        F.avg("y").alias("Location_Center_Y"))
    return io.read_centroids(c)


@query("s4_organoid_area")
def _(spark, d):
    o = fixtures.organoids(spark, d)
    every = io.organoid_area(o, False).select(
        "acquisition_id", F.col("organoid_area_px").alias("all_area_px"),
        F.col("organoid_count").alias("all_count"))
    return every.join(io.organoid_area(o, True), "acquisition_id", "full_outer")


@query("s5_load_run")
def _(spark, d):
    from roispark.session import scratch_dir
    import uuid
    path = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"
    io.save_run({"overlap": base.pair_overlap(spark, d), "matching": base.matches(spark, d)},
                path, ["channel_a", "channel_b"])
    run = io.load_run(spark, path, ("overlap", "matching"), "channel_a = 1 AND channel_b = 0")
    sums = [df.groupBy("acquisition_id").agg(F.count(F.lit(1)).alias("rows"),
                                             F.sum("object_a").alias("sum_object_a"))
            .withColumn("table_name", F.lit(n)) for n, df in run.items()]
    return sums[0].unionByName(sums[1])


@query("s6_run_bundle")
def _(spark, d):
    from roispark.session import scratch_dir
    import uuid
    found = base.pair_overlap(spark, d)
    path = f"{scratch_dir(spark)}/bundle-{uuid.uuid4().hex}"
    manifest = io.save_bundle({
        "overlap": found, "eligible_pairs": found.where("eligible"), "positive_objects": base.matches(spark, d),
        "cell_id_mapping": base.cells(spark, d)}, path, ["channel_a", "channel_b"], {"threshold": THRESHOLD})
    run = io.load_bundle(spark, path, ("overlap", "eligible_pairs", "positive_objects", "cell_id_mapping"), "channel_b = 0")
    sums = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows_of_nuclear_pairs"),
                   F.sum("object_b").alias("sum_object_b")) for n, df in run.items()]
    return reduce(lambda a, b: a.unionByName(b), sums).join(manifest.select("table_name", "rows", "metadata"), "table_name")


# --- labels --------------------------------------------------------------------
@base.shared_table("levels")
def ranked_levels(spark, d):
    return labels.levels(fixtures.label_pixels(spark, d))


@base.shared_table("label_summary")
def summary(spark, d):
    return labels.image_summary(fixtures.label_pixels(spark, d))


@base.shared_table("label_words")
def label_words(spark, d):
    return bits.pack(fixtures.label_pixels(spark, d).where("level <> 0"), [*K, "level"])


def measured(spark, d):
    """Measurements of the segmentation tool: some ROIs differ, some are missing or extra."""
    s = summary(spark, d).where("level % 11 <> 0").select(
        *K, F.when(F.col("level") % 13 == 0, F.col("roi") + 100000).otherwise(F.col("roi")).alias("roi"),
        (F.col("pixel_count") + F.when(F.col("level") % 7 == 0, 1).otherwise(0)).alias("area"),
        "min_x", (F.col("max_x") + F.when(F.col("level") % 3 == 0, 0).otherwise(1)).alias("max_x"),
        "min_y", (F.col("max_y") + 1).alias("max_y"),
        (F.col("center_x") + F.when(F.col("level") % 5 == 0, 0.25).otherwise(0.0)).alias("center_x"),
        "center_y")
    return s


@query("l1_relabel")
def _(spark, d):
    return labels.relabel(fixtures.label_pixels(spark, d))


@query("l2_level_spacing")
def _(spark, d):
    return labels.level_spacing(ranked_levels(spark, d))


@query("l3_label_summary")
def _(spark, d):
    return labels.image_summary(fixtures.label_pixels(spark, d))


@query("l4_label_to_pixels")
def _(spark, d):
    px = fixtures.label_pixels(spark, d)
    both = px.unionByName(px.select(*K, (F.col("x") + 1000).alias("x"), "y", F.lit(0).cast("long").alias("level")))
    return labels.relabel(both).select(*K, "roi", "x", "y")


@query("l5_verify_labels")
def _(spark, d):
    return labels.verify_labels(measured(spark, d), summary(spark, d))


@query("l6_verify_summary")
def _(spark, d):
    return labels.verify_summary(labels.verify_labels(measured(spark, d), summary(spark, d)))


@query("l7_roi_density", 9)
def _(spark, d):
    return labels.roi_density(summary(spark, d), io.organoid_area(fixtures.organoids(spark, d), False))


@query("l8_label_boundary")
def _(spark, d):
    inner = labels.label_boundary(label_words(spark, d), [*K, "level"], (249, 247))
    outer = labels.label_boundary(label_words(spark, d), [*K, "level"])
    return bits.unpack(inner.withColumn("edge_rule", F.lit("edge_is_inside")), [*K, "level", "edge_rule"]).unionByName(
        bits.unpack(outer.withColumn("edge_rule", F.lit("edge_is_boundary")), [*K, "level", "edge_rule"]))


@query("l9_max_project")
def _(spark, d):
    flat = labels.max_project(fixtures.stack_rows(spark, d))
    return flat.select(*K, "y", "seg", F.posexplode("pixel_values").alias("i", "value")).select(
        *K, (F.col("seg") * 32 + F.col("i")).alias("x"), "y", F.col("value").cast("double").alias("value"))


@query("l10_usable_z")
def _(spark, d):
    return labels.usable_z(fixtures.stack_rows(spark, d))


@query("l11_trim_extent")
def _(spark, d):
    return labels.trim_extent(fixtures.stack_rows(spark, d), 64, 64, slab=24)


@query("l12_downsample")
def _(spark, d):
    flat = labels.max_project(fixtures.stack_rows(spark, d))
    return labels.downsample(flat, 5, 64, 64)


@query("l13_out_of_bounds")
def _(spark, d):
    dims = base.sizes(spark, d).select("acquisition_id", F.lit(200).cast("long").alias("width"),
                                       (180 + F.col("acquisition_id") % 50).alias("height"))
    return labels.out_of_bounds(base.words(spark, d), dims)


# --- metrics -------------------------------------------------------------------
@query("m1_intensity")
def _(spark, d):
    return metrics.intensity_stats(base.words(spark, d), base.images(spark, d), OBJ).select(
        *OBJ, *INTENSITY_METRICS)


@query("m2_intensity_extended")
def _(spark, d):
    return metrics.intensity_stats(base.words(spark, d), base.images(spark, d), OBJ).select(
        *OBJ, "mean_intensity", "median_intensity", "intensity_sd", "min_intensity", "p05_intensity",
        "p95_intensity", "max_intensity")


def shape(spark, d, *cols):
    return metrics.shape_metrics(base.words(spark, d), base.sizes(spark, d)).select(*OBJ, *cols)


@query("m3_area")
def _(spark, d):
    return shape(spark, d, "area_px", "area_um2")


@query("m4_bounding_box")
def _(spark, d):
    return shape(spark, d, "min_x", "max_x", "min_y", "max_y", "center_x", "center_y", "extent")


@query("m5_perimeter", perimeter_um=9)
def _(spark, d):
    return shape(spark, d, "perimeter_um")


@query("m6_convex_hull")
def _(spark, d):
    return shape(spark, d, "convex_hull_area_um2")


@query("m7_solidity")
def _(spark, d):
    return shape(spark, d, "solidity")


@query("m8_circularity")
def _(spark, d):
    return shape(spark, d, "circularity")


@query("m9_second_moments")
def _(spark, d):
    return shape(spark, d, "eccentricity", "major_axis_um", "minor_axis_um", "aspect_ratio")


@query("m10_equivalent_diameter")
def _(spark, d):
    return shape(spark, d, "equivalent_diameter_um")


@query("m11_roi_metrics", perimeter_um=9)
def _(spark, d):
    return metrics.roi_metrics(base.words(spark, d), base.images(spark, d), base.sizes(spark, d)).select(
        *OBJ, *SHAPE_METRICS, *INTENSITY_METRICS, "min_x", "max_x", "min_y", "max_y", "center_x", "center_y")


# --- gates ---------------------------------------------------------------------
@query("g2_cutoffs")
def _(spark, d):
    return gates.cutoffs(base.roi_metrics(spark, d), [INTENSITY_RULES[0], INTENSITY_RULES[1], *SHAPE_RULES])


@query("g3_gate_status")
def _(spark, d):
    return gates.apply_gate(base.roi_metrics(spark, d), INTENSITY_RULES, INTENSITY_METRICS).select(
        *OBJ, "pass_mean_intensity", "pass_intensity_sd", "pass_max_intensity", "pass_all_filters")


@query("g4_split_gate")
def _(spark, d):
    gated = gates.apply_gate(base.roi_metrics(spark, d), INTENSITY_RULES, INTENSITY_METRICS)
    parts = gates.split_gate(gated, base.words(spark, d))
    kept = bits.unpack(parts["filtered_words"], OBJ).withColumn("status", F.lit("kept"))
    gone = bits.unpack(parts["removed_words"], OBJ).withColumn("status", F.lit("removed"))
    return kept.unionByName(gone)


@query("g5_two_pass_gate")
def _(spark, d):
    return gates.two_pass_gate(base.roi_metrics(spark, d), INTENSITY_RULES, SHAPE_RULES).select(
        *OBJ, "pass_first", "pass_second", "kept")


# --- bins ----------------------------------------------------------------------
@query("b1_percentile_bins")
def _(spark, d):
    return bins.rank_bins(base.roi_metrics(spark, d), "area_px")


@query("b2_bin_sample")
def _(spark, d):
    return bins.sample_rows(bins.rank_bins(base.roi_metrics(spark, d), "area_px"), [*K, "bin"],
                            ["object_id"], bins.PER_BIN)


@query("b3_histogram")
def _(spark, d):
    return bins.histogram(base.roi_metrics(spark, d), "area_px")


@query("b4_percentile_boundaries")
def _(spark, d):
    return bins.percentile_boundaries(base.roi_metrics(spark, d), "mean_intensity")


@query("b5_quartile_exemplars")
def _(spark, d):
    matched = classes.matched_ids(base.matches(spark, d))
    eligible = bins.restrict_to_matched(base.roi_metrics(spark, d), matched, base.words(spark, d))
    return bins.quartile_exemplars(eligible, "mean_intensity", ["object_id"])


@query("b6_overlap_bins")
def _(spark, d):
    o = base.pair_overlap(spark, d)
    matched = base.matches(spark, d).join(o.select(*KP, "object_a", "object_b", "a_percent_inside_b"),
                                          [*KP, "object_a", "object_b"])
    low = overlap.below_threshold(base.areas(spark, d), o, PAIRS).where("best_object_b IS NOT NULL")
    above = bins.overlap_bins(matched, o, "a_percent_inside_b", "Above threshold")
    below = bins.overlap_bins(low, o, "best_a_percent_inside_b", "Below threshold", below=THRESHOLD * 100)
    return above.unionByName(below)


def single_positive(spark, d):
    return classes.unmatched_classes(base.areas(spark, d), base.pair_overlap(spark, d),
                                     base.matches(spark, d), PAIRS)


@query("b7_unmatched_bins")
def _(spark, d):
    rows = single_positive(spark, d)
    return bins.overlap_bins(rows, rows, "focal_overlap_percent", "Unmatched", [*KP, "side"])


@query("b8_pair_sample")
def _(spark, d):
    return bins.sample_rows(base.matches(spark, d).select(*KP, "object_a", "object_b"), KP,
                            ["object_a", "object_b"], bins.PAIR_SAMPLE)
