"""The whole analysis as one lazy graph of tables for all acquisitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roispark.functions import bits
from roispark.operators import classes, gates, identity, labels, matching, metrics, overlap
from roispark.schema import OBJ, PAIR, SHAPE_METRICS, INTENSITY_METRICS, AnalysisConfig
from roispark.session import materialize
from roispark.sources import io


def gate_objects(metric_table: DataFrame, config: AnalysisConfig) -> DataFrame:
    """Ids that survive the intensity pass and, on its survivors, the shape pass."""
    kept = metric_table
    for rules, allowed in ((config.intensity_rules, INTENSITY_METRICS), (config.shape_rules, SHAPE_METRICS)):
        if rules:
            kept = gates.apply_gate(kept, rules, allowed).where("pass_all_filters").select(*metric_table.columns)
    return kept.select(*OBJ)


def match_stage(words: DataFrame, areas: DataFrame, pairs: list[tuple], threshold: float, table: DataFrame,
                images: DataFrame, sizes: DataFrame) -> dict[str, DataFrame]:
    """Overlap, eligibility, matching, the metrics of pairs and unmatched objects and the per-run tables of one stage."""
    found = materialize(overlap.mark_eligible(overlap.overlap_counts(words, pairs, areas), threshold))
    matches = materialize(matching.stable_matching(found.where("eligible")))
    cells = materialize(matching.cell_ids(matches))
    counts = matching.side_counts(areas, found, matches, pairs)
    unmatched = classes.unmatched_classes(areas, found, matches, pairs)
    regions = overlap.region_intensity(matches, words, images, pairs)
    return {
        "words": words, "pair_geometry": overlap.pair_geometry(matches, found, table, sizes), "pair_intensity": regions,
        "matched_intensity": overlap.matched_intensity(matches, found, regions, areas),
        "unmatched_metrics": classes.unmatched_metrics(unmatched, found, table, sizes, words, images, pairs),
        "overlap": found, "matches": matches, "cell_ids": cells, "side_counts": counts,
        "matching": matching.match_table(matches, found, matching.preferences(found.where("eligible"))),
        "below_threshold": overlap.below_threshold(areas, found, pairs),
        "unmatched_classes": unmatched,
        "class_composition": classes.class_composition(counts),
        "filtering_stage_counts": matching.stage_counts(counts, threshold),
        "status": overlap.pair_status(areas, found, pairs),
    }


CHECK = ["acquisition_id", "channel", "check", "detail"]


def input_checks(words: DataFrame, table: DataFrame, config: AnalysisConfig, dims: DataFrame | None) -> DataFrame:
    """What makes an acquisition unusable: pixels outside of the image, rules without any finite value."""
    found = words.sparkSession.createDataFrame([], words.select("acquisition_id", "channel").schema).select(
        "*", F.lit("").alias("check"), F.lit("").alias("detail"))
    if dims is not None:
        outside = labels.out_of_bounds(words, dims).where("out_of_bounds_px > 0")
        found = found.unionByName(outside.select(
            "acquisition_id", "channel", F.lit("pixels_out_of_bounds").alias("check"), F.col("out_of_bounds_px").cast("string").alias("detail")))
    rules = list({r.metric: r for r in [*config.intensity_rules, *config.shape_rules]}.values())
    if rules:
        gaps = gates.missing_values(table.where(F.col("channel") != F.lit(config.nuclear_channel)), rules)
        found = found.unionByName(gaps.select(
            "acquisition_id", "channel", F.lit("rule_without_values").alias("check"), F.col("metric").alias("detail")))
    return found


def analyze(pixels: DataFrame, images: DataFrame, organoids: DataFrame, sizes: DataFrame,
            config: AnalysisConfig, dims: DataFrame | None = None) -> dict[str, DataFrame]:
    """From ROI pixels to classes and densities, all channels and acquisitions together.

    Acquisitions that fail an input check are left out of everything but ``words``, ``metrics`` and ``checks``; with
    ``dims(acquisition_id, width, height)`` pixels outside of the image are one of them.  ``checks`` also lists what the
    identity stage finds wrong with its own sources (K9) and candidates (K13); it is empty for a sound run.

    Written once, because several branches read them: the bit-row words, the
    metrics, and per stage overlap, matches and cell ids.  Everything else is lazy.
    """
    words = materialize(io.read_roi_words(pixels))
    table = materialize(metrics.roi_metrics(words, images, sizes))
    markers = sorted({c for p in config.marker_pairs for c in p})
    refused = materialize(input_checks(words, table, config, dims))
    every_word, every_metric = words, table
    words, table = (df.join(refused.select("acquisition_id").distinct(), "acquisition_id", "left_anti") for df in (words, table))
    gated = materialize(gate_objects(table, config))
    # The nuclear channel is the identity reference and is not gated.
    nuclear = F.col("channel") == F.lit(config.nuclear_channel)
    kept = materialize(words.where(nuclear).unionByName(words.where(~nuclear).join(gated, OBJ, "left_semi")))
    areas = materialize(metrics.object_areas(kept))
    area_sum = io.organoid_area(organoids, False)

    nuclear_pairs = [(m, config.nuclear_channel) for m in markers]
    first = match_stage(kept, areas, nuclear_pairs, config.marker_nuclear_threshold, table, images, sizes)
    first["summary"] = matching.run_summary(first["side_counts"], area_sum, sizes)

    mapping = materialize(first["cell_ids"].select(
        "acquisition_id", F.col("channel_a").alias("channel"), "cell_id", F.col("object_a").alias("marker_id"),
        F.col("object_b").alias("nucleus_id")))
    current = materialize(kept.join(mapping.select(
        "acquisition_id", "channel", F.col("marker_id").alias("object_id"), "cell_id"), OBJ))
    pair_words = current.drop("cell_id")
    pair_areas = metrics.object_areas(pair_words)
    free = match_stage(pair_words, pair_areas, config.marker_pairs, config.marker_marker_threshold, table, images, sizes)
    free["summary"] = matching.run_summary(free["side_counts"], area_sum, sizes)

    ids = current.select(*OBJ, F.col("object_id").alias("roi"), "cell_id")
    assigned = materialize(identity.resolve_identities(pair_words, ids, kept, mapping, "roi"))
    audit = materialize(identity.constraint_audit(free["overlap"], assigned))
    eligible = materialize(identity.constrained_eligible(free["overlap"], audit))
    bound = materialize(matching.stable_matching(eligible.where("eligible")))
    details = identity.compare_pairs(audit, free["matches"], bound)
    counts = matching.side_counts(pair_areas, eligible, bound, config.marker_pairs)
    roi_counts = reduce(lambda a, b: a.join(b, ["acquisition_id", "channel_a", "channel_b"]), [
        overlap.objects_of_side(pair_areas, config.marker_pairs, s).groupBy(
            "acquisition_id", "channel_a", "channel_b").agg(F.count(F.lit(1)).alias(f"{s}_rois")) for s in "ab"])
    constrained = {
        "assignments": assigned, "audit": identity.finish_audit(audit, bound), "matches": bound,
        "matching": matching.match_table(bound, eligible, matching.preferences(eligible.where("eligible"))),
        "summary": matching.run_summary(counts, area_sum, sizes, constrained=True),
        "comparison_pairs": details,
        "comparison": identity.compare_variants(audit, details, roi_counts),
    }
    sources = identity.source_violations(mapping, kept, current, kept.where(nuclear).select("acquisition_id", "object_id").distinct())
    differing = identity.variant_violations(free["overlap"], eligible, audit)
    checks = refused.unionByName(sources.select(*CHECK)).unionByName(differing.select(
        "acquisition_id", F.col("channel_a").alias("channel"), "check", F.concat_ws(":", "object_a", "object_b").alias("detail")))
    out = {"checks": checks, "words": every_word, "metrics": every_metric, "gated_words": kept, "areas": areas,
           "positive_areas": overlap.union_area(bits.merge(kept, OBJ), io.organoid_area(organoids, True))}
    for prefix, tables in (("nuclear", first), ("marker", free), ("constrained", constrained)):
        out.update({f"{prefix}_{name}": df for name, df in tables.items()})
    return out


def run_tables(tables: dict[str, DataFrame], pairs: list[tuple], stage: str = "marker") -> dict[str, DataFrame]:
    """The tables of one matching stage of ``analyze`` under the names of a run bundle.

    Pixel tables are bit-row words.  The marker stage carries the identity audit and the assignments of both sides.
    """
    def of(name):
        return tables[f"{stage}_{name}"]

    eligible = of("overlap").where("eligible")
    ranks = materialize(matching.preferences(eligible))
    out = {
        "overlap": of("overlap"), "eligible_pairs": eligible, "matching": of("matching"), "positive_objects": of("matching"),
        "cell_id_mapping": of("cell_ids"), "unmatched": of("below_threshold"), "summary": of("summary"),
        "filtering_stage_counts": of("filtering_stage_counts"),
    }
    for s in "ab":
        out[f"object_{s}_pixels"] = overlap.side(of("words"), pairs, s)
        out[f"{s}_preferences"] = ranks.select(*PAIR, "a_percent_inside_b", f"{s}_rank")
        out[f"filtered_object_{s}_pixels"] = matching.matched_words(of("words"), of("cell_ids"), s)
    if stage == "marker":
        out["nuclear_constraint_audit"] = tables["constrained_audit"]
        for s in "ab":
            out[f"object_{s}_nuclear_assignments"] = overlap.side(tables["constrained_assignments"], pairs, s)
    return out
