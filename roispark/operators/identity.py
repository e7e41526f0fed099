"""Nuclear identity of marker objects and the nucleus-constrained matching.

A current object is the source object with exactly the same pixels; ids only
support that.  Candidates come from an equi-join on a fingerprint of the bit-row
words and are confirmed word by word, so a hash collision never links two sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roispark.functions import bits
from roispark.schema import K, KP, OBJ, PAIR
from roispark.session import materialize

# Statuses and exclusion reasons.
RESOLVED = "resolved"
MISSING = "missing_coordinate_identity"
AMBIGUOUS = "ambiguous_coordinate_identity"
MISMATCH = "identifier_coordinate_mismatch"
MANY_ROI = "multiple_ROI_values"
MANY_CELL = "multiple_CellID_values"
ABSENT = "missing_current_object"
BELOW = "below_directional_overlap_threshold"
DIFFERENT = "different_canonical_nuclear_objectids"
NOT_SELECTED = "not_selected_by_constrained_stable_matching"


def fingerprints(words: DataFrame, keys: list[str]) -> DataFrame:
    """Order-independent digest of each pixel set; combines map-side."""
    return words.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_words"), F.sum(bits.size(F.col("bits"))).alias("_px"),
        F.bit_xor(F.xxhash64("y", "seg", "bits")).alias("_xor"),
        F.bit_xor(F.xxhash64(F.lit(1), "bits", "y", "seg")).alias("_xor2"))


def equal_sets(current: DataFrame, source: DataFrame, within: list[str]) -> DataFrame:
    """Per current set with an identical source set: ``(within, current_id, source_id, copies)``.

    ``current``/``source`` are words keyed by ``within`` + ``current_id``/``source_id``.
    Copies among the sources are reduced to their lowest id and their number before
    the join, so many equal sets never form pairs; the match is then confirmed
    against that one source, word by word.
    """
    digest = ["_words", "_px", "_xor", "_xor2"]
    classes = fingerprints(source, [*within, "source_id"]).groupBy(*within, *digest).agg(
        F.min("source_id").alias("source_id"), F.count(F.lit(1)).alias("copies"))
    cand = fingerprints(current, [*within, "current_id"]).join(classes, [*within, *digest]).select(
        *within, "current_id", "source_id", "copies", "_words")
    at = ["y", "seg", "bits"]
    agree = (
        cand.join(current.select(*within, "current_id", *at), [*within, "current_id"])
        .join(source.select(*within, "source_id", *at), [*within, "source_id", *at])
        .groupBy(*within, "current_id", "source_id", "copies", "_words")
        .agg(F.count(F.lit(1)).alias("_agree"))
    )
    return agree.where("_agree = _words").select(*within, "current_id", "source_id", "copies")


def resolve_identities(current_words: DataFrame, current_ids: DataFrame, source_words: DataFrame,
                       mapping: DataFrame, current_id_column: str) -> DataFrame:
    """K8: source object and nucleus of every current marker object.

    ``current_ids``: ``OBJ`` plus optional ``roi`` / ``cell_id`` per pixel row.
    ``mapping``: ``(acquisition_id, channel, cell_id, marker_id, nucleus_id)`` of the
    marker-versus-nucleus run; only its marker objects are candidates.
    """
    have = {c for c in ("roi", "cell_id") if c in current_ids.columns}
    none = F.lit(None).cast("long")

    def extent(c):
        return [F.min(c).alias(f"_min_{c}"), F.max(c).alias(f"_max_{c}")] if c in have else [
            F.max(none).alias(f"_min_{c}"), F.max(none).alias(f"_max_{c}")]

    ids = current_ids.groupBy(*OBJ).agg(*extent("roi"), *extent("cell_id"))
    for c in ("roi", "cell_id"):
        one = F.col(f"_min_{c}") == F.col(f"_max_{c}")
        ids = ids.withColumn(f"input_{c}", F.when(one, F.col(f"_min_{c}"))).withColumn(
            f"_many_{c}", F.coalesce(~one, F.lit(False)))
    ids = ids.withColumn("_roi_key", F.coalesce(
        "input_roi", F.col("object_id") if current_id_column == "roi" else none))
    ids = ids.withColumn("_cell_key", F.coalesce(
        "input_cell_id", F.col("object_id") if current_id_column == "cell_id" else none))

    markers = mapping.select(*K, F.col("marker_id").alias("source_id"))
    # Read twice, for the fingerprints and for the proof: written, so that the words meet the markers once.
    candidates = materialize(
        source_words.withColumnRenamed("object_id", "source_id").join(markers, [*K, "source_id"], "left_semi"))
    sets = equal_sets(
        current_words.withColumnRenamed("object_id", "current_id"), candidates, K,
    ).select(*K, F.col("current_id").alias("object_id"), F.col("copies").alias("_sets"),
             F.col("source_id").alias("_source"))
    by_roi = mapping.select(*K, F.col("marker_id").alias("_roi_key"), F.col("marker_id").alias("_from_roi"))
    by_cell = mapping.select(*K, F.col("cell_id").alias("_cell_key"), F.col("marker_id").alias("_from_cell"))
    out = (
        ids.join(sets, OBJ, "left").join(by_roi, [*K, "_roi_key"], "left")
        .join(by_cell, [*K, "_cell_key"], "left")
    )
    status = (
        F.when(F.col("_many_roi"), F.lit(MANY_ROI)).when(F.col("_many_cell_id"), F.lit(MANY_CELL))
        .when(F.col("_sets").isNull(), F.lit(MISSING)).when(F.col("_sets") > 1, F.lit(AMBIGUOUS))
        .when(F.coalesce(F.col("_from_roi") != F.col("_source"), F.lit(False))
              | F.coalesce(F.col("_from_cell") != F.col("_source"), F.lit(False)), F.lit(MISMATCH))
        .otherwise(F.lit(RESOLVED))
    )
    out = out.withColumn("mapping_status", status).withColumn(
        "source_marker_id", F.when(F.col("mapping_status") == RESOLVED, F.col("_source")))
    found = mapping.select(*K, F.col("marker_id").alias("source_marker_id"),
                           F.col("cell_id").alias("source_cell_id"), "nucleus_id")
    return out.join(found, [*K, "source_marker_id"], "left").select(
        *OBJ, F.lit(current_id_column).alias("input_id_column"), "input_roi", "input_cell_id",
        "source_marker_id", "source_cell_id", "nucleus_id",
        (F.col("mapping_status") == RESOLVED).alias("coordinate_verified"), "mapping_status")


def _issue(df: DataFrame, check: str, detail: Column) -> DataFrame:
    return df.select(*K, F.lit(check).alias("check"), detail.cast("string").alias("detail"))


def source_violations(mapping: DataFrame, source_words: DataFrame, filtered_words: DataFrame,
                      nuclei: DataFrame) -> DataFrame:
    """K9: everything that makes a marker-versus-nucleus run unusable as identity source.

    ``filtered_words`` are keyed by ``K`` + ``cell_id``, ``nuclei`` lists the nucleus ids.
    """
    parts = []
    for c in ("cell_id", "marker_id", "nucleus_id"):
        doubled = mapping.groupBy(*K, c).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        parts.append(_issue(doubled, f"{c}_not_one_to_one", F.col(c)))
    at = ["y", "seg", "bits"]
    src = source_words.select(*K, F.col("object_id").alias("marker_id"), *at).join(
        mapping.select(*K, "marker_id", "cell_id"), [*K, "marker_id"])
    flt = filtered_words.select(*K, "cell_id", *at)
    has_source, has_filtered = src.select(*K, "cell_id").distinct(), flt.select(*K, "cell_id").distinct()
    for have in (has_source, has_filtered):
        missing = mapping.select(*K, "cell_id").join(have, [*K, "cell_id"], "left_anti")
        parts.append(_issue(missing, "mapping_row_lacks_pixels", F.col("cell_id")))
    key = [*K, "cell_id", *at]
    odd = src.select(*key).join(flt, key, "left_anti").unionByName(
        flt.join(mapping.select(*K, "cell_id"), [*K, "cell_id"], "left_semi").join(
            src.select(*key), key, "left_anti"))
    parts.append(_issue(odd.select(*K, "cell_id").distinct(), "filtered_pixels_differ", F.col("cell_id")))
    lost = mapping.join(nuclei.select("acquisition_id", F.col("object_id").alias("nucleus_id")),
                        ["acquisition_id", "nucleus_id"], "left_anti")
    parts.append(_issue(lost, "nucleus_absent", F.col("nucleus_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def context_violations(context_a: DataFrame, context_b: DataFrame, nuclei_a: DataFrame,
                       nuclei_b: DataFrame, rel: float = 1e-5, absolute: float = 1e-8) -> DataFrame:
    """Both identity sources share nucleus name, canvas, calibration and nuclei.

    Contexts: ``(acquisition_id, nuclear_name, width, height, px, py)``; nuclei: words
    keyed by acquisition and object.  An empty result means compatible.
    """
    b = context_b.select("acquisition_id", *[F.col(c).alias(f"_{c}") for c in (
        "nuclear_name", "width", "height", "px", "py")])
    both = context_a.join(b, "acquisition_id", "full_outer")

    def near(c):
        return F.abs(F.col(c) - F.col(f"_{c}")) <= absolute + rel * F.abs(F.col(f"_{c}"))

    def same(c):
        return F.col(c) == F.col(f"_{c}")

    rules = {"nuclear_name": same("nuclear_name"), "canvas": same("width") & same("height"),
             "pixel_size_x": near("px"), "pixel_size_y": near("py")}
    found = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]),
                     lambda v: v.isNotNull())
    scalar = both.select("acquisition_id", F.explode(found).alias("check"))
    cols = ["acquisition_id", "object_id", "y", "seg", "bits"]
    na, nb = nuclei_a.select(*cols), nuclei_b.select(*cols)
    differ = na.join(nb, cols, "left_anti").unionByName(nb.join(na, cols, "left_anti"))
    return scalar.unionByName(differ.select("acquisition_id").distinct().withColumn(
        "check", F.lit("nuclear_segmentation")))


def constraint_audit(overlap: DataFrame, assignments: DataFrame) -> DataFrame:
    """Per overlap pair the identity of both sides and why it is (not) eligible."""
    out = overlap.select(*PAIR, "a_percent_inside_b", "b_percent_inside_a", "eligible")
    for s in ("a", "b"):
        named = assignments.select(
            "acquisition_id", F.col("channel").alias(f"channel_{s}"), F.col("object_id").alias(f"object_{s}"),
            F.col("source_marker_id").alias(f"{s}_source_marker_id"),
            F.col("source_cell_id").alias(f"{s}_source_cell_id"),
            F.col("nucleus_id").alias(f"{s}_nucleus_id"),
            F.col("mapping_status").alias(f"{s}_mapping_status"),
            F.col("coordinate_verified").alias(f"{s}_coordinate_verified"))
        out = out.join(named, ["acquisition_id", f"channel_{s}", f"object_{s}"], "left")
    for s in ("a", "b"):
        out = out.withColumn(f"{s}_mapping_status", F.coalesce(f"{s}_mapping_status", F.lit(ABSENT))).withColumn(
            f"{s}_coordinate_verified", F.coalesce(f"{s}_coordinate_verified", F.lit(False)))
    resolved = (F.col("a_mapping_status") == RESOLVED) & (F.col("b_mapping_status") == RESOLVED)
    same = F.when(resolved, F.col("a_nucleus_id") == F.col("b_nucleus_id"))
    nuclear = F.coalesce(same, F.lit(False))
    reason = (
        F.when(~F.col("eligible"), F.lit(BELOW))
        .when(~resolved, F.concat(F.lit("unresolved_nuclear_assignment:A="), F.col("a_mapping_status"),
                                  F.lit(";B="), F.col("b_mapping_status")))
        .when(~nuclear, F.lit(DIFFERENT)).otherwise(F.lit("")))
    return out.select(
        *PAIR,
        F.col("object_a").alias("a_current_object_id"), F.col("object_b").alias("b_current_object_id"),
        "a_source_marker_id", "b_source_marker_id", "a_source_cell_id", "b_source_cell_id",
        "a_nucleus_id", "b_nucleus_id", "a_mapping_status", "b_mapping_status",
        "a_coordinate_verified", "b_coordinate_verified", same.alias("same_nucleus"),
        "a_percent_inside_b", "b_percent_inside_a", F.col("eligible").alias("threshold_pass"),
        nuclear.alias("nuclear_constraint_pass"), (F.col("eligible") & nuclear).alias("final_eligible"),
        reason.alias("exclusion_reason"))


def constrained_eligible(overlap: DataFrame, audit: DataFrame) -> DataFrame:
    """The overlap table whose ``eligible`` is the audit's verdict; matching and
    everything after it is recomputed on this, never filtered afterwards."""
    return overlap.drop("eligible").join(
        audit.select(*PAIR, F.col("final_eligible").alias("eligible")), PAIR)


def finish_audit(audit: DataFrame, matches: DataFrame) -> DataFrame:
    """K11 second pass: mark the final matches and name the eligible losers."""
    out = audit.join(matches.select(*PAIR, F.lit(True).alias("_m")), PAIR, "left")
    won = F.coalesce("_m", F.lit(False))
    return out.select(
        *[c for c in audit.columns if c != "exclusion_reason"], won.alias("final_match"),
        F.when(F.col("final_eligible") & ~won, F.lit(NOT_SELECTED))
        .otherwise(F.col("exclusion_reason")).alias("exclusion_reason"))


def compare_pairs(audit: DataFrame, unconstrained: DataFrame, constrained: DataFrame) -> DataFrame:
    """K13 details: every finally matched pair of either variant with its category."""
    u = unconstrained.select(*PAIR, F.lit(True).alias("in_unconstrained"))
    c = constrained.select(*PAIR, F.lit(True).alias("in_constrained"))
    both = u.join(c, PAIR, "full_outer").select(
        *PAIR, F.coalesce("in_unconstrained", F.lit(False)).alias("in_unconstrained"),
        F.coalesce("in_constrained", F.lit(False)).alias("in_constrained"))
    both = both.withColumn("pair_category", F.when(
        F.col("in_unconstrained") & F.col("in_constrained"), F.lit("common"))
        .when(F.col("in_unconstrained"), F.lit("unconstrained_only")).otherwise(F.lit("constrained_only")))
    discordant = ((F.col("a_mapping_status") == RESOLVED) & (F.col("b_mapping_status") == RESOLVED)
                  & (F.col("a_nucleus_id") != F.col("b_nucleus_id")))
    return both.join(audit, PAIR).withColumn(
        "nuclear_identity_discordant", F.coalesce(discordant, F.lit(False)))


def compare_variants(audit: DataFrame, details: DataFrame, roi_counts: DataFrame) -> DataFrame:
    """K13 summary: fourteen metric rows per run.

    ``roi_counts``: ``(KP, a_rois, b_rois)``.
    """
    passed = F.col("threshold_pass")
    resolved = (F.col("a_mapping_status") == RESOLVED) & (F.col("b_mapping_status") == RESOLVED)
    per_audit = audit.groupBy(*KP).agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(passed).alias("passing"),
        F.count_if(passed & resolved & ~F.col("nuclear_constraint_pass")).alias("different"),
        F.count_if(passed & ~resolved).alias("unresolved"),
        F.count_if(F.col("final_eligible")).alias("both_pass"))
    u, c = F.col("in_unconstrained"), F.col("in_constrained")
    per_pair = details.groupBy(*KP).agg(
        F.count_if(u).alias("n_u"), F.count_if(c).alias("n_c"), F.count_if(u & c).alias("n_both"),
        F.count_if(u & ~c).alias("n_only_u"), F.count_if(c & ~u).alias("n_only_c"),
        F.count_if(u & F.col("nuclear_identity_discordant")).alias("n_disc"))
    one = roi_counts.join(per_audit, KP, "left").join(per_pair, KP, "left")
    counts = [c for c in one.columns if c not in KP]
    one = one.select(*KP, *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in counts])
    share = F.when(F.col("n_u") > 0, 100.0 * F.col("n_disc") / F.col("n_u")).otherwise(F.lit(0.0))
    # Metric labels and units, in report order.
    rows = [
        ("Marker A input ROIs", F.col("a_rois"), "ROIs"),
        ("Marker B input ROIs", F.col("b_rois"), "ROIs"),
        ("Candidate spatial-overlap pairs", F.col("candidates"), "pairs"),
        ("Pairs passing original overlap threshold", F.col("passing"), "pairs"),
        ("Threshold-passing pairs excluded for different nuclei", F.col("different"), "pairs"),
        ("Threshold-passing pairs with unresolved nuclear identity", F.col("unresolved"), "pairs"),
        ("Pairs passing overlap and nuclear constraints", F.col("both_pass"), "pairs"),
        ("Final unconstrained stable matches", F.col("n_u"), "pairs"),
        ("Final nucleus-constrained stable matches", F.col("n_c"), "pairs"),
        ("Common final pairs", F.col("n_both"), "pairs"),
        ("Final pairs unique to unconstrained", F.col("n_only_u"), "pairs"),
        ("Final pairs unique to nucleus-constrained", F.col("n_only_c"), "pairs"),
        ("Unconstrained final pairs with discordant nuclear identity", F.col("n_disc"), "pairs"),
        ("Percent unconstrained final pairs with discordant nuclear identity", share, "percent"),
    ]
    packed = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value"), F.lit(un).alias("units"))
                       for m, v, un in rows])
    return one.select(*KP, F.explode(packed).alias("_r")).select(*KP, "_r.*")


def variant_violations(unconstrained: DataFrame, constrained: DataFrame, audit: DataFrame) -> DataFrame:
    """K13 precondition: overlap tables and audit list the same candidate pairs."""
    sets = {"unconstrained": unconstrained, "constrained": constrained}
    out = None
    for name, df in sets.items():
        a, b = df.select(*PAIR), audit.select(*PAIR)
        odd = a.join(b, PAIR, "left_anti").unionByName(b.join(a, PAIR, "left_anti"))
        odd = odd.withColumn("check", F.lit(f"{name}_candidates_differ"))
        out = odd if out is None else out.unionByName(odd)
    return out
