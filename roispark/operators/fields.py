"""Per-acquisition (field) metrics and the selection of fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roispark.functions import bits
from roispark.functions.ranking import group_quantiles
from roispark.sources.io import finite

ACQ = ["acquisition_id"]

# Vocabularies and the patterns that recognise them (Java regex).
LINE_ORDER = ["H1", "H1 CL32", "H1 CL23"]
LINE_PATTERNS = [(r"CL[ _-]*32(?!\d)", "H1 CL32"), (r"CL[ _-]*23(?!\d)", "H1 CL23"),
                 (r"(?<![A-Z0-9])H1(?![A-Z0-9])", "H1")]
ENHANCERS = ["BiVe3", "BiVe4"]
ENHANCER_PATTERNS = [(r"bip?ve3", "BiVe3"), (r"bip?ve4", "BiVe4")]
SOURCE_PATTERN = r"(?:^|/)Exp(\d+)_(\d{3})-(\d)(?!\d)"
INTENSITY_COLUMNS = ["Mean intensity", "MeanIntensity", "Mean_Intensity", "Intensity_Mean",
                     "MeanIntensity_GFP", "IntegratedIntensity"]


def infer_line(text: Column, override: Column | None = None) -> tuple[Column, Column]:
    """cell line from a name, an override wins; second column is the problem or null."""
    upper = F.upper(text)
    found = None
    for pattern, name in LINE_PATTERNS:
        hit = F.regexp_like(upper, F.lit(pattern))
        found = F.when(hit, F.lit(name)) if found is None else found.when(hit, F.lit(name))
    chosen = found if override is None else F.coalesce(F.nullif(F.trim(override), F.lit("")), found)
    problem = F.when(chosen.isNull(), F.lit("line_not_inferable")).when(
        ~chosen.isin(LINE_ORDER), F.lit("line_override_invalid"))
    return F.when(chosen.isin(LINE_ORDER), chosen), problem


def infer_enhancer(text: Column, override: Column | None = None) -> tuple[Column, Column]:
    """exactly one of the two enhancers must be named."""
    lower = F.lower(text)
    three, four = (F.regexp_like(lower, F.lit(p)) for p, _ in ENHANCER_PATTERNS)
    found = F.when(three & ~four, F.lit("BiVe3")).when(four & ~three, F.lit("BiVe4"))
    chosen = found if override is None else F.coalesce(F.nullif(F.trim(override), F.lit("")), found)
    problem = F.when(chosen.isNull(), F.lit("enhancer_not_unique")).when(
        ~chosen.isin(ENHANCERS), F.lit("enhancer_override_invalid"))
    return F.when(chosen.isin(ENHANCERS), chosen), problem


def parse_source(df: DataFrame, column: str) -> DataFrame:
    """experiment, block, section, sample and staining status of a source path."""
    def part(i):
        return F.nullif(F.regexp_extract(column, SOURCE_PATTERN, i), F.lit(""))

    sample = F.concat(part(2), F.lit("-"), part(3))
    # Staining labels by sample suffix.
    stain = F.when(F.endswith(sample, F.lit("-2")), F.lit("Anti-GFP stained (-2)")).when(
        F.endswith(sample, F.lit("-3")), F.lit("No anti-GFP (-3)"))
    return df.select("*", part(1).cast("long").alias("experiment_id"), part(2).cast("long").alias("block_id"),
                     part(3).cast("long").alias("section"), sample.alias("sample"),
                     stain.alias("anti_gfp_status"))


def block_label(text: Column) -> Column:
    """the block of a ``<block>-4`` label, null for any other form."""
    return F.nullif(F.regexp_extract(text, r"^(\d+)-4$", 1), F.lit("")).cast("long")


def reporter_metrics(organoid_px: DataFrame, union_px: DataFrame, objects: DataFrame, enhancer: DataFrame,
                     target: DataFrame, direct: DataFrame, sizes: DataFrame) -> DataFrame:
    """one row per acquisition.

    ``enhancer`` and ``target`` hold ``(acquisition_id, nucleus_id)`` of the nuclear
    runs, ``direct`` the marker-marker matches, ``objects`` the target ROI counts.
    """
    def count(df, name):
        return df.groupBy(*ACQ).agg(F.count(F.lit(1)).alias(name))

    both = enhancer.select(*ACQ, "nucleus_id").join(
        target.select(*ACQ, "nucleus_id"), [*ACQ, "nucleus_id"], "left_semi")
    out = organoid_px.join(sizes, ACQ)
    for df in (union_px, objects, count(enhancer, "enhancer_nuclear_positive_cells"),
               count(target, "target_nuclear_positive_cells"), count(both, "double_positive_nuclei"),
               count(direct, "direct_matched_pairs")):
        out = out.join(df, ACQ, "left")
    counts = ["positive_union_px", "segmented_objects", "enhancer_nuclear_positive_cells",
              "target_nuclear_positive_cells", "double_positive_nuclei", "direct_matched_pairs"]
    out = out.select(*ACQ, "organoid_px", "px", "py", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    mm2 = F.col("organoid_px") * F.col("px") * F.col("py") / 1e6

    def ratio(n, d):
        return F.when(d != 0, n / d)

    n_enh, n_tar, n_both = (F.col(c) for c in counts[2:5])
    return out.select(
        *ACQ, "organoid_px", mm2.alias("organoid_mm2"), *counts,
        (100 * F.col("positive_union_px") / F.col("organoid_px")).alias("positive_area_percent"),
        (F.col("segmented_objects") / mm2).alias("segmented_object_density_mm2"),
        (n_tar / mm2).alias("nuclear_positive_density_mm2"),
        ratio(100 * n_both, n_enh).alias("specificity_percent"), ratio(100 * n_both, n_tar).alias("coverage_percent"),
        (F.col("direct_matched_pairs") - n_both).alias("direct_minus_nuclear_overlap"),
        (n_tar == 0).alias("zero_target_denominator"), (n_enh == 0).alias("zero_enhancer_denominator"))


def nucleus_associated_area(matched_words: DataFrame, fields: DataFrame) -> DataFrame:
    """union of whole matched objects over the organoid, with its cross-checks."""
    union = bits.merge(matched_words, ACQ).groupBy(*ACQ).agg(
        F.sum(bits.size(F.col("bits"))).alias("associated_union_px"))
    cells = matched_words.select(*ACQ, "cell_id").distinct().groupBy(*ACQ).agg(
        F.count(F.lit(1)).alias("matched_cells"))
    out = fields.join(union, ACQ, "left").join(cells, ACQ, "left").withColumn(
        "associated_union_px", F.coalesce("associated_union_px", F.lit(0))).withColumn(
        "matched_cells", F.coalesce("matched_cells", F.lit(0)))
    checks = {
        "cell_count_differs": F.col("matched_cells") != F.col("target_nuclear_positive_cells"),
        "more_than_organoid": F.col("associated_union_px") > F.col("organoid_px"),
        "more_than_positive_union": F.col("associated_union_px") > F.col("positive_union_px"),
    }
    found = F.filter(F.array(*[F.when(bad, F.lit(n)) for n, bad in checks.items()]), lambda v: v.isNotNull())
    return out.select(*ACQ, "associated_union_px", "matched_cells",
                      F.when(F.col("organoid_px") > 0, 100 * F.col("associated_union_px") / F.col("organoid_px")
                             ).alias("associated_area_percent"), F.array_join(found, ",").alias("violations"))


def class_metrics(class_counts: DataFrame, organoid_um2: DataFrame) -> DataFrame:
    """totals, densities and shares from the four class counts of an acquisition."""
    names = {"A+/B+": "double_positive", "A+/B-": "a_only", "A-/B+": "b_only", "A-/B-": "double_negative"}
    wide = class_counts.groupBy(*ACQ).agg(*[
        F.coalesce(F.sum(F.when(F.col("cell_class") == k, F.col("count"))), F.lit(0)).alias(v)
        for k, v in names.items()])
    wide = wide.join(organoid_um2, ACQ).withColumn("all_nuclei", sum(F.col(v) for v in names.values())).withColumn(
        "a_positive", F.col("double_positive") + F.col("a_only")).withColumn(
        "b_positive", F.col("double_positive") + F.col("b_only"))
    mm2 = F.col("organoid_area_um2") / 1e6
    parts = ["double_positive", "a_only", "b_only", "a_positive", "b_positive"]
    return wide.select(
        *ACQ, "organoid_area_um2", "all_nuclei", *names.values(), "a_positive", "b_positive",
        F.when(F.col("a_positive") != 0, 100.0 * F.col("double_positive") / F.col("a_positive")).alias(
            "b_within_a_percent"),
        *[F.when(mm2 > 0, F.col(p) / mm2).alias(f"{p}_density_per_mm2") for p in parts],
        *[F.when(F.col("all_nuclei") != 0, 100.0 * F.col(p) / F.col("all_nuclei")).alias(f"{p}_percent") for p in parts])


def positive_areas(nuclei: DataFrame, marker_metrics: DataFrame) -> DataFrame:
    """F6 rows: B-positive nuclei with the area of their marker object (left join)."""
    m = marker_metrics.select(*ACQ, F.col("object_id").alias("b_marker_id"), "area_um2")
    return nuclei.where("b_positive AND cell_class IS NOT NULL").select(
        *ACQ, "nucleus_id", "cell_class", "b_marker_id").join(m, [*ACQ, "b_marker_id"], "left")


def positive_area_metrics(rows: DataFrame) -> DataFrame:
    """area sum, mean, median, by class, and the one-to-one / missing-area counts."""
    area = F.col("area_um2")
    base = rows.groupBy(*ACQ).agg(
        F.count(F.lit(1)).alias("roi_count"), F.sum(area).alias("area_sum_um2"), F.avg(area).alias("area_mean_um2"),
        F.avg(F.when(F.col("cell_class") == "A+/B+", area)).alias("area_mean_double_positive_um2"),
        F.avg(F.when(F.col("cell_class") == "A-/B+", area)).alias("area_mean_b_only_um2"),
        F.count_if(area.isNull() | (area <= 0)).alias("missing_areas"))
    reused = rows.groupBy(*ACQ, "b_marker_id").agg(F.count(F.lit(1)).alias("_n")).groupBy(*ACQ).agg(
        F.count_if(F.col("_n") > 1).alias("markers_used_twice"))
    med = group_quantiles(rows.where("area_um2 IS NOT NULL"), ACQ, "area_um2", {"area_median_um2": 0.5})
    return base.join(med, ACQ, "left").join(reused, ACQ)


def choose_column(columns: list[str], candidates: list[str]) -> str | None:
    """First candidate that exists (exact spelling), decided at plan time."""
    return next((c for c in candidates if c in columns), None)


def reporter_roi_metrics(metrics: DataFrame, organoid_um2: DataFrame, area: str = "area_um2",
                         intensity: str | None = None) -> DataFrame:
    """count, density, area and intensity summary of the reporter channel's ROIs."""
    intensity = intensity or choose_column(metrics.columns, INTENSITY_COLUMNS)
    value = finite(intensity) if intensity else F.lit(None).cast("double")
    rows = metrics.select(*ACQ, F.col(area).alias("_area"), value.alias("_value"))
    base = rows.groupBy(*ACQ).agg(
        F.count(F.lit(1)).alias("roi_count"), F.sum("_area").alias("area_sum_um2"),
        F.avg("_area").alias("area_mean_um2"), F.avg("_value").alias("mean_intensity_mean"))
    a = group_quantiles(rows.where("_area IS NOT NULL"), ACQ, "_area", {"area_median_um2": 0.5})
    out = organoid_um2.join(base, ACQ, "left").join(a, ACQ, "left")
    if intensity:
        v = group_quantiles(rows.where("_value IS NOT NULL"), ACQ, "_value", {"mean_intensity_median": 0.5})
        out = out.join(v, ACQ, "left")
    else:
        out = out.withColumn("mean_intensity_median", F.lit(None).cast("double"))
    um2, n = F.col("organoid_area_um2"), F.coalesce("roi_count", F.lit(0))
    total = F.coalesce("area_sum_um2", F.lit(0.0))
    return out.select(
        *ACQ, n.alias("roi_count"), F.when(um2 != 0, n / (um2 / 1e6)).alias("density_per_mm2"),
        total.alias("area_sum_um2"), F.when(um2 != 0, 100.0 * total / um2).alias("area_percent_of_organoid"),
        "area_mean_um2", "area_median_um2", "mean_intensity_mean", "mean_intensity_median",
        F.lit(intensity or "").alias("intensity_column"))


def manifest_violations(original: DataFrame, remaining: DataFrame, original_tiles: DataFrame,
                        remaining_tiles: DataFrame) -> DataFrame:
    """F8: where the manifests of the two workspaces disagree; empty when they plan the same fields.

    Manifests are ``(index, source_field)``, tiles ``(index, position, source_index, source)``.  One row per index
    and check; ``differing_tiles`` counts positions whose tile is absent on one side or another file.
    """
    def both(a, b, keys, values):
        left, right = (df.select(*keys, F.struct(*values).alias(name)) for df, name in ((a, "_o"), (b, "_r")))
        return left.join(right, keys, "full_outer")

    pair = both(original, remaining, ["index"], ["source_field"])
    known = pair.where("_o IS NOT NULL AND _r IS NOT NULL").select("index")
    planned = pair.where(~F.col("_o").eqNullSafe(F.col("_r"))).select(
        "index", F.when(F.col("_o").isNull(), F.lit("not in original manifest"))
        .when(F.col("_r").isNull(), F.lit("not in remaining manifest"))
        .otherwise(F.lit("source field differs")).alias("check"), F.lit(0).cast("long").alias("differing_tiles"))
    tiles = both(original_tiles, remaining_tiles, ["index", "position"], ["source_index", "source"]).where(
        ~F.col("_o").eqNullSafe(F.col("_r"))).join(known, "index", "left_semi").groupBy("index").agg(
        F.lit("tiles differ").alias("check"), F.count(F.lit(1)).alias("differing_tiles"))
    return planned.unionByName(tiles.select("index", "check", "differing_tiles"))


def selection_gaps(audit: DataFrame, selection: DataFrame) -> DataFrame:
    """F8: verified indices that ``collect_fields`` did not include, with its reason (null: not planned at all)."""
    taken = audit.where("included").select("index")
    return selection.select("index").distinct().join(taken, "index", "left_anti").join(
        audit.select("index", "reason"), "index", "left")


def collect_fields(fields: DataFrame, blocks: DataFrame, selection: DataFrame, experiment: int,
                   excluded: list[int], switch_index: int, verified_line: str) -> DataFrame:
    """F8: audit of every planned field: included or not, from where, and why.

    ``fields``: ``(index, source_field, original_complete, remaining_complete)``;
    ``blocks``: ``(block_id, cell_line, condition)``; ``selection``: verified indices of
    ``verified_line``.  Indices below ``switch_index`` come from the original
    workspace, later ones from the remaining one, the index itself from either.
    """
    f = parse_source(fields, "source_field").join(blocks, "block_id", "left").join(
        selection.select("index", F.lit(True).alias("_verified")), "index", "left")
    # Reasons.
    refused = (
        F.when(F.col("index").isin(excluded), F.lit("known-failed excluded index"))
        .when(F.col("experiment_id") != experiment, F.lit("different experiment"))
        .when(F.col("cell_line").isNull(), F.lit("not one of the planned blocks"))
        .when((F.col("cell_line") == verified_line) & F.col("_verified").isNull(),
              F.lit("not in the verified selection")))
    i, old, new = F.col("index"), F.col("original_complete"), F.col("remaining_complete")
    source = F.when((i <= switch_index) & old, F.lit("original")).when(
        (i >= switch_index) & new, F.lit("remaining"))
    reason = F.coalesce(refused, F.when(source.isNull(), F.lit(
        "no complete downstream marker-colocalization stage")), F.lit("complete analysis"))
    included = refused.isNull() & source.isNotNull()
    return f.select(
        "index", "source_field", "sample", "block_id", "experiment_id",
        F.coalesce("cell_line", F.lit("")).alias("cell_line"), F.coalesce("condition", F.lit("")).alias("condition"),
        included.alias("included"), F.when(included, source).otherwise(F.lit("")).alias("source_workspace"),
        reason.alias("reason"))


def sample_summary(fields: DataFrame, by: list[str], means: list[str]) -> DataFrame:
    """number of fields and metric means per group."""
    return fields.groupBy(*by).agg(F.count(F.lit(1)).alias("n_fields"),
                                   *[F.avg(m).alias(f"mean_{m}") for m in means])


def derived_metric(df: DataFrame, direct: list[str], numerator: list[str], denominator: list[str],
                   name: str, percent: bool, guard: bool) -> DataFrame:
    """the first present column (any case), else the ratio of two present columns.

    ``guard`` makes the ratio null where the denominator is not positive.
    """
    lowered = {c.lower(): c for c in df.columns}

    def first(names):
        return next((lowered[n.lower()] for n in names if n.lower() in lowered), None)

    column = first(direct)
    if column:
        return df.withColumn(name, finite(column)).withColumn(f"{name}_source", F.lit(column))
    top, bottom = first(numerator), first(denominator)
    if not top or not bottom:
        raise ValueError(f"cannot find or compute {name}")
    den = finite(bottom)
    ratio = F.when((den > 0) if guard else (den != 0), finite(top) / den)
    label = f"100*{top}/{bottom}" if percent else f"{top}/{bottom}"
    return df.withColumn(name, ratio * 100.0 if percent else ratio).withColumn(f"{name}_source", F.lit(label))


def verify_selection(source: DataFrame, used: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """keys missing in the used table, extra keys, and metadata mismatches."""
    a = source.select(key, F.lit(True).alias("_s"), *[F.col(c).alias(f"_s_{c}") for c in compare])
    b = used.select(key, F.lit(True).alias("_u"), *[F.col(c).alias(f"_u_{c}") for c in compare])
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"_s_{c}").eqNullSafe(F.col(f"_u_{c}"))
    out = a.join(b, key, "full_outer").withColumn("status", F.when(F.col("_u").isNull(), F.lit("missing"))
                                                  .when(F.col("_s").isNull(), F.lit("extra"))
                                                  .when(~same, F.lit("metadata_mismatch")))
    return out.where("status IS NOT NULL").select(key, "status")


def verify_counts(rows: DataFrame, expected: DataFrame, by: list[str]) -> DataFrame:
    """expected against actual number of rows per cell of a design."""
    found = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("actual"))
    return expected.join(found, by, "full_outer").select(
        *by, F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual")
    ).withColumn("status", F.when(F.col("expected") == F.col("actual"), F.lit("PASS")).otherwise(F.lit("MISMATCH")))
