"""Overlap of objects between channels and pair metrics.

All configured channel pairs of all acquisitions are answered by one join of
bit-row words on (acquisition, channel pair, y, segment).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roispark.functions import bits
from roispark.operators.metrics import intensity_stats, object_areas
from roispark.schema import K, KP, PAIR, validate_pairs, validate_threshold
from roispark.session import materialize

STATS = ["mean_intensity", "median_intensity", "intensity_sd", "min_intensity",
         "p05_intensity", "p95_intensity", "max_intensity"]


def _partners(column, pairs, own: int, kind):
    """Array of the partner channels configured for the channel in ``column``."""
    entries = [F.when(column == F.lit(p[own]), F.lit(p[1 - own]).cast(kind)) for p in pairs]
    return F.filter(F.array(*entries), lambda v: v.isNotNull())


def side(words: DataFrame, pairs: list[tuple], own: str) -> DataFrame:
    """Rows of one side of every configured pair, keyed by ``KP`` and ``object_<own>``."""
    mine, other = (0, "b") if own == "a" else (1, "a")
    rest = [c for c in words.columns if c not in (*K, "object_id")]
    return words.select(
        "acquisition_id", F.col("channel").alias(f"channel_{own}"),
        F.explode(_partners(F.col("channel"), pairs, mine, words.schema["channel"].dataType)).alias(f"channel_{other}"),
        F.col("object_id").alias(f"object_{own}"), *rest)


def shared_words(words: DataFrame, pairs: list[tuple]) -> DataFrame:
    """Shared pixels of every A/B object pair, as words ``(PAIR, y, seg, bits)``.

    At most 32 disjoint objects per side can meet in one segment and one row, so
    the candidate fan-out of the join is bounded by the overlap depth, and a
    candidate without a common pixel is dropped inside the join condition.  Both
    sides are the same words by block, so one shuffle serves them and all pairs.
    """
    validate_pairs(pairs)
    at = ["acquisition_id", "y", "seg"]
    placed = words.select(*at, "channel", "object_id", "bits")
    a, b = placed.alias("a"), placed.alias("b")
    kind = words.schema["channel"].dataType
    # A lookup, since a plain comparison would be moved below the shuffle, differently on both sides.
    wanted = F.array(*[F.struct(F.lit(x).cast(kind).alias("channel_a"), F.lit(y).cast(kind).alias("channel_b")) for x, y in pairs])
    asked = F.array_contains(wanted, F.struct(F.col("a.channel").alias("channel_a"), F.col("b.channel").alias("channel_b")))
    both = F.col("a.bits").bitwiseAND(F.col("b.bits"))
    condition = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in at] + [both != 0, asked]
    return a.join(b, condition).select(
        "a.acquisition_id", F.col("a.channel").alias("channel_a"), F.col("b.channel").alias("channel_b"),
        F.col("a.object_id").alias("object_a"), F.col("b.object_id").alias("object_b"), "a.y", "a.seg", both.alias("bits"))


def shared_pixels(words: DataFrame, pairs: list[tuple]) -> DataFrame:
    """J1 as one row per shared pixel."""
    return bits.unpack(shared_words(words, pairs), PAIR)


def overlap_counts(words: DataFrame, pairs: list[tuple], areas: DataFrame | None = None,
                   shared: DataFrame | None = None) -> DataFrame:
    """Shared area and both percentages for every overlapping pair.

    Counts are aggregated before the areas are joined.  ``shared`` are the ``shared_words``, where they are known.
    """
    areas = object_areas(words) if areas is None else areas
    shared = shared_words(words, pairs) if shared is None else shared
    counts = shared.groupBy(*PAIR).agg(
        F.sum(bits.size(F.col("bits"))).alias("shared_area"))
    return with_areas(counts, areas).select(
        *PAIR, "shared_area", "a_area", "b_area",
        (F.col("shared_area") / F.col("a_area") * 100).alias("a_percent_inside_b"),
        (F.col("shared_area") / F.col("b_area") * 100).alias("b_percent_inside_a"))


def with_areas(pairs: DataFrame, areas: DataFrame) -> DataFrame:
    for s in ("a", "b"):
        named = areas.select(
            "acquisition_id", F.col("channel").alias(f"channel_{s}"),
            F.col("object_id").alias(f"object_{s}"), F.col("area_px").alias(f"{s}_area"))
        pairs = pairs.join(named, ["acquisition_id", f"channel_{s}", f"object_{s}"], "left")
    return pairs


def mark_eligible(overlap: DataFrame, threshold: float) -> DataFrame:
    """Directional, inclusive; the cut is ``threshold * 100`` in double."""
    cut = validate_threshold(threshold) * 100
    return overlap.withColumn("eligible", F.col("a_percent_inside_b") >= F.lit(cut))


def pair_status(acquisitions: DataFrame, overlap: DataFrame, pairs: list[tuple],
                constrained: bool = False) -> DataFrame:
    """One row per acquisition and pair; no overlap at all is an error status
    unless the matching is constrained, where an empty result is valid."""
    kind = overlap.schema["channel_a"].dataType
    wanted = acquisitions.select("acquisition_id").distinct().select(
        "acquisition_id",
        F.explode(F.array(*[F.struct(F.lit(a).cast(kind).alias("channel_a"), F.lit(b).cast(kind).alias("channel_b"))
                            for a, b in validate_pairs(pairs)])).alias("_p"),
    ).select("acquisition_id", "_p.*")
    found = overlap.groupBy(*KP).agg(F.count(F.lit(1)).alias("overlap_pairs"))
    empty = "ok" if constrained else "no_overlap"
    return wanted.join(found, KP, "left").select(
        *KP, F.coalesce("overlap_pairs", F.lit(0)).alias("overlap_pairs"),
        F.when(F.col("overlap_pairs") > 0, F.lit("ok")).otherwise(F.lit(empty)).alias("status"))


def best_partner(overlap: DataFrame, own: str) -> DataFrame:
    """Best partner of each A (by A%) or each B (by B%); ties take the lowest id.

    A max over a struct combines map-side, so a much-overlapped object costs one
    row per task instead of one sorted group.
    """
    other, percent = ("b", "a_percent_inside_b") if own == "a" else ("a", "b_percent_inside_a")
    values = ["shared_area", "a_percent_inside_b", "b_percent_inside_a"]
    best = F.max(F.struct(F.col(percent).alias("_p"), (-F.col(f"object_{other}")).alias("_o"),
                          *values))
    return overlap.groupBy(*KP, f"object_{own}").agg(best.alias("_best")).select(
        *KP, f"object_{own}", (-F.col("_best._o")).alias(f"best_object_{other}"),
        *[F.col(f"_best.{v}").alias(f"best_{v}") for v in values])


def objects_of_side(areas: DataFrame, pairs: list[tuple], own: str) -> DataFrame:
    """Every object of the A or B channel of every configured pair."""
    return side(areas.select(*K, "object_id"), pairs, own).select(*KP, f"object_{own}")


def below_threshold(areas: DataFrame, overlap: DataFrame, pairs: list[tuple]) -> DataFrame:
    """A objects in no eligible pair, with their best partial partner or zeros."""
    ids = objects_of_side(areas, pairs, "a")
    eligible = overlap.where("eligible").select(*KP, "object_a")
    return (
        ids.join(eligible, [*KP, "object_a"], "left_anti")
        .join(best_partner(overlap, "a"), [*KP, "object_a"], "left")
        .select(*KP, "object_a", "best_object_b",
                F.coalesce("best_shared_area", F.lit(0)).alias("best_shared_area"),
                F.coalesce("best_a_percent_inside_b", F.lit(0.0)).alias("best_a_percent_inside_b"),
                F.coalesce("best_b_percent_inside_a", F.lit(0.0)).alias("best_b_percent_inside_a"))
    )


def pair_geometry(pairs: DataFrame, overlap: DataFrame, shapes: DataFrame, sizes: DataFrame) -> DataFrame:
    """Geometry of given pairs; either side may be null (an object without partner).

    ``pairs`` has ``PAIR`` columns, ``shapes`` area and centre per object.
    """
    out = pairs.select(*PAIR).join(overlap.select(*PAIR, "shared_area"), PAIR, "left")
    for s in ("a", "b"):
        named = shapes.select(
            "acquisition_id", F.col("channel").alias(f"channel_{s}"),
            F.col("object_id").alias(f"object_{s}"), F.col("area_px").alias(f"{s}_px"),
            F.col("center_x").alias(f"{s}_cx"), F.col("center_y").alias(f"{s}_cy"))
        out = out.join(named, ["acquisition_id", f"channel_{s}", f"object_{s}"], "left")
    out = out.join(sizes, "acquisition_id")
    a, b = F.coalesce("a_px", F.lit(0)), F.coalesce("b_px", F.lit(0))
    inter = F.coalesce("shared_area", F.lit(0))
    union = a + b - inter
    um2 = F.col("px") * F.col("py")
    dx, dy = F.col("b_cx") - F.col("a_cx"), F.col("b_cy") - F.col("a_cy")
    return out.select(
        *PAIR,
        F.col("a_px").alias("a_pixel_count"), F.col("b_px").alias("b_pixel_count"),
        inter.alias("intersection_pixels"), F.when(union > 0, union).alias("union_pixels"),
        (F.col("a_px") * um2).alias("a_area_um2"), (F.col("b_px") * um2).alias("b_area_um2"),
        (inter * um2).alias("intersection_area_um2"),
        F.when(union > 0, union * um2).alias("union_area_um2"),
        (100.0 * inter / F.col("a_px")).alias("a_percent_inside_b"),
        (100.0 * inter / F.col("b_px")).alias("b_percent_inside_a"),
        F.when(union > 0, 100.0 * inter / union).alias("iou_percent"),
        F.when(a + b > 0, 200.0 * inter / (a + b)).alias("dice_percent"),
        dx.alias("centroid_dx_px"), dy.alias("centroid_dy_px"),
        F.hypot(dx, dy).alias("centroid_distance_px"),
        (dx * F.col("px")).alias("centroid_dx_um"), (dy * F.col("py")).alias("centroid_dy_um"),
        F.hypot(dx * F.col("px"), dy * F.col("py")).alias("centroid_distance_um"))


def region_intensity(pairs: DataFrame, words: DataFrame, images: DataFrame,
                     channel_pairs: list[tuple], shared: DataFrame | None = None) -> DataFrame:
    """Both signals in the A object, the B object and their intersection.

    The words of all regions are one table, so the images are joined once.  An object is measured once per signal that
    some pair of it asks for, whatever the number of its pairs and channel pairs and its side in them; only the
    intersections are measured per pair.  One wide row per pair.
    """
    pairs = pairs.select(*PAIR)
    shared = shared_words(words, channel_pairs) if shared is None else shared
    signals = F.array("channel_a", "channel_b").alias("_s")
    configured = reduce(lambda x, y: x | y, [(F.col("channel_a") == F.lit(a)) & (F.col("channel_b") == F.lit(b))
                                             for a, b in validate_pairs(channel_pairs)])
    wanted = reduce(DataFrame.unionByName, [pairs.where(configured).select(
        "acquisition_id", F.col(f"channel_{s}").alias("channel"), F.col(f"object_{s}").alias("object_id"), F.explode(signals).alias("_s"))
        for s in ("a", "b")]).groupBy(*K, "object_id").agg(F.collect_set("_s").alias("_s"))
    # The region of an object is a pair without B.
    kinds = pairs.schema
    rois = words.join(wanted, [*K, "object_id"]).select(
        "acquisition_id", F.col("channel").alias("channel_a"), F.lit(None).cast(kinds["channel_b"].dataType).alias("channel_b"),
        F.col("object_id").alias("object_a"), F.lit(None).cast(kinds["object_b"].dataType).alias("object_b"),
        "_s", "y", "seg", "bits")
    crossings = shared.join(pairs, PAIR, "left_semi").select(*PAIR, signals, "y", "seg", "bits")
    measured = materialize(intensity_stats(rois.unionByName(crossings), images, [*PAIR, "_s"], "_s"))
    values = F.struct(*STATS, "integrated_intensity")
    by_signal = F.map_from_entries(F.collect_list(F.struct("_s", values)))  # at most one entry per channel
    of_object = measured.where("object_b IS NULL").groupBy("acquisition_id", "channel_a", "object_a").agg(by_signal.alias("_m"))

    def cells(region):
        # Only what the pair asks for goes on to the next join.
        return [F.element_at("_m", F.col(f"channel_{s}")).alias(f"{s}_signal_in_{region}") for s in ("a", "b")]

    out = pairs.join(measured.where("object_b IS NOT NULL").groupBy(*PAIR).agg(by_signal.alias("_m")), PAIR, "left").select(
        *pairs.columns, *cells("intersection"))
    for s in ("a", "b"):
        ids = ["acquisition_id", f"channel_{s}", f"object_{s}"]
        out = out.join(of_object.toDF(*ids, "_m"), ids, "left").select(*out.columns, *cells(f"{s}_roi"))
    found = [f"{s}_signal_in_{region}" for region in ("a_roi", "b_roi", "intersection") for s in ("a", "b")]
    return out.where(F.coalesce(*found).isNotNull()).select(
        *PAIR, *[F.col(f"{c}.{stat}").alias(f"{c}_{stat}") for c in found for stat in [*STATS, "integrated_intensity"]])


def matched_intensity(matches: DataFrame, overlap: DataFrame, regions: DataFrame,
                      areas: DataFrame) -> DataFrame:
    """Native integrated and mean intensity of matched pairs with overlap sums."""
    base = with_areas(matches.select(*PAIR), areas)
    base = base.join(overlap.select(*PAIR, "shared_area", "a_percent_inside_b",
                                    "b_percent_inside_a"), PAIR, "left")
    return base.join(regions, PAIR, "left").select(
        *PAIR,
        F.col("a_signal_in_a_roi_integrated_intensity").alias("a_roi_integrated_intensity"),
        F.col("b_signal_in_b_roi_integrated_intensity").alias("b_roi_integrated_intensity"),
        F.col("a_signal_in_a_roi_mean_intensity").alias("a_roi_mean_intensity"),
        F.col("b_signal_in_b_roi_mean_intensity").alias("b_roi_mean_intensity"),
        F.col("a_area").alias("a_roi_area_px"), F.col("b_area").alias("b_roi_area_px"),
        F.coalesce("shared_area", F.lit(0)).alias("overlap_area_px"),
        F.coalesce("a_signal_in_intersection_integrated_intensity",
                   F.lit(0.0)).alias("a_overlap_integrated_intensity"),
        F.coalesce("b_signal_in_intersection_integrated_intensity",
                   F.lit(0.0)).alias("b_overlap_integrated_intensity"),
        "a_percent_inside_b", "b_percent_inside_a")


def union_area(words: DataFrame, organoid_area: DataFrame | None = None,
               keys: list[str] = K) -> DataFrame:
    """Pixels covered by at least one object of a channel, and % of the organoid."""
    out = bits.merge(words, keys).groupBy(*keys).agg(
        F.sum(bits.size(F.col("bits"))).alias("positive_area_px"))
    if organoid_area is None:
        return out
    return out.join(organoid_area, "acquisition_id", "left").select(
        *keys, "positive_area_px", "organoid_area_px",
        F.when(F.col("organoid_area_px") != 0, 100.0 * F.col("positive_area_px")
               / F.col("organoid_area_px")).alias("positive_area_percent"))


def outside_mask(words: DataFrame, mask_words: DataFrame) -> DataFrame:
    """Per object, pixels not covered by the acquisition's mask (only offenders)."""
    mask = mask_words.select("acquisition_id", "y", "seg", F.col("bits").alias("_m"))
    left = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("_m", F.lit(0).cast("long"))))
    return (
        words.join(mask, ["acquisition_id", "y", "seg"], "left")
        .groupBy(*K, "object_id").agg(F.sum(bits.size(left)).alias("outside_px"))
        .where("outside_px > 0")
    )
