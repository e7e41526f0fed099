"""Label images and image stacks as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roispark.functions import bits
from roispark.functions.ranking import ranked
from roispark.schema import K
from roispark.session import materialize

# Verification tolerance, slab height of the padding search.
CENTER_TOLERANCE = 1e-6
TRIM_SLAB = 128


def levels(label_pixels: DataFrame, keys: list[str] = K) -> DataFrame:
    """Distinct non-zero levels with their rank: the level list, not the pixels, is ranked."""
    distinct = label_pixels.where("level <> 0").select(*keys, "level").distinct()
    return ranked(distinct, keys, ["level"], "roi", "level_count")


def relabel(label_pixels: DataFrame, keys: list[str] = K) -> DataFrame:
    """L1/L4: pixels with ROI ids 1..n in ascending level order; background dropped.

    The merge hint keeps the pixels, whose size is guessed from what they were derived from, out of the driver.
    """
    ids = levels(label_pixels, keys).select(*keys, "level", "roi")
    return label_pixels.where("level <> 0").hint("merge").join(ids, [*keys, "level"]).select(
        *keys, "roi", "x", "y", "level")


def level_spacing(ranked_levels: DataFrame, keys: list[str] = K) -> DataFrame:
    """L2: smallest and largest gap of neighbouring levels; even when they differ by at most 2."""
    this = ranked_levels.select(*keys, "roi", "level")
    nxt = ranked_levels.select(*keys, (F.col("roi") - 1).alias("roi"), F.col("level").alias("_next"))
    gaps = this.join(nxt, [*keys, "roi"], "left").withColumn("_gap", F.col("_next") - F.col("level"))
    return gaps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("levels"), F.min("_gap").alias("min_gap"),
        F.max("_gap").alias("max_gap"), F.avg("_gap").alias("mean_gap"),
        (F.max("_gap") - F.min("_gap") <= 2).alias("evenly_spaced"))


def _extents() -> list[Column]:
    return [F.count(F.lit(1)).alias("pixel_count"), F.min("x").alias("min_x"), F.max("x").alias("max_x"),
            F.min("y").alias("min_y"), F.max("y").alias("max_y"), F.avg("x").alias("center_x"), F.avg("y").alias("center_y")]


def label_summary(roi_pixels: DataFrame, keys: list[str] = K) -> DataFrame:
    """L3: pixel count, bounding box, centre and original level per ROI."""
    return roi_pixels.groupBy(*keys, "roi").agg(*_extents(), F.min("level").alias("level"))


def image_summary(label_pixels: DataFrame, keys: list[str] = K) -> DataFrame:
    """L1 and L3 of label images in one pass over the pixels: they are counted per level, and the levels that were
    found, one row each, are ranked with what was counted."""
    per_level = materialize(label_pixels.where("level <> 0").groupBy(*keys, "level").agg(*_extents()))
    return ranked(per_level, keys, ["level"], "roi", None).select(
        *keys, "roi", *[c for c in per_level.columns if c not in (*keys, "level")], "level")


def verify_labels(measured: DataFrame, summary: DataFrame, keys: list[str] = K) -> DataFrame:
    """Measured against reconstructed ROIs.

    The measuring tool's box maximum is exclusive, so a good maximum differs by -1.
    Comparisons with a missing side are false, not null.
    """
    m = measured.select(*keys, "roi", F.lit(True).alias("_m"), *[
        F.col(c).alias(f"cp_{c}") for c in ("area", "min_x", "max_x", "min_y", "max_y", "center_x", "center_y")])
    out = m.join(summary.withColumn("_s", F.lit(True)), [*keys, "roi"], "full_outer")

    def diff(a, b):
        return F.col(a) - F.col(b)

    def is_true(c):
        return F.coalesce(c, F.lit(False))

    status = F.when(F.col("_m") & F.col("_s"), F.lit("MATCH")).when(
        F.col("_m"), F.lit("CP_ONLY")).otherwise(F.lit("TIFF_ONLY"))
    out = out.select(
        *keys, "roi", status.alias("roi_status"),
        diff("pixel_count", "cp_area").alias("area_difference"),
        diff("min_x", "cp_min_x").alias("min_x_difference"),
        diff("max_x", "cp_max_x").alias("max_x_difference"),
        diff("min_y", "cp_min_y").alias("min_y_difference"),
        diff("max_y", "cp_max_y").alias("max_y_difference"),
        diff("center_x", "cp_center_x").alias("center_x_difference"),
        diff("center_y", "cp_center_y").alias("center_y_difference"))
    box = ((F.col("min_x_difference") == 0) & (F.col("max_x_difference") == -1)
           & (F.col("min_y_difference") == 0) & (F.col("max_y_difference") == -1))
    centre = ((F.abs("center_x_difference") <= CENTER_TOLERANCE)
              & (F.abs("center_y_difference") <= CENTER_TOLERANCE))
    out = out.select("*", is_true(F.col("area_difference") == 0).alias("area_match"),
                     is_true(box).alias("bounding_box_match"), is_true(centre).alias("center_match"))
    return out.withColumn("full_match", (F.col("roi_status") == "MATCH") & F.col("area_match")
                          & F.col("bounding_box_match") & F.col("center_match"))


def verify_summary(verified: DataFrame, keys: list[str] = K) -> DataFrame:
    """Counts per channel and whether both id sets are identical."""
    def count_if(c):
        return F.count_if(c)

    match = F.col("roi_status") == "MATCH"
    return verified.groupBy(*keys).agg(
        count_if(F.col("roi_status") != "TIFF_ONLY").alias("measured_rois"),
        count_if(F.col("roi_status") != "CP_ONLY").alias("reconstructed_rois"),
        count_if(match).alias("matched"),
        count_if(F.col("roi_status") == "CP_ONLY").alias("cp_only"),
        count_if(F.col("roi_status") == "TIFF_ONLY").alias("tiff_only"),
        count_if(match & F.col("area_match")).alias("area_matches"),
        count_if(match & F.col("bounding_box_match")).alias("bounding_box_matches"),
        count_if(match & F.col("center_match")).alias("center_matches"),
        count_if(match & F.col("full_match")).alias("full_matches"),
        F.bool_and(match).alias("numbering_identical"))


def roi_density(summary: DataFrame, organoid_area: DataFrame, keys: list[str] = K) -> DataFrame:
    """ROI count over total organoid area, per pixel, 100 000 and 1 000 000 pixels."""
    counts = summary.groupBy(*keys).agg(F.count(F.lit(1)).alias("roi_count"))
    density = F.col("roi_count") / F.col("organoid_area_px")
    return counts.join(organoid_area, "acquisition_id").select(
        *keys, "roi_count", "organoid_area_px", density.alias("density_per_px"),
        (density * 100000).alias("density_per_100k_px"), (density * 1000000).alias("density_per_1m_px"))


def label_boundary(words: DataFrame, keys: list[str], image_size: tuple[int, int] | None = None) -> DataFrame:
    """Boundary words of disjoint labels: a 4-neighbour is not in the same label.

    With ``image_size`` (width, height) a missing neighbour beyond the image edge
    does not make a pixel a boundary; without it the edge counts as background.
    """
    near = bits.neighbour_words(words, keys, both=True)
    b, full = F.col("bits"), F.lit(bits.FULL).cast("long")
    last = bits.SEGMENT - 1
    left = F.shiftleft(b, 1).bitwiseAND(full).bitwiseOR(F.shiftright("bits_left", last).bitwiseAND(F.lit(1)))
    right = F.shiftright(b, 1).bitwiseOR(F.shiftleft(F.col("bits_right").bitwiseAND(F.lit(1)), last))
    up, down = F.col("bits_up"), F.col("bits_down")
    if image_size is not None:
        width, height = image_size
        edge = F.lit(1 << ((width - 1) & last)).cast("long")
        left = F.when(F.col("seg") == 0, left.bitwiseOR(F.lit(1))).otherwise(left)
        right = F.when(F.col("seg") == (width - 1) // bits.SEGMENT, right.bitwiseOR(edge)).otherwise(right)
        up = F.when(F.col("y") == 0, full).otherwise(up)
        down = F.when(F.col("y") == height - 1, full).otherwise(down)
    inner = reduce(lambda a, c: a.bitwiseAND(c), [left, right, up, down])
    out = near.select(*keys, "y", "seg", b.bitwiseAND(F.bitwise_not(inner)).alias("bits"))
    return out.where("bits <> 0")


def max_project(stack: DataFrame, keys: list[str] = K) -> DataFrame:
    """Maximum over Z, computed on 32-pixel blocks.

    Block positions are aggregated as plain max columns, which combine map-side.
    """
    slots = [F.max(F.get("pixel_values", F.lit(i))).alias(f"_v{i}") for i in range(bits.SEGMENT)]
    return stack.groupBy(*keys, "y", "seg").agg(*slots).select(
        *keys, "y", "seg", F.array(*[F.col(f"_v{i}") for i in range(bits.SEGMENT)]).alias("pixel_values"))


def usable_z(stack: DataFrame, keys: list[str] = K) -> DataFrame:
    """Last plane with a non-zero value + 1; null (an error status) if none."""
    lit = F.exists("pixel_values", lambda v: v != 0)
    return stack.groupBy(*keys).agg((F.max(F.when(lit, F.col("z"))) + 1).alias("usable_planes"))


def trim_extent(stack: DataFrame, height: int, width: int, slab: int | None = None,
                keys: list[str] = K) -> DataFrame:
    """Extent without trailing zero padding.

    ``slab`` (``TRIM_SLAB`` for the usual search) looks at the corner of the last rows and columns only:
    a pixel counts for either extent if it lies in both.  The default looks at the whole image.  Nothing
    found leaves the extents null with status ``no_signal``.
    """
    x_edge, y_edge = (0, 0) if slab is None else (max(width - slab, 0), max(height - slab, 0))
    x = F.transform("pixel_values", lambda v, i: F.when(
        (v != 0) & (F.col("seg") * bits.SEGMENT + i >= x_edge), F.col("seg") * bits.SEGMENT + i))
    last = F.when(F.col("y") >= y_edge, F.array_max(x))
    found = stack.select(*keys, "y", last.alias("_x")).groupBy(*keys).agg(
        (F.max(F.when(F.col("_x").isNotNull(), F.col("y"))) + 1).alias("height"), (F.max("_x") + 1).alias("width"))
    return found.withColumn("status", F.when(F.col("width").isNull(), "no_signal").otherwise("ok"))


def downsample(images: DataFrame, factor: int, height: int, width: int, limit: int = 65535,
               keys: list[str] = K) -> DataFrame:
    """Block means by an integer factor, trailing remainder cropped, rounded half to
    even and clipped to the integer range.  Output is one row per target pixel."""
    if isinstance(factor, bool) or not isinstance(factor, int) or factor <= 0:
        raise ValueError("downsampling factor must be a positive integer")
    out_y, out_x = height // factor, width // factor
    if out_y < 1 or out_x < 1:
        raise ValueError("image is smaller than the downsampling factor")
    # Every block of an image row is cut where target pixels begin; the pieces are summed inside the block, and
    # pieces of one target pixel that lie in several rows or blocks meet as partial sums.
    start = F.col("seg") * bits.SEGMENT
    end = F.least(start + F.size("pixel_values"), F.lit(out_x * factor))
    first, last = F.floor(start / factor), F.floor((end - 1) / factor)

    def piece(x):
        begin, stop = F.greatest(x * factor, start), F.least((x + 1) * factor, end)
        values = F.slice("pixel_values", (begin - start + 1).cast("int"), (stop - begin).cast("int"))
        seen = F.filter(values, lambda v: v.isNotNull())
        return F.struct(x.alias("x"), F.aggregate(seen, F.lit(0.0), lambda a, v: a + v).alias("s"), F.size(seen).alias("n"))

    pieces = images.where((F.col("y") < out_y * factor) & (start < end)).select(
        *keys, F.floor(F.col("y") / factor).alias("y"), F.explode(F.transform(F.sequence(first, last), piece)).alias("_p"))
    mean = F.try_divide(F.sum("_p.s"), F.sum("_p.n"))
    return pieces.groupBy(*keys, "y", F.col("_p.x").alias("x")).agg(mean.alias("_m")).select(
        *keys, "x", "y", F.greatest(F.least(F.rint("_m"), F.lit(float(limit))), F.lit(0.0)).alias("value"))


def out_of_bounds(words: DataFrame, dims: DataFrame, keys: list[str] = K) -> DataFrame:
    """Pixels per channel outside ``0 <= x < width, 0 <= y < height``."""
    inside = F.least(F.greatest(F.col("width") - F.col("seg") * bits.SEGMENT, F.lit(0).cast("long")),
                     F.lit(bits.SEGMENT).cast("long"))
    # Keep only the lowest `inside` positions of the word.
    mask = F.expr("shiftleft(1L, cast(_in as int)) - 1")
    counted = words.join(dims, "acquisition_id").withColumn("_in", inside).withColumn(
        "_out", F.when((F.col("y") < 0) | (F.col("y") >= F.col("height")) | (F.col("seg") < 0),
                       bits.size(F.col("bits")))
        .otherwise(bits.size(F.col("bits").bitwiseAND(F.bitwise_not(mask)))))
    return counted.groupBy(*keys).agg(F.sum("_out").alias("out_of_bounds_px"),
                                      F.sum(bits.size(F.col("bits"))).alias("all_px"))
