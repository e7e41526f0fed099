"""Per-object intensity and shape metrics (M1-M11) from bit-row words."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.functions import bits
from roispark.schema import OBJ


BAND_BITS = 4


def pixel_values(words: DataFrame, images: DataFrame, keep: list[str],
                 signal: str = "channel") -> DataFrame:
    """``(keep, v, narrow)``: the valid image values under every pixel set as lists, one per set and 16 x 32 pixels of the image.

    Words and images meet by these places, so that what lies together of a set is one list before it moves.  Places
    outside of the image and values that are not finite are left out; a set without any valid pixel keeps a list.  The
    merge hint keeps the images, whose size is guessed from what they were derived from, out of the driver.
    ``narrow`` holds what fits into 16 bits, half the bytes, and ``v`` is null then.  ``signal`` names the channel to look at, or a list of channels: then it holds the one that was met.  Images dealt
    by acquisition, ``band`` (16 image rows) and segment move no more.
    """
    place = ["acquisition_id", "_band", "seg"]
    band = F.col("band") if "band" in images.columns else F.shiftright(F.col("y").cast("long"), BAND_BITS)
    img = images.select("acquisition_id", band.alias("_band"), "seg", F.col("y").alias("_y"), F.col("channel").alias("_signal"), "pixel_values")
    several = isinstance(words.schema[signal].dataType, T.ArrayType)
    asked = F.col(signal) if several else F.array(signal)
    # Not as comparisons, which would become keys of the join.
    here = (F.col("y") - F.col("_y") == 0) & F.array_contains(asked, F.col("_signal"))
    met = words.withColumn("_band", F.shiftright(F.col("y").cast("long"), BAND_BITS)).join(img.hint("merge"), place).where(here)
    b = F.col("bits")
    under = F.transform(F.sequence(bits.lowest(b).cast("int"), bits.highest(b).cast("int")),
                        lambda i: F.when(F.getbit(b, i) == 1, F.get("pixel_values", i)))
    valid = F.filter(under, lambda v: F.abs(v.cast("double")) < float("inf"))
    named = [F.col("_signal").alias(c) if several and c == signal else F.col(c) for c in keep]
    lists = met.select(*named, *place[1:], *([] if "acquisition_id" in keep else place[:1]), valid.alias("v")).groupBy(
        *dict.fromkeys([*keep, *place])).agg(F.flatten(F.collect_list("v")).alias("v"))
    fits = F.forall("v", lambda v: (v >= 0) & (v < 1 << 16) & (v == F.floor(v)))
    return lists.withColumn("_fits", fits).select(
        *keep, F.when(~F.col("_fits"), F.col("v")).alias("v"),
        F.when(F.col("_fits"), F.transform("v", lambda v: (v - (1 << 15)).cast("short"))).alias("narrow"))


def whole_values(lists: DataFrame):
    """The values of ``pixel_values`` as they were."""
    kind = lists.schema["v"].dataType.elementType
    return F.coalesce("v", F.transform("narrow", lambda v: (v.cast("int") + (1 << 15)).cast(kind)))


def intensity_stats(words: DataFrame, images: DataFrame, keys: list[str],
                    signal: str = "channel") -> DataFrame:
    """M1/M2: mean, median, population SD, min, P05, P95, max, sum under each pixel set.

    The values of a set, at most those of an image, are gathered and sorted once, for the exact quantiles.  A set
    without any valid pixel keeps a row of nulls.
    """
    lists = pixel_values(words, images, keys, signal)
    one = lists.repartition(*keys).groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list(whole_values(lists)))).alias("_v"))
    some = F.col("measured_px") > 0
    one = one.withColumn("measured_px", F.size("_v").cast("long")).withColumn("integrated_intensity", F.when(some, F.aggregate(
        "_v", F.lit(0.0), lambda total, v: total + v.cast("double")))).withColumn(
        "mean_intensity", F.col("integrated_intensity") / F.col("measured_px"))
    squares = F.aggregate("_v", F.lit(0.0), lambda total, v: total + (v.cast("double") - F.col("mean_intensity")) * (
        v.cast("double") - F.col("mean_intensity")))

    def quantile(share: float):
        at = (F.col("measured_px") - 1) * F.lit(share)
        low, high = (F.get("_v", k(at).cast("int")).cast("double") for k in (F.floor, F.ceil))
        return F.when(F.floor(at) == F.ceil(at), low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)

    return one.select(
        *keys, "mean_intensity", quantile(0.5).alias("median_intensity"),
        F.when(some, F.sqrt(squares / F.col("measured_px"))).alias("intensity_sd"),
        F.get("_v", F.lit(0)).cast("double").alias("min_intensity"), quantile(0.05).alias("p05_intensity"),
        quantile(0.95).alias("p95_intensity"), F.get("_v", (F.col("measured_px") - 1).cast("int")).cast("double").alias("max_intensity"),
        "integrated_intensity", "measured_px")


def object_areas(words: DataFrame, keys: list[str] = OBJ) -> DataFrame:
    """M3: pixels per object (whole object, not only an overlap)."""
    return words.groupBy(*keys).agg(F.sum(bits.size(F.col("bits"))).alias("area_px"))


def hull_area(ys, lows, highs):
    """M6 helper: hull area over pixel centres from row extremes; null when degenerate.

    All objects of an Arrow batch are handled together: points are sorted per
    object, and a point on or inside the line between its current neighbours
    cannot be a hull vertex, so all such points are dropped at once until none is
    left (lower and upper chain separately).
    """
    def chain_sum(obj, x, y, sign):
        while True:
            same = (obj[2:] == obj[:-2])
            turn = (x[1:-1] - x[:-2]) * (y[2:] - y[:-2]) - (y[1:-1] - y[:-2]) * (x[2:] - x[:-2])
            drop = np.zeros(len(obj), dtype=bool)
            drop[1:-1] = same & (sign * turn <= 0)
            if not drop.any():
                break
            obj, x, y = obj[~drop], x[~drop], y[~drop]
        edge = obj[1:] == obj[:-1]
        return obj[1:][edge], sign * (x[:-1] * y[1:] - y[:-1] * x[1:])[edge]

    def area(y: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
        count = len(y)
        if count == 0:
            return pd.Series([], dtype="float64")
        owner = np.repeat(np.arange(count), [len(v) for v in y])
        rows = np.concatenate(y.to_numpy()).astype(np.int64)
        xs = np.concatenate([np.concatenate(lo.to_numpy()), np.concatenate(hi.to_numpy())]).astype(np.int64)
        obj, yy = np.concatenate([owner, owner]), np.concatenate([rows, rows])
        order = np.lexsort((yy, xs, obj))
        obj, xs, yy = obj[order], xs[order], yy[order]
        fresh = np.ones(len(obj), dtype=bool)
        fresh[1:] = (obj[1:] != obj[:-1]) | (xs[1:] != xs[:-1]) | (yy[1:] != yy[:-1])
        obj, xs, yy = obj[fresh], xs[fresh], yy[fresh]
        twice = np.zeros(count, dtype=np.int64)
        for sign in (1, -1):
            at, part = chain_sum(obj, xs, yy, sign)
            np.add.at(twice, at, part)
        return pd.Series(np.where(twice > 0, twice / 2.0, np.nan))

    hull = F.pandas_udf(area, T.DoubleType())(ys, lows, highs)
    return F.when(~F.isnan(hull), hull)


def shape_sums(words: DataFrame, keys: list[str] = OBJ) -> DataFrame:
    """One exchange by object: adjacency counts, bounding box, moments, row extremes.

    An object has at most image-height x image-width / 32 words, so neither the
    windows nor the extreme lists can grow beyond one image.
    """
    b = F.col("bits")
    near = bits.neighbour_words(words.repartition(*keys), keys)
    n = bits.size(b)
    base = F.col("seg") * bits.SEGMENT
    prepared = near.select(
        *keys, "y",
        n.alias("n"),
        bits.horizontal_pairs(b, F.col("bits_left")).alias("h"),
        bits.size(b.bitwiseAND(F.col("bits_up"))).alias("v"),
        (base + bits.lowest(b)).alias("lo"),
        (base + bits.highest(b)).alias("hi"),
        (base * n + bits.position_sum(b)).alias("sx"),
        (base * base * n + base * 2 * bits.position_sum(b)
         + bits.position_square_sum(b)).alias("sxx"),
    )
    y = F.col("y")
    return prepared.groupBy(*keys).agg(
        F.sum("n").alias("area_px"),
        F.sum("h").alias("h_pairs"),
        F.sum("v").alias("v_pairs"),
        F.min("lo").alias("min_x"), F.max("hi").alias("max_x"),
        F.min("y").alias("min_y"), F.max("y").alias("max_y"),
        F.sum("sx").alias("sum_x"), F.sum("sxx").alias("sum_xx"),
        F.sum(y * F.col("n")).alias("sum_y"), F.sum(y * y * F.col("n")).alias("sum_yy"),
        F.sum(y * F.col("sx")).alias("sum_xy"),
        F.collect_list("y").alias("_rows"), F.collect_list("lo").alias("_lows"),
        F.collect_list("hi").alias("_highs"),
    )


def shape_metrics(words: DataFrame, sizes: DataFrame, keys: list[str] = OBJ, beside: DataFrame | None = None) -> DataFrame:
    """M3-M10 for every object; ``sizes`` is ``(acquisition_id, px, py)`` in micrometres.

    Columns nobody selects are pruned, so a caller that needs no hull pays
    neither for the extreme lists nor for the Python worker.  ``beside`` has more columns of the objects; it is joined
    where their words were dealt, since what comes from the Python worker would be dealt again.
    """
    s = shape_sums(words, keys)
    more = [] if beside is None else [c for c in beside.columns if c not in keys]
    if more:
        s = s.join(beside, keys, "left")
    s = s.join(sizes, "acquisition_id")

    def wide(c):
        return F.col(c).cast("decimal(20,0)")

    def spread(nn, ab, a, b):
        # n * sum(ab) - sum(a) * sum(b), exact, then to double
        return (wide(nn) * wide(ab) - wide(a) * wide(b)).cast("double")

    n = F.col("area_px").cast("double")
    s = s.select(
        "*",
        (F.col("area_px") * F.col("px") * F.col("py")).alias("area_um2"),
        ((F.col("max_x") - F.col("min_x") + 1) * (F.col("max_y") - F.col("min_y") + 1)).alias("bbox_px"),
        (F.col("sum_x") / n).alias("center_x"), (F.col("sum_y") / n).alias("center_y"),
        (2 * (F.col("area_px") - F.col("v_pairs")) * F.col("px")
         + 2 * (F.col("area_px") - F.col("h_pairs")) * F.col("py")).alias("perimeter_um"),
        (hull_area("_rows", "_lows", "_highs") * F.col("px") * F.col("py")).alias("convex_hull_area_um2"),
        spread("area_px", "sum_xx", "sum_x", "sum_x").alias("_vx"),
        spread("area_px", "sum_yy", "sum_y", "sum_y").alias("_vy"),
        spread("area_px", "sum_xy", "sum_x", "sum_y").alias("_c"),
    )
    # Equal exact products round to equal doubles, so collinear pixel sets give exactly 0.
    flat = F.col("_vx") * F.col("_vy") == F.col("_c") * F.col("_c")
    s = s.select(
        "*",
        (F.col("_vx") / (n * n) * F.col("px") * F.col("px")).alias("_a"),
        (F.col("_vy") / (n * n) * F.col("py") * F.col("py")).alias("_d"),
        (F.col("_c") / (n * n) * F.col("px") * F.col("py")).alias("_b"),
    )
    half = (F.col("_a") + F.col("_d")) / 2
    root = F.sqrt(F.pow((F.col("_a") - F.col("_d")) / 2, F.lit(2.0)) + F.col("_b") * F.col("_b"))
    s = s.select(
        "*",
        F.when(F.col("area_px") >= 2, half + root).alias("_l1"),
        F.when(F.col("area_px") >= 2,
               F.when(flat, F.lit(0.0)).otherwise(F.greatest(half - root, F.lit(0.0)))).alias("_l2"),
    )
    l1, l2 = F.col("_l1"), F.col("_l2")
    hull = F.col("convex_hull_area_um2")
    return s.select(
        *keys, "area_px", "area_um2", "min_x", "max_x", "min_y", "max_y", "center_x", "center_y",
        (F.col("area_px") / F.col("bbox_px")).alias("extent"),
        "perimeter_um", "h_pairs", "v_pairs", hull,
        F.when(hull > 0, F.col("area_um2") / hull).otherwise(F.lit(1.0)).alias("solidity"),
        F.when(F.col("perimeter_um") > 0, 4 * math.pi * F.col("area_um2")
               / F.pow("perimeter_um", F.lit(2.0))).alias("circularity"),
        F.when(l1 > 0, F.sqrt(F.greatest(1 - l2 / l1, F.lit(0.0))))
        .when(l1 <= 0, F.lit(0.0)).alias("eccentricity"),
        (4 * F.sqrt(l1)).alias("major_axis_um"), (4 * F.sqrt(l2)).alias("minor_axis_um"),
        F.when(l2 > 0, F.sqrt(l1) / F.sqrt(l2)).alias("aspect_ratio"),
        F.sqrt(4 * F.col("area_um2") / math.pi).alias("equivalent_diameter_um"), *more,
    )


def roi_metrics(words: DataFrame, images: DataFrame, sizes: DataFrame) -> DataFrame:
    """Intensity and shape of every object in one row."""
    intensity = intensity_stats(words, images, OBJ)
    return shape_metrics(words, sizes, OBJ, intensity)
