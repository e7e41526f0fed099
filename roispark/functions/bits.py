"""Bit-row layout of pixel sets.

A pixel set is stored as one row per (keys, y, 32-pixel segment) with a 32-bit
occupancy word in a long.  Packing is a map-side-combinable ``bit_or`` that also
removes duplicate pixels, so what is shuffled is words, not pixels; set algebra
on pixels becomes ``&``, ``|``, ``~`` and ``bit_count`` inside code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 32
FULL = (1 << SEGMENT) - 1
_SHIFT = 5
_POSITION_MASKS = [0xAAAAAAAA, 0xCCCCCCCC, 0xF0F0F0F0, 0xFF00FF00, 0xFFFF0000]


def pack(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels ``(keys, x, y)`` to words ``(keys, y, seg, bits)``; duplicates vanish."""
    return pixels.groupBy(
        *keys,
        F.col("y").cast("long").alias("y"),
        F.shiftright(F.col("x").cast("long"), _SHIFT).alias("seg"),
    ).agg(F.bit_or(F.expr("shiftleft(1L, cast(x & 31 as int))")).alias("bits"))


def merge(words: DataFrame, keys: list[str]) -> DataFrame:
    """Union of the words that share ``keys`` (for instance all objects of a channel)."""
    return words.groupBy(*keys, "y", "seg").agg(F.bit_or("bits").alias("bits"))


def unpack(words: DataFrame, keep: list[str]) -> DataFrame:
    """Words back to one row per pixel, with ``keep`` carried along."""
    b = F.col("bits")
    # The outer form keeps Spark from evaluating the bounds a second time in a filter.
    spread = words.select(*keep, "y", "seg", "bits", F.explode_outer(
        F.sequence(lowest(b).cast("int"), highest(b).cast("int"))).alias("_i"))
    return spread.where("getbit(bits, _i) = 1").select(
        *keep, (F.col("seg") * SEGMENT + F.col("_i")).alias("x"), "y")


def size(bits: Column) -> Column:
    return F.bit_count(bits).cast("long")


def lowest(bits: Column) -> Column:
    """Position of the lowest set bit."""
    return F.bit_count(bits.bitwiseAND(-bits) - F.lit(1).cast("long")).cast("long")


def highest(bits: Column) -> Column:
    """Position of the highest set bit (smear right, then count)."""
    smeared = reduce(lambda a, k: a.bitwiseOR(F.shiftright(bits, k)), range(1, SEGMENT), bits)
    return F.bit_count(smeared).cast("long") - 1


def position_sum(bits: Column) -> Column:
    """Sum of the set positions, from the five position bit planes."""
    return reduce(
        lambda a, b: a + b,
        [size(bits.bitwiseAND(F.lit(m))) * (1 << i) for i, m in enumerate(_POSITION_MASKS)],
    )


def position_square_sum(bits: Column) -> Column:
    """Sum of the squared set positions, from pairs of bit planes."""
    terms = []
    for i, mi in enumerate(_POSITION_MASKS):
        terms.append(size(bits.bitwiseAND(F.lit(mi))) * (1 << (2 * i)))
        for j in range(i + 1, len(_POSITION_MASKS)):
            both = mi & _POSITION_MASKS[j]
            terms.append(size(bits.bitwiseAND(F.lit(both))) * (1 << (i + j + 1)))
    return reduce(lambda a, b: a + b, terms)


def neighbour_words(words: DataFrame, keys: list[str], both: bool = False) -> DataFrame:
    """Add the words left of and above each word (and right/below with ``both``).

    The windows are partitioned by one image row or one 32-pixel column of one
    object, so no window group can exceed an image side.  When the input is
    already partitioned by ``keys`` neither window needs an exchange.
    """
    row = Window.partitionBy(*keys, "y").orderBy("seg")
    col = Window.partitionBy(*keys, "seg").orderBy("y")

    def near(fn, window, axis, step):
        hit = fn(axis).over(window) == F.col(axis) + step
        return F.when(hit, fn("bits").over(window)).otherwise(F.lit(0).cast("long"))

    out = words.withColumn("bits_left", near(F.lag, row, "seg", -1))
    if both:
        out = out.withColumn("bits_right", near(F.lead, row, "seg", 1))
    out = out.withColumn("bits_up", near(F.lag, col, "y", -1))
    if both:
        out = out.withColumn("bits_down", near(F.lead, col, "y", 1))
    return out


def horizontal_pairs(bits: Column, left: Column) -> Column:
    """Adjacent pixel pairs inside the word plus the one across the left seam."""
    inside = size(bits.bitwiseAND(F.shiftright(bits, 1)))
    seam = bits.bitwiseAND(F.lit(1)).bitwiseAND(F.shiftright(left, SEGMENT - 1))
    return inside + seam
