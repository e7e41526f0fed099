"""Connected components on Spark, and the run graph of a mask."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roispark.functions import bits
from roispark.session import materialize


def connected_components(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Component of every node that has an edge: ``(keys, node, component)``.

    Randomised contraction: every node points to the neighbour (or itself) with
    the smallest hash, pointers are followed three steps, and the edges are
    rewritten between the targets.  Merging along pointers keeps connectivity, so
    the remaining graph is a contraction of the old one; its size shrinks
    geometrically and the number of rounds is logarithmic also for long chains.
    No neighbour list is ever collected: a hub costs aggregated rows only, and
    its join key is split by adaptive skew handling.
    """
    edges = materialize(edges.select(*keys, "u", "v").where("u <> v").distinct())
    maps = []
    round_no = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        rank_u = F.struct(F.xxhash64("u", F.lit(round_no)).alias("h"), F.col("u").alias("id"))
        rank_v = F.struct(F.xxhash64("v", F.lit(round_no)).alias("h"), F.col("v").alias("id"))
        parent = both.groupBy(*keys, "u").agg(F.min(F.least(rank_u, rank_v)).alias("_p")).select(
            *keys, F.col("u").alias("node"), F.col("_p.id").alias("target"))
        hop = parent.select(*keys, F.col("node").alias("target"), F.col("target").alias("_next"))
        for _ in range(2):
            parent = parent.join(hop, [*keys, "target"]).select(*keys, "node", F.col("_next").alias("target"))
        parent = materialize(parent)
        maps.append(parent)
        end = {c: parent.select(*keys, F.col("node").alias(c), F.col("target").alias(f"_{c}")) for c in "uv"}
        edges = materialize(
            edges.join(end["u"], [*keys, "u"]).join(end["v"], [*keys, "v"])
            .select(*keys, F.least("_u", "_v").alias("u"), F.greatest("_u", "_v").alias("v"))
            .where("u <> v").distinct())
        round_no += 1
    if not maps:
        return edges.select(*keys, F.col("u").alias("node"), F.col("u").alias("component"))
    label = maps[-1]
    for step in reversed(maps[:-1]):
        later = label.select(*keys, F.col("node").alias("target"), F.col("target").alias("_final"))
        label = step.join(later, [*keys, "target"], "left").select(
            *keys, "node", F.coalesce("_final", "target").alias("target"))
    label = materialize(label)
    names = label.groupBy(*keys, "target").agg(F.min("node").alias("component"))
    return label.join(names, [*keys, "target"]).select(*keys, "node", "component")


def mask_runs(words: DataFrame, keys: list[str]) -> DataFrame:
    """Horizontal runs inside each word: ``(keys, y, seg, node, x0, x1)``."""
    b = F.col("bits")
    starts = b.bitwiseAND(F.bitwise_not(F.shiftleft(b, 1)))
    ends = b.bitwiseAND(F.bitwise_not(F.shiftright(b, 1)))
    runs = words.select(*keys, "y", "seg", starts.alias("_s"), ends.alias("_e")).select(
        *keys, "y", "seg", F.expr(
            "explode_outer(arrays_zip(filter(sequence(0, 31), i -> getbit(_s, i) = 1), "
            "filter(sequence(0, 31), i -> getbit(_e, i) = 1)))").alias("_r"))
    return runs.select(
        *keys, "y", "seg",
        (F.shiftleft("y", 32) + F.col("seg") * bits.SEGMENT + F.col("_r")["0"]).alias("node"),
        (F.col("seg") * bits.SEGMENT + F.col("_r")["0"]).alias("x0"),
        (F.col("seg") * bits.SEGMENT + F.col("_r")["1"]).alias("x1"))


def run_edges(runs: DataFrame, keys: list[str]) -> DataFrame:
    """4-neighbour contacts of runs: below in the same segment, or across the seam.

    A segment row holds at most 16 runs, so each join key meets at most 16 x 16 rows.
    """
    last = bits.SEGMENT - 1
    below = runs.select(*keys, (F.col("y") - 1).alias("y"), "seg", F.col("node").alias("v"),
                        F.col("x0").alias("_x0"), F.col("x1").alias("_x1"))
    down = runs.join(below, [*keys, "y", "seg"]).where("x0 <= _x1 AND _x0 <= x1").select(
        *keys, F.col("node").alias("u"), "v")
    right = runs.where(f"x0 & {last} = 0").select(
        *keys, "y", (F.col("seg") - 1).alias("seg"), F.col("node").alias("v"))
    seam = runs.where(f"x1 & {last} = {last}").join(right, [*keys, "y", "seg"]).select(
        *keys, F.col("node").alias("u"), "v")
    return down.unionByName(seam)


def mask_components(words: DataFrame, keys: list[str]) -> DataFrame:
    """4-connected components of each mask with their area."""
    runs = materialize(mask_runs(words, keys))
    labels = connected_components(run_edges(runs, keys), keys)
    return (
        runs.join(labels, [*keys, "node"], "left")
        .groupBy(*keys, F.coalesce("component", "node").alias("component"))
        .agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("area_px"))
    )
