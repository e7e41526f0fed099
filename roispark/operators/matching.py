"""Preference ranks and exact one-to-one stable matching (K1-K7).

The matching is deferred acceptance with a first-in-first-out proposer queue:
A objects propose in ascending id order, a B object changes its partner only for
a strictly higher score, and a displaced proposer joins the end of the queue.
With ties the queue order decides, so the rounds below keep it exactly: the
events of a round are ordered by ``pos``, and a loser enters the next round at
the position of the event that rejected it (one event rejects at most one A, so
positions stay unique without any global numbering).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roispark.functions import bits
from roispark.functions.ranking import ranked
from roispark.operators.overlap import objects_of_side
from roispark.schema import K, KP, PAIR
from roispark.session import materialize

# Waiting proposals of all groups beyond which the events of one B object are spread over tasks.
BLOCK = 1_000_000
# Log entries (rounds) that are merged into one.
COMPACT = 8


def preferences(edges: DataFrame, keys: list[str] = KP, score: str = "a_percent_inside_b") -> DataFrame:
    """K1: both sides rank by the same score; ties take the lower id.

    Ranks come from range-partitioned sorts, so one B object preferred by a
    third of all A objects does not become one task.
    """
    best_first = F.col(score).desc()
    a = ranked(edges, [*keys, "object_a"], [best_first, F.col("object_b")], "a_rank", "a_options")
    return ranked(a, [*keys, "object_b"], [best_first, F.col("object_a")], "b_rank", "b_options")


def stable_matching(edges: DataFrame, keys: list[str] = KP, score: str = "a_percent_inside_b",
                    block: int = BLOCK) -> DataFrame:
    """K2: matches ``(keys, object_a, object_b, score)`` for all groups in lockstep.

    Who holds a B object is a log: a round appends the B objects that changed hands.  A new holder has a strictly
    higher score than the one before, so the best entry is the latest and a round can play all of them as they are.
    Groups without proposers are left out of a round.  After ``COMPACT`` rounds the log is rewritten as its latest
    entries, so that reading it does not grow with the number of rounds.
    """
    # First choices lie in a folder of their own: the first round is a plain scan of it,
    # later rounds read only the rest.
    prefs = materialize(
        ranked(edges.select(*keys, "object_a", "object_b", F.col(score).alias("score")),
               [*keys, "object_a"], [F.col("score").desc(), F.col("object_b")],
               "rank", "options").withColumn("first_choice", F.col("rank") == 1), ["first_choice"])
    b_keys = [*keys, "object_b"]
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    columns = [*b_keys, "object_a", "score", "rank", "options"]
    first, later = (prefs.where(c).select(*columns) for c in ("first_choice", "NOT first_choice"))
    log: list[DataFrame] = []
    proposals, proposers = first.withColumn("pos", F.col("object_a")), None
    waiting = first.count()
    while waiting:
        events = proposals.select(*columns, one.alias("fresh"), "pos")
        if log:
            held = _entries(log).join(proposers.select(*keys).distinct(), keys, "left_semi")
            events = events.unionByName(held.select(*columns, zero.alias("fresh"), zero.alias("pos")))
        played = _play(events, keys, waiting > block)
        # Only what changed is written: new holders, and who must ask the next B object.
        state = materialize(played.where("fresh = 1 AND (holds OR loser.rank < loser.options)"))
        log.append(state.where("holds").select(*columns))
        if len(log) == COMPACT:
            log = [materialize(_latest(log, b_keys))]
        proposers = state.where("loser.rank < loser.options").select(
            *keys, F.col("loser.object_a").alias("object_a"), (F.col("loser.rank") + 1).alias("rank"), "pos")
        waiting = proposers.count()
        proposals = later.join(proposers, [*keys, "object_a", "rank"])
    if not log:
        return prefs.select(*keys, "object_a", "object_b", "score")
    return _latest(log, b_keys).select(*keys, "object_a", "object_b", "score")


def _entries(log: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, log)


def _latest(log: list[DataFrame], b_keys: list[str]) -> DataFrame:
    """The latest log entry of every B object: the one with the highest score."""
    entries = _entries(log)
    rest = [c for c in entries.columns if c not in (*b_keys, "score")]
    return entries.groupBy(*b_keys).agg(F.max(F.struct("score", *rest)).alias("_last")).select(
        *b_keys, *[F.col(f"_last.{c}").alias(c) for c in ("score", *rest)])


def _play(events: DataFrame, keys: list[str], spread: bool) -> DataFrame:
    """One round: mark the event that ends up held per B and the loser of every event.

    ``spread`` splits the events of one B object: a range-partitioned sort by position deals them out in as many
    pieces as the rows need, whatever the ids are; the running best is taken inside pieces and over their maxima,
    so a B object that receives a third of all proposals lies in many tasks.
    """
    b_keys = [*keys, "object_b"]
    entry = F.struct("object_a", "rank", "options")
    # Higher score wins; among equals the incumbent, then the earliest event.
    standing = F.struct(F.col("score"), (-F.col("fresh")).alias("_held"), (-F.col("pos")).alias("_early"),
                        entry.alias("who"))
    before = (Window.unboundedPreceding, -1)
    if not spread:
        group = Window.partitionBy(*b_keys)
        events = events.withColumn("_standing", standing).withColumn(
            "_prev", F.max("_standing").over(group.orderBy("fresh", "pos").rowsBetween(*before))
        ).withColumn("_best", F.max("_standing").over(group))
    else:
        # Written, so that the piece of an event is the same in all passes.
        events = materialize(events.repartitionByRange(*b_keys, "fresh", "pos").withColumn(
            "_piece", F.spark_partition_id())).withColumn("_standing", standing)
        tops = events.groupBy(*b_keys, "_piece").agg(F.max("_standing").alias("_top"))
        per_b = Window.partitionBy(*b_keys)
        tops = tops.select(
            *b_keys, "_piece",
            F.max("_top").over(per_b.orderBy("_piece").rowsBetween(*before)).alias("_before"),
            F.max("_top").over(per_b).alias("_best"))
        inside = Window.partitionBy(*b_keys, "_piece").orderBy("fresh", "pos").rowsBetween(*before)
        events = events.withColumn("_inside", F.max("_standing").over(inside)).join(
            tops, [*b_keys, "_piece"]
        ).withColumn("_prev", F.greatest("_inside", "_before"))
    loser = F.when(F.col("_prev").isNull(), F.lit(None)).when(
        F.col("score") > F.col("_prev.score"), F.col("_prev.who")).otherwise(entry)
    return events.select(
        *b_keys, "object_a", "score", "rank", "options", "fresh", "pos",
        F.when(F.col("fresh") == 1, loser).alias("loser"),
        (F.col("_standing") == F.col("_best")).alias("holds"))


def match_table(matches: DataFrame, overlap: DataFrame, prefs: DataFrame) -> DataFrame:
    """K3: matched pairs with areas, shared pixels, percentages and both ranks."""
    return (
        matches.select(*PAIR)
        .join(overlap.select(*PAIR, "shared_area", "a_area", "b_area", "a_percent_inside_b",
                             "b_percent_inside_a", "eligible"), PAIR)
        .join(prefs.select(*PAIR, "a_rank", "b_rank"), PAIR)
        .withColumnRenamed("eligible", "pass_threshold")
    )


def cell_ids(matches: DataFrame, keys: list[str] = KP) -> DataFrame:
    """K4: cell ids 1..n per run in (A, B) order."""
    return ranked(matches.select(*keys, "object_a", "object_b"), keys,
                  ["object_a", "object_b"], "cell_id", None)


def matched_words(words: DataFrame, cells: DataFrame, own: str) -> DataFrame:
    """Bit-row words of matched objects with their cell id (the compact form of K5)."""
    ids = cells.select(
        *KP, F.col(f"object_{own}").alias("object_id"), F.col(f"channel_{own}").alias("channel"),
        "cell_id")
    return words.join(ids, [*K, "object_id"]).select(
        *KP, "cell_id", "object_id", "y", "seg", "bits")


def matched_word_pixels(words: DataFrame, cells: DataFrame, own: str) -> DataFrame:
    """K5 from words: what meets the cells are words, pixels are made afterwards."""
    return bits.unpack(matched_words(words, cells, own), ["cell_id", *KP, "object_id"])


def matched_pixels(pixels: DataFrame, cells: DataFrame, own: str) -> DataFrame:
    """K5: pixel rows of matched objects, cell id first, original columns kept."""
    rest = [c for c in pixels.columns if c not in (*K, "object_id")]
    ids = cells.select(
        *KP, F.col(f"object_{own}").alias("object_id"), F.col(f"channel_{own}").alias("channel"),
        "cell_id")
    return pixels.join(ids, [*K, "object_id"]).select("cell_id", *KP, *rest)


def side_counts(areas: DataFrame, overlap: DataFrame, matches: DataFrame, pairs: list[tuple]) -> DataFrame:
    """Objects per run and side at each stage: all, overlapping, eligible, matched.

    One row per (run, object) is formed first; the counts then combine map-side.
    """
    sides = None
    for s in ("a", "b"):
        col = f"object_{s}"
        ids = objects_of_side(areas, pairs, s).withColumnRenamed(col, "object_id")
        seen = overlap.groupBy(*KP, F.col(col).alias("object_id")).agg(
            F.max(F.col("eligible").cast("int")).alias("_eligible"))
        got = matches.select(*KP, F.col(col).alias("object_id"), F.lit(1).alias("_matched"))
        part = (
            ids.join(seen, [*KP, "object_id"], "left").join(got, [*KP, "object_id"], "left")
            .groupBy(*KP).agg(
                F.count(F.lit(1)).alias("total"),
                F.count("_eligible").alias("overlapping"),
                F.coalesce(F.sum("_eligible"), F.lit(0)).cast("long").alias("eligible"),
                F.count("_matched").alias("matched"))
            .withColumn("side", F.lit(s))
        )
        sides = part if sides is None else sides.unionByName(part)
    return sides


def stage_counts(counts: DataFrame, threshold: float, constrained: bool = False) -> DataFrame:
    """K7: long table of the filtering stages per marker."""
    # Stage labels.
    tail = " and same canonical nucleus" if constrained else ""
    labels = {
        "total": "All segmented objects",
        "overlapping": "At least one overlapping partner",
        "eligible": f"Participating in eligible pair (A >= {threshold * 100:.0f}% inside B{tail})",
        "matched": "Final one-to-one matched objects",
    }
    stages = F.array(*[F.struct(F.lit(text).alias("stage"), F.col(c).alias("count"))
                       for c, text in labels.items()])
    marker = F.when(F.col("side") == "a", F.col("channel_a")).otherwise(F.col("channel_b"))
    return counts.select(*KP, marker.alias("marker"), F.explode(stages).alias("_s")).select(
        *KP, "marker", "_s.*")


def run_summary(counts: DataFrame, organoid_area: DataFrame, sizes: DataFrame,
                constrained: bool = False) -> DataFrame:
    """K6: fourteen metric / value / unit rows per run; densities need a positive area."""
    def pick(s, c):
        return F.max(F.when(F.col("side") == s, F.col(c))).cast("double").alias(f"{s}_{c}")

    one = counts.groupBy(*KP).agg(*[pick(s, c) for s in "ab" for c in ("total", "eligible", "matched")])
    one = one.join(organoid_area, "acquisition_id", "left").join(sizes, "acquisition_id")
    mm2 = F.col("organoid_area_px") * F.col("px") * F.col("py") / 1e6
    one = one.withColumn("_mm2", mm2)

    def density(c):
        return F.when(F.col("_mm2") > 0, F.col(c) / F.col("_mm2"))

    def share(m, t):
        return F.when(F.col(t) > 0, F.col(m) / F.col(t))

    # Metric and unit labels.
    a, b = F.col("channel_a").cast("string"), F.col("channel_b").cast("string")
    rest = " objects without a constrained-eligible partner" if constrained else " objects below threshold"
    rows = [
        (F.concat(F.lit("Total "), a, F.lit(" objects")), F.col("a_total"), "objects"),
        (F.concat(F.lit("Matched "), a, F.lit(" objects")), F.col("a_matched"), "objects"),
        (F.concat(F.lit("Proportion of "), a, F.lit(" objects matched")),
         share("a_matched", "a_total"), "fraction"),
        (F.concat(F.lit("Total "), b, F.lit(" objects")), F.col("b_total"), "objects"),
        (F.concat(F.lit("Matched "), b, F.lit(" objects")), F.col("b_matched"), "objects"),
        (F.concat(F.lit("Proportion of "), b, F.lit(" objects matched")),
         share("b_matched", "b_total"), "fraction"),
        (F.lit("Matched CellIDs"), F.col("a_matched"), "cells"),
        (F.concat(a, F.lit(rest)), F.col("a_total") - F.col("a_eligible"), "objects"),
        (F.lit("Organoid area"), F.col("organoid_area_px"), "pixels"),
        (F.lit("Organoid area"), F.col("_mm2"), "mm^2"),
        (F.concat(a, F.lit(" density")), density("a_total"), "objects/mm^2"),
        (F.concat(b, F.lit(" density")), density("b_total"), "objects/mm^2"),
        (F.concat(F.lit("Matched "), a, F.lit(" density")), density("a_matched"), "objects/mm^2"),
        (F.concat(F.lit("Matched "), b, F.lit(" density")), density("b_matched"), "objects/mm^2"),
    ]
    packed = F.array(*[F.struct(m.alias("metric"), v.cast("double").alias("value"),
                                F.lit(u).alias("units")) for m, v, u in rows])
    return one.select(*KP, F.explode(packed).alias("_r")).select(*KP, "_r.*")
