"""Centroid registration of all acquisitions at once.

Points are ``(acquisition_id, object_id, x, y)``; a transform row holds
``x' = a*x - b*y + tx, y' = b*x + a*y + ty`` per acquisition.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roispark.functions.ranking import first_rows, group_quantiles
from roispark.session import materialize, settled

# Defaults of the registration.
MATCH_GATE_UM = 25.0
ITERATIONS = 5
MIN_ANCHORS = 8
OUTLIER_MAD = 3.5
DUMMY_FACTOR = 1.01
AFFINE_MIN_IMPROVEMENT = 0.15
SEED = 42


def spatial_subsample(points: DataFrame, max_points: int = 0, seed: int = SEED,
                      keys: list[str] = ["acquisition_id"]) -> DataFrame:
    """The first point of every grid cell, then a repeatable random fill; all points unless ``max_points`` is given.

    The cell step is a min aggregate, the fill a two-level rank limit.
    """
    if max_points <= 0:
        return points
    n_side = max(2, round(max_points ** 0.5))
    box = points.groupBy(*keys).agg(
        F.min("x").alias("_x0"), F.min("y").alias("_y0"),
        F.greatest(F.max("x") - F.min("x"), F.lit(1e-9)).alias("_w"),
        F.greatest(F.max("y") - F.min("y"), F.lit(1e-9)).alias("_h"), F.count(F.lit(1)).alias("_n"))

    def cell(v, v0, span):
        return F.least(F.floor((F.col(v) - F.col(v0)) / F.col(span) * n_side), F.lit(n_side - 1).cast("long"))

    placed = points.join(box, keys).withColumn("_cx", cell("x", "_x0", "_w")).withColumn(
        "_cy", cell("y", "_y0", "_h"))
    first = placed.groupBy(*keys, "_cx", "_cy").agg(F.min("object_id").alias("object_id")).select(
        *keys, "object_id", F.lit(0).alias("_later"))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in [*keys, "object_id"]]))
    placed = placed.join(first, [*keys, "object_id"], "left").withColumn(
        "_later", F.coalesce("_later", F.lit(1))).withColumn("_digest", digest)
    return first_rows(placed, keys, ["_later", "_digest", "object_id"], max_points).select(*points.columns)


def gated_pairs(moving: DataFrame, fixed: DataFrame, gate_px: float,
                keys: list[str] = ["acquisition_id"]) -> DataFrame:
    """R2: range join by grid buckets of four gates a side: each moving point meets the buckets its gate reaches, 2.3 of
    them on average, through an equi-join on (acquisition, bucket)."""
    side = BUCKET_GATES * gate_px

    def buckets(c):
        # A hundredth more than the gate, so that rounding loses no pair that is just inside.
        return F.explode(F.sequence(F.floor((F.col(c) - 1.01 * gate_px) / side), F.floor((F.col(c) + 1.01 * gate_px) / side)))

    m = moving.select(*keys, F.col("object_id").alias("moving_id"), F.col("x").alias("mx"), F.col("y").alias("my"),
                      buckets("x").alias("_bx")).select("*", buckets("my").alias("_by"))
    f = fixed.select(*keys, F.col("object_id").alias("fixed_id"), F.col("x").alias("fx"), F.col("y").alias("fy"),
                     F.floor(F.col("x") / side).alias("_bx"), F.floor(F.col("y") / side).alias("_by"))
    d2 = (F.col("mx") - F.col("fx")) * (F.col("mx") - F.col("fx")) + (F.col("my") - F.col("fy")) * (
        F.col("my") - F.col("fy"))
    return m.join(f, [*keys, "_bx", "_by"]).withColumn("d2", d2).where(
        F.col("d2") <= gate_px * gate_px).select(
        *keys, "moving_id", "fixed_id", "mx", "my", "fx", "fy", "d2")


NOBODY = -(1 << 62)
BUCKET_GATES = 4
# Side of a tile in gates, and edges whose tiles are bid for together.
TILE_GATES = 128
_TOGETHER = 200_000
# Bidding steps as shares of the largest saving: the first, the last, and the factor between.
_STEP_FIRST, _STEP_LAST, _STEP_FACTOR = 0.15, 1e-8, 6.0
# Across tiles fewer steps: a round of jobs costs more than bids inside of a task.
_STEPS_ACROSS = [0.15, 1e-3, 1e-5, _STEP_LAST]


def _bidding_edges(pairs: DataFrame, single: float) -> DataFrame:
    """``(acquisition_id, person, object, w, x, y, ox, oy)``: who may bid for what, with both places.

    Every point is a person and an object, so that prices may start anywhere: moving points bid for fixed points of
    the gate (by the saving) or stay with themselves (saving nothing), fixed points stay with themselves or take
    the moving point that has found another partner.  Then everybody can be served, and the best assignment of all
    is the best matching.  Moving points are even numbers, fixed points odd ones.
    """
    key = "acquisition_id"
    m, f = (F.col("moving_id") * 2).alias("m"), (F.col("fixed_id") * 2 + 1).alias("f")
    real = pairs.select(key, m, f, (F.lit(single) - F.col("d2")).alias("w"), "mx", "my", "fx", "fy")
    forth = real.select(key, F.col("m").alias("person"), F.col("f").alias("object"), "w", F.col("mx").alias("x"),
                        F.col("my").alias("y"), F.col("fx").alias("ox"), F.col("fy").alias("oy"))
    back = real.select(key, F.col("f").alias("person"), F.col("m").alias("object"), F.lit(0.0).alias("w"), F.col("fx").alias("x"),
                       F.col("fy").alias("y"), F.col("mx").alias("ox"), F.col("my").alias("oy"))
    ends = forth.select(key, "person", "x", "y").unionByName(back.select(key, "person", "x", "y")).groupBy(key, "person").agg(
        F.any_value("x").alias("x"), F.any_value("y").alias("y"))
    own = ends.select(key, "person", F.col("person").alias("object"), F.lit(0.0).alias("w"), "x", "y",
                      F.col("x").alias("ox"), F.col("y").alias("oy"))
    return forth.unionByName(back).unionByName(own)


def _bid(person, thing, w, near, price, owner, steps) -> None:
    """Bidding of all unserved persons at once, until each is served or wants something far.

    ``near`` marks the edges to objects that may be taken here; far ones keep their price.  ``steps`` are the least
    raises, one after the other; but for the last one they only find prices to start from.
    """
    order = np.argsort(person, kind="stable")
    person, thing, w, near = person[order], thing[order], w[order], near[order]
    first = np.flatnonzero(np.r_[True, person[1:] != person[:-1]])
    size = np.diff(np.r_[first, len(person)])
    for step in steps:
        if len(steps) > 1:
            owner[thing[near]] = -1
        free = np.ones(len(first), bool)
        free[owner[owner >= 0]] = False
        while len(who := np.flatnonzero(free)):
            at = np.repeat(first[who] - np.r_[0, np.cumsum(size[who])[:-1]], size[who]) + np.arange(size[who].sum())
            begin = np.r_[0, np.cumsum(size[who])[:-1]]
            value = w[at] - price[thing[at]]
            best = np.maximum.reduceat(value, begin)
            top = np.flatnonzero(value == np.repeat(best, size[who]))
            row = np.repeat(np.arange(len(who)), size[who])[top]
            pick = top[np.r_[True, row[1:] != row[:-1]]] if len(top) else top
            value[pick] = -np.inf
            second = np.maximum.reduceat(value, begin)
            # A person with one edge has no other choice: any price is right, so it offers the largest raise.
            raised = np.where(np.isfinite(second), best - second, step) + step
            edge = at[pick]
            here = near[edge]
            free[who[~here]] = False
            who, edge, raised = who[here], edge[here], raised[here]
            wanted, offer = thing[edge], price[thing[edge]] + raised
            by = np.lexsort((who, -offer, wanted))
            win = by[np.r_[True, wanted[by][1:] != wanted[by][:-1]]] if len(by) else by
            before = owner[wanted[win]]
            free[before[before >= 0]] = True
            owner[wanted[win]], price[wanted[win]] = who[win], offer[win]
            free[who[win]] = False


def _first_of(*columns) -> np.ndarray:
    """True where a run of equal values begins."""
    return np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]


def _components(p, t, persons: int) -> np.ndarray:
    """The lowest person that edges ``(p, t)``, sorted by person, link to each person."""
    by_thing = np.argsort(t, kind="stable")
    first_p, first_t = np.flatnonzero(_first_of(p)), np.flatnonzero(_first_of(t[by_thing]))
    label = np.arange(persons)
    while True:
        lowest = np.minimum.reduceat(label[p[by_thing]], first_t)
        found = np.minimum.reduceat(lowest[t], first_p)
        found = found[found]
        if (found == label).all():
            return label
        label = found


def _best_edges(group, moving, fixed, d2, single: float, steps: list[float]) -> np.ndarray:
    """The edges of the matching of largest saving, as row numbers; rows are sorted by group, moving point, ``d2`` and
    fixed point.

    Where all moving points that hang together are nearest to different fixed points, or the other way round, no
    matching saves more than these pairs.  Only the rest is bid for.
    """
    p = np.cumsum(_first_of(group, moving)) - 1
    by_thing = np.lexsort((moving, d2, fixed, group))
    new = _first_of(group[by_thing], fixed[by_thing])
    t = np.empty(len(p), np.int64)
    t[by_thing] = np.cumsum(new) - 1
    persons, things = p[-1] + 1, t[by_thing[-1]] + 1
    part = _components(p, t, persons)
    of_person, of_thing = np.flatnonzero(_first_of(p)), by_thing[new]
    chosen, open_ = [], np.ones(persons, bool)
    for nearest, other, count in ((of_person, t, things), (of_thing, p, persons)):
        clash = np.bincount(other[nearest], minlength=count)[other[nearest]] > 1
        settled = np.ones(persons, bool)
        settled[part[p[nearest[clash]]]] = False
        settled = settled[part] & open_
        chosen.append(nearest[settled[p[nearest]]])
        open_ &= ~settled
    rest = np.flatnonzero(open_[p])
    if len(rest):
        # As in ``_bidding_edges``, every point is a person and an object: first the moving points, then the fixed ones.
        m, f = np.unique(p[rest], return_inverse=True)[1], np.unique(t[rest], return_inverse=True)[1]
        f = f + m.max() + 1
        own = np.arange(f.max() + 1)
        owner = np.full(len(own), -1)
        _bid(np.r_[m, f, own], np.r_[f, m, own], np.r_[single - d2[rest], np.zeros(len(f) + len(own))],
             np.ones(2 * len(f) + len(own), bool), np.zeros(len(own)), owner, steps)
        chosen.append(rest[owner[f] == m])
    return np.concatenate(chosen)


def _whole_tiles(frames, columns: list[str]):
    """The frames, sorted by ``columns``, in pieces of some ``_TOGETHER`` rows that end where ``columns`` change."""
    held = None
    for frame in frames:
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if len(held) >= _TOGETHER:
            tile = held[columns]
            start = (tile != tile.shift()).any(axis=1).to_numpy().nonzero()[0][-1]
            if start:
                yield held.iloc[:start].reset_index(drop=True)
                held = held.iloc[start:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _scaling(single: float) -> list[float]:
    few = max(2, math.ceil(math.log(_STEP_FIRST / _STEP_LAST, _STEP_FACTOR)) + 1)
    return [single * max(_STEP_LAST, _STEP_FIRST / _STEP_FACTOR ** k) for k in range(few)]


def assign_pairs(pairs: DataFrame, gate_px: float, tile_gates: int = TILE_GATES) -> DataFrame:
    """One-to-one assignment of least cost, a point may stay single.

    A pair saves ``2.02 * gate^2 - d2`` against two single points, so the optimum is a matching of the largest saving.
    An acquisition that fits into a tile of ``tile_gates`` gates a side is solved where its pairs meet; larger ones
    bid in tiles.
    """
    single = 2.0 * DUMMY_FACTOR * gate_px * gate_px
    key = "acquisition_id"
    side = tile_gates * gate_px
    pairs = materialize(pairs)
    spans = [F.greatest(F.max(f"m{c}"), F.max(f"f{c}")) - F.least(F.min(f"m{c}"), F.min(f"f{c}")) for c in "xy"]
    large = materialize(pairs.groupBy(key).agg((F.floor(F.greatest(*spans) / side) > 0).alias("_l")).where("_l").select(key))
    whole = large.isEmpty()

    def solve(frames):
        for held in _whole_tiles(frames, [key]):
            yield held.iloc[_best_edges(*(held[c].to_numpy() for c in (key, "moving_id", "fixed_id", "d2")), single, _scaling(single))]

    small = pairs if whole else pairs.join(large, key, "left_anti")
    solved = materialize(small.repartition(key).sortWithinPartitions(key, "moving_id", "d2", "fixed_id").mapInPandas(solve, pairs.schema))
    return solved if whole else solved.unionByName(_assign_in_tiles(pairs.join(large, key, "left_semi"), single, side))


def _assign_in_tiles(pairs: DataFrame, single: float, side: float) -> DataFrame:
    """``assign_pairs`` by an auction over the sparse candidate edges: unserved points raise the price of what suits them
    best, until all are served, with smaller and smaller steps; the total is within one last step per point of the optimum.

    All acquisitions bid in lockstep, one tile at a time, which knows the prices around it but sells only what lies
    inside.  Whoever wants something across the border waits for the next round, whose tiles are shifted by half a
    side, so no task sees more than a tile and prices and owners are the only state between rounds.
    """
    key = "acquisition_id"
    edges = _bidding_edges(pairs, single)
    # Tiles begin at the corner of their acquisition.
    edges = materialize(edges.join(edges.groupBy(key).agg(F.min("x").alias("x0"), F.min("y").alias("y0")), key))
    scaling = _scaling(single)
    out = "acquisition_id long, object long, price double, owner long, waiting long"

    def auction(steps):
        def serve(tiles: pd.DataFrame) -> pd.DataFrame:
            group = tiles.groupby(["acquisition_id", "tx", "ty"], sort=False).ngroup().to_numpy()
            person, people = pd.factorize(pd.MultiIndex.from_arrays([group, tiles["person"]]))
            thing, things = pd.factorize(pd.MultiIndex.from_arrays([group, tiles["object"]]))
            here = tiles.assign(thing=thing).drop_duplicates("thing").sort_values("thing")
            price, held, sold = (here[c].to_numpy(copy=True) for c in ("price", "owner", "near"))
            # Owners by number; those of another tile have none here.
            before = people.get_indexer(pd.MultiIndex.from_arrays([things.get_level_values(0), held]))
            owner = before.copy()
            _bid(person, thing, tiles["w"].to_numpy(), tiles["near"].to_numpy(), price, owner, steps)
            changed, known = owner != before, owner >= 0
            names = people.get_level_values(1).to_numpy()
            now = pd.DataFrame({
                "acquisition_id": here["acquisition_id"].to_numpy(), "object": here["object"].to_numpy(), "price": price,
                "owner": np.where(changed, np.where(known, names[owner], NOBODY), held), "waiting": 0})
            # Owners of another tile that lose their object here wait too.
            now.loc[changed & (before < 0) & (held != NOBODY), "waiting"] = 1
            unserved = np.ones(len(people), bool)
            unserved[owner[known]] = False
            first = tiles.assign(person=person).drop_duplicates("person").sort_values("person")
            more = first["acquisition_id"][unserved].value_counts()
            return pd.concat([now[sold], pd.DataFrame({
                "acquisition_id": more.index, "object": NOBODY, "price": 0.0, "owner": NOBODY, "waiting": more.to_numpy()})])

        def run(frames):
            for held in _whole_tiles(frames, ["acquisition_id", "tx", "ty"]):
                yield serve(held)
        return run

    def round_(state: DataFrame | None, steps: list[float], number: int) -> tuple[DataFrame, DataFrame]:
        """New prices and owners of the objects of ``state`` (none yet: all are free and cost nothing), and the
        acquisitions where somebody waits."""
        shift = [(0.0, 0.0), (0.5, 0.5), (0.5, 0.0), (0.0, 0.5)][number % 4]

        def tile(column, k):
            return F.floor((F.col(column) - F.col(f"{column[-1]}0")) / side + shift[k])

        met = edges.join(state, [key, "object"]) if state is not None else edges.withColumn(
            "price", F.lit(0.0)).withColumn("owner", F.lit(NOBODY))
        tiles = met.select(
            key, "person", "object", "w", "price", "owner", tile("x", 0).alias("tx"), tile("y", 1).alias("ty"),
            ((tile("x", 0) == tile("ox", 0)) & (tile("y", 1) == tile("oy", 1))).alias("near"))
        dealt = tiles.repartition(key, "tx", "ty").sortWithinPartitions(key, "tx", "ty")
        sold = materialize(dealt.mapInPandas(auction(steps), out))
        open_ = materialize(sold.where("waiting > 0").select(key).distinct())
        return sold.where(F.col("object") != NOBODY).select(key, "object", "price", "owner"), open_

    state, waiting = round_(None, scaling, 0)
    done = state.join(waiting, key, "left_anti")
    if not waiting.isEmpty():
        # Acquisitions of several tiles: each step is bid to its end everywhere before the next one begins.
        number, state = 0, state.join(waiting, key)
        for step in [single * x for x in _STEPS_ACROSS]:
            state, open_ = state.withColumn("owner", F.lit(NOBODY)), None
            while open_ is None or not open_.isEmpty():
                # A person displaced across a border shows one round later, so all acquisitions stay until nobody waits.
                state, open_ = round_(state, [step], number)
                number += 1
        done = done.unionByName(state)
    chosen = done.where("(owner & 1) = 0 AND (object & 1) = 1").select(
        key, F.shiftright("owner", 1).alias("moving_id"), F.shiftright("object", 1).alias("fixed_id"))
    return pairs.join(chosen, [key, "moving_id", "fixed_id"])


def mutual_nearest(pairs: DataFrame, keys: list[str] = ["acquisition_id"]) -> DataFrame:
    """R3 alternative without any grouping limit: both points are each other's nearest."""
    best = None
    for own, other in (("moving_id", "fixed_id"), ("fixed_id", "moving_id")):
        pick = pairs.groupBy(*keys, own).agg(F.min(F.struct("d2", other)).alias("_b")).select(
            *keys, own, F.col(f"_b.{other}").alias(other))
        best = pick if best is None else best.join(pick, [*keys, "moving_id", "fixed_id"])
    return pairs.join(best, [*keys, "moving_id", "fixed_id"])


def fit_rigid(anchors: DataFrame, min_anchors: int = MIN_ANCHORS,
              keys: list[str] = ["acquisition_id"]) -> DataFrame:
    """Least-squares rotation and shift from one aggregation per acquisition."""
    s = anchors.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("anchors"), F.avg("mx").alias("_mx"), F.avg("my").alias("_my"),
        F.avg("fx").alias("_fx"), F.avg("fy").alias("_fy"),
        (F.covar_pop("mx", "fx") + F.covar_pop("my", "fy")).alias("_dot"),
        (F.covar_pop("mx", "fy") - F.covar_pop("my", "fx")).alias("_cross"))
    size = F.hypot("_dot", "_cross")
    s = s.where(F.col("anchors") >= min_anchors).withColumn(
        "a", F.when(size > 0, F.col("_dot") / size).otherwise(F.lit(1.0))).withColumn(
        "b", F.when(size > 0, F.col("_cross") / size).otherwise(F.lit(0.0)))
    return s.select(
        *keys, "anchors", "a", "b",
        (F.col("_fx") - F.col("a") * F.col("_mx") + F.col("b") * F.col("_my")).alias("tx"),
        (F.col("_fy") - F.col("b") * F.col("_mx") - F.col("a") * F.col("_my")).alias("ty"))


def _moved(x: str, y: str):
    return (F.col("a") * F.col(x) - F.col("b") * F.col(y) + F.col("tx"),
            F.col("b") * F.col(x) + F.col("a") * F.col(y) + F.col("ty"))


def residuals(anchors: DataFrame, transform: DataFrame, keys: list[str] = ["acquisition_id"]) -> DataFrame:
    """Anchors with their transformed position and distance to the fixed point."""
    t = transform.select(*keys, "a", "b", "tx", "ty")
    x, y = _moved("mx", "my")
    return anchors.join(t, keys).withColumn("tmx", x).withColumn("tmy", y).withColumn(
        "residual_px", F.hypot(F.col("tmx") - F.col("fx"), F.col("tmy") - F.col("fy"))).drop("a", "b", "tx", "ty")


def trim_anchors(measured: DataFrame, gate_px: float, min_anchors: int = MIN_ANCHORS,
                 outlier_mad: float = OUTLIER_MAD, keys: list[str] = ["acquisition_id"]) -> DataFrame:
    """Robust cutoff from median and MAD; all anchors stay when too few would remain."""
    # One row per acquisition each, read more than once.
    mid = materialize(group_quantiles(measured, keys, "residual_px", {"_median": 0.5}))
    dev = measured.join(mid, keys).withColumn("_dev", F.abs(F.col("residual_px") - F.col("_median")))
    mad = group_quantiles(dev, keys, "_dev", {"_mad": 0.5}).join(mid, keys)
    cut = F.least(F.lit(gate_px), F.greatest(
        F.lit(0.25 * gate_px), F.col("_median") + outlier_mad * 1.4826 * F.col("_mad")))
    cuts = materialize(mad.select(*keys, cut.alias("cutoff_px")))
    out = measured.join(cuts, keys)
    enough = out.groupBy(*keys).agg((F.count_if(
        F.col("residual_px") <= F.col("cutoff_px")) >= min_anchors).alias("_enough"))
    return out.join(enough, keys).withColumn(
        "keep", (F.col("residual_px") <= F.col("cutoff_px")) | ~F.col("_enough")).drop("_enough")


def register(moving: DataFrame, fixed: DataFrame, gate_px: float, iterations: int = ITERATIONS,
             min_anchors: int = MIN_ANCHORS, max_points: int = 0, seed: int = SEED,
             shift: DataFrame | None = None, assignment: str = "optimal") -> dict[str, DataFrame]:
    """Match, fit, trim, refit, move; all iterations are composed into one transform.

    ``shift`` is an optional ``(acquisition_id, dx, dy)`` table.  Acquisitions with too
    few anchors leave the loop and do not appear in the result.  All points take part
    unless ``max_points`` asks for a subsample (R1).
    """
    key = ["acquisition_id"]
    mov = materialize(spatial_subsample(moving, max_points, seed))
    fix = materialize(spatial_subsample(fixed, max_points, seed))
    start = mov.select(*key).distinct()
    if shift is not None:
        start = start.join(shift, key, "left")
    zero = F.lit(0.0)
    state = start.select(
        *key, F.lit(1.0).alias("a"), zero.alias("b"),
        (F.coalesce("dx", zero) if shift is not None else zero).alias("tx"),
        (F.coalesce("dy", zero) if shift is not None else zero).alias("ty"))
    anchors = None
    for _ in range(iterations):
        x, y = _moved("x", "y")
        now = mov.join(state, key).select(*key, "object_id", x.alias("x"), y.alias("y"))
        pairs = gated_pairs(now, fix, gate_px)
        found = settled(lambda: mutual_nearest(pairs) if assignment == "mutual" else assign_pairs(pairs, gate_px))
        measured = residuals(found, materialize(fit_rigid(found, min_anchors)))
        kept = settled(lambda: trim_anchors(measured, gate_px, min_anchors).where("keep"))
        step = materialize(fit_rigid(kept, 1))
        anchors = residuals(kept.drop("tmx", "tmy", "residual_px"), step)
        s = step.select(*key, F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("tx").alias("_tx"),
                        F.col("ty").alias("_ty"), "anchors")
        # step after state
        state = materialize(state.drop("anchors").join(s, key).select(
            *key, "anchors", (F.col("_a") * F.col("a") - F.col("_b") * F.col("b")).alias("a"),
            (F.col("_b") * F.col("a") + F.col("_a") * F.col("b")).alias("b"),
            (F.col("_a") * F.col("tx") - F.col("_b") * F.col("ty") + F.col("_tx")).alias("tx"),
            (F.col("_b") * F.col("tx") + F.col("_a") * F.col("ty") + F.col("_ty")).alias("ty")))
    return {"transform": state, "anchors": anchors}


def fit_affine(anchors: DataFrame, keys: list[str] = ["acquisition_id"]) -> DataFrame:
    """Affine map of transformed anchors to fixed points from grouped covariances."""
    s = anchors.groupBy(*keys).agg(
        *[F.avg(c).alias(f"_{c}") for c in ("tmx", "tmy", "fx", "fy")],
        F.var_pop("tmx").alias("sxx"), F.var_pop("tmy").alias("syy"), F.covar_pop("tmx", "tmy").alias("sxy"),
        *[F.covar_pop(p, q).alias(f"{p}_{q}") for p in ("tmx", "tmy") for q in ("fx", "fy")])
    det = F.col("sxx") * F.col("syy") - F.col("sxy") * F.col("sxy")

    def coef(q, first):
        own, other, var = ("tmx", "tmy", "syy") if first else ("tmy", "tmx", "sxx")
        return F.when(det > 0, (F.col(f"{own}_{q}") * F.col(var) - F.col(f"{other}_{q}") * F.col("sxy")) / det)

    s = s.select("*", coef("fx", True).alias("a11"), coef("fx", False).alias("a12"),
                 coef("fy", True).alias("a21"), coef("fy", False).alias("a22"))
    return s.select(
        *keys, "a11", "a12", "a21", "a22",
        (F.col("_fx") - F.col("a11") * F.col("_tmx") - F.col("a12") * F.col("_tmy")).alias("shift_x"),
        (F.col("_fy") - F.col("a21") * F.col("_tmx") - F.col("a22") * F.col("_tmy")).alias("shift_y"))


def choose_model(anchors: DataFrame, affine: DataFrame, force_affine: bool = False,
                 min_improvement: float = AFFINE_MIN_IMPROVEMENT,
                 keys: list[str] = ["acquisition_id"]) -> DataFrame:
    """Affine wins when forced or when the median residual improves enough."""
    x = F.col("a11") * F.col("tmx") + F.col("a12") * F.col("tmy") + F.col("shift_x")
    y = F.col("a21") * F.col("tmx") + F.col("a22") * F.col("tmy") + F.col("shift_y")
    both = anchors.join(affine, keys).withColumn("_ra", F.hypot(x - F.col("fx"), y - F.col("fy")))
    m = group_quantiles(both, keys, "residual_px", {"rigid_median_px": 0.5}).join(
        group_quantiles(both, keys, "_ra", {"affine_median_px": 0.5}), keys)
    gain = F.when(F.col("rigid_median_px") > 0, (F.col("rigid_median_px") - F.col("affine_median_px"))
                  / F.col("rigid_median_px")).otherwise(F.lit(0.0))
    return m.withColumn("improvement", gain).withColumn("model", F.when(
        F.lit(force_affine) | (F.col("improvement") >= min_improvement), F.lit("Affine")).otherwise(F.lit("Rigid")))


def anchor_table(anchors: DataFrame, sizes: DataFrame) -> DataFrame:
    """Anchor positions with residuals in pixels and (approximately) micrometres."""
    return anchors.join(sizes, "acquisition_id").select(
        "acquisition_id", "moving_id", "fixed_id", "mx", "my", "fx", "fy", "tmx", "tmy", "residual_px",
        (F.col("residual_px") * F.sqrt(F.col("px") * F.col("py"))).alias("residual_um_approx"))


def residual_summary(anchors: DataFrame, keys: list[str] = ["acquisition_id"]) -> DataFrame:
    q = group_quantiles(anchors, keys, "residual_px", {"median_px": 0.5, "p95_px": 0.95})
    return anchors.groupBy(*keys).agg(F.count(F.lit(1)).alias("anchors")).join(q, keys)


def gate_pixels(gate_um: float, px: float, py: float) -> float:
    return gate_um / math.sqrt(px * py)
