import math
import random

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from roispark.functions import bits
from roispark.operators import bins, gates, graph, labels, maskqc, metrics, overlap
from roispark.schema import (AnalysisConfig, INTENSITY_METRICS, OBJ, Rule, SHAPE_METRICS, validate_pairs, validate_rules,
                             validate_threshold)

PX, PY = 0.5, 0.25


def frame(spark, objects):
    data = [("q", "c", o, x, y) for o, px in objects.items() for x, y in px]
    return spark.createDataFrame(data, "acquisition_id string, channel string, object_id long, x long, y long")


def sizes(spark):
    return spark.createDataFrame([("q", PX, PY)], "acquisition_id string, px double, py double")


def shapes(spark, objects):
    out = metrics.shape_metrics(bits.pack(frame(spark, objects), OBJ), sizes(spark))
    return {r.object_id: r for r in out.collect()}


def test_shape_goldens(spark):
    ring = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    got = shapes(spark, {1: [(5, 5)], 2: [(x, 7) for x in range(5)], 3: [(i, i) for i in range(5)],
                         4: [(30, 0), (31, 0), (30, 1), (31, 1)], 5: ring, 6: [(31, 0), (32, 0), (31, 1), (32, 1)]})
    assert got[1].eccentricity is None and got[1].convex_hull_area_um2 is None and got[1].solidity == 1.0
    for o in (2, 3):
        assert got[o].minor_axis_um == 0.0 and got[o].aspect_ratio is None and got[o].solidity == 1.0
    for o in (4, 6):  # the second one straddles a word seam
        assert got[o].solidity == pytest.approx(4.0) and got[o].extent == 1.0
        assert got[o].perimeter_um == pytest.approx(4 * PX + 4 * PY)
    assert got[5].perimeter_um == pytest.approx(8 * PX + 8 * PY)
    assert got[1].perimeter_um == pytest.approx(2 * PX + 2 * PY)


def test_shape_against_brute_force(spark):
    rng = random.Random(5)
    objects = {}
    for o in range(1, 60):
        x0, y0, w, h = rng.randint(-40, 90), rng.randint(0, 50), rng.randint(1, 45), rng.randint(1, 12)
        px = {(x0 + i, y0 + j) for i in range(w) for j in range(h) if rng.random() < 0.6}
        objects[o] = sorted(px) or [(x0, y0)]
    got = shapes(spark, objects)
    for o, px in objects.items():
        cells, r = set(px), got[o]
        n = len(px)
        a = np.array(px, dtype=float)
        assert r.area_px == n and r.center_x == pytest.approx(a[:, 0].mean()) and r.min_x == a[:, 0].min()
        assert r.max_x == a[:, 0].max() and r.min_y == a[:, 1].min() and r.max_y == a[:, 1].max()
        edges = sum((PX * ((x, y + d) not in cells)) + (PY * ((x + d, y) not in cells)) for x, y in px for d in (-1, 1))
        assert r.perimeter_um == pytest.approx(edges)
        hull = brute_hull(px)
        assert (r.convex_hull_area_um2 or 0.0) == pytest.approx(hull * PX * PY)
        if n >= 2:
            lam = np.linalg.eigvalsh(np.cov((a * [PX, PY]).T, ddof=0))
            assert r.major_axis_um == pytest.approx(4 * math.sqrt(max(lam[1], 0)), abs=1e-6)
            assert r.minor_axis_um == pytest.approx(4 * math.sqrt(max(lam[0], 0)), abs=1e-6)


def brute_hull(px):
    """Area by the all-pairs edge test."""
    pts = sorted(set(px))
    total = 0
    for p in pts:
        for q in pts:
            if p == q:
                continue
            ok = True
            for s in pts:
                c = (q[0] - p[0]) * (s[1] - p[1]) - (q[1] - p[1]) * (s[0] - p[0])
                between = (s[0] - p[0]) * (s[0] - q[0]) + (s[1] - p[1]) * (s[1] - q[1]) <= 0
                if c < 0 or (c == 0 and not between):
                    ok = False
                    break
            if ok:
                total += p[0] * q[1] - p[1] * q[0]
    return abs(total) / 2


def test_words_round_trip_and_dedupe(spark):
    px = [(x, y) for x in range(-35, 70, 3) for y in (0, 1)]
    df = frame(spark, {1: px}).unionByName(frame(spark, {1: px}))
    back = bits.unpack(bits.pack(df, OBJ), OBJ)
    assert rows(back, "x", "y") == sorted(px)


def test_intensity_ignores_missing_pixels(spark):
    img = spark.createDataFrame([("q", "c", 0, 0, [float(v) for v in range(10)] + [float("nan")])],
                                "acquisition_id string, channel string, y long, seg long, pixel_values array<double>")
    words = bits.pack(frame(spark, {1: [(x, 0) for x in range(8, 14)] + [(2, 5)]}), OBJ)
    r = metrics.intensity_stats(words, img, OBJ).collect()[0]
    assert (r.mean_intensity, r.min_intensity, r.max_intensity, r.measured_px) == (8.5, 8.0, 9.0, 2)
    assert r.intensity_sd == pytest.approx(0.5)


# --- gates ---------------------------------------------------------------------
def test_rule_validation():
    ok = validate_rules([Rule("mean_intensity", 10), Rule("intensity_sd", 0, "below")], INTENSITY_METRICS)
    assert [r.metric for r in ok] == ["mean_intensity"]
    for bad in (Rule("area_px", 10), Rule("mean_intensity", 101), Rule("mean_intensity", True),
                Rule("mean_intensity", 5, "between")):
        with pytest.raises(ValueError):
            validate_rules([bad], INTENSITY_METRICS)
    for pairs in ([("a", "a")], [("a", "b"), ("a", "b")], [("a", "z")]):
        with pytest.raises(ValueError):
            validate_pairs(pairs, {"a", "b"})
    with pytest.raises(ValueError):
        validate_threshold(1.5)
    with pytest.raises(ValueError):
        AnalysisConfig("n", 0.5, 0.5, [("a", "b")], shape_rules=[Rule("mean_intensity", 5)])


def metric_rows(spark, values):
    return spark.createDataFrame([("q", "c", i, v) for i, v in enumerate(values)],
                                 "acquisition_id string, channel string, object_id long, mean_intensity double")


def test_gate_inclusive_null_fails_and_off(spark):
    m = metric_rows(spark, [1.0, 2.0, 3.0, 4.0, 5.0, None, float("nan")])
    got = gates.apply_gate(m, [Rule("mean_intensity", 50, "above")], INTENSITY_METRICS)
    assert rows(got.where("pass_all_filters"), "object_id") == [(2,), (3,), (4,)]
    off = gates.apply_gate(m, [Rule("mean_intensity", 0, "below")], INTENSITY_METRICS)
    assert off.where("pass_all_filters").count() == 7
    empty = metric_rows(spark, [None, float("nan")])
    assert rows(gates.missing_values(empty, [Rule("mean_intensity", 5)]), "metric") == [("mean_intensity",)]


def test_second_pass_uses_survivors(spark):
    data = [("q", "c", i, float(i), float(-i)) for i in range(10)]
    m = spark.createDataFrame(data, "acquisition_id string, channel string, object_id long, mean_intensity double, area_px double")
    out = gates.two_pass_gate(m, [Rule("mean_intensity", 50, "above")], [Rule("area_px", 50, "above")])
    # Survivors of pass 1 are 5..9 with areas -5..-9; their median is -7.
    assert rows(out.where("kept"), "object_id") == [(5,), (6,), (7,)]


# --- bins ----------------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 7, 20, 23, 59, 101])
def test_rank_bins_equal_array_split(spark, n):
    m = metric_rows(spark, [float((i * 7) % 5) for i in range(n)])
    want = {}
    order = sorted(range(n), key=lambda i: (float((i * 7) % 5), i))
    for b, chunk in enumerate(np.array_split(order, 20)):
        want.update({int(i): b for i in chunk})
    assert {r.object_id: r.bin for r in bins.rank_bins(m, "mean_intensity").collect()} == want


def test_quartile_exemplars_twenty_rois(spark):
    m = metric_rows(spark, [10.0 * i for i in range(20)])
    got = bins.quartile_exemplars(m, "mean_intensity", ["object_id"]).collect()
    assert len(got) == 20 and {r.quartile_count for r in got} == {5}
    many = bins.quartile_exemplars(metric_rows(spark, [float(i) for i in range(400)]), "mean_intensity", ["object_id"])
    first = sorted(r.rank_in_quartile - 1 for r in many.where("quartile = 1").collect())
    assert first == [int(v) for v in np.linspace(0, 99, 10)]


def test_histogram_matches_numpy(spark):
    values = [float(v % 17) for v in range(200)]
    got = [r["count"] for r in bins.histogram(metric_rows(spark, values), "mean_intensity").orderBy("bin").collect()]
    assert got == np.histogram(values, 50)[0].tolist()
    flat = bins.histogram(metric_rows(spark, [3.0, 3.0]), "mean_intensity").where("count > 0").collect()
    assert len(flat) == 1 and flat[0]["count"] == 2


def test_sample_is_repeatable_and_bounded(spark):
    m = metric_rows(spark, [1.0] * 40)
    a = rows(bins.sample_rows(m, ["acquisition_id"], ["object_id"], 15), "object_id")
    assert a == rows(bins.sample_rows(m.repartition(7), ["acquisition_id"], ["object_id"], 15), "object_id") and len(a) == 15


# --- masks and labels ----------------------------------------------------------
def mask(spark, px):
    df = spark.createDataFrame([("q", "c", x, y) for x, y in px], "acquisition_id string, channel string, x long, y long")
    return bits.pack(df, ["acquisition_id", "channel"])


def test_mask_golden(spark):
    block = [(x, y) for x in range(3) for y in range(3)]
    organoid = mask(spark, block + [(x, y) for x in (4, 5) for y in (4, 5)])
    cells = mask(spark, [(1, 1), (2, 1), (1, 2), (2, 2), (3, 3)])
    reference = mask(spark, block).drop("channel")
    dims = spark.createDataFrame([("q", "c", 6, 6)], "acquisition_id string, channel string, height long, width long")
    s = maskqc.mask_statistics(organoid, cells, reference, dims).collect()[0]
    assert (s.organoid_mask_area_px, s.segmented_cell_px, s.cell_px_outside_organoid) == (13, 5, 1)
    assert s.cell_px_outside_organoid_percent == 20.0 and s.touches_image_border
    assert (s.reference_mask_area_px, s.organoid_mask_disagreement_px, s.organoid_mask_px_outside_reference) == (9, 4, 4)
    assert (s.reference_mask_px_missing_from_organoid, s.cell_px_outside_reference) == (0, 1)
    assert s.cell_px_outside_reference_percent == 20.0
    c = maskqc.component_summary(organoid, dims).collect()[0]
    assert (c.connected_components, c.largest_component_area_px) == (2, 9)
    checks = {r.check for r in maskqc.mask_violations(maskqc.mask_statistics(organoid, cells, reference, dims)).collect()}
    assert checks == {"organoid_differs_from_reference", "cells_outside_organoid"}


def test_components_of_snakes_and_noise(spark):
    rng = random.Random(9)
    noise = {(x, y) for x in range(80) for y in range(40) if rng.random() < 0.55}
    spiral = {(x, 100) for x in range(70)} | {(69, y) for y in range(100, 140)} | {(x, 139) for x in range(3, 70)}
    px = noise | spiral
    seen, sizes_ = set(), []
    for p in px:
        if p in seen:
            continue
        stack, size = [p], 0
        seen.add(p)
        while stack:
            x, y = stack.pop()
            size += 1
            for q in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if q in px and q not in seen:
                    seen.add(q)
                    stack.append(q)
        sizes_.append(size)
    got = [r.area_px for r in graph.mask_components(mask(spark, px), ["acquisition_id", "channel"]).collect()]
    assert sorted(got) == sorted(sizes_)


def test_components_of_star_and_chain(spark):
    edges = [(0, 0, i) for i in range(1, 50)] + [(0, i, i + 1) for i in range(100, 160)] + [(1, 5, 6)]
    df = spark.createDataFrame(edges, "g long, u long, v long")
    comp = {}
    for g, node, c in rows(graph.connected_components(df, ["g"]), "g", "node", "component"):
        comp.setdefault((g, c), set()).add(node)
    assert comp == {(0, 0): set(range(50)), (0, 100): set(range(100, 161)), (1, 5): {5, 6}}


def test_downsample_crop_and_rounding(spark):
    img = spark.createDataFrame([("q", "c", y, 0, [float(x + y) for x in range(5)]) for y in range(5)],
                                "acquisition_id string, channel string, y long, seg long, pixel_values array<double>")
    got = {(r.x, r.y): r.value for r in labels.downsample(img, 2, 5, 5).collect()}
    assert got == {(0, 0): 1.0, (1, 0): 3.0, (0, 1): 3.0, (1, 1): 5.0}
    for bad in (0, True, 6):
        with pytest.raises(ValueError):
            labels.downsample(img, bad, 5, 5)


def test_union_area_counts_overlap_once(spark):
    words = bits.pack(frame(spark, {1: [(0, 0), (1, 0)], 2: [(1, 0), (2, 0)]}), OBJ)
    assert rows(overlap.union_area(words), "positive_area_px") == [(3,)]


def test_downsample_pieces_across_block_and_row_borders(spark):
    rng = np.random.default_rng(4)
    image = rng.integers(0, 70000, (23, 101)).astype(float)
    rows = [(1, 0, y, g, [float(v) for v in image[y, 32 * g:32 * g + 32]]) for y in range(23) for g in range(4)]
    table = spark.createDataFrame(rows, "acquisition_id long, channel long, y long, seg long, pixel_values array<double>")
    for f in (1, 3, 7, 20):
        got = {(r.x, r.y): r.value for r in labels.downsample(table, f, 23, 101).collect()}
        h, w = 23 // f, 101 // f
        mean = image[:h * f, :w * f].reshape(h, f, w, f).mean(axis=(1, 3))
        want = np.clip(np.rint(mean), 0, 65535)
        assert got == {(x, y): want[y, x] for y in range(h) for x in range(w)}
