"""Plans and intermediate tables that must not grow into one task or the driver."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from roispark.catalog import base
from roispark.functions import bits
from roispark.operators import labels, matching, metrics, overlap, registration
from roispark.schema import OBJ, PAIR
from roispark.session import collecting, materialize
from roispark.sources import fixtures, io

DATA = "/root/testdata/sf0.001"


def broadcast_parts(df):
    """The lines of the plan that lie under a broadcast."""
    return parts_under(df, "BroadcastExchange")


def exchanged_parts(df):
    """The lines of the plan that lie under a shuffle."""
    return parts_under(df, "Exchange hashpartitioning")


def parts_under(df, node):
    found, above = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*("))
        if above is not None and depth <= above:
            above = None
        if above is not None:
            found.append(line)
        elif node in line:
            above = depth
    return found


def task_count(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_relabel_keeps_the_pixels_out_of_the_driver(spark):
    out = labels.relabel(fixtures.label_pixels(spark, DATA))
    assert not [line for line in broadcast_parts(out) if "Generate" in line]


def test_intensity_keeps_the_images_out_of_the_driver(spark):
    out = metrics.intensity_stats(fixtures.roi_words(spark, DATA), fixtures.image_rows(spark, DATA), OBJ)
    assert not [line for line in broadcast_parts(out) if "Generate" in line]


def test_join_of_words_and_images_moves_places_not_pixels(spark):
    img = fixtures.image_rows(spark, DATA)
    met = fixtures.roi_words(spark, DATA).join(img.hint("merge"), [*img.columns[:4]])
    assert "sequence" in str(exchanged_parts(met))
    assert not [line for line in exchanged_parts(met) if "pixel_values" in line]


def test_words_are_packed_where_their_object_is(spark):
    assert not [line for line in exchanged_parts(fixtures.roi_words(spark, DATA)) if "Generate" in line]


def test_pairs_of_all_channels_come_from_one_shuffle_of_the_words(spark):
    words = bits.pack(spark.createDataFrame(
        [(1, c, c * 10 + o, x + o, 0) for c in range(3) for o in range(2) for x in range(4)],
        "acquisition_id long, channel long, object_id long, x long, y long"), OBJ)
    found = overlap.overlap_counts(words, [(1, 0), (2, 0)], overlap.object_areas(words))
    assert rows(found, *PAIR, "shared_area") == sorted(
        (1, a, 0, a * 10 + i, j, 4 - abs(i - j)) for a in (1, 2) for i in range(2) for j in range(2))
    shared = overlap.shared_words(words, [(1, 0), (2, 0)])
    assert "Generate" not in shared._jdf.queryExecution().executedPlan().toString()


def test_matched_pixels_are_made_after_the_join(spark):
    words = bits.pack(spark.createDataFrame(
        [(1, 1, 7, x, y) for x in (30, 31, 32, 40) for y in (0, 5)] + [(1, 1, 8, 0, 0)],
        "acquisition_id long, channel long, object_id long, x long, y long"), OBJ)
    cells = spark.createDataFrame([(1, 1, 0, 7, 3, 1)], "acquisition_id long, channel_a long, channel_b long, "
                                  "object_a long, object_b long, cell_id long")
    out = matching.matched_word_pixels(words, cells, "a")
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert [line for line in plan[:join] if "Generate" in line] and not [line for line in plan[join:] if "Generate" in line]
    assert rows(out, "cell_id", "object_id", "x", "y") == sorted((1, 7, x, y) for x in (30, 31, 32, 40) for y in (0, 5))


def test_read_pixels_move_as_words_and_keep_every_pixel(spark):
    given = [(1, 0, 5, 9, x, y) for x in (-1, 31, 32, 70) for y in (0, 1)] + [(1, 0, 6, None, 3, 3), (1, 0, 6, None, None, 3)]
    df = spark.createDataFrame(given + given[:3] + given[-2:] + [(1, 0, 5, 8, 31, 0)],
                               "acquisition_id long, channel long, roi long, cell_id long, x long, y long")
    out = io.read_roi_pixels(df)
    assert out.columns == [*df.columns, "object_id"]
    assert sorted(r[4:6] for r in rows(out) if r[2] == 5) == sorted(r[4:6] for r in given if r[2] == 5)
    assert rows(out.where("roi = 6")) == [(1, 0, 6, None, None, 3, 6), (1, 0, 6, None, 3, 3, 6)]
    # Of equal pixels with other ids the lowest ids stay, whatever task sees them.
    assert rows(out.where("x = 31 AND y = 0"), "cell_id") == [(8,)]
    many = df.unionByName(df.selectExpr("acquisition_id", "channel", "roi", "cell_id", "x + 1000 AS x", "y"))
    assert [line for line in exchanged_parts(io.read_roi_pixels(many)) if "bit_or" in line]


@pytest.mark.parametrize("build", [fixtures.image_rows, fixtures.stack_rows, fixtures.mask_pixels])
def test_rows_of_images_are_made_in_many_tasks(spark, build):
    assert task_count(build(spark, DATA)) > 1


def test_summary_equals_that_of_relabelled_pixels(spark):
    pixels = fixtures.label_pixels(spark, DATA).unionByName(
        fixtures.label_pixels(spark, DATA).limit(5).withColumn("level", F.lit(0).cast("long")))
    plain = labels.label_summary(labels.relabel(pixels))
    written = []
    with collecting(written):
        got = labels.image_summary(pixels)
        assert rows(got, *plain.columns) == rows(plain)
    assert all("x" not in t.columns for t in written)


def test_label_images_are_made_where_their_objects_were_dealt(spark, tmp_path):
    # Twice the same order, objects that cross a band or lie over each other, one below zero, one without a customer.
    orders = [(5, 3), (5, 3), (8, 3), (605, 7), (608, 7), (611, 900), (1, -8), (2, None)] + [(k, k * k) for k in range(1200, 1800)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    plain = fixtures.roi_pixels(spark, str(tmp_path)).groupBy("acquisition_id", "channel", "x", "y").agg(
        (F.min("object_id") * 97).alias("level"))
    got = fixtures.label_pixels(spark, str(tmp_path))
    assert got.columns == plain.columns and rows(got) == rows(plain)
    moved = exchanged_parts(got)
    assert moved and not [line for line in moved if "AS x#" in line or "bit_or" in line]


def test_pixels_of_a_label_lie_together(spark):
    # Small tables would be merged into one task, where all of them do.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = fixtures.label_pixels(spark, DATA).select("level", F.spark_partition_id().alias("p")).distinct().groupBy("level").count()
        assert pieces.agg(F.avg("count")).first()[0] < 1.3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_levels_are_ranked_with_what_was_counted(spark, monkeypatch):
    monkeypatch.setattr(labels, "levels", None)
    px = spark.createDataFrame([(1, 0, x, y, v) for v, x, y in ((970, 3, 0), (970, 4, 2), (97, 9, 9), (0, 1, 1))],
                               "acquisition_id long, channel long, x long, y long, level long")
    got = rows(labels.image_summary(px), "roi", "level", "pixel_count", "min_x", "max_y", "center_x")
    assert got == [(1, 97, 1, 9, 9, 9.0), (2, 970, 2, 3, 2, 3.5)]


def test_tables_on_the_way_to_a_shared_table_are_deleted(spark):
    seen, folder = [], spark.conf.get("spark.checkpoint.dir")

    def inner(session, name):
        return session.range(3)

    def outer(session, name):
        seen.append(materialize(shared(session, name)))
        return seen[0].join(shared(session, name), "id")

    shared = base.shared_table("inner of a test")(inner)
    found = base.shared_table("outer of a test")(outer)(spark, "none")
    assert not os.path.exists(seen[0]._scratch_path) and os.path.exists(found._scratch_path)
    assert shared(spark, "none").count() == found.count() == 3 and found._scratch_path.startswith(folder)


def test_an_object_is_measured_once_per_signal(spark):
    px = spark.createDataFrame([(1, c, o, x, 0) for c, o in ((0, 10), (1, 20), (2, 30)) for x in range(4)],
                               "acquisition_id long, channel long, object_id long, x long, y long")
    images = spark.createDataFrame([(1, c, 0, 0, [c * 100 + i for i in range(32)]) for c in range(3)],
                                   "acquisition_id long, channel long, y long, seg long, pixel_values array<int>")
    words, wanted = bits.pack(px, OBJ), [(1, 0), (2, 0), (1, 2)]
    pairs = overlap.overlap_counts(words, wanted).select(*PAIR)
    written = []
    with collecting(written):
        got = overlap.region_intensity(pairs, words, images, wanted)
        means = rows(got, "channel_a", "channel_b", "a_signal_in_b_roi_mean_intensity", "b_signal_in_intersection_max_intensity")
    assert means == [(1, 0, 101.5, 3.0), (1, 2, 101.5, 203.0), (2, 0, 201.5, 3.0)]
    # 3 objects under 3 signals each, and 3 intersections under 2.
    assert written[-1].count() == 9 + 6


def test_first_bids_move_the_edges_once(spark, monkeypatch):
    plans, write = [], registration.materialize

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(registration, "materialize", seen)
    pairs = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 0.0, 1.0, 1.0), (1, 1, 2, 0.0, 0.0, 2.0, 0.0, 4.0),
                                   (1, 2, 1, 0.0, 3.0, 0.0, 1.0, 4.0)],
                                  "acquisition_id long, moving_id long, fixed_id long, mx double, my double, fx double, fy double, d2 double")
    assert rows(registration.assign_pairs(pairs, 10.0), "moving_id", "fixed_id") == [(1, 2), (2, 1)]
    assert "Join" not in next(p for p in plans if "MapInPandas" in p)


def test_acquisitions_of_one_tile_are_solved_without_bidding_tables(spark):
    points = [(1, i, float(x), float(y)) for i, (x, y) in enumerate(((-3, 0), (0, 0), (12, 0), (12, 5), (47.5, 48), (48, 60)))]
    moving = spark.createDataFrame(points, "acquisition_id long, object_id long, x double, y double")
    fixed = moving.select("acquisition_id", (F.col("object_id") + 10).alias("object_id"), (F.col("x") + 4).alias("x"), "y")
    pairs = registration.gated_pairs(moving, fixed, 12.0)
    near = {(i, j + 10) for _, i, x, y in points for _, j, u, v in points if (x - u - 4) ** 2 + (y - v) ** 2 <= 144}
    assert set(rows(pairs, "moving_id", "fixed_id")) == near and pairs.count() == len(near)
    written = []
    with collecting(written):
        assert rows(registration.assign_pairs(pairs, 12.0), "moving_id", "fixed_id") == [(i, i + 10) for i in range(6)]
    assert written and not [t for t in written if "person" in t.columns]


def test_best_edges_save_as_much_as_any_matching():
    rng, single = np.random.default_rng(3), 2.02 * 100

    def most(edges, used=frozenset()):
        if not edges:
            return 0.0
        (m, f, w), rest = edges[0], edges[1:]
        return max(most(rest, used), w + most(rest, used | {m, f}) if not used & {m, f} else 0.0)

    for clash in (1, 3, 30):
        group, moving, fixed, d2 = [], [], [], []
        for g in range(40):
            for k in rng.choice(16, 8, replace=False):
                group.append(g), moving.append(k // 4), fixed.append(100 + k % 4), d2.append(float(rng.integers(0, 100) // clash))
        group, moving, fixed, d2 = (np.array(v) for v in (group, moving, fixed, d2))
        order = np.lexsort((fixed, d2, moving, group))
        group, moving, fixed, d2 = group[order], moving[order], fixed[order], d2[order]
        got = registration._best_edges(group, moving, fixed, d2, single, registration._scaling(single))
        for g in range(40):
            mine = got[group[got] == g]
            assert len(set(moving[mine])) == len(set(fixed[mine])) == len(mine)
            all_ = [(m, f, single - v) for m, f, v in zip(moving[group == g], fixed[group == g], d2[group == g])]
            assert abs((single - d2[mine]).sum() - most(all_)) < 1e-4


def test_values_under_a_set_are_one_list_a_place_and_images_dealt_by_band_stay(spark):
    px = spark.createDataFrame([(1, 0, 5, x, y) for x in range(30, 34) for y in range(14, 18)],
                               "acquisition_id long, channel long, object_id long, x long, y long")
    flat = [(1, c, y, s, [float(100 * c + y) if i else float("nan") for i in range(32)]) for c in (0, 1) for y in range(17) for s in (0, 1)]
    images = spark.createDataFrame(flat, "acquisition_id long, channel long, y long, seg long, pixel_values array<double>")
    words = bits.pack(px, OBJ)
    lists = metrics.pixel_values(words, images, OBJ)
    # Rows 14 and 15, row 16; row 17 is outside of the image, x = 32 is not a number.
    assert lists.where("v IS NOT NULL").isEmpty() and dict(lists.dtypes)["narrow"] == "array<smallint>"
    assert sorted(sorted(r[0]) for r in rows(lists.select(metrics.whole_values(lists)))) == [[14.0, 14.0, 15.0, 15.0], [14.0, 15.0], [16.0], [16.0, 16.0]]
    both = metrics.pixel_values(words.withColumn("_s", F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))), images, [*OBJ, "_s"], "_s")
    assert sorted(set(r[0] for r in rows(both.select("_s")))) == [0, 1] and both.count() == 8
    one = metrics.intensity_stats(words, images, OBJ).first()
    values = [14.0, 14.0, 14.0, 15.0, 15.0, 15.0, 16.0, 16.0, 16.0]
    assert (one.measured_px, one.integrated_intensity, one.median_intensity, one.min_intensity, one.max_intensity) == (9, 135.0, 15.0, 14.0, 16.0)
    assert abs(one.intensity_sd - np.std(values)) < 1e-12 and abs(one.p95_intensity - np.percentile(values, 95)) < 1e-12
    for odd in (70000.0, -1.0, 0.5):
        wide = images.withColumn("pixel_values", F.transform("pixel_values", lambda v: v + odd))
        assert metrics.pixel_values(words, wide, OBJ).where("narrow IS NOT NULL").count() == (odd == -1.0) * 4
        assert metrics.intensity_stats(words, wide, OBJ).first().min_intensity == 14.0 + odd
    none = metrics.intensity_stats(words.withColumn("bits", F.lit(1).cast("long")).where("seg = 1"), images, OBJ).first()
    assert none.measured_px == 0 and [none[c] for c in none.asDict() if c not in (*OBJ, "measured_px")] == [None] * 8
    dealt = fixtures.image_bands(spark, DATA)
    assert rows(dealt.drop("band")) == rows(fixtures.image_rows(spark, DATA))
    moved = exchanged_parts(metrics.pixel_values(fixtures.roi_words(spark, DATA), dealt, OBJ))
    assert moved and not [line for line in moved if "pixel_values" in line or "AS y#" in line and "band" in line]


def test_known_shared_words_are_not_made_again(spark):
    words = bits.pack(spark.createDataFrame([(1, c, c * 10, x, 0) for c in range(2) for x in range(4)],
                                            "acquisition_id long, channel long, object_id long, x long, y long"), OBJ)
    shared = materialize(overlap.shared_words(words, [(1, 0)]))
    got = overlap.overlap_counts(words, [(1, 0)], shared=shared)
    assert rows(got, *PAIR, "shared_area") == [(1, 1, 0, 10, 0, 4)]
    assert not [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "bit_or" in line and "Join" in line]


def test_shapes_stay_where_their_words_were_dealt(spark):
    words = materialize(fixtures.roi_words(spark, DATA))
    sizes = materialize(fixtures.pixel_sizes(spark, DATA))
    got = metrics.roi_metrics(words, fixtures.image_bands(spark, DATA), sizes)
    assert not [line for line in exchanged_parts(got) if "ArrowEvalPython" in line]
    assert got.columns[-9:] == ["mean_intensity", "median_intensity", "intensity_sd", "min_intensity", "p05_intensity", "p95_intensity",
                                "max_intensity", "integrated_intensity", "measured_px"]
    assert got.where("convex_hull_area_um2 IS NULL OR mean_intensity IS NULL").isEmpty()
