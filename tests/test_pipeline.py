import duckdb
import pytest
from helpers import rows
from pyspark.sql import functions as F

from roispark import catalog
from roispark.functions import bits
from roispark.operators import fields, inventory
from roispark.plans.pipeline import analyze, run_tables
from roispark.schema import AnalysisConfig, OBJ, PAIR, Rule
from roispark.sources import fixtures, io
from roispark.streaming.arrivals import process_arrivals

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "lineitem"]


def test_every_query_has_sql_or_is_known():
    without = set(catalog.queries()) - set(catalog.oracle_sql())
    assert without == {"r3_assignment"}
    assert not set(catalog.oracle_sql()) - set(catalog.queries())


@pytest.mark.parametrize("name", ["j2_overlap_counts", "k2_stable_matching", "m5_perimeter", "g5_two_pass_gate",
                                  "q2_connected_components", "t6_kruskal_wallis", "i4_acquisition_identity"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(catalog.oracle_sql()[name])
    df = catalog.queries()[name](spark, SF)
    assert set(df.columns) == set(rel.columns)
    want = sorted(tuple(r) for r in rel.select(*[duckdb.ColumnExpression(c) for c in df.columns]).fetchall())
    assert sorted(tuple(r) for r in df.collect()) == want


def test_analyze_end_to_end(spark, tmp_path):
    config = AnalysisConfig(nuclear_channel=0, marker_nuclear_threshold=0.25, marker_marker_threshold=0.25,
                            marker_pairs=[(1, 2)], intensity_rules=[Rule("mean_intensity", 10)],
                            shape_rules=[Rule("area_px", 10)])
    px = fixtures.roi_pixels(spark, SF).withColumnRenamed("object_id", "roi")
    out = analyze(px, fixtures.image_rows(spark, SF), fixtures.organoids(spark, SF), fixtures.pixel_sizes(spark, SF), config)
    assert out["checks"].count() == 0
    run = run_tables(out, [(1, 2)])
    assert set(run) == set(io.RUN_TABLES)
    path = str(tmp_path / "run")
    io.save_bundle(run, path, ["channel_a", "channel_b"], {"pairs": [[1, 2]]})
    back = io.load_bundle(spark, path)
    for name, df in run.items():
        assert back[name].schema.simpleString() == df.schema.simpleString() and rows(back[name]) == rows(df), name
    lone, pairs = out["marker_unmatched_metrics"], out["marker_pair_geometry"].join(out["marker_pair_intensity"], PAIR)
    assert pairs.count() == out["marker_matches"].count()
    assert lone.count() == out["marker_unmatched_classes"].count()
    for r in lone.collect():
        own, other = ("a", "b") if r.side == "a" else ("b", "a")
        assert r[f"{own}_pixel_count"] > 0 and r[f"{own}_signal_in_{own}_roi_mean_intensity"] is not None
        alone = r[f"object_{other}"] is None
        assert alone == (r[f"{other}_pixel_count"] is None) == (r.intersection_pixels == 0)
        assert alone == (r.a_signal_in_intersection_mean_intensity is None)
    n = out["metrics"].count()
    gated = out["areas"].where("channel <> 0").count()
    assert 0 < gated < out["metrics"].where("channel <> 0").count() and n == 1500
    matched = out["nuclear_matching"].collect()
    assert matched and all(r.a_percent_inside_b >= 25 and r.shared_area <= min(r.a_area, r.b_area) for r in matched)
    # Without later edits every exported object is its own source: all identities resolve.
    assert {r.mapping_status for r in out["constrained_assignments"].collect()} == {"resolved"}
    final = out["constrained_audit"].where("final_match").collect()
    assert all(r.same_nucleus for r in final)
    assert out["constrained_summary"].count() % 14 == 0 and out["constrained_comparison"].count() % 14 == 0
    parts = out["nuclear_class_composition"].where("percent IS NOT NULL").groupBy("acquisition_id", "channel_a").agg(
        F.sum("percent").alias("p")).collect()
    assert all(abs(r.p - 100) < 1e-9 for r in parts)


def test_a_bad_acquisition_does_not_stop_the_others(spark):
    config = AnalysisConfig(nuclear_channel=0, marker_nuclear_threshold=0.25, marker_marker_threshold=0.25,
                            marker_pairs=[(1, 2)], intensity_rules=[Rule("mean_intensity", 10)])
    px = fixtures.roi_pixels(spark, SF).withColumnRenamed("object_id", "roi")
    first, second = [r[0] for r in px.select("acquisition_id").distinct().orderBy("acquisition_id").limit(2).collect()]
    px = px.unionByName(px.where(F.col("acquisition_id") == first).limit(1).withColumn("x", F.lit(500).cast(px.schema["x"].dataType)))
    images = fixtures.image_rows(spark, SF).where(f"acquisition_id <> {second} OR channel <> 2")
    dims = px.select("acquisition_id").distinct().selectExpr("acquisition_id", "400L AS width", "400L AS height")
    out = analyze(px, images, fixtures.organoids(spark, SF), fixtures.pixel_sizes(spark, SF), config, dims)
    found = {(r.acquisition_id, r.check) for r in out["checks"].collect()}
    assert (first, "pixels_out_of_bounds") in found and {a for a, _ in found} <= {first, second}
    left = {r[0] for r in out["gated_words"].select("acquisition_id").distinct().collect()}
    assert first not in left and left and left == {r[0] for r in out["nuclear_summary"].select("acquisition_id").distinct().collect()}


def test_run_tables_round_trip_and_dynamic_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2, 5), ("b", 1, 2, 6)], "acquisition_id string, channel_a long, channel_b long, v long")
    keys = ["acquisition_id", "channel_a", "channel_b"]
    io.save_run({"overlap": df}, str(tmp_path / "run"), keys)
    io.save_run({"overlap": df.where("acquisition_id = 'b'").withColumn("v", F.lit(9).cast("long"))}, str(tmp_path / "run"), keys)
    back = io.load_run(spark, str(tmp_path / "run"), ("overlap",))["overlap"]
    assert rows(back, "acquisition_id", "v") == [("a", 5), ("b", 9)]
    pruned = io.load_run(spark, str(tmp_path / "run"), ("overlap",), "acquisition_id = 'a'")["overlap"]
    assert "PartitionFilters: [isnotnull(acquisition_id" in pruned._jdf.queryExecution().toString()


def test_a_run_bundle_is_whole_or_absent(spark, tmp_path):
    path = str(tmp_path / "run")
    df = spark.createDataFrame([("007", 1, 5), ("b", 2, 6)], "acquisition_id string, channel_a long, v long")
    none = df.where("v > 9")
    broken = df.withColumn("v", F.when(F.col("v") == 6, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        io.save_bundle({"overlap": df, "matching": broken}, path, ["acquisition_id"])
    with pytest.raises(ValueError, match="no committed run"):
        io.load_bundle(spark, path)
    manifest = io.save_bundle({"overlap": df, "matching": none}, path, ["acquisition_id"], {"pair": "A/B"})
    assert rows(manifest, "table_name", "rows", "metadata") == [("matching", 0, '{"pair": "A/B"}'), ("overlap", 2, '{"pair": "A/B"}')]
    back = io.load_bundle(spark, path)
    assert rows(back["overlap"]) == rows(df) and back["matching"].count() == 0 and back["overlap"].schema == df.schema
    assert rows(io.load_bundle(spark, path, ("overlap",), "acquisition_id = '007'")["overlap"], "v") == [(5,)]
    with pytest.raises(ValueError, match="holds a committed run"):
        io.save_bundle({"overlap": df}, path, [])
    with pytest.raises(ValueError, match="not tables of a run"):
        io.save_bundle({"other": df}, path, [])
    spark.read.parquet(path + "/overlap").limit(1).write.mode("append").parquet(path + "/overlap/acquisition_id=b")
    with pytest.raises(ValueError, match="does not hold the 2 rows"):
        io.load_bundle(spark, path)


def test_manifests_that_disagree(spark):
    plan = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, None)], "index long, source_field string")
    other = spark.createDataFrame([(0, "a"), (1, "x"), (3, None), (4, "d")], "index long, source_field string")
    tile = "index long, position long, source_index long, source string"
    t1 = spark.createDataFrame([(0, 0, 5, "p"), (0, 1, 6, "q"), (2, 0, 1, "z"), (3, 0, 1, None)], tile)
    t2 = spark.createDataFrame([(0, 0, 5, "p"), (0, 1, 7, "q"), (0, 2, 8, "r"), (3, 0, 1, None)], tile)
    assert rows(fields.manifest_violations(plan, other, t1, t2), "index", "check", "differing_tiles") == [
        (0, "tiles differ", 2), (1, "source field differs", 0), (2, "not in remaining manifest", 0),
        (4, "not in original manifest", 0)]
    assert fields.manifest_violations(plan, plan, t1, t1).count() == 0
    audit = spark.createDataFrame([(0, True, "complete analysis"), (1, False, "late")], "index long, included boolean, reason string")
    wanted = spark.createDataFrame([(0,), (1,), (1,), (9,)], "index long")
    assert rows(fields.selection_gaps(audit, wanted), "index", "reason") == [(1, "late"), (9, None)]


def test_gate_export_and_csv_input(spark, tmp_path):
    df = spark.createDataFrame([("a", "c", 1, 5, 6), ("a", "c", 1, 5, 6)], "acquisition_id string, channel string, roi long, x long, y long")
    io.export_gate({"pixels": df}, str(tmp_path / "out"))
    back = io.read_table(spark, str(tmp_path / "out" / "pixels"), "csv", "roi string, x string, y string, acquisition_id string, channel string")
    got = io.read_roi_pixels(back)
    assert rows(got, "object_id", "x", "y") == [(1, 5, 6)]
    assert rows(bits.unpack(io.read_roi_words(back), OBJ), "object_id", "x", "y") == [(1, 5, 6)]
    with pytest.raises(ValueError):
        io.read_table(spark, "x", "csv")
    bad = spark.createDataFrame([("a", "c", "one", "5", "6")], "acquisition_id string, channel string, roi string, x string, y string")
    with pytest.raises(Exception):
        io.read_roi_pixels(bad).collect()


def test_id_and_centroid_columns():
    assert io.id_column(["CellID", "ROI", "X"]) == "ROI" and io.id_column(["CellID"]) == "CellID"
    with pytest.raises(ValueError):
        io.id_column(["X"])
    assert io.centroid_column(["Location_Center_X", "AreaShape_Center_X"], "x") == "Location_Center_X"
    assert io.centroid_column(["Location_CenterMass_X", "q"], "x") == "Location_CenterMass_X"
    with pytest.raises(ValueError):
        io.centroid_column(["Location_CenterA_X", "Location_CenterB_X"], "x")


def test_tiles_and_names(spark):
    paths = (["s/A_1/A_1_DAPI_PV_1_F%02d.ims" % i for i in range(4)] + ["s/B_2/B_DAPI_F0.ims", "s/B_2/B_DAPI_F1.ims"]
             + ["s/C/C_DAPI_NKX2_1_F%d.ims" % i for i in (1, 2, 3, 5)] + ["s/D/D_DAPI.ims"] + ["s/E/x/E_F%d.ims" % i for i in range(5)])
    f = inventory.path_parts(spark.createDataFrame([(p, 1) for p in paths], "path string, size long"))
    got = {r.folder: r.status for r in inventory.tiles(f).collect()}
    assert got == {"s/A_1": "complete", "s/B_2": "incomplete", "s/C": "noncontiguous", "s/D": "unnumbered_tile",
                   "s/E/x": "too_many_tiles"}
    names = {r.folder: r.channels for r in inventory.channel_names(f, ["DAPI", "PV", "NKX2_1"]).collect()}
    assert names["s/A_1"] == ["DAPI", "PV"] and names["s/C"] == ["DAPI", "NKX2_1"] and names["s/E/x"] == []
    with pytest.raises(ValueError):
        inventory.channel_names(f, ["PV", "pv"])


def test_stream_skips_finished_folders(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "path string, size long"
    spark.createDataFrame([("s/A/A_F0.ims", 1), ("s/B/B_F0.ims", 2)], schema).coalesce(1).write.parquet(src)
    seen = []

    def run():
        q = process_arrivals(spark, src, schema, str(tmp_path / "runs"), str(tmp_path / f"cp"),
                             lambda df: seen.append(rows(df.select("folder").distinct())))
        q.awaitTermination()

    run()
    spark.createDataFrame([("s/B/B_F0.ims", 2), ("s/C/C_F0.ims", 3)], schema).coalesce(1).write.mode("append").parquet(src)
    run()
    assert seen == [[("s/A",), ("s/B",)], [("s/C",)]]


def test_a_folder_in_two_batches_is_processed_whole(spark, tmp_path):
    src, runs = str(tmp_path / "in"), str(tmp_path / "runs")
    schema, seen = "path string, size long", []

    def run():
        process_arrivals(spark, src, schema, runs, str(tmp_path / "cp"), lambda df: seen.append(rows(df.select("path")))).awaitTermination()

    spark.createDataFrame([("s/A/A_F0.ims", 1)], schema).coalesce(1).write.mode("append").parquet(src)
    run()
    spark.createDataFrame([("s/A/A_F1.ims", 2), ("s/B/B_F0.ims", 3)], schema).coalesce(1).write.mode("append").parquet(src)
    run()
    run()
    assert seen == [[("s/A/A_F0.ims",)], [("s/A/A_F0.ims",), ("s/A/A_F1.ims",), ("s/B/B_F0.ims",)]]
    every = inventory.path_parts(spark.read.parquet(src))
    want = inventory.fingerprints(every, ["folder"], ["path", "size"], "").select("folder", "fingerprint")
    done = spark.read.parquet(runs)
    assert want.join(done, ["folder", "fingerprint"], "left_anti").count() == 0 and done.count() == 3


def test_globs_with_classes(spark):
    import fnmatch

    from roispark.operators.inventory import select_fields

    names = ["s1_a", "S2_b", "s3_c", "s-_x", "s]_y", "s[_z", "s[1]", "t1_a", "s^_q", "s!_w", "s\\_e"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for glob in ("s[12]_*", "S[1-3]_?", "s[!1-3]_*", "s[]]_*", "s[[]_*", "s[[]1]", "s[^]_q", "s[-x]_*", "s[_*", "*", "s[\\]_*"):
        got = sorted(r.name for r in select_fields(df, name_glob=glob).collect())
        assert got == sorted(n for n in names if fnmatch.fnmatchcase(n.lower(), glob.lower())), glob
