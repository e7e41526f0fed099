"""Registered queries S9, F1-F12 and I1-I11."""

from __future__ import annotations

from pyspark.sql import functions as F

from roispark.catalog import base
from roispark.catalog.base import query
from roispark.catalog.q_identity import mapping, nuclei
from roispark.functions import bits
from roispark.operators import classes, fields, gates, inventory, matching
from roispark.catalog.q_objects import INTENSITY_RULES
from roispark.schema import INTENSITY_METRICS
from roispark.sources import fixtures, io

MARKERS = ["DAPI", "GFP", "LHX6", "PV", "NKX2_1"]
SWITCH = 10


def named(spark, d):
    """Sample names in many spellings, some ambiguous, some overridden."""
    return fixtures.table(spark, d, "lineitem").selectExpr(
        "l_orderkey AS index", "l_linenumber AS line_number",
        "concat('S', l_orderkey, ' ', CASE l_orderkey % 6 WHEN 0 THEN 'h1_CL32' WHEN 1 THEN 'H1 cl-23' WHEN 2 THEN 'H1' "
        "WHEN 3 THEN 'XH1' WHEN 4 THEN 'CL_323' ELSE 'cl 32 H1' END, '_', CASE l_partkey % 5 WHEN 0 THEN 'bive3' "
        "WHEN 1 THEN 'BiPVe4' WHEN 2 THEN 'BIVE3 bive4' WHEN 3 THEN 'BiVe4' ELSE 'none' END) AS name",
        "CASE l_suppkey % 10 WHEN 0 THEN 'H1 CL23' WHEN 1 THEN 'H9' WHEN 2 THEN '  ' END AS override_line")


@query("f1_infer_names")
def _(spark, d):
    line, bad_line = fields.infer_line(F.col("name"), F.col("override_line"))
    enh, bad_enh = fields.infer_enhancer(F.col("name"))
    return named(spark, d).select("index", "line_number", "name", line.alias("cell_line"), bad_line.alias("line_problem"),
                                  enh.alias("enhancer"), bad_enh.alias("enhancer_problem"))


@query("f2_parse_source")
def _(spark, d):
    out = fields.parse_source(fixtures.file_inventory(spark, d), "path")
    label = F.concat(F.col("block_id").cast("string"), F.lit("-"), (F.col("size") % 5).cast("string"))
    return out.withColumn("block_label", fields.block_label(label))


def organoid_px(spark, d):
    return base.mask_words(spark, d).where("kind = 'organoid'").groupBy("acquisition_id").agg(
        F.sum(bits.size(F.col("bits"))).alias("organoid_px"))


def reporter(spark, d):
    w = base.words(spark, d).where("channel = 2")
    union = bits.merge(w, ["acquisition_id"]).groupBy("acquisition_id").agg(
        F.sum(bits.size(F.col("bits"))).alias("positive_union_px"))
    objects = base.areas(spark, d).where("channel = 2").groupBy("acquisition_id").agg(
        F.count(F.lit(1)).alias("segmented_objects"))
    m = mapping(spark, d)
    direct = base.matches(spark, d).where("channel_a = 1 AND channel_b = 2")
    return fields.reporter_metrics(organoid_px(spark, d), union, objects, m.where("channel = 1"),
                                   m.where("channel = 2"), direct, base.sizes(spark, d))


@query("f3_reporter_metrics")
def _(spark, d):
    return reporter(spark, d)


@query("f4_nucleus_associated_area")
def _(spark, d):
    cells = base.cells(spark, d).where("channel_a = 2 AND channel_b = 0")
    return fields.nucleus_associated_area(matching.matched_words(base.words(spark, d), cells, "a"), reporter(spark, d))


def organoid_um2(spark, d):
    return io.organoid_area(fixtures.organoids(spark, d), True).join(base.sizes(spark, d), "acquisition_id").select(
        "acquisition_id", (F.col("organoid_area_px") * F.col("px") * F.col("py")).alias("organoid_area_um2"))


@query("f5_class_metrics")
def _(spark, d):
    return fields.class_metrics(classes.nuclei_class_counts(nuclei(spark, d)), organoid_um2(spark, d))


@query("f6_positive_areas")
def _(spark, d):
    markers = base.roi_metrics(spark, d).where("channel = 2")
    return fields.positive_area_metrics(fields.positive_areas(nuclei(spark, d), markers))


@query("f7_reporter_roi_metrics")
def _(spark, d):
    gated = gates.apply_gate(base.roi_metrics(spark, d), INTENSITY_RULES, INTENSITY_METRICS)
    kept = gated.where("channel = 1 AND pass_all_filters").withColumnRenamed("mean_intensity", "MeanIntensity")
    return fields.reporter_roi_metrics(kept, organoid_um2(spark, d))


def field_list(spark, d):
    f = fixtures.file_inventory(spark, d).select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("source_field"))
    return f.distinct().withColumn("index", F.regexp_extract("source_field", r"(\d+)$", 1).cast("long")).selectExpr(
        "index", "source_field", "index % 4 <> 1 AS original_complete", "index % 3 <> 0 AS remaining_complete")


def blocks(spark, d):
    b = fields.parse_source(field_list(spark, d), "source_field").select("block_id").distinct()
    return b.selectExpr(
        "block_id", "CASE block_id WHEN 149 THEN 'CL32' WHEN 150 THEN 'CL32' WHEN 151 THEN 'H1' WHEN 152 THEN 'CLX' ELSE 'CL23' END AS cell_line",
        "CASE WHEN block_id % 2 = 0 THEN '+IGF' ELSE 'No IGF' END AS condition", "'17' AS experiment_id")


@query("s9_read_blocks")
def _(spark, d):
    b = blocks(spark, d)
    override = b.where("block_id = 150").select("block_id", F.lit("H9").alias("cell_line"), F.lit(None).cast("string").alias("condition"))
    out = io.read_blocks(b, {"cell_line": ["H1", "CL23", "CL32"], "condition": ["No IGF", "+IGF"], "experiment_id": ["17"]}, override)
    return out.withColumn("violations", F.array_join("violations", ","))


@query("f8_collect_fields")
def _(spark, d):
    known = blocks(spark, d).where("block_id <> 152").select("block_id", "cell_line", "condition")
    selection = field_list(spark, d).where("index % 2 = 0").select("index")
    return fields.collect_fields(field_list(spark, d), known, selection, 17, [12, 13], SWITCH, "H1")


def workspace_tiles(spark, d):
    files = fixtures.file_inventory(spark, d).select("path").distinct()
    return files.select(F.regexp_extract("path", r"(\d+)/[^/]*$", 1).cast("long").alias("index"),
                        F.regexp_extract("path", r"_F0(\d)", 1).cast("long").alias("position"), F.col("path").alias("source")
                        ).withColumn("source_index", F.col("position"))


@query("f8_manifest_violations")
def _(spark, d):
    listed, tiles = field_list(spark, d).select("index", "source_field"), workspace_tiles(spark, d)
    later = listed.where("index % 19 <> 6").selectExpr(
        "index", "CASE WHEN index % 29 = 8 THEN concat(source_field, '_b') ELSE source_field END AS source_field")
    changed = tiles.where("NOT (index % 13 = 4 AND position >= 2)").withColumn(
        "source", F.expr("CASE WHEN index % 17 = 3 AND position = 1 THEN concat(source, '.old') ELSE source END"))
    return fields.manifest_violations(listed.where("index % 23 <> 7"), later, tiles, changed)


@query("f8_selection_gaps")
def _(spark, d):
    known = blocks(spark, d).where("block_id <> 152").select("block_id", "cell_line", "condition")
    selection = field_list(spark, d).where("index % 2 = 0").select("index")
    audit = fields.collect_fields(field_list(spark, d), known, selection, 17, [12, 13], SWITCH, "H1")
    more = selection.unionByName(selection.where("index % 10 = 4").selectExpr("index + 1000000 AS index"))
    return fields.selection_gaps(audit, more)


@query("f9_sample_summary")
def _(spark, d):
    audit = fields.collect_fields(field_list(spark, d), blocks(spark, d).select("block_id", "cell_line", "condition"),
                                  field_list(spark, d).select("index"), 17, [], SWITCH, "H1")
    m = fields.class_metrics(classes.nuclei_class_counts(nuclei(spark, d)), organoid_um2(spark, d))
    rows = audit.withColumnRenamed("index", "acquisition_id").join(m, "acquisition_id")
    return fields.sample_summary(rows, ["cell_line", "condition", "experiment_id", "sample"], [
        "b_within_a_percent", "a_positive_density_per_mm2", "double_positive_density_per_mm2", "b_positive_percent",
        "all_nuclei"])


@query("f10_group_counts")
def _(spark, d):
    f = fixtures.field_metrics(spark, d)
    return fields.sample_summary(f, ["line", "batch", "enhancer"], ["specificity_percent", "density"])


@query("f11_derived_metrics", fraction=9)
def _(spark, d):
    f = fixtures.table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity - 25 AS Nuclei_Count", "l_extendedprice / 1000 AS pv_positive_cells", "l_tax AS PV_Density")
    f = fields.derived_metric(f, ["pv_density"], [], [], "density", False, False)
    return fields.derived_metric(f, ["pv_fraction_percent"], ["pv_count", "pv_positive_cells"],
                                 ["hoechst_count", "nuclei_count"], "fraction", True, True).select(
        "l_orderkey", "l_linenumber", "density", "density_source", "fraction", "fraction_source")


@query("f12_verify_selection")
def _(spark, d):
    o = fixtures.table(spark, d, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS cell_line", "o_orderpriority AS enhancer")
    used = o.where("id % 50 <> 7").selectExpr(
        "CASE WHEN id % 90 = 4 THEN id + 10000000 ELSE id END AS id", "CASE WHEN id % 70 = 3 THEN 'X' ELSE cell_line END AS cell_line", "enhancer")
    return fields.verify_selection(o, used, "id", ["cell_line", "enhancer"])


@query("f12_verify_counts")
def _(spark, d):
    f = fixtures.field_metrics(spark, d)
    expected = f.groupBy("line", "enhancer").agg((F.count(F.lit(1)) + F.when(F.col("line") == "N", 1).otherwise(0)).alias("expected"))
    return fields.verify_counts(f, expected, ["line", "enhancer"])


# --- inventory -----------------------------------------------------------------
def raw_files(spark, d):
    """The tile files plus hidden, metadata, derived and output files."""
    f = fixtures.file_inventory(spark, d)
    parts = [f]
    for path in ("regexp_replace(path, '_F00', '_FusionStitcher_F00')", "concat(path, '/Thumbs.db')", "concat('.cache/', path)",
                 "regexp_replace(path, '/Exp17', '/x_ims_to_tiff/Exp17')"):
        parts.append(f.where("path LIKE '%_F00.ims'").selectExpr(f"{path} AS path", "size"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def clean(spark, d):
    return inventory.exclude_files(raw_files(spark, d))


@query("i1_exclude_files")
def _(spark, d):
    return clean(spark, d).select("path", "size", "name", "stem", "folder")


@query("i2_tiles")
def _(spark, d):
    return inventory.tiles(clean(spark, d))


@query("i3_channel_names")
def _(spark, d):
    f = fixtures.table(spark, d, "orders").selectExpr(
        "concat('a/run_', o_orderkey % 7, '_', CASE o_orderkey % 5 WHEN 0 THEN 'DAPI_GFP_LHX6_PV' WHEN 1 THEN 'dapi_NKX2_1' "
        "WHEN 2 THEN 'GFP_NKX2_1_pv' WHEN 3 THEN 'DAPI_UNKNOWN' ELSE 'PV' END, CASE o_orderkey % 3 WHEN 0 THEN '' "
        "WHEN 1 THEN concat('_Field_', o_custkey % 90) ELSE concat('_', 10 + o_custkey % 90) END, CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE concat('_F0', o_orderkey % 4) END, '.ims') AS path",
        "o_orderkey")
    named_files = inventory.channel_names(inventory.path_parts(f), MARKERS)
    return named_files.select("o_orderkey", F.array_join("channels", ",").alias("channels"))


@query("i4_acquisition_identity")
def _(spark, d):
    f = clean(spark, d).withColumn("stem", F.expr(
        "CASE WHEN size % 5 = 0 THEN regexp_replace(stem, '_Set[0-9]+_', '_Set9_') WHEN size % 11 = 0 THEN regexp_replace(stem, '[0-9]+_F0', '7777_F0') ELSE stem END"))
    return inventory.acquisition_identity(f, MARKERS)


@query("i5_metadata_violations")
def _(spark, d):
    f = fixtures.objects(spark, d).select("acquisition_id").distinct().selectExpr(
        "acquisition_id", "explode(array(0L, 1L, 2L, 3L)) AS tile")
    meta = f.selectExpr(
        "acquisition_id", "tile",
        "CASE WHEN acquisition_id % 9 = 4 THEN array(0L, 2L, 3L, 4L) WHEN acquisition_id % 10 = 3 THEN array(0L, 1L, 2L) ELSE array(0L, 1L, 2L, 3L) END AS indices",
        "CASE WHEN acquisition_id % 8 = 3 AND tile = 2 THEN array('405', '561') WHEN acquisition_id % 12 = 5 THEN array('405', 'Phase') ELSE array('405', '488') END AS names",
        "CASE WHEN acquisition_id % 7 = 2 AND tile = 3 THEN array(405L, 500L) ELSE array(405L, 488L) END AS wavelengths",
        "CASE WHEN acquisition_id % 6 = 1 AND tile = 1 THEN '85x10x10' ELSE '85x20x20' END AS shape",
        "0.3128D * (1 + CASE WHEN acquisition_id % 5 = 2 THEN tile * 0.0002D ELSE tile * 0.00001D END) AS vx", "0.3128D AS vy", "2.0D AS vz")
    return inventory.metadata_violations(meta, 4)


@query("i6_stitched_samples")
def _(spark, d):
    f = fixtures.objects(spark, d).selectExpr(
        "concat('in/', CASE WHEN object_id % 3 = 0 THEN 'x/' ELSE '' END, 'S', acquisition_id, '_', CASE object_id % 4 WHEN 0 THEN 'DAPI' "
        "WHEN 1 THEN 'GFP' WHEN 2 THEN CASE WHEN acquisition_id % 5 = 0 THEN 'XYZ' ELSE 'PV' END ELSE "
        "CASE WHEN acquisition_id % 3 = 0 THEN 'GFP' ELSE 'note' END END, "
        "CASE WHEN object_id % 4 = 3 AND acquisition_id % 2 = 0 OR object_id % 3 <> acquisition_id % 3 THEN '.png' ELSE '.tif' END) AS path",
        "CASE WHEN acquisition_id % 6 = 2 AND object_id % 4 = 1 THEN '10x11' ELSE '10x10' END AS canvas")
    f = inventory.path_parts(f.distinct())
    return inventory.stitched_samples(f, r"(S\d+)_([A-Z]+)\.tif", ["DAPI", "GFP", "PV"])


@query("i6_shared_files")
def _(spark, d):
    """Explicit channel lists in which every fifth acquisition names one file twice."""
    listed = fixtures.objects(spark, d).select("acquisition_id").distinct().selectExpr(
        "concat('S', acquisition_id) AS sample", "explode(array('DAPI', 'GFP', 'PV')) AS channel", "acquisition_id").selectExpr(
        "sample", "channel", "concat('in/', sample, '_', CASE WHEN channel = 'PV' AND acquisition_id % 5 = 0 THEN 'GFP' ELSE channel END, '.tif') AS path")
    return inventory.shared_files(listed)


def found_fields(spark, d):
    return inventory.tiles(clean(spark, d)).withColumn("session", F.element_at(F.split("folder", "/"), 1))


@query("i7_reconcile_plan")
def _(spark, d):
    plan = field_list(spark, d).withColumn("session", F.element_at(F.split("source_field", "/"), 1)).groupBy("session").agg(
        F.count_if(F.col("index") % 7 != 0).alias("complete_fields"), F.count_if(F.col("index") % 7 == 0).alias("incomplete_fields"),
        (4 * F.count_if(F.col("index") % 7 != 0)).alias("original_tiles"))
    return inventory.reconcile_plan(found_fields(spark, d), plan)


@query("i8_select_fields")
def _(spark, d):
    f = fixtures.table(spark, d, "orders").selectExpr(
        "o_orderkey AS index", "concat('Session_', o_orderkey % 4) AS session",
        "concat('Exp_', o_custkey % 200, '-', 2 + o_orderkey % 2, '_', o_orderstatus) AS name")
    kept = inventory.select_fields(f, ["Session_1", "Session_3"], "exp_1*-?_F", None, "Exp_1")
    first = inventory.select_fields(f, contains="-2_", first=25)
    totals = inventory.group_totals(kept, "session")
    return kept.join(totals, "session").withColumn("rule", F.lit("filters")).unionByName(
        first.withColumn("fields", F.lit(None).cast("long")).withColumn("rule", F.lit("first")))


def prints(spark, d):
    return inventory.fingerprints(inventory.path_parts(fixtures.file_inventory(spark, d)), ["folder"], ["path", "size"], "cfg-1")


@query("i9_fingerprints")
def _(spark, d):
    return prints(spark, d)


@query("i9_pending")
def _(spark, d):
    now = prints(spark, d)
    done = now.where("folder NOT LIKE '%3'").selectExpr(
        "folder", "CASE WHEN folder LIKE '%5' THEN concat('old-', fingerprint) ELSE fingerprint END AS fingerprint")
    return inventory.pending(now, done, ["folder"]).select("folder", "files")


@query("i10_duplicates")
def _(spark, d):
    li, o = fixtures.table(spark, d, "lineitem"), fixtures.table(spark, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return inventory.duplicates("order_line", li, ["l_orderkey", "l_linenumber"]).unionByName(
        inventory.not_one_to_one("order", li.select("l_orderkey"), o.select("l_orderkey"), ["l_orderkey"]))


@query("i11_channel_pairs")
def _(spark, d):
    panel = fixtures.objects(spark, d).selectExpr("acquisition_id", "object_id % (3 + acquisition_id % 3) AS channel")
    return inventory.channel_pairs(panel, 0)
