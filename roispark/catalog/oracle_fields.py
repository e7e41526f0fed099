"""SQL for block metadata, field metrics and file inventory."""

from __future__ import annotations

from roispark.catalog.oracle_objects import _cut
from roispark.catalog.oracle_pixels import PX, PY
from roispark.catalog.oracles import cte, oracle, r

# --- fields --------------------------------------------------------------------
cte("named_rows", """SELECT l_orderkey AS index, l_linenumber::BIGINT AS line_number,
 'S' || l_orderkey || ' ' || CASE l_orderkey % 6 WHEN 0 THEN 'h1_CL32' WHEN 1 THEN 'H1 cl-23' WHEN 2 THEN 'H1' WHEN 3 THEN 'XH1'
 WHEN 4 THEN 'CL_323' ELSE 'cl 32 H1' END || '_' || CASE l_partkey % 5 WHEN 0 THEN 'bive3' WHEN 1 THEN 'BiPVe4' WHEN 2 THEN 'BIVE3 bive4'
 WHEN 3 THEN 'BiVe4' ELSE 'none' END AS name,
 CASE l_suppkey % 10 WHEN 0 THEN 'H1 CL23' WHEN 1 THEN 'H9' END AS ov FROM lineitem""")
oracle("f1_infer_names", r"""SELECT index, line_number, name, CASE WHEN l IN ('H1', 'H1 CL32', 'H1 CL23') THEN l END AS cell_line,
 CASE WHEN l IS NULL THEN 'line_not_inferable' WHEN l NOT IN ('H1', 'H1 CL32', 'H1 CL23') THEN 'line_override_invalid' END AS line_problem,
 e AS enhancer, CASE WHEN e IS NULL THEN 'enhancer_not_unique' END AS enhancer_problem FROM (
 SELECT *, coalesce(ov, CASE WHEN regexp_matches(upper(name), 'CL[ _-]*32([^0-9]|$)') THEN 'H1 CL32'
 WHEN regexp_matches(upper(name), 'CL[ _-]*23([^0-9]|$)') THEN 'H1 CL23'
 WHEN regexp_matches(upper(name), '(^|[^A-Z0-9])H1([^A-Z0-9]|$)') THEN 'H1' END) AS l,
 CASE WHEN regexp_matches(lower(name), 'bip?ve3') AND NOT regexp_matches(lower(name), 'bip?ve4') THEN 'BiVe3'
 WHEN regexp_matches(lower(name), 'bip?ve4') AND NOT regexp_matches(lower(name), 'bip?ve3') THEN 'BiVe4' END AS e FROM named_rows)""")
cte("acqs", "SELECT DISTINCT acquisition_id AS q FROM objects")
cte("inv", """SELECT q, tile, folder, folder || '/' || substr(folder, instr(folder, '/') + 1) || '_F0' || tile || '.ims' AS path,
 1000 + q*7 + tile AS size FROM (SELECT q, 'Session_' || q % 4 || '/Exp17_' || 149 + q % 5 || '-' || 2 + q % 2 || '_Set' || 1 + q % 3
 || '_DAPI_GFP_LHX6_PV_Field_' || q AS folder, unnest(list_concat(CASE WHEN q % 7 = 0 THEN [0::BIGINT, 1, 2] ELSE [0::BIGINT, 1, 2, 3] END,
 CASE WHEN q % 11 = 5 THEN [1::BIGINT] ELSE [] END)) AS tile FROM acqs)""".replace("149 + q % 5", "(149 + q % 5)").replace(
    "2 + q % 2", "(2 + q % 2)").replace("1 + q % 3", "(1 + q % 3)"))
oracle("f2_parse_source", """SELECT path, size, 17::BIGINT AS experiment_id, 149 + q % 5 AS block_id, 2 + q % 2 AS section,
 (149 + q % 5) || '-' || (2 + q % 2) AS sample, CASE q % 2 WHEN 0 THEN 'Anti-GFP stained (-2)' ELSE 'No anti-GFP (-3)' END AS anti_gfp_status,
 CASE WHEN size % 5 = 4 THEN 149 + q % 5 END AS block_label FROM inv""")
cte("rep", f"""SELECT acquisition_id, o.n AS organoid_px, o.n*{PX}*{PY}/1e6 AS mm, coalesce(u.positive_area_px, 0) AS upx, coalesce(s.n, 0) AS objs,
 coalesce(e.n, 0) AS ne, coalesce(t.n, 0) AS nt, coalesce(b.n, 0) AS nb, coalesce(dm.n, 0) AS nd
 FROM (SELECT acquisition_id, count(*) AS n FROM mask_pixels WHERE kind = 'organoid' GROUP BY 1) o
 LEFT JOIN (SELECT acquisition_id, positive_area_px FROM union_px WHERE channel = 2) u USING (acquisition_id)
 LEFT JOIN (SELECT acquisition_id, count(*) AS n FROM areas WHERE channel = 2 GROUP BY 1) s USING (acquisition_id)
 LEFT JOIN (SELECT acquisition_id, count(*) AS n FROM mapping WHERE channel = 1 GROUP BY 1) e USING (acquisition_id)
 LEFT JOIN (SELECT acquisition_id, count(*) AS n FROM mapping WHERE channel = 2 GROUP BY 1) t USING (acquisition_id)
 LEFT JOIN (SELECT acquisition_id, count(*) AS n FROM (SELECT acquisition_id, nucleus_id FROM mapping WHERE channel = 1
  INTERSECT SELECT acquisition_id, nucleus_id FROM mapping WHERE channel = 2) GROUP BY 1) b USING (acquisition_id)
 LEFT JOIN (SELECT acquisition_id, count(*) AS n FROM matches WHERE channel_a = 1 AND channel_b = 2 GROUP BY 1) dm USING (acquisition_id)""")
oracle("f3_reporter_metrics", f"""SELECT acquisition_id, organoid_px, {r('mm','organoid_mm2')}, upx AS positive_union_px, objs AS segmented_objects,
 ne AS enhancer_nuclear_positive_cells, nt AS target_nuclear_positive_cells, nb AS double_positive_nuclei, nd AS direct_matched_pairs,
 {r('100.0*upx/organoid_px','positive_area_percent')}, {r('objs/mm','segmented_object_density_mm2')}, {r('nt/mm','nuclear_positive_density_mm2')},
 {r('100.0*nb/nullif(ne, 0)','specificity_percent')}, {r('100.0*nb/nullif(nt, 0)','coverage_percent')}, nd - nb AS direct_minus_nuclear_overlap,
 nt = 0 AS zero_target_denominator, ne = 0 AS zero_enhancer_denominator FROM rep""")
oracle("f4_nucleus_associated_area", f"""SELECT acquisition_id, coalesce(n, 0) AS associated_union_px, coalesce(c, 0) AS matched_cells,
 {r('100.0*coalesce(n, 0)/organoid_px','associated_area_percent')},
 concat_ws(',', CASE WHEN coalesce(c, 0) <> nt THEN 'cell_count_differs' END, CASE WHEN coalesce(n, 0) > organoid_px THEN 'more_than_organoid' END,
 CASE WHEN coalesce(n, 0) > upx THEN 'more_than_positive_union' END) AS violations
 FROM rep LEFT JOIN (SELECT acquisition_id, count(DISTINCT x*100000+y) AS n, count(DISTINCT cell_id) AS c FROM matched_px
 WHERE side = 'a' AND channel_a = 2 AND channel_b = 0 GROUP BY 1) USING (acquisition_id)""")
cte("um2", f"SELECT acquisition_id, organoid_area_px*{PX}*{PY} AS um FROM organoid_area_pos")
cte("cls", """SELECT acquisition_id, count(*) FILTER (cell_class = 'A+/B+') AS dp, count(*) FILTER (cell_class = 'A+/B-') AS ao,
 count(*) FILTER (cell_class = 'A-/B+') AS bo, count(*) FILTER (cell_class = 'A-/B-') AS dn, count(*) AS n
 FROM nuc_class WHERE cell_class IS NOT NULL GROUP BY 1""")
_parts = {"double_positive": "dp", "a_only": "ao", "b_only": "bo", "a_positive": "(dp+ao)", "b_positive": "(dp+bo)"}
oracle("f5_class_metrics", f"""SELECT acquisition_id, {r('um','organoid_area_um2')}, n AS all_nuclei, dp AS double_positive, ao AS a_only, bo AS b_only,
 dn AS double_negative, dp+ao AS a_positive, dp+bo AS b_positive, {r('100.0*dp/nullif(dp+ao, 0)','b_within_a_percent')},
 {', '.join(r(f'{v}/(um/1e6)', f'{k}_density_per_mm2') for k, v in _parts.items())},
 {', '.join(r(f'100.0*{v}/n', f'{k}_percent') for k, v in _parts.items())} FROM cls JOIN um2 USING (acquisition_id)""")
oracle("f6_positive_areas", f"""SELECT acquisition_id, count(*) AS roi_count, {r('sum(a)','area_sum_um2')}, {r('avg(a)','area_mean_um2')},
 {r("avg(a) FILTER (cell_class = 'A+/B+')",'area_mean_double_positive_um2')}, {r("avg(a) FILTER (cell_class = 'A-/B+')",'area_mean_b_only_um2')},
 count(*) FILTER (a IS NULL OR a <= 0) AS missing_areas, {r('quantile_cont(a, 0.5)','area_median_um2')},
 count(*) - count(DISTINCT b_marker_id) AS markers_used_twice
 FROM (SELECT c.*, m.area_um2 AS a FROM nuc_class c LEFT JOIN shape1 m ON m.channel = 2 AND m.acquisition_id = c.acquisition_id
 AND m.object_id = c.b_marker_id WHERE b_positive AND cell_class IS NOT NULL) GROUP BY acquisition_id""")
cte("rep_roi", f"""SELECT acquisition_id, area_px*{PX}*{PY} AS a, mean_intensity AS v FROM gated1 WHERE channel = 1 AND pall""")
oracle("f7_reporter_roi_metrics", f"""SELECT acquisition_id, count(a) AS roi_count, {r('count(a)/(any_value(um)/1e6)','density_per_mm2')},
 {r('coalesce(sum(a), 0)','area_sum_um2')}, {r('100*coalesce(sum(a), 0)/any_value(um)','area_percent_of_organoid')}, {r('avg(a)','area_mean_um2')},
 {r('quantile_cont(a, 0.5)','area_median_um2')}, {r('avg(v)','mean_intensity_mean')}, {r('quantile_cont(v, 0.5)','mean_intensity_median')},
 'MeanIntensity' AS intensity_column FROM um2 LEFT JOIN rep_roi USING (acquisition_id) GROUP BY acquisition_id""")
cte("flist", "SELECT DISTINCT q AS index, folder AS source_field, q % 4 <> 1 AS oc, q % 3 <> 0 AS rc, 149 + q % 5 AS block_id, (149 + q % 5) || '-' || (2 + q % 2) AS sample FROM inv")
cte("blk", """SELECT DISTINCT block_id, CASE block_id WHEN 149 THEN 'CL32' WHEN 150 THEN 'CL32' WHEN 151 THEN 'H1' WHEN 152 THEN 'CLX' ELSE 'CL23' END AS cell_line,
 CASE WHEN block_id % 2 = 0 THEN '+IGF' ELSE 'No IGF' END AS condition FROM flist""")
oracle("s9_read_blocks", """SELECT block_id, CASE WHEN block_id = 150 THEN 'H9' ELSE cell_line END AS cell_line, condition, '17' AS experiment_id,
 CASE WHEN block_id IN (150, 152) THEN 'cell_line' ELSE '' END AS violations FROM blk""")


def audit(blocks: str, excluded: str, selected: str) -> str:
    return f"""SELECT index, source_field, sample, block_id, 17::BIGINT AS experiment_id, coalesce(cell_line, '') AS cell_line, coalesce(condition, '') AS condition,
 refused IS NULL AND src IS NOT NULL AS included, CASE WHEN refused IS NULL AND src IS NOT NULL THEN src ELSE '' END AS source_workspace,
 coalesce(refused, CASE WHEN src IS NULL THEN 'no complete downstream marker-colocalization stage' END, 'complete analysis') AS reason
 FROM (SELECT f.*, b.cell_line, b.condition, CASE WHEN {excluded} THEN 'known-failed excluded index' WHEN b.cell_line IS NULL THEN 'not one of the planned blocks'
 WHEN b.cell_line = 'H1' AND NOT ({selected}) THEN 'not in the verified selection' END AS refused,
 CASE WHEN index <= 10 AND oc THEN 'original' WHEN index >= 10 AND rc THEN 'remaining' END AS src
 FROM flist f LEFT JOIN (SELECT * FROM blk WHERE {blocks}) b USING (block_id))"""


oracle("f8_collect_fields", audit("block_id <> 152", "index IN (12, 13)", "index % 2 = 0"))
cte("aud8", audit("block_id <> 152", "index IN (12, 13)", "index % 2 = 0"))
oracle("f8_selection_gaps", """SELECT index, reason FROM aud8 WHERE index % 2 = 0 AND NOT included
 UNION ALL SELECT index + 1000000, NULL FROM aud8 WHERE index % 10 = 4""")
oracle("f8_manifest_violations", """SELECT index, CASE WHEN index % 23 = 7 THEN 'not in original manifest' WHEN index % 19 = 6 THEN 'not in remaining manifest'
 ELSE 'source field differs' END AS "check", 0::BIGINT AS differing_tiles FROM flist
 WHERE (index % 23 = 7) <> (index % 19 = 6) OR (index % 23 <> 7 AND index % 19 <> 6 AND index % 29 = 8)
 UNION ALL SELECT q, 'tiles differ', count(DISTINCT tile) FROM inv WHERE q % 23 <> 7 AND q % 19 <> 6
 AND ((q % 13 = 4 AND tile >= 2) OR (q % 17 = 3 AND tile = 1)) GROUP BY q""")
cte("aud9", audit("true", "false", "true"))
oracle("f9_sample_summary", f"""SELECT cell_line, condition, experiment_id, sample, count(*) AS n_fields, {r('avg(100.0*dp/nullif(dp+ao, 0))','mean_b_within_a_percent')},
 {r('avg((dp+ao)/(um/1e6))','mean_a_positive_density_per_mm2')}, {r('avg(dp/(um/1e6))','mean_double_positive_density_per_mm2')},
 {r('avg(100.0*(dp+bo)/n)','mean_b_positive_percent')}, {r('avg(n)','mean_all_nuclei')}
 FROM aud9 JOIN cls ON cls.acquisition_id = aud9.index JOIN um2 ON um2.acquisition_id = aud9.index GROUP BY ALL""")
oracle("f10_group_counts", f"""SELECT line, batch, enhancer, count(*) AS n_fields, {r('avg(specificity_percent)','mean_specificity_percent')},
 {r('avg(density)','mean_density')} FROM fields GROUP BY ALL""")
oracle("f11_derived_metrics", f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {r('l_tax','density')}, 'PV_Density' AS density_source,
 {r('CASE WHEN l_quantity > 25 THEN l_extendedprice/1000/(l_quantity-25)*100 END','fraction',9)}, '100*pv_positive_cells/Nuclei_Count' AS fraction_source FROM lineitem""")
oracle("f12_verify_selection", """WITH used AS (SELECT CASE WHEN o_orderkey % 90 = 4 THEN o_orderkey + 10000000 ELSE o_orderkey END AS id,
 CASE WHEN o_orderkey % 70 = 3 THEN 'X' ELSE o_orderstatus END AS st FROM orders WHERE o_orderkey % 50 <> 7)
 SELECT * FROM (SELECT coalesce(o_orderkey, id) AS id, CASE WHEN id IS NULL THEN 'missing' WHEN o_orderkey IS NULL THEN 'extra'
 WHEN st <> o_orderstatus THEN 'metadata_mismatch' END AS status FROM orders FULL JOIN used ON o_orderkey = id) WHERE status IS NOT NULL""")
oracle("f12_verify_counts", """SELECT line, enhancer, count(*) + CASE WHEN line = 'N' THEN 1 ELSE 0 END AS expected, count(*) AS actual,
 CASE WHEN line = 'N' THEN 'MISMATCH' ELSE 'PASS' END AS status FROM fields GROUP BY line, enhancer""")

# --- inventory -----------------------------------------------------------------
cte("inv_clean", r"""SELECT path, size, folder, substr(folder, instr(folder, '/') + 1) || '_F0' || tile || '.ims' AS name,
 substr(folder, instr(folder, '/') + 1) || '_F0' || tile AS stem, q, tile FROM inv""")
oracle("i1_exclude_files", "SELECT path, size, name, stem, folder FROM inv_clean")
cte("tl", """SELECT folder, any_value(q) AS q, sum(n)::BIGINT AS files, count(*) AS tiles, string_agg(tile::VARCHAR, ',' ORDER BY tile) AS tile_list,
 CASE WHEN max(n) > 1 THEN 'duplicate_tile' WHEN count(*) < 4 THEN 'incomplete' WHEN max(tile) - min(tile) <> 3 THEN 'noncontiguous' ELSE 'complete' END AS status
 FROM (SELECT folder, any_value(q) AS q, tile, count(*) AS n FROM inv_clean GROUP BY folder, tile) GROUP BY folder""")
oracle("i2_tiles", "SELECT folder, files, tiles, tile_list, status FROM tl")
oracle("i3_channel_names", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 AND o_orderkey % 3 > 0 THEN '' ELSE CASE o_orderkey % 5 WHEN 0 THEN 'DAPI,GFP,LHX6,PV' WHEN 1 THEN 'DAPI,NKX2_1' WHEN 2 THEN 'GFP,NKX2_1,PV'
 WHEN 3 THEN '' ELSE 'PV' END END AS channels FROM orders""")
oracle("i4_acquisition_identity", r"""SELECT folder, q AS acquisition_number, set_number, CASE WHEN lo <> hi THEN 'files_disagree' WHEN lo <> q THEN 'folder_and_files_disagree'
 WHEN sets > 1 THEN 'set_mismatch' ELSE 'ok' END AS status FROM (SELECT folder, any_value(q) AS q, 1 + any_value(q) % 3 AS set_number,
 min(CASE WHEN size % 5 <> 0 AND size % 11 = 0 THEN 7777 ELSE q END) AS lo, max(CASE WHEN size % 5 <> 0 AND size % 11 = 0 THEN 7777 ELSE q END) AS hi,
 max(CASE WHEN size % 5 = 0 THEN 2 ELSE 1 END) AS sets FROM inv_clean GROUP BY folder)""")
oracle("i5_metadata_violations", """SELECT q AS acquisition_id, t AS tile, c AS "check" FROM (SELECT q, unnest(range(4)) AS t FROM acqs),
 (VALUES ('indices_not_sequential'), ('phase_channel'), ('channel_count'), ('names_differ'), ('wavelengths_differ'), ('shape_differs'), ('calibration_differs')) v(c)
 WHERE CASE c WHEN 'indices_not_sequential' THEN t = 0 AND q % 9 = 4 WHEN 'phase_channel' THEN t = 0 AND q % 12 = 5 AND NOT (q % 8 = 3 AND t = 2)
 WHEN 'channel_count' THEN t = 0 AND q % 10 = 3 AND q % 9 <> 4 WHEN 'names_differ' THEN t = 2 AND q % 8 = 3
 WHEN 'wavelengths_differ' THEN t = 3 AND q % 7 = 2 WHEN 'shape_differs' THEN t = 1 AND q % 6 = 1 ELSE t > 0 AND q % 5 = 2 END""")
cte("st_files", """SELECT DISTINCT q, sub, ch, png, cv FROM (SELECT acquisition_id AS q, object_id % 3 = 0 AS sub, CASE object_id % 4 WHEN 0 THEN 'DAPI' WHEN 1 THEN 'GFP'
 WHEN 2 THEN CASE WHEN acquisition_id % 5 = 0 THEN 'XYZ' ELSE 'PV' END ELSE CASE WHEN acquisition_id % 3 = 0 THEN 'GFP' ELSE 'note' END END AS ch,
 object_id % 4 = 3 AND acquisition_id % 2 = 0 OR object_id % 3 <> acquisition_id % 3 AS png,
 CASE WHEN acquisition_id % 6 = 2 AND object_id % 4 = 1 THEN '10x11' ELSE '10x10' END AS cv FROM objects) WHERE NOT png AND ch <> 'note'""")
cte("st_ch", "SELECT q, ch, count(*) AS n, min(cv) AS c0, max(cv) AS c1 FROM st_files GROUP BY ALL")
oracle("i6_stitched_samples", """SELECT *, missing_channels = '' AND unknown_channels = 0 AND duplicate_channels = 0 AND NOT canvas_mismatch AS valid FROM (
 SELECT 'S' || q AS sample, sum(n)::BIGINT AS files, count(*) FILTER (ch <> 'XYZ') AS known_channels,
 concat_ws(',', CASE WHEN NOT bool_or(ch = 'DAPI') THEN 'DAPI' END, CASE WHEN NOT bool_or(ch = 'GFP') THEN 'GFP' END, CASE WHEN NOT bool_or(ch = 'PV') THEN 'PV' END) AS missing_channels,
 count(*) FILTER (ch = 'XYZ') AS unknown_channels, count(*) FILTER (n > 1) AS duplicate_channels, min(c0) <> max(c1) AS canvas_mismatch FROM st_ch GROUP BY q)""")
oracle("i7_reconcile_plan", """SELECT p.session, true AS planned, complete_fields, incomplete_fields, original_tiles, fc AS found_complete, fi AS found_incomplete,
 fv AS found_invalid, ft AS found_tiles, complete_fields = fc AND incomplete_fields = fi AND fv = 0 AND original_tiles = ft AS passed
 FROM (SELECT 'Session_' || q % 4 AS session, count(*) FILTER (q % 7 <> 0) AS complete_fields, count(*) FILTER (q % 7 = 0) AS incomplete_fields,
 4*count(*) FILTER (q % 7 <> 0) AS original_tiles FROM acqs GROUP BY 1) p
 JOIN (SELECT 'Session_' || q % 4 AS session, count(*) FILTER (status = 'complete') AS fc, count(*) FILTER (status = 'incomplete') AS fi,
 count(*) FILTER (status NOT IN ('complete', 'incomplete')) AS fv, coalesce(sum(tiles) FILTER (status = 'complete'), 0)::BIGINT AS ft FROM tl GROUP BY 1) f USING (session)""")
cte("sel", """SELECT o_orderkey AS index, 'Session_' || o_orderkey % 4 AS session,
 'Exp_' || o_custkey % 200 || '-' || (2 + o_orderkey % 2) || '_' || o_orderstatus AS name FROM orders""")
cte("sel_kept", "SELECT * FROM sel WHERE session IN ('Session_1', 'Session_3') AND lower(name) LIKE 'exp\\_1%-_\\_f' ESCAPE '\\' AND name LIKE '%Exp\\_1%' ESCAPE '\\'")
oracle("i8_select_fields", """SELECT index, session, name, count(*) OVER (PARTITION BY session) AS fields, 'filters' AS rule FROM sel_kept
 UNION ALL SELECT index, session, name, NULL, 'first' FROM (SELECT * FROM sel WHERE contains(name, '-2_') ORDER BY index LIMIT 25)""")
cte("fp1", """SELECT folder, substr(d, 1, 2) AS b, sha256(string_agg(d, '' ORDER BY d)) AS d, count(*) AS n FROM (
 SELECT folder, sha256(path || '|' || size) AS d FROM inv) GROUP BY ALL""")
cte("fp", "SELECT folder, sum(n)::BIGINT AS files, sha256(string_agg(d, '' ORDER BY b, d) || 'cfg-1') AS fingerprint FROM fp1 GROUP BY folder")
oracle("i9_fingerprints", "SELECT folder, files, fingerprint FROM fp")
oracle("i9_pending", "SELECT folder, files FROM fp WHERE folder LIKE '%3' OR folder LIKE '%5'")
oracle("i10_duplicates", """SELECT 'order_line' AS "check", l_orderkey || '|' || l_linenumber AS key, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
 UNION ALL SELECT 'order:left', l_orderkey::VARCHAR, count(*) FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
 UNION ALL SELECT 'order:right', o_orderkey::VARCHAR, count(*) FROM orders GROUP BY o_orderkey HAVING count(*) > 1""")
cte("panel", "SELECT DISTINCT acquisition_id, object_id % (3 + acquisition_id % 3) AS c FROM objects WHERE object_id % (3 + acquisition_id % 3) <> 0")
oracle("i11_channel_pairs", """SELECT a.acquisition_id, a.c AS channel_a, b.c AS channel_b FROM panel a JOIN panel b USING (acquisition_id) WHERE a.c < b.c""")
oracle("i6_shared_files", """SELECT 'S' || q AS sample, 'in/S' || q || '_GFP.tif' AS path, 2::BIGINT AS channels FROM acqs WHERE q % 5 = 0""")
