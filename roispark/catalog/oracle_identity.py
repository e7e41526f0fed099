"""SQL for identity, constrained matching and cell classes."""

from __future__ import annotations

from roispark.catalog.oracle_pixels import KP, PX, PY, STAT_SQL, UM2, image_value, matching_ctes
from roispark.catalog.oracles import cte, oracle, r

K = "acquisition_id, channel"
PAIR = f"{KP}, object_a, object_b"

cte("mapping", """SELECT acquisition_id, channel_a AS channel, cell_id, object_a AS marker_id, object_b AS nucleus_id
 FROM cells WHERE channel_b = 0""")
cte("cur_px", f"""SELECT acquisition_id, channel, marker_id AS object_id, x, y,
 CASE WHEN marker_id % 19 = 0 OR (marker_id % 23 = 0 AND (x+y) % 2 = 0) THEN cell_id + 1 ELSE cell_id END AS cell_id
 FROM mapping JOIN (SELECT {K}, object_id AS marker_id, x, y FROM roi_pixels) USING ({K}, marker_id)
 WHERE NOT (marker_id % 17 = 0 AND (x+y) % 7 = 0)""")
cte("cur_sets", f"""SELECT {K}, object_id, list(y*100000+x ORDER BY y, x) AS px, min(cell_id) AS c1, max(cell_id) AS c2
 FROM cur_px GROUP BY ALL""")
cte("src_sets", f"""SELECT {K}, object_id, list(y*100000+x ORDER BY y, x) AS px FROM roi_pixels
 WHERE ({K}, object_id) IN (SELECT ({K}, marker_id) FROM mapping) GROUP BY ALL""")
cte("cur_found", f"""SELECT c.acquisition_id, c.channel, c.object_id, c.c1, c.c2, count(s.object_id) AS n, min(s.object_id) AS src
 FROM cur_sets c LEFT JOIN src_sets s ON s.acquisition_id = c.acquisition_id AND s.channel = c.channel AND s.px = c.px GROUP BY ALL""")
cte("cur_status", f"""SELECT f.*, CASE WHEN c1 <> c2 THEN 'multiple_CellID_values' WHEN n = 0 THEN 'missing_coordinate_identity'
 WHEN n > 1 THEN 'ambiguous_coordinate_identity'
 WHEN (SELECT count(*) FROM mapping m WHERE m.acquisition_id = f.acquisition_id AND m.channel = f.channel AND m.marker_id <> f.src
  AND (m.marker_id = f.object_id OR m.cell_id = f.c1)) > 0 THEN 'identifier_coordinate_mismatch' ELSE 'resolved' END AS st FROM cur_found f""")
cte("assigned", f"""SELECT s.acquisition_id, s.channel, s.object_id, 'roi' AS input_id_column, s.object_id AS input_roi,
 CASE WHEN c1 = c2 THEN c1 END AS input_cell_id, m.marker_id AS source_marker_id, m.cell_id AS source_cell_id, m.nucleus_id,
 st = 'resolved' AS coordinate_verified, st AS mapping_status
 FROM cur_status s LEFT JOIN mapping m ON st = 'resolved' AND m.acquisition_id = s.acquisition_id AND m.channel = s.channel AND m.marker_id = s.src""")
oracle("k8_nuclear_assignment", "SELECT * FROM assigned")
cte("mapping_bad", "SELECT * REPLACE (CASE WHEN marker_id % 29 = 0 THEN nucleus_id + 1 ELSE nucleus_id END AS nucleus_id) FROM mapping")
cte("filt_px", f"""SELECT {K}, cell_id, x, y FROM mapping JOIN (SELECT {K}, object_id AS marker_id, x, y FROM roi_pixels) USING ({K}, marker_id)
 WHERE NOT (cell_id % 31 = 0 AND y % 2 = 0)""")
oracle("k9_source_violations", f"""SELECT {K}, 'nucleus_id_not_one_to_one' AS "check", nucleus_id::VARCHAR AS detail
 FROM mapping_bad GROUP BY {K}, nucleus_id HAVING count(*) > 1
 UNION SELECT {K}, 'mapping_row_lacks_pixels', cell_id::VARCHAR FROM mapping WHERE ({K}, cell_id) NOT IN (SELECT ({K}, cell_id) FROM filt_px)
 UNION SELECT {K}, 'filtered_pixels_differ', cell_id::VARCHAR FROM (SELECT {K}, cell_id, x, y FROM mapping
  JOIN (SELECT {K}, object_id AS marker_id, x, y FROM roi_pixels) USING ({K}, marker_id) EXCEPT SELECT {K}, cell_id, x, y FROM filt_px)
 UNION SELECT {K}, 'nucleus_absent', nucleus_id::VARCHAR FROM mapping_bad
  WHERE (acquisition_id, nucleus_id) NOT IN (SELECT (acquisition_id, object_id) FROM areas WHERE channel = 0)""")
oracle("k10_context_violations", """SELECT acquisition_id, 'nuclear_name' AS "check" FROM (SELECT DISTINCT acquisition_id FROM objects) WHERE acquisition_id % 10 = 3
 UNION ALL SELECT acquisition_id, 'canvas' FROM (SELECT DISTINCT acquisition_id FROM objects) WHERE acquisition_id % 8 = 2
 UNION ALL SELECT acquisition_id, 'pixel_size_x' FROM (SELECT DISTINCT acquisition_id FROM objects) WHERE acquisition_id % 6 = 1
 UNION ALL SELECT DISTINCT acquisition_id, 'nuclear_segmentation' FROM areas WHERE channel = 0 AND object_id % 300 = 0 AND acquisition_id % 5 = 4""")
cte("cur_area", f"SELECT {K}, object_id, count(*) AS n FROM cur_px GROUP BY ALL")
cte("st_overlap", f"""SELECT s.*, aa.n AS a_area, ab.n AS b_area, shared_area/aa.n*100 AS a_percent_inside_b, shared_area/ab.n*100 AS b_percent_inside_a,
 shared_area/aa.n*100 >= 0.25*100 AS eligible FROM (SELECT a.acquisition_id, a.channel AS channel_a, b.channel AS channel_b,
 a.object_id AS object_a, b.object_id AS object_b, count(*) AS shared_area FROM cur_px a JOIN cur_px b
 ON a.channel = 1 AND b.channel = 2 AND a.acquisition_id = b.acquisition_id AND a.x = b.x AND a.y = b.y GROUP BY ALL) s
 JOIN cur_area aa ON aa.acquisition_id = s.acquisition_id AND aa.channel = 1 AND aa.object_id = s.object_a
 JOIN cur_area ab ON ab.acquisition_id = s.acquisition_id AND ab.channel = 2 AND ab.object_id = s.object_b""")
cte("aud0", f"""SELECT {PAIR}, a_percent_inside_b, b_percent_inside_a, eligible,
 coalesce(a.mapping_status, 'missing_current_object') AS sa, coalesce(b.mapping_status, 'missing_current_object') AS sb,
 a.source_marker_id AS a_source_marker_id, b.source_marker_id AS b_source_marker_id, a.source_cell_id AS a_source_cell_id,
 b.source_cell_id AS b_source_cell_id, a.nucleus_id AS a_nucleus_id, b.nucleus_id AS b_nucleus_id FROM st_overlap o
 LEFT JOIN assigned a ON a.acquisition_id = o.acquisition_id AND a.channel = channel_a AND a.object_id = object_a
 LEFT JOIN assigned b ON b.acquisition_id = o.acquisition_id AND b.channel = channel_b AND b.object_id = object_b""".replace(
    "SELECT acquisition_id,", "SELECT o.acquisition_id,", 1))
cte("aud1", """SELECT *, CASE WHEN sa = 'resolved' AND sb = 'resolved' THEN a_nucleus_id = b_nucleus_id END AS same_nucleus,
 coalesce(CASE WHEN sa = 'resolved' AND sb = 'resolved' THEN a_nucleus_id = b_nucleus_id END, false) AS np FROM aud0""")
cte("fe", "SELECT {'q': acquisition_id, 'ca': channel_a, 'cb': channel_b} AS g, object_a AS a, object_b AS b, a_percent_inside_b AS score FROM aud1 WHERE eligible")
matching_ctes("f", "fe")
cte("ce", "SELECT {'q': acquisition_id, 'ca': channel_a, 'cb': channel_b} AS g, object_a AS a, object_b AS b, a_percent_inside_b AS score FROM aud1 WHERE eligible AND np")
matching_ctes("c", "ce")
cte("free_m", "SELECT g.q AS acquisition_id, g.ca AS channel_a, g.cb AS channel_b, a AS object_a, b AS object_b FROM fmatched")
cte("bound_m", "SELECT g.q AS acquisition_id, g.ca AS channel_a, g.cb AS channel_b, a AS object_a, b AS object_b FROM cmatched")
oracle("k11_constraint_audit", f"""SELECT {PAIR}, object_a AS a_current_object_id, object_b AS b_current_object_id,
 a_source_marker_id, b_source_marker_id, a_source_cell_id, b_source_cell_id, a_nucleus_id, b_nucleus_id,
 sa AS a_mapping_status, sb AS b_mapping_status, sa = 'resolved' AS a_coordinate_verified, sb = 'resolved' AS b_coordinate_verified,
 same_nucleus, {r('a_percent_inside_b','a_percent_inside_b')}, {r('b_percent_inside_a','b_percent_inside_a')},
 eligible AS threshold_pass, np AS nuclear_constraint_pass, eligible AND np AS final_eligible, m IS NOT NULL AS final_match,
 CASE WHEN NOT eligible THEN 'below_directional_overlap_threshold'
 WHEN sa <> 'resolved' OR sb <> 'resolved' THEN 'unresolved_nuclear_assignment:A=' || sa || ';B=' || sb
 WHEN NOT np THEN 'different_canonical_nuclear_objectids' WHEN m IS NULL THEN 'not_selected_by_constrained_stable_matching' ELSE '' END AS exclusion_reason
 FROM aud1 LEFT JOIN (SELECT *, 1 AS m FROM bound_m) USING ({PAIR})""")
oracle("k12_constrained_matching", f"""SELECT {PAIR}, shared_area, a_area, b_area, {r('a_percent_inside_b','a_percent_inside_b')},
 {r('b_percent_inside_a','b_percent_inside_a')}, true AS pass_threshold, a_rank, b_rank FROM bound_m JOIN st_overlap USING ({PAIR})
 JOIN (SELECT {PAIR}, row_number() OVER (PARTITION BY {KP}, object_a ORDER BY a_percent_inside_b DESC, object_b) AS a_rank,
 row_number() OVER (PARTITION BY {KP}, object_b ORDER BY a_percent_inside_b DESC, object_a) AS b_rank FROM aud1 WHERE eligible AND np) USING ({PAIR})""")
cte("cmp", f"""SELECT {PAIR}, coalesce(u, false) AS u, coalesce(c, false) AS c, sa = 'resolved' AND sb = 'resolved' AND NOT np AS disc,
 a_nucleus_id, b_nucleus_id FROM (SELECT *, true AS u FROM free_m) FULL JOIN (SELECT *, true AS c FROM bound_m) USING ({PAIR}) JOIN aud1 USING ({PAIR})""")
oracle("k13_compare_pairs", f"""SELECT {PAIR}, u AS in_unconstrained, c AS in_constrained, CASE WHEN u AND c THEN 'common' WHEN u THEN 'unconstrained_only'
 ELSE 'constrained_only' END AS pair_category, disc AS nuclear_identity_discordant, a_nucleus_id, b_nucleus_id FROM cmp""")
cte("cmp_n", f"""SELECT {KP}, a_rois, b_rois, cand, passing, different, unresolved, both_pass, coalesce(nu,0) AS nu, coalesce(nc,0) AS nc,
 coalesce(nb,0) AS nb, coalesce(nou,0) AS nou, coalesce(noc,0) AS noc, coalesce(nd,0) AS nd
 FROM (SELECT acquisition_id, 1::BIGINT AS channel_a, 2::BIGINT AS channel_b, count(*) FILTER (channel=1) AS a_rois, count(*) FILTER (channel=2) AS b_rois
  FROM cur_area GROUP BY 1)
 LEFT JOIN (SELECT {KP}, count(*) AS cand, count(*) FILTER (eligible) AS passing,
  count(*) FILTER (eligible AND sa='resolved' AND sb='resolved' AND NOT np) AS different,
  count(*) FILTER (eligible AND NOT (sa='resolved' AND sb='resolved')) AS unresolved, count(*) FILTER (eligible AND np) AS both_pass
  FROM aud1 GROUP BY {KP}) USING ({KP})
 LEFT JOIN (SELECT {KP}, count(*) FILTER (u) AS nu, count(*) FILTER (c) AS nc, count(*) FILTER (u AND c) AS nb, count(*) FILTER (u AND NOT c) AS nou,
  count(*) FILTER (c AND NOT u) AS noc, count(*) FILTER (u AND disc) AS nd FROM cmp GROUP BY {KP}) USING ({KP})""")
_cmp = [("Marker A input ROIs", "a_rois", "ROIs"), ("Marker B input ROIs", "b_rois", "ROIs"),
        ("Candidate spatial-overlap pairs", "cand", "pairs"), ("Pairs passing original overlap threshold", "passing", "pairs"),
        ("Threshold-passing pairs excluded for different nuclei", "different", "pairs"),
        ("Threshold-passing pairs with unresolved nuclear identity", "unresolved", "pairs"),
        ("Pairs passing overlap and nuclear constraints", "both_pass", "pairs"),
        ("Final unconstrained stable matches", "nu", "pairs"), ("Final nucleus-constrained stable matches", "nc", "pairs"),
        ("Common final pairs", "nb", "pairs"), ("Final pairs unique to unconstrained", "nou", "pairs"),
        ("Final pairs unique to nucleus-constrained", "noc", "pairs"),
        ("Unconstrained final pairs with discordant nuclear identity", "nd", "pairs"),
        ("Percent unconstrained final pairs with discordant nuclear identity", "CASE WHEN nu > 0 THEN 100.0*nd/nu ELSE 0 END", "percent")]
oracle("k13_compare_variants", " UNION ALL ".join(
    f"SELECT {KP}, '{m}' AS metric, {r(f'coalesce({v}, 0)', 'value')}, '{u}' AS units FROM cmp_n" for m, v, u in _cmp))
oracle("k13_variant_violations", f"""SELECT {PAIR}, 'unconstrained_candidates_differ' AS "check" FROM aud1 WHERE object_b % 31 = 0
 UNION ALL SELECT {PAIR}, 'constrained_candidates_differ' FROM aud1 WHERE (object_a % 29 = 0) <> (object_b % 31 = 0)""")

# --- classes -------------------------------------------------------------------
oracle("k14_unmatched_classes", f"SELECT * REPLACE ({r('focal_overlap_percent','focal_overlap_percent')}) FROM single_pos")
cte("lone", """SELECT *, CASE side WHEN 'a' THEN object_id ELSE context_object_id END AS object_a,
 CASE side WHEN 'a' THEN context_object_id ELSE object_id END AS object_b,
 CASE side WHEN 'a' THEN channel_a ELSE channel_b END AS own, CASE side WHEN 'a' THEN channel_b ELSE channel_a END AS other FROM single_pos""")
cte("lone_px", f"""SELECT side, p.acquisition_id, channel_a, channel_b, p.object_id, 'a_roi' AS region, x, y FROM lone p JOIN roi_pixels q
 ON q.acquisition_id = p.acquisition_id AND q.channel = channel_a AND q.object_id = object_a
 UNION ALL SELECT side, p.acquisition_id, channel_a, channel_b, p.object_id, 'b_roi', x, y FROM lone p JOIN roi_pixels q
 ON q.acquisition_id = p.acquisition_id AND q.channel = channel_b AND q.object_id = object_b
 UNION ALL SELECT side, {KP}, p.object_id, 'intersection', x, y FROM lone p JOIN shared USING ({KP}, object_a, object_b)""")
_lone_key = f"side, {KP}, object_id"
cte("lone_stats", f"""SELECT {_lone_key}, """ + ", ".join(
    f"{fn} FILTER (region = '{g}' AND signal = '{s}') AS {s}_signal_in_{g}_{n}"
    for g in ("a_roi", "b_roi", "intersection") for s in "ab" for n, fn in STAT_SQL.items())
    + f""" FROM (SELECT *, 'a' AS signal, {image_value('channel_a')} AS v FROM lone_px
 UNION ALL SELECT *, 'b', {image_value('channel_b')} FROM lone_px) GROUP BY {_lone_key}""")
cte("lone_geo", """SELECT p.*, a.area_px AS an, b.area_px AS bn, intersection_px AS s, coalesce(a.area_px, 0) + coalesce(b.area_px, 0) AS ab_px,
 b.cx - a.cx AS dx, b.cy - a.cy AS dy FROM lone p
 LEFT JOIN centres a ON a.acquisition_id = p.acquisition_id AND a.channel = p.channel_a AND a.object_id = p.object_a
 LEFT JOIN centres b ON b.acquisition_id = p.acquisition_id AND b.channel = p.channel_b AND b.object_id = p.object_b""")
oracle("k14_unmatched_metrics", f"""SELECT {KP}, side, own || ' only / not final matched' AS cell_class, reason, own::VARCHAR AS focal_object,
 CASE WHEN context_object_id IS NULL THEN 'No overlapping ' || other || ' ROI' ELSE 'Best overlapping ' || other || ' context' END AS context_partner_type,
 object_a, object_b, {r('focal_overlap_percent','focal_overlap_percent')}, an AS a_pixel_count, bn AS b_pixel_count, s AS intersection_pixels,
 ab_px - s AS union_pixels, {r(f'an*{UM2}','a_area_um2')}, {r(f'bn*{UM2}','b_area_um2')}, {r(f's*{UM2}','intersection_area_um2')},
 {r(f'(ab_px-s)*{UM2}','union_area_um2')}, {r('100.0*s/an','a_percent_inside_b')}, {r('100.0*s/bn','b_percent_inside_a')},
 {r('100.0*s/(ab_px-s)','iou_percent')}, {r('200.0*s/ab_px','dice_percent')}, {r('dx','centroid_dx_px')}, {r('dy','centroid_dy_px')},
 {r('sqrt(dx*dx+dy*dy)','centroid_distance_px')}, {r(f'dx*{PX}','centroid_dx_um')}, {r(f'dy*{PY}','centroid_dy_um')},
 {r(f'sqrt(dx*{PX}*dx*{PX}+dy*{PY}*dy*{PY})','centroid_distance_um')}, """ + ", ".join(
    r(f"{s}_signal_in_{g}_{n}", f"{s}_signal_in_{g}_{n}")
    for g in ("a_roi", "b_roi", "intersection") for s in "ab" for n in STAT_SQL)
    + f" FROM lone_geo LEFT JOIN lone_stats USING ({_lone_key})")
oracle("k15_class_composition", " UNION ALL ".join(
    f"SELECT {KP}, channel_a || '{x}/' || channel_b || '{y}' AS cell_class, {n} AS count, {r(f'100.0*({n})/nullif(ta+tb-m, 0)','percent')} FROM run_n"
    for x, y, n in (("+", "+", "m"), ("+", "-", "ta-m"), ("-", "+", "tb-m"))))
oracle("k16_headline_summary", f"""SELECT {KP}, ta AS a_total_rois, tb AS b_total_rois, m AS double_positive_count, ta-m AS a_only_count, tb-m AS b_only_count,
 ta+tb-m AS classified_cell_count, {r('100.0*m/ta','a_assigned_percent')}, {r('100.0*(ta-m)/ta','a_not_assigned_percent')},
 {r('100.0*m/tb','b_assigned_percent')}, {r('100.0*(tb-m)/tb','b_not_assigned_percent')},
 channel_a || '+/' || channel_b || '+' AS double_positive_label, {r('100.0*m/(ta+tb-m)','double_positive_percent')},
 channel_a || '+/' || channel_b || '-' AS a_only_label, {r('100.0*(ta-m)/(ta+tb-m)','a_only_percent')},
 channel_a || '-/' || channel_b || '+' AS b_only_label, {r('100.0*(tb-m)/(ta+tb-m)','b_only_percent')},
 organoid_count, {r('o.organoid_area_px','organoid_area_px')}, {r(f'o.organoid_area_px*({PX}*{PY})','organoid_area_um2')},
 a.positive_area_px AS a_positive_area_px, {r(f'a.positive_area_px*({PX}*{PY})','a_positive_area_um2')},
 {r('100.0*a.positive_area_px/o.organoid_area_px','a_positive_area_percent')},
 b.positive_area_px AS b_positive_area_px, {r(f'b.positive_area_px*({PX}*{PY})','b_positive_area_um2')},
 {r('100.0*b.positive_area_px/o.organoid_area_px','b_positive_area_percent')}
 FROM run_n n LEFT JOIN organoid_area_pos o USING (acquisition_id)
 LEFT JOIN union_px a ON a.acquisition_id = n.acquisition_id AND a.channel = n.channel_a
 LEFT JOIN union_px b ON b.acquisition_id = n.acquisition_id AND b.channel = n.channel_b""".replace(
    f"SELECT {KP},", "SELECT n.acquisition_id, n.channel_a, n.channel_b,", 1))
cte("nuc_a", "SELECT acquisition_id, object_id AS nucleus_id FROM areas WHERE channel = 0 AND NOT (acquisition_id % 3 = 2 AND object_id % 40 = 1)")
cte("nuc_b", "SELECT acquisition_id, object_id AS nucleus_id FROM areas WHERE channel = 0 AND NOT (acquisition_id % 3 <> 0 AND object_id % 50 = 0)")
cte("nuc_method", """SELECT acquisition_id, CASE WHEN oa = 0 AND ob = 0 THEN 'identical_source_nuclear_sets' WHEN oa = 0 OR ob = 0
 THEN 'nested_source_nuclear_sets_union' ELSE 'incompatible_source_nuclear_sets' END AS denominator_method FROM (
 SELECT acquisition_id, count(*) FILTER (b IS NULL) AS oa, count(*) FILTER (a IS NULL) AS ob
 FROM (SELECT *, 1 AS a FROM nuc_a) FULL JOIN (SELECT *, 1 AS b FROM nuc_b) USING (acquisition_id, nucleus_id) GROUP BY 1)""")
cte("nuc_class", """SELECT u.acquisition_id, u.nucleus_id, denominator_method, a.marker_id IS NOT NULL AS a_positive, b.marker_id IS NOT NULL AS b_positive,
 a.marker_id AS a_marker_id, a.cell_id AS a_cell_id, b.marker_id AS b_marker_id, b.cell_id AS b_cell_id,
 CASE WHEN denominator_method <> 'incompatible_source_nuclear_sets' THEN
 'A' || CASE WHEN a.marker_id IS NULL THEN '-' ELSE '+' END || '/B' || CASE WHEN b.marker_id IS NULL THEN '-' ELSE '+' END END AS cell_class
 FROM (SELECT * FROM nuc_a UNION SELECT * FROM nuc_b) u JOIN nuc_method USING (acquisition_id)
 LEFT JOIN mapping a ON a.channel = 1 AND a.acquisition_id = u.acquisition_id AND a.nucleus_id = u.nucleus_id
 LEFT JOIN mapping b ON b.channel = 2 AND b.acquisition_id = u.acquisition_id AND b.nucleus_id = u.nucleus_id""")
oracle("k17_classify_nuclei", "SELECT * FROM nuc_class")
oracle("k17_nuclei_class_counts", f"""SELECT q.acquisition_id, k AS cell_class, count(n.nucleus_id) AS count, {r('100.0*count(n.nucleus_id)/any_value(q.n)','percent_of_nuclei')}
 FROM (SELECT acquisition_id, count(*) AS n, unnest(['A+/B+','A+/B-','A-/B+','A-/B-']) AS k FROM nuc_class WHERE cell_class IS NOT NULL GROUP BY 1) q
 LEFT JOIN nuc_class n ON n.acquisition_id = q.acquisition_id AND n.cell_class = q.k GROUP BY 1, 2""")
oracle("k18_link_to_nuclei", f"""SELECT {K}, CASE acquisition_id % 3 WHEN 0 THEN marker_id WHEN 1 THEN -marker_id ELSE cell_id END AS object_id,
 CASE acquisition_id % 3 WHEN 0 THEN 'current_ObjectID_to_source_marker_ObjectID' WHEN 1 THEN 'preserved_CellID_to_source_CellID'
 ELSE 'current_ObjectID_to_source_CellID' END AS source_link_method, marker_id AS source_marker_id, cell_id AS source_cell_id, nucleus_id FROM mapping""")
oracle("k19_matched_ids", "SELECT * FROM matched_objects")
