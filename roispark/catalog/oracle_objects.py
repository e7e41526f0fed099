"""SQL for sources, labels, metrics, gates and bins."""

from __future__ import annotations

from roispark.catalog.oracle_pixels import K, KP, PX, PY
from roispark.catalog.oracles import cte, oracle, r
from roispark.schema import INTENSITY_METRICS, SHAPE_METRICS

OBJ = f"{K}, object_id"

# --- sources -------------------------------------------------------------------
oracle("s1_read_roi_pixels", f"""SELECT {K}, object_id AS roi, x, y, object_id + 7 AS cell_id, object_id FROM roi_pixels""")
oracle("s2_read_organoids", """SELECT acquisition_id, image_number, object_number, area_shape_area
 FROM (SELECT *, count(*) OVER (PARTITION BY acquisition_id) AS n FROM organoid_rows) WHERE n = 1 OR image_number = 1""")
oracle("s3_read_centroids", f"""SELECT {OBJ}, {r('x','x')}, {r('y','y')}, count(*) OVER (PARTITION BY {K}) AS points,
 count(*) OVER (PARTITION BY {K}) >= 3 AS enough_points
 FROM (SELECT {OBJ}, avg(x) AS x, avg(y) AS y FROM roi_pixels WHERE object_id % 10 <> 0 GROUP BY ALL)""")
oracle("s4_organoid_area", f"""SELECT acquisition_id, {r('a.organoid_area_px','all_area_px')}, a.n AS all_count,
 {r('p.organoid_area_px','organoid_area_px')}, p.organoid_count
 FROM (SELECT acquisition_id, sum(area_shape_area) AS organoid_area_px, count(*) AS n FROM organoid_rows
 WHERE area_shape_area IS NOT NULL GROUP BY 1) a FULL JOIN organoid_area_pos p USING (acquisition_id)""")
oracle("s5_load_run", """SELECT acquisition_id, count(*) AS rows, sum(object_a)::BIGINT AS sum_object_a, 'overlap' AS table_name
 FROM overlap WHERE channel_a = 1 AND channel_b = 0 GROUP BY 1
 UNION ALL SELECT acquisition_id, count(*), sum(object_a)::BIGINT, 'matching'
 FROM matches WHERE channel_a = 1 AND channel_b = 0 GROUP BY 1""")

oracle("s6_run_bundle", " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, count(*) FILTER (channel_b = 0) AS rows_of_nuclear_pairs,
 (sum(object_b) FILTER (channel_b = 0))::BIGINT AS sum_object_b, count(*) AS rows, '{{"threshold": 0.25}}' AS metadata FROM {source}"""
    for name, source in (("overlap", "overlap"), ("eligible_pairs", "overlap WHERE eligible"), ("positive_objects", "matches"),
                         ("cell_id_mapping", "cells"))))

# --- labels --------------------------------------------------------------------
cte("label_px", f"SELECT {K}, x, y, 97*min(object_id) AS level FROM roi_pixels GROUP BY ALL HAVING min(object_id) <> 0")
cte("level_rank", f"""SELECT {K}, level, row_number() OVER (PARTITION BY {K} ORDER BY level) AS roi
 FROM (SELECT DISTINCT {K}, level FROM label_px)""")
cte("label_roi", f"SELECT {K}, roi, x, y, level FROM label_px JOIN level_rank USING ({K}, level)")
cte("lab_summary", f"""SELECT {K}, roi, count(*) AS pixel_count, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y,
 max(y) AS max_y, avg(x) AS center_x, avg(y) AS center_y, min(level) AS level FROM label_roi GROUP BY ALL""")
oracle("l1_relabel", f"SELECT {K}, roi, x, y, level FROM label_roi")
oracle("l2_level_spacing", f"""SELECT {K}, count(*) AS levels, min(gap) AS min_gap, max(gap) AS max_gap,
 {r('avg(gap)','mean_gap')}, max(gap) - min(gap) <= 2 AS evenly_spaced
 FROM (SELECT {K}, lead(level) OVER (PARTITION BY {K} ORDER BY level) - level AS gap FROM level_rank) GROUP BY {K}""")
oracle("l3_label_summary", f"""SELECT {K}, roi, pixel_count, min_x, max_x, min_y, max_y, {r('center_x','center_x')},
 {r('center_y','center_y')}, level FROM lab_summary""")
oracle("l4_label_to_pixels", f"SELECT {K}, roi, x, y FROM label_roi")
cte("lab_measured", f"""SELECT {K}, CASE WHEN level % 13 = 0 THEN roi + 100000 ELSE roi END AS roi,
 pixel_count + CASE WHEN level % 7 = 0 THEN 1 ELSE 0 END AS area, min_x,
 max_x + CASE WHEN level % 3 = 0 THEN 0 ELSE 1 END AS max_x, min_y, max_y + 1 AS max_y,
 center_x + CASE WHEN level % 5 = 0 THEN 0.25 ELSE 0 END AS center_x, center_y FROM lab_summary WHERE level % 11 <> 0""")
cte("verified", f"""SELECT *, roi_status = 'MATCH' AND area_match AND bounding_box_match AND center_match AS full_match FROM (
 SELECT {K}, roi, CASE WHEN m.area IS NOT NULL AND s.level IS NOT NULL THEN 'MATCH' WHEN m.area IS NOT NULL THEN 'CP_ONLY'
 ELSE 'TIFF_ONLY' END AS roi_status, s.pixel_count - m.area AS area_difference, s.min_x - m.min_x AS min_x_difference,
 s.max_x - m.max_x AS max_x_difference, s.min_y - m.min_y AS min_y_difference, s.max_y - m.max_y AS max_y_difference,
 s.center_x - m.center_x AS center_x_difference, s.center_y - m.center_y AS center_y_difference,
 coalesce(s.pixel_count = m.area, false) AS area_match,
 coalesce(s.min_x = m.min_x AND s.max_x = m.max_x - 1 AND s.min_y = m.min_y AND s.max_y = m.max_y - 1, false) AS bounding_box_match,
 coalesce(abs(s.center_x - m.center_x) <= 1e-6 AND abs(s.center_y - m.center_y) <= 1e-6, false) AS center_match
 FROM lab_measured m FULL JOIN lab_summary s USING ({K}, roi))""")
oracle("l5_verify_labels", f"""SELECT * REPLACE ({r('center_x_difference','center_x_difference')},
 {r('center_y_difference','center_y_difference')}) FROM verified""")
oracle("l6_verify_summary", f"""SELECT {K}, count(*) FILTER (roi_status <> 'TIFF_ONLY') AS measured_rois,
 count(*) FILTER (roi_status <> 'CP_ONLY') AS reconstructed_rois, count(*) FILTER (roi_status = 'MATCH') AS matched,
 count(*) FILTER (roi_status = 'CP_ONLY') AS cp_only, count(*) FILTER (roi_status = 'TIFF_ONLY') AS tiff_only,
 count(*) FILTER (roi_status = 'MATCH' AND area_match) AS area_matches,
 count(*) FILTER (roi_status = 'MATCH' AND bounding_box_match) AS bounding_box_matches,
 count(*) FILTER (roi_status = 'MATCH' AND center_match) AS center_matches,
 count(*) FILTER (roi_status = 'MATCH' AND full_match) AS full_matches,
 bool_and(roi_status = 'MATCH') AS numbering_identical FROM verified GROUP BY {K}""")
oracle("l7_roi_density", f"""SELECT {K}, count(*) AS roi_count, any_value(organoid_area_px) AS organoid_area_px,
 {r('count(*)/any_value(organoid_area_px)','density_per_px',9)}, {r('count(*)/any_value(organoid_area_px)*100000','density_per_100k_px',9)},
 {r('count(*)/any_value(organoid_area_px)*1000000','density_per_1m_px',9)}
 FROM lab_summary JOIN organoid_area USING (acquisition_id) GROUP BY {K}""")
cte("lab_near", f"""SELECT p.*,
 EXISTS (SELECT 1 FROM label_px q WHERE q.acquisition_id=p.acquisition_id AND q.channel=p.channel AND q.level=p.level AND q.y=p.y AND q.x=p.x-1) AS l,
 EXISTS (SELECT 1 FROM label_px q WHERE q.acquisition_id=p.acquisition_id AND q.channel=p.channel AND q.level=p.level AND q.y=p.y AND q.x=p.x+1) AS g,
 EXISTS (SELECT 1 FROM label_px q WHERE q.acquisition_id=p.acquisition_id AND q.channel=p.channel AND q.level=p.level AND q.x=p.x AND q.y=p.y-1) AS u,
 EXISTS (SELECT 1 FROM label_px q WHERE q.acquisition_id=p.acquisition_id AND q.channel=p.channel AND q.level=p.level AND q.x=p.x AND q.y=p.y+1) AS b
 FROM label_px p""")
oracle("l8_label_boundary", f"""SELECT {K}, level, 'edge_is_inside' AS edge_rule, x, y FROM lab_near
 WHERE NOT ((l OR x = 0) AND (g OR x = 248) AND (u OR y = 0) AND (b OR y = 246))
 UNION ALL SELECT {K}, level, 'edge_is_boundary', x, y FROM lab_near WHERE NOT (l AND g AND u AND b)""")
cte("stack_px", f"""SELECT *, CASE WHEN z <= 1 + acquisition_id % 3 AND y < 64 - acquisition_id % 9
 AND x < 64 - channel*5 - acquisition_id % 4 THEN cast((x*131 + y*17 + (z+1)*7 + (acquisition_id+1)*(channel+1)*29) % 4096 AS double) ELSE 0 END AS v
 FROM (SELECT *, unnest(range(64)) AS x FROM (SELECT *, unnest(range(64)) AS y FROM (SELECT *, unnest(range(4)) AS z
 FROM (SELECT DISTINCT {K} FROM objects))))""")
cte("flat_px", f"SELECT {K}, x, y, max(v) AS value FROM stack_px GROUP BY ALL")
oracle("l9_max_project", f"SELECT {K}, x, y, {r('value','value')} FROM flat_px")
oracle("l10_usable_z", f"SELECT {K}, max(z) FILTER (v <> 0) + 1 AS usable_planes FROM stack_px GROUP BY {K}")
oracle("l11_trim_extent", f"""SELECT {K}, max(y) FILTER (corner) + 1 AS height, max(x) FILTER (corner) + 1 AS width,
 CASE WHEN bool_or(corner) THEN 'ok' ELSE 'no_signal' END AS status
 FROM (SELECT *, v <> 0 AND y BETWEEN 40 AND 63 AND x BETWEEN 40 AND 63 AS corner FROM stack_px) GROUP BY {K}""")
oracle("l12_downsample", f"""SELECT {K}, x//5 AS x, y//5 AS y, {r('greatest(least(round_even(avg(value), 0), 65535), 0)','value')}
 FROM flat_px WHERE x < 60 AND y < 60 GROUP BY {K}, x//5, y//5""")
oracle("l13_out_of_bounds", f"""SELECT {K}, count(*) FILTER (x >= 200 OR y >= 180 + acquisition_id % 50) AS out_of_bounds_px,
 count(*) AS all_px FROM roi_pixels GROUP BY {K}""")

# --- metrics -------------------------------------------------------------------
cte("intensity", f"""SELECT {OBJ}, avg(v) AS mean_intensity, quantile_cont(v, 0.5) AS median_intensity, max(v) AS max_intensity,
 sum(v) AS integrated_intensity, stddev_pop(v) AS intensity_sd, min(v) AS min_intensity,
 quantile_cont(v, 0.05) AS p05_intensity, quantile_cont(v, 0.95) AS p95_intensity FROM roi_values GROUP BY ALL""")
oracle("m1_intensity", f"SELECT {OBJ}, {', '.join(r(m, m) for m in INTENSITY_METRICS)} FROM intensity")
oracle("m2_intensity_extended", f"SELECT {OBJ}, " + ", ".join(r(m, m) for m in (
    "mean_intensity", "median_intensity", "intensity_sd", "min_intensity", "p05_intensity", "p95_intensity",
    "max_intensity")) + " FROM intensity")
cte("pairs_hv", f"""SELECT {OBJ}, sum(CASE WHEN px = x-1 THEN 1 ELSE 0 END) AS h, sum(CASE WHEN py = y-1 THEN 1 ELSE 0 END) AS v
 FROM (SELECT *, lag(x) OVER (PARTITION BY {OBJ}, y ORDER BY x) AS px, lag(y) OVER (PARTITION BY {OBJ}, x ORDER BY y) AS py
 FROM roi_pixels) GROUP BY ALL""")
cte("shape0", f"""SELECT {OBJ}, count(*) AS n, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y,
 avg(x) AS center_x, avg(y) AS center_y,
 cast(count(*)*sum(x*x) - sum(x)*sum(x) AS double) AS vx, cast(count(*)*sum(y*y) - sum(y)*sum(y) AS double) AS vy,
 cast(count(*)*sum(x*y) - sum(x)*sum(y) AS double) AS c FROM roi_pixels GROUP BY ALL""")
cte("shape1", f"""SELECT *, n*{PX}*{PY} AS area_um2, 2*(n-v)*{PX} + 2*(n-h)*{PY} AS perimeter_um,
 n::DOUBLE/((max_x-min_x+1)*(max_y-min_y+1)) AS extent,
 vx/(n*n)*{PX}*{PX} AS a, vy/(n*n)*{PY}*{PY} AS d, c/(n*n)*{PX}*{PY} AS b FROM shape0 JOIN pairs_hv USING ({OBJ})""")
cte("shape2", """SELECT *, CASE WHEN n >= 2 THEN (a+d)/2 + sqrt(((a-d)/2)*((a-d)/2) + b*b) END AS l1,
 CASE WHEN n >= 2 THEN CASE WHEN vx*vy = c*c THEN 0 ELSE greatest((a+d)/2 - sqrt(((a-d)/2)*((a-d)/2) + b*b), 0) END END AS l2
 FROM shape1""")
cte("rim", f"""SELECT {OBJ}, y, min(x) AS x FROM roi_pixels GROUP BY {OBJ}, y
 UNION SELECT {OBJ}, y, max(x) AS x FROM roi_pixels GROUP BY {OBJ}, y""")
# A hull edge p->q: every other point lies strictly left of it or on the segment itself.
cte("hull", f"""SELECT {OBJ}, sum(cr)/2.0 AS hull_px FROM (
 SELECT {OBJ}, any_value(p.x*q.y - p.y*q.x) AS cr FROM rim p JOIN rim q USING ({OBJ}) JOIN rim s USING ({OBJ})
 WHERE p.x <> q.x OR p.y <> q.y GROUP BY {OBJ}, p.x, p.y, q.x, q.y
 HAVING bool_and((q.x-p.x)*(s.y-p.y) - (q.y-p.y)*(s.x-p.x) > 0 OR ((q.x-p.x)*(s.y-p.y) - (q.y-p.y)*(s.x-p.x) = 0
  AND (s.x-p.x)*(s.x-q.x) + (s.y-p.y)*(s.y-q.y) <= 0))) GROUP BY {OBJ}""")
cte("shape3", f"""SELECT *, CASE WHEN hull_px > 0 THEN hull_px*{PX}*{PY} END AS convex_hull_area_um2,
 CASE WHEN hull_px > 0 THEN area_um2/(hull_px*{PX}*{PY}) ELSE 1.0 END AS solidity,
 CASE WHEN perimeter_um > 0 THEN 4*pi()*area_um2/(perimeter_um*perimeter_um) END AS circularity,
 CASE WHEN l1 > 0 THEN sqrt(greatest(1 - l2/l1, 0)) WHEN l1 <= 0 THEN 0 END AS eccentricity,
 4*sqrt(l1) AS major_axis_um, 4*sqrt(l2) AS minor_axis_um, CASE WHEN l2 > 0 THEN sqrt(l1)/sqrt(l2) END AS aspect_ratio,
 sqrt(4*area_um2/pi()) AS equivalent_diameter_um, n AS area_px FROM shape2 LEFT JOIN hull USING ({OBJ})""")
cte("shape_nohull", f"""SELECT *, n AS area_px,
 CASE WHEN perimeter_um > 0 THEN 4*pi()*area_um2/(perimeter_um*perimeter_um) END AS circularity,
 CASE WHEN l1 > 0 THEN sqrt(greatest(1 - l2/l1, 0)) WHEN l1 <= 0 THEN 0 END AS eccentricity FROM shape2""")
oracle("m3_area", f"SELECT {OBJ}, n AS area_px, {r('area_um2','area_um2')} FROM shape1")
oracle("m4_bounding_box", f"""SELECT {OBJ}, min_x, max_x, min_y, max_y, {r('center_x','center_x')}, {r('center_y','center_y')},
 {r('extent','extent')} FROM shape1""")
oracle("m5_perimeter", f"SELECT {OBJ}, {r('perimeter_um','perimeter_um',9)} FROM shape1")
oracle("m6_convex_hull", f"SELECT {OBJ}, {r('convex_hull_area_um2','convex_hull_area_um2')} FROM shape3")
oracle("m7_solidity", f"SELECT {OBJ}, {r('solidity','solidity')} FROM shape3")
oracle("m8_circularity", f"SELECT {OBJ}, {r('circularity','circularity')} FROM shape3")
oracle("m9_second_moments", f"SELECT {OBJ}, " + ", ".join(r(c, c) for c in (
    "eccentricity", "major_axis_um", "minor_axis_um", "aspect_ratio")) + " FROM shape3")
oracle("m10_equivalent_diameter", f"SELECT {OBJ}, {r('equivalent_diameter_um','equivalent_diameter_um')} FROM shape3")
oracle("m11_roi_metrics", f"""SELECT {OBJ}, area_px, min_x, max_x, min_y, max_y, {r('center_x','center_x')}, {r('center_y','center_y')},
 {', '.join(r(m, m, 9 if m == 'perimeter_um' else 6) for m in SHAPE_METRICS if m != 'area_px')}, {', '.join(r(m, m) for m in INTENSITY_METRICS)}
 FROM shape3 LEFT JOIN intensity USING ({OBJ})""")

# --- gates ---------------------------------------------------------------------
cte("gate_in", f"""SELECT {OBJ}, mean_intensity, intensity_sd, area_px, circularity, eccentricity
 FROM shape_nohull JOIN intensity USING ({OBJ})""")


def _cut(metric, p):
    return f"quantile_cont({metric}::DOUBLE, {p})"


oracle("g2_cutoffs", f"""SELECT {K}, {r(_cut('mean_intensity',0.2),'cutoff_mean_intensity')}, {r(_cut('intensity_sd',0.95),'cutoff_intensity_sd')},
 {r(_cut('area_px',0.1),'cutoff_area_px')}, {r(_cut('circularity',0.15),'cutoff_circularity')}, {r(_cut('eccentricity',0.9),'cutoff_eccentricity')}
 FROM gate_in GROUP BY {K}""")
cte("gated1", f"""SELECT *, pm AND ps AS pall FROM (SELECT g.*, coalesce(mean_intensity >= c1, false) AS pm, coalesce(intensity_sd <= c2, false) AS ps
 FROM gate_in g JOIN (SELECT {K}, {_cut('mean_intensity',0.2)} AS c1, {_cut('intensity_sd',0.95)} AS c2 FROM gate_in GROUP BY {K}) USING ({K}))""")
oracle("g3_gate_status", f"""SELECT {OBJ}, pm AS pass_mean_intensity, ps AS pass_intensity_sd, true AS pass_max_intensity,
 pall AS pass_all_filters FROM gated1""")
oracle("g4_split_gate", f"""SELECT {OBJ}, x, y, CASE WHEN pall THEN 'kept' ELSE 'removed' END AS status
 FROM roi_pixels JOIN gated1 USING ({OBJ})""")
cte("gated2", f"""SELECT {OBJ}, coalesce(area_px >= c1 AND circularity >= c2 AND eccentricity <= c3, false) AS pass_second
 FROM gated1 JOIN (SELECT {K}, {_cut('area_px',0.1)} AS c1, {_cut('circularity',0.15)} AS c2, {_cut('eccentricity',0.9)} AS c3
 FROM gated1 WHERE pall GROUP BY {K}) USING ({K}) WHERE pall""")
oracle("g5_two_pass_gate", f"""SELECT {OBJ}, pall AS pass_first, pass_second, coalesce(pass_second, false) AS kept
 FROM gated1 LEFT JOIN gated2 USING ({OBJ})""")

# --- bins ----------------------------------------------------------------------
cte("area_bins", f"""SELECT {OBJ}, area_px, bin, (bin*5) || '–' || (bin*5+5) || 'th percentile' AS bin_label
 FROM (SELECT *, ntile(20) OVER (PARTITION BY {K} ORDER BY area_px, object_id) - 1 AS bin FROM areas)""")
oracle("b1_percentile_bins", f"SELECT {OBJ}, area_px, bin, bin_label FROM area_bins")
oracle("b2_bin_sample", f"""SELECT {OBJ}, area_px, bin, bin_label FROM (SELECT *, row_number() OVER (PARTITION BY {K}, bin
 ORDER BY md5('42|' || acquisition_id || '|' || channel || '|' || bin || '|' || object_id), object_id) AS pick FROM area_bins) WHERE pick <= 5""")
cte("area_span", f"SELECT {K}, min(area_px)::DOUBLE AS lo, max(area_px)::DOUBLE AS hi FROM areas GROUP BY {K}")
cte("area_hist", f"""SELECT {K}, least(floor((area_px-lo)*50/(hi-lo))::BIGINT, 49) AS bin, count(*) AS n
 FROM areas JOIN area_span USING ({K}) GROUP BY ALL""")
oracle("b3_histogram", f"""SELECT {K}, bin, {r('lo+(hi-lo)/50*bin','bin_start')}, {r('lo+(hi-lo)/50*(bin+1)','bin_end')},
 coalesce(n, 0) AS count FROM (SELECT *, unnest(range(50)) AS bin FROM area_span) LEFT JOIN area_hist USING ({K}, bin)""")
oracle("b4_percentile_boundaries", f"SELECT {K}, " + ", ".join(
    r(f"quantile_cont(mean_intensity, {p}/100.0::DOUBLE)", f"p{p:02d}") for p in range(5, 100, 5)) + f" FROM intensity GROUP BY {K}")
cte("matched_objects", """SELECT acquisition_id, channel_a AS channel, object_a AS object_id FROM matches
 UNION SELECT acquisition_id, channel_b, object_b FROM matches""")
cte("quart", f"""SELECT *, count(*) OVER w AS n, min(mean_intensity) OVER w AS lo, max(mean_intensity) OVER w AS hi,
 row_number() OVER (PARTITION BY {K}, quartile ORDER BY mean_intensity, object_id) AS i FROM (
 SELECT {OBJ}, mean_intensity, ntile(4) OVER (PARTITION BY {K} ORDER BY mean_intensity, object_id) AS quartile
 FROM intensity JOIN matched_objects USING ({OBJ})) WINDOW w AS (PARTITION BY {K}, quartile)""")
oracle("b5_quartile_exemplars", f"""SELECT {OBJ}, {r('mean_intensity','mean_intensity')}, quartile, n AS quartile_count,
 {r('lo','quartile_min')}, {r('hi','quartile_max')}, i AS rank_in_quartile FROM quart
 WHERE n <= 10 OR list_contains(list_transform(range(10), lambda j: j*(n-1)//9), i-1)""")


def _bins(source, percent, view, keys, extra=""):
    return f"""SELECT {keys}, '{view}' AS view, bin, bin*5 AS bin_start, bin*5+5 AS bin_end, coalesce(n, 0) AS available,
 least(coalesce(n, 0), 5) AS selected FROM (SELECT *, unnest(range(20)) AS bin FROM (SELECT DISTINCT {keys} FROM {source[1]}))
 LEFT JOIN (SELECT {keys}, least(floor({percent}/5)::BIGINT, 19) AS bin, count(*) AS n FROM {source[0]} GROUP BY ALL) USING ({keys}, bin) {extra}"""


cte("matched_pct", f"SELECT {KP}, a_percent_inside_b FROM matches JOIN overlap USING ({KP}, object_a, object_b)")
cte("low_pct", f"""SELECT {KP}, best_a_percent_inside_b FROM best_b
 WHERE ({KP}, object_a) NOT IN (SELECT ({KP}, object_a) FROM overlap WHERE eligible)""")
oracle("b6_overlap_bins", _bins(("matched_pct", "overlap"), "a_percent_inside_b", "Above threshold", KP) + " UNION ALL "
       + _bins(("low_pct", "overlap"), "best_a_percent_inside_b", "Below threshold", KP, "WHERE bin*5 < 25"))
cte("single_pos", f"""SELECT {KP}, 'a' AS side, object_a AS object_id, best_object_b AS context_object_id,
 coalesce(best_shared_area, 0) AS intersection_px, coalesce(best_a_percent_inside_b, 0.0) AS focal_overlap_percent,
 CASE WHEN best_object_b IS NULL THEN 'No spatial overlap with any Object B ROI'
 WHEN ({KP}, object_a) IN (SELECT ({KP}, object_a) FROM overlap WHERE eligible)
 THEN 'Eligible pair existed, but A was not retained in final one-to-one match'
 ELSE 'Best Object B overlap remained below the A-inside-B threshold' END AS reason
 FROM a_ids LEFT JOIN best_b USING ({KP}, object_a) WHERE ({KP}, object_a) NOT IN (SELECT ({KP}, object_a) FROM matches)
 UNION ALL SELECT {KP}, 'b', object_b, best_object_a, coalesce(best_shared_area, 0), coalesce(best_b_percent_inside_a, 0.0),
 CASE WHEN best_object_a IS NULL THEN 'No spatial overlap with any Object A ROI'
 WHEN ({KP}, object_b) IN (SELECT ({KP}, object_b) FROM overlap WHERE eligible)
 THEN 'Eligible pair existed, but B was not retained in final one-to-one match'
 ELSE 'Only non-eligible/sub-threshold Object A partners overlapped B' END
 FROM b_ids LEFT JOIN best_a USING ({KP}, object_b) WHERE ({KP}, object_b) NOT IN (SELECT ({KP}, object_b) FROM matches)""")
oracle("b7_unmatched_bins", _bins(("single_pos", "single_pos"), "focal_overlap_percent", "Unmatched", f"{KP}, side"))
oracle("b8_pair_sample", f"""SELECT {KP}, object_a, object_b FROM (SELECT *, row_number() OVER (PARTITION BY {KP}
 ORDER BY md5('42|' || acquisition_id || '|' || channel_a || '|' || channel_b || '|' || object_a || '|' || object_b), object_a, object_b) AS pick
 FROM matches) WHERE pick <= 15""")
