"""SQL for mask quality control and registration."""

from __future__ import annotations

from roispark.catalog.oracle_pixels import PX, PY
from roispark.catalog.oracles import cte, oracle, r

K = "acquisition_id, channel"

cte("ch_masks", """SELECT acquisition_id, 1::BIGINT AS channel, 'o' AS k, x, y FROM mask_pixels WHERE kind = 'organoid'
 UNION ALL SELECT acquisition_id, 2, 'o', x, y FROM mask_pixels WHERE kind = 'reference'
 UNION ALL SELECT acquisition_id, c, CASE kind WHEN 'cell' THEN 'c' ELSE 'r' END, x, y
 FROM mask_pixels, (VALUES (1::BIGINT), (2)) t(c) WHERE kind <> 'organoid'""")
cte("ch_px", f"SELECT {K}, x, y, bool_or(k='o') AS o, bool_or(k='c') AS c, bool_or(k='r') AS r FROM ch_masks GROUP BY ALL")
cte("ch_stats", f"""SELECT {K}, 64::BIGINT AS height, 64::BIGINT AS width, count(*) FILTER (o) AS organoid_mask_area_px,
 count(*) FILTER (c) AS segmented_cell_px, count(*) FILTER (c AND NOT o) AS cell_px_outside_organoid,
 count(*) FILTER (r) AS reference_mask_area_px, count(*) FILTER (o <> r) AS organoid_mask_disagreement_px,
 count(*) FILTER (o AND NOT r) AS organoid_mask_px_outside_reference,
 count(*) FILTER (r AND NOT o) AS reference_mask_px_missing_from_organoid,
 count(*) FILTER (c AND NOT r) AS cell_px_outside_reference,
 coalesce(bool_or(o AND (x = 0 OR y = 0 OR x = 63 OR y = 63)), false) AS touches_image_border FROM ch_px GROUP BY {K}""")
oracle("q1_mask_statistics", f"""SELECT * EXCLUDE (touches_image_border),
 {r('CASE WHEN segmented_cell_px > 0 THEN 100.0*cell_px_outside_organoid/segmented_cell_px ELSE 0 END','cell_px_outside_organoid_percent')},
 {r('CASE WHEN reference_mask_area_px > 0 THEN 100.0*organoid_mask_disagreement_px/reference_mask_area_px ELSE 0 END','organoid_mask_disagreement_percent_of_reference')},
 {r('CASE WHEN segmented_cell_px > 0 THEN 100.0*cell_px_outside_reference/segmented_cell_px ELSE 0 END','cell_px_outside_reference_percent')} FROM ch_stats""")
oracle("q3_touches_border", f"SELECT {K}, touches_image_border FROM ch_stats")
oracle("q4_mask_violations", f"""SELECT {K}, 'organoid_differs_from_reference' AS "check" FROM ch_stats WHERE organoid_mask_disagreement_px > 0
 UNION ALL SELECT {K}, 'cells_outside_organoid' FROM ch_stats WHERE cell_px_outside_organoid > 0
 UNION ALL SELECT {K}, 'reference_mask_empty' FROM ch_stats WHERE reference_mask_area_px = 0
 UNION ALL SELECT {K}, 'organoid_mask_empty' FROM ch_stats WHERE organoid_mask_area_px = 0""")
oracle("q5_max_disagreement", """SELECT acquisition_id, max(organoid_mask_disagreement_px) AS max_disagreement_px,
 max(organoid_mask_disagreement_px) = 0 AS masks_agree FROM ch_stats GROUP BY 1""")
# Minimum-label propagation over 8 x 8 blocks would depend on the fixture's shape; the
# statement below works on pixel runs of a row instead and holds for any mask.
cte("m_runs", f"""SELECT {K}, y, min(x) AS x0, max(x) AS x1, y*100000+min(x) AS node FROM (
 SELECT {K}, y, x, x - row_number() OVER (PARTITION BY {K}, y ORDER BY x) AS isl FROM ch_px WHERE o) GROUP BY {K}, y, isl""")
cte("m_edges", f"""SELECT a.acquisition_id, a.channel, a.node AS u, b.node AS v FROM m_runs a JOIN m_runs b
 ON a.acquisition_id = b.acquisition_id AND a.channel = b.channel AND b.y IN (a.y-1, a.y+1) AND a.x0 <= b.x1 AND b.x0 <= a.x1""")
cte("m_reach", f"""SELECT acquisition_id, channel, node, node AS seen FROM m_runs
 UNION SELECT r.acquisition_id, r.channel, r.node, e.v FROM m_reach r JOIN m_edges e
 ON e.acquisition_id = r.acquisition_id AND e.channel = r.channel AND e.u = r.seen""")
oracle("q2_connected_components", f"""SELECT {K}, count(*) AS connected_components, max(area) AS largest_component_area_px FROM (
 SELECT {K}, comp, sum(x1-x0+1)::BIGINT AS area FROM m_runs JOIN (SELECT {K}, node, min(seen) AS comp FROM m_reach GROUP BY ALL) USING ({K}, node)
 GROUP BY ALL) GROUP BY {K}""")

# --- registration --------------------------------------------------------------
cte("c_fixed", "SELECT acquisition_id, object_id, avg(x) AS x, avg(y) AS y FROM roi_pixels WHERE channel = 1 GROUP BY ALL")
cte("c_moving", """SELECT acquisition_id, object_id, x*9999.0::DOUBLE/10001.0::DOUBLE - y*200.0::DOUBLE/10001.0::DOUBLE + 3.5 AS x,
 x*200.0::DOUBLE/10001.0::DOUBLE + y*9999.0::DOUBLE/10001.0::DOUBLE - 2.25 AS y FROM c_fixed""")
cte("c_box", """SELECT acquisition_id, min(x) AS x0, min(y) AS y0, greatest(max(x)-min(x), 1e-9) AS w, greatest(max(y)-min(y), 1e-9) AS h
 FROM c_fixed GROUP BY 1""")
cte("c_cell", """SELECT f.*, least(floor((x-x0)/w*10), 9) AS cx, least(floor((y-y0)/h*10), 9) AS cy FROM c_fixed f JOIN c_box USING (acquisition_id)""")
oracle("r1_spatial_subsample", f"""SELECT acquisition_id, object_id, {r('x','x')}, {r('y','y')} FROM (
 SELECT *, row_number() OVER (PARTITION BY acquisition_id ORDER BY later, md5('42|' || acquisition_id || '|' || object_id), object_id) AS k FROM (
 SELECT *, object_id <> min(object_id) OVER (PARTITION BY acquisition_id, cx, cy) AS later FROM c_cell)) WHERE k <= 100""")
cte("c_pairs", """SELECT m.acquisition_id, m.object_id AS moving_id, f.object_id AS fixed_id,
 (m.x-f.x)*(m.x-f.x) + (m.y-f.y)*(m.y-f.y) AS d2 FROM c_moving m JOIN c_fixed f ON m.acquisition_id = f.acquisition_id
 AND (m.x-f.x)*(m.x-f.x) + (m.y-f.y)*(m.y-f.y) <= 144""")
oracle("r2_gated_pairs", f"SELECT acquisition_id, moving_id, fixed_id, {r('d2','d2')} FROM c_pairs")
oracle("r3_mutual_nearest", f"""SELECT acquisition_id, moving_id, fixed_id, {r('d2','d2')} FROM (SELECT *,
 row_number() OVER (PARTITION BY acquisition_id, moving_id ORDER BY d2, fixed_id) AS a,
 row_number() OVER (PARTITION BY acquisition_id, fixed_id ORDER BY d2, moving_id) AS b FROM c_pairs) WHERE a = 1 AND b = 1""")
cte("n_anchor", """SELECT acquisition_id, object_id AS moving_id, m.x*1.002 + (object_id*7 % 13 - 6)*0.05 AS mx,
 m.y + (object_id*5 % 11 - 5)*0.05 + CASE WHEN object_id % 37 = 0 THEN 15.0 ELSE 0 END AS my, f.x AS fx, f.y AS fy
 FROM c_moving m JOIN c_fixed f USING (acquisition_id, object_id)""")
cte("n_sum", """SELECT acquisition_id, count(*) AS n, avg(mx) AS amx, avg(my) AS amy, avg(fx) AS afx, avg(fy) AS afy,
 covar_pop(mx, fx) + covar_pop(my, fy) AS dot, covar_pop(mx, fy) - covar_pop(my, fx) AS crs FROM n_anchor GROUP BY 1""")
cte("n_fit", """SELECT *, afx - a*amx + b*amy AS tx, afy - b*amx - a*amy AS ty FROM (SELECT *, dot/sqrt(dot*dot+crs*crs) AS a,
 crs/sqrt(dot*dot+crs*crs) AS b FROM n_sum WHERE n >= 8)""")
oracle("r4_rigid_fit", f"SELECT acquisition_id, n AS anchors, {r('a','a')}, {r('b','b')}, {r('tx','tx')}, {r('ty','ty')} FROM n_fit")
cte("n_res", """SELECT *, sqrt((tmx-fx)*(tmx-fx) + (tmy-fy)*(tmy-fy)) AS res FROM (
 SELECT n_anchor.*, a*mx - b*my + tx AS tmx, b*mx + a*my + ty AS tmy FROM n_anchor JOIN n_fit USING (acquisition_id))""")
cte("n_cut", """SELECT acquisition_id, least(12.0, greatest(3.0, any_value(med) + 3.5*1.4826*quantile_cont(abs(res-med), 0.5))) AS cut
 FROM n_res JOIN (SELECT acquisition_id, quantile_cont(res, 0.5) AS med FROM n_res GROUP BY 1) USING (acquisition_id) GROUP BY 1""")
oracle("r5_trim_anchors", f"""SELECT acquisition_id, moving_id, {r('res','residual_px')}, {r('cut','cutoff_px')},
 res <= cut OR count(*) FILTER (res <= cut) OVER (PARTITION BY acquisition_id) < 8 AS keep FROM n_res JOIN n_cut USING (acquisition_id)""")
# The moving points are an exact rotation and shift, so the composed result is its inverse.
oracle("r6_register", f"""SELECT acquisition_id, {r('9999.0/10001.0','a',5)}, {r('-200.0/10001.0','b',5)},
 {r('(-3.5*9999.0 + 2.25*200.0)/10001.0','tx',5)}, {r('(3.5*200.0 + 2.25*9999.0)/10001.0','ty',5)}
 FROM (SELECT DISTINCT acquisition_id FROM objects)""")
cte("n_cov", """SELECT acquisition_id, avg(tmx) AS ax, avg(tmy) AS ay, avg(fx) AS afx, avg(fy) AS afy, var_pop(tmx) AS sxx, var_pop(tmy) AS syy,
 covar_pop(tmx, tmy) AS sxy, covar_pop(tmx, fx) AS xfx, covar_pop(tmx, fy) AS xfy, covar_pop(tmy, fx) AS yfx, covar_pop(tmy, fy) AS yfy
 FROM n_res GROUP BY 1""")
cte("n_aff", """SELECT *, afx - a11*ax - a12*ay AS shift_x, afy - a21*ax - a22*ay AS shift_y FROM (SELECT *, (xfx*syy - yfx*sxy)/(sxx*syy-sxy*sxy) AS a11,
 (yfx*sxx - xfx*sxy)/(sxx*syy-sxy*sxy) AS a12, (xfy*syy - yfy*sxy)/(sxx*syy-sxy*sxy) AS a21, (yfy*sxx - xfy*sxy)/(sxx*syy-sxy*sxy) AS a22 FROM n_cov)""")
cte("n_med", """SELECT acquisition_id, quantile_cont(res, 0.5) AS rm, quantile_cont(sqrt((a11*tmx+a12*tmy+shift_x-fx)*(a11*tmx+a12*tmy+shift_x-fx)
 + (a21*tmx+a22*tmy+shift_y-fy)*(a21*tmx+a22*tmy+shift_y-fy)), 0.5) AS am FROM n_res JOIN n_aff USING (acquisition_id) GROUP BY 1""")
oracle("r7_affine", f"""SELECT acquisition_id, {r('rm','rigid_median_px')}, {r('am','affine_median_px')}, {r('(rm-am)/rm','improvement')},
 CASE WHEN (rm-am)/rm >= 0.15 THEN 'Affine' ELSE 'Rigid' END AS model, {', '.join(r(c, c) for c in ('a11','a12','a21','a22','shift_x','shift_y'))}
 FROM n_med JOIN n_aff USING (acquisition_id)""")
oracle("r8_anchor_table", f"""SELECT acquisition_id, moving_id, moving_id AS fixed_id, {', '.join(r(c, c) for c in ('mx','my','fx','fy','tmx','tmy'))},
 {r('res','residual_px')}, {r(f'res*sqrt({PX}*{PY})','residual_um_approx')}, anchors, {r('med','median_px')}, {r('p95','p95_px')}
 FROM n_res JOIN (SELECT acquisition_id, count(*) AS anchors, quantile_cont(res, 0.5) AS med, quantile_cont(res, 0.95) AS p95 FROM n_res GROUP BY 1)
 USING (acquisition_id)""")
