"""SQL for sources, labels, metrics, gates, bins, overlap, matching and masks."""

from __future__ import annotations

from roispark.catalog.oracles import PX, PY, cte, oracle, r

K = "acquisition_id, channel"
KP = "acquisition_id, channel_a, channel_b"
PAIR = f"{KP}, object_a, object_b"
THRESHOLD = 0.25

cte("objects", """SELECT o_orderkey // 600 AS acquisition_id, o_orderkey % 3 AS channel,
 o_orderkey AS object_id, (o_custkey*37 + o_orderkey*11) % 240 AS cx,
 (o_orderkey*53 + o_custkey*7) % 240 AS cy, 3 + o_orderkey % 7 AS w, 3 + o_custkey % 5 AS h FROM orders""")
cte("roi_pixels", """SELECT DISTINCT acquisition_id, channel, object_id, cx+i AS x, cy+j AS y
 FROM (SELECT *, unnest(range(h)) AS j FROM (SELECT *, unnest(range(w)) AS i FROM objects))
 WHERE (i+j+object_id) % 11 <> 0""")
cte("roi_values", """SELECT *, cast((x*131 + y*17 + (acquisition_id+1)*(channel+1)*29) % 4096 AS double) AS v
 FROM roi_pixels""")
cte("areas", f"SELECT {K}, object_id, count(*) AS area_px FROM roi_pixels GROUP BY ALL")
cte("pair_list", "SELECT * FROM (VALUES (1::BIGINT,0::BIGINT),(2,0),(1,2)) t(channel_a, channel_b)")
cte("shared", """SELECT a.acquisition_id, p.channel_a, p.channel_b, a.object_id AS object_a,
 b.object_id AS object_b, a.x, a.y
 FROM roi_pixels a JOIN pair_list p ON a.channel = p.channel_a
 JOIN roi_pixels b ON b.acquisition_id = a.acquisition_id AND b.channel = p.channel_b AND b.x = a.x AND b.y = a.y""")
cte("overlap", f"""SELECT s.*, aa.area_px AS a_area, ab.area_px AS b_area,
 s.shared_area / aa.area_px * 100 AS a_percent_inside_b, s.shared_area / ab.area_px * 100 AS b_percent_inside_a,
 s.shared_area / aa.area_px * 100 >= {THRESHOLD} * 100 AS eligible
 FROM (SELECT {PAIR}, count(*) AS shared_area FROM shared GROUP BY ALL) s
 JOIN areas aa ON aa.acquisition_id = s.acquisition_id AND aa.channel = s.channel_a AND aa.object_id = s.object_a
 JOIN areas ab ON ab.acquisition_id = s.acquisition_id AND ab.channel = s.channel_b AND ab.object_id = s.object_b""")
cte("a_ids", f"""SELECT acquisition_id, channel_a, channel_b, object_id AS object_a
 FROM areas JOIN pair_list ON channel = channel_a""")
cte("b_ids", f"""SELECT acquisition_id, channel_a, channel_b, object_id AS object_b
 FROM areas JOIN pair_list ON channel = channel_b""")
cte("best_b", f"""SELECT * EXCLUDE (rn) FROM (SELECT {KP}, object_a, object_b AS best_object_b,
 shared_area AS best_shared_area, a_percent_inside_b AS best_a_percent_inside_b,
 b_percent_inside_a AS best_b_percent_inside_a,
 row_number() OVER (PARTITION BY {KP}, object_a ORDER BY a_percent_inside_b DESC, object_b) AS rn
 FROM overlap) WHERE rn = 1""")
cte("best_a", f"""SELECT * EXCLUDE (rn) FROM (SELECT {KP}, object_b, object_a AS best_object_a,
 shared_area AS best_shared_area, a_percent_inside_b AS best_a_percent_inside_b,
 b_percent_inside_a AS best_b_percent_inside_a,
 row_number() OVER (PARTITION BY {KP}, object_b ORDER BY b_percent_inside_a DESC, object_a) AS rn
 FROM overlap) WHERE rn = 1""")


def matching_ctes(prefix: str, edges: str) -> None:
    """Deferred acceptance as one recursive statement over ``e(g, a, b, score)``."""
    cte(f"{prefix}pref", f"""SELECT g, a, b, score,
 row_number() OVER (PARTITION BY g, a ORDER BY score DESC, b) AS r,
 count(*) OVER (PARTITION BY g, a) AS np FROM {edges}""")
    cte(f"{prefix}st", f"""SELECT 0 AS it, 0 AS kind, g, cast(NULL AS bigint) AS b, a,
 cast(NULL AS double) AS score, cast(0 AS bigint) AS nr, np,
 row_number() OVER (PARTITION BY g ORDER BY a) AS pos FROM (SELECT DISTINCT g, a, np FROM {prefix}pref)
 UNION ALL
 SELECT it+1, kind, g, b, a, score, nr, np, pos FROM (
 WITH ev AS (
  SELECT s.it, f.g, f.b, f.a, f.score, s.nr+1 AS nr, s.np, s.pos FROM {prefix}st s
  JOIN {prefix}pref f ON f.g = s.g AND f.a = s.a AND f.r = s.nr+1 WHERE s.kind = 0
  UNION ALL SELECT it, g, b, a, score, nr, np, cast(-1 AS bigint) FROM {prefix}st WHERE kind = 1),
 w AS (SELECT *, max({{'s': score, 'p': -pos, 'a': a, 'nr': nr, 'np': np}}) OVER (PARTITION BY g, b ORDER BY pos
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
  max({{'s': score, 'p': -pos, 'a': a, 'nr': nr, 'np': np}}) OVER (PARTITION BY g, b) AS best FROM ev)
 SELECT it, 1 AS kind, g, b, a, score, nr, np, cast(NULL AS bigint) AS pos FROM w WHERE a = best.a
 UNION ALL
 SELECT it, 0, g, NULL, CASE WHEN score > prev.s THEN prev.a ELSE a END, NULL,
  CASE WHEN score > prev.s THEN prev.nr ELSE nr END, CASE WHEN score > prev.s THEN prev.np ELSE np END,
  row_number() OVER (PARTITION BY g ORDER BY pos) FROM w WHERE prev IS NOT NULL
  AND (CASE WHEN score > prev.s THEN prev.nr < prev.np ELSE nr < np END)
 ) z WHERE EXISTS (SELECT 1 FROM {prefix}st s2 WHERE s2.kind = 0)""")
    cte(f"{prefix}matched", f"""SELECT g, a, b, score FROM {prefix}st WHERE kind = 1
 AND it = (SELECT max(it) FROM {prefix}st)""")


cte("dense_edges", """SELECT l_orderkey // 20 AS run_id, l_partkey % 12 AS object_a, l_suppkey % 11 AS object_b,
 max(25.0*(1 + l_linenumber % 4))::DOUBLE AS score FROM lineitem GROUP BY ALL""")
cte("de", "SELECT run_id AS g, object_a AS a, object_b AS b, score FROM dense_edges")
matching_ctes("d", "de")
cte("pe", "SELECT {'q': acquisition_id, 'ca': channel_a, 'cb': channel_b} AS g, object_a AS a, object_b AS b, "
          "a_percent_inside_b AS score FROM overlap WHERE eligible")
matching_ctes("p", "pe")
cte("matches", "SELECT g.q AS acquisition_id, g.ca AS channel_a, g.cb AS channel_b, a AS object_a, b AS object_b FROM pmatched")
cte("cells", f"SELECT *, row_number() OVER (PARTITION BY {KP} ORDER BY object_a, object_b) AS cell_id FROM matches")
cte("organoid_rows", """SELECT o_orderkey // 600 AS acquisition_id, 1 + o_orderkey % 2 AS image_number,
 o_orderkey AS object_number, CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN -1.0
 ELSE cast(4000 + o_custkey AS double) END AS area_shape_area FROM orders""")
cte("organoid_area", """SELECT acquisition_id, sum(area_shape_area) AS organoid_area_px
 FROM organoid_rows WHERE area_shape_area IS NOT NULL GROUP BY 1""")
cte("organoid_area_pos", """SELECT acquisition_id, sum(area_shape_area) AS organoid_area_px, count(*) AS organoid_count
 FROM organoid_rows WHERE area_shape_area > 0 GROUP BY 1""")

# --- overlap -----------------------------------------------------------------
oracle("j1_shared_pixels", "SELECT * FROM shared")
oracle("j2_overlap_counts", f"""SELECT {PAIR}, shared_area, a_area, b_area,
 {r('a_percent_inside_b','a_percent_inside_b')}, {r('b_percent_inside_a','b_percent_inside_a')} FROM overlap""")
oracle("j3_eligible_pairs", f"""SELECT {PAIR}, {r('a_percent_inside_b','a_percent_inside_b')} FROM overlap WHERE eligible""")
oracle("j4_pair_status", f"""SELECT q.acquisition_id, p.channel_a, p.channel_b, coalesce(n, 0) AS overlap_pairs,
 CASE WHEN n > 0 THEN 'ok' ELSE 'no_overlap' END AS status
 FROM (SELECT DISTINCT acquisition_id FROM objects) q CROSS JOIN pair_list p
 LEFT JOIN (SELECT {KP}, count(*) AS n FROM overlap GROUP BY ALL) o
 ON o.acquisition_id = q.acquisition_id AND o.channel_a = p.channel_a AND o.channel_b = p.channel_b""")
oracle("j5_best_partner", f"""SELECT 'a' AS side, {KP}, object_a AS object_id, best_object_b AS best_object_id, best_shared_area,
 {r('best_a_percent_inside_b','best_a_percent_inside_b')}, {r('best_b_percent_inside_a','best_b_percent_inside_a')} FROM best_b
 UNION ALL SELECT 'b', {KP}, object_b, best_object_a, best_shared_area,
 {r('best_a_percent_inside_b','best_a_percent_inside_b')}, {r('best_b_percent_inside_a','best_b_percent_inside_a')} FROM best_a""")
oracle("j6_below_threshold", f"""SELECT {KP}, object_a, best_object_b, coalesce(best_shared_area, 0) AS best_shared_area,
 {r('coalesce(best_a_percent_inside_b, 0)','best_a_percent_inside_b')}, {r('coalesce(best_b_percent_inside_a, 0)','best_b_percent_inside_a')}
 FROM a_ids LEFT JOIN best_b USING ({KP}, object_a)
 WHERE ({KP}, object_a) NOT IN (SELECT ({KP}, object_a) FROM overlap WHERE eligible)""")
cte("centres", f"SELECT {K}, object_id, count(*) AS area_px, avg(x) AS cx, avg(y) AS cy FROM roi_pixels GROUP BY ALL")
cte("geom", f"""SELECT o.acquisition_id, channel_a, channel_b, object_a, object_b, a.area_px AS an, b.area_px AS bn, shared_area AS s, a.area_px + b.area_px - shared_area AS u,
 b.cx - a.cx AS dx, b.cy - a.cy AS dy FROM overlap o
 JOIN centres a ON a.acquisition_id = o.acquisition_id AND a.channel = o.channel_a AND a.object_id = o.object_a
 JOIN centres b ON b.acquisition_id = o.acquisition_id AND b.channel = o.channel_b AND b.object_id = o.object_b""")
UM2 = f"({PX} * {PY})"
oracle("j7_pair_geometry", f"""SELECT {PAIR}, an AS a_pixel_count, bn AS b_pixel_count, s AS intersection_pixels, u AS union_pixels,
 {r(f'an*{UM2}','a_area_um2')}, {r(f'bn*{UM2}','b_area_um2')}, {r(f's*{UM2}','intersection_area_um2')}, {r(f'u*{UM2}','union_area_um2')},
 {r('100.0*s/an','a_percent_inside_b')}, {r('100.0*s/bn','b_percent_inside_a')}, {r('100.0*s/u','iou_percent')},
 {r('200.0*s/(an+bn)','dice_percent')}, {r('dx','centroid_dx_px')}, {r('dy','centroid_dy_px')},
 {r('sqrt(dx*dx+dy*dy)','centroid_distance_px')}, {r(f'dx*{PX}','centroid_dx_um')}, {r(f'dy*{PY}','centroid_dy_um')},
 {r(f'sqrt(dx*{PX}*dx*{PX}+dy*{PY}*dy*{PY})','centroid_distance_um')} FROM geom""")


def image_value(ch: str, x: str = "x", y: str = "y", acq: str = "acquisition_id") -> str:
    return f"cast(({x}*131 + {y}*17 + ({acq}+1)*({ch}+1)*29) % 4096 AS double)"


_stats = ["mean_intensity", "median_intensity", "intensity_sd", "min_intensity", "p05_intensity",
          "p95_intensity", "max_intensity", "integrated_intensity"]
STAT_SQL = {"mean_intensity": "avg(v)", "median_intensity": "quantile_cont(v, 0.5)", "intensity_sd": "stddev_pop(v)",
       "min_intensity": "min(v)", "p05_intensity": "quantile_cont(v, 0.05)", "p95_intensity": "quantile_cont(v, 0.95)",
       "max_intensity": "max(v)", "integrated_intensity": "sum(v)"}
cte("region_pixels", f"""SELECT {PAIR}, 'a_roi' AS region, x, y FROM overlap o JOIN roi_pixels q
 ON q.acquisition_id = o.acquisition_id AND q.channel = o.channel_a AND q.object_id = o.object_a
 UNION ALL SELECT {PAIR}, 'b_roi', x, y FROM overlap o JOIN roi_pixels q
 ON q.acquisition_id = o.acquisition_id AND q.channel = o.channel_b AND q.object_id = o.object_b
 UNION ALL SELECT {PAIR}, 'intersection', x, y FROM shared""".replace(
    f"SELECT {PAIR}, '", "SELECT o.acquisition_id, channel_a, channel_b, object_a, object_b, '", 2))
cte("region_stats", f"""SELECT {PAIR}, region, signal, {', '.join(f'{f} AS {n}' for n, f in STAT_SQL.items())} FROM (
 SELECT {PAIR}, region, 'a' AS signal, {image_value('channel_a')} AS v FROM region_pixels
 UNION ALL SELECT {PAIR}, region, 'b', {image_value('channel_b')} FROM region_pixels) GROUP BY ALL""")
oracle("j8_region_intensity", f"SELECT {PAIR}, " + ", ".join(
    r(f"max(CASE WHEN region = '{g}' AND signal = '{s}' THEN {n} END)", f"{s}_signal_in_{g}_{n}")
    for g in ("a_roi", "b_roi", "intersection") for s in "ab" for n in _stats)
    + f" FROM region_stats GROUP BY {PAIR}")


def _rs(region, signal, stat):
    return f"max(CASE WHEN region = '{region}' AND signal = '{signal}' THEN {stat} END)"


oracle("j9_matched_intensity", f"""SELECT {PAIR},
 {r(_rs('a_roi','a','integrated_intensity'),'a_roi_integrated_intensity')},
 {r(_rs('b_roi','b','integrated_intensity'),'b_roi_integrated_intensity')},
 {r(_rs('a_roi','a','mean_intensity'),'a_roi_mean_intensity')}, {r(_rs('b_roi','b','mean_intensity'),'b_roi_mean_intensity')},
 any_value(a_area) AS a_roi_area_px, any_value(b_area) AS b_roi_area_px, any_value(shared_area) AS overlap_area_px,
 {r(_rs('intersection','a','integrated_intensity'),'a_overlap_integrated_intensity')},
 {r(_rs('intersection','b','integrated_intensity'),'b_overlap_integrated_intensity')},
 {r('any_value(a_percent_inside_b)','a_percent_inside_b')}, {r('any_value(b_percent_inside_a)','b_percent_inside_a')}
 FROM matches JOIN overlap USING ({PAIR}) JOIN region_stats USING ({PAIR}) GROUP BY {PAIR}""")
cte("union_px", f"SELECT {K}, count(DISTINCT x*100000+y) AS positive_area_px FROM roi_pixels GROUP BY ALL")
oracle("j10_union_area", f"""SELECT {K}, positive_area_px, {r('organoid_area_px','organoid_area_px')},
 {r('100.0*positive_area_px/nullif(organoid_area_px, 0)','positive_area_percent')}
 FROM union_px LEFT JOIN organoid_area_pos USING (acquisition_id)""")
cte("mask_pixels", """WITH g AS (SELECT acquisition_id, x, y, (x//8) + 3*(y//8) + acquisition_id AS b FROM
 (SELECT *, unnest(range(64)) AS x FROM (SELECT *, unnest(range(64)) AS y FROM (SELECT DISTINCT acquisition_id FROM objects))))
 SELECT acquisition_id, x, y, 'organoid' AS kind FROM g WHERE b % 5 <> 0
 UNION ALL SELECT acquisition_id, x, y, 'reference' FROM g WHERE b % 7 <> 0
 UNION ALL SELECT acquisition_id, x, y, 'cell' FROM g WHERE (x*y + acquisition_id) % 11 = 0""")
oracle("j11_outside_mask", f"""SELECT {K}, object_id, count(*) AS outside_px FROM roi_pixels q
 WHERE NOT EXISTS (SELECT 1 FROM mask_pixels m WHERE m.kind = 'organoid' AND m.acquisition_id = q.acquisition_id
 AND m.x = q.x AND m.y = q.y) GROUP BY ALL""")

# --- matching ----------------------------------------------------------------
oracle("k1_preferences", """SELECT run_id, object_a, object_b, score,
 row_number() OVER (PARTITION BY run_id, object_a ORDER BY score DESC, object_b) AS a_rank,
 row_number() OVER (PARTITION BY run_id, object_b ORDER BY score DESC, object_a) AS b_rank,
 count(*) OVER (PARTITION BY run_id, object_a) AS a_options,
 count(*) OVER (PARTITION BY run_id, object_b) AS b_options FROM dense_edges""")
oracle("k2_stable_matching", "SELECT g AS run_id, a AS object_a, b AS object_b, score FROM dmatched")
cte("prefs", f"""SELECT {PAIR}, row_number() OVER (PARTITION BY {KP}, object_a ORDER BY a_percent_inside_b DESC, object_b) AS a_rank,
 row_number() OVER (PARTITION BY {KP}, object_b ORDER BY a_percent_inside_b DESC, object_a) AS b_rank
 FROM overlap WHERE eligible""")
oracle("k3_match_table", f"""SELECT {PAIR}, shared_area, a_area, b_area, {r('a_percent_inside_b','a_percent_inside_b')},
 {r('b_percent_inside_a','b_percent_inside_a')}, eligible AS pass_threshold, a_rank, b_rank
 FROM matches JOIN overlap USING ({PAIR}) JOIN prefs USING ({PAIR})""")
oracle("k4_cell_ids", f"SELECT {PAIR}, cell_id FROM cells")
cte("matched_px", f"""SELECT c.cell_id, c.acquisition_id, c.channel_a, c.channel_b, 'a' AS side, q.object_id, q.x, q.y
 FROM cells c JOIN roi_pixels q ON q.acquisition_id = c.acquisition_id AND q.channel = c.channel_a AND q.object_id = c.object_a
 UNION ALL SELECT c.cell_id, c.acquisition_id, c.channel_a, c.channel_b, 'b', q.object_id, q.x, q.y
 FROM cells c JOIN roi_pixels q ON q.acquisition_id = c.acquisition_id AND q.channel = c.channel_b AND q.object_id = c.object_b""")
oracle("k5_matched_pixels", f"SELECT {KP}, side, cell_id, object_id, x, y FROM matched_px")
oracle("s8_nuclear_positive_pixels", "SELECT acquisition_id, channel_a AS channel, cell_id, object_id, x, y "
       "FROM matched_px WHERE side = 'a' AND channel_b = 0")
cte("side_n", f"""SELECT 'a' AS side, {KP}, count(*) AS total, count(e) AS overlapping, coalesce(sum(e), 0)::BIGINT AS eligible, count(m) AS matched
 FROM a_ids LEFT JOIN (SELECT {KP}, object_a, max(eligible::INT) AS e FROM overlap GROUP BY ALL) USING ({KP}, object_a)
 LEFT JOIN (SELECT {KP}, object_a, 1 AS m FROM matches) USING ({KP}, object_a) GROUP BY {KP}
 UNION ALL SELECT 'b', {KP}, count(*), count(e), coalesce(sum(e), 0)::BIGINT, count(m)
 FROM b_ids LEFT JOIN (SELECT {KP}, object_b, max(eligible::INT) AS e FROM overlap GROUP BY ALL) USING ({KP}, object_b)
 LEFT JOIN (SELECT {KP}, object_b, 1 AS m FROM matches) USING ({KP}, object_b) GROUP BY {KP}""")
oracle("k7_stage_counts", f"""SELECT {KP}, CASE WHEN side = 'a' THEN channel_a ELSE channel_b END AS marker, stage, count FROM (
 SELECT {KP}, side, 'All segmented objects' AS stage, total AS count FROM side_n
 UNION ALL SELECT {KP}, side, 'At least one overlapping partner', overlapping FROM side_n
 UNION ALL SELECT {KP}, side, 'Participating in eligible pair (A >= 25% inside B)', eligible FROM side_n
 UNION ALL SELECT {KP}, side, 'Final one-to-one matched objects', matched FROM side_n)""")
cte("run_n", f"""SELECT {KP}, max(total) FILTER (side='a') AS ta, max(matched) FILTER (side='a') AS m,
 max(eligible) FILTER (side='a') AS ea, max(total) FILTER (side='b') AS tb FROM side_n GROUP BY {KP}""")
cte("run_mm", f"""SELECT *, organoid_area_px*{PX}*{PY}/1e6 AS mm FROM run_n LEFT JOIN organoid_area USING (acquisition_id)""")
_rows = [
    ("'Total ' || channel_a || ' objects'", "ta", "objects"), ("'Matched ' || channel_a || ' objects'", "m", "objects"),
    ("'Proportion of ' || channel_a || ' objects matched'", "m/ta", "fraction"),
    ("'Total ' || channel_b || ' objects'", "tb", "objects"), ("'Matched ' || channel_b || ' objects'", "m", "objects"),
    ("'Proportion of ' || channel_b || ' objects matched'", "m/tb", "fraction"), ("'Matched CellIDs'", "m", "cells"),
    ("channel_a || ' objects below threshold'", "ta-ea", "objects"), ("'Organoid area'", "organoid_area_px", "pixels"),
    ("'Organoid area'", "mm", "mm^2"), ("channel_a || ' density'", "CASE WHEN mm>0 THEN ta/mm END", "objects/mm^2"),
    ("channel_b || ' density'", "CASE WHEN mm>0 THEN tb/mm END", "objects/mm^2"),
    ("'Matched ' || channel_a || ' density'", "CASE WHEN mm>0 THEN m/mm END", "objects/mm^2"),
    ("'Matched ' || channel_b || ' density'", "CASE WHEN mm>0 THEN m/mm END", "objects/mm^2")]
oracle("k6_run_summary", " UNION ALL ".join(
    f"SELECT {KP}, {m} AS metric, {r(v, 'value')}, '{u}' AS units FROM run_mm" for m, v, u in _rows))
