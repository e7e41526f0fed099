"""SQL for the group statistics."""

from __future__ import annotations

from roispark.catalog.oracles import cte, oracle, r
from roispark.functions import distributions as dist

cte("fields", """SELECT l_orderkey*10 + l_linenumber AS field_id, l_returnflag AS line, l_suppkey % 3 AS batch, l_linestatus AS enhancer,
 l_discount*1000 AS specificity_percent, l_extendedprice/1000 AS density FROM lineitem""")
cte("lng", """SELECT field_id, line, batch, enhancer, 'specificity_percent' AS metric, CASE WHEN field_id % 97 <> 0 THEN specificity_percent END AS value FROM fields
 UNION ALL SELECT field_id, line, batch, enhancer, 'density', CASE WHEN field_id % 97 <> 0 THEN density END FROM fields""")
cte("lngv", "SELECT * FROM lng WHERE value IS NOT NULL")
D = f"""count(*) AS n_total, count(value) AS n_valid, count(*) - count(value) AS n_missing, {r('avg(value)','mean')},
 {r('quantile_cont(value, 0.5)','median',9)}, {r('var_samp(value)','sample_variance')}, {r('stddev_samp(value)','sample_sd')},
 {r('stddev_samp(value)/sqrt(count(value))','sem')}, {r('100*stddev_samp(value)/nullif(abs(avg(value)), 0)','cv_percent')},
 {r('quantile_cont(value, 0.25)','q1',9)}, {r('quantile_cont(value, 0.75)','q3',9)},
 {r('quantile_cont(value, 0.75) - quantile_cont(value, 0.25)','iqr',9)}, {r('min(value)','min')}, {r('max(value)','max')},
 count(*) FILTER (value = 0) AS n_zero, count(*) FILTER (value = 100) AS n_100"""
oracle("t1_descriptives", f"SELECT metric, line, {D} FROM lng GROUP BY metric, line")
oracle("t2_grouping_sets", f"""SELECT metric, CASE WHEN gl = 1 AND gb = 1 AND ge = 1 THEN 'overall' ELSE
 array_to_string(list_filter([CASE WHEN gl = 0 THEN 'line' END, CASE WHEN gb = 0 THEN 'batch' END, CASE WHEN ge = 0 THEN 'enhancer' END],
 lambda v: v IS NOT NULL), ' x ') END AS grouping, coalesce(line, '') AS line, coalesce(batch::VARCHAR, '') AS batch, coalesce(enhancer, '') AS enhancer,
 * EXCLUDE (metric, line, batch, enhancer, gl, gb, ge) FROM (SELECT metric, line, batch, enhancer, grouping(line) AS gl, grouping(batch) AS gb,
 grouping(enhancer) AS ge, {D} FROM lng GROUP BY GROUPING SETS ((metric), (metric, line), (metric, batch), (metric, line, batch),
 (metric, enhancer), (metric, line, enhancer)))""")
oracle("t3_variance_matrix", f"""SELECT m.metric, l.line, b.batch, coalesce(n_total, 0) AS n_total, coalesce(n_valid, 0) AS n_valid,
 coalesce(n_missing, 0) AS n_missing, coalesce(n_zero, 0) AS n_zero, coalesce(n_100, 0) AS n_100,
 mean, median, sample_variance, sample_sd, sem, cv_percent, q1, q3, iqr, min, max
 FROM (SELECT DISTINCT metric FROM lng) m CROSS JOIN (VALUES ('A'), ('N'), ('R'), ('X')) l(line) CROSS JOIN (VALUES (0::BIGINT), (1), (2)) b(batch)
 LEFT JOIN (SELECT metric, line, batch, {D} FROM lng GROUP BY ALL) d ON d.metric = m.metric AND d.line = l.line AND d.batch = b.batch""")
cte("fields_bad", """SELECT field_id, specificity_percent + CASE WHEN field_id % 500 = 3 THEN 1000 ELSE 0 END AS sp,
 CASE WHEN field_id % 700 = 5 THEN -density WHEN field_id % 900 = 7 THEN 'inf'::DOUBLE ELSE density END AS de,
 CASE WHEN field_id % 800 = 9 THEN 'Z' ELSE line END AS line FROM fields""")
oracle("t4_metric_violations", """SELECT field_id::VARCHAR AS key, 'specificity_percent_outside_0_100' AS "check" FROM fields_bad WHERE sp < 0 OR sp > 100
 UNION ALL SELECT field_id::VARCHAR, 'density_negative' FROM fields_bad WHERE de < 0
 UNION ALL SELECT field_id::VARCHAR, 'density_infinite' FROM fields_bad WHERE abs(de) = 'inf'::DOUBLE
 UNION ALL SELECT field_id::VARCHAR, 'line_unknown' FROM fields_bad WHERE line = 'Z'
 UNION ALL SELECT field_id::VARCHAR, 'duplicate_key' FROM fields_bad GROUP BY field_id HAVING count(*) > 1""")
cte("lq", """SELECT metric, line, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3
 FROM lngv GROUP BY ALL""")
oracle("t5_tukey_box", f"""SELECT metric, line, {r('any_value(q1)','q1',9)}, {r('any_value(med)','median',9)}, {r('any_value(q3)','q3',9)},
 {r('least(min(value) FILTER (value >= q1 - 1.5*(q3-q1)), any_value(q1))','whisker_low',9)},
 {r('greatest(max(value) FILTER (value <= q3 + 1.5*(q3-q1)), any_value(q3))','whisker_high',9)},
 count(*) FILTER (value < q1 - 1.5*(q3-q1) OR value > q3 + 1.5*(q3-q1)) AS outliers FROM lngv JOIN lq USING (metric, line) GROUP BY metric, line""")


def kw(keys: str) -> str:
    return f"""SELECT {keys}, n, k - 1 AS df, (12.0/(n::DOUBLE*(n+1))*s - 3*(n+1.0)) / (1 - ties/(n::DOUBLE*n*n - n)) AS h FROM (
 SELECT {keys}, sum(c) AS n, count(*) AS k, sum(rs*rs/c) AS s FROM (SELECT {keys}, line, count(*) AS c, sum(mid) AS rs FROM (
 SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY value) + (count(*) OVER (PARTITION BY {keys}, value) - 1)/2.0 AS mid FROM lngv)
 GROUP BY ALL) GROUP BY {keys}) JOIN (SELECT {keys}, sum(t*t*t - t) AS ties FROM (SELECT {keys}, value, count(*)::DOUBLE AS t FROM lngv GROUP BY ALL)
 GROUP BY {keys}) USING ({keys})"""


cte("kw_all", kw("metric"))
# Three groups: two degrees of freedom, for which the chi-square tail is exp(-h/2).
oracle("t6_kruskal_wallis", f"SELECT metric, {r('h','h')}, df, n::BIGINT AS n_total, {r('exp(-h/2)','p')} FROM kw_all")
cte("mw_rows", """SELECT metric, g1 AS group1, g2 AS group2, line, value FROM lngv
 JOIN (VALUES ('A','N'), ('A','R'), ('N','R')) p(g1, g2) ON line IN (g1, g2)""")
# The error function as its power series (exact to about 1e-9 up to 4; the tail beyond is below 1e-7).
def two_sided(z: str) -> str:
    x = f"least(({z})/sqrt(2.0::DOUBLE), 4.0)"
    return (f"greatest(0, least(1, 1 - 2/sqrt(pi())*list_sum(list_transform(range(0, 90), "
            f"lambda k: (CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END)*pow({x}, 2*k+1)/(gamma(k+1)*(2*k+1))))))")


cte("mw_one", """SELECT metric, group1, group2, count(*) FILTER (line = group1) AS n1, count(*) FILTER (line = group2) AS n2,
 sum(mid) FILTER (line = group1) - count(*) FILTER (line = group1)*(count(*) FILTER (line = group1) + 1)/2.0 AS u, sum(same*same - 1)::DOUBLE AS ties
 FROM (SELECT *, rank() OVER (PARTITION BY metric, group1, group2 ORDER BY value)
 + (count(*) OVER (PARTITION BY metric, group1, group2, value) - 1)/2.0 AS mid,
 count(*) OVER (PARTITION BY metric, group1, group2, value) AS same FROM mw_rows) GROUP BY metric, group1, group2""")
cte("mw_p", f"""SELECT *, {two_sided('z')} AS p FROM (SELECT *, (greatest(u, n1*n2 - u) - n1*n2/2.0::DOUBLE - 0.5)
 / sqrt(n1*n2/12.0::DOUBLE*(n1 + n2 + 1 - ties/((n1 + n2)*(n1 + n2 - 1.0::DOUBLE)))) AS z FROM mw_one)""")
oracle("t7_mann_whitney", f"""SELECT metric, group1, group2, n1, n2, {r('u','u')}, {r('p','p_raw')},
 {r('least(1, max(step) OVER (PARTITION BY metric ORDER BY i))','p_holm')} FROM (
 SELECT *, (count(*) OVER (PARTITION BY metric) - i + 1)*p AS step FROM (SELECT *,
 row_number() OVER (PARTITION BY metric ORDER BY p, group1, group2) AS i FROM mw_p))""")
cte("kw_cells", kw("metric, batch, enhancer"))
oracle("t8_holm", f"""SELECT metric, batch, enhancer, {r('h','h')}, {r('p','p')},
 {r('least(1, max(step) OVER (PARTITION BY metric ORDER BY i))','p_holm')} FROM (
 SELECT *, (count(*) OVER (PARTITION BY metric) - i + 1)*p AS step FROM (SELECT *, exp(-h/2) AS p,
 row_number() OVER (PARTITION BY metric ORDER BY exp(-h/2), batch, enhancer) AS i FROM kw_cells))""")
cte("devs", "SELECT metric, line, batch, enhancer, field_id, value, med, abs(value - med) AS dev FROM lngv JOIN lq USING (metric, line)")


def anova(source: str, value: str) -> str:
    return f"""SELECT metric, (b/(k-1))/(w/(n-k)) AS f, k - 1 AS df_num, n - k AS df_den FROM (
 SELECT metric, count(*) AS k, sum(c) AS n, sum(c*v) AS w, sum(c*(m-g)*(m-g)) AS b FROM (
 SELECT metric, line, count({value}) AS c, avg({value}) AS m, var_pop({value}) AS v FROM {source} GROUP BY ALL)
 JOIN (SELECT metric, avg({value}) AS g FROM {source} GROUP BY 1) USING (metric) GROUP BY metric)"""


# With two numerator degrees of freedom the F tail is (1 + 2 f / d)^(-d/2).
for _name, _src, _val in (("t9_brown_forsythe", "devs", "dev"), ("t12_anova", "lngv", "value")):
    oracle(_name, f"""SELECT metric, {r('f','f')}, df_num, df_den::BIGINT AS df_den, {r('pow(1 + 2*f/df_den, -df_den/2.0)','p')} FROM ({anova(_src, _val)})""")


def _poly(coefficients, x):
    out = repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = f"({out}*{x} + {c!r})"
    return f"({out})"


def ppf(p: str) -> str:
    """The normal quantile as SQL (the same published coefficients)."""
    t = f"sqrt(-ln(CASE WHEN ({p}) < 0.5 THEN ({p}) ELSE 1 - ({p}) END))"
    centre = f"(0.180625 - (({p}) - 0.5)*(({p}) - 0.5))"
    middle, tail = f"({t} - 1.6)", f"({t} - 5.0)"
    return f"""CASE WHEN abs(({p}) - 0.5) <= 0.425 THEN (({p}) - 0.5)*{_poly(dist.PPND_CENTRE_NUM, centre)}/{_poly(dist.PPND_CENTRE_DEN, centre)}
 ELSE sign(({p}) - 0.5)*CASE WHEN {t} <= 5 THEN {_poly(dist.PPND_MIDDLE_NUM, middle)}/{_poly(dist.PPND_MIDDLE_DEN, middle)}
 ELSE {_poly(dist.PPND_TAIL_NUM, tail)}/{_poly(dist.PPND_TAIL_DEN, tail)} END END"""


cte("fl_rank", """SELECT *, 0.5::DOUBLE + (rank() OVER (PARTITION BY metric ORDER BY dev) + (count(*) OVER (PARTITION BY metric, dev) - 1)/2.0)
 /(2*(count(*) OVER (PARTITION BY metric) + 1)) AS pr FROM devs""")
cte("fl_score", f"SELECT metric, line, {ppf('pr')} AS a FROM fl_rank")
oracle("t10_fligner_killeen", f"""SELECT metric, {r('b/v','chi2')}, k - 1 AS df, {r('exp(-b/v/2)','p')} FROM (
 SELECT metric, count(*) AS k, sum(c*(m-g)*(m-g)) AS b, any_value(v) AS v FROM (SELECT metric, line, count(*) AS c, avg(a) AS m FROM fl_score GROUP BY ALL)
 JOIN (SELECT metric, avg(a) AS g, var_samp(a) AS v FROM fl_score GROUP BY 1) USING (metric) GROUP BY metric)""")
oracle("t11_variance_ratio", f"""SELECT metric, count(*) AS groups, min(n) AS smallest_n, {r('max(v)/min(v)','variance_ratio')},
 'Exploratory; small n limits power; neither test proves equality.' AS note FROM (SELECT metric, line, count(*) AS n, var_samp(value) AS v
 FROM lngv GROUP BY ALL) GROUP BY metric""")
cte("wg", "SELECT metric, line, count(*)::DOUBLE AS n, avg(value) AS m, count(*)/var_samp(value) AS w FROM lngv GROUP BY ALL")
cte("wt", """SELECT metric, count(*)::DOUBLE AS k, sum(w*(m-wm)*(m-wm)) AS num, sum((1-w/ws)*(1-w/ws)/(n-1)) AS base FROM wg
 JOIN (SELECT metric, sum(w) AS ws, sum(w*m)/sum(w) AS wm FROM wg GROUP BY 1) USING (metric) GROUP BY metric""")
oracle("t13_welch_anova", f"""SELECT metric, {r('f','f')}, (k-1)::BIGINT AS df_num, {r('d','df_den',4)}, 'Welch unequal-variance ANOVA' AS note,
 {r('pow(1 + 2*f/d, -d/2)','p')} FROM (SELECT metric, k, (num/(k-1))/(1 + 2*(k-2)/(k*k-1)*base) AS f, (k*k-1)/(3*base) AS d FROM wt)""")

# Normal equations of value ~ line + batch, eliminated step by step (no pivoting is
# needed for a positive definite matrix): columns 0-4 matrix, 5-9 inverse, 10 right side.
P = 5
X = ["1.0", "(line = 'N')::INT", "(line = 'R')::INT", "(batch = 1)::INT", "(batch = 2)::INT"]
_start = ", ".join([f"sum({X[i]}*{X[j]})::DOUBLE AS m{i}_{j}" for i in range(P) for j in range(P)]
                   + [f"{float(i == j)}::DOUBLE AS m{i}_{P + j}" for i in range(P) for j in range(P)]
                   + [f"sum({X[i]}*value)::DOUBLE AS m{i}_{2 * P}" for i in range(P)])
_sql = f"SELECT metric, count(*) AS n, {_start} FROM lngv GROUP BY metric"
for _k in range(P):
    _cells = []
    for _i in range(P):
        for _j in range(2 * P + 1):
            _cells.append(f"m{_k}_{_j}/m{_k}_{_k} AS m{_i}_{_j}" if _i == _k else
                          f"m{_i}_{_j} - m{_i}_{_k}*m{_k}_{_j}/m{_k}_{_k} AS m{_i}_{_j}")
    cte(f"elim{_k}", _sql)
    _sql = f"SELECT metric, n, {', '.join(_cells)} FROM elim{_k}"
cte("ols", _sql)
oracle("t15_additive_model", f"SELECT metric, n, n - {P} AS df, {', '.join(r(f'm{i}_{2 * P}', f'beta{i}') for i in range(P))} FROM ols")
_fit = " + ".join(f"{X[i]}*m{i}_{2 * P}" for i in range(P))
_lev = " + ".join(f"{X[i]}*{X[j]}*m{i}_{P + j}" for i in range(P) for j in range(P))
cte("ols_rows", f"""SELECT metric, field_id, line, batch, value, {_fit} AS fitted, value - ({_fit}) AS e, {_lev} AS lev, n - {P} AS df
 FROM lngv JOIN ols USING (metric)""")
oracle("t15_model_rows", f"""SELECT metric, field_id, line, batch, {r('value','value')}, {r('fitted','fitted')}, {r('e','residual')},
 {r('e/sqrt(sum(e*e) OVER (PARTITION BY metric)/df)','standardized_residual')}, {r('lev','leverage')} FROM ols_rows""")
oracle("t15_model_summary", f"""SELECT metric, count(*) AS n, any_value(df) AS residual_df, {r('sum(e*e)/any_value(df)','residual_variance')},
 {r('sqrt(sum(e*e)/any_value(df))','residual_sd')}, {r('max(lev)','max_leverage')} FROM ols_rows GROUP BY metric""")
_meat = ", ".join(f"sum({X[i]}*{X[j]}*(e/(1-lev))*(e/(1-lev))) AS q{i}_{j}" for i in range(P) for j in range(P))
cte("meat", f"SELECT metric, sum(e*e) AS rss, any_value(df) AS df, {_meat} FROM ols_rows GROUP BY metric")


def hc3(i: int, j: int) -> str:
    return "(" + " + ".join(f"m{i}_{P + a}*q{a}_{b}*m{b}_{P + j}" for a in range(P) for b in range(P)) + ")"


cte("hc", f"""SELECT metric, df, rss, m1_{2 * P} AS b1, m2_{2 * P} AS b2, {hc3(1, 1)} AS h11, {hc3(1, 2)} AS h12, {hc3(2, 2)} AS h22,
 m1_{P + 1}*rss/df AS o11, m1_{P + 2}*rss/df AS o12, m2_{P + 2}*rss/df AS o22 FROM ols JOIN meat USING (metric)""")


def wald(c: str) -> str:
    return f"((b1*b1*{c}22 - 2*b1*b2*{c}12 + b2*b2*{c}11)/({c}11*{c}22 - {c}12*{c}12)/2)"


oracle("t16_joint_test", " UNION ALL ".join(
    f"""SELECT metric, '{name}' AS covariance, {r(wald(c),'f')}, 2::BIGINT AS df_num, df AS df_den, {r(f'pow(1 + 2*{wald(c)}/df, -df/2.0)','p')} FROM hc"""
    for c, name in (("o", "ordinary covariance"), ("h", "HC3 robust covariance"))))
cte("contrast", " UNION ALL ".join(
    f"SELECT metric, '{name}' AS comparison, {diff} AS d, sqrt({var}) AS se, abs({diff})/sqrt({var}) AS t, sign({diff}) AS s, df FROM hc"
    for name, diff, var in (("N - A", "b1", "h11"), ("R - A", "b2", "h22"), ("N - R", "b1 - b2", "h11 + h22 - 2*h12"))))
# Student's t for many degrees of freedom, as the normal distribution and the first terms in 1/df.
cte("contrast_p", f"""SELECT *, least(1, {two_sided('t')} + (t*t*t + t)/(2.0*df)*exp(-t*t/2)/sqrt(2*pi())) AS p,
 z + (z*z*z + z)/(4.0*df) + (5*pow(z, 5) + 16*z*z*z + 3*z)/(96.0*df*df) AS q FROM (SELECT *, 1.959963984540054::DOUBLE AS z FROM contrast)""")
oracle("t16_contrasts", f"""SELECT metric, comparison, {r('d','difference')}, {r('se','hc3_se')}, {r('s*t','t')}, df, {r('p','raw_p')},
 {r('least(1, max(step) OVER (PARTITION BY metric ORDER BY i))','p_holm')}, {r('d - q*se','ci95_lower')}, {r('d + q*se','ci95_upper')}
 FROM (SELECT *, (4 - i)*p AS step FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY p, comparison) AS i FROM contrast_p))""")
cte("qq_pos", """SELECT *, CASE WHEN i = n THEN pow(0.5::DOUBLE, 1.0/n) WHEN i = 1 THEN 1 - pow(0.5::DOUBLE, 1.0/n) ELSE (i - 0.3175::DOUBLE)/(n + 0.365) END AS pr
 FROM (SELECT metric, line, field_id, value, row_number() OVER (PARTITION BY metric, line ORDER BY value, field_id) AS i,
 count(*) OVER (PARTITION BY metric, line) AS n FROM lngv)""")
cte("qq", f"SELECT metric, line, field_id, value, {ppf('pr')} AS theoretical FROM qq_pos")
oracle("t17_qq_points", f"SELECT metric, line, field_id, {r('value','value')}, {r('theoretical','theoretical')} FROM qq")
oracle("t17_qq_line", f"""SELECT metric, line, count(*) AS n, {r('regr_slope(value, theoretical)','slope')},
 {r('regr_intercept(value, theoretical)','intercept')} FROM qq GROUP BY metric, line""")
oracle("t18_median_deviation", f"SELECT metric, line, field_id, {r('value','value')}, {r('med','group_median',9)}, {r('dev','abs_deviation',9)} FROM devs")
cte("sw_rank", f"""SELECT *, {ppf('(i - 0.375::DOUBLE)/(n + 0.25)')} AS m FROM (SELECT metric, line, batch, enhancer, value,
 row_number() OVER g AS i, count(*) OVER (PARTITION BY metric, line, batch, enhancer) AS n FROM lng WHERE value IS NOT NULL
 WINDOW g AS (PARTITION BY metric, line, batch, enhancer ORDER BY value))""")
cte("sw_sum", """SELECT metric, line, batch, enhancer, n, sum(m*m) AS ssq, max(m) AS m1, max(m) FILTER (i = n-1) AS m2, sum(m*value) AS mx,
 max(value) - min(value) AS wide, max(value) FILTER (i = n-1) - max(value) FILTER (i = 2) AS inn, var_pop(value)*n AS dev, 1/sqrt(n) AS u
 FROM sw_rank GROUP BY metric, line, batch, enhancer, n""")
cte("sw_top", """SELECT *, ((((-2.706056::DOUBLE*u + 4.434685)*u - 2.071190)*u - 0.147981)*u + 0.221157)*u + m1/sqrt(ssq) AS a1,
 ((((-3.582633::DOUBLE*u + 5.682633)*u - 1.752461)*u - 0.293762)*u + 0.042981)*u + m2/sqrt(ssq) AS a2 FROM sw_sum""")
cte("sw_lin", """SELECT *, CASE WHEN n = 3 THEN sqrt(0.5::DOUBLE)*wide WHEN n > 5 THEN
 (mx - m1*wide - m2*inn)/sqrt((ssq - 2*m1*m1 - 2*m2*m2)/(1 - 2*a1*a1 - 2*a2*a2)) + a1*wide + a2*inn
 ELSE (mx - m1*wide)/sqrt((ssq - 2*m1*m1)/(1 - 2*a1*a1)) + a1*wide END AS lin FROM sw_top""")
oracle("t14_shapiro_wilk", f"""SELECT metric, line, batch, enhancer, n, {r('CASE WHEN n >= 3 AND wide > 0 THEN least(1.0, lin*lin/dev) END', 'w')},
 CASE WHEN n < 3 THEN 'not tested (n<3)' WHEN wide = 0 THEN 'not tested (all values identical)' WHEN n < 8 THEN 'very low power (n<8)'
 WHEN n > 5000 THEN 'p extrapolated (n>5000)' ELSE 'visual checks also needed' END AS note FROM sw_lin""")
