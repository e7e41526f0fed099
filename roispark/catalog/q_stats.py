"""Registered queries T1-T18."""

from __future__ import annotations

from pyspark.sql import functions as F

from roispark.catalog import base
from roispark.catalog.base import query
from roispark.operators import stats
from roispark.sources import fixtures

LINES, BATCHES, ENHANCERS = ["A", "N", "R"], [0, 1, 2], ["F", "O"]
METRICS = ["specificity_percent", "density"]
FACTORS = [("line", LINES), ("batch", BATCHES)]
# Interpolated quartiles have up to seven decimals, so they are compared with nine.
QUARTILES = {"q1": 9, "median": 9, "q3": 9, "iqr": 9}
LINE_PAIRS = [("A", "N"), ("A", "R"), ("N", "R")]


@base.shared_table("long")
def long(spark, d):
    """Both metrics in long form; every 97th field has no value."""
    f = fixtures.field_metrics(spark, d)
    f = f.select("field_id", "line", "batch", "enhancer", *[
        F.when(F.col("field_id") % 97 != 0, F.col(m)).alias(m) for m in METRICS])
    return stats.long_metrics(f, METRICS, ["field_id", "line", "batch", "enhancer"])


@query("t1_descriptives", **QUARTILES)
def _(spark, d):
    return stats.descriptives(long(spark, d), ["metric", "line"])


@query("t2_grouping_sets", **QUARTILES)
def _(spark, d):
    sets = [(), ("line",), ("batch",), ("line", "batch"), ("enhancer",), ("line", "enhancer")]
    return stats.grouped_descriptives(long(spark, d), sets, ["line", "batch", "enhancer"])


@query("t3_variance_matrix", **QUARTILES)
def _(spark, d):
    return stats.variance_matrix(long(spark, d), ("line", [*LINES, "X"]), ("batch", BATCHES))


@query("t4_metric_violations")
def _(spark, d):
    f = fixtures.field_metrics(spark, d).selectExpr(
        "field_id", "specificity_percent + CASE WHEN field_id % 500 = 3 THEN 1000D ELSE 0D END AS specificity_percent",
        "CASE WHEN field_id % 700 = 5 THEN -density WHEN field_id % 900 = 7 THEN double('Infinity') ELSE density END AS density",
        "CASE WHEN field_id % 800 = 9 THEN 'Z' ELSE line END AS line")
    return stats.metric_violations(f, "field_id", ["specificity_percent"], ["density"], {"line": LINES})


@query("t5_tukey_box", **QUARTILES, whisker_low=9, whisker_high=9)
def _(spark, d):
    return stats.tukey_box(long(spark, d), ["metric", "line"])


@query("t6_kruskal_wallis")
def _(spark, d):
    return stats.kruskal_wallis(long(spark, d), "line")


@query("t7_mann_whitney")
def _(spark, d):
    return stats.mann_whitney(long(spark, d), "line", LINE_PAIRS)


@query("t8_holm")
def _(spark, d):
    # Kruskal-Wallis of every batch x enhancer cell (3 groups, closed-form p), one family per metric.
    kw = stats.kruskal_wallis(long(spark, d), "line", ["metric", "batch", "enhancer"])
    return stats.holm(kw, "p", ["metric"], ["batch", "enhancer"]).select(
        "metric", "batch", "enhancer", "h", "p", "p_holm")


@query("t9_brown_forsythe")
def _(spark, d):
    return stats.brown_forsythe(long(spark, d), "line")


@query("t10_fligner_killeen")
def _(spark, d):
    return stats.fligner_killeen(long(spark, d), "line")


@query("t11_variance_ratio")
def _(spark, d):
    return stats.variance_ratio(long(spark, d), "line")


@query("t12_anova")
def _(spark, d):
    return stats.anova_table(long(spark, d), "value", "line")


@query("t13_welch_anova", df_den=4)
def _(spark, d):
    return stats.welch_anova(long(spark, d), "line")


@query("t14_shapiro_wilk")
def _(spark, d):
    return stats.shapiro_wilk(long(spark, d), ["metric", "line", "batch", "enhancer"]).drop("p")


@query("t15_additive_model")
def _(spark, d):
    m = stats.fit_additive(long(spark, d), FACTORS)
    return m.select("metric", "n", "df", *[F.col("beta")[i].alias(f"beta{i}") for i in range(5)])


@query("t15_model_rows")
def _(spark, d):
    data = long(spark, d)
    rows = stats.model_rows(data, stats.fit_additive(data, FACTORS), FACTORS)
    return rows.select("metric", "field_id", "line", "batch", "value", "fitted", "residual",
                       "standardized_residual", "leverage")


@query("t15_model_summary")
def _(spark, d):
    data = long(spark, d)
    return stats.model_summary(stats.model_rows(data, stats.fit_additive(data, FACTORS), FACTORS))


@query("t16_joint_test")
def _(spark, d):
    return stats.robust_inference(long(spark, d), FACTORS)[0]


@query("t16_contrasts")
def _(spark, d):
    return stats.robust_inference(long(spark, d), FACTORS)[1].select(
        "metric", "comparison", "difference", "hc3_se", "t", "df", "raw_p", "p_holm", "ci95_lower", "ci95_upper")


@query("t17_qq_points")
def _(spark, d):
    return stats.qq_points(long(spark, d), ["metric", "line"], ["field_id"])


@query("t17_qq_line")
def _(spark, d):
    return stats.qq_line(stats.qq_points(long(spark, d), ["metric", "line"], ["field_id"]), ["metric", "line"])


@query("t18_median_deviation", group_median=9, abs_deviation=9)
def _(spark, d):
    dev = stats.median_deviations(long(spark, d), ["metric", "line"])
    return dev.select("metric", "line", "field_id", "value", "group_median", "abs_deviation")
