"""Group statistics over long metric tables.

Input rows are ``(metric, value, <grouping columns>)``.  Sufficient statistics are
plain aggregates; ranks and quantiles come from positional passes over distinct
values; only one-row-per-test results meet a distribution function.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roispark.functions.distributions import (chi2_sf, f_sf, f_tail, mann_whitney_p, norm_ppf, norm_tail,
                                              t_quantile, t_two_sided)
from roispark.functions.ranking import (group_quantiles, quantile_columns, ranked, running_totals,
                                         value_positions)
from roispark.session import materialize
from roispark.sources.io import finite


def long_metrics(fields: DataFrame, metrics: list[str], keep: list[str]) -> DataFrame:
    """Wide field rows to ``(keep, metric, value)``; missing stays as null rows."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), finite(m).alias("value")) for m in metrics])
    return fields.select(*keep, F.explode(cells).alias("_c")).select(*keep, "_c.*")


# Quartile columns of every table of descriptives.
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def descriptives(long: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, moments (ddof 1, null below two values), quartiles, extremes."""
    v = F.col("value")
    base = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_total"), F.count(v).alias("n_valid"), F.avg(v).alias("mean"),
        F.var_samp(v).alias("_var"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.count_if(v == 0).alias("n_zero"), F.count_if(v == 100).alias("n_100"))
    q = group_quantiles(long.where(v.isNotNull()), keys, "value", QUARTILES)
    return _described(base.join(q, keys, "left"), keys)


def _described(found: DataFrame, keys: list[str]) -> DataFrame:
    n = F.col("n_valid")
    var = F.when(n >= 2, F.col("_var"))
    return found.select(
        *keys, "n_total", "n_valid", (F.col("n_total") - n).alias("n_missing"), "mean", "median",
        var.alias("sample_variance"), F.sqrt(var).alias("sample_sd"), (F.sqrt(var) / F.sqrt(n)).alias("sem"),
        F.when(F.col("mean") != 0, 100 * F.sqrt(var) / F.abs("mean")).alias("cv_percent"),
        "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"), "min", "max", "n_zero", "n_100")


def value_lattice(long: DataFrame, groupings: list[tuple[str, ...]], dims: list[str],
                  fill: str = "") -> DataFrame:
    """Value counts of several grouping sets: ``(metric, grouping, dims, value, times)``.

    The rows are counted once, by value in the finest cell; every grouping is rolled up from those counts, so
    what is copied per grouping is distinct values.  Absent and null dimensions are ``fill``; a missing value is a row.
    """
    used = [d for d in dims if any(d in g for g in groupings)]
    finest = long.groupBy("metric", *used, "value").agg(F.count(F.lit(1)).alias("times"))
    sets = [F.struct(F.lit(" x ".join(g) if g else "overall").alias("grouping"),
                     *[(F.coalesce(F.col(d).cast("string"), F.lit(fill)) if d in g else F.lit(fill)).alias(d) for d in dims])
            for g in groupings]
    # The finest counts are read once by all groupings.
    spread = materialize(finest).select("metric", "value", "times", F.explode(F.array(*sets)).alias("_g"))
    return spread.select("metric", "_g.*", "value", "times").groupBy(
        "metric", "grouping", *dims, "value").agg(F.sum("times").alias("times"))


def grouped_descriptives(long: DataFrame, groupings: list[tuple[str, ...]], dims: list[str]) -> DataFrame:
    """Descriptives of several grouping sets, keyed by a label, from one lattice of value counts."""
    keys = ["metric", "grouping", *dims]
    return count_descriptives(materialize(value_lattice(long, groupings, dims)), keys)


def count_descriptives(counts: DataFrame, keys: list[str]) -> DataFrame:
    """T1 from written value counts ``(keys, value, times)``, one row per key and value, keys not null.

    Squares are summed around each group's mean, which keeps their digits.
    """
    v, t = F.col("value"), F.col("times")
    known = v.isNotNull() & ~F.isnan(v)
    middle = materialize(counts.where(known).groupBy(*keys).agg(
        (F.sum(v * t) / F.sum(t)).alias("_c"), F.sum(t).alias("n")))
    d = v - F.col("_c")
    base = counts.join(middle, keys, "left").groupBy(*keys).agg(
        F.sum(t).alias("n_total"), F.coalesce(F.sum(F.when(v.isNotNull(), t)), F.lit(0)).alias("n_valid"),
        F.sum(d * t).alias("_s"), F.sum(d * d * t).alias("_q"), F.max("_c").alias("_c"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.coalesce(F.sum(F.when(v == 0, t)), F.lit(0)).alias("n_zero"),
        F.coalesce(F.sum(F.when(v == 100, t)), F.lit(0)).alias("n_100"))
    placed = running_totals(counts.where(known), keys, "value", ["times"]).withColumnRenamed("times_below", "below")
    q = placed.join(middle.select(*keys, "n"), keys).groupBy(*keys).agg(*quantile_columns("value", QUARTILES))
    shift = F.try_divide("_s", "n_valid")
    spread = F.greatest(F.col("_q") - F.col("_s") * shift, F.lit(0.0))
    out = base.join(q, keys, "left").withColumn("mean", F.col("_c") + shift).withColumn(
        "_var", F.try_divide(spread, F.col("n_valid") - 1))
    return _described(out, keys)


def variance_matrix(long: DataFrame, rows: tuple[str, list], columns: tuple[str, list]) -> DataFrame:
    """Descriptives of every row x column cell, empty cells with n = 0 and null variance."""
    (rname, rvals), (cname, cvals) = rows, columns
    grid = long.select("metric").distinct().select(
        "metric", F.explode(F.array(*[F.lit(v) for v in rvals])).alias(rname)).select(
        "*", F.explode(F.array(*[F.lit(v) for v in cvals])).alias(cname))
    found = descriptives(long, ["metric", rname, cname])
    counts = ("n_total", "n_valid", "n_missing", "n_zero", "n_100")
    return grid.join(found, ["metric", rname, cname], "left").select(*[
        F.coalesce(c, F.lit(0).cast("long")).alias(c) if c in counts else F.col(c) for c in found.columns])


def metric_violations(fields: DataFrame, key: str, percents: list[str], non_negative: list[str],
                      vocabulary: dict[str, list]) -> DataFrame:
    """T4: ``(key, check)`` rows: ranges, infinities, vocabulary, duplicate keys."""
    rules = []
    for m in percents:
        rules.append((f"{m}_outside_0_100", ~F.coalesce(F.col(m).between(0, 100), F.lit(True))))
    for m in non_negative:
        rules.append((f"{m}_negative", F.coalesce(F.col(m) < 0, F.lit(False))))
    for m in [*percents, *non_negative]:
        rules.append((f"{m}_infinite", F.coalesce(F.abs(m) == float("inf"), F.lit(False))))
    for c, allowed in vocabulary.items():
        rules.append((f"{c}_unknown", ~F.coalesce(F.col(c).isin(allowed), F.lit(False))))
    found = F.filter(F.array(*[F.when(bad, F.lit(n)) for n, bad in rules]), lambda v: v.isNotNull())
    rows = fields.select(F.col(key).cast("string").alias("key"), F.explode(found).alias("check"))
    doubled = fields.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return rows.unionByName(doubled.select(F.col(key).cast("string").alias("key"), F.lit("duplicate_key").alias("check")))


def tukey_box(long: DataFrame, keys: list[str]) -> DataFrame:
    """T5: quartiles and whiskers at the most extreme data within 1.5 IQR."""
    use = long.where("value IS NOT NULL")
    q = group_quantiles(use, keys, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col("value")
    ends = use.join(q, keys).groupBy(*keys).agg(
        F.min(F.when(v >= F.col("q1") - reach, v)).alias("low"),
        F.max(F.when(v <= F.col("q3") + reach, v)).alias("high"),
        F.count_if((v < F.col("q1") - reach) | (v > F.col("q3") + reach)).alias("outliers"))
    # A whisker never ends inside the box.
    return q.join(ends, keys).select(
        *keys, "q1", "median", "q3", F.least("low", "q1").alias("whisker_low"),
        F.greatest("high", "q3").alias("whisker_high"), "outliers")


def rank_sums(long: DataFrame, keys: list[str], group: str) -> tuple[DataFrame, DataFrame]:
    """Mid-rank sums per group and per key the total and tie term ``sum(t^3 - t)``.

    Everything works on distinct values with counts: equal values never travel alone.
    """
    use = long.where("value IS NOT NULL")
    positions = value_positions(use, keys, "value")
    times = F.col("times").cast("double")
    totals = positions.groupBy(*keys).agg(
        F.max("n").alias("n"), F.sum(times * times * times - times).alias("ties"))
    counts = use.groupBy(*keys, group, "value").agg(F.count(F.lit(1)).alias("_k"))
    mid = F.col("below") + (F.col("times") + 1) / 2
    sums = counts.join(positions.select(*keys, "value", mid.alias("_mid")), [*keys, "value"]).groupBy(
        *keys, group).agg(F.sum("_k").alias("n_group"), F.sum(F.col("_k") * F.col("_mid")).alias("rank_sum"))
    return sums, totals


def kruskal_wallis(long: DataFrame, group: str, keys: list[str] = ["metric"]) -> DataFrame:
    """H with mid-ranks and tie correction; null when a group has fewer than two values."""
    sums, totals = rank_sums(long, keys, group)
    n = F.col("n").cast("double")
    one = sums.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("groups"), F.min("n_group").alias("_least"),
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n_group")).alias("_s")).join(totals, keys)
    raw = 12 / (n * (n + 1)) * F.col("_s") - 3 * (n + 1)
    h = raw / (1 - F.col("ties") / (n * n * n - n))
    return one.select(*keys, F.when((F.col("_least") >= 2) & (F.col("groups") >= 2), h).alias("h"),
                      (F.col("groups") - 1).alias("df"), F.col("n").alias("n_total")).withColumn(
        "p", chi2_sf(F.col("h"), F.col("df")))


def mann_whitney(long: DataFrame, group: str, pairs: list[tuple], keys: list[str] = ["metric"]) -> DataFrame:
    """U of the first group, two-sided p and Holm adjustment, for every listed pair.

    One table of counts per distinct value serves all pairs: U adds up, over the values of the first group, how many
    of the second are smaller and half of those that are equal.  Rows are never copied per pair.
    """
    column = {g: f"_c{i}" for i, g in enumerate(dict.fromkeys(g for p in pairs for g in p))}
    counts = long.where(F.col("value").isNotNull() & F.col(group).isin(list(column))).groupBy(*keys, "value").agg(
        *[F.count_if(F.col(group) == g).alias(c) for g, c in column.items()])
    table = running_totals(counts, keys, "value", list(column.values()))
    tests = []
    for g1, g2 in pairs:
        c1, c2, below = F.col(column[g1]), F.col(column[g2]), F.col(f"{column[g2]}_below")
        same = (c1 + c2).cast("double")
        tests.append(F.struct(
            F.lit(g1).alias("group1"), F.lit(g2).alias("group2"), F.sum(c1).alias("n1"), F.sum(c2).alias("n2"),
            F.sum(c1 * (below + c2 / 2)).alias("u"), F.sum(same * same * same - same).alias("ties")))
    one = table.groupBy(*keys).agg(F.array(*tests).alias("_t")).select(*keys, F.explode("_t").alias("_t")).select(*keys, "_t.*")
    one = one.where("n1 > 0 AND n2 > 0")
    return holm(one.withColumn("p_raw", mann_whitney_p(F.col("u"), F.col("n1"), F.col("n2"), F.col("ties"))),
                "p_raw", keys, ["group1", "group2"]).select(*keys, "group1", "group2", "n1", "n2", "u", "p_raw", "p_holm")


def holm(tests: DataFrame, p: str, keys: list[str], tie_break: list[str]) -> DataFrame:
    """Holm step-down within each family; a missing p counts as 1.

    A family is the list of tests of one metric, a handful of rows.
    """
    family = Window.partitionBy(*keys)
    order = family.orderBy(F.col("_p"), *tie_break)
    steps = tests.withColumn("_p", F.coalesce(F.col(p), F.lit(1.0))).withColumn(
        "_step", (F.count(F.lit(1)).over(family) - F.row_number().over(order) + 1) * F.col("_p"))
    running = F.max("_step").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return steps.withColumn("p_holm", F.least(running, F.lit(1.0))).drop("_p", "_step")


def median_deviations(long: DataFrame, keys: list[str]) -> DataFrame:
    """Absolute deviation of every row from the median of its group."""
    use = long.where("value IS NOT NULL")
    med = group_quantiles(use, keys, "value", {"group_median": 0.5})
    return use.join(med, keys).withColumn("abs_deviation", F.abs(F.col("value") - F.col("group_median")))


def anova_table(rows: DataFrame, value: str, group: str, keys: list[str] = ["metric"]) -> DataFrame:
    """One-way F from group counts, means and variances."""
    g = rows.groupBy(*keys, group).agg(F.count(value).alias("n"), F.avg(value).alias("m"),
                                       F.var_pop(value).alias("v"))
    tot = g.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_total"), F.min("n").alias("least"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"), F.sum(F.col("n") * F.col("v")).alias("within"))
    between = g.join(tot, keys).groupBy(*keys).agg(F.sum(
        F.col("n") * (F.col("m") - F.col("grand")) * (F.col("m") - F.col("grand"))).alias("between"))
    out = tot.join(between, keys).withColumn("df_num", F.col("k") - 1).withColumn(
        "df_den", F.col("n_total") - F.col("k"))
    ratio = (F.col("between") / F.col("df_num")) / (F.col("within") / F.col("df_den"))
    good = (F.col("k") >= 2) & (F.col("least") >= 2) & (F.col("within") > 0)
    return out.select(*keys, F.when(good, ratio).alias("f"), "df_num", "df_den").withColumn(
        "p", f_sf(F.col("f"), F.col("df_num"), F.col("df_den")))


def brown_forsythe(long: DataFrame, group: str, keys: list[str] = ["metric"]) -> DataFrame:
    """One-way ANOVA of the absolute deviations from the group medians."""
    return anova_table(median_deviations(long, [*keys, group]), "abs_deviation", group, keys)


def fligner_killeen(long: DataFrame, group: str, keys: list[str] = ["metric"]) -> DataFrame:
    """Normal scores of the pooled ranks of the absolute deviations."""
    dev = median_deviations(long, [*keys, group]).select(*keys, group, F.col("abs_deviation").alias("value"))
    positions = value_positions(dev, keys, "value")
    mid = F.col("below") + (F.col("times") + 1) / 2
    scores = positions.select(*keys, "value", norm_ppf(0.5 + mid / (2 * (F.col("n") + 1))).alias("_a"))
    counts = dev.groupBy(*keys, group, "value").agg(F.count(F.lit(1)).alias("_k"))
    g = counts.join(scores, [*keys, "value"]).groupBy(*keys, group).agg(
        F.sum("_k").cast("double").alias("n"), F.sum(F.col("_k") * F.col("_a")).alias("s"),
        F.sum(F.col("_k") * F.col("_a") * F.col("_a")).alias("ss"))
    tot = g.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("all_n"),
                               F.sum("s").alias("all_s"), F.sum("ss").alias("all_ss"))
    mean = F.col("all_s") / F.col("all_n")
    spread = (F.col("all_ss") - F.col("all_n") * mean * mean) / (F.col("all_n") - 1)
    stat = g.join(tot, keys).groupBy(*keys, "k").agg(
        F.sum(F.col("n") * (F.col("s") / F.col("n") - mean) * (F.col("s") / F.col("n") - mean)).alias("_b"),
        F.max(spread).alias("_v"))
    return stat.select(*keys, F.when(F.col("_v") > 0, F.col("_b") / F.col("_v")).alias("chi2"),
                       (F.col("k") - 1).alias("df")).withColumn("p", chi2_sf(F.col("chi2"), F.col("df")))


def variance_ratio(long: DataFrame, group: str, keys: list[str] = ["metric"]) -> DataFrame:
    """Largest over smallest sample variance (infinite when only the smallest is 0)."""
    g = long.where("value IS NOT NULL").groupBy(*keys, group).agg(
        F.count(F.lit(1)).alias("n"), F.var_samp("value").alias("v"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    one = g.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("groups"), F.min("n").alias("smallest_n"), F.max("v").alias("_max"),
        F.min("v").alias("_min"), F.bool_and(F.col("lo") == F.col("hi")).alias("_flat"))
    tested = (F.col("groups") >= 2) & (F.col("smallest_n") >= 2) & ~F.col("_flat")
    ratio = F.when(F.col("_min") > 0, F.col("_max") / F.col("_min")).when(
        F.col("_max") > 0, F.lit(float("inf")))
    # Notes.
    return one.select(*keys, "groups", "smallest_n", F.when(tested, ratio).alias("variance_ratio"), F.when(
        tested, F.lit("Exploratory; small n limits power; neither test proves equality."))
        .otherwise(F.lit("Insufficient n or all groups constant.")).alias("note"))


def welch_anova(long: DataFrame, group: str, keys: list[str] = ["metric"]) -> DataFrame:
    """Welch's F and denominator df; refuses small or constant groups."""
    g = long.where("value IS NOT NULL").groupBy(*keys, group).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("value").alias("m"), F.var_samp("value").alias("v"))
    g = g.withColumn("w", F.when(F.col("v") > 0, F.col("n") / F.col("v")))
    tot = g.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("k"), F.min("n").alias("least"), F.sum("w").alias("ws"),
        (F.sum(F.col("w") * F.col("m")) / F.sum("w")).alias("wm"),
        F.bool_and(F.coalesce(F.col("v") > 0, F.lit(False))).alias("varied"))
    s = g.join(tot, keys).groupBy(*keys, "k", "least", "varied").agg(
        F.sum(F.col("w") * (F.col("m") - F.col("wm")) * (F.col("m") - F.col("wm"))).alias("_num"),
        F.sum((1 - F.col("w") / F.col("ws")) * (1 - F.col("w") / F.col("ws"))
              / F.when(F.col("n") > 1, F.col("n") - 1)).alias("_base"))
    k = F.col("k")
    good = (k >= 2) & (F.col("least") >= 2) & F.col("varied")
    f = (F.col("_num") / F.when(k > 1, k - 1)) / (1 + 2 * (k - 2) / F.when(k > 1, k * k - 1) * F.col("_base"))
    # Notes.
    note = F.when((k < 2) | (F.col("least") < 2), F.lit("insufficient group sizes")).when(
        ~F.col("varied"), F.lit("zero within-group variance; Welch not defined")).otherwise(
        F.lit("Welch unequal-variance ANOVA"))
    return s.select(*keys, F.when(good, f).alias("f"), (k - 1).cast("long").alias("df_num"),
                    F.when(good, (k * k - 1) / (3 * F.col("_base"))).alias("df_den"), note.alias("note")).withColumn(
        "p", f_sf(F.col("f"), F.col("df_num"), F.col("df_den")))


def _shapiro_p(w: float, n: int) -> float:
    """Royston's (1995) p of W: exact for three values, else by a normal transform of log(1 - W)."""
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    y = math.log(max(1 - w, 1e-300))
    if n <= 11:
        g = -2.273 + 0.459 * n
        if y >= g:
            return 1e-99
        y = -math.log(g - y)
        mu = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)
        sd = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        ln = math.log(n)
        mu = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], ln)
        sd = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], ln))
    return norm_tail((y - mu) / sd)


def shapiro_p(w: Column, n: Column) -> Column:
    @F.pandas_udf("double")
    def tail(ws: pd.Series, ns: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) else _shapiro_p(float(x), int(k)) for x, k in zip(ws, ns)], dtype="float64")
    return tail(w, n)


# Ranks of one value that are scored in one row.
RANK_CHUNK = 4096


def shapiro_wilk(long: DataFrame, keys: list[str]) -> DataFrame:
    """Normality per group of any size: n, W, p and a note.

    W is a linear statistic of the order scores: every distinct value gets its positions, the normal scores of its
    positions are summed, and W follows from these sums, the moments and the two values at either end.  A value that
    repeats very often is scored in chunks of positions; no group is gathered anywhere.  The normal transform for p was
    fitted up to 5000 values; beyond, the note says so.
    """
    use = long.where("value IS NOT NULL").select(*keys, "value")
    moments = use.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.var_pop("value").alias("_var"), (F.min("value") == F.max("value")).alias("_flat"))
    placed = value_positions(use, keys, "value")
    first = F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / RANK_CHUNK))
    chunks = placed.select(*keys, "value", "times", "below", "n", F.explode(first).alias("_c")).select(
        *keys, "value", "n", F.explode(F.sequence(
            F.col("below") + F.col("_c") * RANK_CHUNK + 1,
            F.col("below") + F.least(F.col("times"), (F.col("_c") + 1) * RANK_CHUNK))).alias("rank"))
    score = norm_ppf((F.col("rank") - 0.375) / (F.col("n") + 0.25))
    at = chunks.withColumn("m", score)
    n = F.col("n")

    def end(rank):
        return F.max(F.when(F.col("rank") == rank, F.col("value")))

    sums = at.groupBy(*keys).agg(
        F.sum(F.col("m") * F.col("m")).alias("ssq"), F.sum(F.col("m") * F.col("value")).alias("mx"),
        F.max("m").alias("m1"), F.max(F.when(F.col("rank") == n - 1, F.col("m"))).alias("m2"),
        (end(n) - end(F.lit(1))).alias("wide"), (end(n - 1) - end(F.lit(2))).alias("inner"))
    u = 1 / F.sqrt(n)

    def weight(coefficients, m):
        out = F.lit(coefficients[0])
        for c in coefficients[1:]:
            out = out * u + F.lit(c)
        return out * u + m / F.sqrt("ssq")

    # Polynomials of algorithm AS R94 (Royston 1995) for the weights of the two largest values.
    top = weight([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157], F.col("m1"))
    second = weight([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981], F.col("m2"))
    m1, m2, ssq = F.col("m1"), F.col("m2"), F.col("ssq")
    large = n > 5
    phi = F.when(large, (ssq - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * top * top - 2 * second * second)).otherwise(
        (ssq - 2 * m1 * m1) / (1 - 2 * top * top))
    rest = F.col("mx") - m1 * F.col("wide") - F.when(large, m2 * F.col("inner")).otherwise(F.lit(0.0))
    linear = F.when(n == 3, F.lit(math.sqrt(0.5)) * F.col("wide")).otherwise(
        rest / F.sqrt(phi) + top * F.col("wide") + F.when(large, second * F.col("inner")).otherwise(F.lit(0.0)))
    tested = (n >= 3) & ~F.col("_flat")
    w = F.when(tested, F.least(F.lit(1.0), linear * linear / (n * F.col("_var"))))
    # Notes.
    note = (F.when(n < 3, F.lit("not tested (n<3)")).when(F.col("_flat"), F.lit("not tested (all values identical)"))
            .when(n < 8, F.lit("very low power (n<8)")).when(n > 5000, F.lit("p extrapolated (n>5000)"))
            .otherwise(F.lit("visual checks also needed")))
    out = moments.join(sums, keys, "left").select(*keys, "n", w.alias("w"), note.alias("note"))
    return out.select(*keys, "n", "w", shapiro_p(F.col("w"), n).alias("p"), "note")


# --- additive linear model -----------------------------------------------------
def design(factors: list[tuple[str, list]]) -> list[tuple[str, Column]]:
    """Treatment coding: an intercept and one indicator per non-reference level."""
    out = [("Intercept", F.lit(1.0))]
    for column, levels in factors:
        for level in levels[1:]:
            out.append((f"{column}[{level}]", F.when(F.col(column) == F.lit(level), 1.0).otherwise(0.0)))
    return out


def _solve_models(labels: list[str], keys: list[str]):
    p = len(labels)
    upper = [(i, j) for i in range(p) for j in range(i, p)]

    def solve(batches):
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                xtx = np.zeros((p, p))
                for (i, j), v in zip(upper, r["_xx"]):
                    xtx[i, j] = xtx[j, i] = v
                ok = r["n"] >= 8 and r["n"] - p >= 3 and np.linalg.matrix_rank(xtx) == p
                inv = np.linalg.inv(xtx) if ok else None
                rows.append({**{k: r[k] for k in keys}, "n": r["n"], "df": r["n"] - p,
                             "beta": (inv @ np.array(r["_xy"])).tolist() if ok else None,
                             "inverse": inv.ravel().tolist() if ok else None})
            yield pd.DataFrame(rows, columns=[*keys, "n", "df", "beta", "inverse"])

    return solve


def _weighted_products(columns: list[Column], weight: Column | None = None) -> Column:
    p = len(columns)
    terms = []
    for i in range(p):
        for j in range(i, p):
            t = columns[i] * columns[j]
            terms.append(F.sum(t if weight is None else t * weight))
    return F.array(*terms)


def fit_additive(long: DataFrame, factors: list[tuple[str, list]], keys: list[str] = ["metric"]) -> DataFrame:
    """Least squares per metric from one aggregation of cross products.

    The normal equations (at most 6 x 6) are solved on the aggregated rows, one
    per metric.  Null coefficients mean the model is not estimable.
    """
    cols = design(factors)
    use = long.where("value IS NOT NULL")
    sums = use.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), _weighted_products([c for _, c in cols]).alias("_xx"),
        F.array(*[F.sum(c * F.col("value")) for _, c in cols]).alias("_xy"))
    schema = ", ".join([f"`{k}` {use.schema[k].dataType.simpleString()}" for k in keys]
                       + ["n long", "df long", "beta array<double>", "inverse array<double>"])
    return sums.mapInPandas(_solve_models([n for n, _ in cols], keys), schema)


def model_rows(long: DataFrame, models: DataFrame, factors: list[tuple[str, list]],
               keys: list[str] = ["metric"]) -> DataFrame:
    """Fitted value, residual, standardised residual and leverage of every row.

    ``models`` has one row per metric; it is written, so that its true size decides
    how it is joined.
    """
    cols = [c for _, c in design(factors)]
    p = len(cols)
    use = long.where("value IS NOT NULL").join(materialize(models.where("beta IS NOT NULL")), keys)
    fitted = reduce(lambda a, b: a + b, [c * F.col("beta")[i] for i, c in enumerate(cols)])
    lev = reduce(lambda a, b: a + b, [cols[i] * cols[j] * F.col("inverse")[i * p + j]
                                      for i in range(p) for j in range(p)])
    out = use.withColumn("fitted", fitted).withColumn("residual", F.col("value") - F.col("fitted")).withColumn(
        "leverage", lev)
    rss = out.groupBy(*keys).agg(F.sum(F.col("residual") * F.col("residual")).alias("rss"),
                                 F.max("leverage").alias("max_leverage"))
    sd = F.sqrt(F.col("rss") / F.col("df"))
    return out.join(materialize(rss), keys).withColumn(
        "standardized_residual", F.when(sd > 0, F.col("residual") / sd)).drop("inverse", "beta")


def model_summary(rows: DataFrame, keys: list[str] = ["metric"]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.max("n").alias("n"), F.max("df").alias("residual_df"),
        (F.max("rss") / F.max("df")).alias("residual_variance"),
        F.sqrt(F.max("rss") / F.max("df")).alias("residual_sd"), F.max("max_leverage").alias("max_leverage"))


def robust_inference(long: DataFrame, factors: list[tuple[str, list]],
                     keys: list[str] = ["metric"]) -> tuple[DataFrame, DataFrame]:
    """HC3 covariance, joint test of the first factor and its three contrasts.

    A second aggregation gives X' diag((e / (1 - h))^2) X; the rest is arithmetic
    on one row per metric.
    """
    cols = design(factors)
    p = len(cols)
    levels = factors[0][1]
    models = fit_additive(long, factors, keys)
    rows = model_rows(long, models, factors, keys)
    scale = F.col("residual") / (1 - F.col("leverage"))
    meat = rows.groupBy(*keys).agg(
        _weighted_products([c for _, c in cols], scale * scale).alias("_meat"), F.max("rss").alias("rss"))
    packed = models.where("beta IS NOT NULL").join(meat, keys)
    upper = [(i, j) for i in range(p) for j in range(i, p)]
    contrasts = [(f"{levels[1]} - {levels[0]}", 0.0, 1.0, 0.0), (f"{levels[2]} - {levels[0]}", 0.0, 0.0, 1.0),
                 (f"{levels[1]} - {levels[2]}", 0.0, 1.0, -1.0)]

    def covariances(r):
        inv = np.array(r["inverse"]).reshape(p, p)
        m = np.zeros((p, p))
        for (i, j), v in zip(upper, r["_meat"]):
            m[i, j] = m[j, i] = v
        return inv * r["rss"] / r["df"], inv @ m @ inv

    def joint(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                for name, cov in zip(("ordinary covariance", "HC3 robust covariance"), covariances(r)):
                    b, c = np.array(r["beta"])[1:3], cov[1:3, 1:3]
                    f = float(b @ np.linalg.inv(c) @ b / 2) if np.linalg.matrix_rank(c) == 2 else None
                    out.append({**{k: r[k] for k in keys}, "covariance": name, "f": f, "df_num": 2,
                                "df_den": r["df"], "p": None if f is None else f_tail(f, 2, r["df"])})
            yield pd.DataFrame(out, columns=[*keys, "covariance", "f", "df_num", "df_den", "p"])

    def compare(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                _, hc3 = covariances(r)
                for name, *weights in contrasts:
                    c = np.zeros(p)
                    c[:3] = weights
                    diff, se = float(c @ np.array(r["beta"])), math.sqrt(max(0.0, float(c @ hc3 @ c)))
                    t = diff / se if se > 0 else None
                    half = t_quantile(0.975, r["df"]) * se
                    out.append({**{k: r[k] for k in keys}, "comparison": name, "difference": diff, "hc3_se": se,
                                "t": t, "df": r["df"], "raw_p": None if t is None else t_two_sided(t, r["df"]),
                                "ci95_lower": diff - half, "ci95_upper": diff + half})
            yield pd.DataFrame(out)

    key_schema = ", ".join(f"`{k}` {long.schema[k].dataType.simpleString()}" for k in keys)
    tests = packed.mapInPandas(joint, f"{key_schema}, covariance string, f double, df_num long, df_den long, p double")
    pairs = packed.mapInPandas(
        compare, f"{key_schema}, comparison string, difference double, hc3_se double, t double, df long, "
        "raw_p double, ci95_lower double, ci95_upper double")
    return tests, holm(pairs, "raw_p", keys, ["comparison"])


def qq_points(long: DataFrame, keys: list[str], tie_break: list[str]) -> DataFrame:
    """Ordered values against normal quantiles at Filliben positions."""
    r = ranked(long.where("value IS NOT NULL").select(*keys, *tie_break, "value"), keys, ["value", *tie_break])
    n, i = F.col("n"), F.col("rn")
    edge = F.pow(F.lit(0.5), 1.0 / n)
    position = F.when(i == n, edge).when(i == 1, 1 - edge).otherwise((i - 0.3175) / (n + 0.365))
    return r.select(*keys, *tie_break, "value", F.when(n > 1, norm_ppf(position)).otherwise(F.lit(0.0)).alias("theoretical"))


def qq_line(points: DataFrame, keys: list[str]) -> DataFrame:
    """Least-squares line through the Q-Q points (null when all values are equal)."""
    return points.groupBy(*keys).agg(
        F.regr_slope("value", "theoretical").alias("_s"), F.regr_intercept("value", "theoretical").alias("_i"),
        (F.min("value") < F.max("value")).alias("_v"), F.count(F.lit(1)).alias("n")).select(
        *keys, "n", F.when(F.col("_v"), F.col("_s")).alias("slope"), F.when(F.col("_v"), F.col("_i")).alias("intercept"))
