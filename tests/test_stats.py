import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from roispark.functions import distributions as dist
from roispark.functions.ranking import group_quantiles, ranked, value_positions
from roispark.operators import registration, stats


def long(spark, groups, metric="m"):
    data = [(metric, g, float(v)) for g, values in groups.items() for v in values]
    return spark.createDataFrame(data, "metric string, line string, value double")


def test_ranked_equals_window(spark):
    rng = random.Random(0)
    data = [("hot" if rng.random() < 0.7 else f"k{rng.randint(0, 5)}", rng.randint(0, 9), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, v long, id long").repartition(6)
    got = {(r.k, r.id): (r.rn, r.n) for r in ranked(df, ["k"], [F.col("v").desc(), "id"]).collect()}
    for k in {d[0] for d in data}:
        order = sorted((d for d in data if d[0] == k), key=lambda d: (-d[1], d[2]))
        for i, d in enumerate(order, 1):
            assert got[(k, d[2])] == (i, len(order))


def test_positions_and_quantiles(spark):
    rng = random.Random(1)
    values = {g: [float(rng.randint(0, 40)) for _ in range(n)] for g, n in (("a", 1), ("b", 2), ("c", 777))}
    df = long(spark, values)
    probs = {f"p{p}": p / 100 for p in (0, 5, 25, 50, 95, 100)}
    for r in group_quantiles(df, ["line"], "value", probs).collect():
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.percentile(values[r.line], p * 100), abs=1e-12)
    for r in value_positions(df, ["line"], "value").collect():
        v = values[r.line]
        assert r.below == sum(x < r.value for x in v) and r.times == v.count(r.value) and r.n == len(v)


# Reference values: standard tables of the distributions.
def test_distribution_tails():
    assert dist.f_tail(4.964603, 1, 10) == pytest.approx(0.05, abs=1e-6)
    assert dist.f_tail(3.098391, 3, 20) == pytest.approx(0.05, abs=1e-6)
    assert dist.gamma_tail(1.0, 5.991465 / 2) == pytest.approx(0.05, abs=1e-7)
    assert dist.gamma_tail(2.5, 11.0705 / 2) == pytest.approx(0.05, abs=1e-6)
    assert dist.t_quantile(0.975, 9) == pytest.approx(2.262157, abs=1e-6)
    assert dist.t_two_sided(2.262157, 9) == pytest.approx(0.05, abs=1e-6)
    assert dist.norm_tail(1.959964) == pytest.approx(0.025, abs=1e-7)


def test_norm_ppf(spark):
    ps = [1e-9, 1e-4, 0.025, 0.3, 0.5, 0.9, 0.975, 1 - 1e-7]
    df = spark.createDataFrame([(p,) for p in ps], "p double").select("p", dist.norm_ppf(F.col("p")).alias("z"))
    for r in df.collect():
        assert dist.norm_tail(-r.z) == pytest.approx(r.p, rel=1e-9)


def test_mann_whitney_exact_by_enumeration():
    for n1, n2 in ((2, 3), (4, 4), (3, 6)):
        ranks = range(1, n1 + n2 + 1)
        us = [sum(c) - n1 * (n1 + 1) / 2 for c in itertools.combinations(ranks, n1)]
        for u in range(n1 * n2 + 1):
            far = max(u, n1 * n2 - u)
            want = min(1.0, 2 * sum(x >= far for x in us) / len(us))
            assert dist.mann_whitney_exact(u, n1, n2) == pytest.approx(want)


def test_kruskal_by_hand(spark):
    groups = {"A": [1, 2, 3, 3], "B": [3, 4, 5], "C": [6, 7, 7, 9]}
    r = stats.kruskal_wallis(long(spark, groups), "line").collect()[0]
    pool = sorted(v for g in groups.values() for v in g)
    rank = {v: np.mean([i + 1 for i, x in enumerate(pool) if x == v]) for v in pool}
    n = len(pool)
    h = 12 / (n * (n + 1)) * sum(sum(rank[v] for v in g) ** 2 / len(g) for g in groups.values()) - 3 * (n + 1)
    ties = sum(pool.count(v) ** 3 - pool.count(v) for v in set(pool))
    assert r.h == pytest.approx(h / (1 - ties / (n ** 3 - n))) and r.df == 2
    assert r.p == pytest.approx(math.exp(-r.h / 2))
    assert stats.kruskal_wallis(long(spark, {"A": [1], "B": [2, 3]}), "line").collect()[0].h is None


def test_mann_whitney_and_holm(spark):
    groups = {"A": [1.5, 2.5, 3.5], "B": [4.5, 5.5, 6.5, 7.5], "C": [0.5, 8.5, 9.5]}
    got = {(r.group1, r.group2): r for r in stats.mann_whitney(
        long(spark, groups), "line", [("A", "B"), ("A", "C"), ("B", "C")]).collect()}
    assert got[("A", "B")].u == 0 and got[("A", "B")].p_raw == pytest.approx(2 / 35)
    p = sorted(r.p_raw for r in got.values())
    want, run = [], 0.0
    for i, v in enumerate(p):
        run = max(run, v * (3 - i))
        want.append(min(1.0, run))
    assert sorted(r.p_holm for r in got.values()) == pytest.approx(want)


def test_holm_missing_counts_as_one(spark):
    df = spark.createDataFrame([("m", "x", 0.01), ("m", "y", None), ("m", "z", 0.04)], "metric string, t string, p double")
    got = {r.t: r.p_holm for r in stats.holm(df, "p", ["metric"], ["t"]).collect()}
    assert got == pytest.approx({"x": 0.03, "z": 0.08, "y": 1.0})


def test_descriptives_edge_cases(spark):
    df = spark.createDataFrame([("m", "one", 100.0), ("m", "two", 0.0), ("m", "two", 100.0), ("m", "none", None)],
                               "metric string, line string, value double")
    got = {r.line: r for r in stats.descriptives(df, ["metric", "line"]).collect()}
    assert got["one"].sample_variance is None and got["one"].n_100 == 1 and got["one"].median == 100
    assert got["two"].sample_sd == pytest.approx(np.std([0, 100], ddof=1)) and got["two"].n_zero == 1
    assert got["none"].n_valid == 0 and got["none"].n_missing == 1 and got["none"].mean is None
    cells = df.withColumn("batch", F.lit("p"))
    grid = {r.line: r for r in stats.variance_matrix(cells, ("line", ["one", "two", "x"]), ("batch", ["p"])).collect()}
    assert grid["x"].n_total == 0 and grid["x"].sample_variance is None and grid["two"].n_valid == 2


def test_anova_family(spark):
    rng = random.Random(4)
    groups = {g: [rng.gauss(m, s) for _ in range(12)] for g, m, s in (("A", 0, 1), ("B", 1, 2), ("C", 0.5, 1))}
    df = long(spark, groups)

    def f_oneway(gs):
        allv = np.concatenate(gs)
        between = sum(len(g) * (np.mean(g) - allv.mean()) ** 2 for g in gs)
        within = sum(((np.array(g) - np.mean(g)) ** 2).sum() for g in gs)
        return (between / (len(gs) - 1)) / (within / (len(allv) - len(gs)))

    arrays = [np.array(v) for v in groups.values()]
    a = stats.anova_table(df, "value", "line").collect()[0]
    assert a.f == pytest.approx(f_oneway(arrays)) and (a.df_num, a.df_den) == (2, 33)
    assert a.p == pytest.approx((1 + 2 * a.f / 33) ** (-33 / 2))
    b = stats.brown_forsythe(df, "line").collect()[0]
    assert b.f == pytest.approx(f_oneway([np.abs(x - np.median(x)) for x in arrays]))
    one = long(spark, {"A": [1.0, 1.0], "B": [2.0, 2.0]})
    assert stats.welch_anova(one, "line").collect()[0].note.startswith("zero within-group")
    assert stats.variance_ratio(one, "line").collect()[0].variance_ratio is None
    half = long(spark, {"A": [1.0, 1.0], "B": [2.0, 3.0]})
    assert stats.variance_ratio(half, "line").collect()[0].variance_ratio == float("inf")


def test_shapiro_published_example(spark):
    # Weights of 11 men (Shapiro and Wilk 1965): W = 0.79, p < 0.01.
    data = {"w": [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], "few": [1, 2], "flat": [3] * 9}
    got = {r.line: r for r in stats.shapiro_wilk(long(spark, data), ["metric", "line"]).collect()}
    assert got["w"].w == pytest.approx(0.79, abs=0.005) and got["w"].p == pytest.approx(0.0067, abs=0.001)
    assert got["few"].w is None and "n<3" in got["few"].note and "identical" in got["flat"].note


def test_additive_model_and_hc3(spark):
    rng = np.random.default_rng(3)
    n = 60
    pdf = pd.DataFrame({"metric": "m", "line": rng.choice(["A", "B", "C"], n), "batch": rng.choice(["x", "y"], n)})
    pdf["value"] = rng.normal(size=n) + (pdf.line == "B") * 2.0
    df = spark.createDataFrame(pdf)
    factors = [("line", ["A", "B", "C"]), ("batch", ["x", "y"])]
    X = np.column_stack([np.ones(n), pdf.line == "B", pdf.line == "C", pdf.batch == "y"]).astype(float)
    y = pdf.value.to_numpy()
    inv = np.linalg.inv(X.T @ X)
    beta = inv @ X.T @ y
    e, h = y - X @ beta, np.einsum("ij,jk,ik->i", X, inv, X)
    hc3 = inv @ (X.T @ ((e / (1 - h))[:, None] ** 2 * X)) @ inv
    assert stats.fit_additive(df, factors).collect()[0].beta == pytest.approx(beta.tolist())
    tests, contrasts = stats.robust_inference(df, factors)
    c = {r.comparison: r for r in contrasts.collect()}
    assert c["B - A"].difference == pytest.approx(beta[1]) and c["B - A"].hc3_se == pytest.approx(math.sqrt(hc3[1, 1]))
    v = np.array([0, 1, -1, 0.0])
    assert c["B - C"].hc3_se == pytest.approx(math.sqrt(v @ hc3 @ v))
    assert c["B - A"].ci95_upper - c["B - A"].difference == pytest.approx(dist.t_quantile(0.975, n - 4) * c["B - A"].hc3_se)
    joint = {r.covariance: r.f for r in tests.collect()}
    assert joint["HC3 robust covariance"] == pytest.approx(beta[1:3] @ np.linalg.inv(hc3[1:3, 1:3]) @ beta[1:3] / 2)
    few = df.limit(5)
    assert stats.fit_additive(few, factors).collect()[0].beta is None


# --- registration --------------------------------------------------------------
def points(spark, pts, acq=0):
    return spark.createDataFrame([(acq, i, float(x), float(y)) for i, (x, y) in enumerate(pts)],
                                 "acquisition_id long, object_id long, x double, y double")


def test_assignment_is_optimal(spark):
    rng = random.Random(8)
    gate = 3.0
    single = 2 * registration.DUMMY_FACTOR * gate * gate
    want = {}
    ms, fs = [], []
    for acq in range(6):
        m = [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(6)]
        f = [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(6)]
        ms.append(points(spark, m, acq))
        fs.append(points(spark, f, acq))
        best = 0.0

        def walk(i, used, saved):
            nonlocal best
            best = max(best, saved)
            if i == len(m):
                return
            walk(i + 1, used, saved)
            for j, q in enumerate(f):
                d2 = (m[i][0] - q[0]) ** 2 + (m[i][1] - q[1]) ** 2
                if j not in used and d2 <= gate * gate:
                    walk(i + 1, used | {j}, saved + single - d2)

        walk(0, frozenset(), 0.0)
        want[acq] = best
    mov, fix = ms[0], fs[0]
    for a, b in zip(ms[1:], fs[1:]):
        mov, fix = mov.unionByName(a), fix.unionByName(b)
    pairs = registration.gated_pairs(mov, fix, gate)
    got = registration.assign_pairs(pairs, gate).collect()
    for acq, best in want.items():
        mine = [r for r in got if r.acquisition_id == acq]
        assert len({r.moving_id for r in mine}) == len(mine) == len({r.fixed_id for r in mine})
        assert sum(single - r.d2 for r in mine) == pytest.approx(best)


def test_assignment_across_tiles_is_that_of_one_tile(spark):
    """Sparse points over many tiles: borders are crossed by shifted tiles, the total stays the optimum."""
    rng = random.Random(3)
    gate, single = 3.0, 2 * registration.DUMMY_FACTOR * 9.0
    mov, fix = ([(rng.uniform(0, 50), rng.uniform(0, 50)) for _ in range(60)] for _ in range(2))
    pairs = registration.gated_pairs(points(spark, mov), points(spark, fix), gate)
    one, many = ({(r.moving_id, r.fixed_id): single - r.d2 for r in registration.assign_pairs(pairs, gate, t).collect()} for t in (128, 8))
    assert len({m for m, _ in many}) == len(many) == len({f for _, f in many})
    assert sum(many.values()) == pytest.approx(sum(one.values()), abs=1e-3)


def test_register_with_noise_and_outliers(spark):
    """Refits after trimming recover the motion although a tenth of the points is displaced and all are blurred."""
    rng = random.Random(12)
    fixed = [(20 * i + rng.uniform(-4, 4), 20 * j + rng.uniform(-4, 4)) for i in range(12) for j in range(12)]
    a = 0.01
    moving = []
    for k, (x, y) in enumerate(fixed):
        shift = 7.0 if k % 10 == 0 else 0.0
        moving.append((math.cos(a) * x - math.sin(a) * y + 2 + rng.gauss(0, 0.1) + shift, math.sin(a) * x + math.cos(a) * y - 1 + rng.gauss(0, 0.1)))
    out = registration.register(points(spark, moving), points(spark, fixed), 9.0)
    t = out["transform"].collect()[0]
    assert t.a == pytest.approx(math.cos(a), abs=1e-3) and t.b == pytest.approx(-math.sin(a), abs=1e-3)
    anchors = {r.moving_id: r for r in out["anchors"].collect()}
    assert all(r.moving_id == r.fixed_id for r in anchors.values())
    assert set(anchors) == {k for k in range(len(fixed)) if k % 10} and t.anchors == len(anchors)


def test_register_recovers_known_motion(spark):
    rng = random.Random(2)
    fixed = [(rng.uniform(0, 300), rng.uniform(0, 300)) for _ in range(80)]
    a = 0.02
    moving = [(math.cos(a) * x - math.sin(a) * y + 3, math.sin(a) * x + math.cos(a) * y - 2) for x, y in fixed]
    out = registration.register(points(spark, moving), points(spark, fixed), 12.0)
    t = out["transform"].collect()[0]
    assert t.a == pytest.approx(math.cos(a), abs=1e-9) and t.b == pytest.approx(-math.sin(a), abs=1e-9)
    assert max(r.residual_px for r in out["anchors"].collect()) < 1e-6
    few = registration.register(points(spark, moving[:5]), points(spark, fixed[:5]), 12.0)
    assert few["transform"].count() == 0
    shifted = registration.register(points(spark, [(x + 100, y) for x, y in moving]), points(spark, fixed), 12.0,
                                    shift=spark.createDataFrame([(0, -100.0, 0.0)], "acquisition_id long, dx double, dy double"))
    assert shifted["transform"].collect()[0].a == pytest.approx(math.cos(a), abs=1e-9)


def test_grouping_sets_equal_the_groups_on_their_own(spark):
    rng = random.Random(3)
    data = [("m" if i % 3 else "k", rng.choice("AB"), rng.randint(0, 2), None if i % 11 == 0 else 1e6 + rng.randint(0, 30) / 8)
            for i in range(400)] + [("m", "Z", 9, 5.0), ("m", "Y", 9, None), ("void", "A", 0, None)]
    df = spark.createDataFrame(data, "metric string, line string, batch long, value double")
    got = stats.grouped_descriptives(df, [(), ("line",), ("line", "batch")], ["line", "batch"]).collect()
    plain = {g: stats.descriptives(df, ["metric", *g]).collect() for g in ((), ("line",), ("line", "batch"))}
    want = {(r.metric, " x ".join(g) or "overall", *[str(r[d]) if d in g else "" for d in ("line", "batch")]): r
            for g, found in plain.items() for r in found}
    assert {(r.metric, r.grouping, r.line, r.batch) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        one = want[r.metric, r.grouping, r.line, r.batch]
        for c in one.asDict():
            if c not in ("metric", "line", "batch"):
                assert r[c] == (one[c] if not isinstance(one[c], float) else pytest.approx(one[c], rel=1e-9, abs=1e-9)), (c, one)
