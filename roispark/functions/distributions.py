"""Distribution functions for statistics rows.

The normal quantile is a Spark expression because it is applied per distinct
value; the tail probabilities are evaluated on a handful of result rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Coefficients of algorithm AS 241 (Wichura 1988), ascending powers.
PPND_CENTRE_NUM = [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
                   1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
                   3.3430575583588128105e4, 2.5090809287301226727e3]
PPND_CENTRE_DEN = [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
                   2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
                   5.2264952788528545610e3]
PPND_MIDDLE_NUM = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
                   3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
                   2.27238449892691845833e-2, 7.74545014278341407640e-4]
PPND_MIDDLE_DEN = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
                   1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
                   1.05075007164441684324e-9]
PPND_TAIL_NUM = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
                 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
                 2.71155556874348757815e-5, 2.01033439929228813265e-7]
PPND_TAIL_DEN = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
                 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
                 2.04426310338993978564e-15]


def norm_ppf(p: Column) -> Column:
    """Standard normal quantile of a probability in (0, 1)."""
    def poly(coefficients, x):
        out = F.lit(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            out = out * x + F.lit(c)
        return out

    q = p - 0.5
    centre = F.lit(0.180625) - q * q
    tail = F.sqrt(-F.log(F.when(q < 0, p).otherwise(1.0 - p)))
    value = F.when(tail <= 5.0, poly(PPND_MIDDLE_NUM, tail - 1.6) / poly(PPND_MIDDLE_DEN, tail - 1.6)).otherwise(
        poly(PPND_TAIL_NUM, tail - 5.0) / poly(PPND_TAIL_DEN, tail - 5.0))
    return F.when(F.abs(q) <= 0.425, q * poly(PPND_CENTRE_NUM, centre) / poly(PPND_CENTRE_DEN, centre)).otherwise(
        F.when(q < 0, -value).otherwise(value))


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function (continued fraction)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_inc(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    out = d
    for m in range(1, 10000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
            c = 1.0 + num / c
            c = c if abs(c) > 1e-300 else 1e-300
            out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * out


def gamma_tail(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    scale = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1:
        term = total = 1.0 / s
        k = s
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1.0 - total * scale
    b = x + 1.0 - s
    c, d = 1e300, 1.0 / b
    out = d
    for i in range(1, 10000):
        an = -i * (i - s)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = b + an / c
        c = c if abs(c) > 1e-300 else 1e-300
        out *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return scale * out


def f_tail(f: float, d1: float, d2: float) -> float:
    return 1.0 if f <= 0 else beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """Upper quantile (p > 0.5) by bisection on the tail."""
    lo, hi = 0.0, 1.0
    while t_two_sided(hi, df) / 2 > 1 - p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if t_two_sided(mid, df) / 2 > 1 - p else (lo, mid)
    return (lo + hi) / 2


def norm_tail(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def mann_whitney_exact(u: float, n1: int, n2: int) -> float:
    """Two-sided exact p without ties: counts of U as a Gaussian binomial coefficient."""
    small, large = min(n1, n2), max(n1, n2)
    top = int(n1 * n2 - math.floor(max(u, n1 * n2 - u)))
    weights = np.zeros(n1 * n2 + 1)
    weights[0] = 1.0
    for j in range(1, small + 1):
        shifted = weights.copy()
        shifted[large + j:] -= weights[:-(large + j)] if large + j < len(weights) else 0
        for start in range(j):
            shifted[start::j] = np.cumsum(shifted[start::j])
        weights = shifted
    return float(min(1.0, 2.0 * weights[:top + 1].sum() / math.comb(n1 + n2, small)))


def chi2_sf(x: Column, df: Column) -> Column:
    """Upper tail of the chi-square distribution."""
    def tail(v: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([gamma_tail(k / 2, c / 2) if c == c and k == k else None
                          for c, k in zip(v, d)], dtype="float64")

    return F.pandas_udf(tail, T.DoubleType())(x.cast("double"), df.cast("double"))


def f_sf(f: Column, d1: Column, d2: Column) -> Column:
    """Upper tail of the F distribution."""
    def tail(v: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f_tail(c, p, q) if c == c and p == p and q == q else None
                          for c, p, q in zip(v, a, b)], dtype="float64")

    return F.pandas_udf(tail, T.DoubleType())(f.cast("double"), d1.cast("double"), d2.cast("double"))


def mann_whitney_p(u: Column, n1: Column, n2: Column, ties: Column) -> Column:
    """Two-sided p: exact when one sample has at most 8 values and nothing is tied,
    else normal with tie and continuity correction."""
    def tail(us: pd.Series, a: pd.Series, b: pd.Series, t: pd.Series) -> pd.Series:
        out = []
        for uu, p, q, tie in zip(us, a, b, t):
            p, q = int(p), int(q)
            if tie == 0 and min(p, q) <= 8:
                out.append(mann_whitney_exact(uu, p, q))
                continue
            n = p + q
            sd = math.sqrt(p * q / 12 * ((n + 1) - tie / (n * (n - 1))))
            z = (max(uu, p * q - uu) - p * q / 2 - 0.5) / sd if sd > 0 else float("nan")
            out.append(min(1.0, 2 * norm_tail(z)) if z == z else None)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(tail, T.DoubleType())(u.cast("double"), n1, n2, ties.cast("double"))
