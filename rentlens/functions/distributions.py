"""Upper-tail probabilities of the normal, chi-square and F distributions.

Used on the one-row results of the statistical tests (SciPy is not
available).  Regularised incomplete gamma by series / continued fraction and
regularised incomplete beta by continued fraction (modified Lentz), both in
double precision.  ``pandas_udf`` wrappers let the p-value be a column of
the (tiny) result frame, so the test stays one lazy plan.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_TINY = 1e-300
_MAX_ITER = 10000


def normal_sf(z: float) -> float:
    if z is None or math.isnan(z):
        return float("nan")
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _gamma_p_series(a: float, x: float) -> float:
    term = 1.0 / a
    total = term
    ap = a
    for _ in range(_MAX_ITER):
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * _EPS:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_q_cf(a: float, x: float) -> float:
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, _MAX_ITER):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = _TINY if abs(d) < _TINY else d
        c = b + an / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        return 1.0 - _gamma_p_series(a, x)
    return _gamma_q_cf(a, x)


def chi2_sf(x: float, df: float) -> float:
    if x is None or df is None or math.isnan(x) or df <= 0:
        return float("nan")
    return gamma_q(df / 2.0, x / 2.0)


def _beta_cf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = 1.0
    d = 1.0 - qab * x / qap
    d = _TINY if abs(d) < _TINY else d
    d = 1.0 / d
    h = d
    for m in range(1, _MAX_ITER):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_cf(a, b, x) / a
    return 1.0 - front * _beta_cf(b, a, 1.0 - x) / b


def f_sf(x: float, d1: float, d2: float) -> float:
    if x is None or math.isnan(x) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * x))


def mann_whitney_exact_sf(n1: int, n2: int, u: float) -> float:
    """P(U >= u) without ties: the splits of n1 + n2 ranks into two groups, counted by their U.

    Their number by U is the Gaussian binomial coefficient: factors (1 - q^(n+i)) /
    (1 - q^i) for i up to the smaller group, as whole numbers."""
    k, n = sorted((int(n1), int(n2)))
    ways = [1] + [0] * (k * n)
    for i in range(1, k + 1):
        for j in range(k * n, n + i - 1, -1):
            ways[j] -= ways[j - n - i]
        for j in range(i, k * n + 1):
            ways[j] += ways[j - i]
    return sum(ways[max(0, math.ceil(u - 1e-9)):]) / math.comb(n + k, k)


# --- column wrappers (Arrow batches; used on result frames of a few rows) ---------

@F.pandas_udf(T.DoubleType())
def normal_sf_col(z: pd.Series) -> pd.Series:
    return z.map(lambda v: normal_sf(float(v)) if v is not None and not pd.isna(v) else float("nan"))


@F.pandas_udf(T.DoubleType())
def chi2_sf_col(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(float(a), float(b)) if not (pd.isna(a) or pd.isna(b)) else float("nan")
                      for a, b in zip(x, df)])


@F.pandas_udf(T.DoubleType())
def f_sf_col(x: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_sf(float(a), float(b), float(c)) if not (pd.isna(a) or pd.isna(b) or pd.isna(c))
                      else float("nan") for a, b, c in zip(x, d1, d2)])


@F.pandas_udf(T.DoubleType())
def mann_whitney_exact_sf_col(n1: pd.Series, n2: pd.Series, u: pd.Series) -> pd.Series:
    return pd.Series([mann_whitney_exact_sf(a, b, c) if not (pd.isna(a) or pd.isna(b) or pd.isna(c)) else float("nan") for a, b, c in zip(n1, n2, u)])
