"""Scalar distribution tails for p-values (SciPy is not available).

Standard special-function evaluations: regularized incomplete gamma (series /
continued fraction) and regularized incomplete beta (Lentz continued
fraction).  They run on tiny statistics tables through a pandas UDF.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ITER = 500
_EPS = 3e-16
_TINY = 1e-300


def log_gammaincc(a: float, x: float) -> float:
    """ln Q(a, x), Q(a, x) = Gamma(a, x) / Gamma(a); far tails that a double can't hold as such keep their logarithm."""
    if x != x or a != a:
        return float("nan")
    if x <= 0:
        return 0.0
    lg = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1.0:
        term = total = 1.0 / a
        ap = a
        for _ in range(_ITER):
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * _EPS:
                break
        return math.log1p(-min(total * math.exp(lg), 1.0 - _EPS))
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, _ITER):
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
    return lg + math.log(h)


def gammaincc(a: float, x: float) -> float:
    """Q(a, x)."""
    return math.exp(log_gammaincc(a, x))


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = 1.0
    d = 1.0 - qab * x / qap
    d = _TINY if abs(d) < _TINY else d
    d = 1.0 / d
    h = d
    for m in range(1, _ITER):
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


def log_betainc(a: float, b: float, x: float) -> float:
    """ln I_x(a, b)."""
    if x <= 0.0:
        return -math.inf
    if x >= 1.0:
        return 0.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return lbt + math.log(_betacf(a, b, x) / a)
    return math.log1p(-min(math.exp(lbt) * _betacf(b, a, 1.0 - x) / b, 1.0 - _EPS))


def betainc(a: float, b: float, x: float) -> float:
    """I_x(a, b)."""
    return math.exp(log_betainc(a, b, x))


def chi2_log_sf(x: float, dof: float) -> float:
    if dof is None or x is None or dof <= 0:
        return 0.0
    return log_gammaincc(dof / 2.0, x / 2.0)


def chi2_sf(x: float, dof: float) -> float:
    return math.exp(chi2_log_sf(x, dof))


def corr_log_pvalue(r: float, n: float) -> float:
    """ln of the two-sided p of a Pearson r with n - 2 degrees of freedom."""
    if r is None or n is None or n <= 2 or r != r:
        return float("nan")
    # I_x(dof / 2, 1 / 2) at x = dof / (dof + t^2) = 1 - r^2
    return log_betainc((n - 2.0) / 2.0, 0.5, 1.0 - r * r) if abs(r) < 1.0 else -math.inf


def corr_pvalue(r: float, n: float) -> float:
    return math.exp(corr_log_pvalue(r, n))


_LN10 = math.log(10.0)


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(a, b) for a, b in zip(x, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def corr_pvalue_udf(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([corr_pvalue(a, b) for a, b in zip(r, n)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_log10_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_log_sf(a, b) / _LN10 for a, b in zip(x, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def corr_log10_udf(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([corr_log_pvalue(a, b) / _LN10 for a, b in zip(r, n)], dtype="float64")
