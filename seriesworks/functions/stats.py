"""Tail probabilities for test statistics."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_KOLMOGOROV_TERMS = 100


def kolmogorov_p(statistic: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic p-value of the two-sample Kolmogorov-Smirnov statistic."""
    n1, n2 = n1.cast("double"), n2.cast("double")
    scaled = F.sqrt(n1 * n2 / (n1 + n2)) * statistic

    def add_term(total, k):
        sign = F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return total + sign * F.exp(-2.0 * k * k * scaled * scaled)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(_KOLMOGOROV_TERMS)), F.lit(0.0), add_term)
    # the series converges too slowly below this point, where the tail is 1 anyway
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(
        F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0))
    )


def _chi_square_tail(x: float, dof: float) -> float:
    if pd.isna(x) or pd.isna(dof) or dof < 1:
        return float("nan")
    half = x / 2.0
    if half <= 0:
        return 1.0
    n = int(dof)
    if n % 2:
        total, power = math.erfc(math.sqrt(half)), 0.5
    else:
        total, power = math.exp(-half), 1.0
    while power < n / 2.0:
        total += math.exp(power * math.log(half) - half - math.lgamma(power + 1.0))
        power += 1.0
    return min(1.0, total)


@F.pandas_udf(DoubleType())
def _chi_square_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([_chi_square_tail(a, b) for a, b in zip(x, dof)], dtype="float64")


def chi_square_p(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution for whole degrees of freedom.

    Runs on one row per tested feature only.
    """
    return F.nanvl(_chi_square_p(statistic.cast("double"), dof.cast("double")), F.lit(None))


def _exact_kolmogorov(d: float, n1: float, n2: float) -> float:
    """Share of the orders of two samples in one another whose largest gap is ``d`` or more.

    An order is a path over the grid of (values of one sample, values of the other) seen
    so far.  ``q[i]`` is the share of the paths to that point that have been ``d`` away
    from the diagonal, one anti-diagonal after the other.
    """
    if pd.isna(d) or pd.isna(n1) or pd.isna(n2) or min(n1, n2) < 1:
        return float("nan")
    m, n = sorted((int(n1), int(n2)))
    g = math.gcd(m, n)
    far = round(d * (m // g) * n)  # the statistic as a whole number of steps of 1 / lcm
    if far <= 0:
        return 1.0
    i = np.arange(m + 1)
    q = np.zeros(m + 1)
    for k in range(1, m + n + 1):
        q[1:] = q[1:] * (k - i[1:]) / k + q[:-1] * i[1:] / k
        j = k - i
        q[(np.abs(i * (n // g) - j * (m // g)) >= far) & (j >= 0) & (j <= n)] = 1.0
        q[(j < 0) | (j > n)] = 0.0
    return float(min(1.0, q[m]))


@F.pandas_udf(DoubleType())
def _exact_kolmogorov_p(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([_exact_kolmogorov(*row) for row in zip(d, n1, n2)], dtype="float64")


def exact_kolmogorov_p(statistic: Column, n1: Column, n2: Column) -> Column:
    """Exact p-value of the two-sample Kolmogorov-Smirnov statistic; work grows with n1 * n2.

    Runs on one row per tested feature only.
    """
    p = _exact_kolmogorov_p(statistic.cast("double"), n1.cast("double"), n2.cast("double"))
    return F.nanvl(p, F.lit(None))
