"""Statistics on rows that are already aggregated."""

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def z_value(probability):
    return NormalDist().inv_cdf(probability)


def two_tailed_p(z):
    """P(|Z| > |z|) as a column expression: the complementary error function of |z| / sqrt 2.

    Up to 2 by the series of the error function, whose terms all add up; beyond by the
    continued fraction of its complement, from its far end.
    """
    x = F.abs(z) / math.sqrt(2)
    near = F.aggregate(
        F.sequence(F.lit(60), F.lit(1), F.lit(-1)), F.lit(1.0),
        lambda rest, k: 1.0 + 2.0 * x * x / (2.0 * k + 1.0) * rest)
    far = F.aggregate(
        F.sequence(F.lit(80), F.lit(1), F.lit(-1)), x, lambda rest, k: x + (k / 2.0) / rest)
    scale = F.exp(-x * x) / math.sqrt(math.pi)
    return F.when(x < 2, 1.0 - 2.0 * x * scale * near).otherwise(scale / far)


def kolmogorov_p(statistic, n_reference, n_current, terms=100):
    """Two-sided p-value of the two-sample statistic from the limit distribution."""
    n = n_reference.cast("double") * n_current / (n_reference + n_current)
    scaled = F.sqrt(n) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    p = F.when(scaled < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
    return F.when(statistic.isNotNull(), p)


def _lattice_tail(d, n, m):
    """P(D >= d) for samples of n and m values: share of lattice paths that leave the band."""
    lcm = n * m // math.gcd(n, m)
    limit = round(d * lcm)
    if limit <= 0:
        return 1.0
    across = np.arange(m + 1) * (lcm // m)
    paths = (across < limit).astype(float)
    log_scale = 0.0
    for i in range(1, n + 1):
        inside = np.abs(across - i * (lcm // n)) < limit
        paths = np.cumsum(paths * inside) * inside
        peak = paths.max()
        if peak == 0.0:
            return 1.0
        paths /= peak
        log_scale += math.log(peak)
    if paths[-1] == 0.0:
        return 1.0
    log_all = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return min(1.0, max(0.0, -math.expm1(math.log(paths[-1]) + log_scale - log_all)))


@F.pandas_udf(T.DoubleType())
def kolmogorov_p_exact(statistic: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Exact two-sided p-value; one row per feature, for samples of at most 10,000."""
    return pd.Series(
        [
            None if pd.isna(d) else _lattice_tail(float(d), int(a), int(b))
            for d, a, b in zip(statistic, n, m)
        ],
        dtype="float64",
    )
