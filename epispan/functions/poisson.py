"""Exact Poisson limits without a statistics package: a gamma quantile for listed counts, an expansion above them."""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import Z_975

_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(96)
_LARGE = 100.0


def _log_density(shape: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Log gamma density; large shapes are centred on the mode to keep digits."""
    result = np.empty_like(x)
    large = shape >= _LARGE
    if large.any():
        mode = shape[large] - 1.0
        off = (x[large] - mode) / mode
        centre = -0.5 * np.log(2 * np.pi * mode) - 1 / (12 * mode) + 1 / (360 * mode**3)
        result[large] = mode * (np.log1p(off) - off) + centre
    if not large.all():
        a, t = shape[~large], x[~large]
        result[~large] = (a - 1.0) * np.log(t) - t - np.array([math.lgamma(v) for v in a])
    return result


def _cdf_small(shape: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Lower regularised gamma by its all-positive power series."""
    term = np.ones_like(x)
    total = np.ones_like(x)
    step = shape.copy()
    for _ in range(2000):
        step = step + 1.0
        term = term * x / step
        total = total + term
        if np.all(term <= 1e-17 * total):
            break
    else:
        raise ArithmeticError("the gamma series did not settle in 2000 terms")
    return np.clip(np.exp(_log_density(shape, x)) * x / shape * total, 0.0, 1.0)


def _cdf_large(shape: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Lower regularised gamma by quadrature between ``x`` and the far lower tail."""
    low = np.maximum(shape - 1.0 - 12.0 * np.sqrt(shape), 0.0)
    high = np.maximum(x, low)
    half = (high - low) / 2.0
    points = (high + low)[:, None] / 2.0 + half[:, None] * _NODES[None, :]
    density = np.exp(_log_density(np.broadcast_to(shape[:, None], points.shape), points))
    return np.clip(half * (density * _WEIGHTS[None, :]).sum(axis=1), 0.0, 1.0)


def gamma_cdf(shape: np.ndarray, x: np.ndarray) -> np.ndarray:
    result = np.empty_like(x)
    large = shape >= _LARGE
    if (~large).any():
        result[~large] = _cdf_small(shape[~large], x[~large])
    if large.any():
        result[large] = _cdf_large(shape[large], x[large])
    return result


def gamma_quantile(shape: np.ndarray, p: float) -> np.ndarray:
    """Solve ``gamma_cdf(shape, x) == p`` by Newton steps kept inside a bracket."""
    shape = np.asarray(shape, dtype=float)
    z = math.copysign(1.959963984540054, p - 0.5)
    start = shape * (1 - 1 / (9 * shape) + z / (3 * np.sqrt(shape))) ** 3
    x = np.where(start > 0, start, shape * 1e-3)
    low = np.zeros_like(shape)
    high = shape + 14.0 * np.sqrt(shape) + 30.0
    open_ = np.arange(shape.size)
    while open_.size:
        a, t = shape[open_], x[open_]
        gap = gamma_cdf(a, t) - p
        low[open_] = np.where(gap < 0, t, low[open_])
        high[open_] = np.where(gap > 0, t, high[open_])
        newton = t - gap / np.exp(_log_density(a, t))
        inside = (newton > low[open_]) & (newton < high[open_])
        following = np.where(gap == 0, t, np.where(inside, newton, (low[open_] + high[open_]) / 2))
        x[open_] = following
        open_ = open_[np.abs(following - t) > 1e-12 * t]
    return x


def poisson_limits(count: np.ndarray, alpha: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Exact two-sided limits of a Poisson mean for each observed count."""
    count = np.asarray(count, dtype=float)
    if (count < 0).any():
        raise ValueError("Poisson limits need counts from zero up")
    distinct, back = np.unique(count, return_inverse=True)
    lower = np.zeros_like(distinct)
    if (distinct > 0).any():
        lower[distinct > 0] = gamma_quantile(distinct[distinct > 0], alpha / 2)
    upper = gamma_quantile(distinct + 1.0, 1 - alpha / 2)
    return lower[back], upper[back]


#: Counts whose limits are listed; above them the expansion below is exact to the last digits.
LISTED_COUNTS = 10_000


@cache
def _listed() -> pd.DataFrame:
    lower, upper = poisson_limits(np.arange(LISTED_COUNTS))
    return pd.DataFrame({"_n": np.arange(LISTED_COUNTS), "_lower": lower, "_upper": upper})


def _chi_square_quantile(freedom: Column, z: float) -> Column:
    """Cornish-Fisher expansion of a chi-square quantile; its error falls with the cube of the degrees of freedom."""
    root = F.sqrt(freedom)
    terms = [
        F.lit(math.sqrt(2) * z) * root,
        F.lit(2 / 3 * (z**2 - 1)),
        F.lit((z**3 - 7 * z) / (9 * math.sqrt(2))) / root,
        F.lit(-(6 * z**4 + 14 * z**2 - 32) / 405) / freedom,
        F.lit((9 * z**5 + 256 * z**3 - 433 * z) / (4860 * math.sqrt(2))) / (freedom * root),
        F.lit((12 * z**6 - 243 * z**4 - 923 * z**2 + 1472) / 25515) / (freedom * freedom),
    ]
    return sum(terms, freedom)


def with_poisson_interval(df: DataFrame, count: str, name: str) -> DataFrame:
    """``df`` with a struct of the exact 95 % limits of each count; null for a null count, an error below zero.

    Limits of counts below ``LISTED_COUNTS`` are listed once and joined by count, larger ones are an
    expression. The list has a fixed size, so it is broadcast; nothing leaves the JVM.
    """
    listed = F.broadcast(df.sparkSession.createDataFrame(_listed()))
    n = F.col(count).cast("double")
    lower = _chi_square_quantile(2 * n, -Z_975) / 2
    upper = _chi_square_quantile(2 * n + 2, Z_975) / 2
    large = F.struct(lower.alias("lower"), upper.alias("upper"))
    refused = F.raise_error(F.lit("Poisson limits need counts from zero up"))
    none = F.lit(None).cast("double")
    limits = (
        F.when(F.col(count).isNull(), F.struct(none.alias("lower"), none.alias("upper")))
        .when(n < 0, refused.cast("struct<lower: double, upper: double>"))
        .when(n >= LISTED_COUNTS, large)
        .otherwise(F.struct(F.col("_lower").alias("lower"), F.col("_upper").alias("upper")))
    )
    joined = df.join(listed, F.col(count).cast("long") == F.col("_n"), "left")
    return joined.withColumn(name, limits).drop("_n", "_lower", "_upper")
