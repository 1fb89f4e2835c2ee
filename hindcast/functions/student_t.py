"""Quantiles of Student's t distribution as vectorised column functions."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Floors that keep stored quantiles reproducible.
EXTRA_FREEDOM = 2.0
SCALE_FLOOR = 1e-6
TAIL_GUARD = 1e-8


def softplus(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


# From here on the normal expansion is exact to nine digits.
NORMAL_FROM = 200.0
NODES, WEIGHTS = np.polynomial.legendre.leggauss(96)


def _share_below(angle: np.ndarray, freedom: np.ndarray) -> np.ndarray:
    """P(0 < t < sqrt(v) tan(angle)): in this angle the density is cos to the power v - 1."""
    half = angle[..., None] / 2
    log_cos = np.log(np.maximum(np.cos(half * (NODES + 1)), 1e-300))
    area = (half * WEIGHTS * np.exp((freedom[..., None] - 1) * log_cos)).sum(-1)
    log_whole = np.array([math.lgamma((v + 1) / 2) - math.lgamma(v / 2) for v in freedom.ravel()]).reshape(freedom.shape)
    return area * np.exp(log_whole) / math.sqrt(math.pi)


def _by_angle(above: np.ndarray, freedom: np.ndarray) -> np.ndarray:
    """The positive t with that much probability between 0 and t, by halving the quarter circle."""
    low, high = np.zeros(above.shape), np.full(above.shape, math.pi / 2)
    for _ in range(60):
        middle = (low + high) / 2
        short = _share_below(middle, freedom) < above
        low, high = np.where(short, middle, low), np.where(short, high, middle)
    return np.sqrt(freedom) * np.tan((low + high) / 2)


def _by_normal(above: np.ndarray, freedom: np.ndarray) -> np.ndarray:
    """The same from the normal quantile, by its expansion in 1 / v."""
    z = np.array([NormalDist().inv_cdf(0.5 + x) for x in above.ravel()]).reshape(above.shape)
    v, s = freedom, z * z
    return z * (
        1 + (s + 1) / (4 * v) + ((5 * s + 16) * s + 3) / (96 * v**2) + (((3 * s + 19) * s + 17) * s - 15) / (384 * v**3)
        + ((((79 * s + 776) * s + 1482) * s - 1920) * s - 945) / (92160 * v**4))


def t_quantile(q: np.ndarray, freedom: np.ndarray, guard: float = TAIL_GUARD) -> np.ndarray:
    """Standard quantiles; ``guard`` is added to v / (v + t^2), which bounds the far tails."""
    q, freedom = np.broadcast_arrays(np.asarray(q, float), np.asarray(freedom, float))
    inside = (q > 0) & (q < 1)
    above = np.where(inside, np.abs(q - 0.5), 0.0)
    wide = freedom >= NORMAL_FROM
    t = np.zeros(q.shape)
    t[~wide] = _by_angle(above[~wide], freedom[~wide])
    t[wide] = _by_normal(above[wide], freedom[wide])
    rest = freedom / (freedom + t * t) + guard
    t = np.sqrt(np.maximum(freedom / rest - freedom, 0.0))
    return np.where(inside, np.sign(q - 0.5) * t, np.where(q <= 0, -np.inf, np.where(q >= 1, np.inf, np.nan)))


@F.pandas_udf(T.DoubleType())
def standard_t(q: pd.Series, freedom: pd.Series) -> pd.Series:
    """Standard Student-t quantile, one Arrow batch at a time."""
    out = np.full(len(q), np.nan)
    known = (q.notna() & freedom.notna()).to_numpy()
    if known.any():
        pairs = np.column_stack([q.to_numpy(float)[known], freedom.to_numpy(float)[known]])
        unique, back = np.unique(pairs, axis=0, return_inverse=True)
        out[known] = t_quantile(unique[:, 0], unique[:, 1])[back.reshape(-1)]
    return pd.Series(out)


def expand_quantiles(df: DataFrame, levels, *, raw_freedom: str, raw_loc: str, raw_scale: str,
                     location: str = "location", scale: str = "scale") -> DataFrame:
    """Raw distribution parameters of each row to one row per level, back on the original scale."""
    freedom = softplus(F.col(raw_freedom)) + EXTRA_FREEDOM
    width = softplus(F.col(raw_scale)) + SCALE_FLOOR
    each = df.select("*", F.explode(F.array(*[F.lit(float(q)) for q in levels])).alias("q"))
    normed = F.col(raw_loc) + width * standard_t(F.col("q"), freedom)
    return each.withColumn(
        "value", normed * F.greatest(F.col(scale), F.lit(SCALE_FLOOR)) + F.col(location)
    )
