"""Upper tail probabilities of Student's t and Fisher's F.

They run on one row per model, after all data has been aggregated.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


# Executors get these functions themselves, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function (DLMF 8.17.22, evaluated from the last term)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_inc(b, a, 1.0 - x)
    tail = 1.0
    for m in range(int(100 + 5 * math.sqrt(max(a, b))), 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1))
        tail = 1.0 + odd / (1.0 + even / tail)
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    return math.exp(log_front) / (a * tail)


def t_tail(t: float, df: float) -> float:
    """P(T > t)."""
    half = 0.5 * beta_inc(df / 2.0, 0.5, df / (df + t * t))
    return half if t >= 0 else 1.0 - half


def f_tail(f: float, df1: float, df2: float) -> float:
    """P(F > f)."""
    return 1.0 if f <= 0 else beta_inc(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * f))


def _rowwise(fn, *cols: pd.Series) -> pd.Series:
    rows = zip(*cols)
    return pd.Series([None if any(pd.isna(v) for v in r) else fn(*r) for r in rows], dtype="float64")


@F.pandas_udf(DoubleType())
def t_upper(t: pd.Series, df: pd.Series) -> pd.Series:
    return _rowwise(t_tail, t, df)


@F.pandas_udf(DoubleType())
def f_upper(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return _rowwise(f_tail, f, df1, df2)
