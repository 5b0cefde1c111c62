"""Tail probabilities and t quantiles for result-sized frames, in Arrow batches.

Spark has no error function or incomplete gamma/beta function, so these few scalars are computed in
pandas UDFs. They are applied to one row per test or per group, never to data rows. The helpers are
nested so that they travel to the workers by value.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _elementwise(f, *columns: Column | str) -> Column:
    def batch(*series: pd.Series) -> pd.Series:
        def one(*values):
            return None if any(v is None or v != v for v in values) else f(*(float(v) for v in values))

        return pd.Series([one(*v) for v in zip(*series)], dtype="float64")

    # The evaluation type is inferred from the annotations, which need a fixed arity.
    if len(columns) == 1:
        def call(a: pd.Series) -> pd.Series:
            return batch(a)
    else:
        def call(a: pd.Series, b: pd.Series) -> pd.Series:
            return batch(a, b)
    return F.pandas_udf(call, DoubleType())(*columns)


def normal_upper_tail(z: Column | str) -> Column:
    """P(Z > z)."""
    return _elementwise(lambda x: 0.5 * math.erfc(x / math.sqrt(2.0)), z)


def chi2_upper_tail(x: Column | str, dof: Column | str) -> Column:
    """P(X > x) for a chi-squared variable, by the series or continued fraction of the incomplete gamma."""

    def tail(x, k):
        a, x = k / 2.0, x / 2.0
        if x <= 0 or a <= 0:
            return 1.0
        scale = math.exp(a * math.log(x) - x - math.lgamma(a))
        if x < a + 1:
            term = total = 1.0 / a
            n = a
            while term > total * 1e-16:
                n += 1
                term *= x / n
                total += term
            return max(0.0, 1.0 - total * scale)
        tiny = 1e-300
        b = x + 1 - a
        c, d = 1 / tiny, 1 / b
        h = d
        for i in range(1, 10000):
            an = -i * (i - a)
            b += 2
            d = 1 / (an * d + b or tiny)
            c = b + an / c or tiny
            h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return scale * h

    return _elementwise(tail, x, dof)


def t_quantile_975(dof: Column | str) -> Column:
    """The 97.5 % quantile of Student's t: bisection on the integral of its density."""

    def quantile(n):
        # With theta = atan(t / sqrt(n)) the density becomes cos(theta)^(n - 1), smooth on a finite range.
        norm = math.exp(math.lgamma((n + 1) / 2) - math.lgamma(n / 2)) / math.sqrt(math.pi)

        def central(theta, steps=400):
            h = theta / steps
            total = 1.0 + math.cos(theta) ** (n - 1)
            for i in range(1, steps):
                total += (4 if i % 2 else 2) * math.cos(i * h) ** (n - 1)
            return norm * total * h / 3

        low, high = 0.0, math.atan(13.0 / math.sqrt(n)) if n >= 1 else math.pi / 2
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if central(mid) < 0.475 else (low, mid)
        return math.sqrt(n) * math.tan(low)

    return _elementwise(lambda n: quantile(n) if n >= 1 else float("nan"), dof)
