"""Interval estimators as native Column expressions.

Wilson score interval for one proportion and Newcombe's hybrid score interval
(method 10) for a difference of two independent proportions. They are built
from ``sqrt``/``greatest``/``least`` so they run in codegen, once per row of an
already-aggregated table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trialguard.functions.parsing import col
from trialguard.terminology import Z95


def _d(c) -> Column:
    return (F.lit(c) if isinstance(c, (int, float)) else col(c)).cast("double")


def wilson(x, n, z: float = Z95) -> tuple[Column, Column]:
    """(lower, upper) of the Wilson score interval; NULL when n <= 0; error when x is outside 0..n."""
    x, n = _d(x), _d(n)
    zz = F.lit(z * z)
    p = x / n
    denom = F.lit(1.0) + zz / n
    centre = (p + zz / (F.lit(2.0) * n)) / denom
    half = F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / n + zz / (F.lit(4.0) * n * n)) / denom
    valid = n > 0
    bad = valid & ((x < 0) | (x > n))
    guard = F.raise_error(F.lit("x must be between 0 and n"))
    lower = F.when(bad, guard).when(valid, F.greatest(F.lit(0.0), centre - half))
    upper = F.when(bad, guard).when(valid, F.least(F.lit(1.0), centre + half))
    return lower, upper


def newcombe_diff(x1, n1, x2, n2, z: float = Z95) -> tuple[Column, Column, Column]:
    """(diff, lower, upper) of p1 - p2 with Newcombe's hybrid score CI; NULL when n1 or n2 <= 0."""
    x1, n1, x2, n2 = _d(x1), _d(n1), _d(x2), _d(n2)
    p1, p2 = x1 / n1, x2 / n2
    l1, u1 = wilson(x1, n1, z)
    l2, u2 = wilson(x2, n2, z)
    d = p1 - p2
    valid = (n1 > 0) & (n2 > 0)
    lower = d - F.sqrt(F.pow(p1 - l1, 2) + F.pow(u2 - p2, 2))
    upper = d + F.sqrt(F.pow(u1 - p1, 2) + F.pow(p2 - l2, 2))
    return (
        F.when(valid, d),
        F.when(valid, F.greatest(F.lit(-1.0), lower)),
        F.when(valid, F.least(F.lit(1.0), upper)),
    )
