"""Small per-key series statistics on bounded arrays (at most one value per day).

The arrays are built by an aggregation over a fixed date window (28 or 30
days), so they never grow with the data volume.  Everything here is a
higher-order function evaluated in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def linear_quantile(sorted_arr: Column, n: Column, q: float) -> Column:
    """Quantile with linear interpolation at position (n-1)*q of an ascending array."""
    kk = (n - F.lit(1)).cast("double") * F.lit(q)
    f, c = F.floor(kk), F.ceil(kk)
    frac = kk - f
    lo = F.element_at(sorted_arr, (f + 1).cast("int"))
    hi = F.element_at(sorted_arr, (c + 1).cast("int"))
    return (F.when(n == 0, F.lit(0.0))
            .when(f == c, lo)
            .otherwise(lo * (F.lit(1.0) - frac) + hi * frac))


def exact_quantile(sorted_arr: Column, n: Column, q: float) -> Column:
    """Element at 0-based floor(q*n) of an ascending array (no interpolation)."""
    idx = F.least(F.floor(n.cast("double") * F.lit(q)), n - 1)
    return F.element_at(sorted_arr, (idx + 1).cast("int"))


def ewma_last(arr: Column, n: Column, alpha: float) -> Column:
    """Normalised EWMA at the end of a chronological array.

    sum_i arr[i] * (1-alpha)^(n-1-i) * alpha / (1 - (1-alpha)^n)
    """
    decay = 1.0 - alpha
    weighted = F.transform(arr, lambda v, i: v * F.pow(F.lit(decay), (n - 1 - i).cast("double")))
    num = F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x)
    norm = F.lit(1.0) - F.pow(F.lit(decay), n.cast("double"))
    return F.when(n == 0, F.lit(0.0)).otherwise(num * F.lit(alpha) / F.nullif(norm, F.lit(0.0)))


def array_mean(arr: Column, n: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x) / n.cast("double")
