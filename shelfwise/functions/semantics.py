"""Semantics the model depends on, pinned as Spark expressions.

The source queries were written for a SQL dialect whose LEFT JOIN fills
missing non-nullable columns with the type default (0, '' ...) instead of
NULL, whose float division by zero yields NaN/inf, and whose float ROUND is
half-to-even.  Spark differs on all three, so every place that relies on
them goes through a helper here:

- ``fill_defaults``: coalesce to type defaults after a left join.
- ``safe_div``: NULL instead of NaN/inf/error; NULL is skipped by median and
  compares false, which is what NaN did in the source.
- ``round_even``: ``bround`` (2.5 -> 2), never ``round``.
- ``capped_ratio``: round(least(ifnull(a / nullif(b, 0), 1), 1), 2).
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs produced by an outer join with the column's default."""
    return df.withColumns({c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v))
                           for c, v in defaults.items()})


def safe_div(num: Column, den: Column) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def round_even(c: Column, scale: int = 0) -> Column:
    """Half-to-even rounding of a float the way the source dialect does it:
    scale the double, round half-to-even, scale back (so 1.005 -> 1.0,
    because 1.005 * 100 is 100.49999999999999)."""
    if scale == 0:
        return F.bround(c, 0)
    f = float(10 ** scale)
    return F.bround(c * F.lit(f), 0) / F.lit(f)


def capped_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """round(least(ifnull(num / nullif(den, 0), 1), 1), scale).

    Coalescing before ``least`` matters: Spark's least skips NULLs.
    """
    return round_even(F.least(F.coalesce(safe_div(num, den), F.lit(1.0)), F.lit(1.0)), scale)


def in_range(c: Column, lo, hi, hi_inclusive: bool = False) -> Column:
    """lo <= c < hi (or <= hi): the half-open / closed date windows."""
    upper = c <= F.lit(hi) if hi_inclusive else c < F.lit(hi)
    return (c >= F.lit(lo)) & upper


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small intermediate that several branches read.

    Written under spark.checkpoint.dir (the shared folder the cluster names),
    so a lost executor does not force recomputing the scans behind it.  The
    shuffle files behind it go when it is written: what follows reads it alone.
    """
    from shelfwise.session import ensure_checkpoint_dir, shuffles_freed
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)     # select: planned anew, so that the setting holds for it
