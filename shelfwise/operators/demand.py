"""Demand target per key: capped EWMA of daily demand and its variability.

Two plans compute the same numbers:

- ``demand_target`` (dense): every key gets one row per window day (zero on
  days without sales), the days are collected in date order and reduced.
  This is the literal definition and the test reference.
- ``demand_target_sparse``: only days with sales are aggregated (sales are
  pre-aggregated per (key, date) with a map-side combine, so a hot key
  costs one row per day after the first stage).  Missing days are zeros,
  handled in closed form: they add nothing to sums and to the EWMA
  numerator, and the padded sorted series for the quantile is built from
  at most 28 values.  No calendar expansion and no join with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.semantics import fill_defaults, in_range, round_even
from shelfwise.functions.series import array_mean, ewma_last, linear_quantile
from shelfwise.params import Day
from shelfwise.schema import KEY
from shelfwise.sources.tables import Tables

DEMAND_COLUMNS = ["n_days", "p90_win", "avg_qty_ewma", "s2_cap", "buf_target_toc", "buf_target_norm"]


def daily_sales(t: Tables, day: Day, keys: DataFrame, lo, hi, hi_inclusive=False,
                nonzero=False) -> DataFrame:
    """Orders per (key, date) in a date window, restricted to a key list."""
    s = t.sales.filter(in_range(F.col("date"), lo, hi, hi_inclusive))
    if nonzero:
        s = s.filter(F.col("quantity_orders") != 0)
    return (s.join(keys, KEY, "left_semi")
            .groupBy("date", *KEY)
            .agg(F.sum("quantity_orders").alias("quantity_orders"),
                 F.sum("orders_sum").alias("orders_sum"),
                 F.sum("cost_value_orders").alias("cost_value_orders")))


def calendar_demand(t: Tables, day: Day, keys: DataFrame) -> DataFrame:
    """Dense daily demand: keys x window days, zero where nothing was sold.

    A key's sold days are joined as one map of at most window_days entries, so the calendar's days are not moved.
    """
    sold = (daily_sales(t, day, keys, day.window_start, day.window_end, hi_inclusive=True)
            .groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("date", "quantity_orders"))).alias("by_day")))
    return (keys.select(*KEY).join(sold, KEY, "left")
            .select(F.explode(F.sequence(F.lit(day.window_start), F.lit(day.window_end))).alias("date"), *KEY, "by_day")
            .select("date", *KEY,
                    F.coalesce(F.try_element_at("by_day", F.col("date")), F.lit(0)).cast("double").alias("qty")))


def _targets(df: DataFrame, day: Day) -> DataFrame:
    p = day.p
    ewma, s2 = F.col("avg_qty_ewma"), F.col("s2_cap")
    sigma_h = F.sqrt(F.greatest(F.lit(0.0), s2) * F.lit(float(p.rt_days)))
    base = ewma * F.lit(float(p.rt_days)) + F.lit(p.z) * sigma_h
    return df.withColumns({
        "buf_target_toc": round_even(base * F.lit(p.b_mult) + ewma * F.lit(float(p.b_extra_days))),
        "buf_target_norm": round_even(F.lit(float(p.rt_days * p.m_rt)) * ewma),
    })


def demand_target(t: Tables, day: Day, keys: DataFrame) -> DataFrame:
    """Dense plan of the demand target (reference definition)."""
    p = day.p
    per_key = (calendar_demand(t, day, keys)
               .groupBy(*KEY)
               .agg(F.array_sort(F.collect_list(F.struct("date", "qty"))).alias("pairs")))
    arr = F.transform(F.col("pairs"), lambda x: x["qty"])
    n = F.size(F.col("arr"))
    out = (per_key.select(*KEY, arr.alias("arr"))
           .withColumn("n_days", n.cast("bigint"))
           .withColumn("p90_win", linear_quantile(F.array_sort("arr"), F.col("n_days"), p.cap_q))
           .withColumn("cap", F.transform("arr", lambda v: F.least(v, F.col("p90_win"))))
           .withColumn("avg_qty_ewma", ewma_last(F.col("cap"), F.col("n_days"), p.alpha))
           .withColumn("m_cap", array_mean(F.col("cap"), F.col("n_days")))
           .withColumn("s2_cap", array_mean(F.transform("cap", lambda v: v * v), F.col("n_days"))
                       - F.col("m_cap") * F.col("m_cap")))
    return _targets(out, day).select(*KEY, *DEMAND_COLUMNS)


def demand_target_sparse(t: Tables, day: Day, keys: DataFrame) -> DataFrame:
    """Sparse plan: same result from the days with sales only."""
    n = day.p.window_days
    sold = (daily_sales(t, day, keys, day.window_start, day.window_end, hi_inclusive=True)
            .select(*KEY, F.datediff(F.lit(day.window_end), F.col("date")).alias("age"),
                    F.col("quantity_orders").cast("double").alias("qty")))
    obs = sold.groupBy(*KEY).agg(F.collect_list(F.struct("age", "qty")).alias("obs"))
    out = targets_from_observations(obs, day).select(*KEY, *DEMAND_COLUMNS)
    # keys without a single sale in the window: all-zero series
    return fill_defaults(keys.select(*KEY).join(out, KEY, "left"),
                         {"n_days": F.lit(n).cast("bigint"), "p90_win": 0.0, "avg_qty_ewma": 0.0, "s2_cap": 0.0,
                          "buf_target_toc": 0.0, "buf_target_norm": 0.0})


def targets_from_observations(df: DataFrame, day: Day) -> DataFrame:
    """``df`` with the demand columns, from its array ``obs`` of (age, qty) of the window's days with sales."""
    p = day.p
    n = p.window_days
    decay = 1.0 - p.alpha
    m = F.size("obs")
    padded = F.array_sort(F.concat(F.transform("obs", lambda x: x["qty"]),
                                   F.array_repeat(F.lit(0.0), F.lit(n) - m)))
    p90 = F.col("p90_win")
    zero_cap = F.least(F.lit(0.0), p90)
    w_total = (1.0 - decay ** n) / p.alpha          # sum of decay^age over all n days

    def total(f):
        return F.aggregate("obs", F.lit(0.0), lambda acc, x: acc + f(x))

    cap = lambda x: F.least(x["qty"], p90)
    w = lambda x: F.pow(F.lit(decay), x["age"].cast("double"))
    ewma_num = total(lambda x: cap(x) * w(x)) + zero_cap * (F.lit(w_total) - total(w))
    sum_cap = total(cap) + zero_cap * (F.lit(n) - m)
    sum_cap2 = total(lambda x: cap(x) * cap(x)) + zero_cap * zero_cap * (F.lit(n) - m)
    out = (df.withColumn("p90_win", linear_quantile(padded, F.lit(n), p.cap_q))
           .withColumn("avg_qty_ewma", ewma_num * F.lit(p.alpha) / F.lit(1.0 - decay ** n))
           .withColumn("m_cap", sum_cap / F.lit(float(n)))
           .withColumn("s2_cap", sum_cap2 / F.lit(float(n)) - F.col("m_cap") * F.col("m_cap"))
           .withColumn("n_days", F.lit(n).cast("bigint")))
    return _targets(out, day)
