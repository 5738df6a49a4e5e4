"""Stock history as runs of equal days, and what follows from their lengths (S2, A10, A12, T9).

A run is a maximal stretch of consecutive days on which an item has the same
free stock in a cluster.  A stock that stands still for a year is one row, not
365, and peaks, out-of-stock days and their counts come from the runs; single
days are made only where they are asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.semantics import safe_div
from shelfwise.operators.history import stocks_by_cluster
from shelfwise.params import Day
from shelfwise.schema import KEY
from shelfwise.sources.tables import Tables


def runs_of(days: DataFrame, value: str = "quantity_stocks") -> DataFrame:
    """KEY, value, first_day, last_day of each run; ``days`` has one row per (date, key).

    Days less their number among the key's days of one value are the same for the days of a run, so one
    ordering by (key, value) serves the numbering and the grouping.
    """
    nth = F.row_number().over(Window.partitionBy(*KEY, value).orderBy("date"))
    return (days.withColumn("__run", F.date_sub("date", nth)).groupBy(*KEY, value, "__run")
            .agg(F.min("date").alias("first_day"), F.max("date").alias("last_day")).drop("__run"))


def stock_runs(t: Tables, day: Day, keys: DataFrame | None = None) -> DataFrame:
    """Runs of free stock over [D-PERIOD, D], per key with the stock's cluster as destination."""
    days = stocks_by_cluster(t, day, day.history_start, day.d, keys=keys).withColumnRenamed("cluster", "cluster_to")
    return runs_of(days.select("date", *KEY, "quantity_stocks"))


def peaks(runs: DataFrame, day: Day) -> DataFrame:
    """The peak stock before D of each key that had stock before D."""
    return runs.filter(F.col("first_day") < F.lit(day.d)).groupBy(*KEY).agg(F.max("quantity_stocks").alias("max_qs"))


def oos_intervals(runs: DataFrame, day: Day) -> DataFrame:
    """KEY, max_qs, quantity_stocks, first_day, last_day of the stretches of [D-PERIOD, D) on which a key is out of
    stock: the days between its runs, and runs at or below the out-of-stock share of its peak."""
    start, end = F.lit(day.history_start), F.lit(day.prev)
    by_key = Window.partitionBy(*KEY)
    c = (runs.filter((F.col("first_day") < F.lit(day.d)) & (F.col("last_day") >= start))
         .withColumns({"first_day": F.greatest("first_day", start), "last_day": F.least("last_day", end),
                       "max_qs": F.max("quantity_stocks").over(by_key)}))
    ordered = by_key.orderBy("first_day")
    before = F.coalesce(F.lag("last_day").over(ordered), F.date_sub(start, 1))
    last = F.lead("first_day").over(ordered).isNull()
    qs = F.col("quantity_stocks")
    low = (qs <= 0) | F.coalesce(safe_div(qs, F.col("max_qs")) <= day.p.oos_ratio, F.lit(False))
    none = F.lit(0).cast("bigint")
    stretch = lambda when, a, b, q: F.when(when & (a <= b), F.struct(a.alias("first_day"), b.alias("last_day"), q.alias("quantity_stocks")))
    every = F.array(stretch(F.lit(True), F.date_add("__before", 1), F.date_sub("first_day", 1), none),
                    stretch(low, F.col("first_day"), F.col("last_day"), qs),
                    stretch(F.col("__last"), F.date_add("last_day", 1), end, none))
    return (c.withColumns({"__before": before, "__last": last})
            .select(*KEY, "max_qs", F.explode(F.filter(every, lambda x: x.isNotNull())).alias("x"))
            .select(*KEY, "max_qs", "x.quantity_stocks", "x.first_day", "x.last_day"))


def oos_counts(intervals: DataFrame) -> DataFrame:
    """Out-of-stock days of each key that has some, without making them."""
    return intervals.groupBy(*KEY).agg(F.sum(F.datediff("last_day", "first_day") + 1).alias("days_oos_number"))


def oos_days(intervals: DataFrame, day: Day) -> DataFrame:
    """One row per out-of-stock day."""
    return intervals.select(F.explode(F.sequence("first_day", "last_day")).alias("date"), *KEY,
                            F.lit(day.p.oos_label).alias("out_of_stocks"), "quantity_stocks", "max_qs")
