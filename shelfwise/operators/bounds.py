"""State in a window of each key's own length (J3 with per-row bounds).

Where the lead time is a column, every key has its own [lo, hi].  The range is
turned into an equality: bounds are spread over the fixed bins of ``BIN`` days
that they touch (window / BIN + 1 rows a key), state rows have one bin each, and
the join is on (KEY, bin) with the exact range after it.  Keys whose windows
touch other bins never meet, and no nested loop is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.keys import state_rows
from shelfwise.operators.ring import ORIGIN, state_of_days
from shelfwise.operators.zones import zone_of
from shelfwise.params import Day
from shelfwise.schema import KEY, LANE
from shelfwise.sources.tables import Tables

BIN = 14


def bin_of(date: Column, width: int = BIN) -> Column:
    return F.floor(F.datediff(date, F.lit(ORIGIN)) / F.lit(width)).cast("int")


def within_bounds(rows: DataFrame, bounds: DataFrame, width: int = BIN) -> DataFrame:
    """Rows (KEY, date, ...) whose date lies in their key's [lo, hi]; ``bounds`` (KEY, lo, hi, ...) has one row a key."""
    spread = bounds.filter("lo <= hi").withColumn("__bin", F.explode(F.sequence(bin_of(F.col("lo"), width), bin_of(F.col("hi"), width))))
    return (rows.withColumn("__bin", bin_of(F.col("date"), width)).join(spread, [*KEY, "__bin"])
            .filter(F.col("date").between(F.col("lo"), F.col("hi"))).drop("__bin"))


def lane_zone_days(t: Tables, day: Day, keys: DataFrame, lead_times: DataFrame) -> DataFrame:
    """Zone days of each key over its own window: lead time of its lane times M_RT, up to D - 1.

    ``lead_times`` has (LANE, rt_days); lanes without one take the model's.
    """
    p = day.p
    rt = F.coalesce("rt_days", F.lit(p.rt_days)).cast("int")
    bounds = (keys.select(*KEY).join(lead_times.select(*LANE, "rt_days"), LANE, "left")
              .select(*KEY, rt.alias("rt_days"), F.date_sub(F.lit(day.d), rt * p.m_rt).alias("lo"), F.lit(day.prev).alias("hi")))
    longest = max(p.rt_days, lead_times.agg(F.max("rt_days").alias("most")).first().most or 0)     # older days are not read
    since = day.minus(longest * p.m_rt)
    rows = state_rows(t, day, since, day.prev).filter(F.col("date").between(F.lit(since), F.lit(day.prev)))
    days = within_bounds(state_of_days(rows), bounds).withColumn("zone", zone_of(F.col("bt"), F.col("stock")))
    zone = F.col("zone")
    return days.groupBy(*KEY, "rt_days").agg(
        F.count(zone).alias("days_observed"), F.count_if(zone == "black").alias("breach_days"), F.count_if(zone == "red").alias("red_days"),
        F.count_if(zone == "yellow").alias("yellow_days"), F.count_if(zone == "green").alias("green_days"))
