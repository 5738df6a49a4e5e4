"""Stock and order history over the PERIOD window, per key and day.

Used by the first-init of new keys (destination stock, with price anomalies)
and, with the report variants, by the planning report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.semantics import in_range, safe_div
from shelfwise.params import Day
from shelfwise.schema import KEY
from shelfwise.sources.tables import Tables


def cluster_map(t: Tables) -> DataFrame:
    """(mp, warehouse_name) -> cluster; a reference dimension (distinct first)."""
    return t.warehouses.select("mp", "warehouse_name", "cluster").distinct()


def stocks_by_cluster(t: Tables, day: Day, lo, hi, report: bool = False, keys: DataFrame | None = None) -> DataFrame:
    """Marketplace stock per (date, key-with-cluster) in [lo, hi].

    Init variant: positive free stock.  Report variant: positive total
    quantity, YM listings pooled under an empty sku, discounted Ozon skus
    removed (anti join).  Output column ``cluster`` is the warehouse's cluster
    ('' when the warehouse is unknown).  ``keys`` restricts the rows before they
    are aggregated.
    """
    p = day.p
    s = (t.days("stocks", lo, hi).filter(in_range(F.col("date"), lo, hi, hi_inclusive=True))
         .filter(F.col("mp").isin(*p.marketplaces) & (F.col("code_1c") != "")))
    if report:
        s = s.filter(F.col("quantity") > 0)
        discounted = (t.article_mp.filter((F.col("mp") == "Ozon") & (F.col("discounted") == 1))
                      .select("sku").distinct())
        s = (s.join(discounted, "sku", "left_anti")
             .withColumn("sku", F.when(F.col("mp") == "YM", F.lit("")).otherwise(F.col("sku"))))
    else:
        s = s.filter(F.col("quantityFree") > 0)
    # a list of warehouses is small: broadcast, it moves none of the stock's days, which stay grouped as they are made
    s = s.join(F.broadcast(cluster_map(t)), ["mp", "warehouse_name"], "left").fillna({"cluster": ""})
    if keys is not None:
        own = keys.select(*KEY).withColumnRenamed("cluster_to", "cluster")
        s = s.join(own, [c if c != "cluster_to" else "cluster" for c in KEY], "left_semi")
    return (s.groupBy("date", "mp", "seller", "sku", "article_1c", "code_1c", "cluster")
            .agg(F.sum("quantityFree").alias("quantity_stocks"),
                 F.sum("quantityFull").alias("quantity_stocks_full")))


def central_stock(t: Tables, day: Day, lo, hi, report: bool = False) -> DataFrame:
    """Central-warehouse stock per (date, article, code) in [lo, hi]."""
    p = day.p
    qty = "quantity" if report else "quantityFree"
    return (t.days("stocks", lo, hi).filter(in_range(F.col("date"), lo, hi, hi_inclusive=True))
            .filter(F.col("warehouse_name").isin(*p.central_warehouses) & (F.col("mp") == p.central_mp)
                    & (F.col(qty) > 0) & (F.col("code_1c") != ""))
            .groupBy("date", "article_1c", "code_1c")
            .agg(F.sum("quantityFree").alias("quantity_stocks_main"),
                 F.sum("quantityFull").alias("quantity_stocks_main_full")))


def key_calendar(keys: DataFrame, day: Day) -> DataFrame:
    """Keys x days of [D-PERIOD, D) with age dfe (1 = yesterday) and quintile weight.

    A generator per key (explode of a date sequence), not a join.
    """
    per = day.p.period
    q = per // 5
    dfe = F.datediff(F.lit(day.d), F.col("date"))
    w = (F.when(dfe <= q, 5).when(dfe <= 2 * q, 4).when(dfe <= 3 * q, 3)
         .when(dfe <= 4 * q, 2).otherwise(1))
    return (keys.select(*KEY, F.explode(F.sequence(F.lit(day.history_start), F.lit(day.prev))).alias("date"))
            .withColumn("dfe", dfe).withColumn("w", w))


def peak_stock(stock_days: DataFrame) -> DataFrame:
    return stock_days.groupBy(*KEY).agg(F.max("quantity_stocks").alias("max_qs"))


FACTS = ["quantity_stocks", "quantity_orders", "orders_sum", "cost_value_orders"]


def history_by_key(facts: DataFrame, day: Day) -> DataFrame:
    """One row per key with its days as a map: date -> FACTS, the peak stock before D and the median unit price.

    ``facts`` has at most one row per (date, key); NULL is a fact the day does not
    have.  A key has at most one entry per day of the window, so maps are small.
    """
    price = safe_div(F.col("orders_sum"), F.col("quantity_orders"))
    return facts.groupBy(*KEY).agg(
        F.max(F.when(F.col("date") < F.lit(day.d), F.col("quantity_stocks"))).alias("max_qs"),
        F.median(price).alias("median_price"),
        F.map_from_entries(F.collect_list(F.struct("date", F.struct(*FACTS)))).alias("by_day"))


def flag_days(by_key: DataFrame, day: Day, peak_default_one: bool = False) -> DataFrame:
    """Keys x days of [D-PERIOD, D) with stock, orders, out-of-stock and price flags.

    The days come from the key's own map, so there is no join with a calendar.
    Missing stock / orders are 0 (type defaults of the source joins).  Out of
    stock: stock <= 0, or stock / peak <= OOS_RATIO (peak 0 -> no ratio; the
    report variant divides by ifnull(peak, 1)).  Price: unit price / median - 1
    against the thresholds; days without orders have no price and no flag.
    """
    p = day.p
    every = F.transform(F.sequence(F.lit(day.history_start), F.lit(day.prev)),
                        lambda d: F.struct(d.alias("date"), F.try_element_at(F.col("by_day"), d).alias("f")))
    df = (by_key.select(*KEY, "max_qs", "median_price", F.explode(every).alias("x"))
          .select("x.date", *KEY, "max_qs", "median_price", *[F.col(f"x.f.{c}").alias(c) for c in FACTS])
          .fillna({"quantity_stocks": 0, "quantity_orders": 0, "orders_sum": 0.0, "cost_value_orders": 0.0}))
    qs = F.col("quantity_stocks")
    ratio = safe_div(qs, F.coalesce(F.col("max_qs"), F.lit(1 if peak_default_one else 0)))
    oos = (qs <= 0) | F.coalesce(ratio <= p.oos_ratio, F.lit(False))
    price = safe_div(F.col("orders_sum"), F.col("quantity_orders"))
    rate = safe_div(price, F.col("median_price")) - F.lit(1.0)
    bad = (F.when(rate <= p.bad_price_low, F.lit(p.low_price_label))
           .when(rate >= p.bad_price_high, F.lit(p.high_price_label)).otherwise(F.lit("")))
    return (df.withColumn("out_of_stocks", F.when(oos, F.lit(p.oos_label)).otherwise(F.lit("")))
            .withColumn("avg_price_per_day", price)
            .withColumn("rate", rate)
            .withColumn("bad_price", bad))
