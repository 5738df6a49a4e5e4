"""First initialisation of a buffer for keys without history (route first_init).

Per key over [D-PERIOD, D): daily destination stock and orders, out-of-stock
and low-price days, and a capped EWMA of demand over the good days only.
All per-key statistics come from ONE aggregation over the key calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.semantics import capped_ratio, fill_defaults, materialize, round_even
from shelfwise.functions.series import ewma_last, exact_quantile
from shelfwise.operators.demand import daily_sales
from shelfwise.operators.history import FACTS, flag_days, history_by_key, key_calendar, stocks_by_cluster
from shelfwise.operators.keys import lane_in_transit, supply_windows
from shelfwise.params import Day
from shelfwise.schema import BUFFER_MAIN_COLUMNS, KEY
from shelfwise.sources.tables import Tables


def route_keys(calc_keys: DataFrame, day: Day, *routes: str) -> DataFrame:
    return calc_keys.filter((F.col("date") == F.lit(day.d)) & (F.col("id_ver") == day.p.id_ver)
                            & F.col("calc_type").isin(*routes))


def article_names(t: Tables, day: Day) -> DataFrame:
    p = day.p
    return (t.article_mp.filter((F.col("discounted") != 1) & (F.col("brand") != p.resale_brand))
            .select("name", "article_1c", "code_1c").distinct())


class InitHistory:
    """The PERIOD history of the first-init keys (lazy DataFrames)."""

    def __init__(self, t: Tables, day: Day, calc_keys: DataFrame, cut: bool = True):
        self.t, self.day = t, day
        keep = materialize if cut else (lambda df: df)
        # calc keys are already stored (daily job) or checkpointed: no second cut here
        self.keys = route_keys(calc_keys, day, "first_init").select(*KEY).distinct()
        # stock of these keys alone, [D-PERIOD, D]
        self.stocks = (stocks_by_cluster(t, day, day.history_start, day.d, keys=self.keys)
                       .withColumnRenamed("cluster", "cluster_to"))
        self.orders = daily_sales(t, day, self.keys, day.history_start, day.d, hi_inclusive=True, nonzero=True)
        none = {c: F.lit(None).cast(k) for c, k in (("quantity_stocks", "bigint"), ("quantity_orders", "bigint"),
                                                    ("orders_sum", "double"), ("cost_value_orders", "double"))}
        facts = (self.stocks.select("date", *KEY, "quantity_stocks",
                                    *[none[c].alias(c) for c in ("quantity_orders", "orders_sum", "cost_value_orders")])
                 .unionByName(self.orders.select("date", *KEY, none["quantity_stocks"].alias("quantity_stocks"),
                                                 "quantity_orders", "orders_sum", "cost_value_orders")))
        by_day = facts.groupBy("date", *KEY).agg(*[F.sum(c).alias(c) for c in FACTS])
        # keys that had stock before D; their days, peak and median price are read several times, so cut once
        self.every_key = keep(history_by_key(by_day, day))
        self.by_key = self.every_key.filter(F.col("max_qs").isNotNull())

    @property
    def calendar(self) -> DataFrame:
        return key_calendar(self.by_key.select(*KEY), self.day)

    def median_price(self) -> DataFrame:
        return self.every_key.filter(F.col("median_price").isNotNull()).select(*KEY, "median_price")

    def days(self) -> DataFrame:
        """One row per key and day of the window with the day flags."""
        return flag_days(self.by_key, self.day)

    def today(self) -> DataFrame:
        """Stock and orders of D itself."""
        d = F.try_element_at(F.col("by_day"), F.lit(self.day.d))
        return self.by_key.select(*KEY, d["quantity_stocks"].alias("quantity_stocks"), d["quantity_orders"].alias("orders_d"))

    def summary(self) -> DataFrame:
        """Every per-key statistic of the init in one aggregation."""
        p = self.day.p
        d = self.days()
        oos = F.col("out_of_stocks") == p.oos_label
        low = F.col("bad_price") == p.low_price_label
        qty = F.col("quantity_orders")
        good = ~oos & ~low
        agg = d.groupBy(*KEY).agg(
            F.count_if(oos).alias("days_oos_number"),
            F.count_if(low).alias("days_bp_number"),
            F.sum(F.when(low, qty)).alias("bp_quantity_orders"),
            F.count_if(oos | low).alias("exclude_number"),
            F.max(qty).alias("max_quantity_order"),
            F.min(qty).alias("min_quantity_order"),
            F.sum(qty).alias("total_quantity_orders_full"),
            F.stddev_pop(qty).alias("sigma"),
            F.collect_list(F.when(good, F.struct("date", qty.cast("double").alias("q")))).alias("good"),
        )
        return good_day_stats(agg, p).withColumn(
            "avg_quantity_orders_full", F.col("total_quantity_orders_full") / F.lit(float(p.period)))


def good_day_stats(df: DataFrame, p) -> DataFrame:
    """Capped EWMA over the good days, in date order (bounded list: <= PERIOD days)."""
    arr = F.transform(F.array_sort("good"), lambda x: x["q"])
    n = F.size("good").cast("bigint")
    return (df.withColumn("arr", arr).withColumn("n_good", n)
            .withColumn("p90_good", exact_quantile(F.array_sort("arr"), F.col("n_good"), p.cap_q))
            .withColumn("cap", F.transform("arr", lambda v: F.least(v, F.col("p90_good"))))
            .withColumn("avg_quantity_orders", ewma_last(F.col("cap"), F.col("n_good"), p.alpha))
            .withColumn("total_quantity_orders", F.aggregate("arr", F.lit(0.0), lambda a, x: a + x))
            .drop("arr", "cap"))


def first_init(t: Tables, day: Day, calc_keys: DataFrame) -> DataFrame:
    """State rows of day D for the first-init keys (declared buffer_main schema)."""
    p = day.p
    h = InitHistory(t, day, calc_keys)
    s = h.summary().filter(F.col("n_good") > 0)
    within = supply_windows(t, day, h.keys).select(*KEY, "quantity_supplies_within_rt")
    df = (s.join(h.today(), KEY, "left")
          .join(lane_in_transit(t, day), ["mp", "seller", "article_1c", "code_1c", "cluster_to"], "left")
          .join(within, KEY, "left"))
    df = fill_defaults(df, {"quantity_stocks": 0, "quantity_supplies": 0,
                            "quantity_supplies_within_rt": 0, "orders_d": 0})
    lim = p.max_excluded_days
    df = df.filter((F.col("days_oos_number") <= lim) & (F.col("days_bp_number") <= lim)
                   & (F.col("total_quantity_orders") != 0))
    norm = float(p.window_days)
    avg2 = round_even(F.col("avg_quantity_orders"), 2)         # the rounded mean drives the buffer
    need = F.lit(norm) * avg2
    buf = round_even(need).cast("bigint")
    qs, sup = F.col("quantity_stocks"), F.col("quantity_supplies")
    df = (df.withColumn("avg2", avg2).withColumn("buffer_cluster", buf)
          .join(article_names(t, day), ["article_1c", "code_1c"], "left").fillna({"name": ""}))
    return df.select(
        F.lit(p.id_ver).alias("id_ver"), F.lit(day.d).alias("date"), "name",
        "article_1c", "code_1c", "mp", "seller", "sku", "cluster_to",
        F.col("total_quantity_orders").cast("bigint").alias("total_quantity_orders"),
        F.col("max_quantity_order").cast("bigint").alias("max_quantity_order"),
        F.col("avg2").alias("avg_quantity_orders"),
        F.col("days_oos_number").cast("bigint").alias("days_oos_number"),
        F.col("days_bp_number").cast("bigint").alias("days_bp_number"),
        F.lit(p.rt_days).cast("bigint").alias("avg_day_to_cluster"),
        F.lit(p.ins_const).cast("bigint").alias("insurance_reserv_cluster"),
        F.lit(p.window_days).cast("bigint").alias("buffer_cluster_norm"),
        "buffer_cluster",
        F.greatest(F.lit(0.0), round_even(F.lit(norm) * F.col("avg2") - qs - sup)).cast("bigint")
         .alias("deliveries_to_cluster"),
        capped_ratio(qs + F.col("quantity_supplies_within_rt"), F.col("buffer_cluster"))
         .alias("buffer_cluster_marker_current"),
        capped_ratio(qs + sup, F.lit(norm) * F.col("avg2")).alias("buffer_cluster_marker"),
        F.when(qs <= 0, F.lit(0)).otherwise(F.col("orders_d")).cast("bigint").alias("quantity_orders"),
        qs.cast("bigint").alias("quantity_stocks"),
        sup.cast("bigint").alias("quantity_supplies"),
        F.col("quantity_supplies_within_rt").cast("bigint").alias("quantity_supplies_within_rt"),
        F.lit(0).cast("bigint").alias("new_buffer"),
    ).select(*BUFFER_MAIN_COLUMNS)
