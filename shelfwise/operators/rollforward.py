"""Roll the state of existing keys forward to day D (routes simulate_day and recalc_day).

One function serves both routes; they differ only in the buffer rule and the
change counter:

- simulate_day: buffer unchanged, counter + 1
- recalc_day:   buffer x (1 + UP_STEP) or x (1 - DOWN_STEP), half-even rounded;
                a DOWN below the key's min_buffer keeps the old buffer; counter 0

stock(D) = max(0, stock(D-1) - orders(D-1) + arrivals(D)); orders(D) count only
when stock(D) > 0.  Keys need a state row on D-1 (inner join), as in the model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.semantics import capped_ratio, fill_defaults, round_even
from shelfwise.operators.init_buffer import article_names, route_keys
from shelfwise.operators.keys import state_on, supply_windows
from shelfwise.params import Day
from shelfwise.schema import BUFFER_MAIN_COLUMNS, KEY
from shelfwise.sources.tables import Tables

ROUTES = ("simulate_day", "recalc_day")

CARRIED = ["total_quantity_orders", "max_quantity_order", "avg_quantity_orders", "days_oos_number",
           "days_bp_number", "avg_day_to_cluster", "insurance_reserv_cluster", "buffer_cluster_norm"]

SERVICE_COLUMNS = ["deliveries_to_cluster", "buffer_cluster_marker_current", "buffer_cluster_marker"]


def service_markers(bt: F.Column, stock: F.Column, in_transit: F.Column, within_rt: F.Column):
    """Need and the two coverage markers of a state row (T15)."""
    return [
        F.greatest(F.lit(0.0), round_even(bt - stock - in_transit)).cast("bigint").alias("deliveries_to_cluster"),
        capped_ratio(stock + within_rt, bt).alias("buffer_cluster_marker_current"),
        capped_ratio(stock + in_transit, bt).alias("buffer_cluster_marker"),
    ]


def roll_forward(t: Tables, day: Day, calc_keys: DataFrame, routes=ROUTES) -> DataFrame:
    """State rows of day D for the routed existing keys; keeps ``calc_type``."""
    p = day.p
    # the key list may hold every key there is: it is moved once, by KEY, which serves the distinct rows and the join
    rk = (route_keys(calc_keys, day, *routes)
          .select(*KEY, "calc_type", "action_suggested", "min_buffer").repartition(*KEY).distinct())
    prev = (state_on(t, day, day.prev)
            .select(*KEY, *CARRIED, "buffer_cluster", "quantity_stocks", "quantity_orders", "new_buffer")
            .join(rk, KEY, "inner"))
    # open shipments and the day's orders are fewer than the keys: a join with the list would only move it again
    sup = supply_windows(t, day)
    orders_d = (t.sales.filter(F.col("date") == F.lit(day.d))
                .groupBy(*KEY).agg(F.sum("quantity_orders").alias("orders_d")))
    df = fill_defaults(prev.join(sup, KEY, "left").join(orders_d, KEY, "left"),
                       {"quantity_supplies_arrive": 0, "quantity_supplies": 0,
                        "quantity_supplies_within_rt": 0, "orders_d": 0})
    recalc = F.col("calc_type") == "recalc_day"
    act, bt_prev = F.col("action_suggested"), F.col("buffer_cluster")
    factor = (F.when(act == "UP", F.lit(1.0 + p.up_step))
              .when(act == "DOWN", F.lit(1.0 - p.down_step)).otherwise(F.lit(1.0)))
    cand = round_even(bt_prev.cast("double") * factor).cast("bigint")
    rebased = F.when((act == "DOWN") & (cand < F.coalesce(F.col("min_buffer"), F.lit(1))), bt_prev).otherwise(cand)
    bt = F.when(recalc, rebased).otherwise(bt_prev)
    stock = F.greatest(F.lit(0).cast("bigint"),
                       F.col("quantity_stocks") - F.col("quantity_orders") + F.col("quantity_supplies_arrive"))
    df = (df.withColumn("bt_new", bt.cast("bigint")).withColumn("stock_new", stock)
          .join(article_names(t, day), ["article_1c", "code_1c"], "left").fillna({"name": ""}))
    b, s = F.col("bt_new"), F.col("stock_new")
    return df.select(
        F.lit(p.id_ver).alias("id_ver"), F.lit(day.d).alias("date"), "name",
        "article_1c", "code_1c", "mp", "seller", "sku", "cluster_to",
        "total_quantity_orders", "max_quantity_order",
        round_even(F.col("avg_quantity_orders"), 2).alias("avg_quantity_orders"),
        "days_oos_number", "days_bp_number", "avg_day_to_cluster", "insurance_reserv_cluster",
        "buffer_cluster_norm",
        b.alias("buffer_cluster"),
        *service_markers(b, s, F.col("quantity_supplies"), F.col("quantity_supplies_within_rt")),
        F.when(s <= 0, F.lit(0)).otherwise(F.col("orders_d")).cast("bigint").alias("quantity_orders"),
        s.alias("quantity_stocks"),
        F.col("quantity_supplies").cast("bigint").alias("quantity_supplies"),
        F.col("quantity_supplies_within_rt").cast("bigint").alias("quantity_supplies_within_rt"),
        F.when(recalc, F.lit(0)).otherwise(F.col("new_buffer") + 1).cast("bigint").alias("new_buffer"),
        "calc_type",
    )


def conform(df: DataFrame, schema) -> DataFrame:
    """Cast to the declared schema and add missing columns as NULL (S11)."""
    cols = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def buffer_main_day(t: Tables, day: Day, calc_keys: DataFrame) -> DataFrame:
    """All state rows of day D: first init, roll-forward and rebase (U3), one write."""
    from shelfwise.operators.init_buffer import first_init
    from shelfwise.schema import BUFFER_MAIN
    rolled = roll_forward(t, day, calc_keys).select(*BUFFER_MAIN_COLUMNS)
    return conform(first_init(t, day, calc_keys).unionByName(rolled), BUFFER_MAIN)
