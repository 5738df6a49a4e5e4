"""Key sets, key history, previous-day state and supply windows.

All state reads filter on ``id_ver`` and ``date`` first: with the state
tables partitioned by those columns the filters become partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.semantics import in_range
from shelfwise.params import Day
from shelfwise.schema import KEY
from shelfwise.sources.tables import Tables


def state_rows(t: Tables, day: Day, lo=None, hi=None) -> DataFrame:
    """State of the version; lo and hi tell which days the caller's filter leaves."""
    return t.days("buffer_main", lo, hi).filter(F.col("id_ver") == day.p.id_ver)


def state_on(t: Tables, day: Day, date) -> DataFrame:
    """One state snapshot: main(id_ver, date)."""
    return state_rows(t, day, date, date).filter(F.col("date") == F.lit(date))


def valid_articles(t: Tables, day: Day) -> DataFrame:
    """Articles allowed into the model: not discounted, not resale, known marketplace."""
    p = day.p
    return (t.article_mp
            .filter((F.col("discounted") != 1) & (F.col("brand") != p.resale_brand)
                    & F.col("mp").isin(*p.marketplaces))
            .select("article_1c", "code_1c", "sku", "mp").distinct())


def keys_today(t: Tables, day: Day) -> DataFrame:
    """Keys sold in [D-PERIOD, D) plus keys that have state on D-1 (UNION DISTINCT)."""
    sold = (t.sales.filter(in_range(F.col("date"), day.history_start, day.d))
            .select(*KEY).distinct())
    held = state_on(t, day, day.prev).select(*KEY).distinct()
    return sold.unionByName(held).distinct()


def candidate_keys(t: Tables, day: Day) -> DataFrame:
    """Keys of the day restricted to valid articles.

    The article list is a small dimension (distinct rows of the article
    master), so the semi join is planned as a broadcast when it fits the
    broadcast threshold and as a shuffle join otherwise.
    """
    return keys_today(t, day).join(valid_articles(t, day), ["article_1c", "code_1c", "sku", "mp"],
                                   "left_semi")


def key_history(t: Tables, day: Day, keys: DataFrame | None = None) -> DataFrame:
    """Rows of state per key before D (only its existence is used downstream)."""
    if t.key_registry is not None:
        return registered_keys(t, day, keys)
    # aggregated first: a task sends a key's rows as one count, not its days
    hist = (state_rows(t, day, hi=day.prev).filter(F.col("date") < F.lit(day.d))
            .groupBy(*KEY).agg(F.count(F.lit(1)).alias("cnt_hist")))
    return hist if keys is None else hist.join(keys, KEY, "left_semi")


def prev_state(t: Tables, day: Day, keys: DataFrame | None = None) -> DataFrame:
    """Previous-day state per key: max of counter, buffer and stock."""
    prev = state_on(t, day, day.prev)
    if keys is not None:
        prev = prev.join(keys, KEY, "left_semi")
    return prev.groupBy(*KEY).agg(
        F.max(F.col("new_buffer").cast("short")).cast("bigint").alias("new_buffer_prev"),
        F.max("buffer_cluster").alias("bt_prev"),
        F.max("quantity_stocks").alias("stocks_prev"),
    )


def supply_windows(t: Tables, day: Day, keys: DataFrame | None = None) -> DataFrame:
    """The three supply windows of day D in one pass over the shipments.

    arrive today:   closing = D and shipping <= D
    in transit:     shipping < D < closing
    within lead time: D < closing <= D + RT, shipped before D (the bound on
                    shipping keeps a re-run of D from counting D's own shipments)
    """
    p = day.p
    s = t.buffer_supplies.filter(F.col("id_ver").cast("int") == p.id_ver)
    ship, close, q = F.col("shipping_date"), F.col("closing_date"), F.col("quantity_supplies")
    d = F.lit(day.d)
    arrive = (close == d) & (ship <= d)
    transit = (ship < d) & (close > d)
    within = (close > d) & (close <= F.lit(day.rt_end)) & (ship < d)
    s = s.filter((close >= d) & (arrive | transit | within))      # all three windows: only open shipments are read
    if keys is not None:
        s = s.join(keys, KEY, "left_semi")
    zero = F.lit(0).cast("bigint")
    return s.groupBy(*KEY).agg(
        F.sum(F.when(arrive, q).otherwise(zero)).cast("bigint").alias("quantity_supplies_arrive"),
        F.sum(F.when(transit, q).otherwise(zero)).cast("bigint").alias("quantity_supplies"),
        F.sum(F.when(within, q).otherwise(zero)).cast("bigint").alias("quantity_supplies_within_rt"),
    )


def lane_in_transit(t: Tables, day: Day) -> DataFrame:
    """In-transit supplies by (mp, seller, article, code, cluster_to): no sku.

    The first-init step joins this on the coarser key, so every sku of the
    article sees the same in-transit quantity.
    """
    d = F.lit(day.d)
    return (t.buffer_supplies
            .filter((F.col("id_ver").cast("int") == day.p.id_ver)
                    & (F.col("shipping_date") < d) & (F.col("closing_date") > d))
            .groupBy("mp", "seller", "article_1c", "code_1c", "cluster_to")
            .agg(F.sum("quantity_supplies").cast("bigint").alias("quantity_supplies")))


def registered_keys(t: Tables, day: Day, keys: DataFrame | None = None) -> DataFrame:
    """Key history from the registry: one row per key whose state began before D.

    Reads one row per key instead of the whole state history; ``cnt_hist`` is 1
    (the decision only tests it against 0).
    """
    reg = t.key_registry.filter((F.col("id_ver") == day.p.id_ver) & (F.col("first_date") < F.lit(day.d)))
    if keys is not None:
        reg = reg.join(keys, KEY, "left_semi")
    return reg.select(*KEY).distinct().withColumn("cnt_hist", F.lit(1).cast("bigint"))


def new_registry_rows(calc_keys: DataFrame, day: Day, main_d: DataFrame) -> DataFrame:
    """Keys with state on D that had none before: those of the first-init route, which the decision chose by that."""
    first = (calc_keys.filter((F.col("date") == F.lit(day.d)) & (F.col("id_ver") == day.p.id_ver) & (F.col("calc_type") == "first_init"))
             .select(*KEY))
    return (main_d.join(first, KEY, "left_semi").select(*KEY).distinct()
            .select(F.lit(day.p.id_ver).alias("id_ver"), *KEY, F.lit(day.d).alias("first_date")))


def registry_from_history(state: DataFrame) -> DataFrame:
    """Initial registry: first state date per (id_ver, key) (map-side min)."""
    return state.groupBy("id_ver", *KEY).agg(F.min("date").alias("first_date"))
