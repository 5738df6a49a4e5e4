"""Domain tables derived from the TPC-H-like test data.

The test data has no sales / stock / buffer tables, so they are derived from
``lineitem`` and its dimensions with integer arithmetic only (the same mapping
is written for the DuckDB oracle in ``shelfwise.checks.fixtures_sql``).  Every
lineitem row becomes one sales row.  Stock and state rows exist on the days
around a key's sales (``ACTIVE_BEFORE`` days before to ``ACTIVE_AFTER`` days
after each), over all dates of the test data, so every table grows with the
input and with its history.

Tags per key: a = l_partkey (the article), r = customer region (destination
cluster), m = l_suppkey % 3 (marketplace), s = (l_suppkey div 3) % 2 (seller).
g = a % 4 and a % 50 only steer branches:

- g, r: brands, discounts, sparse histories (r = 4: every other day), keys
  without history (r = 3 and g >= 2);
- a % 50 = 7: the state has a second row for each key and day;
  11: the article has two brands; 13: it is absent from the master;
  17: it has two volumes; 19: its stock lies in a warehouse that the map lacks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.params import DEFAULT_PARAMS, Params
from shelfwise.schema import KEY
from shelfwise.sources.tables import Tables

# --- fixed values: the test mapping ---------------------------------------
AS_OF = dt.date(1998, 7, 1)        # business date D of the tests
EPOCH = dt.date(1992, 1, 1)        # n = days since this date
ACTIVE_BEFORE, ACTIVE_AFTER = 10, 25
TASKS_OF_HISTORY = 16              # times the session's shuffle partitions, where every day is made
LOT_ROWS, MOST_LOTS = 2_000_000, 8   # lineitem rows whose joins are on the disk at once; a share of 1 / MOST_LOTS beyond that
MP_NAMES = ("Ozon", "WB", "YM")    # m = 0, 1, 2
SIZE_MARKS = ("S", "M", "L")       # a % 3 = 0, 1, 2
TWICE, TWO_BRANDS, NO_MASTER, TWO_VOLUMES, NO_WAREHOUSE = 7, 11, 13, 17, 19   # a % 50
# ---------------------------------------------------------------------------

TAGS = ["a", "r", "m", "s"]


def _read(spark: SparkSession, sf_dir: str, name: str, cols) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _idiv(c: str, d: int) -> Column:
    return F.expr(f"{c} div {d}")


def _n(date_col: str = "date") -> Column:
    """Days since EPOCH."""
    return F.datediff(F.col(date_col), F.lit(EPOCH))


def _choose(idx: Column, values) -> Column:
    expr = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        expr = F.when(idx == i, F.lit(values[i])).otherwise(expr)
    return expr


def _lot(df: DataFrame, key: str, lot: tuple[int, int] | None) -> DataFrame:
    """The rows whose key lies in lot k of n; all of them without a lot."""
    return df if lot is None else df.filter(F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(lot[1])) == lot[0])


def sales_tags(spark: SparkSession, sf_dir: str, lot: tuple[int, int] | None = None) -> DataFrame:
    """One narrow row per lineitem row: its date, integer tags and amounts; for the orders of lot k of n alone, if given."""
    li = _read(spark, sf_dir, "lineitem",
               ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_shipdate"])
    li, orders = _lot(li, "l_orderkey", lot), _lot(_read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"]), "o_orderkey", lot)
    cust = _read(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    supp = _read(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    nation = _read(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    # nation has 25 rows: a fixed-size dimension, broadcast by construction.
    cust_r = cust.join(F.broadcast(nation.withColumnRenamed("n_nationkey", "c_nationkey")
                                   .withColumnRenamed("n_regionkey", "r")), "c_nationkey")
    supp_r = supp.join(F.broadcast(nation.withColumnRenamed("n_nationkey", "s_nationkey")
                                   .withColumnRenamed("n_regionkey", "src_region")), "s_nationkey")
    # the order's region first: lineitem is moved once, by its order
    of_order = orders.join(cust_r, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("r").cast("int").alias("r"))
    return (li.join(of_order, li.l_orderkey == of_order.o_orderkey)
            .join(supp_r, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                F.col("l_shipdate").cast("date").alias("date"),
                F.col("l_partkey").cast("int").alias("a"),
                "r",
                (F.col("l_suppkey") % 3).cast("int").alias("m"),
                (_idiv("l_suppkey", 3) % 2).cast("int").alias("s"),
                F.col("src_region"),
                F.col("l_quantity").cast("bigint").alias("quantity_orders"), F.col("l_extendedprice"), F.col("l_linenumber")))


def _article() -> Column:
    return F.concat(F.lit("A"), F.col("a")).alias("article_1c")


def _names(article: Column) -> list[Column]:
    """The key's columns from the tags."""
    a, r, m, s = (F.col(c) for c in TAGS)
    return [_choose(m, MP_NAMES).alias("mp"), F.concat(F.lit("S"), s).alias("seller"),
            F.concat(F.lit("K"), m, F.lit("-"), a).alias("sku"), article, F.concat(F.lit("C"), a).alias("code_1c"),
            F.concat(F.lit("R"), r).alias("cluster_to")]


def sales_table(tagged: DataFrame) -> DataFrame:
    """One sales row per lineitem row, with the integer tags."""
    price = F.col("l_extendedprice")
    return tagged.select(
        "date", *_names(_article()),
        F.when(F.col("src_region") == 0, F.lit(DEFAULT_PARAMS.main_cluster))
         .otherwise(F.concat(F.lit("R"), F.col("src_region"))).alias("cluster_from"),
        "quantity_orders",
        (price * F.when(F.col("l_linenumber") == 7, F.lit(0.25)).otherwise(F.lit(1.0))).alias("orders_sum"),
        (price * F.lit(0.5)).alias("cost_value_orders"),
        *TAGS)


def active_stretches(tagged: DataFrame, lo: dt.date | None = None, hi: dt.date | None = None, per=TAGS) -> DataFrame:
    """article_1c, ``per`` (which holds a), first and last day of the stretches around the sales of each ``per``;
    from lo to hi alone, if given.

    A sale has the days that the sale before it has not, so stretches do not overlap and their days need no
    ``distinct``.  Sales are moved once, by article, before there are days: what is grouped by article and
    more finds its rows together.
    """
    sold = tagged.select(_article(), *per, "date").filter(F.col("date").isNotNull())
    first, last = F.date_sub("date", ACTIVE_BEFORE), F.date_add("date", ACTIVE_AFTER)
    if lo is not None:
        sold = sold.filter(F.col("date") >= F.lit(lo - dt.timedelta(days=ACTIVE_AFTER)))
        first = F.greatest(first, F.lit(lo))
    if hi is not None:
        sold = sold.filter(F.col("date") <= F.lit(hi + dt.timedelta(days=ACTIVE_BEFORE)))
        last = F.least(last, F.lit(hi))
    before = F.lag("date").over(Window.partitionBy("article_1c", *[c for c in per if c != "a"]).orderBy("date"))
    # a task of the whole history makes up to 36 days of each sale: in more tasks what reads them sorts in memory
    parts = [] if lo is not None else [TASKS_OF_HISTORY * int(sold.sparkSession.conf.get("spark.sql.shuffle.partitions"))]
    return (sold.repartition(*parts, "article_1c").withColumn("before", before)
            .select("article_1c", *per, F.greatest(first, F.date_add("before", ACTIVE_AFTER + 1)).alias("first"), last.alias("last")))


def _days_of_stretch() -> Column:
    """Each day from first to last; a stretch that ends before it begins has none (no filter is sure to come first)."""
    return F.explode(F.when(F.col("first") <= F.col("last"), F.sequence("first", "last"))).alias("date")


def active_days(tagged: DataFrame, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """Keys with their tags on every day around their sales, each once; from lo to hi alone, if given."""
    return (active_stretches(tagged, lo, hi).select(*_names(F.col("article_1c")), *TAGS, "first", "last")
            .select(*KEY, *TAGS, _days_of_stretch()))


def fixture_tables(tagged: DataFrame, tags: DataFrame | None = None, as_of: dt.date = AS_OF,
                   p: Params = DEFAULT_PARAMS) -> Tables:
    """All domain tables, lazily, from the tagged sales and their distinct tags (when already stored).

    Stock and buffer state have a row for each of a key's active days.  They are made when an operator reads
    them, for the days it asks for (``Tables.days``), and are never stored: the days of all keys over the whole
    history are many times the sales.
    """
    sales_t = sales_table(tagged)
    if tags is None:
        tags = tagged.select(*TAGS).distinct()
    a, r, m, s = (F.col(c) for c in TAGS)
    g, odd = a % 4, a % 50
    n = _n()
    k = tags.select(*_names(_article()), *TAGS)          # the tags make the names: distinct as they are
    of_article = tags.select("a", "m", "s").distinct().withColumn("r", F.lit(None).cast("int"))
    items = of_article.select(*_names(_article()), *TAGS)

    milli = 7 + (a * 37 + m * 11) % 240          # unit volume in thousandths of a cubic metre
    volume = lambda v: F.concat(F.lit("0."), F.lpad(v.cast("string"), 3, "0"))
    master = items.filter(odd != NO_MASTER).select(
        "article_1c", "code_1c", "sku", "mp", "seller",
        F.concat(F.lit("name-A"), a).alias("name"),
        F.when((g == 1) & (m == 2), F.lit(p.resale_brand))
         .otherwise(F.concat(F.lit("B"), a % 2)).alias("brand"),
        F.when((g == 3) & (m == 0), 1).otherwise(0).alias("discounted"),
        F.concat(F.lit("WC"), a).alias("warehouse_code"),
        F.when((g == 2) & (m == 1) & (s == 1), F.lit("")).otherwise(volume(milli)).alias("volume_m3"),
        "a", "m")
    # the second rows are made beside the first: a union would read and move the items once more for each kind
    kinds = F.when(odd == TWO_BRANDS, F.array(F.lit(0), F.lit(1))).when(odd == TWO_VOLUMES, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    article_mp = (master.withColumn("kind", F.explode(kinds))
                  .withColumns({"brand": F.when(F.col("kind") == 1, F.lit("B9")).otherwise(F.col("brand")),
                                "volume_m3": F.when(F.col("kind") == 2, volume(milli + 5)).otherwise(F.col("volume_m3"))})
                  .drop("a", "m", "kind"))

    warehouses = (tags.select("m", "r").distinct()
                  .select(_choose(m, MP_NAMES).alias("mp"), F.concat(F.lit("W-R"), r).alias("warehouse_name"),
                          F.concat(F.lit("R"), r).alias("cluster")).distinct())

    def stocks(lo=None, hi=None) -> DataFrame:
        mp_stock = (active_days(tagged, lo, hi).withColumn("q", (n * (m + 2) + a * 13 + r * 7 + s * 5) % 41)
                    .select("date", "mp", "seller", "sku", "article_1c", "code_1c",
                            F.when(odd == NO_WAREHOUSE, F.lit("W-unknown"))
                             .otherwise(F.concat(F.lit("W-"), F.col("cluster_to"))).alias("warehouse_name"),
                            F.col("q").cast("bigint").alias("quantity"),
                            F.col("q").cast("bigint").alias("quantityFree"),
                            (F.col("q") + 3).cast("bigint").alias("quantityFull")))
        central_stock = (active_stretches(tagged, lo, hi, ["a"])
                         .select("article_1c", F.concat(F.lit("C"), a).alias("code_1c"), "a",
                                 _days_of_stretch())
                         .withColumn("q", (n * 3 + a * 17) % 97)
                         .select("date", F.lit(p.central_mp).alias("mp"), F.lit("").alias("seller"),
                                 F.lit("").alias("sku"), "article_1c", "code_1c",
                                 F.lit(p.main_cluster).alias("warehouse_name"),
                                 F.col("q").cast("bigint").alias("quantity"),
                                 F.col("q").cast("bigint").alias("quantityFree"),
                                 (F.col("q") + 5).cast("bigint").alias("quantityFull")))
        return mp_stock.unionByName(central_stock)

    bt = (a * 17 + r * 31 + m * 5 + s * 11) % 150 + 40
    stock_hist = F.when((a + r + m) % 3 == 0, bt - (n + s) % 11).otherwise(
        F.greatest(F.lit(0), (n * (m + 3) + a * 29 + r * 17 + s * 23) % (g * 40 + r * 12 + 30) - r * 5))
    zero = F.lit(0).cast("bigint")
    state_columns = [
        F.lit(p.id_ver).alias("id_ver"), "date",
        F.concat(F.lit("name-A"), a).alias("name"),
        "article_1c", "code_1c", "mp", "seller", "sku", "cluster_to",
        (a * 10 + r).cast("bigint").alias("total_quantity_orders"),
        (g + 3).cast("bigint").alias("max_quantity_order"),
        ((g * 8 + r) / F.lit(16)).alias("avg_quantity_orders"),
        r.cast("bigint").alias("days_oos_number"),
        g.cast("bigint").alias("days_bp_number"),
        F.lit(p.rt_days).cast("bigint").alias("avg_day_to_cluster"),
        zero.alias("insurance_reserv_cluster"),
        F.lit(p.window_days).cast("bigint").alias("buffer_cluster_norm"),
        (bt + F.col("second") * 5).cast("bigint").alias("buffer_cluster"),
        zero.alias("deliveries_to_cluster"),
        F.lit(0.0).alias("buffer_cluster_marker_current"),
        F.lit(0.0).alias("buffer_cluster_marker"),
        ((n * (m + 1) + a + r) % 13).cast("bigint").alias("quantity_orders"),
        (stock_hist + F.col("second") * 3).cast("bigint").alias("quantity_stocks"),
        zero.alias("quantity_supplies"),
        zero.alias("quantity_supplies_within_rt"),
        ((n + a + r) % 6).cast("bigint").alias("new_buffer"),
    ]

    def buffer_main(lo=None, hi=None) -> DataFrame:
        end = as_of - dt.timedelta(days=1)
        return (active_days(tagged, lo, end if hi is None else min(hi, end))
                .filter(~((r == 4) & ((n + a) % 2 == 0)) & ~((r == 3) & (g >= 2)))
                .withColumn("second", F.explode(F.when(odd == TWICE, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
                .select(*state_columns))

    # a shipment for about a third of the sales rows, with their quantity, a few days ahead of them
    shipped = F.date_sub("date", 3)
    buffer_supplies = (sales_t.filter((F.date_sub("date", 3) < F.lit(as_of)) & ((n + F.col("quantity_orders")) % 3 == 0))
                       .select(F.lit(p.id_ver).alias("id_ver"),
                               F.concat_ws("_", "mp", "seller", "cluster_to").alias("supply_id"),
                               shipped.alias("shipping_date"),
                               F.date_add(shipped, (a % 3 * 4 + 5).cast("int")).alias("closing_date"),
                               "article_1c", "code_1c", "mp", "seller", "sku", "cluster_to",
                               F.col("quantity_orders").cast("int").alias("quantity_supplies")))

    action = _choose((a + r + m + s) % 3, ("UP", "DOWN", "HOLD"))
    calc_keys = k.select(
        F.lit(as_of).alias("date"), *KEY,
        F.when((r == 3) & (g >= 2), F.lit("first_init"))
         .when(action.isin("UP", "DOWN"), F.lit("recalc_day"))
         .otherwise(F.lit("simulate_day")).alias("calc_type"),
        action.alias("action_suggested"),
        ((a * 13 + r * 7) % 60 + 30).cast("bigint").alias("min_buffer"),
        zero.alias("new_buffer_prev"), zero.alias("is_first_day"), zero.alias("is_recalc_day"),
        F.lit(p.id_ver).alias("id_ver"))

    supply_id = F.concat(F.lit("SUP"), a, F.lit("-"), r, F.lit("-"), m, F.lit("-"), s)
    goods_supplies = k.select(F.lit(as_of).alias("date"), supply_id.alias("supply_id"),
                              "mp", "seller", "article_1c", "code_1c",
                              ((a * 7 + r * 5 + m) % 12).cast("bigint").alias("quantity"))
    supplies_list = k.select(supply_id.alias("supply_id"),
                             F.concat(F.lit("W-"), F.col("cluster_to")).alias("fc_warehouse"))
    import_supplies = (tags.select("a").distinct()
                       .select(F.concat(F.lit("C"), a).alias("code_1c"), _article(), (g * 10 + 100).cast("bigint").alias("quantity")))
    dimensions = items.select("article_1c", "sku", "seller", "mp", _choose(a % 3, SIZE_MARKS).alias("mark_mp"))

    every = {"stocks": (stocks(), stocks), "buffer_main": (buffer_main(), buffer_main)}
    return Tables(
        sales=sales_t.drop(*TAGS), stocks=every["stocks"][0], article_mp=article_mp, warehouses=warehouses,
        buffer_main=every["buffer_main"][0], buffer_supplies=buffer_supplies,
        goods_supplies=goods_supplies, supplies_list=supplies_list,
        import_supplies=import_supplies, dimensions=dimensions, buffer_calc_keys=calc_keys, made_by_day=every,
    )


# --- stored fixtures ---------------------------------------------------------

_STORED: dict = {}


def stored_fixture_tables(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> Tables:
    """The domain tables from the tagged sales and their distinct tags, which are written once per session under
    the session's checkpoint folder and read back.

    Queries then start from scans of these two narrow tables instead of joining lineitem in every branch of a
    plan.  The folder carries the application's id, so sessions do not overwrite each other's.
    """
    from shelfwise.session import ensure_checkpoint_dir, shuffles_freed
    import hashlib
    key = (spark.sparkContext.applicationId, sf_dir, as_of)
    if key in _STORED:
        return _STORED[key]
    tag = hashlib.sha1(f"{sf_dir}|{as_of}".encode()).hexdigest()[:12]
    root = f"{ensure_checkpoint_dir(spark)}/fixtures/{spark.sparkContext.applicationId}/{tag}"

    def stored(parts: list[DataFrame], name: str) -> DataFrame:
        for k, df in enumerate(parts):
            df.write.mode("append" if k else "overwrite").option("compression", "zstd").parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    # lineitem is moved by order and by supplier: a lot of orders at a time, so that its moved rows are not all on the disk at once
    lots = max(1, min(MOST_LOTS, -(-_read(spark, sf_dir, "lineitem", ["l_orderkey"]).count() // LOT_ROWS)))
    with shuffles_freed(spark):
        # by date inside a file: a reader of some days skips the pages of the others
        tagged = stored([sales_tags(spark, sf_dir, (k, lots) if lots > 1 else None).sortWithinPartitions("date") for k in range(lots)], "sales_tags")
        tags = stored([tagged.select(*TAGS).distinct()], "tags")
    _STORED[key] = fixture_tables(tagged, tags, as_of)
    return _STORED[key]
