"""What a write leaves on the disk, and how many tasks make and keep large tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.semantics import materialize
from shelfwise.operators import report
from shelfwise.operators.current import upsert
from shelfwise.operators.demand import calendar_demand
from shelfwise.operators.report import latest_state
from shelfwise.operators.rollforward import roll_forward
from shelfwise.operators.runs import stock_runs
from shelfwise.operators.zones import day_state
from shelfwise.params import DEFAULT_PARAMS, Day
from shelfwise.schema import BUFFER_MAIN, CURRENT_KEY, KEY
from shelfwise.sources.fixtures import AS_OF, TASKS_OF_HISTORY, active_days, fixture_tables
from shelfwise.sources.state import StateStore
from shelfwise.sources.tables import Tables

D = dt.date(2025, 3, 10)


def state(spark, rows):
    """State rows of (date, sku, buffer, stock)."""
    given = spark.createDataFrame([(*r, "WB", "S0", "R1") for r in rows],
                                  "date date, sku string, buffer_cluster bigint, quantity_stocks bigint, mp string, seller string, cluster_to string")
    fixed = {"id_ver": F.lit(DEFAULT_PARAMS.id_ver), "article_1c": F.concat(F.lit("A"), "sku"), "code_1c": F.lit("C")}
    df = given.withColumns(fixed)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in BUFFER_MAIN.fields])


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def with_partitions(spark, n, work):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        return work()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_store_writes_leave_no_shuffle_files(spark, tmp_path):
    store, rows = StateStore(spark, str(tmp_path)), state(spark, [(D, f"k{i}", i, 1) for i in range(50)])
    before = shuffle_files(spark)
    store.replace_day("buffer_main", rows, DEFAULT_PARAMS.id_ver, D)
    store.seed("buffer_main", state(spark, [(D - dt.timedelta(days=1), "k1", 2, 3)]))
    assert shuffle_files(spark) <= before
    assert store.read_between("buffer_main", DEFAULT_PARAMS.id_ver, D, D).count() == 50


def test_kept_table_is_not_moved_where_partitions_are_more_than_eight(spark, tmp_path):
    def work():
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            store = StateStore(spark, str(tmp_path))
            store.replace_day("buffer_current", state(spark, [(D, f"k{i}", i, 1) for i in range(50)]), DEFAULT_PARAMS.id_ver, D)
            kept = store.bucketed("buffer_current", DEFAULT_PARAMS.id_ver, D)
            new = upsert(kept, state(spark, [(D + dt.timedelta(days=1), "k1", 7, 7)]))
            plan = new._jdf.queryExecution().executedPlan().toString()
            return store.buckets, plan.count("Exchange hashpartitioning"), {r.sku: r.buffer_cluster for r in new.collect()}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    buckets, exchanges, rows = with_partitions(spark, 24, work)
    assert buckets == 24 and exchanges == 1              # the day's rows alone
    assert rows == {**{f"k{i}": i for i in range(50)}, "k1": 7}


def test_whole_history_is_made_in_more_tasks_than_a_window(spark):
    sold = spark.createDataFrame([(D, 1, 1, 0, 0), (D, 2, 1, 0, 0)], "date date, a int, r int, m int, s int")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    days = active_days(sold, hi=D)
    assert days.rdd.getNumPartitions() == TASKS_OF_HISTORY * n
    assert days.count() == 2 * 11 and active_days(sold, D, D).count() == 2


def test_latest_state_takes_the_last_day_then_buffer_then_stock(spark):
    day = Day(D)
    rows = state(spark, [(D - dt.timedelta(days=k), "a", 10 + k, 1) for k in (3, 2, 1)] +
                 [(D - dt.timedelta(days=9), "b", 5, 1), (D - dt.timedelta(days=9), "b", 6, 1), (D - dt.timedelta(days=9), "b", 6, 4), (D, "b", 1, 1)])
    t = Tables(sales=None, stocks=None, article_mp=None, warehouses=None, buffer_main=rows, buffer_supplies=None)
    got = {r.sku: (r.buffer_cluster, r.quantity_stocks) for r in latest_state(t, day, before=D).select(*CURRENT_KEY, "buffer_cluster", "quantity_stocks").collect()}
    assert got == {"a": (11, 1), "b": (6, 4)}


def test_stock_days_are_not_moved_by_warehouse(spark):
    """The join with the list of warehouses moved every stock day, although they lie together by article."""
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    key = "mp string, seller string, sku string, article_1c string, code_1c string"
    rows = [(D, "WB", "S0", f"k{i}", f"A{i % 5}", "C", w, 5, 5, 5) for i in range(40) for w in ("W-1", "W-2", None, "W-none")]
    stocks = table(rows, f"date date, {key}, warehouse_name string, quantity bigint, quantityFree bigint, quantityFull bigint").repartition(16, "article_1c")
    t = Tables(sales=None, stocks=stocks, article_mp=None, buffer_main=None, buffer_supplies=None,
               warehouses=table([("WB", "W-1", "R1"), ("WB", "W-1", "R1"), ("WB", "W-2", "R2"), ("WB", None, "R3")], "mp string, warehouse_name string, cluster string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = stock_runs(t, Day(D))
        plan = runs._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.sku, r.cluster_to, r.quantity_stocks) for r in runs.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2       # the table's own, and that of the distinct warehouses
    assert got == sorted((f"k{i}", c, n) for i in range(40) for c, n in (("R1", 5), ("R2", 5), ("", 10)))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(AS_OF - dt.timedelta(days=back), a, r, m, m % 2, r, 1 + back % 7, 10.0 + back, 1)
            for a in (1, 2, 7, 8, 17, 19) for r, m in ((0, 0), (1, 1), (3, 2), (4, 1), (None, 2)) for back in (-3, 0, 0, 5, 16, 30, 31)]
    return fixture_tables(spark.createDataFrame(rows, "date date, a int, r int, m int, s int, src_region int, quantity_orders bigint, "
                                                      "l_extendedprice double, l_linenumber int").cache())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cut_leaves_no_shuffle_files(spark):
    """The shuffle files of a cut stayed until the driver collected its garbage (daily_main, daily_supplies)."""
    before = shuffle_files(spark)
    cut = materialize(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert shuffle_files(spark) <= before
    assert {r.k: r["count"] for r in cut.collect()} == {k: 15 if k < 2 else 14 for k in range(7)}


def test_roll_forward_reads_the_key_list_once(spark, tables, no_broadcast):
    """The list of keys was moved for its distinct rows, for the join, and again for the shipments and the day's orders."""
    day = Day(AS_OF)
    listed = spark.createDataFrame(tables.buffer_calc_keys.collect() * 2, tables.buffer_calc_keys.schema)
    got = roll_forward(tables, day, listed)
    assert sum("Scan ExistingRDD" in x and "action_suggested" in x for x in plan_of(got).splitlines()) == 1
    once = roll_forward(tables, day, tables.buffer_calc_keys)
    assert got.count() > 0 and sorted(map(str, got.collect())) == sorted(map(str, once.collect()))


def test_window_stock_is_not_kept_by_the_report(tables, monkeypatch):
    """All stock days of the window were kept for the report's parts, though one part alone reads the days before D."""
    kept = []
    monkeypatch.setattr(report, "materialize", lambda df: kept.append(df.columns) or df)
    assert report.Report(tables, Day(AS_OF)).mean_demand_excl().count() > 0
    assert len(kept) == 1 and "cluster_from" in kept[0]       # the orders


def test_supplies_of_given_items(tables):
    """The report moved the goods and headers of every key; it needs those of its own items."""
    r = report.Report(tables, Day(AS_OF), cut=False)
    items = tables.goods_supplies.filter(F.col("article_1c").isin("A1", "A7")).select("mp", "seller", "article_1c", "code_1c")
    every = r.supplies_by_cluster()
    assert sorted(map(str, r.supplies_by_cluster(items).collect())) == sorted(map(str, every.filter(F.col("article_1c").isin("A1", "A7")).collect()))


def test_state_days_are_moved_once(spark, no_broadcast):
    """The join with the keys had moved the window's state rows by KEY already when they were moved by KEY again."""
    rows = state(spark, [(D - dt.timedelta(days=k), f"k{i}", 5 + k, k) for i in range(9) for k in (1, 2, 2, 28, 29)])
    rows = rows.withColumn("code_1c", F.concat(F.lit("C"), "sku"))       # a fixed column would be dropped from the keys
    t = Tables(sales=None, stocks=None, article_mp=None, warehouses=None, buffer_main=rows, buffer_supplies=None)
    got = day_state(t, Day(D), rows.filter("sku != 'k0'").select(*KEY).distinct())
    assert plan_of(got).count("Exchange hashpartitioning") == 2       # the rows' and the keys'
    assert sorted((r.sku, (D - r.date).days, r.bt, r.available) for r in got.collect()) == [(f"k{i}", k, 5 + k, k) for i in range(1, 9) for k in (1, 2, 28)]


def test_calendar_days_are_not_moved(spark, tables, no_broadcast):
    """Each key's 28 days were moved by day and key to join the days on which it was sold."""
    day, keys = Day(AS_OF), tables.buffer_calc_keys.select(*KEY)
    got = calendar_demand(tables, day, keys)
    generate = plan_of(got).index("Generate")
    assert "Exchange" not in plan_of(got)[:generate]          # nothing moves after the days are made
    sold = {}
    for r in tables.sales.collect():
        k = tuple(r[c] for c in KEY)
        sold[r.date, k] = sold.get((r.date, k), 0.0) + r.quantity_orders
    want = [(d, k, sold.get((d, k), 0.0) if None not in k else 0.0) for k in map(tuple, keys.collect())
            for d in (AS_OF - dt.timedelta(days=b) for b in range(1, 29))]
    assert sorted(((r.date, tuple(r[c] for c in KEY), r.qty) for r in got.collect()), key=str) == sorted(want, key=str)


def test_kept_table_is_not_moved_where_it_is_written_again(spark, tmp_path, no_broadcast):
    """The table of the latest rows was moved as a whole before each write, although it lay in the buckets it is written in."""
    def work():
        store = StateStore(spark, str(tmp_path))
        store.replace_day("buffer_current", state(spark, [(D, f"k{i}", i, 1) for i in range(50)]), DEFAULT_PARAMS.id_ver, D)
        kept = store.bucketed("buffer_current", DEFAULT_PARAMS.id_ver, D)
        nameless = state(spark, [(D, None, 3, 3), (D, None, 4, 4)])
        new = upsert(kept, state(spark, [(D + dt.timedelta(days=1), "k1", 7, 7), (D, "k2", 9, 9), (D, "k3", 1, 1), (D, "new", 5, 5)]))
        out = new.repartition(store.buckets, *CURRENT_KEY)
        rows = {r.sku: r.buffer_cluster for r in out.collect()}
        final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        odd = upsert(nameless, state(spark, [(D, None, 1, 1), (D, "a", 1, 1)]))
        return final.count("Exchange hashpartitioning"), rows, sorted((str(r.sku), r.buffer_cluster) for r in odd.collect())
    exchanges, rows, odd = with_partitions(spark, 24, work)
    assert exchanges == 1                                # the day's rows alone
    assert rows == {**{f"k{i}": i for i in range(50)}, "k1": 7, "k2": 9, "k3": 3, "new": 5}
    assert odd == [("None", 1), ("None", 3), ("None", 4), ("a", 1)]


def test_article_list_is_made_once(spark, no_broadcast):
    """The items were read and moved once for each of the three kinds of rows of the article list."""
    from shelfwise.operators.keys import valid_articles
    from shelfwise.sources.fixtures import stored_fixture_tables
    t = stored_fixture_tables(spark, "/root/testdata/sf0.001")
    assert plan_of(t.article_mp).count("Exchange hashpartitioning") == 1
    assert t.article_mp.count() == t.article_mp.select("article_1c", "sku", "seller", "mp", "brand", "volume_m3").distinct().count()
    assert valid_articles(t, Day(AS_OF)).count() > 0


def test_sales_lie_by_date_in_their_files(spark):
    """A reader of some days opened every page of the stored sales."""
    from shelfwise.sources.fixtures import stored_fixture_tables
    t = stored_fixture_tables(spark, "/root/testdata/sf0.001")
    path = t.sales.inputFiles()[0]
    dates = [r.date for r in spark.read.parquet(path).collect() if r.date]
    assert len(dates) > 100 and dates == sorted(dates)
