"""The ring, runs of stock days, windows per lane, and the report without its optional tables."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.operators import bounds, runs
from shelfwise.operators.keys import state_on
from shelfwise.operators.report import Report
from shelfwise.operators.ring import advance, ring_from_history, slot
from shelfwise.params import DEFAULT_PARAMS, Day
from shelfwise.schema import KEY
from shelfwise.sources.fixtures import AS_OF, stored_fixture_tables

SF = "/root/testdata/sf0.001"
DAY = Day(AS_OF, DEFAULT_PARAMS)


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _key(k):
    return ("Ozon", "S0", f"K{k}", f"A{k}", f"C{k}", "R0")


def test_ring_advances_to_the_ring_of_the_history(spark):
    """Three days, keys entering and leaving; late sales are taken in when their days are read again."""
    t = stored_fixture_tables(spark, SF)
    late = t.sales.filter(F.col("date") == F.lit(DAY.minus(4))).limit(5).withColumn("quantity_orders", F.lit(1000).cast("bigint"))
    more = t.with_state(sales=t.sales.unionByName(late).cache())
    ring = ring_from_history(t, DAY, DAY.minus(4)).cache()
    for k in (3, 2, 1):
        end = DAY.minus(k)
        ring = advance(ring, more, DAY, end, state_on(t, DAY, end), again=[DAY.minus(4), DAY.minus(200)]).checkpoint()
        assert _rows(ring) == _rows(ring_from_history(more, DAY, end))
    assert ring.filter(F.size("bt") != 28).count() == 0 and slot(DAY.d, 28) == slot(DAY.minus(28), 28)


def test_runs_of_stock_days(spark):
    start = DAY.history_start
    held = {1: [5] * 10 + [0] * 0, 2: [7, 7, None, 7, 200, 200, 3, 3], 3: [None] * 29 + [4, 9], 4: [None] * 30 + [6]}
    days = [(start + dt.timedelta(days=i), *_key(k), q) for k, qs in held.items() for i, q in enumerate(qs) if q is not None]
    found = runs.runs_of(spark.createDataFrame(days, "date date, " + ", ".join(f"{c} string" for c in KEY) + ", quantity_stocks bigint"))
    got = sorted((r.sku, r.quantity_stocks, (r.first_day - start).days, (r.last_day - start).days) for r in found.collect())
    assert got == [("K1", 5, 0, 9), ("K2", 3, 6, 7), ("K2", 7, 0, 1), ("K2", 7, 3, 3), ("K2", 200, 4, 5), ("K3", 4, 29, 29), ("K3", 9, 30, 30), ("K4", 6, 30, 30)]
    spans = runs.oos_intervals(found, DAY)
    out = sorted((r.sku, r.quantity_stocks, (r.first_day - start).days, (r.last_day - start).days, r.max_qs) for r in spans.collect())
    assert out == [("K1", 0, 10, 29, 5), ("K2", 0, 2, 2, 200), ("K2", 0, 8, 29, 200), ("K2", 3, 6, 7, 200), ("K3", 0, 0, 28, 4)]
    assert {r.sku: r.days_oos_number for r in runs.oos_counts(spans).collect()} == {"K1": 20, "K2": 25, "K3": 29}
    assert runs.oos_days(spans, DAY).count() == 74
    assert {r.sku: r.max_qs for r in runs.peaks(found, DAY).collect()} == {"K1": 5, "K2": 200, "K3": 4}


def test_windows_of_each_key(spark):
    """Bounds of a day, over many bins, empty and at the edges of bins."""
    origin = dt.date(2020, 1, 1)
    at = lambda n: origin + dt.timedelta(days=n)
    kinds = ", ".join(f"{c} string" for c in KEY)
    rows = spark.createDataFrame([(*_key(k), at(n)) for k in range(4) for n in range(80)], f"{kinds}, date date")
    limits = {0: (0, 79), 1: (13, 14), 2: (27, 28), 3: (9, 8)}
    df = spark.createDataFrame([(*_key(k), at(a), at(b)) for k, (a, b) in limits.items()], f"{kinds}, lo date, hi date")
    for width in (1, 14, 500):
        out = bounds.within_bounds(rows, df, width)
        got = {(r.sku, (r.date - origin).days) for r in out.collect()}
        assert out.count() == len(got) and got == {(f"K{k}", n) for k, (a, b) in limits.items() for n in range(a, b + 1)}
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_report_order_and_absent_tables(spark):
    t = stored_fixture_tables(spark, SF)
    order = lambda rows: [(r.article_1c, r.mp, r.seller, r.cluster_to) for r in rows]
    whole = Report(t, DAY).planning_report().collect()
    assert order(whole) == sorted(order(whole)) and len(whole) > 10
    less = Report(t.with_state(goods_supplies=None, supplies_list=None, import_supplies=None, dimensions=None), DAY).planning_report().collect()
    assert order(less) == order(whole)
    assert all(r.quantity_import_orders == 0 and r.quantity_supplies == 0 and r["size"] == "" for r in less)
