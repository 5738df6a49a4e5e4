"""Demand target: dense plan == sparse plan == a numpy brute force."""

import datetime as dt
import random

import numpy as np
import pytest

from shelfwise.operators.demand import demand_target, demand_target_sparse
from shelfwise.params import DEFAULT_PARAMS, Day
from shelfwise.schema import KEY
from shelfwise.sources.tables import Tables

DAY = Day(dt.date(1998, 7, 1), DEFAULT_PARAMS)
SALES = ("date date, mp string, seller string, sku string, article_1c string, code_1c string, "
         "cluster_to string, quantity_orders bigint, orders_sum double, cost_value_orders double")


def brute(series, p=DEFAULT_PARAMS):
    x = np.array(series, dtype=float)                   # chronological, 28 values
    n = len(x)
    s = np.sort(x)
    kk = (n - 1) * p.cap_q
    f, c = int(np.floor(kk)), int(np.ceil(kk))
    p90 = s[f] if f == c else s[f] * (1 - (kk - f)) + s[c] * (kk - f)
    cap = np.minimum(x, p90)
    a = p.alpha
    w = (1 - a) ** np.arange(n)[::-1]
    ewma = (cap * w).sum() * a / (1 - (1 - a) ** n)
    s2 = (cap * cap).mean() - cap.mean() ** 2
    return p90, ewma, s2


@pytest.mark.parametrize("seed", range(3))
def test_dense_sparse_brute(spark, seed):
    rnd = random.Random(seed)
    rows, series = [], {}
    for k in range(12):
        key = ("Ozon", "S0", f"K{k}", "A", "C", "R1")
        days = [0] * 28
        for i in range(28):
            if rnd.random() < (0.1 if k % 3 == 0 else 0.6):
                q = rnd.choice([1, 2, 3, 5, 40]) if k != 5 else 0   # key 5: zero-quantity rows only
                days[i] += q
                rows.append((DAY.window_start + dt.timedelta(days=i), *key, q, 10.0 * q, 5.0 * q))
        series[key[2]] = days
    empty_key = ("Ozon", "S0", "K99", "A", "C", "R1")            # no sales at all
    sales = spark.createDataFrame(rows, SALES)
    all_keys = [("Ozon", "S0", f"K{k}", "A", "C", "R1") for k in range(12)] + [empty_key]
    keys = spark.createDataFrame(all_keys, ", ".join(f"{c} string" for c in KEY))
    series["K99"] = [0] * 28
    t = Tables(sales=sales, stocks=None, article_mp=None, warehouses=None, buffer_main=None, buffer_supplies=None)
    dense = {r.sku: r for r in demand_target(t, DAY, keys).collect()}
    sparse = {r.sku: r for r in demand_target_sparse(t, DAY, keys).collect()}
    assert dense.keys() == sparse.keys() == series.keys()
    for sku, s in series.items():
        p90, ewma, s2 = brute(s)
        for r in (dense[sku], sparse[sku]):
            assert r.p90_win == pytest.approx(p90, abs=1e-9)
            assert r.avg_qty_ewma == pytest.approx(ewma, abs=1e-9)
            assert r.s2_cap == pytest.approx(s2, abs=1e-9)
        assert dense[sku].buf_target_toc == sparse[sku].buf_target_toc
