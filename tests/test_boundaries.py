"""Boundaries of the guards and of the rebase, on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.decision import decide
from shelfwise.operators.rollforward import roll_forward
from shelfwise.params import DEFAULT_PARAMS, Day
from shelfwise.schema import BUFFER_MAIN, BUFFER_SUPPLIES, CALC_KEYS, KEY
from shelfwise.sources.tables import Tables

DAY = Day(dt.date(1998, 7, 1), DEFAULT_PARAMS)
BASE = dict(cnt_hist=9, new_buffer_prev=5, bt_prev=100, stocks_prev=0, days_observed=28, breach_days=0, red_days=0,
            green_days=0, yellow_days=28, red_threshold=10, green_threshold=18, has_coverage=1, fast_red=0,
            quantity_supplies_within_rt=0, buf_target_toc=50.0, buf_target_norm=50.0, avg_qty_ewma=1.0)
# red days alone raise the buffer unless half of it is covered
RED = dict(red_days=10)
CASES = [
    (dict(), "HOLD", "HOLD"),
    (dict(has_coverage=0, breach_days=5), "HOLD", "HOLD"),
    ({**RED, "stocks_prev": 49}, "UP", "UP"),
    ({**RED, "stocks_prev": 50}, "UP", "HOLD"),                                       # cover exactly 0.5
    ({**RED, "stocks_prev": 20, "quantity_supplies_within_rt": 30}, "UP", "HOLD"),
    ({**RED, "stocks_prev": 50, "breach_days": 1}, "UP", "UP"),                       # a breach overrides the cover
    (dict(buf_target_toc=101.0, stocks_prev=99), "UP", "UP"),
    (dict(fast_red=1, stocks_prev=80), "UP", "HOLD"),
    (dict(green_days=18), "DOWN", "DOWN"),
    (dict(green_days=17), "HOLD", "HOLD"),
    (dict(green_days=18, new_buffer_prev=3), "DOWN", "DOWN"),                          # cooldown: 3 days are enough
    (dict(green_days=18, new_buffer_prev=2), "DOWN", "HOLD"),
    ({**RED, "new_buffer_prev": 2}, "UP", "UP"),                                      # a hard cause needs no cooldown
    (dict(bt_prev=0, buf_target_toc=1.0), "UP", "UP"),                                # no buffer: cover is 0
    (dict(bt_prev=0, buf_target_toc=0.0, **RED), "UP", "UP"),
]


def test_guards(spark):
    names = list(BASE)
    rows = [(k, *[{**BASE, **change}[n] for n in names]) for k, (change, _, _) in enumerate(CASES)]
    kinds = ["double" if isinstance(BASE[n], float) else "bigint" for n in names]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    got = {r.id: (r.action_raw, r.action_suggested) for r in decide(df, DAY).collect()}
    assert [got[k] for k in range(len(CASES))] == [(raw, done) for _, raw, done in CASES]


@pytest.fixture(scope="module")
def rebased(spark):
    """bt_prev, action, min_buffer -> new buffer."""
    cases = [(90, "DOWN", 60), (90, "DOWN", 61), (90, "UP", 0), (15, "UP", 0), (45, "DOWN", None), (1, "DOWN", None), (0, "UP", 0), (90, "HOLD", 0)]
    key = lambda k: ("Ozon", "S0", f"K{k}", f"A{k}", f"C{k}", "R0")
    main = spark.createDataFrame([(2, DAY.prev, *key(k), bt, 10, 0, 4) for k, (bt, _, _) in enumerate(cases)],
                                 "id_ver int, date date, " + ", ".join(f"{c} string" for c in KEY)
                                 + ", buffer_cluster bigint, quantity_stocks bigint, quantity_orders bigint, new_buffer bigint")
    main = main.select(*[F.col(f.name) if f.name in main.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in BUFFER_MAIN])
    calc = spark.createDataFrame([(DAY.d, *key(k), "recalc_day", a, m, 4, 0, 1, 2) for k, (_, a, m) in enumerate(cases)], CALC_KEYS)
    sales = spark.createDataFrame([], "date date, " + ", ".join(f"{c} string" for c in KEY) + ", quantity_orders bigint")
    master = spark.createDataFrame([], "article_1c string, code_1c string, name string, brand string, discounted int")
    t = Tables(sales=sales, stocks=None, article_mp=master, warehouses=None, buffer_main=main,
               buffer_supplies=spark.createDataFrame([], BUFFER_SUPPLIES))
    out = {r.sku: r for r in roll_forward(t, DAY, calc).collect()}
    return {c: (out[f"K{k}"].buffer_cluster, out[f"K{k}"].new_buffer) for k, c in enumerate(cases)}


def test_rebase(rebased):
    assert rebased[90, "DOWN", 60] == (60, 0)          # 60.003 rounds to the floor itself
    assert rebased[90, "DOWN", 61] == (90, 0)          # one below the floor: the old buffer stays
    assert rebased[90, "UP", 0] == (120, 0)            # 119.997
    assert rebased[15, "UP", 0] == (20, 0)
    assert rebased[45, "DOWN", None] == (30, 0)
    assert rebased[1, "DOWN", None] == (1, 0)
    assert rebased[0, "UP", 0] == (0, 0)
    assert rebased[90, "HOLD", 0] == (90, 0)
