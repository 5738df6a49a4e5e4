"""Boundary cases of the pinned semantics and of the column-level rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.semantics import capped_ratio, round_even, safe_div
from shelfwise.functions.series import exact_quantile, linear_quantile
from shelfwise.operators.zones import _thresholds, zoned
from shelfwise.params import DEFAULT_PARAMS, Day

DAY = Day(dt.date(1998, 7, 1), DEFAULT_PARAMS)


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_round_even_half_to_even(spark):
    assert one(spark, round_even(F.lit(2.5))) == 2.0
    assert one(spark, round_even(F.lit(3.5))) == 4.0
    assert one(spark, round_even(F.lit(0.125), 2)) == 0.12
    assert one(spark, round_even(F.lit(1.005), 2)) == 1.0       # 100.49999999999999 after scaling


def test_safe_div_and_marker(spark):
    assert one(spark, safe_div(F.lit(1), F.lit(0))) is None
    assert one(spark, safe_div(F.lit(0.0), F.lit(0.0))) is None
    assert one(spark, capped_ratio(F.lit(5), F.lit(0))) == 1.0      # missing denominator -> 1
    assert one(spark, capped_ratio(F.lit(30), F.lit(20))) == 1.0     # capped
    assert one(spark, capped_ratio(F.lit(5), F.lit(8))) == 0.62     # 0.625 -> even


@pytest.mark.parametrize("bt,avail,zone", [
    (3, 2, "yellow"),      # pos exactly 1/3 -> not green
    (3, 1, "red"),         # pos exactly 2/3 -> not yellow
    (0, 5, None),          # no buffer -> no zone
    (10, 15, "green"),     # stock above buffer is capped
    (10, -4, "black"),     # negative stock -> breach
    (10, 0, "black"),
])
def test_zones(spark, bt, avail, zone):
    df = spark.createDataFrame([("m", "s", "k", "a", "c", "r", dt.date(1998, 6, 30), bt, avail)],
                               "mp string, seller string, sku string, article_1c string, code_1c string, "
                               "cluster_to string, date date, bt bigint, available bigint")
    assert zoned(df).first()["zone"] == zone


@pytest.mark.parametrize("obs,red_thr,green_thr,cov", [(16, 6, 10, 0), (17, 6, 11, 1), (28, 10, 18, 1), (0, 1, 0, 0)])
def test_coverage_thresholds(spark, obs, red_thr, green_thr, cov):
    df = spark.createDataFrame([(obs,)], "days_observed bigint")
    r = _thresholds(df, DAY).first()
    assert (r["red_threshold"], r["green_threshold"], r["has_coverage"]) == (red_thr, green_thr, cov)


def test_quantiles(spark):
    for n in (10, 20, 30):
        arr = F.array(*[F.lit(float(i)) for i in range(n)])
        # exact: 0-based floor(0.9 n); linear: (n-1) * 0.9 interpolated
        assert one(spark, exact_quantile(arr, F.lit(n), 0.9)) == float(int(0.9 * n))
        assert one(spark, linear_quantile(arr, F.lit(n), 0.9)) == pytest.approx((n - 1) * 0.9)
