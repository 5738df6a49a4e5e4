"""The test tables: days around sales are made for the days asked for, and never stored."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import fixtures
from shelfwise.sources.fixtures import TAGS, active_days, fixture_tables

D = dt.date(1998, 7, 1)
SCHEMA = ("date date, a int, r int, m int, s int, src_region int, quantity_orders bigint, "
          "l_extendedprice double, l_linenumber int")


@pytest.fixture(scope="module")
def tagged(spark):
    rows = [(D - dt.timedelta(days=back), a, r, m, m % 2, r, back % 7, 10.0, 1)
            for a in (1, 2, 7, 11, 13, 17, 19, None) for r, m in ((0, 0), (4, 1), (3, 2), (None, 2))
            for back in (-3, 0, 0, 5, 30, 31, 70, 71, 300)]
    return spark.createDataFrame(rows + [(None, 1, 0, 0, 1, 0, 1, 1.0, 1)], SCHEMA).cache()


def plain(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def brute_days(tagged):
    around = F.sequence(F.date_sub("date", fixtures.ACTIVE_BEFORE), F.date_add("date", fixtures.ACTIVE_AFTER))
    return tagged.select(*TAGS, F.explode(around).alias("date")).distinct()


def test_each_active_day_once(tagged):
    want = brute_days(tagged)
    assert plain(active_days(tagged).select(*TAGS, "date")) == plain(want)
    lo, hi = D - dt.timedelta(days=40), D - dt.timedelta(days=1)
    for a, b in ((lo, hi), (lo, None), (None, hi), (hi, hi)):
        part = want.filter((F.col("date") >= F.lit(a or dt.date(1900, 1, 1))) & (F.col("date") <= F.lit(b or dt.date(2100, 1, 1))))
        assert plain(active_days(tagged, a, b).select(*TAGS, "date")) == plain(part)


@pytest.mark.parametrize("name", ["stocks", "buffer_main"])
def test_days_asked_for_are_those_of_the_whole_table(tagged, name):
    t = fixture_tables(tagged)
    whole = getattr(t, name)
    for lo, hi in ((D - dt.timedelta(days=30), D), (D - dt.timedelta(days=1),) * 2, (None, D - dt.timedelta(days=9))):
        part = whole if lo is None else whole.filter(F.col("date") >= F.lit(lo))
        assert plain(t.days(name, lo, hi)) == plain(part.filter(F.col("date") <= F.lit(hi)))
    other = t.with_state(**{name: whole.limit(3)})          # a table put in its place is read as it is
    assert other.days(name, D, D).count() == 3


def test_only_narrow_tables_are_stored(spark, tagged, tmp_path, monkeypatch):
    """The days of stock and state were stored: dozens of rows for each sale."""
    spark.createDataFrame([(0, 0)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/in/nation.parquet")
    spark.createDataFrame([(1, 0)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/in/customer.parquet")
    spark.createDataFrame([(1, 0)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/in/supplier.parquet")
    spark.createDataFrame([(1, 1)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/in/orders.parquet")
    spark.range(200).selectExpr("1L l_orderkey", "id % 20 l_partkey", "1L l_suppkey", "1 l_linenumber", "2D l_quantity", "3D l_extendedprice",
                                "timestamp_ntz'1998-06-20 00:00:00' l_shipdate").write.parquet(f"{tmp_path}/in/lineitem.parquet")
    monkeypatch.setattr("shelfwise.session.ensure_checkpoint_dir", lambda _: f"{tmp_path}/kept")
    t = fixtures.stored_fixture_tables(spark, f"{tmp_path}/in")
    stored = {d: spark.read.parquet(f"{p}/{d}").count() for p, dirs, _ in os.walk(f"{tmp_path}/kept") for d in dirs if d in ("sales_tags", "tags")}
    assert {d for p, dirs, files in os.walk(f"{tmp_path}/kept") if any(f.endswith(".parquet") for f in files) for d in [os.path.basename(p)]} == {"sales_tags", "tags"}
    assert stored == {"sales_tags": 200, "tags": 20} and t.stocks.count() == 2 * 20 * 36


def test_sales_are_joined_a_lot_of_orders_at_a_time(spark, tmp_path, monkeypatch):
    """All of lineitem was moved by order and by supplier at once, and both moves were on the disk until the write ended."""
    spark.createDataFrame([(k, k % 5) for k in range(25)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/in/nation.parquet")
    spark.range(30).selectExpr("id c_custkey", "cast(id % 25 as int) c_nationkey").write.parquet(f"{tmp_path}/in/customer.parquet")
    spark.range(9).selectExpr("id s_suppkey", "cast(id % 25 as int) s_nationkey").write.parquet(f"{tmp_path}/in/supplier.parquet")
    # keys that come twice, null keys, orders without customer, lines without order or supplier
    spark.range(100).selectExpr("nullif(id % 90, 7) o_orderkey", "nullif(id % 40, 3) o_custkey").write.parquet(f"{tmp_path}/in/orders.parquet")
    spark.range(500).selectExpr("nullif(id % 110, 9) l_orderkey", "id % 20 l_partkey", "nullif(id % 11, 4) l_suppkey", "cast(id % 7 as int) l_linenumber",
                                "2D l_quantity", "cast(id as double) l_extendedprice", "timestamp_ntz'1998-06-20 00:00:00' l_shipdate").write.parquet(f"{tmp_path}/in/lineitem.parquet")
    monkeypatch.setattr("shelfwise.session.ensure_checkpoint_dir", lambda _: f"{tmp_path}/kept")
    monkeypatch.setattr(fixtures, "LOT_ROWS", 100)
    one_go, sizes = fixtures.sales_tags, []

    def counted(*args):
        df = one_go(*args)
        sizes.append(df.count())
        return df

    monkeypatch.setattr(fixtures, "sales_tags", counted)
    fixtures.stored_fixture_tables(spark, f"{tmp_path}/in")
    kept = next(f"{p}/sales_tags" for p, dirs, _ in os.walk(f"{tmp_path}/kept") if "sales_tags" in dirs)
    want = one_go(spark, f"{tmp_path}/in")
    assert plain(spark.read.parquet(kept)) == plain(want)
    assert len(sizes) == 5 and sum(sizes) == want.count() > 0 and max(sizes) < sum(sizes) / 2
