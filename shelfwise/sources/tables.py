"""The domain tables the model reads.

In production each table is a Parquet dataset (facts partitioned by date,
state partitioned by ``id_ver``/date).  ``read_tables`` opens them lazily so
date and version filters of the operators reach the scan as partition
filters; ``sources.fixtures`` builds the same tables from the TPC-H test
data.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Optional

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    sales: DataFrame            # date, KEY, cluster_from, quantity_orders, orders_sum, cost_value_orders
    stocks: DataFrame           # date, mp, seller, sku, article_1c, code_1c, warehouse_name, quantity*
    article_mp: DataFrame       # article master (volume_m3 is text, '' = missing)
    warehouses: DataFrame       # mp, warehouse_name, cluster
    buffer_main: DataFrame      # state: one row per (id_ver, date, KEY)
    buffer_supplies: DataFrame  # state: shipments (id_ver, shipping_date, KEY ...)
    goods_supplies: Optional[DataFrame] = None   # external supplies (report)
    supplies_list: Optional[DataFrame] = None    # supply header (report)
    import_supplies: Optional[DataFrame] = None  # inbound orders to the central warehouse
    dimensions: Optional[DataFrame] = None       # size marks
    buffer_calc_keys: Optional[DataFrame] = None  # state: decisions per (id_ver, date, KEY)
    key_registry: Optional[DataFrame] = None      # state: (id_ver, KEY, first_date) of every key with state
    buffer_ring: Optional[DataFrame] = None       # state: the window up to the day before, one row per active key
    made_by_day: Optional[dict] = None            # name -> (the table, what makes its days from lo to hi)

    def days(self, name: str, lo=None, hi=None) -> DataFrame:
        """A dated table of which days lo to hi (None: open) are read.

        A stored table is returned as it is, since the reader's filter reaches its scan.  No filter reaches
        below the rows of a table that is made from others, so such a table is made for these days alone.
        """
        df = getattr(self, name)
        whole, make = (self.made_by_day or {}).get(name, (None, None))
        return make(lo, hi) if df is whole and make else df

    def with_state(self, **kw) -> "Tables":
        return replace(self, **kw)


TABLE_NAMES = (
    "sales", "stocks", "article_mp", "warehouses", "buffer_main", "buffer_supplies",
    "goods_supplies", "supplies_list", "import_supplies", "dimensions", "buffer_calc_keys",
)

#: State begins empty, and the report's extra tables may be absent.
OPTIONAL = {"buffer_main", "buffer_supplies", "buffer_calc_keys", "goods_supplies", "supplies_list",
            "import_supplies", "dimensions"}

#: What the report reads of them where they are absent: empty tables.
ABSENT = {"goods_supplies": "date date, supply_id string, mp string, seller string, article_1c string, code_1c string, quantity bigint",
          "supplies_list": "supply_id string, fc_warehouse string",
          "import_supplies": "article_1c string, code_1c string, quantity bigint",
          "dimensions": "article_1c string, sku string, seller string, mp string, mark_mp string"}


def with_absent(t: Tables) -> Tables:
    """``t`` with empty tables in place of the report's absent ones."""
    spark = t.sales.sparkSession
    return t.with_state(**{n: spark.createDataFrame([], s) for n, s in ABSENT.items() if getattr(t, n) is None})


def read_tables(spark: SparkSession, root: str, state_root: Optional[str] = None) -> Tables:
    """Open the domain tables stored as ``{root}/{name}`` Parquet datasets.

    State tables are read from ``state_root`` (default ``root``); a missing
    optional table is left as None.
    """
    state_root = state_root or root
    state = {"buffer_main", "buffer_supplies", "buffer_calc_keys"}
    out = {}
    for name in TABLE_NAMES:
        base = state_root if name in state else root
        try:
            out[name] = spark.read.parquet(f"{base}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND" or name not in OPTIONAL:
                raise
            out[name] = None
    return Tables(**out)
