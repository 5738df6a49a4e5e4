"""Key columns and declared schemas of the state tables."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ["mp", "seller", "sku", "article_1c", "code_1c", "cluster_to"]
LANE = ["mp", "seller", "cluster_to"]
ARTICLE = ["article_1c", "code_1c"]

_S, _L, _D, _I, _DT = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.DateType()


def _struct(cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


_KEY_FIELDS = [(c, _S) for c in KEY]

CALC_KEYS = _struct(
    [("date", _DT)] + _KEY_FIELDS + [
        ("calc_type", _S), ("action_suggested", _S),
        ("min_buffer", _L), ("new_buffer_prev", _L),
        ("is_first_day", _L), ("is_recalc_day", _L), ("id_ver", _I),
    ]
)

BUFFER_MAIN = _struct(
    [("id_ver", _I), ("date", _DT), ("name", _S),
     ("article_1c", _S), ("code_1c", _S), ("mp", _S), ("seller", _S), ("sku", _S), ("cluster_to", _S),
     ("total_quantity_orders", _L), ("max_quantity_order", _L), ("avg_quantity_orders", _D),
     ("days_oos_number", _L), ("days_bp_number", _L),
     ("avg_day_to_cluster", _L), ("insurance_reserv_cluster", _L), ("buffer_cluster_norm", _L),
     ("buffer_cluster", _L), ("deliveries_to_cluster", _L),
     ("buffer_cluster_marker_current", _D), ("buffer_cluster_marker", _D),
     ("quantity_orders", _L), ("quantity_stocks", _L), ("quantity_supplies", _L),
     ("quantity_supplies_within_rt", _L), ("new_buffer", _L)]
)

BUFFER_SUPPLIES = _struct(
    [("id_ver", _I), ("supply_id", _S), ("shipping_date", _DT), ("closing_date", _DT),
     ("article_1c", _S), ("code_1c", _S), ("mp", _S), ("seller", _S), ("sku", _S), ("cluster_to", _S),
     ("quantity_supplies", _I)]
)

BUFFER_MAIN_COLUMNS = [f.name for f in BUFFER_MAIN.fields]
CALC_KEYS_COLUMNS = [f.name for f in CALC_KEYS.fields]
BUFFER_SUPPLIES_COLUMNS = [f.name for f in BUFFER_SUPPLIES.fields]

KEY_REGISTRY = _struct([("id_ver", _I)] + _KEY_FIELDS + [("first_date", _DT)])

#: Key of the latest state row (the report's), and that row with the date it is known for.
CURRENT_KEY = ["mp", "seller", "cluster_to", "sku"]
BUFFER_CURRENT = T.StructType([*BUFFER_MAIN.fields, T.StructField("as_of", _DT, True)])

_AL = T.ArrayType(_L, True)

#: One row per active key: a slot for each day of the window that ends on ``date``.
BUFFER_RING = _struct([("id_ver", _I), ("date", _DT)] + _KEY_FIELDS
                      + [("known", T.BooleanType()), ("last_sold", _DT), ("bt", _AL), ("stock", _AL), ("quantity", _AL)])
