"""The daily buffer decision: raw action, guards, route and advice per key.

Inputs per key are joined with LEFT JOIN + type defaults (M1 of SURVEY):
a key without previous state has bt_prev = 0, stocks_prev = 0 and
new_buffer_prev = 0, so the cooldown guard also applies to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.semantics import fill_defaults, materialize, safe_div
from shelfwise.operators.demand import demand_target_sparse
from shelfwise.operators.keys import candidate_keys, key_history, prev_state, supply_windows
from shelfwise.operators.zones import day_zones, zone_summary
from shelfwise.params import Day
from shelfwise.schema import CALC_KEYS_COLUMNS, KEY
from shelfwise.sources.tables import Tables

_DEFAULTS = {
    "cnt_hist": 0, "new_buffer_prev": 0, "bt_prev": 0, "stocks_prev": 0,
    "days_observed": 0, "breach_days": 0, "red_days": 0, "green_days": 0, "yellow_days": 0,
    "red_threshold": 0, "green_threshold": 0, "has_coverage": 0, "fast_red": 0,
    "quantity_supplies_within_rt": 0,
}


def decision_inputs(t: Tables, day: Day, demand=demand_target_sparse, keys: DataFrame | None = None,
                    cut: bool = True) -> DataFrame:
    """One row per candidate key with every input of the decision.

    The key list feeds six branches (history, previous state, zones, supplies,
    demand, the final join).  It is small (one row per key), so it is
    materialised once (reliable checkpoint under spark.checkpoint.dir)
    instead of re-scanning sales and state in every branch.
    """
    if keys is None:
        keys = candidate_keys(t, day)
        if cut:
            keys = materialize(keys)
    zones = zone_summary(day_zones(t, day, keys), day)
    within = supply_windows(t, day, keys).select(*KEY, "quantity_supplies_within_rt")
    df = (keys
          .join(key_history(t, day, keys), KEY, "left")
          .join(prev_state(t, day, keys), KEY, "left")
          .join(zones, KEY, "left")
          .join(within, KEY, "left")
          .join(demand(t, day, keys), KEY, "left"))
    return fill_defaults(df, _DEFAULTS)


def decide(inputs: DataFrame, day: Day) -> DataFrame:
    """Raw action -> guarded action -> route, flags and advice."""
    p = day.p
    c = F.col
    toc_up = c("buf_target_toc") > c("bt_prev")
    breach = c("breach_days") > 0
    red_up = c("red_days") >= c("red_threshold")
    fast = c("fast_red") == 1
    raw = (F.when(c("has_coverage") == 0, "HOLD")
           .when(fast, "UP").when(toc_up, "UP").when(breach, "UP").when(red_up, "UP")
           .when((c("breach_days") == 0) & (c("red_days") == 0)
                 & (c("green_days") >= c("green_threshold")), "DOWN")
           .otherwise("HOLD"))
    # guard 1: stock plus supplies within lead time already cover half the buffer
    ratio = safe_div(c("stocks_prev") + c("quantity_supplies_within_rt"), c("bt_prev"))
    cover = F.when(ratio.isNull(), F.lit(0.0)).otherwise(F.least(ratio, F.lit(1.0)))
    guard_cover = (c("action_raw") == "UP") & (cover >= 0.5) & ~(toc_up | breach)
    # guard 2: cooldown since the last buffer change, unless a hard UP cause
    guard_cool = (c("action_raw").isin("UP", "DOWN") & (c("new_buffer_prev") < p.cooldown_days)
                  & ~((c("action_raw") == "UP") & (fast | breach | red_up | toc_up)))
    suggested = F.when(guard_cover, "HOLD").when(guard_cool, "HOLD").otherwise(c("action_raw"))
    first = (c("cnt_hist") == 0)
    recalc = c("action_suggested").isin("UP", "DOWN")
    tol = p.advice_tol

    def advice(mult):
        return (F.when(mult.isNull(), "HOLD").when(mult > 1 + tol, "UP")
                .when(mult < 1 - tol, "DOWN").otherwise("HOLD"))

    return (inputs
            .withColumn("action_raw", raw)
            .withColumn("action_suggested", suggested)
            .withColumns({
                "date": F.lit(day.d),
                "min_buffer": c("buf_target_toc").cast("bigint"),
                "calc_type": F.when(first, "first_init").when(recalc, "recalc_day").otherwise("simulate_day"),
                "is_first_day": first.cast("bigint"),
                "is_recalc_day": recalc.cast("bigint"),
                "id_ver": F.lit(p.id_ver),
                "rec_mult_norm": safe_div(c("buf_target_norm"), c("bt_prev")),
                "rec_mult_toc": safe_div(c("buf_target_toc"), c("bt_prev")),
            })
            .withColumns({"advice_norm": advice(c("rec_mult_norm")),
                          "advice_toc": advice(c("rec_mult_toc"))}))


def decisions(t: Tables, day: Day, demand=demand_target_sparse, cut: bool = True) -> DataFrame:
    """Full decision table of day D (calc-keys columns plus diagnostics)."""
    return decide(decision_inputs(t, day, demand, cut=cut), day)


def calc_keys(t: Tables, day: Day) -> DataFrame:
    """The routed key list of day D, in the declared calc-keys schema."""
    return decisions(t, day).select(*CALC_KEYS_COLUMNS).distinct()
