"""Model parameters.

Every value below is a fixed value of the model; results only match when
they are kept as they are.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # --- fixed values: model parameters -------------------------------
    id_ver: int = 2                 # calculation version written with every state row
    period: int = 30                # sales / stock history window, days
    rt_days: int = 7                # replenishment time (lead time) per key, days
    m_rt: int = 4                   # zone window = rt_days * m_rt days
    oos_ratio: float = 0.02         # stock / peak stock at or below this is out of stock
    bad_price_low: float = -0.4     # unit price / median - 1 at or below: low price day
    bad_price_high: float = 0.4     # at or above: high price day
    ins_const: int = 0              # insurance reserve written on init rows
    truck_m3: float = 8.0           # one truck
    min_line_qty: int = 3           # smallest quantity worth shipping on one line
    min_load_m3: float = 6.0        # a lane ships only from this volume; a last truck
                                    # loaded at least this much still goes
    cooldown_days: int = 3          # no buffer change more often than this
    up_step: float = 0.3333         # buffer growth factor 1 + up_step
    down_step: float = 0.3333       # buffer shrink factor 1 - down_step
    red_share_up: float = 0.3333    # UP when red days >= share of observed days
    green_share_down: float = 0.66666  # DOWN when green days >= share and no red/black
    require_coverage: float = 0.6   # share of window days with a zone, else HOLD
    fast_red_streak: int = 3        # last N observed days red -> UP
    cap_q: float = 0.90             # demand is capped at this quantile
    half_life: float = 5.0          # EWMA half life, days
    z: float = 2.33                 # service factor on demand variability
    b_mult: float = 1.0             # manual multiplier of the target buffer
    b_extra_days: float = 0.0       # extra days of cover on the target buffer
    advice_tol: float = 0.05        # advice tolerance around the current buffer
    cluster_norm_days: int = 19     # full report: destination buffer, 7 days to the cluster + reserve of 7 + 5
    central_norm_days: int = 75     # full report: central buffer, 35 days to the centre + reserve of 35 + 5
    lead_time_days: int = 7         # closing date = shipping date + this
    marketplaces: tuple = ("Ozon", "WB", "YM")
    resale_brand: str = "РЕСЕЙЛ"
    central_mp: str = "1C"
    main_cluster: str = "Основной"
    central_warehouses: tuple = (
        "Основной",
        "Старая Купавна ответ хранение (СТ Лоджистик)",
        "Старая Купавна: СВХ",
        "Старая Купавна",
    )
    oos_label: str = "Низкий запас"
    low_price_label: str = "Низкая цена"
    high_price_label: str = "Высокая цена"
    # ------------------------------------------------------------------

    @property
    def window_days(self) -> int:
        """Zone / demand window length (28 with the defaults)."""
        return self.rt_days * self.m_rt

    @property
    def alpha(self) -> float:
        """EWMA smoothing factor from the half life."""
        return 1.0 - 2.0 ** (-1.0 / self.half_life)

    @property
    def max_excluded_days(self) -> float:
        """Init acceptance bound on out-of-stock / low-price days (25.0)."""
        return self.period - self.period / 6

    @property
    def coverage_days(self) -> int:
        """Observed days needed for a decision: half-even round of 28 * 0.6."""
        return int(round(self.window_days * self.require_coverage))


DEFAULT_PARAMS = Params()


@dataclass(frozen=True)
class Day:
    """Date arithmetic for one business date D, as Python dates (literals in plans)."""

    d: dt.date
    p: Params = field(default_factory=Params)

    def minus(self, n: int) -> dt.date:
        return self.d - dt.timedelta(days=n)

    def plus(self, n: int) -> dt.date:
        return self.d + dt.timedelta(days=n)

    @property
    def prev(self) -> dt.date:
        return self.minus(1)

    @property
    def history_start(self) -> dt.date:
        return self.minus(self.p.period)

    @property
    def window_start(self) -> dt.date:
        return self.minus(self.p.window_days)

    @property
    def window_end(self) -> dt.date:
        return self.prev

    @property
    def rt_end(self) -> dt.date:
        return self.plus(self.p.rt_days)


def as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))
