"""Column-level helpers (all JVM-side Spark expressions)."""

from shelfwise.functions.semantics import (  # noqa: F401
    fill_defaults, safe_div, round_even, capped_ratio, in_range,
)
