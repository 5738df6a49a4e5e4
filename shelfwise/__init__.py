"""shelfwise: stock-buffer and replenishment analytics as Spark DataFrame jobs.

Layout
- ``params``      fixed parameters of the model (frozen dataclass)
- ``schema``      key columns and the declared state-table schemas
- ``functions``   column-level helpers that pin the dialect semantics
- ``sources``     table readers, the state store, the test-table mapping
- ``operators``   the domain operators (decision, init, roll-forward, allocation, report)
- ``plans``       the daily job, the backfill and the query registry
- ``streaming``   (empty on purpose: the model is a daily batch workload)
"""

from shelfwise.params import Params, DEFAULT_PARAMS  # noqa: F401
