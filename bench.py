"""Benchmark: headline operators and the daily job on the test tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Each query is timed as a full execution to a no-op
sink (every row computed), median of BENCH_REPEAT warm runs after one
warm-up.  The derived domain tables (``setup``), the state of day D that
the allocation queries read (``snapshot``) and the latest state rows that the
daily job keeps up (``current_state``: the whole history once, and one day) are
stored once, as they would be in production, and timed by themselves.  The daily job (T22: decision, init/roll,
allocation with partition writes) and a 3-day backfill (T23) are timed on a
fresh state store.  The value is the sum of all of these; ``shuffle_mb`` has
the shuffle bytes written by one run of each, from Spark's event log.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "candidate_keys", "day_zones", "zone_coverage", "demand_target", "demand_target_sparse",
    "calc_keys", "first_init", "roll_forward", "rebase", "buffer_main_day",
    "lane_capacity", "truck_fill", "planning_report", "latest_state", "latest_state_scan", "ring_decision", "oos_from_runs",
]


def shuffle_mb(folder: str, runs: dict) -> dict:
    """MB of shuffle written per run of each job group in the event log."""
    group, total = {}, {}
    for name in os.listdir(folder):
        path = os.path.join(folder, name)
        for f in [path] if os.path.isfile(path) else [os.path.join(path, x) for x in os.listdir(path)]:
            with open(f, errors="replace") as lines:
                for line in lines:
                    if '"SparkListenerStageSubmitted"' in line:
                        e = json.loads(line)
                        group[e["Stage Info"]["Stage ID"]] = e.get("Properties", {}).get("spark.jobGroup.id")
                    elif '"SparkListenerTaskEnd"' in line:
                        e = json.loads(line)
                        n = e.get("Task Metrics", {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                        g = group.get(e["Stage ID"])
                        total[g] = total.get(g, 0) + n
    return {k: round(total.get(k, 0) / 1e6 / n, 2) for k, n in runs.items()}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    events = tempfile.mkdtemp(prefix="bench-events-", dir="/tmp")
    from shelfwise.session import local_session
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus), conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false", "spark.eventLog.buffer.kb": "1k"})
    from shelfwise.plans.daily import backfill, run_day, seed_store
    from shelfwise.plans.registry import QUERIES, _current, _snapshot
    from shelfwise.sources.fixtures import AS_OF, stored_fixture_tables
    from shelfwise.sources.state import StateStore

    times, runs = {}, {}

    def timed(name, f):
        spark.sparkContext.setJobGroup(name, name)
        s = time.time()
        out = f()
        runs[name] = runs.get(name, 0) + 1
        return time.time() - s, out

    times["setup"], base = timed("setup", lambda: stored_fixture_tables(spark, sf_dir))
    times["snapshot"], _ = timed("snapshot", lambda: _snapshot(spark, sf_dir))
    times["current_state"], _ = timed("current_state", lambda: _current(spark, sf_dir))
    for name in HEADLINE:
        def run(name=name):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timed(name, run)
        times[name] = statistics.median(timed(name, run)[0] for _ in range(repeat))

    store = StateStore(spark, tempfile.mkdtemp(prefix="bench-state-", dir="/tmp"))
    timed("seed", lambda: seed_store(store, base, AS_OF, since=AS_OF - dt.timedelta(days=30)))
    times["daily_job"], _ = timed("daily_job", lambda: run_day(base, store, AS_OF))
    times["backfill_3_days"], _ = timed("backfill_3_days", lambda: backfill(
        base, store, AS_OF + dt.timedelta(days=1), AS_OF + dt.timedelta(days=3)))
    spark.stop()

    times = {k: round(v, 3) for k, v in times.items()}
    print(json.dumps({"metric": "sum_of_median_query_job_and_setup_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "queries_only": round(sum(times[k] for k in HEADLINE), 3), "cpus": cpus, "repeat": repeat,
                      "shuffle_mb": shuffle_mb(events, runs)}))


if __name__ == "__main__":
    main()
