"""Benchmark every registered query.

Environment:
  BENCH_SF_DIR   test-data directory (default /root/testdata/sf0.1)
  BENCH_CPUS     local[N] threads (default 8)
  BENCH_RUNS     runs per query, first one cold (default 3)
  BENCH_QUERIES  optional comma-separated subset of keys
  BENCH_WARMUP   untimed JVM warm-up queries before timing (default 3, 0 = none)

Each run executes the full plan into Spark's ``noop`` sink (nothing is
collected to the driver). Per query the median of the runs is reported;
the headline value is the sum of the medians. Whole dashboard pages (tables
derived from shared aggregates) are timed the same way under ``pages``.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cinelake.session import build_session  # noqa: E402


# Untimed warm-up queries (a join + aggregate, a row-wise scan, a sort).
WARMUP = ["popular_titles", "clean_ratings", "catalog"]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    conf = {
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
    }
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="cinelake-bench", extra=conf)

    from cinelake.registry import REGISTRY

    queries = dict(REGISTRY)
    wanted = os.environ.get("BENCH_QUERIES")
    keys = [k for k in sorted(queries) if not wanted or k in wanted.split(",")]

    # JVM warm-up, untimed: the first seconds of a JVM compile Spark's hot
    # paths, which otherwise inflates whichever queries happen to run first.
    # First-run ("cold") times of every query are still reported below.
    for key in [k for k in WARMUP if k in queries][: int(os.environ.get("BENCH_WARMUP", "3"))]:
        try:
            _run(queries[key](spark, sf_dir))
        except Exception:  # noqa: BLE001 - a failing query is reported in the timed loop
            pass

    medians: dict[str, float] = {}
    cold: dict[str, float] = {}
    failed: dict[str, str] = {}
    for key in keys:
        times = []
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                _run(queries[key](spark, sf_dir))
                times.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 - report and continue
            failed[key] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        cold[key] = round(times[0], 3)
        medians[key] = round(statistics.median(times), 3)

    # Whole pages (several tables from shared aggregates), same protocol.
    from cinelake.plans.pages import analytics_page, front_page
    from cinelake.sources.adapters import app_tables, star

    def _analytics(spark_, sf):
        s = star(spark_, sf)
        return analytics_page(s.fact_rating, s.dim_movie, s.dim_user)

    def _front(spark_, sf):
        a = app_tables(spark_, sf)
        return front_page(a.movies, a.users, a.ratings)

    pages: dict[str, float] = {}
    if not wanted:
        for name, build in (("analytics_page", _analytics), ("front_page", _front)):
            times = []
            try:
                for _ in range(runs):
                    t0 = time.perf_counter()
                    for df in build(spark, sf_dir).values():
                        _run(df)
                    times.append(time.perf_counter() - t0)
            except Exception as e:  # noqa: BLE001
                failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
                continue
            pages[name] = round(statistics.median(times), 3)

    sf_name = os.path.basename(sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "cold": cold,
        "pages": pages,
        "sf": sf_name[2:] if sf_name.startswith("sf") else sf_name,
        "runs": runs,
        "cpus": cpus,
        "machine": platform.machine(),
        "spark": spark.version,
        "shuffle_partitions": 2 * cpus,
    }
    if failed:
        out["failed"] = failed
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
