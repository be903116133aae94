"""Command line: ``python -m cinelake <command> ...``.

Commands
--------
``load``      lake CSV → warehouse (``--policy warehouse``) or app tables
              (``--policy app``), then the mart views; prints row counts.
``reset``     drop and recreate the warehouse database (engine-created only).
``vacuum``    drop table versions no longer current (keeps ``--keep`` newest).
``report``    the analytical reports over the loaded warehouse: most popular
              titles, best primary genres, most active countries, and the
              analytics page (five tables from two shared aggregates).

The master, shuffle partitions and ``spark.checkpoint.dir`` come from the
launcher (``spark-submit``) or the environment; nothing here assumes a
machine-local folder. Tables are registered in the session catalog, so
running ``load`` and ``report`` as separate applications needs a persistent
metastore (e.g. Hive support) configured by the launcher.
"""

from __future__ import annotations

import argparse
import json
import sys

from cinelake.fixed_values import TOP_COUNTRIES, TOP_GENRES, TOP_POPULAR
from cinelake.plans import analytics
from cinelake.plans.pages import analytics_page
from cinelake.plans.load import APP_POLICY, WAREHOUSE_POLICY, app_warehouse, load_lake, warehouse
from cinelake.session import build_session, staged_scope


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="cinelake")
    sub = ap.add_subparsers(dest="command", required=True)
    load = sub.add_parser("load")
    load.add_argument("--lake", required=True, help="folder with movies.csv, users.csv, ratings.csv")
    load.add_argument("--root", required=True, help="shared folder holding the table versions")
    load.add_argument("--policy", choices=["warehouse", "app"], default="warehouse")
    reset = sub.add_parser("reset")
    reset.add_argument("--root", required=True)
    vacuum = sub.add_parser("vacuum")
    vacuum.add_argument("--root", required=True)
    vacuum.add_argument("--keep", type=int, default=1)
    vacuum.add_argument("--policy", choices=["warehouse", "app"], default="warehouse")
    report = sub.add_parser("report")
    report.add_argument("--root", required=True)
    report.add_argument("--rows", type=int, default=0, help="print at most this many rows (0 = all)")
    return ap


def _print_reports(wh, rows: int) -> None:
    fact, movies, users = wh.table("fact_rating"), wh.table("dim_movie"), wh.table("dim_user")
    reports = {
        "popular_titles": analytics.popular(fact, movies, k=TOP_POPULAR),
        "best_genres": analytics.best_genres(fact, movies, k=TOP_GENRES),
        "active_countries": analytics.countries(fact, users, k=TOP_COUNTRIES),
    }
    # The analytics page: five tables from two shared aggregates.
    reports.update({f"page.{k}": v for k, v in analytics_page(fact, movies, users).items()})
    for name, df in reports.items():
        print(f"== {name}")
        # Fetched one partition at a time: some reports have a row per group.
        for r in (df.limit(rows) if rows else df).toLocalIterator():
            print(json.dumps(r.asDict(), default=str))


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session()
    if args.command == "load":
        if args.policy == "app":
            report = load_lake(spark, args.lake, app_warehouse(spark, args.root), APP_POLICY)
        else:
            report = load_lake(spark, args.lake, warehouse(spark, args.root), WAREHOUSE_POLICY)
        print(json.dumps(report.counts))
    elif args.command == "reset":
        warehouse(spark, args.root).reset()
    elif args.command == "vacuum":
        wh = app_warehouse(spark, args.root) if args.policy == "app" else warehouse(spark, args.root)
        print(json.dumps(wh.vacuum(keep=args.keep)))
    elif args.command == "report":
        with staged_scope(spark):
            _print_reports(warehouse(spark, args.root), args.rows)
    return 0


if __name__ == "__main__":
    sys.exit(main())
