"""Refresh: spark-submit refresh.py --src <raw folder> --dst <published folder>

Reads the four exports and publishes staged tables, quality report and all reports as one version.
With --incremental only changed months and buckets are written, into a folder laid out for that.
"""

from __future__ import annotations

import argparse
import datetime
import logging
import os
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwise import schemas as S  # noqa: E402
from shelfwise.plans.dashboards import gold_tables  # noqa: E402
from shelfwise.plans.incremental import run_incremental  # noqa: E402
from shelfwise.plans.refresh import run_refresh  # noqa: E402
from shelfwise.sinks import jdbc, lake  # noqa: E402


def _pair(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    return key, value


def _page(text: str) -> tuple[str, dict]:
    name, categories = _pair(text)
    return name, {"categories_in": [c.strip().upper() for c in categories.split(",")]}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--src", required=True)
    args.add_argument("--dst", required=True)
    args.add_argument("--run-date", type=datetime.date.fromisoformat, default=None,
                      help="as-of date of the ageing, YYYY-MM-DD (default: today)")
    args.add_argument("--format", choices=["csv", "parquet", "table"], default="csv")
    args.add_argument("--house-category", default=S.HOUSE_CATEGORY)
    args.add_argument("--aging-threshold-days", type=int, default=S.AGED_DAYS)
    args.add_argument("--snapshots", action="store_true", help="also write CSV copies")
    args.add_argument("--no-gold", action="store_true", help="staged tables only")
    args.add_argument("--jdbc-url", help="also load the staged tables into this database")
    args.add_argument("--as-of-strict", action="store_true",
                      help="leave out movements after the run date")
    args.add_argument("--safe-keys", action="store_true",
                      help="keep placeholder numbers of log and sheet apart in the ageing join")
    args.add_argument("--csv-option", type=_pair, action="append", default=[], metavar="KEY=VALUE",
                      help="option of the CSV reader, such as multiLine=true; may repeat")
    args.add_argument("--page", type=_page, action="append", default=[], metavar="NAME=CATEGORY,...",
                      help="a segment page over some categories; may repeat")
    args.add_argument("--incremental", action="store_true",
                      help="write only the months and buckets that differ from the last version")
    args.add_argument("--keep", type=int, help="versions to keep; older ones are removed")
    args.add_argument("--max-rejected", type=float, default=0.0, metavar="SHARE",
                      help="share of an export's rows that may be set aside instead of staged")
    args.add_argument("--jdbc-option", type=_pair, action="append", default=[],
                      metavar="KEY=VALUE", help="such as user, password, driver; may repeat")
    opts = args.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    run_date = opts.run_date or datetime.date.today()
    spark = spark or SparkSession.builder.appName("refresh").getOrCreate()

    def reports(staged):
        return gold_tables(staged, run_date, opts.house_category, pages=dict(opts.page))

    gold = None if opts.no_gold else reports
    ageing = dict(aging_threshold_days=opts.aging_threshold_days, as_of_strict=opts.as_of_strict,
                  safe_keys=opts.safe_keys)
    if opts.incremental:
        if opts.snapshots or opts.max_rejected or opts.jdbc_url:
            args.error("--incremental goes with none of --snapshots, --max-rejected, --jdbc-url")
        return run_incremental(spark, opts.src, opts.dst, run_date, opts.format,
                               opts.house_category, dict(opts.csv_option), gold,
                               keep=opts.keep, **ageing).version
    version = run_refresh(
        spark, opts.src, opts.dst, run_date, opts.format, opts.house_category, opts.snapshots,
        dict(opts.csv_option), gold, opts.max_rejected, opts.keep, **ageing)
    if opts.jdbc_url:
        staged = {name: lake.read_table(spark, lake.version_path(opts.dst, version, name))
                  for name in S.STAGED}
        jdbc.load_all(staged, opts.jdbc_url, dict(opts.jdbc_option) or None)
    return version


if __name__ == "__main__":
    main()
