"""P2 as an incremental refresh: only changed months and buckets are written."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise import schemas as S
from shelfwise.operators.ageing import KEYS, stock_ageing
from shelfwise.operators.quality import declared_keys, quality_report
from shelfwise.operators.staging import conform
from shelfwise.plans.refresh import refuse, stage_all
from shelfwise.sinks import parts
from shelfwise.sources.exports import read_all

log = logging.getLogger(__name__)

#: Parts of the tables that are not cut by month. Fixed once a folder is published.
BUCKETS = 16


def run_incremental(spark: SparkSession, src: str, dst: str, run_date: datetime.date,
                    fmt: str = "csv", house_category: str = S.HOUSE_CATEGORY,
                    options: dict | None = None,
                    reports: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None,
                    buckets: int = BUCKETS, keep: int | None = None, **ageing) -> parts.Manifest:
    """Read all, check, stage, and publish what differs from the last version.

    The exports are whole files, so they are read and staged in any case; what is saved is the
    writing, and, if the stock sheet, the log and the run date are as they were, the ageing join
    too. Sales and movements are cut by month, the others by a hash of their key. The tables are
    those that a full refresh publishes, with the same rows. With `keep`, parts that are in none
    of the last `keep` versions are removed.
    """
    raw = read_all(spark, src, fmt, row_ids="blank", options=options)
    report = quality_report(read_all(spark, src, fmt, row_ids=False, options=options))
    refuse(report)
    staged = stage_all(raw, run_date, house_category, **ageing)
    cuts = {
        "stg_product": parts.by_key(["Product No."], buckets),
        "stg_sales": parts.by_month("Date"),
        "stg_stock_balance": parts.by_key(KEYS, buckets),
        "stg_stock_movement": parts.by_month("Date"),
    }

    def aged(written: dict[str, DataFrame]) -> dict:
        balance = written["stg_stock_balance"].drop(parts.BUCKET)
        table = stock_ageing(balance, written["stg_stock_movement"], run_date, **ageing)
        return {"stg_stock_aging": (conform(table, S.STG_STOCK_AGING), cuts["stg_stock_balance"])}

    def reported(written: dict[str, DataFrame]) -> dict:
        dated = {n: written[n].drop(parts.BUCKET) for n in S.STAGED}
        made = {"key_check": declared_keys(dated), **(reports(dated) if reports else {})}
        facts = {"fact_sales": parts.by_month("date"),
                 "fact_stock_aging": parts.by_key(["product_no", "warehouse"], buckets)}
        return {n: (df, facts.get(n, parts.whole())) for n, df in made.items()}

    notes = {"run_date": str(run_date), **{k: str(v) for k, v in sorted(ageing.items())}}
    tables = {"quality_report": (report, parts.whole()),
              **{n: (staged[n], cut) for n, cut in cuts.items()}}
    m = parts.publish(spark, dst, tables, [aged, reported], notes)
    fresh = {n: sum(v == m.version for v, _, _ in t.parts.values()) for n, t in m.tables.items()}
    for name, n in fresh.items():
        log.info("%s: wrote %s of %s parts", name, n, len(m.tables[name].parts))
    if keep is not None:
        parts.vacuum(spark, dst, keep)
    return m
