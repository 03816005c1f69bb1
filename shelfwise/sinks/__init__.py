from shelfwise.sinks.jdbc import load_table, load_all
from shelfwise.sinks.lake import csv_snapshot, current, publish, write_table

__all__ = ["csv_snapshot", "current", "load_all", "load_table", "publish", "write_table"]
