from shelfwise.sources.exports import TABLES, read_all, read_raw
from shelfwise.sources.row_ids import with_row_ids

__all__ = ["TABLES", "read_all", "read_raw", "with_row_ids"]
