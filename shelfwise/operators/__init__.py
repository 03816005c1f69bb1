from shelfwise.operators.ageing import age_stock, asof_series, last_movement, stock_ageing
from shelfwise.operators.quality import (
    assert_conserved, key_violations, observed, quality_report, row_conservation,
)
from shelfwise.operators.reshape import plan_headers, unpivot_balance
from shelfwise.operators.staging import conform, stage_movement, stage_product, stage_sales

__all__ = [
    "age_stock", "asof_series", "assert_conserved", "conform", "key_violations", "last_movement",
    "observed", "plan_headers", "quality_report", "row_conservation", "stage_movement",
    "stage_product", "stage_sales", "stock_ageing", "unpivot_balance",
]
