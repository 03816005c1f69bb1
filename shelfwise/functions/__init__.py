from shelfwise.functions.ageing import (
    age_days, aging_bucket, aging_status, bucket_names, bucket_order, is_aged,
)
from shelfwise.functions.clean import (
    blank_str, clean_brand, clean_category, clean_channel, clean_product_no, clean_text, known,
    null_na, parse_date, quoted, strip_fields, strip_ws, to_number, to_whole, zero_filled,
)

__all__ = [
    "age_days", "aging_bucket", "aging_status", "blank_str", "bucket_names", "bucket_order",
    "clean_brand", "clean_category", "clean_channel", "clean_product_no", "clean_text", "is_aged",
    "known", "null_na", "parse_date", "quoted", "strip_fields", "strip_ws", "to_number",
    "to_whole", "zero_filled",
]
