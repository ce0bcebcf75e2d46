from shoptide.functions.columns import (
    age_at,
    doc_id,
    epoch_ms,
    mask_phone,
    minute_of,
    money,
    money_sum,
    percent,
    tokens,
    with_log_time,
    with_order_time,
)

__all__ = [
    "age_at",
    "doc_id",
    "epoch_ms",
    "mask_phone",
    "minute_of",
    "money",
    "money_sum",
    "percent",
    "tokens",
    "with_log_time",
    "with_order_time",
]
