from indexloom.functions.columns import (
    MONEY,
    clean_count,
    clean_money,
    has_code,
    lenient_number,
    null_if_zero,
    pct_change,
    real_change,
    rolled_forward,
    zero_pad,
)
from indexloom.functions.sums import stable_sum

__all__ = [
    "MONEY",
    "clean_count",
    "clean_money",
    "has_code",
    "lenient_number",
    "null_if_zero",
    "pct_change",
    "real_change",
    "rolled_forward",
    "stable_sum",
    "zero_pad",
]
