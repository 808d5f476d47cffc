from loadweave.functions.numeric import as_decimal, mean, pct, ratio, to_report_types
from loadweave.functions.temporal import (
    day_floor,
    hour_floor,
    minute_of_day,
    month_floor,
    seconds_between,
)

__all__ = [
    "as_decimal", "day_floor", "hour_floor", "mean", "minute_of_day",
    "month_floor", "pct", "ratio", "seconds_between", "to_report_types",
]
