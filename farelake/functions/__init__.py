"""Column expressions whose results differ from the plain Spark function of the same name."""

from farelake.functions.scalars import (
    date_of,
    day_of_week,
    file_name,
    hour_of_day,
    interval_micros,
    longer_than,
    mean_from,
    month_start,
    round_half_away,
    seconds_between,
    split_list,
    to_int_half_even,
)

__all__ = [
    "date_of",
    "day_of_week",
    "file_name",
    "hour_of_day",
    "interval_micros",
    "longer_than",
    "mean_from",
    "month_start",
    "round_half_away",
    "seconds_between",
    "split_list",
    "to_int_half_even",
]
