"""Expressions whose results must agree with the SQL oracle to the bit."""

from tierwise.functions.calendar import day_name, day_of_week, minutes_between
from tierwise.functions.numeric import (
    average,
    count_where,
    exact_sum,
    number,
    ratio,
    round2,
    round2_agg,
    sum2,
    whole,
)

__all__ = [
    "average",
    "count_where",
    "day_name",
    "day_of_week",
    "exact_sum",
    "minutes_between",
    "number",
    "ratio",
    "round2",
    "round2_agg",
    "sum2",
    "whole",
]
