"""Column expressions shared by the operators."""

from sluice.functions.arithmetic import safe_ratio
from sluice.functions.time import (
    local_time,
    minus_minutes,
    minutes_between,
    month_start,
    wall_clock,
    week_start,
)

__all__ = [
    "local_time",
    "minus_minutes",
    "minutes_between",
    "month_start",
    "safe_ratio",
    "wall_clock",
    "week_start",
]
