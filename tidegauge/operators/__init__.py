"""Operators on tables of ticks; each returns a DataFrame."""

from .activity import inactive_keys, latest_by_key, latest_per_tick
from .averages import adaptive_average, last_averages, running_averages, tick_advice, window_advice, window_averages
from .blockscan import block_average
from .over_windows import over_windows, window_drawdown
from .skew import SkewPolicy
from .windows import in_windows, window_average_row, window_count, window_rows, window_sum

__all__ = [
    "SkewPolicy",
    "adaptive_average",
    "block_average",
    "in_windows",
    "inactive_keys",
    "last_averages",
    "latest_by_key",
    "latest_per_tick",
    "over_windows",
    "running_averages",
    "tick_advice",
    "window_advice",
    "window_average_row",
    "window_averages",
    "window_count",
    "window_drawdown",
    "window_rows",
    "window_sum",
]
