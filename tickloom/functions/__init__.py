from tickloom.functions.display import display_number, display_window
from tickloom.functions.timeparts import (
    boundaries_between,
    dt_hour,
    hour_key,
    interval,
    parse_hour_key,
    unit_index,
    width_seconds,
)

__all__ = [
    "boundaries_between",
    "display_number",
    "display_window",
    "dt_hour",
    "hour_key",
    "interval",
    "parse_hour_key",
    "unit_index",
    "width_seconds",
]
