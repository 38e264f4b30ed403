"""Text forms for a dashboard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_window(moment: Column) -> Column:
    """Wall-clock text without zone or fraction."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def display_number(value: Column, decimals: int = 2) -> Column:
    """Thousands separators and a fixed number of decimals."""
    return F.format_number(value, decimals)
