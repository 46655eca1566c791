"""Year and month columns, and year filters a Parquet scan can prune on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_calendar(
    df: DataFrame, date_column: str, year: str = "year", month: str = "month"
) -> DataFrame:
    """Add integer ``year`` and ``month`` columns taken from a date or timestamp."""
    return df.withColumns({year: F.year(date_column), month: F.month(date_column)})


def within_years(date_column: str, years: Iterable[int], kind: str = "date") -> Column:
    """Rows whose date falls in one of ``years``.

    A filter on ``year(date)`` alone never reaches the scan. The plain range on
    the raw column does, so files and row groups outside the span are skipped;
    ``kind`` is the column's own type (``date``, ``timestamp_ntz`` …), which keeps
    a cast from getting between the column and the pushed filter.
    """
    wanted = sorted(set(years))
    if not wanted:
        raise ValueError("within_years needs at least one year")
    date = F.col(date_column)
    span = (date >= F.lit(f"{wanted[0]:04d}-01-01").cast(kind)) & (
        date < F.lit(f"{wanted[-1] + 1:04d}-01-01").cast(kind)
    )
    gapless = wanted[-1] - wanted[0] + 1 == len(wanted)
    return span if gapless else span & F.year(date).isin(wanted)
