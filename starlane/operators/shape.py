"""Row-level filters, unions, previews and counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every named column has a value.

    Written as one condition per column because each of those is pushed into a
    Parquet scan, which ``dropna`` is not.
    """
    return df.filter(reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in columns]))


def is_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which ``column`` is missing."""
    return df.filter(F.col(column).isNull())


def union_rows(*tables: DataFrame) -> DataFrame:
    """UNION ALL of any number of tables, matched by column name.

    Types widen where they differ. For many files of one layout prefer
    :func:`starlane.sources.readers.read_many`, which plans a single scan.
    """
    if not tables:
        raise ValueError("union_rows needs at least one table")
    return reduce(DataFrame.unionByName, tables)


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows by ``order``; each task keeps at most ``n`` of them."""
    return df.orderBy(*order).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
