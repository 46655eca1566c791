"""One row per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep one whole row per key: the least by ``order``, then by the other columns.

    Unlike ``dropDuplicates``, the pick does not depend on how the data is split.
    NULL sorts first, and NULL keys form one group. The minimum of a struct is an
    ordinary aggregate, so every map task ships at most one row per key and an
    entity that fills a third of the table costs no more than any other. Select
    the columns you need beforehand: the others would travel along.
    """
    keys, order = list(keys), list(order)
    ranked = [c for c in order if c not in keys] + [c for c in df.columns if c not in keys and c not in order]
    if not ranked:
        return df.distinct()
    least = F.min(F.struct(*[F.col(f"`{c}`") for c in ranked]))
    first = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(least.alias("__first"))
    return first.select(
        *[F.col(f"`{c}`") if c in keys else F.col(f"__first.`{c}`").alias(c) for c in df.columns]
    )
