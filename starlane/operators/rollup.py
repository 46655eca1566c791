"""Build a dimension from entity rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.operators.dedup import dedup_first


def build_dimension(
    df: DataFrame,
    entity: Sequence[str],
    keys: Mapping[str, str],
    measures: Sequence[Column],
    uses: Sequence[str],
    primary: str,
    order: Sequence[str] = (),
) -> DataFrame:
    """Reduce to one row per entity, roll up, and keep one row per primary key.

    ``keys`` maps grouping columns to their names in the dimension, ``measures``
    are aliased aggregates over the columns in ``uses``. Everything else is cut
    off before the first shuffle.
    """
    entity, order = list(entity), list(order)
    needed = list(dict.fromkeys([*entity, *order, *keys, *uses]))
    entities = dedup_first(df.select(*[f"`{c}`" for c in needed]), entity, order)
    rolled = entities.groupBy(*[F.col(f"`{k}`").alias(name) for k, name in keys.items()]).agg(*measures)
    return dedup_first(rolled, [primary], [n for n in keys.values() if n != primary]).orderBy(primary)
