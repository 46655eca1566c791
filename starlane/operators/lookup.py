"""Inner equi-joins: conform codes to a dimension, enrich a fact, recombine aggregates.

No join carries a broadcast hint. Spark broadcasts a side only when its size, from
the file statistics or measured at run time, is below
``spark.sql.autoBroadcastJoinThreshold``; a larger lookup is shuffled and merged,
and AQE splits the partition of a key that holds a large share of the rows. Read a
lookup back from a written stage table so that its true size is known up front.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conform(
    rows: DataFrame,
    codes: DataFrame,
    on: Mapping[str, str | Column],
    take: Sequence[str],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Attach columns of a lookup table to the rows that have a match in it.

    ``on`` maps each key column of ``codes`` to a column of ``rows`` or to an
    expression over them; ``take`` names the lookup columns to attach and ``keep``
    the columns of ``rows`` to retain (all by default). Rows without a match, or
    with a NULL key, drop out. A code listed twice yields two rows per match;
    :func:`starlane.operators.quality.duplicate_keys` shows such codes.
    """
    keep = list(rows.columns if keep is None else keep)
    clash = set(keep) & set(take)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}; leave them out of keep or take")
    names = [f"__on_{i}" for i in range(len(on))]
    left = rows.select(
        *[F.col(f"`{c}`") for c in keep],
        *[(F.col(f"`{e}`") if isinstance(e, str) else e).alias(n) for n, e in zip(names, on.values())],
    )
    right = codes.select(
        *[F.col(f"`{c}`") for c in take],
        *[F.col(f"`{c}`").alias(n) for n, c in zip(names, on)],
    )
    return left.join(right, names, "inner").select(*[f"`{c}`" for c in [*keep, *take]])


def enrich(fact: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add the columns of ``other`` to a fact on equally named keys.

    The keys may be only part of the fact's own key (month without year, say);
    they have to be unique in ``other``, or fact rows multiply.
    """
    return fact.join(other, list(on), "inner")


def recombine(keys: Sequence[str], *parts: DataFrame) -> DataFrame:
    """Join aggregates of one table back together on their common group keys.

    Each part is already partitioned by ``keys`` after its ``groupBy``, so the
    joins add no exchange. A single :func:`~starlane.operators.profile.profile`
    reads the table once instead of once per part.
    """
    if not parts:
        raise ValueError("recombine needs at least one part")
    return reduce(lambda a, b: a.join(b, list(keys), "inner"), parts)
