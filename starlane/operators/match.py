"""Lookups that account for the rows they lose."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.sources.sinks import write_stage

BUCKET_BITS = 32_768


@dataclass(frozen=True)
class Matched:
    """Rows that met an entry of a lookup, and those that met none, from one join."""

    rows: DataFrame
    unmatched: DataFrame


def match(
    rows: DataFrame,
    codes: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str],
    folder: str,
    mode: str = "errorifexists",
) -> Matched:
    """:func:`starlane.operators.lookup.conform` that keeps the rows without a match, too.

    Both parts come from one left join, which is written as a stage and read back. A NULL
    key matches nothing. Meant for rows that were summed per key first
    (:func:`starlane.operators.profile.presum`): then the stage is small, and what is
    unmatched has its counts by key.
    """
    clash = set(rows.columns) & set(take)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    names = [f"__on_{i}" for i in range(len(on))]
    left = rows.withColumns({n: F.col(f"`{c}`") for n, c in zip(names, on.values())})
    right = codes.select(*[F.col(f"`{c}`") for c in take], *[F.col(f"`{c}`").alias(n) for n, c in zip(names, on)], F.lit(1).alias("__met"))
    joined = left.join(right, names, "left").drop(*names).withColumn("__met", F.coalesce("__met", F.lit(0)))
    staged = write_stage(joined, folder, mode=mode)
    return Matched(staged.where("__met = 1").drop("__met"), staged.where("__met = 0").select(*[f"`{c}`" for c in rows.columns]))


def unmatched_counts(rows: DataFrame, codes: DataFrame, on: Mapping[str, str], count: str = "n") -> DataFrame:
    """Per key of ``rows`` that the lookup lacks (NULL, too): how many rows have it.

    Rows are counted per key inside each task first, so the join sees each key once.
    """
    counted = rows.groupBy(*[F.col(f"`{c}`").alias(n) for n, c in on.items()]).agg(F.count(F.lit(1)).alias(count))
    known = codes.select(*[F.col(f"`{c}`") for c in on])
    return counted.join(known, list(on), "left_anti")


def key_filter(codes: DataFrame, on: Mapping[str, str], most_bits: int = 1 << 20) -> Column:
    """A condition that no row with a match fails, and most rows without one do: a Bloom filter.

    The keys of the lookup are hashed to a table of ``most_bits`` bits, which is all that
    comes to the driver and is part of the plan; 2^20 bits are 128 kB. The condition is an
    ordinary filter above the scan, so rows without a match are not shuffled for the join.
    A lookup whose keys fill more than half of the bits filters little: then the condition is
    true for all rows. A NULL key fails.
    """
    buckets = -(-most_bits // BUCKET_BITS)
    bits = buckets * BUCKET_BITS
    kinds = dict(codes.dtypes)

    def slot(keys: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(bits))

    def complete(keys: Sequence[Column]) -> Column:
        out = F.lit(True)
        for k in keys:
            out = out & k.isNotNull()
        return out

    own = [F.col(f"`{c}`") for c in on]
    slots = codes.where(complete(own)).select(slot(own).alias("slot"))
    maps = slots.groupBy((F.col("slot") / BUCKET_BITS).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("slot") % BUCKET_BITS).alias("bitmap")
    )
    found = maps.select("bucket", "bitmap", F.bitmap_count("bitmap").alias("n")).collect()
    keys = [F.col(f"`{c}`").cast(kinds[n]) for n, c in on.items()]
    if 2 * sum(r["n"] for r in found) > bits:
        return complete(keys)
    by_bucket = {r["bucket"]: bytes(r["bitmap"]) for r in found}
    table = F.array(*[F.lit(by_bucket.get(b, b"\0")) for b in range(buckets)])
    at = slot(keys)
    byte = F.substring(F.get(table, (at / BUCKET_BITS).cast("int")), (at % BUCKET_BITS / 8).cast("int") + 1, F.lit(1))
    number = F.coalesce(F.conv(F.hex(byte), 16, 10).cast("int"), F.lit(0))
    return complete(keys) & (F.getbit(number, (at % 8).cast("int")) == 1)
