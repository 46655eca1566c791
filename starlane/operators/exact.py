"""Profiles with error-free sums of doubles, the same bit for bit however rows are split.

A plain sum of doubles depends on the order in which tasks finish. Here each value is cut
into whole numbers of 24 bits at places that are multiples of 24 powers of two, and whole
numbers are summed. A first aggregation groups by the keys and the highest place of each
value, so a group has a row for every 24 powers of two its values span, 88 at most; a
second one adds these few rows, carrying from the lowest place to the highest. Both are
built-in aggregates with partial sums in each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.operators.profile import CountBy, Mean, category_counts
from starlane.operators.shape import not_null

#: Powers of two from one place to the next, and parts that hold every bit of a value.
PLACE, PARTS = 24, 4


def _shifted(value: Column, places: Column) -> Column:
    """A value times ``2**(PLACE * places)``, in two steps as one factor may not be a double."""
    factor = F.pow(F.lit(2.0), F.lit(PLACE // 2) * places)
    return value * factor * factor


def _place_of(value: Column) -> Column:
    """The place of a value's highest part. One too low or high is harmless: parts have bits to spare."""
    return F.when(value != 0, F.floor(F.log2(F.abs(value)) / F.lit(PLACE))).otherwise(F.lit(0)).cast("int")


def _parts(value: Column, place: Column) -> list[Column]:
    """Whole numbers at ``place`` and the places below it that add up to a value; each step is exact."""
    rest, parts = _shifted(value, -place), []
    for _ in range(PARTS):
        part = rest.cast("bigint")
        parts.append(part)
        rest = (rest - part.cast("double")) * F.lit(float(1 << PLACE))
    return parts


def _total(parts: Column) -> Column:
    """The sum of structs (place, n), read as ``n * 2**(PLACE * place)``; NULL if there are none.

    Carries go from the lowest place to the highest, towards zero, and what stays behind is
    added from the lowest up, so only these last additions round.
    """
    ascending = F.array_sort(parts)
    start = F.struct(ascending[0]["place"].alias("place"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("below"))

    def add(sum_: Column, part: Column) -> Column:
        gap = part["place"] - sum_["place"]
        # Beyond two places all of it stays below.
        unit = F.pow(F.lit(2.0), F.lit(PLACE) * F.least(gap, F.lit(2))).cast("bigint")
        carry = F.when(gap > 2, F.lit(0).cast("bigint")).otherwise(F.call_function("div", sum_["n"], unit))
        left = _shifted((sum_["n"] - carry * unit).cast("double"), sum_["place"])
        return F.struct(part["place"].alias("place"), (carry + part["n"]).alias("n"), (sum_["below"] + left).alias("below"))

    def value(sum_: Column) -> Column:
        return _shifted(sum_["n"].cast("double"), sum_["place"]) + sum_["below"]

    return F.when(F.size(parts) > 0, F.aggregate(ascending, start, add, value))


def profile_exact(
    df: DataFrame, keys: Sequence[str], means: Sequence[Mean], counts: Sequence[CountBy] = (), required: Sequence[str] = ()
) -> DataFrame:
    """:func:`~starlane.operators.profile.profile` with error-free sums for the means.

    NULL values do not count, a group without values has a NULL mean, infinite values and NaN
    give what they give in a plain mean, and a sum beyond all doubles is infinite. A group
    may have 2**38 values in a place; more raise, as bigint sums do. The means' ``units`` are not needed.
    """
    rows = not_null(df, required) if required else df
    by, cells, again, out = [], [F.count(F.lit(1)).alias("__rows")], [], []
    for i, m in enumerate(means):
        value = F.col(m.column).cast("double")
        finite = (F.abs(value) < F.lit(float("inf"))) & ~F.isnan(value)
        plain = F.when(finite, value)
        rows = rows.withColumn(f"__place_{i}", _place_of(plain))
        place = F.col(f"__place_{i}")
        by.append(f"__place_{i}")
        cells += [F.sum(part).alias(f"__part_{i}_{j}") for j, part in enumerate(_parts(plain, place))]
        cells += [F.count(value).alias(f"__n_{i}"), F.sum(F.when(~finite, value)).alias(f"__odd_{i}")]
        found = F.array(*[F.struct((place - j).alias("place"), F.col(f"__part_{i}_{j}").alias("n")) for j in range(PARTS)])
        # One entry for each combination of places, not for each row.
        again += [
            F.flatten(F.collect_list(F.when(F.col(f"__part_{i}_0").isNotNull(), found))).alias(f"__parts_{i}"),
            F.sum(f"__n_{i}").alias(f"__n_{i}"), F.sum(f"__odd_{i}").alias(f"__odd_{i}"),
        ]
        total = F.coalesce(F.col(f"__odd_{i}"), _total(F.col(f"__parts_{i}")))
        out.append(Mean(m.column, m.alias, m.digits).of(total, F.col(f"__n_{i}")).alias(m.alias))
    for c in counts:
        cells += category_counts(c, fill_zero=True)
        again += [F.sum(f"`{label}`").alias(label) for label in c.labels.values()]
        out += [F.nullif(F.col(f"`{label}`"), F.lit(0).cast("bigint")).alias(label) for label in c.labels.values()]
    places = rows.groupBy(*keys, *by).agg(*cells)
    return places.groupBy(*keys).agg(F.sum("__rows").alias("__rows"), *again).select(*keys, *out)
