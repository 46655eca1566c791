"""Per-group profile: means and category counts in a single aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.functions.means import exact_mean, half_up_mean, rounded_mean, to_units
from starlane.operators.lookup import conform
from starlane.operators.shape import not_null


@dataclass(frozen=True)
class Mean:
    """The mean of a column, rounded half up to ``digits`` (unrounded if None).

    With ``units`` the values are summed exactly, as whole multiples of
    ``10**-units``; see :mod:`starlane.functions.means`.
    """

    column: str
    alias: str
    digits: int | None = None
    units: int | None = None

    @property
    def value(self) -> Column:
        return F.col(self.column) if self.units is None else to_units(self.column, self.units)

    def over_rows(self, weight: str | None = None) -> Column:
        """The mean over rows, each counted ``weight`` times if given."""
        if weight is not None:
            total = F.sum(self.value * F.col(weight))
            return self.of(total, F.sum(F.when(F.col(self.column).isNotNull(), F.col(weight))))
        if self.units is not None:
            return self.of(F.sum(self.value), F.count(self.column))
        return F.avg(self.column) if self.digits is None else rounded_mean(self.column, self.digits)

    def of(self, total: Column, count: Column) -> Column:
        """The mean from a sum of :attr:`value` and a count of values."""
        if self.units is not None:
            if self.digits is None:
                return exact_mean(total, count, self.units)
            return half_up_mean(total, count, self.units, self.digits)
        mean = total / F.nullif(count, F.lit(0))
        return mean if self.digits is None else F.round(mean, self.digits)


@dataclass(frozen=True)
class CountBy:
    """Row counts per category: ``labels`` maps each value to its output column.

    The output columns are fixed by ``labels``, whatever values the data holds; a
    value that is not listed gets no column. Numeric codes compare as numbers, so
    1 and 1.0 are the same category.
    """

    column: str
    labels: Mapping[object, str]


def category_counts(counts: CountBy, fill_zero: bool = False, weight: str | None = None) -> list[Column]:
    """One aggregate per category; NULL (or 0 with ``fill_zero``) where none occurs."""
    cells = []
    for value, label in counts.labels.items():
        hit = F.col(counts.column) == F.lit(value)
        if weight is None:
            n = F.count_if(hit)
        else:
            n = F.sum(F.when(hit, F.col(weight)).otherwise(F.lit(0).cast("bigint")))
        cells.append((n if fill_zero else F.nullif(n, F.lit(0).cast("bigint"))).alias(label))
    return cells


def pivot_count(df: DataFrame, keys: Sequence[str], counts: CountBy, fill_zero: bool = False) -> DataFrame:
    """Count rows per key and category, one column per category.

    Conditional counts need one shuffle of one row per key, where a pivot also
    groups by the category first.
    """
    return df.groupBy(*keys).agg(*category_counts(counts, fill_zero))


def fold_codes(codes: DataFrame, keys: Sequence[str], take: Sequence[str], weight: str) -> DataFrame:
    """A lookup with equal entries merged into one that says how many there were.

    A code listed a thousand times then meets each row once, with weight 1000,
    instead of producing a thousand copies of the row only to count them.
    """
    columns = list(dict.fromkeys([*keys, *take]))
    return codes.groupBy(*columns).agg(F.count(F.lit(1)).alias(weight))


def profile(
    df: DataFrame,
    keys: Sequence[str],
    means: Sequence[Mean],
    counts: Sequence[CountBy],
    required: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Means and category counts per key, over the rows that have all ``required`` columns.

    One scan, one partial aggregation per task, one shuffle of a row per key and
    task: a key with a third of all rows is no heavier to merge than any other.
    ``weight`` names a column that says how many rows each row stands for.
    """
    rows = not_null(df, required) if required else df
    cells = [m.over_rows(weight).alias(m.alias) for m in means]
    for c in counts:
        cells += category_counts(c, weight=weight)
    return rows.groupBy(*keys).agg(*cells)


def profile_preaggregated(
    df: DataFrame,
    codes: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str],
    keys: Sequence[str],
    means: Sequence[Mean],
    counts: Sequence[CountBy],
    required: Sequence[str] = (),
) -> DataFrame:
    """``profile(conform(df, codes, on, take), keys, …)``, aggregated before the join.

    For a lookup too large to broadcast, over rows that repeat few codes often.
    Rows are first summed per code (and period) and equal lookup entries folded, so
    the join moves one row per code instead of every input row, a hot code shrinks
    inside each task, and no pair of a hot row and a hot entry is ever formed. A
    code listed twice still counts twice. Where nearly every row has its own code
    this saves nothing; join first there.
    """
    local = [k for k in keys if k not in take]
    base = list(dict.fromkeys([*on.values(), *local]))
    summed = presum(df, base, means, counts, required)
    kept = [n for n in summed.columns if n not in on.values() or n in local]
    folded = fold_codes(codes, list(on), take, "__weight")
    return profile_sums(conform(summed, folded, on, [*take, "__weight"], keep=kept), keys, means, counts, "__weight")


def presum(
    df: DataFrame, by: Sequence[str], means: Sequence[Mean], counts: Sequence[CountBy], required: Sequence[str] = ()
) -> DataFrame:
    """What a profile is made of, one row per ``by``: sums and counts, which add up.

    Such rows can be kept, added to rows of other files, and joined with lookups before
    :func:`profile_sums` makes the profile. ``n_rows`` is the number of rows.
    """
    rows = not_null(df, required) if required else df
    cells = [F.count(F.lit(1)).alias("n_rows")]
    for m in means:
        cells += [F.sum(m.value).alias(f"__sum_{m.alias}"), F.count(m.column).alias(f"__n_{m.alias}")]
    for c in counts:
        cells += category_counts(c, fill_zero=True)
    return rows.groupBy(*by).agg(*cells)


def profile_sums(
    summed: DataFrame, keys: Sequence[str], means: Sequence[Mean], counts: Sequence[CountBy], weight: str | None = None
) -> DataFrame:
    """The profile per ``keys`` from rows of :func:`presum`, each counted ``weight`` times if given."""

    def total(name: str) -> Column:
        part = F.col(f"`{name}`")
        return F.sum(part if weight is None else part * F.col(weight))

    cells = [m.of(total(f"__sum_{m.alias}"), total(f"__n_{m.alias}")).alias(m.alias) for m in means]
    for c in counts:
        cells += [F.nullif(total(label), F.lit(0).cast("bigint")).alias(label) for label in c.labels.values()]
    return summed.groupBy(*keys).agg(*cells)
