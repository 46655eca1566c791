"""Fill missing periods of a year from the same periods of other years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlane.operators.exact import profile_exact
from starlane.operators.profile import Mean
from starlane.operators.shape import union_rows

#: Rows that repeat one reading are made in arrays of at most this many.
BLOCK = 4096


def donor_mean(
    df: DataFrame,
    entity: Sequence[str],
    value: Mean,
    target_year: int,
    donor_years: Sequence[int],
    months: Sequence[int],
    year: str = "year",
    month: str = "month",
    exact: bool = False,
) -> DataFrame:
    """One row per entity and month: the mean over the donor years, dated ``target_year``.

    With ``exact`` the sums are error-free, see :mod:`starlane.operators.exact`.
    """
    donors = df.filter(F.col(year).isin(list(donor_years)) & F.col(month).isin(list(months)))
    keys = [*entity, month]
    means = profile_exact(donors, keys, [value]) if exact else donors.groupBy(*keys).agg(value.over_rows().alias(value.alias))
    return means.select(*entity, value.alias, month, F.lit(target_year).alias(year))


def impute_periods(
    df: DataFrame,
    entity: Sequence[str],
    value: Mean,
    target_year: int,
    donor_years: Sequence[int],
    months: Sequence[int],
    year: str = "year",
    month: str = "month",
    only_missing: bool = False,
    exact: bool = False,
) -> DataFrame:
    """The target year's rows as observed, plus a donor mean for each listed month.

    Observed rows pass through unchanged, a NULL reading included. A donor mean is
    added even if the month has been observed; ``only_missing`` leaves those out.
    ``exact`` is that of :func:`donor_mean`, and reads ``df`` twice; otherwise it is
    read once, see :func:`fold_periods`.
    Filter ``df`` with :func:`starlane.functions.calendar.within_years` on its raw
    date first, so that the scan skips all other years.
    """
    entity = list(entity)
    if not exact:
        folded = fold_periods(df, entity, value, target_year, donor_years, months, year, month)
        return unfold_periods(folded, entity, value.alias, month, year, only_missing)
    observed = df.filter(F.col(year) == F.lit(target_year)).select(
        *entity, F.col(value.column).alias(value.alias), month, year
    )
    filled = donor_mean(df, entity, value, target_year, donor_years, months, year, month, exact)
    if only_missing:
        filled = filled.join(observed.select(*entity, month).distinct(), [*entity, month], "left_anti")
    return union_rows(observed, filled.select(observed.columns))


def fold_periods(
    df: DataFrame,
    entity: Sequence[str],
    value: Mean,
    target_year: int,
    donor_years: Sequence[int],
    months: Sequence[int],
    year: str = "year",
    month: str = "month",
) -> DataFrame:
    """Observed and donor values of each entity and month, from one scan and one aggregation.

    One row per entity, month and distinct observed value with the count ``__times`` of its
    rows, and one per entity and month with the mean of its donors, where ``__times`` is NULL.
    Equal readings fold inside each task, so a reading that fills a third of the table is
    one row per task in the shuffle. A target year that is its own donor plays both parts.
    A reading of -0.0 is 0.0 afterwards, as in any grouping.
    """
    is_target, of = F.col(year) == F.lit(target_year), F.col(value.column)
    is_donor = F.col(year).isin(list(donor_years)) & F.col(month).isin(list(months))
    used = df.filter(is_target | is_donor)
    if target_year in donor_years:
        used = used.withColumn("__parts", F.when(is_target & is_donor, F.array(F.lit(True), F.lit(False))).otherwise(F.array(is_target)))
        used = used.withColumn("__observed", F.explode("__parts"))
    else:
        used = used.withColumn("__observed", is_target)
    seen = F.when(F.col("__observed"), of).alias("__seen")
    rows = used.select(*entity, month, "__observed", seen, F.when(~F.col("__observed"), of).alias(value.column))
    folded = rows.groupBy(*entity, month, "__observed", "__seen").agg(
        value.over_rows().alias("__mean"), F.count(F.lit(1)).alias("__times")
    )
    return folded.select(
        *entity,
        F.when(F.col("__observed"), F.col("__seen")).otherwise(F.col("__mean")).alias(value.alias),
        month,
        F.lit(target_year).alias(year),
        F.when(F.col("__observed"), F.col("__times")).alias("__times"),
    )


def unfold_periods(
    folded: DataFrame, entity: Sequence[str], alias: str, month: str = "month", year: str = "year", only_missing: bool = False
) -> DataFrame:
    """The rows behind :func:`fold_periods`: every observed one, and one per donor mean.

    Repeats come from two short arrays, so a reading that occurs a billion times makes none
    of that length. ``only_missing`` drops the donor means of observed months.
    """
    if only_missing:
        # The folded rows of a month are few, and its largest count tells whether it was observed.
        seen = F.max("__times").over(Window.partitionBy(*entity, month))
        folded = folded.withColumn("__any", seen).filter(F.col("__times").isNotNull() | F.col("__any").isNull())
    out = [*entity, alias, month, year]
    times = F.coalesce("__times", F.lit(1))
    blocks = folded.select(*out, times.alias("__times"), F.explode(F.sequence(F.lit(0), F.floor((times - 1) / BLOCK))).alias("__block"))
    left = F.least(F.lit(BLOCK), F.col("__times") - F.col("__block") * BLOCK).cast("int")
    return blocks.select(F.inline(F.array_repeat(F.struct(*out), left)))
