"""Data quality checks: lazy counts of violations, and one place that raises.

A report has one row per rule and column: ``rule``, ``column``, ``violations``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlane.operators.shape import union_rows
from starlane.sources.contracts import TableContract
from starlane.sources.sinks import write_observed


class DataQualityError(Exception):
    """At least one rule was violated; the message lists all of them."""


def _line(rule: str, column: str, violations: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column"),
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
    )


def _count_rules(df: DataFrame, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Count the rows that break each rule, all rules in one pass over ``df``."""
    lines = F.array(*[_line(rule, column, F.count_if(broken)) for rule, column, broken in rules])
    return df.agg(lines.alias("lines")).select(F.inline("lines"))


def _null_rules(columns: Sequence[str]) -> list[tuple[str, str, Column]]:
    return [("not_null", c, F.col(f"`{c}`").isNull()) for c in columns]


def _length_rules(lengths: Mapping[str, int]) -> list[tuple[str, str, Column]]:
    return [("max_length", c, F.length(F.col(f"`{c}`")) > F.lit(n)) for c, n in lengths.items()]


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Report: missing values per column."""
    return _count_rules(df, _null_rules(columns))


def length_counts(df: DataFrame, required: Sequence[str], lengths: Mapping[str, int]) -> DataFrame:
    """Report: missing values in ``required`` and values longer than allowed."""
    return _count_rules(df, _null_rules(required) + _length_rules(lengths))


def _rows_per_key(df: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    if count in keys:
        raise ValueError(f"{count} is a key; choose another name for the count")
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(count))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return _rows_per_key(df, keys, count).filter(F.col(count) > 1)


def orphan_keys(fact: DataFrame, key: str, dim: DataFrame, dim_key: str, count: str = "n") -> DataFrame:
    """Values of ``key`` that the dimension lacks, with their row count.

    Fact rows are counted per key first, so the anti join sees each key once, how
    ever many rows it has. NULL refers to nothing and is no orphan.
    """
    used = _rows_per_key(fact.filter(F.col(key).isNotNull()), [key], count)
    known = dim.select(F.col(dim_key).alias(key))
    return used.join(known, key, "left_anti")


def audit(df: DataFrame, contract: TableContract, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Report on everything a table contract promises.

    ``tables`` holds the tables the contract refers to, by name.
    """
    rules = _null_rules(contract.required) + _length_rules(contract.lengths)
    reports = [_count_rules(df, rules)] if rules else []
    if contract.min_rows:
        short = df.agg(F.greatest(F.lit(contract.min_rows) - F.count(F.lit(1)), F.lit(0)).alias("short"))
        reports.append(short.select(_line("min_rows", "*", F.col("short")).alias("line")).select("line.*"))
    doubled = duplicate_keys(df, contract.key, "__n").agg(F.count(F.lit(1)).alias("bad"))
    reports.append(
        doubled.select(_line("unique_key", ",".join(contract.key), F.col("bad")).alias("line")).select("line.*")
    )
    for column, (table, target) in contract.references.items():
        if not tables or table not in tables:
            raise ValueError(f"{contract.name}.{column} refers to {table}, which was not given")
        lost = orphan_keys(df, column, tables[table], target, "__n").agg(F.sum("__n").alias("bad"))
        reports.append(lost.select(_line("foreign_key", column, F.col("bad")).alias("line")).select("line.*"))
    return union_rows(*reports)


Violation = tuple[str, str, int]


def write_checked(
    df: DataFrame, path: str, contract: TableContract, tables: Mapping[str, DataFrame] | None = None, **how: object
) -> tuple[DataFrame, list[Violation]]:
    """Write a stage and check its contract on the way; the stage, and a line per rule as in :func:`audit`.

    All rules are counted over the rows as they are written, so the stage is not read again.
    A key's rows are numbered, and each key with a second row is one violation; the tables
    referred to are joined by their distinct keys. Rows that are grouped by their key already
    are not shuffled for it.
    """
    marked, hidden, rules = df, [], [*_null_rules(contract.required), *_length_rules(contract.lengths)]
    for i, (column, (table, target)) in enumerate(contract.references.items()):
        if not tables or table not in tables:
            raise ValueError(f"{contract.name}.{column} refers to {table}, which was not given")
        mark, key = f"__known_{i}", f"__key_{i}"
        known = tables[table].select(F.col(f"`{target}`").alias(key)).distinct().withColumn(mark, F.lit(True))
        marked = marked.join(known, marked[column] == known[key], "left").drop(key)
        hidden.append(mark)
        rules.append(("foreign_key", column, F.col(f"`{column}`").isNotNull() & F.col(mark).isNull()))
    keys = [F.col(f"`{k}`") for k in contract.key]
    marked = marked.withColumn("__number", F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))
    rules.append(("unique_key", ",".join(contract.key), F.col("__number") == 2))
    counts = {str(i): F.count_if(broken) for i, (_, _, broken) in enumerate(rules)}
    written, seen = write_observed(marked, path, {"n": F.count(F.lit(1)), **counts}, [*hidden, "__number"], **how)
    lines = [(rule, column, seen[str(i)]) for i, (rule, column, _) in enumerate(rules)]
    if contract.min_rows:
        lines.append(("min_rows", "*", max(0, contract.min_rows - seen["n"])))
    return written, lines


def report_of(spark: SparkSession, lines: Sequence[Violation]) -> DataFrame:
    """Lines of a check as a report."""
    return spark.createDataFrame(list(lines), "rule string, column string, violations long")


def enforce(report: DataFrame | Sequence[Violation]) -> None:
    """Run the checks and raise if any rule is violated, naming every one.

    Only failed lines come to the driver, at most one per rule and column.
    """
    if isinstance(report, DataFrame):
        report = [tuple(r) for r in report.filter("violations > 0").collect()]
    failed = sorted(line for line in report if line[2] > 0)
    if failed:
        listing = "; ".join(f"{rule}({column}): {violations}" for rule, column, violations in failed)
        raise DataQualityError(f"{len(failed)} check(s) failed: {listing}")
