"""Star-join reports in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The columns the two standard reports show.
VISA_MIX = ("business", "pleasure", "student", "average_temperature")
GENDER_MIX = ("F", "M", "U", "X", "average_temperature")


def category_mix_report(
    spark: SparkSession, fact: DataFrame, dimension: DataFrame, key: str, entity: object, columns: Sequence[str]
) -> DataFrame:
    """Chosen columns by month for one entity of the dimension.

    The entity filter is pushed into the scans of both tables.
    """
    shown = ", ".join(f"fact.`{c}`" for c in columns)
    return spark.sql(
        f"""
        SELECT fact.month, {shown}
        FROM {{fact}} AS fact JOIN {{dimension}} AS dim ON fact.`{key}` = dim.`{key}`
        WHERE fact.`{key}` = :entity
        ORDER BY fact.month
        """,
        args={"entity": entity},
        fact=fact,
        dimension=dimension,
    )


def register_views(spark: SparkSession, **tables: DataFrame) -> None:
    """Expose tables to ``spark.sql`` under the given names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
