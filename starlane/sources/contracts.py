"""Declared schemas of the raw inputs and contracts of the produced tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names, order and types of the raw files (public data sets).
CITY_DEMOGRAPHICS = """
    `City` string, `State` string, `Median Age` float, `Male Population` int,
    `Female Population` int, `Total Population` int, `Number of Veterans` int,
    `Foreign Born` int, `Average Household Size` float, `State Code` string,
    `Race` string, `Count` int
"""
# Another spelling of a column in the header of the published file.
CITY_ALIASES = {"Foreign Born": "Foreign-born"}
STATE_TEMPERATURE = """
    dt date, AverageTemperature float, AverageTemperatureUncertainty float,
    State string, Country string
"""
AIRPORT_CODES = """
    ident string, type string, name string, elevation_ft int, continent string,
    iso_country string, iso_region string, municipality string, gps_code string,
    iata_code string, local_code string, coordinates string
"""
ARRIVALS = """
    i94yr double, i94mon double, i94port string, i94bir double, i94visa double,
    gender string
"""


@dataclass(frozen=True)
class TableContract:
    """What a produced table promises: columns in order, keys, and references."""

    name: str
    columns: str
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    min_rows: int = 0

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def lengths(self) -> dict[str, int]:
        """Longest allowed value per varchar column."""
        return {f.name: f.dataType.length for f in self.schema if isinstance(f.dataType, T.VarcharType)}


# Layout, key and reference of the published tables.
DIMENSION_STATE = TableContract(
    name="dimension_state",
    columns="""
        state_key varchar(2), state_name varchar(256), average_age double,
        female_urban_population bigint, male_urban_population bigint,
        total_urban_population bigint
    """,
    key=("state_key",),
    required=("state_key",),
    min_rows=1,
)
FACT_TEMPERATURE_STATE = TableContract(
    name="fact_temperature_state",
    columns="state_key varchar(2), average_temperature double, month int",
    key=("state_key", "month"),
    required=("state_key", "month"),
    min_rows=1,
)
FACT_ARRIVALS = TableContract(
    name="fact_arrivals",
    columns="""
        state_key varchar(2), month int, year int, average_age_arrivals double,
        F bigint, M bigint, U bigint, X bigint, business bigint, pleasure bigint,
        student bigint, average_temperature double
    """,
    key=("state_key", "month", "year"),
    required=("state_key", "month", "year", "average_age_arrivals", "average_temperature"),
    references={"state_key": ("dimension_state", "state_key")},
    min_rows=1,
)


def conform_to(df: DataFrame, contract: TableContract | str) -> DataFrame:
    """Select and cast ``df`` to the contract's columns, in the contract's order.

    Columns the contract does not name are dropped; a missing one fails the plan.
    A varchar column is carried as string here. Its length is enforced by the
    table on write and by the length rule of the quality checks.
    """
    schema = contract.schema if isinstance(contract, TableContract) else T.StructType.fromDDL(contract)
    return df.select(
        *[
            F.col(f"`{f.name}`")
            .cast(T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )
