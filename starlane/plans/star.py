"""The traveller-arrivals star schema: four raw inputs to one fact and one dimension.

The recipes take and return DataFrames. :func:`run` reads the raw files, writes
each stage once, checks the result and publishes it::

    spark-submit --py-files starlane.zip starlane/plans/star.py --input IN --output OUT
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.functions.calendar import add_calendar, within_years
from starlane.operators.impute import impute_periods
from starlane.operators.lookup import conform, enrich
from starlane.operators.match import match
from starlane.operators.profile import CountBy, Mean, fold_codes, presum, profile, profile_sums
from starlane.operators.quality import Violation, audit, duplicate_keys, enforce, write_checked
from starlane.operators.rollup import build_dimension
from starlane.operators.shape import union_rows
from starlane.plans.graph import Finished, Step, describe_inputs, fingerprint, run_steps
from starlane.plans.monthly import MonthlySums
from starlane.session import build_session, keeps_shares, size_shares, size_shuffles
from starlane.sources import contracts
from starlane.sources.contracts import conform_to
from starlane.sources.readers import Landed, land_csv, read_csv, read_many, read_parquet
from starlane.sources.sinks import publish_all, read_published, write_stage

# Raw column names with the names and types the tables use, the country
# filters, the year to complete with its donors and months, and the category codes
# with their column names.
URBAN_TOTALS = {
    "Female Population": "female_urban_population",
    "Male Population": "male_urban_population",
    "Total Population": "total_urban_population",
}
ARRIVAL_COLUMNS = {
    "i94mon": ("month", "int"), "i94yr": ("year", "int"), "i94bir": ("age", "double"),
    "gender": ("gender", "string"), "i94port": ("airport_key", "string"), "i94visa": ("visa_key", "double"),
}
COUNTRY_NAME = "United States"
COUNTRY_CODE = "US"
TARGET_YEAR = 2013
DONOR_YEARS = (2010, 2011, 2012)
FILLED_MONTHS = (10, 11, 12)
GENDERS = CountBy("gender", {"F": "F", "M": "M", "U": "U", "X": "X"})
VISAS = CountBy("visa_key", {1: "business", 2: "pleasure", 3: "student"})

PROFILE_KEYS = ("state_key", "month", "year")
# An arrival counts only if all of these are known.
PROFILE_REQUIRED = ("age", "month", "gender", "visa_key", "year")


@dataclass(frozen=True)
class Inputs:
    """Names of the raw inputs below the input folder (fixed values)."""

    demographics: str = "us-cities-demographics.csv"
    temperatures: str = "GlobalLandTemperaturesByState.csv"
    airports: str = "airport-codes_csv.csv"
    arrivals: str = "arrivals"
    arrivals_source: str = "parquet"


@dataclass(frozen=True)
class Stages:
    """Folder names of the stage tables below the output folder (fixed values)."""

    dimension: str = "dimension_state"
    cities: str = "city_rows"
    readings: str = "state_readings"
    temperature: str = "fact_temperature_state"
    airports: str = "airport_rows"
    ports: str = "port_state"
    by_port: str = "arrivals_by_port"
    placed: str = "arrivals_placed"
    fact: str = "fact_arrivals_by_state_month"
    report: str = "run_report"


def state_dimension(demographics: DataFrame) -> DataFrame:
    """One row per state from city rows, each city counted once.

    A city appears once per population group with equal measures. The city name
    alone identifies it, so a name used in two states stays with the first state.
    The mean age is the plain mean over cities.
    """
    dimension = build_dimension(
        demographics,
        entity=["City"],
        order=["State", "State Code"],
        keys={"State Code": "state_key", "State": "state_name"},
        uses=["Median Age", *URBAN_TOTALS],
        measures=[
            F.avg("Median Age").alias("average_age"),
            *[F.sum(raw).alias(name) for raw, name in URBAN_TOTALS.items()],
        ],
        primary="state_key",
    )
    return conform_to(dimension, contracts.DIMENSION_STATE)


def is_usable(target_year: int = TARGET_YEAR, donor_years: Sequence[int] = DONOR_YEARS) -> Column:
    """Whether a reading is domestic and of the target year or its donors, a small part of the series."""
    return (F.col("Country") == COUNTRY_NAME) & within_years("dt", [target_year, *donor_years])


def usable_readings(
    readings: DataFrame, target_year: int = TARGET_YEAR, donor_years: Sequence[int] = DONOR_YEARS
) -> DataFrame:
    return readings.filter(is_usable(target_year, donor_years)).select("dt", "AverageTemperature", "State", "Country")


def complete_temperatures(
    readings: DataFrame,
    target_year: int = TARGET_YEAR,
    donor_years: Sequence[int] = DONOR_YEARS,
    months: Sequence[int] = FILLED_MONTHS,
    only_missing: bool = False,
) -> DataFrame:
    """Monthly temperature per state name for the target year, absent months filled."""
    usable = usable_readings(readings, target_year, donor_years)
    series = add_calendar(usable, "dt").withColumnRenamed("State", "state_name")
    value = Mean("AverageTemperature", "average_temperature")
    filled = impute_periods(
        series, ["state_name"], value, target_year, donor_years, months, only_missing=only_missing
    )
    return filled.orderBy("state_name", "month")


def state_temperatures(readings: DataFrame, dimension: DataFrame, **choices: object) -> DataFrame:
    """Completed monthly temperatures keyed by state; states the dimension lacks drop out."""
    named = complete_temperatures(readings, **choices)
    keyed = conform(named, dimension, on={"state_name": "state_name"}, take=["state_key"])
    return keyed.select("state_key", F.round("average_temperature", 2).alias("average_temperature"), "month")


def port_states(airports: DataFrame, dimension: DataFrame) -> DataFrame:
    """State of each domestic airport; the region code ``US-CA`` belongs to state ``CA``."""
    return conform(
        airports.filter(F.col("iso_country") == COUNTRY_CODE),
        dimension,
        on={"state_key": F.substring("iso_region", 4, 2)},
        take=["state_key"],
        keep=["ident", "local_code"],
    )


def arrival_rows(arrivals: DataFrame) -> DataFrame:
    """Raw arrival records under business names, the period as integers."""
    return arrivals.select(*[F.col(raw).cast(kind).alias(name) for raw, (name, kind) in ARRIVAL_COLUMNS.items()])


PORT_KEYS = ("airport_key", "month", "year")
AGES = [Mean("age", "average_age_arrivals", digits=1)]


def arrivals_by_port(arrivals: DataFrame) -> DataFrame:
    """Sums and counts per port code and month, which is all that the profile needs.

    One pass over the arrivals with one shuffle of a row per port, month and task. Sums of
    single files add up, so they can be kept (:mod:`starlane.plans.monthly`).
    """
    return presum(arrivals, PORT_KEYS, AGES, [GENDERS, VISAS], PROFILE_REQUIRED)


def port_weights(ports: DataFrame) -> DataFrame:
    """Ports by code; a code listed twice counts twice, so its entries are folded into a weight."""
    return fold_codes(ports, ["local_code"], ["state_key"], "entries")


def profile_of_ports(placed: DataFrame) -> DataFrame:
    """Mean age and counts by gender and visa per state and month, from sums placed in states."""
    return profile_sums(placed, PROFILE_KEYS, AGES, [GENDERS, VISAS], "entries").orderBy(*PROFILE_KEYS)


def arrivals_profile(arrivals: DataFrame, ports: DataFrame) -> DataFrame:
    """The same from the arrivals in one aggregation, without what the lookup loses.

    Ports without a state drop out. The entries of a code are folded into a weight, so
    arrivals are not copied for it.
    """
    placed = conform(
        arrivals, port_weights(ports), {"local_code": "airport_key"}, ["state_key", "entries"], keep=list(PROFILE_REQUIRED)
    )
    return profile(placed, PROFILE_KEYS, AGES, [GENDERS, VISAS], PROFILE_REQUIRED, weight="entries").orderBy(*PROFILE_KEYS)


def arrivals_fact(arrivals: DataFrame, temperatures: DataFrame) -> DataFrame:
    """The profile with the month's temperature, matched on state and month alone.

    Temperatures describe one earlier year, so the year is no part of the match.
    A state and month without temperature drops out.
    """
    return conform_to(enrich(arrivals, temperatures, ["state_key", "month"]), contracts.FACT_ARRIVALS)


def check_tables(fact: DataFrame, dimension: DataFrame) -> None:
    """Raise unless both published tables keep their contracts; all rules in one job."""
    known = {contracts.DIMENSION_STATE.name: dimension}
    reports = [
        audit(table, contract, known).withColumn("column", F.concat(F.lit(contract.name + "."), "column"))
        for table, contract in ((dimension, contracts.DIMENSION_STATE), (fact, contracts.FACT_ARRIVALS))
    ]
    enforce(union_rows(*reports))


def reading_faults(readings: Landed) -> list[Violation]:
    """A reading whose date or value does not parse would silently drop out."""
    unparsed = readings.unparsed()
    return [("parses", c, unparsed[c]) for c in ("dt", "AverageTemperature")]


def check_temperatures(temperatures: DataFrame, profiled: DataFrame) -> None:
    """Raise if a month of the profile has several temperatures, which would double its facts."""
    keys = list(contracts.FACT_TEMPERATURE_STATE.key)
    doubled = duplicate_keys(temperatures, keys, "n")
    if doubled.isEmpty():
        return
    met = doubled.join(profiled.select(*keys).distinct(), keys, "left_semi")
    name = f"{contracts.FACT_TEMPERATURE_STATE.name}.{','.join(keys)}"
    enforce(met.agg(F.count(F.lit(1)).alias("violations")).select(F.lit("unique_key").alias("rule"), F.lit(name).alias("column"), "violations"))


@keeps_shares
def run(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    inputs: Inputs = Inputs(),
    stages: Stages = Stages(),
    publish_as: tuple[str, str] | None = None,
    publish_dir: str | None = None,
    target_year: int = TARGET_YEAR,
    donor_years: Sequence[int] = DONOR_YEARS,
    months: Sequence[int] = FILLED_MONTHS,
    only_missing: bool = False,
    most_faulty: Mapping[str, int] | None = None,
    resume: bool = False,
    monthly_sums: str | None = None,
) -> dict[str, DataFrame]:
    """Dimension, temperatures, ports, fact, checks, publish; each stage written once.

    Steps that need nothing of each other run at once. Every stage replaces its previous
    content and is read back from storage, so a lost executor costs the running stage's
    tasks only. With ``resume`` a stage that an earlier run finished from the same files and
    choices is left as it is.

    Each text file is parsed once, its faulty rows beside the others in its stage;
    ``most_faulty`` gives the number allowed by input (``demographics``, ``temperatures``,
    ``airports``), and a reading whose date or value does not parse always raises. Nothing
    is published unless all checks pass. ``publish_as`` names the (dimension, fact) tables to
    refresh, by default the contracts' own names, kept under ``publish_dir`` if
    given; both switch together. ``target_year``, ``donor_years``, ``months`` and
    ``only_missing`` choose how temperatures are completed.

    With ``monthly_sums``, a folder, the arrivals read are one delivery of several: their sums
    are kept there, and the fact is made from the sums of all deliveries so far.

    Returns the tables by name, with ``unmatched_ports``, the arrivals per port code that has
    no state, and ``run_report``, what was counted on the way.
    """

    def stage(name: str) -> str:
        return f"{output_dir.rstrip('/')}/{name}"

    raw = {n: f"{input_dir.rstrip('/')}/{getattr(inputs, n)}" for n in ("demographics", "temperatures", "airports", "arrivals")}
    found = describe_inputs(spark, raw)
    input_bytes = sum(i.size for i in found.values())
    size_shuffles(spark, input_bytes)
    size_shares(spark, input_bytes)
    finished, allowed, choices = Finished(spark, resume), dict(most_faulty or {}), (target_year, tuple(donor_years))
    imputed = dict(target_year=target_year, donor_years=donor_years, months=months, only_missing=only_missing)
    made = {
        "cities": fingerprint(RECIPE, found["demographics"]),
        "readings": fingerprint(RECIPE, found["temperatures"], choices),
        "airports": fingerprint(RECIPE, found["airports"]),
        "by_port": fingerprint(RECIPE, found["arrivals"], inputs.arrivals_source),
    }
    made["dimension"] = fingerprint(made["cities"], "dimension")
    made["temperature"] = fingerprint(made["dimension"], made["readings"], tuple(months), only_missing)
    made["ports"] = fingerprint(made["dimension"], made["airports"])

    def land(name: str, source: str, schema: str, sep: str = ",", aliases: Mapping[str, str] | None = None, keep: Column | None = None) -> Landed:
        folder, of = stage(getattr(stages, name)), T.StructType.fromDDL(schema).names

        def build() -> tuple[DataFrame, dict]:
            landed = land_csv(spark, raw[source], schema, folder, sep, aliases, keep, allowed.get(source), mode="overwrite")
            return landed.staged, landed.counts

        return Landed(*finished.stage(folder, made[name], build), tuple(of))

    def plain(name: str, df: DataFrame, **how: object) -> DataFrame:
        folder = stage(getattr(stages, name))
        return finished.stage(folder, made[name], lambda: (write_stage(df, folder, mode="overwrite", **how), {}))[0]

    def dimension_step(cities: Landed) -> tuple[DataFrame, list[Violation]]:
        folder = stage(stages.dimension)

        def build() -> tuple[DataFrame, dict]:
            written, lines = write_checked(state_dimension(cities.rows), folder, contracts.DIMENSION_STATE, mode="overwrite")
            return written, {"lines": lines}

        written, seen = finished.stage(folder, made["dimension"], build)
        return written, [tuple(line) for line in seen["lines"]]

    def readings_step() -> Landed:
        landed = land("readings", "temperatures", contracts.STATE_TEMPERATURE, keep=is_usable(*choices))
        enforce(reading_faults(landed))
        return landed

    def by_port_step() -> DataFrame:
        landed = read_many(spark, raw["arrivals"], contracts.ARRIVALS, inputs.arrivals_source, header="true")
        summed = arrivals_by_port(arrival_rows(landed))
        if monthly_sums is None:
            return plain("by_port", summed)
        sums = MonthlySums(spark, monthly_sums, PORT_KEYS)
        sums.add(inputs.arrivals, summed)
        return sums.total()

    done = run_steps(
        spark,
        {
            "by_port": Step((), by_port_step),
            "cities": Step((), lambda: land("cities", "demographics", contracts.CITY_DEMOGRAPHICS, ";", contracts.CITY_ALIASES)),
            "readings": Step((), readings_step),
            "airports": Step((), lambda: land("airports", "airports", contracts.AIRPORT_CODES, keep=F.col("iso_country") == COUNTRY_CODE)),
            "dimension": Step(("cities",), dimension_step),
            "temperature": Step(
                ("readings", "dimension"),
                lambda readings, dimension: plain("temperature", state_temperatures(readings.rows, dimension[0], **imputed)),
            ),
            "ports": Step(
                ("airports", "dimension"), lambda airports, dimension: plain("ports", port_states(airports.rows, dimension[0]), compact=True)
            ),
            # The sums are few, so the lookup that keeps what it loses is written as a whole.
            "placed": Step(
                ("by_port", "ports"),
                lambda by_port, ports: match(
                    by_port, port_weights(ports), {"local_code": "airport_key"}, ["state_key", "entries"], stage(stages.placed), "overwrite"
                ),
            ),
        },
    )
    (dimension, dimension_lines), temperatures, placed = done["dimension"], done["temperature"], done["placed"]
    profiled = profile_of_ports(placed.rows)
    check_temperatures(temperatures, profiled)
    # Reports ask for one state, so its rows should lie together.
    fact, fact_lines = write_checked(
        arrivals_fact(profiled, temperatures), stage(stages.fact), contracts.FACT_ARRIVALS, {contracts.DIMENSION_STATE.name: dimension},
        mode="overwrite", sort_by=["state_key", "month"],
    )
    named = [(contracts.DIMENSION_STATE, dimension_lines), (contracts.FACT_ARRIVALS, fact_lines)]
    lines = [(rule, f"{contract.name}.{column}", n) for contract, of in named for rule, column, n in of]
    unmatched = placed.unmatched.groupBy("airport_key").agg(F.sum("n_rows").alias("n_rows"))
    dimension_name, fact_name = publish_as or (contracts.DIMENSION_STATE.name, contracts.FACT_ARRIVALS.name)

    def place(table: str) -> str | None:
        return None if publish_dir is None else f"{publish_dir.rstrip('/')}/{table}"

    def publish_step() -> list[DataFrame]:
        enforce(lines)
        return publish_all(
            [
                (dimension, contracts.DIMENSION_STATE, dimension_name, place("dimension_state")),
                (fact, contracts.FACT_ARRIVALS, fact_name, place("fact_arrivals")),
            ]
        )

    # The report is there whether or not the checks pass.
    ended = run_steps(
        spark,
        {
            "report": Step((), lambda: write_stage(_run_report(spark, found, done, unmatched, lines), stage(stages.report), mode="overwrite")),
            "published": Step((), publish_step),
        },
    )
    published, report = ended["published"], ended["report"]
    return {
        "dimension_state": published[0],
        "fact_arrivals": published[1],
        "fact_temperature_state": temperatures,
        "port_state": done["ports"],
        "unmatched_ports": unmatched,
        "run_report": report,
    }


# Part of every fingerprint: change it when a recipe changes what a stage holds.
RECIPE = "3"


def _run_report(spark: SparkSession, found: dict, done: dict, unmatched: DataFrame, lines: Sequence[Violation]) -> DataFrame:
    """What a run read, rejected and lost: measure, subject, value."""
    rows = [(m, name, v) for name, i in found.items() for m, v in (("input_files", i.files), ("input_bytes", i.size))]
    for name in ("cities", "readings", "airports"):
        counts = done[name].counts
        rows += [("rows", name, counts["rows"]), ("faulty_rows", name, counts["faulty"])]
        rows += [("unparsed_cells", f"{name}.{c}", n) for c, n in done[name].unparsed().items()]
    rows += [(rule, column, n) for rule, column, n in lines]
    lost = unmatched.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("value")).select(
        F.lit("unmatched_rows").alias("measure"), F.lit("arrivals.airport_key").alias("subject"), "value"
    )
    return spark.createDataFrame(rows, "measure string, subject string, value long").unionByName(lost)


def open_published(spark: SparkSession, publish_dir: str) -> dict[str, DataFrame]:
    """The tables that a run published below ``publish_dir``, both of the same run."""
    tables = {"dimension_state": contracts.DIMENSION_STATE, "fact_arrivals": contracts.FACT_ARRIVALS}
    return {name: read_published(spark, f"{publish_dir.rstrip('/')}/{name}", contract) for name, contract in tables.items()}


def open_stages(spark: SparkSession, output_dir: str, stages: Stages = Stages()) -> dict[str, DataFrame]:
    """The tables of an earlier run, from its stage folders."""
    base = output_dir.rstrip("/")
    return {
        "dimension_state": read_parquet(spark, f"{base}/{stages.dimension}"),
        "fact_arrivals": read_parquet(spark, f"{base}/{stages.fact}"),
    }


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build, check and publish the arrivals star schema.")
    parser.add_argument("--input", required=True, help="folder with the raw files")
    parser.add_argument("--output", required=True, help="folder for the stage tables")
    parser.add_argument("--publish", help="folder for the published tables (default: the warehouse)")
    names = Inputs()
    for name in ("demographics", "temperatures", "airports", "arrivals"):
        parser.add_argument(f"--{name}", default=getattr(names, name), help="path or glob below --input")
    parser.add_argument("--arrivals-source", default=names.arrivals_source, help="format of the arrival files")
    parser.add_argument("--target-year", type=int, default=TARGET_YEAR, help="year whose months are completed")
    parser.add_argument("--donor-years", type=int, nargs="+", default=DONOR_YEARS, help="years they are completed from")
    parser.add_argument("--months", type=int, nargs="+", default=FILLED_MONTHS, help="months to complete")
    parser.add_argument("--only-missing", action="store_true", help="leave months that have a reading")
    parser.add_argument("--monthly-sums", help="folder with the sums of earlier deliveries of arrivals")
    parser.add_argument("--resume", action="store_true", help="leave stages that were finished from the same files")
    for name in ("demographics", "temperatures", "airports"):
        parser.add_argument(f"--most-faulty-{name}", type=int, help="faulty rows allowed in this input")
    parser.add_argument("--hive", action="store_true", help="keep tables in the Hive catalog")
    args = parser.parse_args(argv)
    run(
        build_session("arrivals-star", hive=args.hive),
        args.input,
        args.output,
        inputs=Inputs(args.demographics, args.temperatures, args.airports, args.arrivals, args.arrivals_source),
        publish_dir=args.publish,
        target_year=args.target_year,
        donor_years=args.donor_years,
        months=args.months,
        only_missing=args.only_missing,
        most_faulty={n: v for n in ("demographics", "temperatures", "airports") if (v := getattr(args, f"most_faulty_{n}")) is not None},
        resume=args.resume,
        monthly_sums=args.monthly_sums,
    )


if __name__ == "__main__":
    main()
