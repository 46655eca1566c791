"""Queries over the sample tables, one per capability.

``orders`` plays the arrivals, ``customer`` the lookup from a code to a place
(``c_custkey`` → ``c_nationkey``), ``nation`` the dimension, the order status and
the priority digit the two categories, and the highest order price of a month the
temperature. The ``star_*`` queries go further: they shape the sample tables into
the four raw inputs and run the recipes of :mod:`starlane.plans.star` on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.functions.calendar import add_calendar, within_years
from starlane.functions.means import exact_mean, to_units
from starlane.operators.dedup import dedup_first
from starlane.operators.exact import profile_exact
from starlane.operators.impute import donor_mean, impute_periods
from starlane.operators.lookup import conform, enrich, recombine
from starlane.operators.match import Matched, key_filter, match, unmatched_counts
from starlane.operators.profile import (
    CountBy, Mean, category_counts, pivot_count, presum, profile, profile_preaggregated, profile_sums,
)
from starlane.operators.quality import audit, duplicate_keys, length_counts, null_counts, orphan_keys, report_of, write_checked
from starlane.operators.rollup import build_dimension
from starlane.operators.shape import is_null, not_null, preview, row_count, union_rows
from starlane.plans import reports, star
from starlane.plans.graph import Step, describe_inputs, fingerprint, run_steps
from starlane.plans.monthly import MonthlySums
from starlane.session import keeps_shares, size_shares
from starlane.sources.contracts import TableContract
from starlane.sources.readers import Landed, land_csv, read_csv, read_many, read_parquet
from starlane.sources.scratch import scratch_folder, scratch_root
from starlane.sources.sinks import publish, read_published, write_bucketed, write_stage
from starlane.sources.versions import exists, read_text, write_text

KEYS = ("nation_key", "month", "year")
STATUS = CountBy("status", {"F": "filled", "O": "open", "P": "pending"})
PRIORITY = CountBy("priority", {1: "urgent", 2: "high", 3: "medium"})
MEAN_PRICE = Mean("price", "mean_price", digits=1, units=2)
PEAK = Mean("peak_price", "peak_price", digits=2, units=2)

TARGET_YEAR = 2001
DONOR_YEARS = (1998, 1999, 2000)
FILLED_MONTHS = (9, 10, 11, 12)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


# -- the sample tables in the roles of the star ---------------------------------


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under business names, with period and numeric priority.

    Orders that lack a value the profile needs are left out. The conditions stand
    on the stored columns, so the scan can apply them and no derived column is
    computed twice: a period or priority is missing only where its source is.
    """
    orders = not_null(
        table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority"]
    )
    return add_calendar(orders, "o_orderdate").select(
        F.col("o_custkey").alias("customer_key"),
        "month",
        "year",
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
    )


def customer_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey"), F.col("c_nationkey").alias("nation_key")
    )


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the nation of their customer."""
    rows = order_rows(spark, sf_dir)
    return conform(
        rows,
        customer_nations(spark, sf_dir),
        on={"c_custkey": "customer_key"},
        take=["nation_key"],
        keep=[c for c in rows.columns if c != "customer_key"],
    )


def monthly_peaks(spark: SparkSession, sf_dir: str, years: tuple[int, ...]) -> DataFrame:
    """The highest order price per nation and month of the given years.

    No stage lies between: imputation reads its series once.
    """
    orders = table(spark, sf_dir, "orders").filter(within_years("o_orderdate", years, "timestamp_ntz"))
    rows = add_calendar(orders, "o_orderdate").select("o_custkey", "month", "year", "o_totalprice")
    placed = conform(rows, customer_nations(spark, sf_dir), {"c_custkey": "o_custkey"}, ["nation_key"])
    return placed.groupBy(*KEYS).agg(F.max("o_totalprice").alias("peak_price"))


def completed_peaks(spark: SparkSession, sf_dir: str, only_missing: bool = False) -> DataFrame:
    series = monthly_peaks(spark, sf_dir, (TARGET_YEAR, *DONOR_YEARS))
    return impute_periods(
        series,
        ["nation_key"],
        PEAK,
        TARGET_YEAR,
        DONOR_YEARS,
        FILLED_MONTHS,
        only_missing=only_missing,
    )


def priced_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(placed_orders(spark, sf_dir), KEYS, [MEAN_PRICE], [STATUS, PRIORITY])


# -- sources and sinks ----------------------------------------------------------


def scan_parquet_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("customer_key"),
        F.col("o_totalprice").alias("price"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
    )


def csv_contract_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers through a ``;`` file with spaces in its header."""
    folder = scratch_folder(spark, "customers_csv")
    table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer Key"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_acctbal").alias("Account Balance"),
        F.col("c_mktsegment").alias("Segment"),
    ).write.csv(folder, header=True, sep=";")
    schema = "`Customer Key` bigint, `Customer Name` string, `Account Balance` double, `Segment` string"
    return read_csv(spark, folder, schema, sep=";").select(
        F.col("Customer Key").alias("customer_key"),
        F.col("Customer Name").alias("customer_name"),
        F.col("Account Balance").alias("balance"),
        F.col("Segment").alias("segment"),
    )


def csv_date_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through a comma file with a date column."""
    folder = scratch_folder(spark, "orders_csv")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("dt"), "o_orderkey", "o_totalprice", "o_orderpriority"
    ).write.csv(folder, header=True)
    schema = "dt date, o_orderkey bigint, o_totalprice double, o_orderpriority string"
    return add_calendar(read_csv(spark, folder, schema), "dt").drop("dt")


def landed_orders(spark: SparkSession, sf_dir: str) -> str:
    """Write orders as one folder of files per month; return the parent folder."""
    folder = scratch_folder(spark, "orders_by_month")
    dated = add_calendar(table(spark, sf_dir, "orders"), "o_orderdate", "landing_year", "landing_month")
    write_stage(dated, folder, partition_by=["landing_year", "landing_month"])
    return folder


def monthly_files_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All monthly files in one scan, the month of each row taken from its folder."""
    folder = landed_orders(spark, sf_dir)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    return read_many(
        spark,
        f"{folder}/landing_year=*/landing_month=*",
        f"{schema}, landing_year int, landing_month int",
        basePath=folder,
    )


def append_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of one layout appended to each other, widening int to bigint."""
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation_key")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation_key"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.lit("nation").alias("kind"), F.col("n_nationkey").alias("key"), F.col("n_nationkey").alias("nation_key")
    )
    return union_rows(customers, suppliers, nations)


def stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a stage twice over the same folder and read it back: no rows pile up."""
    folder = scratch_folder(spark, "customers_per_segment")
    counted = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_customers")
    )
    write_stage(counted, folder, mode="overwrite")
    return write_stage(counted, folder, mode="overwrite")


def publish_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish an aggregate twice into a table with a declared layout; read what is published."""
    contract = TableContract(
        name="segment_share",
        columns="segment varchar(10), nation_key int, n_customers bigint, share_key varchar(13)",
        key=("segment", "nation_key"),
    )
    counted = (
        table(spark, sf_dir, "customer")
        .groupBy(F.col("c_nationkey").alias("nation_key"), F.col("c_mktsegment").alias("segment"))
        .agg(F.count(F.lit(1)).alias("n_customers"))
        .withColumn("share_key", F.concat_ws("-", "segment", "nation_key"))
    )
    folder = scratch_folder(spark, "segment_share")
    name = "segment_share_" + folder.rsplit("-", 1)[-1]
    publish(counted, contract, name, folder)
    publish(counted, contract, name, folder)
    spark.sql(f"DROP TABLE {name}")
    return read_published(spark, folder)


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders, 100, "o_orderkey")


def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


# -- projections and filters ----------------------------------------------------


def calendar_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = add_calendar(table(spark, sf_dir, "orders"), "o_orderdate")
    return orders.select("o_orderkey", "year", "month")


def filter_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").filter(F.col("c_nationkey") == 7)
    return customers.select("c_custkey", "c_name", "c_mktsegment")


def filter_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderstatus") == "F") & within_years("o_orderdate", DONOR_YEARS, "timestamp_ntz")
    )
    dated = add_calendar(orders, "o_orderdate").filter(F.col("month").isin(10, 11, 12))
    return dated.select("o_orderkey", "o_custkey", "year", "month")


def filter_before_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter on columns the result does not carry."""
    orders = table(spark, sf_dir, "orders").filter(
        within_years("o_orderdate", [TARGET_YEAR], "timestamp_ntz") & (F.col("o_orderpriority") == "1-URGENT")
    )
    return orders.select("o_orderkey", "o_totalprice")


def seeded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose type and value are missing for some rows."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
    )


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return not_null(seeded_events(spark, sf_dir), ["event_type", "value"])


def filter_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return is_null(seeded_events(spark, sf_dir), "event_type").select("event_id", "user_id", "value")


# -- joins ----------------------------------------------------------------------


def conform_computed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers to nations, on the number inside the nation's name."""
    nations = table(spark, sf_dir, "nation").withColumn("code", F.substring("n_name", 8, 2))
    suppliers = table(spark, sf_dir, "supplier")
    return conform(
        suppliers,
        nations,
        on={"code": F.col("s_nationkey").cast("string")},
        take=["n_name", "n_regionkey"],
        keep=["s_suppkey", "s_name"],
    )


def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        on={"c_custkey": "o_custkey"},
        take=["c_nationkey"],
        keep=["o_orderkey", "o_totalprice", "o_orderstatus"],
    )


def conform_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly peak prices known by nation name, keyed through the nation table."""
    nations = table(spark, sf_dir, "nation")
    placed = placed_orders(spark, sf_dir)
    peaks = placed.groupBy("nation_key", "year").agg(F.max("price").alias("peak_price"))
    named = conform(peaks, nations, {"n_nationkey": "nation_key"}, ["n_name"], keep=["year", "peak_price"])
    keyed = conform(named, nations, {"n_name": "n_name"}, ["n_nationkey"])
    return keyed.select("n_nationkey", "year", F.round("peak_price", 1).alias("peak_price"))


def fact_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile with the completed peak series, on nation and month without year.

    The peaks are a column of the profile's own aggregation; the orders are joined once.
    """
    placed = placed_orders(spark, sf_dir)
    cells = [MEAN_PRICE.over_rows().alias(MEAN_PRICE.alias), *category_counts(STATUS), *category_counts(PRIORITY)]
    whole = _stage(spark, placed.groupBy(*KEYS).agg(*cells, F.max("price").alias("peak_price")), "profile_and_peaks")
    peaks = impute_periods(whole.select(*KEYS, "peak_price"), ["nation_key"], PEAK, TARGET_YEAR, DONOR_YEARS, FILLED_MONTHS)
    return enrich(whole.drop("peak_price"), peaks.drop("year"), ["nation_key", "month"])


def key_filter_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users that are suppliers; the others go before the join, by a filter of bits."""
    events, on = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), {"s_suppkey": "user_id"}
    suppliers = table(spark, sf_dir, "supplier")
    return conform(events.where(key_filter(suppliers, on)), suppliers, on, ["s_nationkey"])


def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers in buckets of one key, joined where they lie."""
    orders = write_bucketed(table(spark, sf_dir, "orders"), scratch_folder(spark, "orders"), ["o_custkey"], 16)
    customers = write_bucketed(table(spark, sf_dir, "customer"), scratch_folder(spark, "customers"), ["c_custkey"], 16)
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("top_price"), F.min("c_nationkey").alias("nation_key")
    )


# -- aggregates -----------------------------------------------------------------


def dedup_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return dedup_first(customers, ["c_nationkey", "c_mktsegment"], ["c_custkey"])


def dimension_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer per nation and segment, rolled up to nations."""
    customers = table(spark, sf_dir, "customer").withColumn("cents", to_units("c_acctbal", 2))
    return build_dimension(
        customers,
        entity=["c_nationkey", "c_mktsegment"],
        order=["c_custkey"],
        keys={"c_nationkey": "nation_key"},
        uses=["cents"],
        measures=[
            exact_mean(F.sum("cents"), F.count("cents"), 2).alias("mean_balance"),
            F.sum("cents").alias("sum_cents"),
            F.count(F.lit(1)).alias("n_entities"),
        ],
        primary="nation_key",
    )


def donor_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = monthly_peaks(spark, sf_dir, DONOR_YEARS)
    return donor_mean(series, ["nation_key"], PEAK, TARGET_YEAR, DONOR_YEARS, FILLED_MONTHS)


def impute_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completed_peaks(spark, sf_dir)


def impute_only_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asks for all twelve months, but fills only those without an observation."""
    series = monthly_peaks(spark, sf_dir, (TARGET_YEAR, *DONOR_YEARS))
    return impute_periods(
        series, ["nation_key"], PEAK, TARGET_YEAR, DONOR_YEARS, range(1, 13), only_missing=True
    )


def pivot_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_count(placed_orders(spark, sf_dir), KEYS, STATUS)


def pivot_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_count(placed_orders(spark, sf_dir), KEYS, PRIORITY)


def group_mean_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(placed_orders(spark, sf_dir), KEYS, [MEAN_PRICE], [])


def exact_group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of doubles, rounded here only as the SQL counterpart sums them in any order."""
    lines = table(spark, sf_dir, "lineitem")
    means = [Mean("l_extendedprice", "mean_price", 4), Mean("l_discount", "mean_discount", 6)]
    return profile_exact(lines, ["l_returnflag"], means, [CountBy("l_linestatus", {"F": "filled", "O": "open"})])


def profile_preaggregated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_preaggregated(
        order_rows(spark, sf_dir),
        customer_nations(spark, sf_dir),
        on={"c_custkey": "customer_key"},
        take=["nation_key"],
        keys=KEYS,
        means=[MEAN_PRICE],
        counts=[STATUS, PRIORITY],
    )


def profile_by_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile as three aggregates joined back together.

    The orders are folded to one row per group and pair of categories in one pass; the
    three aggregates start from that small table.
    """
    parts = placed_orders(spark, sf_dir).groupBy(*KEYS, "status", "priority").agg(
        F.sum(MEAN_PRICE.value).alias("total"), F.count("price").alias("priced"), F.count(F.lit(1)).alias("n")
    )
    rows = write_stage(parts, scratch_folder(spark, "order_parts"))
    mean = rows.groupBy(*KEYS).agg(MEAN_PRICE.of(F.sum("total"), F.sum("priced")).alias("mean_price"))
    counts = [rows.groupBy(*KEYS).agg(*category_counts(c, weight="n")) for c in (STATUS, PRIORITY)]
    return recombine(KEYS, mean, *counts)


def stage_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage whose files are sorted, read back through a filter on the sort columns."""
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    staged = write_stage(customers, scratch_folder(spark, "sorted"), sort_by=["c_nationkey", "c_custkey"])
    return staged.filter(F.col("c_nationkey") == 5)


def _spoilt_file(spark: SparkSession, sf_dir: str) -> Landed:
    """Customers as a file, some cells of which were spoilt, landed as a stage."""
    folder = scratch_folder(spark, "spoilt_csv")
    key = F.col("c_custkey")
    table(spark, sf_dir, "customer").select(
        F.when(key % 7 != 0, key.cast("string")).alias("key"),
        F.when(key % 5 == 0, "many").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(key % 3 == 0, "2013-13-01").otherwise("2013-01-01").alias("day"),
    ).write.csv(folder, header=True)
    return land_csv(spark, folder, "key bigint, balance double, day date", scratch_folder(spark, "landed"))


def input_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing and unparsed cells per column of a file, counted as it was landed."""
    return _spoilt_file(spark, sf_dir).report()


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a file in which a cell does not parse, with the columns at fault."""
    rejected = _spoilt_file(spark, sf_dir).rejected
    return rejected.select("line", F.array_join("faults", ",").alias("faults"))


def landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of that file, NULL in the cells that do not parse."""
    return _spoilt_file(spark, sf_dir).rows


def _events_by_user(spark: SparkSession, sf_dir: str) -> Matched:
    """Events summed per user and type, looked up among the suppliers."""
    summed = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    suppliers = table(spark, sf_dir, "supplier")
    return match(summed, suppliers, {"s_suppkey": "user_id"}, ["s_nationkey"], scratch_folder(spark, "events_by_user"))


def match_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that a lookup of their user among the suppliers leaves without a match."""
    met = _events_by_user(spark, sf_dir)
    both = met.rows.select("n", F.lit(0).alias("lost")).unionByName(met.unmatched.select("n", F.col("n").alias("lost")))
    return both.agg(F.sum("n").alias("n_rows"), F.sum("lost").alias("n_unmatched"))


def matched_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per nation of the supplier they met and type, from the other part of that lookup."""
    met = _events_by_user(spark, sf_dir).rows
    return met.groupBy(F.col("s_nationkey").alias("nation_key"), "event_type").agg(F.sum("n").alias("n_events"))


def unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per user that is no supplier."""
    return unmatched_counts(table(spark, sf_dir, "events"), table(spark, sf_dir, "supplier"), {"s_suppkey": "user_id"})


def added_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile from kept sums: all orders but those of the last years, then these, given twice."""
    rows = order_rows(spark, sf_dir)
    sums = MonthlySums(spark, scratch_folder(spark, "monthly_sums"), ["customer_key", "month", "year"])
    early = F.col("year") < TARGET_YEAR
    for label, part in (("first", early), ("last", ~early), ("last", ~early)):
        sums.add(label, presum(rows.where(part), sums.by, [MEAN_PRICE], [STATUS, PRIORITY]))
    placed = conform(sums.total(), customer_nations(spark, sf_dir), {"c_custkey": "customer_key"}, ["nation_key"])
    return profile_sums(placed, KEYS, [MEAN_PRICE], [STATUS, PRIORITY])


def sorted_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priced_profile(spark, sf_dir).orderBy(*KEYS)


# -- data quality ---------------------------------------------------------------


def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(seeded_events(spark, sf_dir), ["event_id", "event_type", "value"])


def dq_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = add_calendar(table(spark, sf_dir, "orders"), "o_orderdate")
    return duplicate_keys(orders, ["o_custkey", "year", "month"])


def dq_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_keys(table(spark, sf_dir, "events"), "user_id", table(spark, sf_dir, "supplier"), "s_suppkey")


def dq_not_null_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = seeded_events(spark, sf_dir)
    return length_counts(events, required=["event_type"], lengths={"event_type": 5})


EVENT_LOG = TableContract(
    name="event_log",
    columns="user_id bigint, event_type varchar(5), value double",
    key=("user_id", "event_type"),
    required=("user_id", "event_type", "value"),
    references={"user_id": ("supplier", "s_suppkey")},
)


def dq_contract_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every promise of a contract at once, over a table that breaks each of them."""
    return audit(seeded_events(spark, sf_dir), EVENT_LOG, {"supplier": table(spark, sf_dir, "supplier")})


def dq_checked_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, counted while the table is written."""
    known = {"supplier": table(spark, sf_dir, "supplier")}
    return report_of(spark, write_checked(seeded_events(spark, sf_dir), scratch_folder(spark, "event_log"), EVENT_LOG, known)[1])


# -- the recipes on raw inputs shaped from the sample tables ---------------------


def _state_code(column: str) -> Column:
    return F.lpad(F.col(column).cast("string"), 2, "0")


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as cities: two share each name, and each is listed for four groups."""
    named = conform(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), {"n_nationkey": "c_nationkey"}, ["n_name"]
    )
    women = F.floor(F.abs("c_acctbal")).cast("int")
    men = F.length("c_mktsegment") + F.col("c_nationkey") * 10
    cities = named.select(
        F.concat(F.lit("City "), F.floor(F.col("c_custkey") / 2).cast("string")).alias("City"),
        F.col("n_name").alias("State"),
        F.floor(F.abs("c_acctbal") / 100).cast("float").alias("Median Age"),
        men.alias("Male Population"),
        women.alias("Female Population"),
        (women + men).alias("Total Population"),
        F.lit(0).alias("Number of Veterans"),
        F.lit(None).cast("int").alias("Foreign Born"),
        F.lit(2.5).cast("float").alias("Average Household Size"),
        _state_code("c_nationkey").alias("State Code"),
    )
    groups = F.array(*[F.lit(g) for g in ("group a", "group b", "group c", "group d")])
    return cities.withColumn("Race", F.explode(groups)).withColumn("Count", F.length("Race"))


def raw_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly peak prices as temperatures, dated twelve years later.

    The last sample year becomes the year to complete; one region lies abroad.
    """
    nations = table(spark, sf_dir, "nation")
    placed = placed_orders(spark, sf_dir)
    peaks = placed.groupBy(*KEYS).agg(F.max("price").alias("peak_price"))
    named = conform(peaks, nations, {"n_nationkey": "nation_key"}, ["n_name", "n_regionkey"])
    return named.select(
        F.make_date(F.col("year") + 12, F.col("month"), F.lit(1)).alias("dt"),
        F.floor(F.col("peak_price") / 10000).cast("float").alias("AverageTemperature"),
        F.lit(0.5).cast("float").alias("AverageTemperatureUncertainty"),
        F.col("n_name").alias("State"),
        F.when(F.col("n_regionkey") == 4, "Elsewhere").otherwise(star.COUNTRY_NAME).alias("Country"),
    )


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as airports: some abroad, in no state, without a code, or sharing one."""
    key, balance, segment = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    code = F.when(balance > 9500, F.lit(None)).when(segment == "HOUSEHOLD", key - 1).otherwise(key)
    region = F.concat(F.lit("US-"), _state_code("c_nationkey"))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("K"), key.cast("string")).alias("ident"),
        F.lit("small_airport").alias("type"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("int").alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        F.when(segment == "MACHINERY", "CA").otherwise(star.COUNTRY_CODE).alias("iso_country"),
        F.when(balance < -500, "US-U-A").otherwise(region).alias("iso_region"),
        segment.alias("municipality"),
        F.lit(None).cast("string").alias("gps_code"),
        F.lit(None).cast("string").alias("iata_code"),
        code.cast("string").alias("local_code"),
        F.concat_ws(", ", key, "c_nationkey").alias("coordinates"),
    )


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as arrivals, some without age or gender, and with two undeclared visa codes."""
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    visa = F.substring("o_orderpriority", 1, 1).cast("double")
    gender = (
        F.when((status == "P") & (visa == 4), F.lit(None))
        .when((status == "O") & (visa == 5), "X")
        .when(status == "F", "F")
        .when(status == "O", "M")
        .otherwise("U")
    )
    return table(spark, sf_dir, "orders").select(
        (F.year("o_orderdate") + 15).cast("double").alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        F.col("o_custkey").cast("string").alias("i94port"),
        F.when(price >= 20000, F.floor(price / 6000).cast("double")).alias("i94bir"),
        visa.alias("i94visa"),
        gender.alias("gender"),
    )


def star_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.state_dimension(raw_demographics(spark, sf_dir))


def _stage(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    return write_stage(df, scratch_folder(spark, label))


def star_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _stage(spark, raw_temperatures(spark, sf_dir), "readings")
    return star.complete_temperatures(readings)


def star_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension_and_temperatures(spark, sf_dir)[1]


def star_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = _stage(spark, star_dimension(spark, sf_dir), "dimension")
    return star.port_states(raw_airports(spark, sf_dir), dimension)


def star_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    ports = _stage(spark, star_ports(spark, sf_dir), "ports")
    return star.arrivals_profile(star.arrival_rows(raw_arrivals(spark, sf_dir)), ports)


@keeps_shares
def _star_run(spark: SparkSession, sf_dir: str) -> str:
    """Land the four raw inputs as files and run the whole job on them; where it published."""
    size_shares(spark, sum(i.size for i in describe_inputs(spark, _star_inputs(sf_dir)).values()))
    landing = scratch_folder(spark, "landing")
    inputs = star.Inputs()

    def arrivals() -> None:
        months = {"landing_year": F.col("i94yr").cast("int"), "landing_month": F.col("i94mon").cast("int")}
        write_stage(raw_arrivals(spark, sf_dir).withColumns(months), f"{landing}/{inputs.arrivals}", partition_by=[*months])

    def text(rows: DataFrame, name: str, sep: str = ",") -> None:
        rows.write.csv(f"{landing}/{name}", header=True, sep=sep)

    run_steps(
        spark,
        {
            "arrivals": Step((), arrivals),
            "demographics": Step((), lambda: text(raw_demographics(spark, sf_dir), inputs.demographics, ";")),
            "temperatures": Step((), lambda: text(raw_temperatures(spark, sf_dir), inputs.temperatures)),
            "airports": Step((), lambda: text(raw_airports(spark, sf_dir), inputs.airports)),
        },
    )
    output = scratch_folder(spark, "star")
    names = [f"{n}_{output.rsplit('-', 1)[-1]}" for n in ("dimension_state", "fact_arrivals")]
    star.run(spark, landing, output, publish_as=tuple(names), publish_dir=f"{output}/published")
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return f"{output}/published"


def full_refresh_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from raw files to the published fact table."""
    return star.open_published(spark, _star_run(spark, sf_dir))["fact_arrivals"]


def full_refresh_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from raw files to the published dimension table."""
    return star.open_published(spark, _star_run(spark, sf_dir))["dimension_state"]


def published_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The published tables of this application's run over these inputs, which is made if there is none yet."""
    pointer = f"{scratch_root(spark)}/published-{fingerprint(sf_dir, describe_inputs(spark, _star_inputs(sf_dir)))}"
    if not exists(spark, pointer):
        write_text(spark, pointer, _star_run(spark, sf_dir))
    return star.open_published(spark, read_text(spark, pointer))


def _star_inputs(sf_dir: str) -> dict[str, str]:
    return {name: f"{sf_dir}/{name}.parquet" for name in ("customer", "nation", "orders")}


def _dimension_and_temperatures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both small tables, staged."""
    dimension = _stage(spark, star_dimension(spark, sf_dir), "dimension")
    readings = _stage(spark, raw_temperatures(spark, sf_dir), "readings")
    return dimension, _stage(spark, star.state_temperatures(readings, dimension), "temperatures")


def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact from frames, staging only the small tables."""
    dimension, temperatures = _dimension_and_temperatures(spark, sf_dir)
    ports = _stage(spark, star.port_states(raw_airports(spark, sf_dir), dimension), "ports")
    profiled = star.arrivals_profile(star.arrival_rows(raw_arrivals(spark, sf_dir)), ports)
    return star.arrivals_fact(profiled, temperatures)


# The reports look at one state, as a reader of the published table would.
REPORT_STATE = "05"


def report_visa_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, reports.VISA_MIX)


def report_gender_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, reports.GENDER_MIX)


def _report(spark: SparkSession, sf_dir: str, columns: tuple[str, ...]) -> DataFrame:
    tables = published_star(spark, sf_dir)
    return reports.category_mix_report(spark, tables["fact_arrivals"], tables["dimension_state"], "state_key", REPORT_STATE, columns)


QUERIES = {
    "scan_parquet_project": scan_parquet_project,
    "csv_contract_scan": csv_contract_scan,
    "csv_date_scan": csv_date_scan,
    "monthly_files_union": monthly_files_union,
    "append_union": append_union,
    "stage_roundtrip": stage_roundtrip,
    "publish_refresh": publish_refresh,
    "preview_limit": preview_limit,
    "row_count": count_rows,
    "calendar_columns": calendar_columns,
    "filter_equality": filter_equality,
    "filter_members": filter_members,
    "filter_before_projection": filter_before_projection,
    "filter_not_null": filter_not_null,
    "filter_is_null": filter_is_null,
    "conform_computed_key": conform_computed_key,
    "lookup_join": lookup_join,
    "conform_by_name": conform_by_name,
    "dedup_first": dedup_first_rows,
    "dimension_rollup": dimension_rollup,
    "donor_mean": donor_means,
    "impute_periods": impute_missing,
    "impute_only_missing": impute_only_missing,
    "pivot_string": pivot_string,
    "pivot_numeric": pivot_numeric,
    "group_mean_rounded": group_mean_rounded,
    "exact_group_mean": exact_group_mean,
    "profile_one_pass": priced_profile,
    "profile_preaggregated": profile_preaggregated_rows,
    "profile_by_joins": profile_by_joins,
    "fact_enrich": fact_enrich,
    "sorted_result": sorted_result,
    "stage_sorted": stage_sorted,
    "input_audit": input_audit,
    "quarantined_rows": quarantined_rows,
    "landed_rows": landed_rows,
    "match_audit": match_audit,
    "matched_counts": matched_counts,
    "unmatched_keys": unmatched_keys,
    "key_filter_join": key_filter_join,
    "bucketed_join": bucketed_join,
    "added_months": added_months,
    "dq_checked_write": dq_checked_write,
    "dq_null_counts": dq_null_counts,
    "dq_unique_key": dq_unique_key,
    "dq_foreign_key": dq_foreign_key,
    "dq_not_null_length": dq_not_null_length,
    "dq_contract_audit": dq_contract_audit,
    "star_dimension": star_dimension,
    "star_calendar": star_calendar,
    "star_temperature": star_temperature,
    "star_ports": star_ports,
    "star_profile": star_profile,
    "star_fact": star_fact,
    "report_visa_mix": report_visa_mix,
    "report_gender_mix": report_gender_mix,
    "full_refresh_run": full_refresh_run,
    "full_refresh_dimension": full_refresh_dimension,
}
