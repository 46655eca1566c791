"""What the plans look like, and how they behave when one key holds a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

from starlane.operators import (
    CountBy, Mean, conform, dedup_first, duplicate_keys, fold_codes, impute_periods, orphan_keys, profile, profile_preaggregated,
)
from starlane.plans import samples as sample_queries, star
from starlane.sources import write_stage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution."""
    df.write.format("noop").mode("overwrite").save()
    executed = df._jdf.queryExecution()
    executed.executedPlan().execute().count()
    return executed.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(sample_queries.QUERIES))
def test_no_query_needs_python_a_cross_join_or_a_forced_broadcast(spark, samples, settings, name):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(sample_queries.QUERIES[name](spark, samples))
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "Broadcast"):
        assert operator not in text


def test_filters_and_columns_reach_the_scan(spark, samples, settings):
    settings(spark__sql__maxMetadataStringLength="10000")
    text = plan(sample_queries.filter_members(spark, samples))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text, re.S).group(1)
    assert "EqualTo(o_orderstatus,F)" in pushed and "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    text = plan(sample_queries.filter_before_projection(spark, samples))
    assert "o_custkey" not in re.search(r"ReadSchema: (\S+)", text).group(1)
    text = plan(sample_queries.priced_profile(spark, samples))
    assert "IsNotNull(o_totalprice)" in text


def test_profile_is_one_scan_and_one_shuffle_beyond_the_join(spark, samples, settings):
    text = plan(sample_queries.priced_profile(spark, samples))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan parquet") == 2
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(sample_queries.priced_profile(spark, samples))
    assert "SortMergeJoin" in text and "Broadcast" not in text
    assert text.count("Exchange hashpartitioning") == 3


def test_imputation_scans_its_series_once(spark, settings, tmp_path):
    settings(spark__sql__adaptive__enabled="false")
    spark.range(100).selectExpr("id % 7 as e", "2010 + int(id % 4) as year", "int(id % 12) as month", "double(id) as v").write.parquet(str(tmp_path / "s"))
    series = spark.read.parquet(str(tmp_path / "s"))
    for only_missing in (False, True):
        text = plan(impute_periods(series, ["e"], Mean("v", "v"), 2013, [2010, 2011], [1, 2], only_missing=only_missing))
        assert len(re.findall(r"FileScan parquet", text)) == 1 and "Join" not in text and "SortAggregate" not in text
        assert len(re.findall(r"Exchange hash", text)) == 1 + only_missing


def test_buckets_are_joined_and_grouped_where_they_lie(spark, samples, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(sample_queries.bucketed_join(spark, samples))
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_a_report_reads_one_state_of_the_published_tables(spark, samples, settings):
    settings(spark__sql__maxMetadataStringLength="10000")
    text = plan(sample_queries.report_visa_mix(spark, samples))
    assert text.count("EqualTo(state_key,05)") == 2 and text.count("FileScan parquet") == 2
    assert "Aggregate" not in text and "orders.parquet" not in text
    fact = re.search(r"ReadSchema: (struct<\S*business\S*)", text).group(1)
    assert "average_age_arrivals" not in fact
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("again", "again")
    sample_queries.report_gender_mix(spark, samples)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("again")) <= 3


def test_a_key_filter_stands_below_the_shuffle(spark, samples, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(sample_queries.key_filter_join(spark, samples))
    below = text[text.index("getbit") :]
    assert "Exchange" not in below[: below.index("FileScan")]


@pytest.fixture(scope="module")
def hot(spark, samples, tmp_path_factory):
    """Orders of which every third belongs to one customer."""
    orders = spark.read.parquet(f"{samples}/orders.parquet")
    many = orders.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40))))
    skewed = many.select(
        F.when(F.xxhash64("o_orderkey", "copy") % 3 == 0, 7).otherwise(F.col("o_custkey")).alias("customer_key"),
        F.month("o_orderdate").alias("month"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
    )
    stage = write_stage(skewed.repartition(16), str(tmp_path_factory.mktemp("hot") / "orders"))
    assert stage.filter("customer_key = 7").count() > stage.count() / 3.2
    return stage


MEANS = [Mean("price", "mean_price", 1, 2)]
COUNTS = [CountBy("status", {"F": "filled", "O": "open", "P": "pending"})]


def test_a_hot_key_in_a_merge_join_is_split(spark, samples, settings, hot, rows):
    codes = sample_queries.customer_nations(spark, samples)
    plain = profile(conform(hot, codes, {"c_custkey": "customer_key"}, ["nation_key"]), ["nation_key", "month"], MEANS, COUNTS)
    want = rows(plain)
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
    )
    split = profile(conform(hot, codes, {"c_custkey": "customer_key"}, ["nation_key"]), ["nation_key", "month"], MEANS, COUNTS)
    assert rows(split) == want
    assert "skew=true" in final_plan(split)


def test_preaggregation_moves_one_row_per_code_and_month(spark, samples, settings, hot, rows):
    codes = sample_queries.customer_nations(spark, samples)
    on, keys = {"c_custkey": "customer_key"}, ["nation_key", "month"]
    want = rows(profile(conform(hot, codes, on, ["nation_key"]), keys, MEANS, COUNTS))
    early = profile_preaggregated(hot, codes, on, ["nation_key"], keys, MEANS, COUNTS)
    assert rows(early) == want
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(profile_preaggregated(hot, codes, on, ["nation_key"], keys, MEANS, COUNTS))
    join = text.index("SortMergeJoin")
    assert "HashAggregate" in text[join:], "the aggregation has to sit below the join"


@pytest.mark.parametrize(
    "build",
    [
        lambda df: dedup_first(df, ["customer_key"], ["price"]),
        lambda df: duplicate_keys(df, ["customer_key"]),
        lambda df: orphan_keys(df, "customer_key", df.filter("customer_key < 3"), "customer_key"),
    ],
)
def test_a_hot_group_is_folded_before_the_shuffle(spark, hot, build):
    text = plan(build(hot.select("customer_key", "price")))
    assert re.search(r"Exchange hashpartitioning\(customer_key#\d+L?, .*?\n.*?Aggregate\(key", text)


def test_dedup_of_a_hot_group_equals_the_minimum(spark, hot):
    got = dedup_first(hot.select("customer_key", "price", "month"), ["customer_key"], ["price"])
    least = hot.groupBy("customer_key").agg(F.min("price").alias("price"))
    assert got.count() == least.count()
    assert got.join(least, ["customer_key", "price"]).count() == least.count()


def test_star_fact_reads_small_stages_and_shuffles_once(spark, samples):
    """Lookups come from written stages, so their size is known and small ones are broadcast."""
    text = plan(sample_queries.star_fact(spark, samples))
    # One shuffle for the profile, one for the few ports with equal entries.
    assert text.count("BroadcastHashJoin") == 2 and text.count("Exchange hashpartitioning") == 2
    assert "rangepartitioning" not in text, "sorts inside the flow have to be gone"


def test_a_code_hot_on_both_sides_forms_no_pairs(spark, settings, rows):
    """A third of the rows and a third of the lookup share one code."""
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("code"), F.lit(1).alias("month"), (F.col("id") % 7).alias("v")
    )
    codes = spark.range(3000).select(F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id")).alias("c"), (F.col("id") % 2).alias("state"))
    mean, keys = [Mean("v", "m", 1)], ["state", "month"]
    want = rows(profile(conform(facts, codes, {"c": "code"}, ["state"]), keys, mean, []))
    joined = conform(facts, fold_codes(codes, ["c"], ["state"], "w"), {"c": "code"}, ["state", "w"])
    assert joined.count() < 2 * 3000 and conform(facts, codes, {"c": "code"}, ["state"]).count() > 900 * 1000
    assert rows(profile(joined, keys, mean, [], weight="w")) == want
    assert rows(profile_preaggregated(facts, codes, {"c": "code"}, ["state"], keys, mean, [])) == want


def test_readings_are_pruned_to_the_wanted_years(spark, tmp_path, settings):
    settings(spark__sql__maxMetadataStringLength="10000")
    readings = spark.createDataFrame([], "dt date, AverageTemperature float, AverageTemperatureUncertainty float, State string, Country string")
    stage = write_stage(readings, str(tmp_path / "readings"))
    text = plan(star.complete_temperatures(stage))
    assert text.count("GreaterThanOrEqual(dt,2010-01-01)") == 1 and text.count("LessThan(dt,2014-01-01)") == 1
    assert "AverageTemperatureUncertainty" not in text
