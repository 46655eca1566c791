"""Error-free sums: the same bits for every layout, and close to the true sum."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F
from starlane.operators import CountBy, Mean, donor_mean, profile_exact

MEAN = [Mean("x", "mean")]


def bits(value):
    return None if value is None else struct.pack(">d", value)


def mean_of(spark, values):
    df = spark.createDataFrame([(1, v) for v in values], "k int, x double")
    return profile_exact(df, ["k"], MEAN).collect()[0]["mean"]


def messy(n, low, high, seed):
    draw = random.Random(seed)
    return [draw.choice((-1, 1)) * draw.random() * 2.0 ** draw.randint(low, high) for _ in range(n)]


@pytest.mark.parametrize("low, high", [(0, 4), (-40, 40), (-1060, 1000)])
def test_shuffled_rows_give_the_same_bits(spark, low, high):
    values = [(i % 3, x) for i, x in enumerate(messy(3000, low, high, low))]
    got = set()
    for seed, parts in [(1, 1), (2, 3), (3, 11)]:
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame(values, "k int, x double").repartition(parts)
        got.add(tuple(sorted((r["k"], bits(r["mean"])) for r in profile_exact(df, ["k"], MEAN).collect())))
    assert len(got) == 1
    for k, mean in next(iter(got)):
        true = math.fsum(x for i, x in values if i == k) / 1000
        assert math.isclose(struct.unpack(">d", mean)[0], true, rel_tol=1e-15)


@pytest.mark.parametrize(
    "values",
    [
        [0.1] * 10, [1e300, 1.0, -1e300], [1e8, -1e8, -0.1], [5e-324] * 4, [2.0**24, -(2.0**24 - 2.0**-29)], [0.0, -0.0],
        [1e16, 1.0, 1.0, -1e16], [1.7e308, -1.7e308, 3.5], [2.0**48, -(2.0**-48)], [123456789.125, -0.375, 1e-12], [2.0**1023, 2.0**-1074],
    ],
)
def test_sum_is_that_of_the_real_numbers(spark, values):
    assert mean_of(spark, values) == math.fsum(values) / len(values)


def test_defined_cases(spark):
    inf, nan = float("inf"), float("nan")
    assert mean_of(spark, [1.0, inf]) == inf and mean_of(spark, [-inf, 5.0]) == -inf
    assert math.isnan(mean_of(spark, [inf, -inf, 1.0])) and math.isnan(mean_of(spark, [nan, 1.0]))
    assert mean_of(spark, [None, 3.0, None]) == 3.0 and mean_of(spark, [None]) is None
    assert mean_of(spark, [1.7e308, 1.7e308]) == inf
    empty = spark.createDataFrame([], "k int, x double")
    assert profile_exact(empty, ["k"], MEAN).collect() == []
    assert [tuple(r) for r in profile_exact(empty, [], MEAN).collect()] == [(None,)]


def test_several_means_counts_and_a_null_key(spark, rows):
    df = spark.createDataFrame(
        [(None, 1.5, 1e9, "a"), (None, 2.5, None, "b"), (7, 1e-9, 3.0, "a"), (7, 1e9, 4.0, "a"), (7, None, 5.0, "c")],
        "k int, x double, y double, c string",
    )
    out = profile_exact(df, ["k"], [Mean("x", "mx", 1), Mean("y", "my")], [CountBy("c", {"a": "n_a", "b": "n_b"})])
    assert rows(out) == [(None, 2.0, 1e9, 1, 1), (7, 5e8, 4.0, 2, None)]


def test_donors_can_be_summed_exactly(spark):
    df = spark.createDataFrame([("A", v, 10, y) for y, v in [(2010, 1e16), (2011, 1.0), (2012, -1e16), (2012, 2.0)]], "s string, t double, month int, year int")
    out = donor_mean(df.repartition(4), ["s"], Mean("t", "t"), 2013, [2010, 2011, 2012], [10], exact=True)
    assert [tuple(r) for r in out.collect()] == [("A", 0.75, 10, 2013)]


def test_work_is_hash_aggregation_over_sums(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("x"))
    plan = profile_exact(df, ["k"], MEAN)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Python" not in plan
