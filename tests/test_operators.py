import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starlane.operators import (
    CountBy, Mean, build_dimension, conform, dedup_first, donor_mean, enrich, fold_codes, impute_periods, is_null, key_filter, match,
    not_null, pivot_count, presum, preview, profile, profile_preaggregated, profile_sums, recombine, row_count, union_rows,
    unmatched_counts,
)
from starlane.plans.monthly import MonthlySums
from starlane.plans.reports import category_mix_report, register_views

GENDER = CountBy("gender", {"F": "F", "M": "M", "U": "U", "X": "X"})
VISA = CountBy("visa", {1: "business", 2: "pleasure", 3: "student"})


# -- shape ----------------------------------------------------------------------


def test_not_null_and_is_null(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "n int, s string")
    assert rows(not_null(df, ["n", "s"])) == [(1, "a")]
    assert rows(is_null(df, "n")) == [(None, "b")]


def test_union_matches_names_and_widens(spark, rows):
    a = spark.createDataFrame([("x", 1.5)], "s string, v float")
    b = spark.createDataFrame([(2.25, "y")], "v double, s string")
    out = union_rows(a, b, b)
    assert out.dtypes == [("s", "string"), ("v", "double")]
    assert rows(out) == [("x", 1.5), ("y", 2.25), ("y", 2.25)]
    with pytest.raises(ValueError):
        union_rows()


def test_preview_and_row_count(spark):
    df = spark.range(50).select(F.col("id").alias("n"))
    assert [r.n for r in preview(df, 3, F.desc("n")).collect()] == [49, 48, 47]
    assert row_count(df).first().n_rows == 50
    assert row_count(df.filter("n < 0")).first().n_rows == 0


# -- dedup and dimension --------------------------------------------------------


def test_dedup_keeps_the_whole_least_row(spark, rows):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "z"), ("a", 1, "b"), (None, 5, "n1"), (None, 4, "n2"), ("c", None, "q"), ("c", 0, "p")],
        "k string, o int, v string",
    )
    want = [(None, 4, "n2"), ("a", 1, "b"), ("c", None, "q")]
    for parts in (1, 7):
        assert rows(dedup_first(df.repartition(parts), ["k"], ["o"])) == want
    assert dedup_first(df, ["k"], ["o"]).columns == df.columns


def test_dedup_on_all_columns_and_odd_names(spark, rows):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "`a b` int, `c.d` string")
    assert rows(dedup_first(df, ["a b", "c.d"])) == [(1, "x"), (2, "y")]
    assert rows(dedup_first(df, ["a b"])) == [(1, "x"), (2, "y")]


def test_dimension_counts_each_entity_once(spark, rows):
    df = spark.createDataFrame(
        [("Ames", "Iowa", "IA", 20.0, 10), ("Ames", "Iowa", "IA", 20.0, 10), ("Davenport", "Iowa", "IA", 40.0, 5),
         ("Salem", "Oregon", "OR", 30.0, None), ("Salem", "Utah", "UT", 50.0, 7), ("Provo", "Utah", "UT", 10.0, 1),
         ("Odd", "Deseret", "UT", 99.0, 1)],
        "city string, state string, code string, age double, people int",
    )
    out = build_dimension(
        df, entity=["city"], keys={"code": "key", "state": "name"}, uses=["age", "people"], order=["state"],
        measures=[F.avg("age").alias("age"), F.sum("people").alias("people")], primary="key",
    )
    # Salem belongs to one state only; the two names of UT leave one row.
    assert [tuple(r) for r in out.collect()] == [("IA", "Iowa", 30.0, 15), ("OR", "Oregon", 30.0, None), ("UT", "Deseret", 99.0, 1)]


# -- joins ----------------------------------------------------------------------


def test_conform_drops_unmatched_and_null_keys_and_fans_out(spark, rows):
    facts = spark.createDataFrame([(1, "A"), (2, "B"), (3, "Z"), (4, None)], "id int, port string")
    codes = spark.createDataFrame([("A", "IA"), ("B", "IN"), ("B", "IL"), (None, "XX")], "code string, state string")
    out = conform(facts, codes, on={"code": "port"}, take=["state"], keep=["id"])
    assert rows(out) == [(1, "IA"), (2, "IL"), (2, "IN")]
    assert conform(facts, codes, {"code": "port"}, ["state"]).columns == ["id", "port", "state"]


def test_conform_on_a_computed_key(spark, rows):
    airports = spark.createDataFrame([("K1", "US-CA"), ("K2", "US-U-A"), ("K3", None)], "ident string, region string")
    states = spark.createDataFrame([("CA", "California"), ("NY", "New York")], "state_key string, name string")
    out = conform(airports, states, {"state_key": F.substring("region", 4, 2)}, ["state_key", "name"], keep=["ident"])
    assert rows(out) == [("K1", "CA", "California")]


def test_conform_of_a_frame_with_its_own_descendant(spark, rows):
    base = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    peak = base.groupBy("k").agg(F.max("v").alias("peak"))
    assert rows(conform(base, peak, {"k": "k"}, ["peak"])) == [(1, 5, 5), (2, 6, 6)]


def test_conform_refuses_names_from_both_sides(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="v"):
        conform(df, df, {"k": "k"}, ["v"])


def test_enrich_on_part_of_the_key(spark, rows):
    fact = spark.createDataFrame([("IA", 1, 2015, 7), ("IA", 1, 2016, 8), ("IA", 2, 2016, 9)], "s string, month int, year int, n int")
    temps = spark.createDataFrame([("IA", 1, -7.5)], "s string, month int, t double")
    out = enrich(fact, temps, ["s", "month"])
    assert rows(out.select("s", "month", "year", "n", "t")) == [("IA", 1, 2015, 7, -7.5), ("IA", 1, 2016, 8, -7.5)]
    assert sorted(out.columns) == ["month", "n", "s", "t", "year"]


# -- profiles -------------------------------------------------------------------


def test_pivot_cells_are_null_or_zero_and_columns_are_fixed(spark, rows):
    df = spark.createDataFrame([("a", "F"), ("a", "F"), ("a", "Z"), ("b", None), ("b", "M")], "k string, gender string")
    assert rows(pivot_count(df, ["k"], GENDER)) == [("a", 2, None, None, None), ("b", None, 1, None, None)]
    assert rows(pivot_count(df, ["k"], GENDER, fill_zero=True)) == [("a", 2, 0, 0, 0), ("b", 0, 1, 0, 0)]
    assert pivot_count(df, ["k"], GENDER).columns == ["k", "F", "M", "U", "X"]


@pytest.mark.parametrize("kind", ["int", "double", "bigint"])
def test_numeric_codes_match_whatever_their_type(spark, rows, kind):
    df = spark.createDataFrame([(1.0,), (1.0,), (3.0,), (9.0,)], "visa double").select(F.lit("k").alias("k"), F.col("visa").cast(kind))
    assert rows(pivot_count(df, ["k"], VISA)) == [("k", 2, None, 1)]


def test_pivot_agrees_with_the_built_in_pivot(spark, rows):
    rng = random.Random(7)
    df = spark.createDataFrame([(rng.randrange(5), rng.choice("FMUXZ")) for _ in range(300)], "k int, gender string")
    assert rows(pivot_count(df, ["k"], GENDER)) == rows(df.groupBy("k").pivot("gender", list("FMUX")).count())


def arrivals(spark, seed=3, n=600):
    rng = random.Random(seed)

    def maybe(value):
        return None if rng.random() < 0.05 else value

    data = [
        (maybe(rng.choice(["P1", "P1", "P1", "P2", "P3", "P9"])), maybe(rng.randrange(1, 4)), maybe(2016),
         maybe(float(rng.randrange(1, 90))), maybe(rng.choice("FMUXZ")), maybe(float(rng.randrange(1, 6))))
        for _ in range(n)
    ]
    return data, spark.createDataFrame(data, "port string, month int, year int, age double, gender string, visa double")


PORTS = [("P1", "IA"), ("P2", "IA"), ("P2", "GA"), ("P3", "GA"), ("P3", "GA"), (None, "XX")]
KEYS = ["state", "month", "year"]
REQUIRED = ["age", "month", "gender", "visa", "year"]


def expected_profile(data):
    """The profile by hand, row by row."""
    groups = defaultdict(list)
    for port, month, year, age, gender, visa in data:
        if None in (port, month, year, age, gender, visa):
            continue
        for code, state in PORTS:
            if code == port:
                groups[state, month, year].append((age, gender, visa))
    out = []
    for key, members in groups.items():
        cells = [sum(1 for m in members if m[1] == g) or None for g in "FMUX"]
        cells += [sum(1 for m in members if m[2] == v) or None for v in (1, 2, 3)]
        total, n = int(sum(m[0] for m in members)), len(members)
        out.append((*key, (20 * total + n) // (2 * n) / 10, *cells))
    return sorted(out, key=str)


def test_three_forms_of_the_profile_agree_with_counting_by_hand(spark):
    data, df = arrivals(spark)
    ports = spark.createDataFrame(PORTS, "code string, state string")
    mean = Mean("age", "mean_age", digits=1)
    placed = conform(df, ports, {"code": "port"}, ["state"])
    clean = not_null(placed, REQUIRED)
    forms = [
        profile(placed, KEYS, [mean], [GENDER, VISA], REQUIRED),
        recombine(KEYS, profile(clean, KEYS, [mean], []), pivot_count(clean, KEYS, GENDER), pivot_count(clean, KEYS, VISA)),
        profile_preaggregated(df, ports, {"code": "port"}, ["state"], KEYS, [mean], [GENDER, VISA], REQUIRED),
        profile(placed, KEYS, [Mean("age", "mean_age", digits=1, units=1)], [GENDER, VISA], REQUIRED),
    ]
    folded = conform(df, fold_codes(ports, ["code"], ["state"], "w"), {"code": "port"}, ["state", "w"])
    for m in (mean, Mean("age", "mean_age", digits=1, units=1)):
        forms.append(profile(folded, KEYS, [m], [GENDER, VISA], REQUIRED, weight="w"))
    want = expected_profile(data)
    for form in forms:
        assert form.columns == [*KEYS, "mean_age", "F", "M", "U", "X", "business", "pleasure", "student"]
        assert sorted((tuple(r) for r in form.collect()), key=str) == want


def test_folded_codes_keep_their_number(spark, rows):
    ports = spark.createDataFrame(PORTS, "code string, state string")
    assert rows(fold_codes(ports, ["code"], ["state"], "w")) == [(None, "XX", 1), ("P1", "IA", 1), ("P2", "GA", 1), ("P2", "IA", 1), ("P3", "GA", 2)]


def test_weights_do_not_count_missing_values(spark, rows):
    df = spark.createDataFrame([("a", None, 5), ("a", 2.0, 1), ("a", 5.0, 2), ("b", None, 3)], "k string, v double, w bigint")
    for mean in (Mean("v", "m"), Mean("v", "m", 1), Mean("v", "m", 1, 2)):
        assert rows(profile(df, ["k"], [mean], [], weight="w")) == [("a", 4.0), ("b", None)]


def test_preaggregated_profile_keeps_the_join_key_as_a_group(spark, rows):
    _, df = arrivals(spark)
    ports = spark.createDataFrame(PORTS, "code string, state string")
    means, keys = [Mean("age", "mean_age", digits=1)], ["state", "port"]
    got = profile_preaggregated(df, ports, {"code": "port"}, ["state"], keys, means, [GENDER], REQUIRED)
    assert rows(got) == rows(profile(conform(df, ports, {"code": "port"}, ["state"]), keys, means, [GENDER], REQUIRED))


def test_means_of_groups_without_values_are_null(spark, rows):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, v double")
    for mean in (Mean("v", "m"), Mean("v", "m", 1), Mean("v", "m", 1, 2), Mean("v", "m", None, 2)):
        assert rows(profile(df, ["k"], [mean], [])) == [("a", None), ("b", 2.0)]


def test_declared_categories_add_up_to_the_row_count(spark):
    _, df = arrivals(spark)
    clean = not_null(df, REQUIRED).filter(F.col("gender") != "Z")
    out = pivot_count(clean, ["month"], GENDER, fill_zero=True).withColumn("total", F.col("F") + F.col("M") + F.col("U") + F.col("X"))
    counted = {r.month: r["count"] for r in clean.groupBy("month").count().collect()}
    assert {r.month: r.total for r in out.collect()} == counted


# -- imputation -----------------------------------------------------------------

SERIES = [
    ("IA", 2010, 10, 10.0), ("IA", 2011, 10, 13.0), ("IA", 2012, 10, None), ("IA", 2009, 10, 99.0), ("IA", 2010, 9, 50.0),
    ("IA", 2013, 9, 18.0), ("IA", 2013, 1, None), ("GA", 2012, 12, 8.0), ("GA", 2013, 12, 6.0), ("XX", 2010, 11, None),
]


def impute(spark, **choices):
    df = spark.createDataFrame(SERIES, "state string, year int, month int, reading float")
    value = Mean("reading", "temperature")
    return impute_periods(df, ["state"], value, 2013, [2010, 2011, 2012], [10, 11, 12], **choices)


def test_imputation_appends_donor_means_to_untouched_observations(spark, rows):
    want = [
        ("GA", 6.0, 12, 2013), ("GA", 8.0, 12, 2013), ("IA", None, 1, 2013), ("IA", 11.5, 10, 2013), ("IA", 18.0, 9, 2013),
        ("XX", None, 11, 2013),
    ]
    out = impute(spark)
    assert out.columns == ["state", "temperature", "month", "year"] and rows(out) == want


def test_only_missing_leaves_observed_months_alone(spark, rows):
    assert ("GA", 8.0, 12, 2013) not in rows(impute(spark, only_missing=True))
    assert len(rows(impute(spark, only_missing=True))) == len(rows(impute(spark))) - 1


def test_every_repeat_of_an_observed_reading_stays(spark, rows):
    df = spark.createDataFrame([("A", 2013, 1, 5.0)] * 9000 + [("A", 2013, 1, None)] * 4097 + [("A", 2013, 2, 1.0), ("A", 2012, 10, 3.0)], "state string, year int, month int, reading double").repartition(5)
    out = impute_periods(df, ["state"], Mean("reading", "t"), 2013, [2012], [1, 10])
    assert rows(out.groupBy("state", "t", "month", "year").count()) == [("A", None, 1, 2013, 4097), ("A", 1.0, 2, 2013, 1), ("A", 3.0, 10, 2013, 1), ("A", 5.0, 1, 2013, 9000)]


@pytest.mark.parametrize("only_missing", [False, True])
def test_one_pass_imputation_equals_two_passes(spark, rows, only_missing):
    import random

    pick = random.Random(3)
    made = [(pick.choice("ABC"), pick.choice([None, 2010, 2011, 2012, 2013]), pick.choice([None, 1, 2, 3]), pick.choice([None, 1.5, 2.5, float("nan")])) for _ in range(400)]
    df = spark.createDataFrame([(s if s != "C" else None, *r) for s, *r in made], "state string, year int, month int, reading double")
    for donors in ([2010, 2011], [2012, 2013]):
        value = Mean("reading", "t")
        got = impute_periods(df, ["state"], value, 2013, donors, [1, 2], only_missing=only_missing)
        observed = df.where("year = 2013").selectExpr("state", "reading as t", "month", "year")
        filled = donor_mean(df, ["state"], value, 2013, donors, [1, 2])
        if only_missing:
            known = {(r.state, r.month) for r in observed.collect()}
            want = [tuple(r) for r in filled.collect() if (r.state, r.month) not in known]
        else:
            want = [tuple(r) for r in filled.collect()]
        want += [tuple(r) for r in observed.collect()]
        assert sorted(map(str, rows(got))) == sorted(map(str, want)) and got.columns == observed.columns


def test_donor_mean_alone(spark, rows):
    df = spark.createDataFrame(SERIES, "state string, year int, month int, reading float")
    out = donor_mean(df, ["state"], Mean("reading", "temperature", 1), 2013, [2010, 2011, 2012], [10])
    assert rows(out) == [("IA", 11.5, 10, 2013)]


# -- reports --------------------------------------------------------------------


def test_report_is_one_entity_in_month_order(spark):
    fact = spark.createDataFrame([("CA", 3, 5, 1), ("CA", 1, 6, 2), ("NY", 1, 7, 3), ("ZZ", 1, 1, 1)], "k string, month int, F int, M int")
    dim = spark.createDataFrame([("CA", "California"), ("NY", "New York")], "k string, name string")
    assert [tuple(r) for r in category_mix_report(spark, fact, dim, "k", "CA", ["F", "M"]).collect()] == [(1, 6, 2), (3, 5, 1)]
    assert category_mix_report(spark, fact, dim, "k", "ZZ", ["F"]).count() == 0
    assert category_mix_report(spark, fact, dim, "k", "x' OR '1'='1", ["F"]).count() == 0


def test_registered_views_answer_plain_sql(spark):
    register_views(spark, v_fact=spark.createDataFrame([("CA", 1)], "k string, n int"))
    assert spark.sql("SELECT n FROM v_fact WHERE k = 'CA'").first().n == 1


def test_a_match_accounts_for_every_row(spark, tmp_path, rows):
    sums = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("b", 1, 1), (None, 1, 2), ("c", 3, 4)], "code string, month int, n long")
    codes = spark.createDataFrame([("a", "X", 2), ("c", "Y", 1), ("c", "Z", 1), (None, "N", 1)], "key string, place string, weight int")
    met = match(sums, codes, {"key": "code"}, ["place", "weight"], str(tmp_path / "met"))
    assert rows(met.rows) == [("a", 1, 5, "X", 2), ("a", 2, 7, "X", 2), ("c", 3, 4, "Y", 1), ("c", 3, 4, "Z", 1)]
    assert rows(met.unmatched) == [(None, 1, 2), ("b", 1, 1)] and met.unmatched.columns == sums.columns
    assert rows(unmatched_counts(sums, codes, {"key": "code"})) == [(None, 1), ("b", 1)]
    with pytest.raises(ValueError, match="both sides"):
        match(sums, codes.withColumnRenamed("place", "n"), {"key": "code"}, ["n"], str(tmp_path / "clash"))
    nothing = match(sums.limit(0), codes, {"key": "code"}, ["place"], str(tmp_path / "nothing"))
    assert nothing.rows.count() == nothing.unmatched.count() == 0


@pytest.mark.parametrize("most_bits", [32, 1 << 16, 1 << 20])
def test_a_key_filter_loses_no_match(spark, most_bits):
    codes = spark.range(0, 3000, 3).selectExpr("int(id) AS key", "id AS other").union(spark.sql("SELECT CAST(NULL AS INT), 1L"))
    rows = spark.range(0, 30_000).selectExpr("id AS n").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    kept = rows.where(key_filter(codes, {"key": "n"}, most_bits))
    found = {r.n for r in kept.collect()}
    assert {r for r in range(0, 3000, 3)} <= found and None not in found
    # A thousand keys among 2^16 bits let 1.5 % of the others through.
    assert len(found) < (30_000 * 0.08 if most_bits > 32_768 else 30_001)
    pairs = spark.range(100).selectExpr("id AS a", "string(id % 7) AS b")
    both = spark.sql("SELECT 3L AS x, '3' AS y UNION ALL SELECT 8L, '1'")
    assert {(3, "3"), (8, "1")} <= {tuple(r) for r in pairs.where(key_filter(both, {"x": "a", "y": "b"})).collect()}
    assert rows.where(key_filter(codes.limit(0), {"key": "n"})).count() == 0


def test_a_key_filter_of_many_keys_lets_all_through(spark):
    codes = spark.range(0, 200_000).selectExpr("id AS key")
    assert spark.range(100_000, 400_000).where(key_filter(codes, {"key": "id"}, 1 << 15)).count() == 300_000


def test_kept_sums_add_up_and_a_delivery_counts_once(spark, tmp_path, rows):
    df = spark.range(600).selectExpr("id % 7 AS k", "double(id) AS x", "if(id % 3 = 0, 'a', 'b') AS c")
    how = [Mean("x", "mean", digits=1)], [CountBy("c", {"a": "a", "b": "b"})]
    sums = MonthlySums(spark, str(tmp_path / "sums"), ["k"])
    parts = df.where("x < 200"), df.where("x >= 200")
    for label, part in (("one", parts[1]), ("two", parts[1]), ("one", parts[0])):
        sums.add(label, presum(part, ["k"], *how))
    assert len(sums.batches()) == 2 and rows(profile_sums(sums.total(), ["k"], *how)) == rows(profile(df, ["k"], *how))
