import pytest

from starlane.operators import (
    DataQualityError, audit, duplicate_keys, enforce, length_counts, null_counts, orphan_keys, report_of, write_checked,
)
from starlane.sources.contracts import TableContract

CONTRACT = TableContract(
    name="t", columns="k varchar(2), n int, d string", key=("k", "n"), required=("k", "n"), references={"d": ("dim", "code")}
)


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("x",), ("y",), (None,)], "code string")


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, n int, d string")


def test_null_and_length_counts(spark):
    df = frame(spark, ("aa", 1, None), (None, None, "x"), ("long", 2, "y"))
    assert [tuple(r) for r in null_counts(df, ["k", "n", "d"]).collect()] == [("not_null", "k", 1), ("not_null", "n", 1), ("not_null", "d", 1)]
    assert [tuple(r) for r in length_counts(df, ["k"], {"k": 2}).collect()] == [("not_null", "k", 1), ("max_length", "k", 1)]
    assert [r.violations for r in null_counts(df.filter("n > 99"), ["k", "n"]).collect()] == [0, 0]


def test_duplicate_and_orphan_keys(spark, rows, dim):
    df = frame(spark, ("a", 1, "x"), ("a", 1, "q"), ("a", 2, "q"), (None, 1, None), (None, 1, "y"))
    assert rows(duplicate_keys(df, ["k", "n"], "rows")) == [(None, 1, 2), ("a", 1, 2)]
    with pytest.raises(ValueError):
        duplicate_keys(df, ["k", "n"])
    assert rows(orphan_keys(df, "d", dim, "code")) == [("q", 2)]


def test_clean_table_passes(spark, dim):
    enforce(audit(frame(spark, ("a", 1, "x"), ("a", 2, None)), CONTRACT, {"dim": dim}))
    enforce(audit(frame(spark), CONTRACT, {"dim": dim}))


@pytest.mark.parametrize(
    "bad, named",
    [
        (("a", None, "x"), r"1 check\(s\) failed: not_null\(n\): 1"),
        (("abc", 1, "x"), r"max_length\(k\): 1"),
        (("z", 9, "x"), r"unique_key\(k,n\): 1"),
        (("b", 1, "nowhere"), r"foreign_key\(d\): 1"),
    ],
)
def test_each_violation_raises(spark, dim, bad, named):
    with pytest.raises(DataQualityError, match=named):
        enforce(audit(frame(spark, ("z", 9, "x"), bad), CONTRACT, {"dim": dim}))


def test_all_violations_are_named_at_once(spark, dim):
    df = frame(spark, (None, 1, "x"), ("abc", 1, "no"), ("abc", 1, "no"))
    with pytest.raises(DataQualityError) as error:
        enforce(audit(df, CONTRACT, {"dim": dim}))
    assert str(error.value) == "4 check(s) failed: foreign_key(d): 2; max_length(k): 2; not_null(k): 1; unique_key(k,n): 1"


def test_unknown_columns_and_missing_references_raise(spark, dim):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        null_counts(frame(spark), ["no_such"])
    with pytest.raises(ValueError, match="dim"):
        audit(frame(spark), CONTRACT)


@pytest.mark.parametrize("least", [0, 9])
def test_a_checked_write_counts_what_an_audit_counts(spark, rows, dim, tmp_path, least):
    contract = TableContract(**{**CONTRACT.__dict__, "min_rows": least})
    df = frame(spark, (None, 1, "x"), ("abc", 1, "no"), ("abc", 1, "no"), ("abc", 1, "y"), (None, 1, None), ("a", None, "nowhere"))
    written, lines = write_checked(df, str(tmp_path / "t"), contract, {"dim": dim.union(dim)})
    assert rows(report_of(spark, lines)) == rows(audit(df, contract, {"dim": dim}))
    assert rows(written) == rows(df) and written.columns == df.columns
    with pytest.raises(DataQualityError, match="unique_key"):
        enforce(lines)
    _, clean = write_checked(frame(spark, ("a", 1, "x")), str(tmp_path / "c"), CONTRACT, {"dim": dim})
    enforce(clean)
    with pytest.raises(ValueError, match="dim"):
        write_checked(df, str(tmp_path / "u"), CONTRACT)


def test_a_checked_write_reads_nothing_again(spark, dim, tmp_path):
    spark.sparkContext.setJobGroup("checked", "checked")
    df = spark.range(100).selectExpr("string(id) AS k", "int(id) AS n", "CAST(NULL AS string) AS d")
    write_checked(df, str(tmp_path / "t"), CONTRACT, {"dim": dim})
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    names = [tracker.getStageInfo(s).name for j in tracker.getJobIdsForGroup("checked") for s in tracker.getJobInfo(j).stageIds]
    assert names and not [n for n in names if n.startswith(("collect", "count"))]
