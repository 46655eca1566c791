import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starlane.sources import (
    InputError, LayoutError, TableContract, conform_to, contracts, input_files, land_csv, publish, publish_all, publish_jdbc,
    read_csv, read_many, read_parquet, read_published, scratch_folder, sinks, unparsed_cells, versions, write_observed, write_stage,
)
from starlane.sources.contracts import TableContract

CITY_HEADER = (
    "City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;"
    "Foreign-born;Average Household Size;State Code;Race;Count"
)
SMALL = TableContract("small", "code varchar(2), n bigint, share double", key=("code",), required=("code",))


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_semicolon_csv_checks_its_header_and_nulls_bad_cells(spark, tmp_path):
    path = write(
        tmp_path / "cities.csv",
        CITY_HEADER,
        "Ames;Iowa;23.5;10;11;21;1;2;2.2;IA;White;9",
        "Gary;Indiana;37.1;many;;75;1;2;2.4;IN;Asian;3",
    )
    df = read_csv(spark, path, contracts.CITY_DEMOGRAPHICS, sep=";", aliases=contracts.CITY_ALIASES)
    assert len(df.columns) == 12 and df.columns[7] == "Foreign Born"
    got = df.select("City", "Median Age", "Male Population", "Female Population", "State Code").orderBy("City")
    assert [tuple(r) for r in got.collect()] == [("Ames", 23.5, 10, 11, "IA"), ("Gary", pytest.approx(37.1), None, None, "IN")]
    assert dict(df.dtypes)["Median Age"] == "float" and dict(df.dtypes)["Count"] == "int"


def test_comma_csv_with_dates_and_quoted_commas(spark, tmp_path):
    temps = write(
        tmp_path / "t.csv",
        "dt,AverageTemperature,AverageTemperatureUncertainty,State,Country",
        "2013-09-01,18.25,0.3,Iowa,United States",
        "2013-10-01,,,Iowa,United States",
    )
    df = read_csv(spark, temps, contracts.STATE_TEMPERATURE)
    assert [(str(r.dt), r.AverageTemperature) for r in df.orderBy("dt").collect()] == [("2013-09-01", 18.25), ("2013-10-01", None)]
    airports = write(
        tmp_path / "a.csv",
        "ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates",
        '00A,heliport,Total Rf,11,NA,US,US-PA,Bensalem,00A,,00A,"-74.9, 40.0"',
    )
    row = read_csv(spark, airports, contracts.AIRPORT_CODES).first()
    assert (row.iso_region, row.iata_code, row.local_code, row.coordinates) == ("US-PA", None, "00A", "-74.9, 40.0")


def test_unreadable_input_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_csv(spark, str(tmp_path / "nowhere.csv"), "a int").count()
    with pytest.raises(AnalysisException):
        read_parquet(spark, str(tmp_path / "nowhere"))


def test_monthly_files_become_one_table_with_lineage(spark, tmp_path):
    schema = "i94mon double, i94port string"
    for month in (1, 2, 3):
        spark.createDataFrame([(float(month), "NYC"), (float(month), "LAX")], schema).coalesce(1).write.parquet(
            str(tmp_path / f"m{month}")
        )
    df = read_many(spark, str(tmp_path / "m*"), schema, lineage="path")
    assert df.count() == 6 and df.select("path").distinct().count() == 3
    two = read_many(spark, [str(tmp_path / "m1"), str(tmp_path / "m3")], schema)
    assert sorted(r.i94mon for r in two.collect()) == [1.0, 1.0, 3.0, 3.0]
    # One scan, not a union of scans.
    assert "Union" not in df._jdf.queryExecution().toString()


def test_many_csv_files(spark, tmp_path):
    write(tmp_path / "1.csv", "a,b", "1,x")
    write(tmp_path / "2.csv", "a,b", "2,y")
    df = read_many(spark, str(tmp_path), "a int, b string", "csv", header="true")
    assert sorted(tuple(r) for r in df.collect()) == [(1, "x"), (2, "y")]


def test_stage_fails_if_present_unless_told_to_replace(spark, tmp_path):
    df, path = spark.range(5), str(tmp_path / "stage")
    assert write_stage(df, path).count() == 5
    with pytest.raises(AnalysisException):
        write_stage(df, path)
    assert write_stage(spark.range(3), path, mode="overwrite").count() == 3


def test_partitioned_stage_keeps_all_rows_and_splits_a_hot_folder(spark, settings, tmp_path):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__rebalancePartitionsSmallPartitionFactor="0.01",
    )
    df = spark.range(0, 60_000, numPartitions=8).select(
        "id", F.xxhash64("id").alias("noise"), F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("k")
    )
    back = write_stage(df, str(tmp_path / "stage"), partition_by=["k"])
    assert back.count() == 60_000 and back.select("id").distinct().count() == 60_000
    files = {r.k: r["count"] for r in back.select("k", "_metadata.file_path").distinct().groupBy("k").count().collect()}
    assert files[0] > 1 and files[3] == 1


def test_replacing_a_stage_replaces_every_folder(spark, settings, tmp_path):
    settings(spark__sql__sources__partitionOverwriteMode="dynamic")
    df, path = spark.range(10).withColumn("k", F.col("id") % 2), str(tmp_path / "stage")
    write_stage(df, path, partition_by=["k"])
    again = write_stage(df.filter("k = 1"), path, mode="overwrite", partition_by=["k"])
    assert [r.k for r in again.select("k").distinct().collect()] == [1]


def test_compact_and_sorted_stage(spark, tmp_path):
    df = spark.range(0, 4000, numPartitions=16).select((F.col("id") * 7919 % 4000).alias("n"), (F.col("id") % 2).alias("k"))
    loose = write_stage(df, str(tmp_path / "loose"))
    tight = write_stage(df, str(tmp_path / "tight"), compact=True, sort_by=["n"])
    assert len(loose.inputFiles()) == 16 and len(tight.inputFiles()) == 1
    assert [r.n for r in tight.collect()] == list(range(4000))
    folders = write_stage(df, str(tmp_path / "folders"), partition_by=["k"], sort_by=["n"])
    for k in (0, 1):
        kept = [r.n for r in folders.filter(F.col("k") == k).collect()]
        assert len(kept) == 2000 and kept == sorted(kept)


def test_conform_to_orders_casts_and_drops(spark):
    df = spark.createDataFrame([(1, "x", "IA", 3)], "share int, extra string, code string, n int")
    out = conform_to(df, SMALL)
    assert out.dtypes == [("code", "string"), ("n", "bigint"), ("share", "double")]
    with pytest.raises(AnalysisException):
        conform_to(df.drop("n"), SMALL)


def test_contract_lengths_and_output_layouts():
    assert contracts.DIMENSION_STATE.lengths == {"state_key": 2, "state_name": 256}
    assert [f.name for f in contracts.FACT_ARRIVALS.schema] == [
        "state_key", "month", "year", "average_age_arrivals", "F", "M", "U", "X",
        "business", "pleasure", "student", "average_temperature",
    ]


def test_publish_is_a_full_refresh_by_name(spark, tmp_path):
    place = str(tmp_path / "published")
    first = spark.createDataFrame([(0.5, 1, "IA"), (0.25, 2, "IN")], "share double, n int, code string")
    for _ in range(2):
        table = publish(first, SMALL, "published_small", place)
        assert sorted(tuple(r) for r in table.collect()) == [("IA", 1, 0.5), ("IN", 2, 0.25)]
    table = publish(first.filter("n = 2"), SMALL, "published_small", place)
    assert [tuple(r) for r in table.collect()] == [("IN", 2, 0.25)]
    assert spark.sql("SELECT sum(n) FROM published_small").first()[0] == 2


def test_publish_rejects_too_long_values(spark, tmp_path):
    df = spark.createDataFrame([("IOWA", 1, 0.5)], "code string, n int, share double")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        publish(df, SMALL, "published_long", str(tmp_path / "long"))


def test_jdbc_publish_truncates_and_reloads(spark, monkeypatch):
    """No database here: look at what is handed to Spark's writer."""
    seen = {}

    class Writer:
        def mode(self, value):
            seen["mode"] = value
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def jdbc(self, url, table, properties):
            seen.update(url=url, table=table, properties=properties)

    df = spark.createDataFrame([(1, "IA", 0.5)], "n int, code string, share double")
    monkeypatch.setattr(type(df), "write", property(lambda self: seen.update(columns=self.columns) or Writer()))
    publish_jdbc(df, SMALL, "jdbc:x:y", properties={"user": "me"}, connections=4)
    assert seen == {
        "columns": ["code", "n", "share"], "mode": "overwrite", "truncate": "true", "batchsize": "10000",
        "numPartitions": "4", "url": "jdbc:x:y", "table": "small", "properties": {"user": "me"},
    }


def test_scratch_folders_follow_the_session_and_go_with_it(tmp_path):
    code = (
        "from starlane.session import build_session\n"
        "from starlane.sources import scratch_folder, write_stage\n"
        f"spark = build_session('x', 'local[1]', spark__ui__enabled='false', spark__checkpoint__dir={str(tmp_path / 'c')!r})\n"
        "one, two = scratch_folder(spark, 'x'), scratch_folder(spark, 'x')\n"
        "print('ROWS', write_stage(spark.range(3), one).count(), one != two, one)\n"
    )
    out = in_process(code)
    assert f"ROWS 3 True {tmp_path}/c/starlane-scratch/" in out
    assert list((tmp_path / "c" / "starlane-scratch").iterdir()) == []


def in_process(code):
    import subprocess
    import sys
    from pathlib import Path

    run = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=180)
    assert run.returncode == 0, run.stderr[-2000:]
    return run.stdout


def test_a_later_session_publishes_onto_the_same_folder(tmp_path):
    code = (
        "from starlane.session import build_session\n"
        "from starlane.sources import TableContract, publish\n"
        f"spark = build_session('x', 'local[1]', spark__ui__enabled='false', spark__sql__warehouse__dir={str(tmp_path / 'w')!r})\n"
        "small = TableContract('small_table', 'code varchar(2), n bigint', key=('code',))\n"
        "print('ROWS', publish(spark.sql(\"SELECT 'IA' AS code, {} AS n\"), small).collect())\n"
    )
    assert "n=1)]" in in_process(code.replace("{}", "1")) and "n=2)]" in in_process(code.replace("{}", "2"))
    assert [p.name for p in (tmp_path / "w").iterdir() if p.name != "starlane-scratch"] == ["small_table"]


def test_publish_needs_the_layout_of_the_contract(spark, tmp_path):
    spark.sql(f"CREATE TABLE reordered (n bigint, code string, share double) USING parquet LOCATION '{tmp_path}/r'")
    df = spark.createDataFrame([("IA", 1, 0.5)], "code string, n bigint, share double")
    with pytest.raises(LayoutError, match="reordered"):
        publish(df, SMALL, "reordered")
    df.select("share", "n", "code").write.parquet(str(tmp_path / "folder"))
    with pytest.raises(LayoutError, match="folder"):
        publish(df, SMALL, "over_a_folder", str(tmp_path / "folder"))


def test_a_failed_publish_leaves_every_table_as_it_was(spark, tmp_path):
    good = spark.createDataFrame([("IA", 1, 0.5)], "code string, n int, share double")
    bad = spark.createDataFrame([("IOWA", 2, 0.5)], "code string, n int, share double")
    places = [("pair_one", str(tmp_path / "one")), ("pair_two", str(tmp_path / "two"))]
    publish_all([(good, SMALL, *p) for p in places])
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        publish_all([(good.withColumn("n", good["n"] + 5), SMALL, *places[0]), (bad, SMALL, *places[1])])
    assert [spark.table(name).collect() for name, _ in places] == [[("IA", 1, 0.5)]] * 2


def test_a_header_in_another_order_raises(spark, tmp_path):
    path = write(tmp_path / "t.csv", "dt,State,AverageTemperature,AverageTemperatureUncertainty,Country", "2013-09-01,Iowa,1.0,0.1,US")
    with pytest.raises(InputError, match="in this order"):
        read_csv(spark, path, contracts.STATE_TEMPERATURE)
    folder = tmp_path / "two"
    folder.mkdir()
    write(folder / "a.csv", "a,b", "1,2"), write(folder / "b.csv", "b,a", "1,2")
    with pytest.raises(Exception, match="(?s)header"):
        read_csv(spark, str(folder), "a int, b int").collect()


def test_a_parquet_file_without_a_column_raises(spark, tmp_path):
    both = spark.createDataFrame([(1, "x")], "a int, b string")
    both.write.parquet(str(tmp_path / "m1"))
    both.drop("b").write.parquet(str(tmp_path / "m2"))
    with pytest.raises(InputError, match="m2.*lacks b"):
        read_many(spark, str(tmp_path / "m*"), "a int, b string")
    with pytest.raises(InputError):
        read_many(spark, [str(tmp_path / "m2")], "a int, b string")
    (tmp_path / "empty").mkdir()
    with pytest.raises(InputError, match="no input files"):
        read_many(spark, str(tmp_path / "empty"), "a int, b string")


def test_bad_cells_are_counted(spark, tmp_path, rows):
    path = write(tmp_path / "c.csv", "d,n", "2013-01-01,1", "2013-13-01,x", ",2", "2013-01-02,")
    assert rows(unparsed_cells(spark, path, "d date, n int")) == [("d", 1, 1), ("n", 1, 1)]


def test_import_runs_no_job_and_starts_no_session():
    import subprocess
    import sys
    from pathlib import Path

    code = (
        "import json, __spark_entry__, starlane.plans.star\n"
        "from pyspark import SparkContext\n"
        "print(json.dumps(SparkContext._active_spark_context is None))"
    )
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=120
    )
    assert json.loads(out.stdout) is True


@pytest.mark.parametrize("source", ["parquet", "orc", "json"])
def test_files_of_every_format_need_every_column(spark, tmp_path, source):
    whole = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string").coalesce(1)
    for name, df in (("m1", whole), ("m2", whole.drop("b")), ("m3", whole.drop("b"))):
        df.write.format(source).save(str(tmp_path / name))
    df = read_many(spark, str(tmp_path / "m1"), "a int, b string", source)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "x"), (2, "y")]
    with pytest.raises(InputError, match="/m2/.* lacks b, and so do 1 more files"):
        read_many(spark, str(tmp_path / "m*"), "a int, b string", source)
    with pytest.raises(InputError, match="/m3/.* lacks b$"):
        read_many(spark, [str(tmp_path / "m3")], "a int, b string", source)
    (tmp_path / "empty").mkdir()
    with pytest.raises(InputError, match="no input files"):
        read_many(spark, str(tmp_path / "empty"), "a int, b string", source)


def test_columns_of_folders_and_null_keys_count_as_there(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 5), (2, None, 6)], "a int, b string, month int")
    for source in ("parquet", "orc", "json"):
        place = str(tmp_path / source)
        df.write.format(source).partitionBy("month").option("ignoreNullFields", "false").save(place)
        got = read_many(spark, f"{place}/month=*", "a int, b string, month int", source, basePath=place)
        assert sorted(tuple(r) for r in got.collect()) == [(1, "x", 5), (2, None, 6)]
    (tmp_path / "lists.json").write_text('[{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]\n')
    assert read_many(spark, str(tmp_path / "lists.json"), "a int, b string", "json").count() == 2
    (tmp_path / "wide.json").write_text('{"a": 1,\n "b": "x"}\n')
    assert read_many(spark, str(tmp_path / "wide.json"), "a int, b string", "json", multiLine="true").count() == 1
    with pytest.raises(InputError, match="wide.json lacks c"):
        read_many(spark, str(tmp_path / "wide.json"), "a int, c string", "json", multiLine="true")


def test_a_store_that_only_spark_opens_is_judged_by_its_values(spark, tmp_path):
    both = spark.createDataFrame([(1, "x")], "a int, b string")
    both.write.parquet(str(tmp_path / "m1")), both.drop("b").write.parquet(str(tmp_path / "m2"))
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.here.link./in", f"file://{tmp_path}")
    assert read_many(spark, "viewfs://here/in/m1", "a int, b string").count() == 1
    with pytest.raises(InputError, match="m2.* lacks b"):
        read_many(spark, "viewfs://here/in/m*", "a int, b string")


def test_no_list_of_files_goes_through_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "inputFiles", lambda self: pytest.fail("file list on the driver"))
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "m1"))
    assert read_many(spark, str(tmp_path / "m1"), "a int").count() == 1
    listed = input_files(spark, [str(tmp_path / "m1")])
    assert listed.columns == ["path", "length", "modificationTime"] and listed.first().length > 0


CITIES = "d date, n int, `a name` string"


def landed(spark, tmp_path, name="landed", **options):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    write(folder / "a.csv", "d;n;a name", "2013-01-01;1;x", "2013-13-01;y;z", ";2;", "2013-01-02;;w")
    write(folder / "b.csv", "d;n;a name", "2013-01-03;3", "2013-01-04;4;u;v")
    return land_csv(spark, str(folder), CITIES, str(tmp_path / name), sep=";", **options)


def test_a_file_lands_once_with_its_faulty_rows_apart(spark, tmp_path, rows):
    got = landed(spark, tmp_path)
    plain = read_csv(spark, str(tmp_path / "in"), CITIES, sep=";")
    assert got.rows.dtypes == plain.dtypes and rows(got.rows) == rows(plain)
    faulty = sorted((r.file.rsplit("/", 1)[-1], r.line, r.faults) for r in got.rejected.collect())
    assert faulty == [("a.csv", "2013-13-01;y;z", ["d", "n"]), ("b.csv", "2013-01-03;3", []), ("b.csv", "2013-01-04;4;u;v", [])]
    assert got.counts["rows"] == 6 and got.counts["faulty"] == 3 and got.unparsed() == {"d": 1, "n": 1, "a name": 0}
    assert rows(got.report()) == [("a name", 2, 0), ("d", 1, 1), ("n", 1, 1)]


def test_faulty_rows_are_kept_whatever_is_thinned_out_and_a_limit_decides(spark, tmp_path, rows):
    got = landed(spark, tmp_path, keep=F.col("n") >= 3, most_faulty=3)
    assert sorted(r.n for r in got.rows.collect()) == [3, 4] and got.rejected.count() == 3 and got.counts["rows"] == 6
    with pytest.raises(InputError, match="3 faulty rows where 2 are allowed, such as '2013-01-03;3' in .*b.csv|'2013-13-01;y;z'"):
        landed(spark, tmp_path, "limited", most_faulty=2)
    # The stage shows what stopped the run.
    assert spark.read.parquet(str(tmp_path / "limited")).where("__faulty = 1").count() == 3


def test_a_landed_file_is_not_parsed_again(spark, tmp_path):
    got = landed(spark, tmp_path)
    for name in ("a.csv", "b.csv"):
        write(tmp_path / "in" / name, "other;things", "1;2")
    assert got.rows.count() == 6 and got.rejected.count() == 3 and got.unparsed()["d"] == 1 and got.report().count() == 3


def test_a_landed_file_stays_where_its_parts_were_parsed(spark, tmp_path, settings):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", "d;n;a name", *[f"2013-01-01;{'x' if n % 500 == 7 else n};same" for n in range(2000)])
    settings(spark__sql__files__maxPartitionBytes="8k", spark__sql__files__openCostInBytes="0")
    got = land_csv(spark, str(tmp_path / "in"), CITIES, str(tmp_path / "landed"), sep=";")
    shares = [r["count"] for r in got.staged.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(shares) == got.rows.count() == 2000 and max(shares) < 1000, "no task may hold a whole input"
    assert got.counts == {"rows": 2000, "faulty": 4} and got.unparsed() == {"d": 0, "n": 4, "a name": 0}
    assert {r.line for r in got.rejected.collect()} == {"2013-01-01;x;same"}


def test_written_rows_are_observed(spark, tmp_path):
    df = spark.range(10).withColumn("odd", F.col("id") % 2)
    counts = {"n": F.count(F.lit(1)), "odd": F.sum("odd"), "high": F.count_if(F.col("id") > 7)}
    back, seen = write_observed(df, str(tmp_path / "seen"), counts, hidden=["odd"], compact=True)
    assert seen == {"n": 10, "odd": 5, "high": 2} and back.columns == ["id"] and back.count() == 10
    back, seen = write_observed(df.where("id < 0"), str(tmp_path / "none"), counts, hidden=["odd"])
    assert seen == {"n": 0, "odd": None, "high": 0} and back.count() == 0


@pytest.fixture
def pair(spark, tmp_path):
    """Two tables, published once, and a way to publish other rows to both."""
    places = [(f"switch_{n}", str(tmp_path / n)) for n in ("one", "two")]

    def rows_of(n):
        return spark.createDataFrame([("IA", n, 0.5)], "code string, n int, share double")

    def put(first, second):
        return publish_all([(rows_of(first), SMALL, *places[0]), (rows_of(second), SMALL, *places[1])])

    def shown():
        by_name = [spark.table(name).first().n for name, _ in places]
        assert by_name == [read_published(spark, place).first().n for _, place in places]
        return by_name

    put(1, 1)
    yield put, shown
    for name, _ in places:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_both_tables_switch_and_the_version_before_stays_for_its_readers(spark, tmp_path, pair):
    put, shown = pair
    before = spark.table("switch_one")
    put(2, 3)
    assert shown() == [2, 3] and before.first().n == 1
    put(4, 5)
    assert shown() == [4, 5]
    assert len([p for p in (tmp_path / "one").iterdir() if p.name.startswith("_v-")]) == 2


@pytest.mark.parametrize("step", range(1, 8))
def test_a_failure_anywhere_leaves_both_tables(spark, tmp_path, pair, monkeypatch, step):
    """The n-th rename fails, or the n-th change of a table's location."""
    put, shown = pair
    calls = {"n": 0}

    def failing(real):
        def call(*args):
            calls["n"] += 1
            if calls["n"] == step:
                raise OSError("no more")
            return real(*args)

        return call

    monkeypatch.setattr(versions, "move", failing(versions.move))
    monkeypatch.setattr(sinks, "_locate", failing(sinks._locate))
    if step <= 5:  # two entries, the commit record, two locations
        with pytest.raises(OSError, match="no more"):
            put(8, 9)
        assert shown() == [1, 1]
        monkeypatch.undo()
        put(6, 7)
        assert shown() == [6, 7]
        assert len([p for p in (tmp_path / "two").iterdir() if p.name.startswith("_v-")]) == 2
    else:
        put(8, 9)
        assert shown() == [8, 9]


def test_a_rename_that_only_says_no_raises(spark, monkeypatch):
    class Refusing:
        def rename(self, source, target):
            return False

    monkeypatch.setattr(versions, "hadoop_path", lambda spark, place: (Refusing(), place))
    with pytest.raises(OSError, match="a could not be moved to b"):
        versions.move(spark, "a", "b")


def test_a_publish_that_died_changes_nothing(spark, tmp_path, pair):
    """Versions and entries were written, and the process ended before the commit record."""
    _, shown = pair
    place = str(tmp_path / "one")
    dead = versions.new_version(place)
    spark.createDataFrame([("IA", 99, 0.5)], "code string, n long, share double").write.parquet(dead)
    versions.write_text(spark, f"{place}/_log/{2:012d}.json", json.dumps({"version": dead.rsplit("/", 1)[-1], "commit": f"{place}/_commits/never"}))
    assert shown() == [1, 1]
    publish(spark.createDataFrame([("IA", 3, 0.5)], "code string, n int, share double"), SMALL, "switch_one", place)
    assert shown() == [3, 1] and not (tmp_path / "one" / dead.rsplit("/", 1)[-1]).exists()
