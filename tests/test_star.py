"""The whole job on a small hand-written input whose results are known."""

import pytest

from starlane.operators import DataQualityError
from starlane.plans import reports, star
from starlane.sources import InputError, contracts

DEMOGRAPHICS = """City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count
Ames;Iowa;20.0;10;11;21;1;2;2.2;IA;White;9
Ames;Iowa;20.0;10;11;21;1;2;2.2;IA;Asian;3
Ames;Iowa;20.0;10;11;21;1;2;2.2;IA;Hispanic or Latino;2
Ames;Iowa;20.0;10;11;21;1;2;2.2;IA;Black or African-American;1
Davenport;Iowa;40.0;100;110;210;1;2;2.2;IA;White;9
Gary;Indiana;37.0;many;40;75;1;2;2.4;IN;Asian;3
Springfield;Missouri;35.0;7;8;15;1;2;2.4;MO;White;3
Springfield;Illinois;33.0;5;6;11;1;2;2.4;IL;White;3
Atlanta;Georgia;30.0;1;2;3;1;2;2.4;GA;White;3
"""
TEMPERATURES = """dt,AverageTemperature,AverageTemperatureUncertainty,State,Country
2009-10-01,99.0,0.1,Iowa,United States
2010-10-01,10.0,0.1,Iowa,United States
2011-10-01,13.0,0.1,Iowa,United States
2012-10-01,,,Iowa,United States
2010-11-01,1.25,0.1,Iowa,United States
2011-11-01,1.5,0.1,Iowa,United States
2012-11-01,1.75,0.1,Iowa,United States
2010-12-01,-5.0,0.1,Iowa,United States
2011-12-01,-6.0,0.1,Iowa,United States
2012-12-01,-8.0,0.1,Iowa,United States
2013-01-01,-7.5,0.1,Iowa,United States
2013-09-01,18.257,0.1,Iowa,United States
2013-01-01,5.0,0.1,Georgia,United States
2012-12-01,8.0,0.1,Georgia,United States
2013-12-01,6.0,0.1,Georgia,United States
2013-01-01,77.0,0.1,Georgia,Georgia
2013-01-01,,,Illinois,United States
2013-01-01,25.0,0.1,Puerto Rico,United States
2013-01-01,-9.0,0.1,Ontario,Canada
"""
AIRPORTS = """ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates
KDSM,large_airport,Des Moines,958,NA,US,US-IA,Des Moines,KDSM,DSM,DSM,"-93.6, 41.5"
KATL,large_airport,Atlanta,1026,NA,US,US-GA,Atlanta,KATL,ATL,ATL,"-84.4, 33.6"
KAT2,small_airport,Atlanta two,1026,NA,US,US-GA,Atlanta,KAT2,,ATL,"-84.4, 33.6"
CYYZ,large_airport,Toronto,569,NA,CA,CA-ON,Toronto,CYYZ,YYZ,YYZ,"-79.6, 43.6"
KUMX,small_airport,Nowhere,,NA,US,US-U-A,,,,UMX,"0, 0"
KNUL,small_airport,No code,,NA,US,US-IA,,,,,"0, 0"
KORD,large_airport,Chicago,672,NA,US,US-IL,Chicago,KORD,ORD,ORD,"-87.9, 41.9"
KGYY,small_airport,Gary,591,NA,US,US-IN,Gary,KGYY,GYY,GYY,"-87.4, 41.6"
"""
# year, month, port, age, visa, gender
JANUARY = [
    (2016.0, 1.0, "DSM", 30.0, 1.0, "F"),
    (2016.0, 1.0, "DSM", 31.0, 2.0, "M"),
    (2016.0, 1.0, "DSM", 32.0, 2.0, "F"),
    (2016.0, 1.0, "DSM", 40.0, 9.0, "Z"),
    (2016.0, 1.0, "ATL", 20.0, 3.0, "U"),
    (2016.0, 1.0, "GYY", 50.0, 1.0, "M"),
    (2016.0, 1.0, "ZZZ", 50.0, 1.0, "M"),
    (2016.0, 1.0, "YYZ", 50.0, 1.0, "M"),
    (2016.0, 1.0, "UMX", 50.0, 1.0, "M"),
    (None, 1.0, "DSM", 99.0, 1.0, "F"),
    (2016.0, None, "DSM", 99.0, 1.0, "F"),
    (2016.0, 1.0, None, 99.0, 1.0, "F"),
    (2016.0, 1.0, "DSM", None, 1.0, "F"),
    (2016.0, 1.0, "DSM", 99.0, None, "F"),
    (2016.0, 1.0, "DSM", 99.0, 1.0, None),
]
LATER = [(2016.0, 10.0, "DSM", 10.0, 1.0, "X"), (2016.0, 2.0, "ATL", 22.0, 2.0, "F")]

DIMENSION = [
    ("GA", "Georgia", 30.0, 2, 1, 3),
    ("IA", "Iowa", 30.0, 121, 110, 231),
    ("IL", "Illinois", 33.0, 6, 5, 11),
    ("IN", "Indiana", 37.0, 40, None, 75),
]
FACT = [
    ("GA", 1, 2016, 20.0, None, None, 2, None, None, None, 2, 5.0),
    ("IA", 1, 2016, 33.3, 2, 1, None, None, 1, 2, None, -7.5),
    ("IA", 10, 2016, 10.0, None, None, None, 1, 1, None, None, 11.5),
]


def land(spark, folder, extra=()):
    inputs = star.Inputs()
    for name, text in ((inputs.demographics, DEMOGRAPHICS), (inputs.temperatures, TEMPERATURES), (inputs.airports, AIRPORTS)):
        (folder / name).write_text(text)
    for name, month in (("jan", JANUARY), ("later", [*LATER, *extra])):
        spark.createDataFrame(month, contracts.ARRIVALS).write.parquet(str(folder / inputs.arrivals / f"{name}.parquet"))
    return str(folder)


def run(spark, tmp_path, raw, **options):
    inputs = star.Inputs(arrivals="arrivals/*.parquet")
    return star.run(
        spark, raw, str(tmp_path / "stages"), inputs=inputs, publish_as=("star_dim", "star_fact"),
        publish_dir=str(tmp_path / "published"), **options,
    )


@pytest.fixture
def fresh(spark):
    yield
    for name in ("star_dim", "star_fact"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_run_from_raw_files_to_published_tables(spark, tmp_path, rows, fresh):
    raw = tmp_path / "raw"
    raw.mkdir()
    tables = run(spark, tmp_path, land(spark, raw))
    assert rows(tables["dimension_state"]) == DIMENSION
    assert rows(tables["fact_temperature_state"]) == sorted(
        [("GA", 5.0, 1), ("GA", 6.0, 12), ("GA", 8.0, 12), ("IA", -7.5, 1), ("IA", 18.26, 9), ("IA", 11.5, 10),
         ("IA", 1.5, 11), ("IA", -6.33, 12), ("IL", None, 1)],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )
    assert rows(tables["port_state"]) == [
        ("KAT2", "ATL", "GA"), ("KATL", "ATL", "GA"), ("KDSM", "DSM", "IA"), ("KGYY", "GYY", "IN"), ("KNUL", None, "IA"), ("KORD", "ORD", "IL"),
    ]
    assert sorted((tuple(r) for r in tables["fact_arrivals"].collect()), key=lambda r: r[:3]) == FACT
    assert tables["fact_arrivals"].columns == [f.name for f in contracts.FACT_ARRIVALS.schema]

    # A second run over the same folders leaves the same rows.
    again = run(spark, tmp_path, str(raw))
    assert rows(again["dimension_state"]) == DIMENSION and again["fact_arrivals"].count() == len(FACT)
    stages = star.open_stages(spark, str(tmp_path / "stages"))
    assert stages["fact_arrivals"].count() == len(FACT) and stages["dimension_state"].count() == len(DIMENSION)

    # The published tables answer the reports and plain SQL.
    fact, dimension = tables["fact_arrivals"], tables["dimension_state"]
    visa = reports.category_mix_report(spark, fact, dimension, "state_key", "IA", reports.VISA_MIX)
    assert [tuple(r) for r in visa.collect()] == [(1, 1, 2, None, -7.5), (10, 1, None, None, 11.5)]
    gender = reports.category_mix_report(spark, fact, dimension, "state_key", "IA", reports.GENDER_MIX)
    assert [tuple(r) for r in gender.collect()] == [(1, 2, 1, None, None, -7.5), (10, None, None, None, 1, 11.5)]
    joined = spark.sql("SELECT d.state_name FROM star_fact f JOIN star_dim d ON f.state_key = d.state_key WHERE f.U = 2")
    assert [r.state_name for r in joined.collect()] == ["Georgia"]


@pytest.mark.parametrize(
    "arrival, broken",
    [
        # Two temperatures for Georgia's December double the fact row.
        ((2016.0, 12.0, "ATL", 30.0, 1.0, "F"), r"unique_key\(fact_temperature_state\.state_key,month\): 1"),
        # Illinois has an empty reading for January.
        ((2016.0, 1.0, "ORD", 30.0, 1.0, "F"), r"not_null\(fact_arrivals\.average_temperature\): 1"),
    ],
)
def test_a_failed_check_stops_the_publish(spark, tmp_path, rows, fresh, arrival, broken):
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.mkdir(), bad.mkdir()
    run(spark, tmp_path, land(spark, good))
    with pytest.raises(DataQualityError, match=broken):
        run(spark, tmp_path, land(spark, bad, [arrival]))
    assert spark.table("star_fact").count() == len(FACT)


def test_only_missing_months_can_be_filled(spark, tmp_path, rows):
    (tmp_path / "t.csv").write_text(TEMPERATURES)
    readings = star.read_csv(spark, str(tmp_path / "t.csv"), contracts.STATE_TEMPERATURE)
    filled = star.complete_temperatures(readings, only_missing=True).filter("state_name = 'Georgia' AND month = 12")
    assert [r.average_temperature for r in filled.collect()] == [6.0]
    ordered = [(r.state_name, r.month) for r in star.complete_temperatures(readings).collect()]
    assert ordered == sorted(ordered)


def test_command_line(spark, tmp_path, monkeypatch):
    called = {}
    monkeypatch.setattr(star, "run", lambda spark, *where, **options: called.update(where=where, **options))
    star.main(["--input", "in", "--output", "out", "--publish", "pub", "--arrivals", "a/*", "--arrivals-source", "orc"])
    inputs = star.Inputs(arrivals="a/*", arrivals_source="orc")
    wanted = {"where": ("in", "out"), "inputs": inputs, "publish_dir": "pub"}
    usual = {"target_year": 2013, "donor_years": (2010, 2011, 2012), "months": (10, 11, 12), "only_missing": False}
    usual |= {"most_faulty": {}, "resume": False, "monthly_sums": None}
    assert called == {**wanted, **usual}
    star.main(["--input", "in", "--output", "out", "--target-year", "2014", "--donor-years", "2013", "--months", "1", "2", "--only-missing"])
    assert (called["target_year"], called["donor_years"], called["months"], called["only_missing"]) == (2014, [2013], [1, 2], True)


@pytest.mark.parametrize("fault", ["no column", "no column in one file", "header", "bad date", "no arrivals"])
def test_incomplete_input_leaves_what_is_published(spark, tmp_path, fresh, fault):
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.mkdir(), bad.mkdir()
    run(spark, tmp_path, land(spark, good))
    land(spark, bad)
    inputs = star.Inputs()
    if fault.startswith("no column"):
        for name in ("jan", "later") if fault == "no column" else ("jan",):
            kept = spark.createDataFrame(JANUARY, contracts.ARRIVALS).drop("gender")
            kept.write.mode("overwrite").parquet(str(bad / inputs.arrivals / f"{name}.parquet"))
    if fault == "header":
        (bad / inputs.demographics).write_text(DEMOGRAPHICS.replace("City;State;", "State;City;"))
    if fault == "bad date":
        (bad / inputs.temperatures).write_text(TEMPERATURES.replace("2013-01-01,-7.5", "2013-01-41,-7.5"))
    if fault == "no arrivals":
        for name in ("jan", "later"):
            spark.createDataFrame([], contracts.ARRIVALS).write.mode("overwrite").parquet(str(bad / inputs.arrivals / f"{name}.parquet"))
    with pytest.raises((InputError, DataQualityError)):
        run(spark, tmp_path, str(bad))
    assert spark.table("star_fact").count() == len(FACT) and spark.table("star_dim").count() == len(DIMENSION)


def test_what_a_run_counts_on_the_way(spark, tmp_path, rows, fresh):
    raw = tmp_path / "raw"
    raw.mkdir()
    tables = run(spark, tmp_path, land(spark, raw))
    report = {(r.measure, r.subject): r.value for r in tables["run_report"].collect()}
    assert report["rows", "cities"] == 9 and report["faulty_rows", "cities"] == 1
    assert report["unparsed_cells", "cities.Male Population"] == 1 and report["unparsed_cells", "readings.dt"] == 0
    assert report["input_files", "arrivals"] >= 2 and report["unmatched_rows", "arrivals.airport_key"] == 4
    assert report["foreign_key", "fact_arrivals.state_key"] == 0 and report["unique_key", "fact_arrivals.state_key,month,year"] == 0
    assert rows(tables["unmatched_ports"]) == [(None, 1), ("UMX", 1), ("YYZ", 1), ("ZZZ", 1)]
    quarantined = spark.read.parquet(str(tmp_path / "stages" / "city_rows")).where("__faulty = 1").first()
    assert quarantined["__line"].startswith("Gary;Indiana;37.0;many;") and quarantined["__faults"] == ["Male Population"]
    published = star.open_published(spark, str(tmp_path / "published"))
    assert published["fact_arrivals"].count() == len(FACT) and published["dimension_state"].count() == len(DIMENSION)


def test_faulty_rows_beyond_the_limit_stop_the_run(spark, tmp_path, fresh):
    raw = tmp_path / "raw"
    raw.mkdir()
    land(spark, raw)
    with pytest.raises(InputError, match="1 faulty rows where 0 are allowed, such as 'Gary;Indiana"):
        run(spark, tmp_path, str(raw), most_faulty={"demographics": 0})
    assert run(spark, tmp_path, str(raw), most_faulty={"demographics": 1})["fact_arrivals"].count() == len(FACT)


def test_a_rerun_leaves_the_stages_that_were_finished(spark, tmp_path, rows, fresh, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    land(spark, raw)
    monkeypatch.setattr(star, "port_states", lambda *given: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, tmp_path, str(raw), resume=True)
    monkeypatch.undo()

    def written():
        return {p.name: (p / "_fingerprint").stat().st_mtime_ns for p in (tmp_path / "stages").iterdir() if (p / "_fingerprint").exists()}

    before = written()
    assert {"city_rows", "dimension_state", "arrivals_by_port"} <= set(before) and "port_state" not in before
    assert rows(run(spark, tmp_path, str(raw), resume=True)["dimension_state"]) == DIMENSION
    after = written()
    assert {n: after[n] for n in before} == before and "port_state" in after
    # Another file makes the stages that hang on it anew, and no other.
    (raw / star.Inputs().temperatures).write_text(TEMPERATURES.replace("18.257", "28.257"))
    got = run(spark, tmp_path, str(raw), resume=True)
    assert ("IA", 28.26, 9) in rows(got["fact_temperature_state"])
    again = written()
    assert {n for n in after if again[n] != after[n]} == {"state_readings", "fact_temperature_state"}
    # Without resume everything is made anew.
    run(spark, tmp_path, str(raw))
    assert all(t != again[n] for n, t in written().items())


def test_steps_run_at_once_and_a_failure_lets_none_begin(spark):
    import threading

    from starlane.plans.graph import Step, run_steps

    both = threading.Barrier(2, timeout=30)
    met = run_steps(spark, {"a": Step((), both.wait), "b": Step((), both.wait), "c": Step(("a", "b"), lambda a, b: a + b)})
    assert met["c"] == 1
    begun = []
    steps = {"bad": Step((), lambda: 1 / 0), "after": Step(("bad",), lambda bad: begun.append("after"))}
    with pytest.raises(ZeroDivisionError):
        run_steps(spark, steps)
    assert begun == []
    with pytest.raises(ValueError, match="wait for each other"):
        run_steps(spark, {"a": Step(("b",), print), "b": Step(("a",), print)})


def test_shuffles_start_with_partitions_for_the_input(spark, monkeypatch):
    from starlane import session

    class Conf:
        def contains(self, key):
            return False

    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: Conf())
    before = spark.conf.get(session.INITIAL, None)
    try:
        for size, wanted in ((0, 200), (10**12, 5000), (10**15, session.MOST_PARTITIONS)):
            session.size_shuffles(spark, size)
            assert spark.conf.get(session.INITIAL) == str(wanted)
    finally:
        spark.conf.unset(session.INITIAL) if before is None else spark.conf.set(session.INITIAL, before)


def test_a_larger_input_makes_more_tasks_and_not_larger_ones(spark, tmp_path, rows, fresh, monkeypatch):
    from starlane import session

    raw = tmp_path / "raw"
    raw.mkdir()
    land(spark, raw)
    files = 24
    for n in range(files - 2):
        month = [(2016.0, 3.0, f"P{n}-{i}", 30.0, 1.0, "F") for i in range(50)]
        spark.createDataFrame(month, contracts.ARRIVALS).coalesce(1).write.parquet(str(raw / "arrivals" / f"more{n}.parquet"))
    seen, plain = {}, star.arrivals_by_port

    def watched(arrivals):
        seen["tasks"] = arrivals.rdd.getNumPartitions()
        seen["shares"] = [int(spark.conf.get(key)) for key in session.SHARES]
        return plain(arrivals)

    monkeypatch.setattr(star, "arrivals_by_port", watched)
    before = [spark.conf.get(key, None) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")]
    monkeypatch.setattr(session, "LEAST_SHARE", 1 << 20, raising=False)
    tables = run(spark, tmp_path, str(raw))
    assert rows(tables["fact_arrivals"]) == FACT
    assert seen["tasks"] >= files and seen["shares"] == [1 << 20] * 2
    assert [spark.conf.get(key, None) for key in session.SHARES] == before


def test_shares_follow_the_input_within_bounds_and_yield_to_the_session(spark, settings):
    from starlane import session

    files, shuffled = session.SHARES

    @session.keeps_shares
    def shares(spark, size):
        session.size_shares(spark, size)
        return [int(spark.conf.get(key)) for key in session.SHARES]

    assert shares(spark, 0) == shares(spark, 10**11) == [16 << 20] * 2
    assert shares(spark, 5 * 10**11) == [50_000_000] * 2 and shares(spark, 10**15) == [128 << 20, 64 << 20]
    settings(**{files.replace(".", "__"): str(1 << 10), shuffled.replace(".", "__"): str(1 << 30)})
    assert shares(spark, 0) == [1 << 10, 1 << 30]
