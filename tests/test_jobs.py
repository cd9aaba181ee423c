import random
import threading
import uuid
from datetime import timedelta

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from callstrata.plans.boosting import Growth
from callstrata.plans.jobs import Jobs
from callstrata.plans.run_window import window_of
from callstrata.schemas import BRONZE, FORECAST_COLUMNS
from callstrata.settings import VALIDATION, Settings, ValidationPeriod
from callstrata.sources import ingest
from callstrata.sources.readers import SourceSpec, jdbc_source, parquet_source, read_exclusion_list
from callstrata.sources.warehouse import LOAD_DAY, PublishError, Warehouse
from tests.helpers import at, bronze, day, dicts, frame, plan


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), unused())


def unused():
    """Name of a database that no other test has."""
    return f"db_{uuid.uuid4().hex[:8]}"


def test_publish_replaces_and_survives_failure(spark, warehouse):
    assert warehouse.publish(frame(spark, "x INT", (1,), (2,)), "p1") == 2
    old = warehouse.read("p1")
    assert warehouse.publish(old.withColumn("x", F.col("x") + 10), "p1") == 2  # reads what it replaces
    assert sorted(r["x"] for r in warehouse.read("p1").collect()) == [11, 12]
    with pytest.raises(Exception):
        warehouse.publish(warehouse.read("p1").select(F.raise_error(F.lit("x")).alias("x")), "p1")
    assert warehouse.read("p1").count() == 2
    assert issubclass(PublishError, RuntimeError)


def test_publish_by_partition_and_archive(spark, warehouse):
    rows = [(i, day("2024-01-01") + timedelta(days=i % 3)) for i in range(30)]
    df = frame(spark, "x INT, d DATE", *rows)
    assert warehouse.publish(df, "p2", partition_by=["d"]) == 30
    assert dict(warehouse.read("p2").dtypes)["d"] == "date"
    for shift in (0, 1):
        warehouse.archive(df.where(F.col("d") != day("2024-01-03")).withColumn("x", F.col("x") + shift), "a1", "d")
    warehouse.archive(df.where(F.col("d") == day("2024-01-03")), "a1", "d")
    assert warehouse.read("a1").count() == 30
    assert warehouse.read("a1").agg(F.sum("x")).first()[0] == sum(range(30)) + 20


def test_incremental_load_keeps_rows_with_an_equal_time(spark, tmp_path, warehouse):
    path = str(tmp_path / "src")
    ddl = "id INT, t TIMESTAMP_NTZ"
    t1, t2 = at("2024-01-01"), at("2024-01-02")
    frame(spark, ddl, (1, t1), (2, t2), (2, t2)).write.parquet(path)
    keyed = ingest.IngestSpec(parquet_source(path), "t1", ingest.INCREMENTAL, "t", ("id",))
    whole = ingest.IngestSpec(parquet_source(path), "t2", ingest.INCREMENTAL, "t")
    assert [ingest.load_one(spark, warehouse, s) for s in (keyed, whole)] == [3, 3]
    frame(spark, ddl, (3, t2), (2, t2), (4, at("2024-01-03"))).write.mode("append").parquet(path)
    source = spark.read.parquet(path)
    assert ingest.new_rows(source, warehouse.read("t1"), "t", strict=True).count() == 1
    assert ingest.load_one(spark, warehouse, keyed) == 2      # 3 and 4
    assert ingest.load_one(spark, warehouse, whole) == 3      # 3, 4 and the third copy of 2
    assert [ingest.load_one(spark, warehouse, s) for s in (keyed, whole)] == [0, 0]
    assert ingest.new_rows(source, source.limit(0), "t").count() == 6


def test_growing_tables_are_read_by_day(spark, tmp_path, warehouse):
    path = str(tmp_path / "src")
    rows = [(i, at("2024-01-01") + timedelta(hours=i)) for i in range(100)]
    frame(spark, "id INT, Created TIMESTAMP_NTZ", *rows).write.parquet(path)
    ingest.load_one(spark, warehouse, ingest.IngestSpec(parquet_source(path), "g1", ingest.INCREMENTAL, "Created"))
    assert warehouse.latest("g1", "Created") == "2024-01-05 03:00:00" == ingest.high_watermark(warehouse.read("g1"), "Created")
    window = window_of(spark, warehouse.latest("g1", "Created"), Settings(operational_months_ago=0))
    assert (window.start, window.today) == (day("2024-01-01"), day("2024-01-06"))
    wanted = warehouse.read_days("g1", day("2024-01-02"), day("2024-01-03"))
    assert wanted.count() == 24 and "PartitionFilters: [isnotnull(_load_day" in plan(wanted)
    assert warehouse.read("g1").columns == wanted.columns == ["id", "Created"]


def test_a_source_keeps_its_own_day_column(spark, tmp_path, warehouse):
    path = str(tmp_path / "src")
    frame(spark, "t TIMESTAMP_NTZ, Datum DATE", (at("2024-01-01"), day("1999-01-01"))).write.parquet(path)
    ingest.load_one(spark, warehouse, ingest.IngestSpec(parquet_source(path), "own", ingest.INCREMENTAL, "t"))
    assert warehouse.read("own").first()["Datum"] == day("1999-01-01")
    with pytest.raises(ValueError):
        warehouse.append(frame(spark, "t TIMESTAMP_NTZ, _load_day INT", (at("2024-01-01"), 1)), "own", "t")


def test_another_session_finds_what_one_stored_and_loads_nothing_twice(spark, tmp_path):
    path, root, name = str(tmp_path / "src"), str(tmp_path / "wh"), unused()
    frame(spark, "id INT, t TIMESTAMP_NTZ", (1, at("2024-01-01")), (2, at("2024-01-02"))).write.parquet(path)
    spec = ingest.IngestSpec(parquet_source(path), "again", ingest.INCREMENTAL, "t")
    for expected in (2, 0):
        other = spark.newSession()
        assert ingest.load_one(other, Warehouse(other, root, name), spec) == expected
        assert Warehouse(other, root, name).read("again").count() == 2


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path, warehouse):
    def broken(df):
        return df.select("id", F.when(F.col("id") > 0, F.raise_error(F.lit("x")).cast("timestamp_ntz")).alias("t"))

    rows = frame(spark, "id INT, t TIMESTAMP_NTZ", (1, at("2024-01-01")), (2, at("2024-01-02")))
    with pytest.raises(Exception):
        warehouse.append(broken(rows), "f9", "t")
    assert not warehouse.exists("f9") and warehouse.append(rows, "f9", "t") == 2
    with pytest.raises(Exception):
        warehouse.append(broken(rows), "f9", "t")
    assert warehouse.read("f9").count() == 2 and warehouse.latest("f9", "t") == "2024-01-02 00:00:00"


def test_files_no_catalog_entry_names_are_an_error(spark, tmp_path, warehouse):
    """A catalog that has forgotten a table never makes a load start again beside its files."""
    rows = frame(spark, "id INT, t TIMESTAMP_NTZ", (1, at("2024-01-01")))
    rows.write.parquet(f"{warehouse.root}/lost")
    assert not warehouse.exists("lost") and warehouse.latest("lost", "t") is None
    with pytest.raises(LookupError):
        warehouse.read("lost")
    with pytest.raises(SparkRuntimeException, match="LOCATION_ALREADY_EXISTS"):
        warehouse.append(rows, "lost", "t")
    with pytest.raises(ValueError):
        Warehouse(spark, str(tmp_path / "elsewhere"), warehouse.database)


def test_old_versions_go_after_their_grace(spark, tmp_path):
    keeping, eager = (Warehouse(spark, str(tmp_path / n), unused(), g) for n, g in (("a", 3600), ("b", 0)))
    for warehouse, left in ((keeping, 3), (eager, 1)):
        for x in (1, 2, 3):
            before = warehouse.read_or_none("v")
            warehouse.publish(frame(spark, "x INT", (x,)), "v")
            warehouse.publish(frame(spark, "x INT", (x,)), "v__other")  # a longer name is another table
            if before is not None and warehouse is keeping:
                assert before.first()["x"] == x - 1  # a reader that began before the swap
        assert warehouse.read("v").first()["x"] == 3
        tables = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {warehouse.database} LIKE 'v__2*'").collect()]
        assert len(tables) == left


def test_projections_share_a_version_and_schemas_may_change(spark, warehouse):
    warehouse.publish(frame(spark, "x INT, y INT", (1, 2)), "wide", projections={"narrow": ["y"]})
    assert warehouse.read("narrow").columns == ["y"] and warehouse.read("narrow").first()["y"] == 2
    warehouse.publish(frame(spark, "x INT, `å b` STRING", (3, "c")), "wide", projections={"narrow": ["å b"]})
    assert warehouse.read("wide").first().asDict() == {"x": 3, "å b": "c"} and warehouse.read("narrow").first()[0] == "c"


def test_growing_tables_take_new_columns_and_are_compacted(spark, warehouse):
    def rows(ddl, *values):
        return frame(spark, "id INT, t TIMESTAMP_NTZ" + ddl, *values)

    for i in range(4):
        assert warehouse.append(rows("", (i, at("2024-01-01")), (i + 10, at("2024-01-02"))), "grow", "t") == 2
    assert warehouse.append(rows(", extra STRING", (9, at("2024-01-03"), "e")), "grow", "t") == 1
    assert warehouse.append(frame(spark, "t TIMESTAMP_NTZ, ID INT", (at("2024-01-03"), 8)), "grow", "t") == 1
    assert warehouse.append(rows("").limit(0), "grow", "t") == 0
    before = sorted(map(tuple, warehouse.read("grow").collect()), key=repr)
    assert len(before) == 10 and (9, at("2024-01-03"), "e") in before and (8, at("2024-01-03"), None) in before
    files = files_by_day(warehouse, "grow")
    assert len(files[day("2024-01-01")]) == 4
    assert warehouse.compact("grow", "t", day("2024-01-01"), day("2024-01-02")) == 4
    after = files_by_day(warehouse, "grow")
    assert len(after[day("2024-01-01")]) == 1 and after[day("2024-01-02")] == files[day("2024-01-02")]
    assert sorted(map(tuple, warehouse.read("grow").collect()), key=repr) == before


def files_by_day(warehouse, table):
    found = {}
    for r in warehouse.with_days(table).select(LOAD_DAY, "_metadata.file_path").distinct().collect():
        found.setdefault(r[0], set()).add(r[1])
    return found


def test_changed_rows_rewrite_only_their_days(spark, warehouse):
    def merge(*rows, ddl="id INT, t TIMESTAMP_NTZ, a STRING, b STRING"):
        return ingest.merge_changes(warehouse, frame(spark, ddl, *rows), "m", ["id"], "t")

    d1, d2, d3, d4 = (at(f"2024-01-0{i}") for i in (1, 2, 3, 4))
    first = [(1, d1, "x", None), (2, d1, "x", None), (3, d2, "x", None), (4, d3, "x", None), (None, None, "n", None)]
    assert merge(*first, (4, d2, "older", None)) == 5  # one row a key, the latest
    assert merge(*first) == 0
    files = files_by_day(warehouse, "m")
    # 1: a value moves to the next column; 4: the only row of its day moves; 5 is new; null key: another value
    second = [(1, d1, None, "x"), *first[1:3], (4, d4, "x", None), (5, d4, "x", None), (None, None, "m", None)]
    assert merge(*second, second[0]) == 4
    assert sorted(map(tuple, warehouse.read("m").collect()), key=repr) == sorted(second, key=repr)
    after = files_by_day(warehouse, "m")
    assert after[d2.date()] == files[d2.date()] and set(after) == {d1.date(), d2.date(), d4.date(), None}
    assert merge((None, d1, "m", None)) == 1  # the null day is left by its only row
    assert set(files_by_day(warehouse, "m")) == {d1.date(), d2.date(), d4.date()}
    assert warehouse.read("m").count() == 6  # rows the source no longer has stay
    assert merge((2, d1, "x", None, 7), (3, d2, "x", None, None), ddl="id INT, t TIMESTAMP_NTZ, a STRING, b STRING, c INT") == 1
    assert [r["id"] for r in warehouse.read("m").where("c = 7").collect()] == [2]
    assert merge(ddl="id INT, t TIMESTAMP_NTZ, a STRING, b STRING") == 0
    with pytest.raises(ValueError):
        ingest.merge_changes(warehouse, warehouse.read("m"), "m", [], "t")


def test_a_broken_off_merge_is_completed_by_the_next(spark, warehouse):
    """The new day was written, the emptied one not dropped yet: the row is there twice until the next merge."""
    ddl, old, new = "id INT, t TIMESTAMP_NTZ", (1, at("2024-01-01")), (1, at("2024-01-02"))
    warehouse.append(frame(spark, ddl, old, new), "twice", "t")
    assert ingest.merge_changes(warehouse, frame(spark, ddl, new), "twice", ["id"], "t") == 1
    assert [tuple(r) for r in warehouse.read("twice").collect()] == [new]


def test_changes_as_a_load_type(spark, tmp_path, warehouse):
    path = str(tmp_path / "src")
    spec = ingest.IngestSpec(parquet_source(path), "c1", ingest.CHANGES, "t", ("id",))
    for value, written in (("a", 2), ("a", 0), ("b", 2)):
        frame(spark, "id INT, t TIMESTAMP_NTZ, v STRING", (1, at("2024-01-01"), value), (2, at("2024-01-02"), value)).write.mode(
            "overwrite").parquet(path)
        status = ingest.load_all(spark, warehouse, [spec]).first()
        assert (status["status"], status["written"]) == ("LOADED" if written else "EMPTY", written)
        assert {r["v"] for r in warehouse.read("c1").collect()} == {value}


def test_the_latest_time_is_read_from_the_last_day_alone(spark, warehouse):
    rows = [(i, at("2024-01-01") + timedelta(hours=i)) for i in range(72)]
    warehouse.append(frame(spark, "id INT, t TIMESTAMP_NTZ", *rows, (99, None)), "last", "t")
    assert warehouse.latest("last", "t") == "2024-01-03 23:00:00"
    warehouse.append(frame(spark, "id INT, t TIMESTAMP_NTZ", (1, None)), "undated", "t")
    assert warehouse.latest("undated", "t") is None


def test_full_load_guard_and_status(spark, tmp_path, warehouse):
    full, empty = str(tmp_path / "full"), str(tmp_path / "empty")
    frame(spark, "x INT", (1,)).write.parquet(full)
    spark.createDataFrame([], "x INT").write.parquet(empty)
    assert ingest.load_one(spark, warehouse, ingest.IngestSpec(parquet_source(full), "f1", ingest.FULL)) == 1
    specs = [ingest.IngestSpec(parquet_source(p), "f1", ingest.FULL) for p in (empty, str(tmp_path / "no"))]
    specs.append(ingest.IngestSpec(parquet_source(full), "f2", ingest.FULL))
    status = [(r["status"], r["written"]) for r in ingest.load_all(spark, warehouse, specs).collect()]
    assert status == [("EMPTY", 0), ("FAILED", 0), ("LOADED", 1)]
    assert warehouse.read("f1").count() == 1


def test_loads_run_side_by_side(spark, warehouse, monkeypatch):
    """Four loads wait for each other, the fifth fails; the caller's properties reach them, the order of rows stays."""
    meeting, seen = threading.Barrier(4, timeout=20), []

    def load(spark, warehouse, spec, strict):
        seen.append(spark.sparkContext.getLocalProperty("of the caller"))
        if spec.target == "t4":
            raise ValueError("broken")
        meeting.wait()
        return spark.range(int(spec.target[1:])).count()

    monkeypatch.setattr(ingest, "load_one", load)
    spark.sparkContext.setLocalProperty("of the caller", "yes")
    specs = [ingest.IngestSpec(parquet_source("/nowhere"), f"t{i}", ingest.FULL) for i in range(5)]
    rows = [(r["target"], r["status"], r["written"], r["error"]) for r in ingest.load_all(spark, warehouse, specs).collect()]
    assert rows == [("t0", "EMPTY", 0, None), *[(f"t{i}", "LOADED", i, None) for i in (1, 2, 3)], ("t4", "FAILED", 0, "broken")]
    assert seen == ["yes"] * 5


def test_exclusion_list(spark, tmp_path):
    file = tmp_path / "numbers.csv"
    file.write_text("LandingNumber\n 0812 \n007\n0812\n")
    got = sorted(r[0] for r in read_exclusion_list(spark, str(file)).collect())
    assert got == ["007", "0812"]
    assert read_exclusion_list(spark, str(tmp_path / "none.csv")).count() == 0
    assert read_exclusion_list(spark, None).columns == ["LandingNumber"]


def test_jdbc_source_reads_in_ranges():
    spec = jdbc_source("jdbc:x", "cdr", "id", "0", "9", partitions=4, user="u")
    assert spec.format == "jdbc" and spec.options["numPartitions"] == "4" and spec.options["user"] == "u"
    assert "partitionColumn" not in jdbc_source("jdbc:x", "cdr").options


def write_sources(spark, root, days):
    rng = random.Random(5)
    start = at("2024-01-01")
    legs, cases = [], []
    for i in range(days * 30):
        created = start + timedelta(days=i // 30, hours=rng.randint(7, 17), minutes=rng.randint(0, 59))
        leg = {
            "CallId": f"c{i}", "Status": rng.choice(["CallAbandoned", "Answered"]), "Created": created,
            "LandingNumber": rng.choice(["081", "082", "089", None]), "ChannelType": "call",
            "QueueId": rng.choice(["1", "2", "9"]), "callerNr": f"0701{rng.randint(0, 300):06d}",
            "TalkTimeInSec": rng.randint(0, 900), "Duration": rng.randint(0, 1000), "CaseId": f"k{i}",
        }
        legs.append(leg)
        if i % 3:
            legs.append({**leg, "Created": created + timedelta(seconds=30), "Status": "Answered"})
        cases.append({"CaseId": f"k{i}", "Status": "done", "Created": created, "InternalType": "call",
                      "UserId": rng.randint(1, 3), "GroupId": "1"})
    tables = {
        "cdr": legs, "cases": cases,
        "customers": [{"CustomerId": 1, "Name": "Ett", "OrganisationNumber": "55-1", "LandingNumber": "081,082"},
                      {"CustomerId": 2, "Name": "Två", "LandingNumber": "089", "ParentId": 1}],
        "groups": [{"ID": "1", "Name": "Kö"}],
        "users": [{"UserId": 1, "Name": "Ada"}],
    }
    for name, rows in tables.items():
        bronze(spark, name, *rows).write.mode("overwrite").parquet(f"{root}/{name}")
    return {name: SourceSpec("parquet", path=f"{root}/{name}", schema=BRONZE[name]) for name in tables}


def test_full_run(spark, tmp_path):
    days = 60
    sources = write_sources(spark, str(tmp_path / "src"), days)
    last = day("2024-01-01") + timedelta(days=days - 1)
    settings = Settings(
        warehouse_dir=str(tmp_path / "wh"), database=unused(), model_dir=str(tmp_path / "models"),
        queue_to_service={"1": "Support", "2": "Växel"}, exclude_queue_ids=("9",),
        run_mode=VALIDATION, holdout_period_days=7,
        validation=ValidationPeriod(last - timedelta(days=7), last - timedelta(days=6), last, last - timedelta(days=7)),
    )
    class EachInItsOwnSession:
        """Every step in a new session, as when each is a process of its own."""

        def __getattr__(self, name):
            return getattr(Jobs(spark.newSession(), settings), name)

    jobs = EachInItsOwnSession()
    assert {r["status"] for r in dicts(jobs.load_bronze(sources))} == {"LOADED"}
    assert {(r["load_type"], r["written"]) for r in dicts(jobs.load_bronze(sources)) if r["load_type"] == "INCREMENTAL"} == {("INCREMENTAL", 0)}
    rows = jobs.extract()
    assert 0 < rows["Operative_Training_Data"] == rows["Silver_Enriched_Calls"] <= days * 30
    # Every call with a second leg ends answered.
    table = Warehouse(spark, settings.warehouse_dir, settings.database).read
    report = table("Abandoned_Calls_Report")
    assert 0 < report.count() < days * 30 / 3 and rows["Customer_Dimension"] == 2
    jobs.segment()
    assert jobs.train(growth=Growth(trees=20))["Hourly_Aggregated_History"] > 0
    run = settings.validation.forecast_run_date
    assert jobs.forecast(run)["Operative_Forecast"] == jobs.forecast(run)["Forecast_Archive"]
    forecast = table("Operative_Forecast")
    assert forecast.columns == FORECAST_COLUMNS
    jobs.forecast(run, modelled=True, close_holidays=True)
    talk = {r[0] for r in table("Operative_Forecast").select("Prognos_Snitt_Taltid_Sek").distinct().collect()}
    assert talk and talk != {180} and all(0 <= s < 2 * 900 for s in talk)  # trees may overshoot a mean
    compared, summary = jobs.evaluate()
    assert compared.count() == 7
    score = summary.first()
    assert score["Actual_Total"] > 0 and score["wMAPE"] >= 0
    assert jobs.sync_cases()["Raw_Cases"] == days * 30
    with_agent = table("Fact_Cases").where("AgentName IS NOT NULL").select("UserId").distinct()
    assert [r[0] for r in with_agent.collect()] == [1]
