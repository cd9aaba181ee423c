import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from callstrata.operators.columns import keep_existing
from callstrata.operators import joins
from callstrata.plans import calls as C
from callstrata.plans import customers as D
from callstrata.plans import run_window as R
from callstrata.plans.cases import fact_cases
from callstrata.settings import VALIDATION, Settings, ValidationPeriod
from tests.helpers import at, bronze, day, dicts, frame, plan, silver


def test_collapse_takes_first_leg_and_last_status(spark):
    legs = bronze(
        spark, "cdr",
        {"CallId": "1", "Status": "x", "Created": at("2024-01-01 10:00:05"), "QueueId": "b", "Duration": 9},
        {"CallId": "1", "Status": "y", "Created": at("2024-01-01 10:00:00"), "QueueId": "a", "Duration": 5, "callerNr": None},
        {"CallId": "2", "Status": "z", "Created": at("2024-01-01 10:00:00"), "QueueId": "b"},
        {"CallId": "3", "Status": "z", "Created": at("2024-01-01 10:00:00"), "QueueId": None},
    )
    got = {r["CallId"]: r for r in dicts(C.collapse_calls(legs, ["b"]))}
    assert set(got) == {"1"}
    assert (got["1"]["QueueId"], got["1"]["Status"], got["1"]["Duration"]) == ("a", "x", 5)
    assert {r["CallId"] for r in dicts(C.collapse_calls(legs, []))} == {"1", "2"}


def test_collapse_is_deterministic_on_equal_times_and_sorts_once(spark):
    rows = [{"CallId": "1", "Status": s, "Created": at("2024-01-01"), "QueueId": q}
            for s, q in (("m", "3"), ("k", "1"), ("z", "2"))]
    results = {tuple(C.collapse_calls(bronze(spark, "cdr", *random.Random(i).sample(rows, 3))).first())
               for i in range(4)}
    assert len(results) == 1
    text = plan(C.collapse_calls(bronze(spark, "cdr", *rows)))
    assert "SortAggregate" not in text and text.count("Exchange hashpartitioning") == text.count("Sort [") == 1


def test_collapse_of_heavy_and_missing_ids_equals_the_plain_one(spark, monkeypatch):
    rng = random.Random(6)
    rows = [{"CallId": rng.choice(["h"] * 6 + ["g", None, f"c{i // 3}"]), "Status": rng.choice(["x", "y", None]),
             "Created": at("2024-01-01") + timedelta(seconds=rng.randint(0, 60)), "QueueId": rng.choice(["1", "2"]),
             "Duration": rng.choice([None, 1, 2])} for i in range(900)]
    legs = bronze(spark, "cdr", *rows)
    want = sorted(map(str, C.collapse_calls(legs).collect()))
    monkeypatch.setattr(joins, "_HEAVY_ROWS", 20)
    assert set(joins.heavy_values(legs, F.col("CallId"))) == {"h", "g"}
    assert sorted(map(str, C.collapse_calls(legs).collect())) == want
    order = ["Created", "LandingNumber", "callerNr", "ChannelType", "QueueId", "CaseId", "Duration", "TalkTimeInSec", "Status"]
    plain = legs.groupBy("CallId").agg(F.min(F.struct(*order)).alias("a"), F.max(F.struct(*order)).alias("z"))
    firsts = plain.select("CallId", "a.Created", "a.QueueId", "a.Duration", "z.Status")
    got = C.collapse_calls(legs).select("CallId", "Created", "QueueId", "Duration", "Status")
    assert got.exceptAll(firsts).count() == 0 == firsts.exceptAll(got).count()


REDIAL = [
    # caller, time, status, queue, expected flag
    ("+46 70 111 22 33", "10:00:00", "CallAbandoned", "1", 0),
    ("46701112233", "10:05:00", "CallAnswered", "1", 1),       # exactly 300 s
    ("46701112233", "10:06:00", "CALLABANDONED", "1", 0),      # previous was answered
    ("46701112233", "10:11:01", "CallAnswered", "1", 0),       # 301 s
    ("46701112233", "10:12:00", "callabandoned", "1", 0),
    ("46701112233", "10:12:00", "callabandoned", "1", 0),      # gap 0
    ("46701112233", "10:13:00", "CallAnswered", "2", 0),       # other queue
    ("123456", "10:00:00", "CallAbandoned", "1", 0),
    ("123456", "10:01:00", "CallAnswered", "1", 0),            # six digits
    ("1234567", "10:00:00", "CallAbandoned", "1", 0),
    ("1234567", "10:01:00", "CallAnswered", "1", 1),           # seven digits
    ("anonymous", "10:00:00", "CallAbandoned", "1", 0),
    ("anonymous", "10:01:00", "CallAnswered", "1", 0),
    (None, "10:02:00", "CallAbandoned", "1", 0),
    ("7654321", "10:59:58", None, "1", 0),
    ("7654321", "10:59:59", "CallAbandoned", "1", 0),
    ("7654321", "11:00:01", "CallAnswered", "1", 1),           # across a slot border
    ("7654322", "10:00:00", "CallAbandoned", None, 0),
    ("7654322", "10:00:10", "CallAnswered", None, 0),          # unknown queue
]


def test_redial_edges(spark):
    rows = [{"CallId": f"{i:03d}", "CallerNr": c, "Created": at(f"2024-01-01 {t}"), "Status": s, "QueueId": q}
            for i, (c, t, s, q, _) in enumerate(REDIAL)]
    got = {r["CallId"]: r["is_redial"] for r in dicts(C.flag_redials(silver(spark, *rows), 300))}
    assert got == {f"{i:03d}": flag for i, (*_, flag) in enumerate(REDIAL)}


def test_redial_keeps_every_call(spark):
    calls = silver(spark, {"CallerNr": "1234567", "Created": None}, {"CallerNr": None, "Created": None},
                   {"CallerNr": "1234567", "Created": at("2024-01-01 03:59:59")})
    assert sorted((r["CallId"], r["is_redial"]) for r in C.flag_redials(calls).collect()) == [
        ("0", 0), ("1", 0), ("2", 0)]


@pytest.mark.parametrize("slot", [60, 100, 300, 700, 3600, 90_000])
def test_redial_equals_one_unbroken_window_for_a_hot_caller(spark, in_stockholm, slot):
    rng = random.Random(slot)
    start = at("2024-03-30 20:00:00")
    calls = []
    for i in range(1500):
        caller = "46700000000" if i < 700 else f"4670{rng.randint(0, 12):07d}"
        calls.append({
            "CallId": f"{i:05d}", "CallerNr": caller, "QueueId": str(rng.randint(0, 1)),
            "Status": rng.choice(["CallAbandoned", "CallAnswered"]),
            "Created": start + timedelta(microseconds=rng.randint(0, 40_000_000_000)),
        })
    expected, previous = {}, {}
    for c in sorted(calls, key=lambda c: (c["Created"], c["CallId"])):
        p = previous.get(c["CallerNr"])
        expected[c["CallId"]] = int(
            p is not None and p["Status"] == "CallAbandoned" and p["QueueId"] == c["QueueId"]
            and timedelta(0) < c["Created"] - p["Created"] <= timedelta(seconds=300)
        )
        previous[c["CallerNr"]] = c
    df = silver(spark, *calls)
    got = C.flag_redials(df, 300, slot)
    assert {r["CallId"]: r["is_redial"] for r in got.collect()} == expected
    assert sum(expected.values()) > 50 and got.columns == [*df.columns, "is_redial"]


def test_calls_without_a_usable_number_skip_the_window(spark):
    df = silver(spark, {"CallerNr": "1"}, {"CallerNr": None}, {"CallerNr": "46701112233", "Created": None})
    text = plan(C.flag_redials(df))
    assert "Union" in text and text.count("Exchange hashpartitioning") == 1
    assert C.flag_redials(df).count() == 3


CUSTOMERS = [
    {"CustomerId": 1, "Name": "Moder", "OrganisationNumber": "556000-1111", "LandingNumber": "081", "ParentId": 0},
    {"CustomerId": 2, "Name": "Dotter", "OrganisationNumber": None, "LandingNumber": " 082 ,,083", "ParentId": 1},
    {"CustomerId": 3, "Name": "Ensam", "OrganisationNumber": "Okänt", "LandingNumber": "083", "ParentId": None},
    {"CustomerId": 4, "Name": "Utan", "OrganisationNumber": "1", "LandingNumber": " ", "ParentId": None},
    {"CustomerId": 5, "Name": "Ute", "OrganisationNumber": "9", "LandingNumber": "089", "ParentId": 1},
]


def test_customer_mapping(spark):
    mapping = D.customer_mapping(bronze(spark, "customers", *CUSTOMERS), exclude_ids=[5])
    got = sorted((r["CustomerId"], r["LandingNumber"], r["CustomerKey"], r["ParentName"]) for r in mapping.collect())
    assert got == [(1, "081", "5560001111", None), (2, "082", "5560001111", "Moder"),
                   (2, "083", "5560001111", "Moder"), (3, "083", "CUSTID_3", None)]
    owners = {r["LandingNumber"]: r["CustomerId"] for r in D.one_row_per_number(mapping).collect()}
    assert owners == {"081": 1, "082": 2, "083": 2}


def enriched(spark):
    mapping = D.one_row_per_number(D.customer_mapping(bronze(spark, "customers", *CUSTOMERS)))
    calls = C.collapse_calls(bronze(
        spark, "cdr",
        *[{"CallId": str(i), "Status": "CallAbandoned" if i == 1 else "ok", "LandingNumber": n,
           "Created": at(f"2024-01-01 10:0{i}:00"), "QueueId": "7" if i else "8", "callerNr": "1234567"}
          for i, n in enumerate([" 082", "083\t", "", None, "0770", "081"])],
    ))
    settings = Settings(queue_to_service={"7": "Support"})
    excluded = frame(spark, "LandingNumber STRING", ("0770",))
    return C.enrich_calls(calls, mapping, settings, excluded)


def test_enrichment(spark):
    got = {r["CallId"]: r for r in dicts(enriched(spark))}
    assert set(got) == {"0", "1", "3", "5"}  # empty and listed numbers are gone, null stays
    assert (got["0"]["Name"], got["0"]["är_dotterbolag"], got["0"]["TjänstTyp"]) == ("Dotter", 1, "Okänd Kö")
    assert (got["3"]["Name"], got["3"]["CustomerKey"], got["3"]["är_dotterbolag"]) == ("Okänd Kund", "Okänd", 0)
    assert (got["5"]["är_dotterbolag"], got["5"]["TjänstTyp"]) == (0, "Support")


def test_reports_and_dimensions(spark):
    calls = C.flag_redials(enriched(spark))
    report = dicts(C.abandoned_report(calls))
    assert [(r["CallId"], r["Datum"]) for r in report] == [("1", day("2024-01-01"))]
    assert C.training_data(calls).columns[-2:] == ["is_redial", "Datum"]
    dim = {r["CustomerKey"]: r["CustomerId"] for r in dicts(D.dim_customer(calls))}
    assert dim == {"5560001111": 2, "Okänd": None}
    phones = sorted(r["LandingNumber"] for r in dicts(D.dim_phone_lookup(calls)))
    assert phones == ["081", "082", "083"]
    assert D.dim_queue(frame(spark, "ID STRING, Name STRING", ("1", "a"))).columns == ["QueueId", "QueueName"]
    assert keep_existing(calls, ["Saknas", "CallId"]).columns == ["CallId"]


def test_call_measures(spark):
    calls = silver(spark, {"Status": None, "Duration": 10, "TalkTimeInSec": 30},
                   {"Status": "CALLABANDONED", "Duration": None})
    got = [(r["is_abandoned"], r["is_answered"], r["WaitTime"]) for r in dicts(C.call_measures(calls))]
    assert got == [(0, 1, 0), (1, 0, None)]


def test_run_window(spark):
    legs = bronze(spark, "cdr", {"Created": at("2025-03-14 23:59:59.9")}, {"Created": at("2023-10-31 12:00:00")},
                  {"Created": at("2023-11-01")})
    window = R.resolve_run_window(legs, Settings())
    assert (window.start, window.today) == (day("2023-11-01"), day("2025-03-15"))
    assert R.within(legs, "Created", window).count() == 2
    assert R.within(legs, "Created", R.run_window(legs, Settings())).count() == 2
    nothing = R.resolve_run_window(legs.limit(0), Settings())
    assert nothing.today == day("2025-10-10")


def test_validation_window_is_pinned(spark):
    period = ValidationPeriod(day("2025-01-31"), day("2025-02-01"), day("2025-02-14"), day("2025-01-31"))
    settings = Settings(run_mode=VALIDATION, validation=period, operational_months_ago=1)
    window = R.resolve_run_window(bronze(spark, "cdr", {"Created": at("2025-06-01")}), settings)
    assert (window.start, window.today) == (day("2025-01-01"), day("2025-02-15"))
    assert settings.horizon_days == settings.holdout_period_days


def test_fact_cases(spark):
    cases = bronze(
        spark, "cases",
        {"CaseId": "1", "Created": at("2025-01-02"), "InternalType": "call", "UserId": 1, "GroupId": "a"},
        {"CaseId": "2", "Created": at("2025-01-02"), "InternalType": "call", "UserId": 9, "GroupId": "a"},
        {"CaseId": "3", "Created": at("2025-01-02"), "InternalType": "mail", "UserId": 1, "GroupId": "a"},
        {"CaseId": "4", "Created": at("2025-01-02"), "InternalType": "call", "UserId": 1, "GroupId": None},
        {"CaseId": "5", "Created": at("2025-01-02"), "InternalType": "call", "UserId": 1, "GroupId": "x"},
        {"CaseId": "6", "Created": at("2025-01-03"), "InternalType": "call", "UserId": 1, "GroupId": "a"},
    )
    users = bronze(spark, "users", {"UserId": 1, "Name": "Ada"})
    window = R.RunWindow(day("2025-01-01"), day("2025-01-03"))
    facts = fact_cases(cases, users, window, Settings(exclude_queue_ids=("x",)))
    assert sorted((r["CaseId"], r["AgentName"], r["QueueId"]) for r in facts.collect()) == [
        ("1", "Ada", "a"), ("2", None, "a")]
    assert facts.where(F.col("QueueId").isNull()).count() == 0
