import math
import random
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from callstrata.functions.calendar import calendar_features
from callstrata.plans import evaluate as E
from callstrata.plans import forecast as P
from callstrata.plans import history as H
from callstrata.plans import models as M
from callstrata.settings import Settings
from tests.helpers import at, day, dicts, frame, plan, silver

HOURLY = "ds TIMESTAMP_NTZ, Tj_nstTyp STRING, Behavior_Segment STRING, Antal_Samtal BIGINT"


def test_hourly_history(spark, in_stockholm):
    calls = silver(
        spark,
        {"Created": at("2024-03-30 23:10:00"), "Duration": 100, "TalkTimeInSec": 60},
        {"Created": at("2024-03-30 23:50:00"), "Duration": 10, "TalkTimeInSec": 60, "Status": "CALLABANDONED"},
        {"Created": at("2024-04-01 23:00:00"), "TjänstTyp": " Support "},
        {"Created": at("2024-03-31 02:30:00"), "CustomerKey": "B", "TalkTimeInSec": None},
        {"Created": at("2024-03-31 02:30:00"), "CustomerKey": None},
        {"Created": at("2024-05-01 02:30:00"), "ChannelType": "mail"},
    )
    segments = frame(spark, "CustomerKey STRING, Behavior_Segment STRING", ("A", " Hög "))
    got = {(r["ds"], r["Tj_nstTyp"], r["Behavior_Segment"]): r for r in dicts(H.hourly_history(calls, segments))}
    assert {k[1:] for k in got} == {("Support", "Hög"), ("Support", "Okänt")}
    assert len(got) == 2 * 49
    first = got[at("2024-03-30 23:00:00"), "Support", "Hög"]
    assert [first[m] for m in H.MEASURES] == [2, 120, 40, 1]
    gap = got[at("2024-03-31 02:00:00"), "Support", "Okänt"]
    assert [gap[m] for m in H.MEASURES] == [2, 60, 40, 2]
    assert got[at("2024-03-31 23:00:00"), "Support", "Hög"]["Antal_Samtal_lag_1d"] == 2
    assert got[at("2024-03-31 22:00:00"), "Support", "Hög"]["Antal_Samtal_lag_1d"] is None
    assert {"m_nad", "dag_p___ret", "_r_arbetsdag", "_r_dagen_efter_st_ngt"} <= set(first)


def test_history_without_segments(spark):
    got = dicts(H.hourly_history(silver(spark, {"Created": at("2024-01-01 10:00:00")})))
    assert [(r["Behavior_Segment"], r["Antal_Samtal"]) for r in got] == [("Okänt", 1)]


def test_calls_are_summed_per_customer_before_the_segment_join(spark):
    segments = frame(spark, "CustomerKey STRING, Behavior_Segment STRING", ("A", "x"))
    text = plan(H.hourly_volumes(silver(spark, {"Created": at("2024-01-01")}), segments))
    assert text.index("BroadcastHashJoin") < text.index("CustomerKey#", text.index("BroadcastHashJoin"))
    assert text.count("HashAggregate") >= 4


def history(spark, days=120, start="2024-01-01"):
    rng = random.Random(3)
    rows = []
    for d in range(days):
        at_day = at(start) + timedelta(days=d)
        for service, base in (("A", 40), ("B", 6)):
            for segment in ("x", "y"):
                for hour in (8, 10, 15, 20):
                    n = 0 if at_day.weekday() == 6 else base + rng.randint(-3, 3) + 5 * at_day.weekday()
                    rows.append((at_day + timedelta(hours=hour), service, segment, n))
    return frame(spark, HOURLY, *rows), rows


def daily_counts(rows):
    counts = Counter()
    for ds, service, _, n in rows:
        counts[service, ds.date()] += n
    return counts


def brute_forecast(rows, start, horizon, statistic_days=35):
    """The rule applied one day after the other."""
    series, result = daily_counts(rows), {}
    for service in sorted({s for s, _ in series}):
        known = {d: n for (s, d), n in series.items() if s == service and d < start}
        recent = {}
        for d, n in known.items():
            if d >= start - timedelta(days=statistic_days):
                recent.setdefault(d.weekday(), []).append(n)
        for i in range(horizon):
            d = start + timedelta(days=i)
            stat = sum(recent.get(d.weekday(), [])) / max(len(recent.get(d.weekday(), [])), 1)
            week = known.get(d - timedelta(days=7), 0)
            guess = week if stat < week * 0.5 and week > 10 else stat
            known[d] = round(max(0, guess))
            result[service, d] = known[d]
    return result


def test_recursive_forecast(spark):
    hourly, rows = history(spark)
    start = day("2024-04-30")
    # One last week far above the average, so that the guard carries it forward twice.
    rows = [(ds, s, g, n * 9 if ds.date() >= day("2024-04-23") else n) for ds, s, g, n in rows]
    hourly = frame(spark, HOURLY, *rows)
    daily = P.daily_history(hourly, start)
    got = {(r["Tj_nstTyp"], r["ds"]): r for r in dicts(P.recursive_forecast(daily, start, 21))}
    expected = brute_forecast(rows, start, 21)
    assert {k: r["Prognos_Volym"] for k, r in got.items()} == expected
    assert all(r["Prognos_Låg"] == int(r["Prognos_Volym"] * 0.8) for r in got.values())
    assert all(r["Prognos_Hög"] == int(r["Prognos_Volym"] * 1.2) for r in got.values())


def test_forecast_with_missing_days_keeps_weekdays_aligned(spark):
    hourly, rows = history(spark)
    start = day("2024-04-30")
    gap = {day("2024-04-24"), day("2024-04-28"), day("2024-04-29")}
    rows = [r for r in rows if r[0].date() not in gap]
    daily = P.daily_history(frame(spark, HOURLY, *rows), start)
    got = {(r["Tj_nstTyp"], r["ds"]): r["Prognos_Volym"] for r in dicts(P.recursive_forecast(daily, start, 14))}
    assert got == brute_forecast(rows, start, 14)


@pytest.mark.parametrize("p, stat, lag7, expected", [
    (5.0, 20.0, 0, 20), (5.1, 20.0, 0, 13), (0.0, 4.0, 10, 4), (0.0, 4.0, 11, 11),
    (0.0, 5.5, 11, 6), (0.0, 2.5, 0, 2), (0.0, 3.5, 0, 4), (-9.0, 0.0, 0, 0), (100.0, 0.0, 200, 200),
])
def test_blend_and_guard(spark, p, stat, lag7, expected):
    df = frame(spark, "p DOUBLE, s DOUBLE, l BIGINT", (p, stat, lag7))
    assert df.select(P.blend_and_guard(F.col("p"), F.col("s"), F.col("l"))).first()[0] == expected


def test_shape_sums_to_one(spark):
    hourly, _ = history(spark)
    shape = P.hourly_shape(hourly, hourly.where("Tj_nstTyp = 'A'"))
    sums = shape.groupBy("veckodag", "Tj_nstTyp").agg(F.sum("Avg_Hourly_Proportion").alias("s")).collect()
    assert {r["Tj_nstTyp"] for r in sums} == {"A"} and len(sums) == 6
    assert all(r["s"] == pytest.approx(1) for r in sums)


def test_allocation(spark):
    hourly, _ = history(spark)
    daily = frame(spark, "ds DATE, Tj_nstTyp STRING, Prognos_Volym BIGINT, `Prognos_Låg` BIGINT, `Prognos_Hög` BIGINT",
                  (day("2024-05-03"), "A", 1000, 800, 1200), (day("2024-05-04"), "A", 500, 400, 600),
                  (day("2024-05-03"), "C", 70, 56, 84))
    out = dicts(P.allocate_hours(daily, P.service_segments(hourly), P.hourly_shape(hourly, hourly), day("2024-05-01")))
    friday = [r for r in out if r["TjänstTyp"] == "A" and r["DatumTid"].date() == day("2024-05-03")]
    assert len(friday) == 48 and abs(sum(r["Prognos_Antal_Samtal"] for r in friday) - 1000) <= 24
    assert {r["DatumTid"].hour for r in friday if r["Prognos_Antal_Samtal"]} == {8, 10, 15}
    assert sum(r["Prognos_Antal_Samtal"] for r in out if r["DatumTid"].date() == day("2024-05-04")) == 0
    unknown = [r for r in out if r["TjänstTyp"] == "C"]
    assert len(unknown) == 24 and sum(r["Prognos_Antal_Samtal"] for r in unknown) == 0
    assert {(r["Prognos_Snitt_Taltid_Sek"], r["ForecastRunDate"]) for r in out} == {(180, day("2024-05-01"))}
    check = P.spread_checksum(daily, P.allocate_hours(
        daily, P.service_segments(hourly), P.hourly_shape(hourly, hourly), day("2024-05-01"))).first()
    assert check["Mal_Volym"] == 1570 and abs(check["Slut_Volym"] - 1000) <= 24


def test_allocation_options(spark):
    hourly, _ = history(spark)
    ddl = "ds DATE, Tj_nstTyp STRING, Prognos_Volym BIGINT, `Prognos_Låg` BIGINT, `Prognos_Hög` BIGINT"
    daily = frame(spark, ddl, (day("2024-05-01"), "A", 100, 80, 120), (day("2024-05-02"), "A", 100, 80, 120))
    residuals = frame(spark, "Tj_nstTyp STRING, residual_low DOUBLE, residual_high DOUBLE", ("A", -150.0, 7.6))
    banded = P.model_band(daily, residuals)
    assert {(r["Prognos_Låg"], r["Prognos_Hög"]) for r in banded.collect()} == {(0, 107)}
    talk = frame(spark, "ds DATE, Behavior_Segment STRING, talk_time INT", (day("2024-05-02"), "x", 240))
    out = dicts(P.allocate_hours(banded, P.service_segments(hourly), P.hourly_shape(hourly, hourly),
                                 day("2024-05-01"), talk_times=talk, close_holidays=True))
    volume = Counter()
    for r in out:
        volume[r["DatumTid"].day] += r["Prognos_Antal_Samtal"]
    assert volume[1] == 0 and abs(volume[2] - 100) <= 3  # the first of May is closed
    seconds = {(r["DatumTid"].day, r["Behavior_Segment"], r["Prognos_Snitt_Taltid_Sek"]) for r in out}
    assert seconds == {(1, "x", 180), (1, "y", 180), (2, "x", 240), (2, "y", 180)}


def test_training_sets_lag_by_days(spark):
    hourly, rows = history(spark, days=40)
    counts = daily_counts(rows)
    for r in dicts(H.volume_training_set(hourly)):
        d = r["ds"]
        assert r["Antal_Samtal_lag_7d"] == counts.get((r["Tj_nstTyp"], d - timedelta(days=7)))
    assert H.volume_training_set(hourly).count() == 2 * 39


def test_handling_training_set_keeps_days_with_calls(spark):
    ddl = HOURLY + ", Total_Samtalstid_Sek BIGINT, Total_V_ntetid_Sek BIGINT, Antal_Besvarade_Samtal BIGINT"
    df = frame(spark, ddl, (at("2024-01-01 10:00:00"), "A", "x", 4, 90, 30, 3), (at("2024-01-01 11:00:00"), "B", "x", 0, 0, 0, 0),
               (at("2024-01-02"), "A", "x", 2, 0, 10, 0), (at("2024-01-03"), "A", "x", 0, 0, 0, 0))
    got = [(r["ds"], r["Snitt_Taltid"], r["Snitt_Vantetid"]) for r in dicts(H.aht_training_set(df))]
    assert sorted(got) == [(day("2024-01-01"), 30.0, 7.5), (day("2024-01-02"), 0.0, 5.0)]


CUT = "2024-06-18"


@pytest.fixture(scope="module")
def trained(spark):
    """Fourteen months of noisy weekly and yearly rhythm, and a model fitted before the cut."""
    rng, rows = random.Random(3), []
    for d in range(430):
        ds = at("2023-05-16") + timedelta(days=d)
        season = [1.2, 1.1, 1.0, 1.0, 0.9, 0.3, 0][ds.weekday()] * (1 + 0.2 * math.sin(d / 58))
        rows += [(ds, s, "x", max(0, round(rng.gauss(b * season, math.sqrt(b * season)))))
                 for s, b in (("A", 400), ("B", 60), ("C", 15))]
    hourly = frame(spark, HOURLY, *rows)
    training = H.volume_training_set(hourly, lags=(1, 7)).persist()
    known = training.where(F.col("ds") < F.lit(day(CUT)))
    return hourly, training, {learner: M.train_volume(known, lags=(1, 7), learner=learner) for learner in ("boosted", "linear")}


@pytest.fixture(scope="module", params=["boosted", "linear"])
def model(request, trained):
    return trained[2][request.param]


def test_volume_model_beats_last_week(spark, trained, model, tmp_path):
    _, training, _ = trained
    M.save_volume(model, str(tmp_path / "m"))
    loaded = M.load_volume(spark, str(tmp_path / "m"))
    scored = M.predict_volume(loaded, training.where(F.col("ds") >= F.lit(day(CUT))), (1, 7))
    errors = scored.agg(
        F.sum(F.abs(F.col("Antal_Samtal") - F.col("prediction"))).alias("model"),
        F.sum(F.abs(F.col("Antal_Samtal") - F.col("Antal_Samtal_lag_7d"))).alias("naive"),
    ).first()
    assert errors["model"] < errors["naive"]
    assert M.load_volume(spark, str(tmp_path / "none")) is None


def test_forecast_with_a_model(spark, trained, model):
    """One plan, whose steps equal one prediction after the other."""
    hourly, _, _ = trained
    start = day("2024-07-19")
    daily = P.daily_history(hourly, start)
    made = P.recursive_forecast(daily, start, 8, model, lags=(1, 7))
    out = dicts(made)
    series = {r["Tj_nstTyp"]: r["series"] for r in P.service_series(daily, start).collect()}
    averages = {r["Tj_nstTyp"]: r["averages"] for r in P.service_series(daily, start).collect()}
    for i in range(8):
        ds = start + timedelta(days=i)
        rows = frame(spark, "ds DATE, Tj_nstTyp STRING, Antal_Samtal_lag_1d BIGINT, Antal_Samtal_lag_7d BIGINT",
                     *[(ds, s, x[-1], x[-7]) for s, x in sorted(series.items())])
        for r in M.predict_volume(model, calendar_features(rows), (1, 7)).collect():
            step = P.blend_and_guard(F.lit(r["prediction"]), F.lit(averages[r["Tj_nstTyp"]][ds.weekday()]), F.lit(r["Antal_Samtal_lag_7d"]))
            series[r["Tj_nstTyp"]] = [*series[r["Tj_nstTyp"]], spark.range(1).select(step.alias("v")).first()["v"]]
    assert {(r["Tj_nstTyp"], r["ds"]): r["Prognos_Volym"] for r in out} == {
        (s, start + timedelta(days=i)): x[i - 8] for s, x in series.items() for i in range(8)}
    assert len(out) == 24 and {r["ds"] for r in out} == {start + timedelta(days=i) for i in range(8)}
    weekday = [r["Prognos_Volym"] for r in out if r["Tj_nstTyp"] == "A" and r["ds"].weekday() == 2]
    assert weekday and all(250 < n < 600 for n in weekday)


def test_what_comes_after_the_start_does_not_change_the_forecast(spark):
    """A segment, a shape and a level that appear on scored days are not looked at."""
    hourly, _ = history(spark)
    start, settings = day("2024-05-01"), Settings()
    before = hourly.where(F.col("ds") < F.lit(start).cast("timestamp_ntz"))
    later = before.withColumns({
        "ds": F.col("ds") + F.expr("INTERVAL '400' DAY") + F.expr("INTERVAL '3' HOUR"), "Behavior_Segment": F.lit("new"),
        "Antal_Samtal": F.col("Antal_Samtal") * 50})
    one, other = (P.create_forecast(h, start, start, settings) for h in (before, before.unionByName(later)))
    assert one.count() > 0 and one.exceptAll(other).count() == 0 == other.exceptAll(one).count()


def test_unseen_service_gets_a_prediction(spark, trained, model):
    _, training, _ = trained
    unseen = training.limit(1).withColumn("Tj_nstTyp", F.lit("Ny"))
    assert M.predict_volume(model, unseen, (1, 7)).first()["prediction"] > 0
    with pytest.raises(ValueError):
        M.predict_volume(model, unseen.drop("kvartal"), (1, 7))


def test_volume_band_brackets_most_days(spark, trained):
    _, training, _ = trained
    late = F.col("ds") > F.date_sub(training.agg(F.max("ds")).scalar(), 56)
    scored = M.train_volume_band(training.where(~late), lags=(1, 7), holdout_days=56).predict(training).where(late)
    inside = scored.agg(F.avg(((F.col("low") <= F.col("Antal_Samtal")) & (F.col("Antal_Samtal") <= F.col("high"))).cast("int")).alias("p"),
                        F.min(F.col("high") - F.col("low")).alias("width")).first()
    assert 0.65 < inside["p"] < 0.95 and inside["width"] >= 0


ARCHIVE = "DatumTid TIMESTAMP_NTZ, Prognos_Antal_Samtal BIGINT, ForecastRunDate DATE"


def test_evaluation(spark):
    archive = frame(spark, ARCHIVE,
                    (at("2024-01-01 08:00:00"), 99, day("2023-12-01")), (at("2024-01-01 08:00:00"), 5, day("2023-12-30")),
                    (at("2024-01-01 23:30:00"), 4, day("2023-12-30")), (at("2024-01-02 08:00:00"), 3, day("2023-12-30")),
                    (at("2024-02-02 08:00:00"), 3, day("2024-01-30")))
    hourly = frame(spark, HOURLY, (at("2024-01-01 08:00:00"), "A", "x", 10), (at("2024-01-03 08:00:00"), "A", "x", 2))
    first, last = day("2024-01-01"), day("2024-01-31")
    assert E.latest_run(archive, first, last).first()[0] == day("2023-12-30")
    days = E.evaluation_days(archive, hourly, first, last)
    assert [tuple(r) for r in days.orderBy("Datum").collect()] == [
        (day("2024-01-01"), 10, 9, 1), (day("2024-01-02"), 0, 3, 3), (day("2024-01-03"), 2, 0, 2)]
    summary = E.evaluate_forecast(days)
    assert summary.first()["wMAPE"] == 50.0
    assert [r["Datum"].day for r in E.trend_series(days).collect()] == [1, 2, 3]
    assert [(r["Serie"], r["Volym"]) for r in E.total_series(summary).collect()] == [("Actuals", 12), ("Forecast", 12)]


def test_evaluation_without_actuals(spark):
    archive = frame(spark, ARCHIVE, (at("2024-01-01"), 5, day("2023-12-30")))
    hourly = frame(spark, HOURLY, (at("2023-01-03"), "A", "x", 2))
    row = E.evaluate_forecast(E.evaluation_days(archive, hourly, day("2024-01-01"), day("2024-01-02"))).first()
    assert (row["wMAPE"], row["Accuracy"], row["Diff_Ratio"]) == (0.0, 0.0, None)
    assert Settings().horizon_days == 14
