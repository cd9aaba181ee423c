import random
from collections import Counter

import numpy as np
import pytest

from callstrata.plans import segments as S
from tests.helpers import at, dicts, frame, silver


def calls(spark, *rows):
    return silver(spark, *[{"Created": at("2024-01-01 09:00:00"), **r} for r in rows])


def test_profile(spark):
    df = calls(
        spark,
        {"TjänstTyp": "b", "TalkTimeInSec": 10, "Name": None, "Created": at("2024-01-01 08:00:00")},
        {"TjänstTyp": "a", "TalkTimeInSec": 11, "Name": "Först", "Created": at("2024-01-01 09:00:00")},
        {"TjänstTyp": "b", "TalkTimeInSec": None, "Name": "Sen", "Created": at("2024-01-01 10:00:00")},
        {"TjänstTyp": "a", "TalkTimeInSec": 10, "Name": "Sen", "Created": at("2024-01-01 11:00:00")},
        {"TjänstTyp": None, "CustomerKey": "B", "TalkTimeInSec": None},
        {"CustomerKey": None},
    )
    got = {r["CustomerKey"]: r for r in dicts(S.customer_profiles(df))}
    assert set(got) == {"A", "B"}
    a = got["A"]
    assert (a["Name"], a["TjänstTyp"], a["Total_Samtal"], a["Total_Samtalstid_Sek"], a["Genomsnittlig_AHT_Sek"]) \
        == ("Först", "a", 4, 31, 7)  # the tie between a and b goes to the smaller one
    assert (got["B"]["TjänstTyp"], got["B"]["Genomsnittlig_AHT_Sek"]) == ("Okänd Typ", 0)


def test_segments_use_strict_limits_and_sick_leave_wins(spark):
    rows = []
    for key, n, talk in (("a", 1, 10), ("b", 2, 20), ("c", 3, 30), ("d", 4, 40), ("e", 9, 50)):
        rows += [{"CustomerKey": key, "TalkTimeInSec": talk}] * n
    rows += [{"CustomerKey": " internal_sick ", "TalkTimeInSec": 30}] * 3
    rows += [{"CustomerKey": "g", "Name": "SJUKANMÄLAN väst", "TalkTimeInSec": 30}] * 3
    rows += [{"CustomerKey": "h", "TjänstTyp": "Personalärenden", "TalkTimeInSec": 30}] * 3
    got = {r["CustomerKey"]: r["Behavior_Segment"] for r in dicts(S.customer_segments(calls(spark, *rows)))}
    volumes, times = [1, 2, 3, 4, 9, 3, 3, 3], [10, 20, 30, 40, 50, 30, 30, 30]
    assert (np.quantile(volumes, 0.8), np.quantile(times, 0.5)) == (pytest.approx(3.6), 30)
    assert got == {
        "a": "Låg-Volym_Korta-Ärenden", "b": "Låg-Volym_Korta-Ärenden", "c": "Låg-Volym_Korta-Ärenden",
        "d": "Hög-Volym_Långa-Ärenden", "e": "Hög-Volym_Långa-Ärenden",
        " internal_sick ": "Segment_Sjukanmälan", "g": "Segment_Sjukanmälan", "h": "Segment_Sjukanmälan",
    }


def test_histogram(spark):
    df = frame(spark, "Behavior_Segment STRING", ("x",), ("y",), ("x",))
    assert [tuple(r) for r in S.segment_histogram(df).collect()] == [("x", 2), ("y", 1)]


def test_peak_pattern_breaks_ties_by_weekday_and_hour(spark):
    df = calls(
        spark,
        {"Created": at("2024-01-02 09:10:00")}, {"Created": at("2024-01-01 14:00:00")},
        {"Created": at("2024-01-08 14:59:00")}, {"Created": at("2024-01-09 09:00:00")},
        {"CustomerKey": "B", "Created": None},
    )
    got = {r["CustomerKey"]: r["Peak_Pattern"] for r in dicts(S.profiles_with_peaks(df))}
    assert got == {"A": "Mån-14", "B": "Oklart"}


def test_call_length_limits(spark):
    zero = calls(spark, *[{"TalkTimeInSec": 5}] * 4, {"TalkTimeInSec": 65}, {"TalkTimeInSec": 66}, {"TalkTimeInSec": 0})
    got = Counter(r["Samtalstyp"] for r in dicts(S.call_length_class(zero)))
    values = [5, 5, 5, 5, 65, 66]
    lo, hi = np.quantile(values, 0.33), np.quantile(values, 0.66)
    assert (lo, round(hi, 6)) == (5, 23.0)
    assert got == {"Normal": 4, "Långt": 2}
    flat = calls(spark, *[{"TalkTimeInSec": 5}] * 9, {"TalkTimeInSec": 65}, {"TalkTimeInSec": 66})
    assert Counter(r["Samtalstyp"] for r in dicts(S.call_length_class(flat))) == {"Normal": 10, "Långt": 1}


def test_monthly_peaks_against_brute_force(spark):
    rng = random.Random(1)
    rows = [{"CustomerKey": rng.choice("AB"), "Name": "n", "TalkTimeInSec": rng.choice([0, 10, 20, 30]),
             "Created": at(f"{rng.choice([2023, 2024])}-0{rng.randint(1, 2)}-{rng.randint(10, 16)} {rng.randint(10, 13)}:00:00")}
            for _ in range(400)]
    names = ["Mån", "Tis", "Ons", "Tor", "Fre", "Lör", "Sön"]
    talked = [r for r in rows if r["TalkTimeInSec"] > 0]
    lo, hi = (np.quantile([r["TalkTimeInSec"] for r in talked], q) for q in (0.33, 0.66))
    hi = lo + 60 if hi <= lo else hi
    counts, totals = Counter(), Counter()
    for r in talked:
        kind = "Kort" if r["TalkTimeInSec"] < lo else "Långt" if r["TalkTimeInSec"] > hi else "Normal"
        group = (r["CustomerKey"], r["Created"].month, kind)
        counts[group, names[r["Created"].weekday()], r["Created"].hour] += 1
        totals[group] += 1
    expected = set()
    for group in totals:
        ranked = sorted((-n, wd, h) for (g, wd, h), n in counts.items() if g == group)
        expected |= {(group, wd, h, -n, i + 1, round(-n / totals[group], 9)) for i, (n, wd, h) in enumerate(ranked[:3])}
    got = {((r["CustomerKey"], r["månad"], r["Samtalstyp"]), r["veckodag_namn"], r["timme"],
            r["Antal_Samtal_Denna_Timme"], r["Peak_Rank"], round(r["Procent_Av_Manad_Typ"], 9))
           for r in dicts(S.monthly_peaks(calls(spark, *rows)))}
    assert got == expected


def test_kmeans_puts_alike_customers_together(spark):
    df = frame(spark, "CustomerKey STRING, Total_Samtal BIGINT, Genomsnittlig_AHT_Sek BIGINT",
               *[(f"{k}{i}", n + i, t + i) for k, n, t in (("a", 10, 100), ("b", 500, 900)) for i in range(5)])
    clusters = {}
    for r in S.kmeans_segments(df, k=2).collect():
        clusters.setdefault(r["CustomerKey"][0], set()).add(r["Kluster"])
    assert all(len(c) == 1 for c in clusters.values()) and clusters["a"] != clusters["b"]
