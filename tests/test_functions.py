import math
from datetime import date, timedelta

from pyspark.sql import functions as F

from callstrata.functions import calendar as cal
from callstrata.functions import numbers as num
from callstrata.functions import text as txt
from callstrata.operators.columns import fold_name, fold_names
from tests.helpers import at, day, dicts, frame

import pytest


def one(spark, column, ddl="x STRING", *values):
    return [r[0] for r in frame(spark, ddl, *[(v,) for v in values]).select(column).collect()]


def test_trim_removes_tabs_and_newlines(spark):
    assert one(spark, txt.trim_blanks(F.col("x")), "x STRING", " \ta b\n", "\xa0c", None) == ["a b", "c", None]


def test_org_number(spark):
    got = one(spark, txt.clean_org_number(F.col("x")), "x STRING",
              "556677-8899 AB", "---", "Okänt", "None", None, " 5566", "")
    assert got == ["5566778899", None, None, None, None, None, None]


def test_customer_key_falls_through(spark):
    df = frame(spark, "org STRING, parent STRING, id BIGINT, name STRING",
               ("55-1", "66", 1, "a"), (None, "66-2", 2, "b"), ("x", None, 3, "c"),
               (None, None, None, "Åsa & Co 4"))
    key = txt.customer_key(F.col("org"), F.col("parent"), F.col("id"), F.col("name"))
    assert [r[0] for r in df.select(key).collect()] == ["551", "662", "CUSTID_3", "NAME_saCo4"]


def test_explode_list_drops_empty_members(spark):
    df = frame(spark, "id INT, n STRING", (1, " 08123 ,,08124"), (2, " , "), (3, None))
    assert sorted(tuple(r) for r in txt.explode_list(df, "n").collect()) == [(1, "08123"), (1, "08124")]


def test_keyword_category_last_match_wins(spark):
    df = frame(spark, "Name STRING", ("Röd BIL",), ("bil",), ("Båt",), (None,))
    got = dicts(txt.keyword_category(df, {"Fordon": ["bil", "båt"], "Färg": ["röd"], "Tom": []}))
    assert [r["kategori"] for r in got] == ["Färg", "Fordon", "Fordon", "Övrigt"]
    assert dicts(txt.keyword_category(df.withColumnRenamed("Name", "n"), {}))[0]["kategori"] == "Okänd"


def test_has_parent(spark):
    assert one(spark, txt.has_parent(F.col("x")), "x STRING", "0", "", None, "7", "a") == [0, 0, 0, 1, 0]


def test_rounding_and_division(spark):
    df = frame(spark, "x DOUBLE, y DOUBLE", (0.5, 0.0), (1.5, 3.0), (2.5, -1.0), (2.4999999999999, 2.0))
    row = df.select(num.round_half_even(F.col("x")).alias("r"), num.ratio(F.col("x"), F.col("y")).alias("q")).collect()
    assert [r["r"] for r in row] == [0, 2, 2, 2]
    assert [r["q"] for r in row] == [0.0, 0.5, 0.0, 2.4999999999999 / 2]


def test_whole_average_and_clip(spark):
    df = frame(spark, "s BIGINT, n BIGINT", (7, 2), (7, 0), (None, 3), (-5, 2))
    got = df.select(num.whole_average(F.col("s"), F.col("n")).alias("a"), num.at_least_zero(F.col("s")).alias("z"))
    assert [tuple(r) for r in got.collect()] == [(3, 7), (0, 7), (0, None), (-2, 0)]


def easter(year):
    """Meeus/Jones/Butcher."""
    a, b, c = year % 19, year // 100, year % 100
    h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
    el = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
    m = (a + 11 * h + 22 * el) // 451
    month, dom = divmod(h + el - 7 * m + 114, 31)
    return date(year, month, dom + 1)


def test_easter_over_many_years(spark):
    years = spark.range(1700, 2500).select(F.col("id").cast("int").alias("y"))
    got = {r["y"]: r["e"] for r in cal.with_easter(years, "y", "e").collect()}
    assert got == {y: easter(y) for y in range(1700, 2500)}


def test_holidays_of_a_known_year(spark):
    got = {r["ds"]: r["holiday"] for r in cal.holidays(spark, 2024, 2024).collect()}
    assert got == {
        day("2024-01-01"): "New Year's Day", day("2024-01-06"): "Epiphany",
        day("2024-03-29"): "Good Friday", day("2024-03-31"): "Easter Sunday",
        day("2024-04-01"): "Easter Monday", day("2024-05-01"): "Labour Day",
        day("2024-05-09"): "Ascension Day", day("2024-05-19"): "Whit Sunday",
        day("2024-06-06"): "National Day", day("2024-06-21"): "Midsummer Eve",
        day("2024-06-22"): "Midsummer Day", day("2024-11-02"): "All Saints' Day",
        day("2024-12-24"): "Christmas Eve", day("2024-12-25"): "Christmas Day",
        day("2024-12-26"): "Second Day of Christmas", day("2024-12-31"): "New Year's Eve",
    }
    assert not [r for r in cal.holidays(spark, 2024, 2024, eves=False).collect() if r["is_eve"]]


@pytest.mark.parametrize("eves", [True, False])
def test_workdays_agree_with_the_holiday_table(spark, eves):
    days = spark.sql("SELECT explode(sequence(DATE'2007-12-20', DATE'2013-01-10')) AS ds")
    off = {r["ds"] for r in cal.holidays(spark, 2007, 2013, eves).collect()}
    for row in cal.calendar_features(days, "ds", eves).collect():
        d = row["ds"]
        work = d.weekday() < 5 and d not in off
        after = work and (d.weekday() == 0 or d - timedelta(days=1) in off)
        assert (row["ar_arbetsdag"], row["ar_dagen_efter_stangt"]) == (int(work), int(after)), d


def test_calendar_columns(spark, in_stockholm):
    df = frame(spark, "ds TIMESTAMP_NTZ, keep INT", (at("2024-12-30 06:30:00"), 1), (at("2024-03-31 02:15:00"), 2))
    monday, sunday = dicts(cal.calendar_features(df))
    assert (monday["veckodag"], monday["vecka_nr"], monday["kvartal"], monday["veckodag_namn"]) == (0, 1, 4, "Mån")
    assert (monday["ar_tidig_morgon"], monday["ar_formiddag"], monday["manad_namn"]) == (1, 0, "Dec")
    assert (sunday["timme"], sunday["minut"], sunday["keep"]) == (2, 15, 2)
    assert math.isclose(monday["year_sin"], math.sin(2 * math.pi * 365 / 365.25))


def test_folded_names(spark):
    assert [fold_name(n) for n in ("månad", "dag_på_året", "är_arbetsdag")] == ["m_nad", "dag_p___ret", "_r_arbetsdag"]
    with pytest.raises(ValueError):
        fold_names(frame(spark, "`å` INT, `ä` INT", (1, 2)))
