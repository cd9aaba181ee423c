"""Calendar attributes of a zone-less timestamp or date, including Swedish holidays.

Everything is column arithmetic: no holiday table has to be generated for the right years, no
join is needed, and the expressions stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Short Swedish names (fixed values), Monday first and January first.
WEEKDAY_NAMES = ["Mån", "Tis", "Ons", "Tor", "Fre", "Lör", "Sön"]
MONTH_NAMES = [
    "Jan", "Feb", "Mar", "Apr", "Maj", "Jun", "Jul", "Aug", "Sep", "Okt", "Nov", "Dec",
]

# Swedish holidays on a fixed date, as month * 100 + day (fixed values).
FIXED_HOLIDAYS = {
    101: "New Year's Day",
    106: "Epiphany",
    501: "Labour Day",
    606: "National Day",
    1225: "Christmas Day",
    1226: "Second Day of Christmas",
}
# Holidays relative to Easter Sunday, in days (fixed values).
EASTER_HOLIDAYS = {
    -2: "Good Friday",
    0: "Easter Sunday",
    1: "Easter Monday",
    39: "Ascension Day",
    49: "Whit Sunday",
}
# Eves, treated as days off by default, as month * 100 + day (fixed values).
FIXED_EVES = {1224: "Christmas Eve", 1231: "New Year's Eve"}

# ASCII name -> published name of the calendar columns that are not plain ASCII.
PUBLISHED_NAMES = {
    "dag_pa_aret": "dag_på_året",
    "manad": "månad",
    "ar": "år",
    "manad_namn": "månad_namn",
    "ar_arbetsdag": "är_arbetsdag",
    "ar_dagen_efter_stangt": "är_dagen_efter_stängt",
    "ar_tidig_morgon": "är_tidig_morgon",
    "ar_formiddag": "är_förmiddag",
    "ar_lunchtid": "är_lunchtid",
    "ar_eftermiddag": "är_eftermiddag",
}


# Gauss's rule for Gregorian Easter of the year `_y`, step by step.
_EASTER_STEPS = [
    {"_c": "_y DIV 100", "_g": "pmod(_y, 19)"},
    {"_q": "_c - _c DIV 4"},
    {"_m": "pmod(15 - (13 + 8 * _c) DIV 25 + _q, 30)", "_s": "pmod(4 + _q, 7)"},
    {"_d": "pmod(19 * _g + _m, 30)"},
    {"_e": "pmod(2 * pmod(_y, 4) + 4 * pmod(_y, 7) + 6 * _d + _s, 7)"},
    {"_late": "_e = 6 AND (_d = 29 OR (_d = 28 AND pmod(11 * _m + 11, 30) < 19))"},
]
_EASTER = "date_add(make_date(_y, 3, 22), CAST(_d + _e - IF(_late, 7, 0) AS INT))"


def with_easter(df: DataFrame, year: str, name: str) -> DataFrame:
    """Append Easter Sunday of the year given by a SQL expression.

    The steps are columns of their own: as one nested expression each of them would be repeated
    wherever it is used and the generated code would outgrow the compiler's limits.
    """
    df = df.withColumn("_y", F.expr(year))
    for step in _EASTER_STEPS:
        df = df.withColumns({column: F.expr(rule) for column, rule in step.items()})
    helpers = ["_y", *[column for step in _EASTER_STEPS for column in step]]
    return df.withColumn(name, F.expr(_EASTER)).drop(*helpers)


def _off(month_day: str, weekday: str, from_easter: str, eves: bool) -> str:
    """SQL test whether a date is a holiday, given its month-day, weekday and Easter distance."""
    fixed = ", ".join(str(d) for d in [*FIXED_HOLIDAYS, *(FIXED_EVES if eves else [])])
    moving = ", ".join(str(d) for d in EASTER_HOLIDAYS)
    test = (
        f"{month_day} IN ({fixed}) OR {from_easter} IN ({moving}) OR ({weekday} = 5 AND "
        f"({month_day} BETWEEN 620 AND 626 OR {month_day} BETWEEN 1031 AND 1106))"
    )
    return f"{test} OR ({weekday} = 4 AND {month_day} BETWEEN 619 AND 625)" if eves else test


def holiday_dim(years: DataFrame, year_col: str = "year", eves: bool = True) -> DataFrame:
    """(ds, holiday, is_eve) for every year of a one-column DataFrame, one row per date."""

    def listed(date: str, name: str, eve: bool = False) -> str:
        quoted = name.replace("'", "\\'")
        return f"struct({date} AS ds, {str(eve).lower()} AS is_eve, '{quoted}' AS holiday)"

    def fixed(month_day: int) -> str:
        return f"make_date(year, {month_day // 100}, {month_day % 100})"

    days = [listed(fixed(day), name) for day, name in FIXED_HOLIDAYS.items()]
    days += [listed(f"date_add(easter, {k})", name) for k, name in EASTER_HOLIDAYS.items()]
    days += [
        listed("next_day(make_date(year, 6, 19), 'SAT')", "Midsummer Day"),
        listed("next_day(make_date(year, 10, 30), 'SAT')", "All Saints' Day"),
    ]
    if eves:
        days += [listed(fixed(day), name, True) for day, name in FIXED_EVES.items()]
        days += [listed("next_day(make_date(year, 6, 18), 'FRI')", "Midsummer Eve", True)]
    each = years.select(F.col(year_col).alias("year")).distinct()
    dated = with_easter(each, "year", "easter").select(
        F.explode(F.expr(f"array({', '.join(days)})")).alias("day")
    )
    one = dated.groupBy("day.ds").agg(F.min("day").alias("day"))
    return one.select("ds", "day.holiday", "day.is_eve")


def holidays(spark: SparkSession, first_year: int, last_year: int, eves: bool = True) -> DataFrame:
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    return holiday_dim(years, eves=eves)


def hour_floor(ts: Column) -> Column:
    """Start of the hour, zone-less: ``date_trunc`` would pass through the session's zone."""
    whole = F.to_date(ts).cast("timestamp_ntz")
    return whole + F.make_dt_interval(F.lit(0), F.hour(ts))


def wall_seconds(ts: Column) -> Column:
    """Whole seconds of wall-clock time since 1970, whatever the session's zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def weekday_name(weekday: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), weekday + 1)


def month_name(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), month)


def calendar_features(
    df: DataFrame, ds: str = "ds", eves: bool = True, published_names: bool = False
) -> DataFrame:
    """Append the calendar columns computed from the zone-less timestamp or date ``ds``."""
    names = ", ".join(f"'{n}'" for n in WEEKDAY_NAMES)
    months = ", ".join(f"'{n}'" for n in MONTH_NAMES)
    turn = f"{2 * math.pi!r}D * _doy / 365.25D"
    stages = [
        {"_at": f"CAST(`{ds}` AS TIMESTAMP_NTZ)"},
        {"_day": "to_date(_at)"},
        {"_hour": "hour(_at)", "_wd": "weekday(_day)", "_month": "month(_day)",
         "_doy": "dayofyear(_day)", "_before": "date_sub(_day, 1)",
         "_clock": "hour(_at) + minute(_at) / 60.0D",
         "_from": "datediff(_day, _easter)"},
        {"_md": "_month * 100 + day(_day)",
         "_md_before": "month(_before) * 100 + day(_before)"},
        # 1 January needs no Easter of the year before: no holiday of either year is that far.
        {"_off": _off("_md", "_wd", "_from", eves),
         "_off_before": _off("_md_before", "weekday(_before)", "(_from - 1)", eves)},
        {"_work": "_wd < 5 AND NOT _off"},
    ]
    added = {
        "timme": "_hour",
        "minut": "minute(_at)",
        "veckodag": "_wd",
        "dag_pa_aret": "_doy",
        "vecka_nr": "weekofyear(_day)",
        "manad": "_month",
        "kvartal": "quarter(_day)",
        "ar": "year(_day)",
        "datum": "_day",
        "veckodag_namn": f"element_at(array({names}), _wd + 1)",
        "manad_namn": f"element_at(array({months}), _month)",
        "ar_arbetsdag": "CAST(_work AS INT)",
        "ar_dagen_efter_stangt": "CAST((_wd = 0 OR _off_before) AND _work AS INT)",
        "ar_tidig_morgon": "CAST(_clock >= 6.5D AND _clock < 8D AS INT)",
        "ar_formiddag": "CAST(_clock >= 8D AND _clock < 11D AS INT)",
        "ar_lunchtid": "CAST(_clock >= 11D AND _clock < 13D AS INT)",
        "ar_eftermiddag": "CAST(_clock >= 13D AND _clock < 17.5D AS INT)",
        "year_sin": f"sin({turn})",
        "year_cos": f"cos({turn})",
    }
    if published_names:
        added = {PUBLISHED_NAMES.get(name, name): rule for name, rule in added.items()}
    kept = df.columns
    out = with_easter(df, f"year(`{ds}`)", "_easter")
    for stage in stages:
        out = out.withColumns({column: F.expr(rule) for column, rule in stage.items()})
    return out.select(*[f"`{c}`" for c in kept], *[
        F.expr(rule).alias(name) for name, rule in added.items()
    ])
