"""Daily recursive forecast and its spread over opening hours."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstrata.functions.calendar import calendar_features
from callstrata.functions.numbers import band, round_half_even
from callstrata.functions.text import trim_blanks
from callstrata.operators.grid import expand_hours, fill_grid
from callstrata.operators.joins import lookup_join
from callstrata.operators.windows import apportion, share
from callstrata.plans.boosting import BoostedModels
from callstrata.plans.history import LAG_DAYS, daily_volumes
from callstrata.plans.models import CALENDAR, lag_columns, linear_column
from callstrata.schemas import (
    FOLDED_SERVICE, FORECAST_COLUMNS, FORECAST_HIGH, FORECAST_LOW, SEGMENT, SERVICE,
)
from callstrata.session import cut_lineage
from callstrata.settings import Settings

LOOKBACK_DAYS = 370
STATISTIC_DAYS = 35
TALK_TIME_SEC = 180
OPEN_FROM_HOUR, OPEN_TO_HOUR = 6, 18


def _day(start: date | Column) -> Column:
    return start if isinstance(start, Column) else F.lit(start)


def daily_history(hourly: DataFrame, start: date | Column, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Daily volume per service over the look-back before the forecast starts."""
    day = _day(start)
    since = F.date_sub(day, days).cast("timestamp_ntz")
    recent = hourly.where((F.col("ds") >= since) & (F.col("ds") < day.cast("timestamp_ntz")))
    trimmed = recent.withColumn(FOLDED_SERVICE, trim_blanks(F.col(FOLDED_SERVICE)))
    return daily_volumes(trimmed.where(F.col(FOLDED_SERVICE).isNotNull()))


def weekday_average(
    daily: DataFrame, start: date | Column, days: int = STATISTIC_DAYS
) -> DataFrame:
    """Mean daily volume per service and weekday over the last weeks."""
    recent = daily.where(F.col("ds") >= F.date_sub(_day(start), days))
    return recent.groupBy(FOLDED_SERVICE, F.weekday("ds").alias("veckodag")).agg(
        F.avg("Antal_Samtal").alias("Stat_Avg")
    )


def service_series(
    daily: DataFrame, start: date | Column, statistic_days: int = STATISTIC_DAYS
) -> DataFrame:
    """One row per service: its gap-free daily series up to the day before the start, oldest
    first, and its seven weekday averages. A series is bounded by the look-back."""
    day = _day(start)
    first = daily.agg(F.min("ds")).scalar()
    grid = fill_grid(
        daily.withColumn("seen", F.lit(1)), [FOLDED_SERVICE], "ds", ["Antal_Samtal", "seen"],
        first, F.date_sub(day, 1), "day",
    )
    counts_in = (F.col("seen") == 1) & (F.col("ds") >= F.date_sub(day, statistic_days))
    averages = F.array(*[
        F.coalesce(
            F.avg(F.when(counts_in & (F.weekday("ds") == k), F.col("Antal_Samtal"))), F.lit(0.0)
        )
        for k in range(7)
    ])
    return grid.groupBy(FOLDED_SERVICE).agg(
        F.array_sort(F.collect_list(F.struct("ds", "Antal_Samtal"))).alias("days"),
        averages.alias("averages"),
    ).select(
        FOLDED_SERVICE, F.col("days.Antal_Samtal").alias("series"), "averages"
    )


def blend_and_guard(predicted: Column, average: Column, last_week: Column) -> Column:
    """Half model, half weekday average when the model expects more than 5 calls, else the
    average; never below half of a last week that had more than 10 calls."""
    base = F.when(predicted > 5, predicted * 0.5 + average * 0.5).otherwise(average)
    collapsed = (base < last_week * 0.5) & (last_week > 10)
    guarded = F.when(collapsed, last_week.cast("double")).otherwise(base)
    return round_half_even(F.greatest(guarded, F.lit(0.0)))


def _lag(series: Column, k: int) -> Column:
    return F.try_element_at(series, F.lit(-k))


def _next(series: Column, averages: Column, day: Column, predicted: Column) -> Column:
    average = F.element_at(averages, F.weekday(day) + 1)
    return blend_and_guard(predicted, average, F.coalesce(_lag(series, 7), F.lit(0)))


def _unfold(forecast: DataFrame, start: Column, horizon: int) -> DataFrame:
    """The last ``horizon`` entries of every series as rows with their bounds."""
    future = F.slice("series", -horizon, horizon)
    rows = forecast.select(FOLDED_SERVICE, F.posexplode(future).alias("offset", "Prognos_Volym"))
    low, high = band(F.col("Prognos_Volym"))
    return rows.select(
        F.date_add(start, F.col("offset")).alias("ds"), FOLDED_SERVICE, "Prognos_Volym",
        low.alias(FORECAST_LOW), high.alias(FORECAST_HIGH),
    )


def recursive_forecast(
    daily: DataFrame, start: date | Column, horizon: int = 14,
    model: BoostedModels | PipelineModel | None = None, lags: Sequence[int] = LAG_DAYS, eves: bool = True,
    statistic_days: int = STATISTIC_DAYS,
) -> DataFrame:
    """Daily forecast per service where every day may look back on days forecast before it.

    The state is one row per service holding its series. All steps are one fold inside a single expression,
    with a model too: its prediction is a column of the series so far and the day's calendar, so a
    step needs neither a shuffle nor a stored table.
    """
    day = _day(start)
    state = service_series(daily, day, statistic_days).withColumn("start", day)
    if model is not None:
        state = state.withColumn("days", _horizon_calendar(daily, day, horizon, eves))
    if isinstance(model, BoostedModels):
        state = state.withColumn("model", model.value("operative"))

    def predicted(series: Column, i: Column) -> Column:
        if model is None:
            return F.lit(0.0)
        given = {FOLDED_SERVICE: F.col(FOLDED_SERVICE), **{c: F.get("days", i)[c] for c in CALENDAR},
                 **{name: _lag(series, k) for name, k in zip(lag_columns(lags), lags, strict=True)}}
        if isinstance(model, BoostedModels):
            return model.score("operative", F.col("model"), given)
        return linear_column(model, given, lags)

    folded = F.aggregate(
        F.sequence(F.lit(0), F.lit(horizon - 1)), F.col("series"),
        lambda series, i: F.concat(series, F.array(_next(
            series, F.col("averages"), F.date_add(F.col("start"), i), predicted(series, i)
        ))),
    )
    return _unfold(state.withColumn("series", folded), day, horizon)


def _horizon_calendar(daily: DataFrame, day: Column, horizon: int, eves: bool) -> Column:
    """Calendar features of the days to forecast, as one array with an entry per day."""
    days = daily.sparkSession.range(horizon).select(
        F.date_add(day, F.col("id").cast("int")).alias("ds")
    )
    return calendar_features(days, "ds", eves).agg(
        F.array_sort(F.collect_list(F.struct("ds", *CALENDAR)))
    ).scalar()


def hourly_shape(hourly: DataFrame, services: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Mean share of each hour in its day, per service and weekday, summing to 1 per weekday."""
    busy = hourly.where(F.col("Antal_Samtal") > 0).select(
        "ds", trim_blanks(F.col(FOLDED_SERVICE)).alias(FOLDED_SERVICE), "Antal_Samtal"
    )
    # Services, segments, hours of the week and forecast days are limited by the settings.
    active = lookup_join(
        busy, services.select(FOLDED_SERVICE).distinct(), FOLDED_SERVICE, "left_semi",
        settings=settings, bounded=True,
    ).withColumns({
        "datum": F.to_date("ds"), "veckodag": F.weekday("ds"), "timme": F.hour("ds"),
    })
    shares = active.withColumn(
        "share", share(F.col("Antal_Samtal"), ["datum", FOLDED_SERVICE])
    )
    mean = shares.groupBy("veckodag", "timme", FOLDED_SERVICE).agg(F.avg("share").alias("share"))
    return mean.select(
        "veckodag", "timme", FOLDED_SERVICE,
        share(F.col("share"), ["veckodag", FOLDED_SERVICE]).alias("Avg_Hourly_Proportion"),
    )


def service_segments(hourly: DataFrame) -> DataFrame:
    """The (service, segment) pairs that occur, used to split a service over its segments."""
    return hourly.select(
        trim_blanks(F.col(FOLDED_SERVICE)).alias(FOLDED_SERVICE), SEGMENT
    ).distinct()


def open_weight(ts: Column, weight: Column, day_off: Column) -> Column:
    """The weight of an hour, 0 on weekends, outside 06-18 and on other days off."""
    closed = (
        (F.weekday(ts) >= 5) | (F.hour(ts) < OPEN_FROM_HOUR) | (F.hour(ts) >= OPEN_TO_HOUR)
        | day_off
    )
    return F.when(closed, F.lit(0.0)).otherwise(F.coalesce(weight, F.lit(0.0)))


def model_band(
    daily: DataFrame, residuals: DataFrame, settings: Settings | None = None
) -> DataFrame:
    """Replace the fixed bounds by the volume plus the residual quantiles of its service."""
    joined = lookup_join(daily, residuals, FOLDED_SERVICE, settings=settings, bounded=True)

    def bound(residual: str) -> Column:
        shifted = F.col("Prognos_Volym") + F.coalesce(residual, F.lit(0.0))
        return F.greatest(shifted, F.lit(0.0)).cast("bigint")

    return joined.withColumns({
        FORECAST_LOW: bound("residual_low"), FORECAST_HIGH: bound("residual_high"),
    }).select(*daily.columns)


def model_talk_times(
    daily: DataFrame, segments: DataFrame, model: BoostedModels,
    settings: Settings | None = None,
) -> DataFrame:
    """Expected talk time in whole seconds per forecast day and segment."""
    pairs = lookup_join(
        daily.select("ds", FOLDED_SERVICE), segments, FOLDED_SERVICE, "inner",
        settings=settings, bounded=True,
    ).select("ds", SEGMENT).distinct()
    scored = model.with_scores(calendar_features(pairs), prediction="Snitt_Taltid")
    seconds = round_half_even(F.greatest(F.col("prediction"), F.lit(0.0))).cast("int")
    return scored.select("ds", SEGMENT, seconds.alias("talk_time"))


def allocate_hours(
    daily: DataFrame, segments: DataFrame, shape: DataFrame, run_date: date | Column,
    settings: Settings | None = None, talk_times: DataFrame | None = None,
    close_holidays: bool = False, keep_totals: bool = False,
) -> DataFrame:
    """Spread a daily forecast over opening hours and segments.

    Every hour is rounded by itself, as studied, so a day's total may change; with ``keep_totals`` the hours of a
    (day, service) are rounded by largest remainders and add up to its volume wherever an hour is open.

    Weights are normalised over the hours and segments of a (day, service), so a day without any
    open hour loses its volume. The groups hold 24 rows per segment. Talk time is a constant
    unless ``talk_times`` per (ds, segment) are given; holidays are open unless closed here.
    """
    day_off = F.lit(False)
    if close_holidays:
        daily = calendar_features(daily).select(*daily.columns, "ar_arbetsdag")
        day_off = F.col("ar_arbetsdag") == 0
    split = lookup_join(
        daily, segments, FOLDED_SERVICE, "left", settings=settings, bounded=True
    )
    talk_time = F.lit(TALK_TIME_SEC)
    if talk_times is not None:
        split = lookup_join(
            split, talk_times, ["ds", SEGMENT], settings=settings, bounded=True
        )
        talk_time = F.coalesce("talk_time", talk_time)
    expanded = expand_hours(
        split.withColumnRenamed("ds", "datum"), "datum", "DatumTid"
    ).withColumns({"veckodag": F.weekday("DatumTid"), "timme": F.hour("DatumTid")})
    weighted = lookup_join(
        expanded, shape, ["veckodag", "timme", FOLDED_SERVICE], "left", settings=settings, bounded=True
    ).withColumn(
        "weight", open_weight(F.col("DatumTid"), F.col("Avg_Hourly_Proportion"), day_off)
    )
    group = ["datum", FOLDED_SERVICE]
    normal = weighted.withColumn("weight", share(F.col("weight"), group))
    volumes = {"Prognos_Volym": "Prognos_Antal_Samtal", FORECAST_LOW: FORECAST_LOW,
               FORECAST_HIGH: FORECAST_HIGH}
    parts = normal.withColumns({f"_{v}": F.col(v) * F.col("weight") for v in volumes})
    spread = {out: F.col(v) * share(F.col(f"_{v}"), group) for v, out in volumes.items()}
    if keep_totals:
        hours = apportion(parts.withColumns(spread), list(spread), group, ["DatumTid", SEGMENT])
    else:
        hours = parts.withColumns({out: round_half_even(x) for out, x in spread.items()})
    day = run_date if isinstance(run_date, Column) else F.lit(run_date)
    return hours.withColumns({
        SERVICE: F.col(FOLDED_SERVICE),
        "Prognos_Snitt_Taltid_Sek": talk_time,
        "ForecastRunDate": day.cast("date"),
    }).select(*FORECAST_COLUMNS)


def spread_checksum(daily: DataFrame, hourly_forecast: DataFrame) -> DataFrame:
    """Total volume before and after spreading, as one row."""
    before = daily.agg(F.sum("Prognos_Volym")).scalar()
    return hourly_forecast.agg(F.sum("Prognos_Antal_Samtal").alias("Slut_Volym")).select(
        before.alias("Mal_Volym"), "Slut_Volym"
    )


def create_forecast(
    hourly: DataFrame, start: date | Column, run_date: date | Column, settings: Settings,
    model: BoostedModels | PipelineModel | None = None, handling: BoostedModels | None = None,
    residuals: DataFrame | None = None, close_holidays: bool = False, keep_totals: bool = False,
) -> DataFrame:
    """Hourly forecast table from the hourly history before the start; later hours, which a
    validation run has, are not looked at.

    Bounds and talk times are constants unless residuals and a handling model are given.
    """
    hourly = hourly.where(F.col("ds") < _day(start).cast("timestamp_ntz"))
    daily = daily_history(hourly, start)
    # Built by a long plan and read several times below: a few rows per service.
    forecast = cut_lineage(recursive_forecast(daily, start, settings.horizon_days, model))
    if residuals is not None:
        forecast = model_band(forecast, residuals, settings)
    shape = hourly_shape(hourly, daily, settings)
    since = F.date_sub(_day(start), LOOKBACK_DAYS).cast("timestamp_ntz")
    segments = service_segments(hourly.where(F.col("ds") >= since))
    talk_times = None
    if handling is not None:
        talk_times = model_talk_times(forecast, segments, handling, settings)
    return allocate_hours(
        forecast, segments, shape, run_date, settings, talk_times, close_holidays, keep_totals
    )
