"""Scoring a forecast against what happened."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstrata.operators.aggregates import weighted_error
from callstrata.operators.filters import on_days


def _period(df: DataFrame, ts: str, first: date | Column, last: date | Column) -> DataFrame:
    bounds = [d if isinstance(d, Column) else F.lit(d) for d in (first, last)]
    return df.where(on_days(F.col(ts), *bounds))


def latest_run(archive: DataFrame, first: date | Column, last: date | Column) -> DataFrame:
    """The newest run date among the forecasts of a period, as one row."""
    return _period(archive, "DatumTid", first, last).agg(
        F.max("ForecastRunDate").alias("ForecastRunDate")
    )


def evaluation_days(
    archive: DataFrame, hourly: DataFrame, first: date | Column, last: date | Column
) -> DataFrame:
    """Actual and forecast volume per day of the newest run; a day missing on one side is 0."""
    run = latest_run(archive, first, last).scalar()
    forecast = (
        _period(archive, "DatumTid", first, last).where(F.col("ForecastRunDate") == run)
        .groupBy(F.to_date("DatumTid").alias("Datum"))
        .agg(F.sum("Prognos_Antal_Samtal").alias("Forecast_Volym"))
    )
    actual = (
        _period(hourly, "ds", first, last).groupBy(F.to_date("ds").alias("Datum"))
        .agg(F.sum("Antal_Samtal").alias("Actual_Volym"))
    )
    both = actual.join(forecast, "Datum", "full_outer")
    return both.select(
        "Datum",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("Actual_Volym", "Forecast_Volym")],
    ).withColumn("AbsError", F.abs(F.col("Actual_Volym") - F.col("Forecast_Volym")))


def evaluate_forecast(days: DataFrame) -> DataFrame:
    """Totals, difference, wMAPE and accuracy of the compared days, as one row."""
    return weighted_error(days, "Actual_Volym", "Forecast_Volym")


def trend_series(days: DataFrame) -> DataFrame:
    """Daily lines of actual and forecast volume, in date order."""
    return days.select("Datum", "Actual_Volym", "Forecast_Volym").orderBy("Datum")


def total_series(summary: DataFrame) -> DataFrame:
    """Two bars with their labels: the totals, the forecast with its relative difference."""
    bars = F.array(
        F.struct(F.lit("Actuals").alias("Serie"), F.col("Actual_Total").alias("Volym"),
                 F.lit(None).cast("double").alias("Diff_Ratio")),
        F.struct(F.lit("Forecast").alias("Serie"), F.col("Forecast_Total").alias("Volym"),
                 F.col("Diff_Ratio").alias("Diff_Ratio")),
    )
    return summary.select(F.explode(bars).alias("bar")).select("bar.*")
