"""The period a run reads, derived from the calls themselves."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.operators.filters import in_period
from callstrata.settings import Settings


@dataclass(frozen=True)
class RunWindow:
    """Half-open [start, today)."""

    start: date
    today: date


def today_column(last: Column, settings: Settings) -> Column:
    """The day after the last call; a fixed day when there are no calls."""
    if settings.pinned_today is not None:
        return F.lit(settings.pinned_today)
    return F.coalesce(F.date_add(F.to_date(last), 1), F.lit(settings.fallback_today))


def window_start(today: Column, months: int) -> Column:
    """First day of the month that lies ``months`` before today."""
    return F.trunc(F.add_months(today, -months), "month")


def run_window(calls: DataFrame, settings: Settings, created: str = "Created") -> DataFrame:
    """(start, today) as one row."""
    latest = calls.agg(F.max(created).alias("last"))
    today = today_column(F.col("last"), settings)
    return latest.select(
        window_start(today, settings.operational_months_ago).alias("start"),
        today.alias("today"),
    )


def resolve_run_window(
    calls: DataFrame, settings: Settings, created: str = "Created"
) -> RunWindow:
    """The window as plain dates, so later filters are literals that prune files and folders."""
    row = run_window(calls, settings, created).first()
    return RunWindow(row["start"], row["today"])


def window_of(spark: SparkSession, latest: str | None, settings: Settings) -> RunWindow:
    """The window from the latest time already known as text; the calls are not read."""
    one = spark.range(1).select(F.lit(latest).cast("timestamp_ntz").alias("Created"))
    return resolve_run_window(one, settings)


def within(df: DataFrame, ts: str, window: RunWindow | DataFrame) -> DataFrame:
    """Rows of [start, today), from resolved dates or from a one-row DataFrame."""
    if isinstance(window, RunWindow):
        start, today = F.lit(window.start), F.lit(window.today)
    else:
        start, today = window.select("start").scalar(), window.select("today").scalar()
    return df.where(
        in_period(F.col(ts), start.cast("timestamp_ntz"), today.cast("timestamp_ntz"))
    )
