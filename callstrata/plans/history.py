"""Hourly call history and the daily training sets built from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.functions.calendar import calendar_features, hour_floor
from callstrata.functions.numbers import ratio
from callstrata.functions.text import trim_blanks
from callstrata.operators.columns import fold_names
from callstrata.operators.grid import fill_grid
from callstrata.operators.joins import lookup_join
from callstrata.operators.windows import lag_days
from callstrata.plans.calls import call_measures
from callstrata.schemas import FOLDED_SERVICE, SEGMENT, SERVICE, UNKNOWN_SEGMENT
from callstrata.session import cut_lineage
from callstrata.settings import Settings

LAG_DAYS = (1, 7, 14, 28, 364)
MEASURES = [
    "Antal_Samtal", "Total_Samtalstid_Sek", "Total_V_ntetid_Sek", "Antal_Besvarade_Samtal",
]


def hourly_volumes(
    calls: DataFrame, segments: DataFrame | None, settings: Settings | None = None
) -> DataFrame:
    """Calls, talk time, wait time and answered calls by (hour, service, segment).

    Calls are summed per customer before the segment is looked up, so the join and its shuffle
    see one row per (hour, service, customer) instead of one per call, and a customer with a
    large part of all calls shrinks to one row per hour and service.
    """
    settings = settings or Settings()
    service = trim_blanks(F.col(SERVICE))
    wanted = call_measures(
        calls.where(F.col("ChannelType") == settings.call_channel_name)
        .withColumn(FOLDED_SERVICE, service)
        .where(F.col(FOLDED_SERVICE).isNotNull() & F.col("Created").isNotNull())
    )
    per_customer = wanted.groupBy(
        hour_floor(F.col("Created")).alias("ds"), FOLDED_SERVICE, "CustomerKey"
    ).agg(
        F.count("Created").alias(MEASURES[0]),
        F.sum("TalkTimeInSec").alias(MEASURES[1]),
        F.sum("WaitTime").alias(MEASURES[2]),
        F.sum("is_answered").alias(MEASURES[3]),
    )
    if segments is None:
        joined = per_customer.withColumn(SEGMENT, F.lit(UNKNOWN_SEGMENT))
    else:
        joined = lookup_join(
            per_customer, segments.select("CustomerKey", SEGMENT), "CustomerKey", "left",
            spread_by=["ds", FOLDED_SERVICE], settings=settings,
        ).withColumn(SEGMENT, trim_blanks(F.coalesce(SEGMENT, F.lit(UNKNOWN_SEGMENT))))
    return joined.groupBy("ds", FOLDED_SERVICE, SEGMENT).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES]
    )


def hourly_history(
    calls: DataFrame, segments: DataFrame | None = None, settings: Settings | None = None,
    lags: Sequence[int] = LAG_DAYS, eves: bool = True,
) -> DataFrame:
    """Gap-free hourly history of every service and segment with calendar and lag columns."""
    settings = settings or Settings()
    # Small beside the calls and read twice, so the calls themselves are read only once.
    volumes = cut_lineage(hourly_volumes(calls, segments, settings))
    hours = volumes.agg(F.struct(F.min("ds").alias("first"), F.max("ds").alias("last"))).scalar()
    groups = [FOLDED_SERVICE, SEGMENT]
    grid = fill_grid(
        volumes, groups, "ds", MEASURES, hours.getField("first"), hours.getField("last"), "hour"
    )
    lagged = lag_days(grid, groups, "ds", "Antal_Samtal", lags, rows_per_day=24)
    return fold_names(calendar_features(lagged, "ds", eves, published_names=True))


def daily_volumes(hourly: DataFrame) -> DataFrame:
    """Calls per day and service."""
    return hourly.groupBy(F.to_date("ds").alias("ds"), FOLDED_SERVICE).agg(
        F.sum("Antal_Samtal").alias("Antal_Samtal")
    )


def volume_training_set(
    hourly: DataFrame, lags: Sequence[int] = LAG_DAYS, eves: bool = True
) -> DataFrame:
    """Daily volume per service with the features the forecast sees later.

    Lags are counted in days here as in the forecast; days before the first lag are dropped.
    """
    lagged = lag_days(daily_volumes(hourly), [FOLDED_SERVICE], "ds", "Antal_Samtal", lags, 1)
    return calendar_features(lagged, "ds", eves).where(
        F.col(f"Antal_Samtal_lag_{lags[0]}d").isNotNull()
    )


def aht_training_set(hourly: DataFrame, eves: bool = True) -> DataFrame:
    """Mean talk and wait time per segment on the days that had calls."""
    daily = hourly.groupBy(F.to_date("ds").alias("ds"), SEGMENT).agg(
        *[F.sum(m).alias(m) for m in MEASURES]
    )
    rated = daily.withColumns({
        "Snitt_Taltid": ratio(F.col("Total_Samtalstid_Sek"), F.col("Antal_Besvarade_Samtal")),
        "Snitt_Vantetid": ratio(F.col("Total_V_ntetid_Sek"), F.col("Antal_Samtal")),
    })
    return calendar_features(rated.where(F.col("Antal_Samtal") > 0), "ds", eves)
