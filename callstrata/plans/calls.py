"""Call legs to one enriched row per call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callstrata.functions.numbers import at_least_zero
from callstrata.functions.text import digits_only, has_parent, status_is, trim_blanks
from callstrata.operators.columns import keep_existing
from callstrata.operators.filters import not_listed
from callstrata.operators.joins import heavy_values, lookup_join, map_values
from callstrata.operators.windows import flag_follow_ups
from callstrata.schemas import (
    ABANDONED, SERVICE, SUBSIDIARY, TRAINING_COLUMNS, UNKNOWN_CUSTOMER_KEY,
    UNKNOWN_CUSTOMER_NAME, UNKNOWN_QUEUE,
)
from callstrata.session import cut_lineage
from callstrata.settings import Settings

# Parts in which the legs of one very common call id are reduced first.
_SLICES = 1024
_FIRST_TOUCH = [
    "LandingNumber", "callerNr", "ChannelType", "QueueId", "CaseId", "Duration", "TalkTimeInSec",
]


def collapse_calls(
    legs: DataFrame, excluded_queues: Sequence[str] = (), tie: Sequence[str] | None = None
) -> DataFrame:
    """One row per call: everything from its first leg, the status from its last leg.

    Legs are ordered by ``Created`` and then by the ``tie`` columns (all others by default). One
    shuffle and one sort per call id. Ids that hold more than a thousandth of all legs, and legs
    without an id, are first reduced in slices and then once more.
    """
    tie = list(tie) if tie is not None else [*_FIRST_TOUCH, "Status"]
    order = ["Created", *tie]
    rest = [c for c in [*_FIRST_TOUCH, "Status"] if c not in tie]
    heavy = [*heavy_values(legs, F.col("CallId"))]
    crowded = F.col("CallId").isNull() | (F.col("CallId").isin(heavy) if heavy else F.lit(False))
    legs = legs.select("CallId", *dict.fromkeys([*order, *rest])).withColumn(
        "_slice", F.when(crowded, 1 + F.pmod(F.xxhash64(*order), F.lit(_SLICES))).otherwise(0))
    call = Window.partitionBy("CallId", "_slice")
    firsts = legs.withColumns({
        "_place": F.row_number().over(call.orderBy(*order, *rest)),
        "_last": F.max(F.struct(*dict.fromkeys([*order, "Status"]))).over(call),
    }).where(F.col("_place") == 1)
    columns = [c for c in firsts.columns if c not in ("CallId", "_slice", "_place", "_last", "Created")]
    if heavy or legs.where(F.col("CallId").isNull()).limit(1).count():
        firsts = cut_lineage(firsts)
        whole = dict.fromkeys([*order, *rest])
        again = firsts.where(F.col("_slice") > 0).groupBy("CallId").agg(
            F.min(F.struct(*whole)).alias("_first"), F.max("_last").alias("_last"))
        firsts = firsts.where(F.col("_slice") == 0).select("CallId", "Created", *columns, "_last").unionByName(
            again.select("CallId", *[F.col(f"_first.{c}").alias(c) for c in ("Created", *columns)], "_last"))
    return firsts.select(
        "CallId", "Created", "LandingNumber", F.col("callerNr").alias("CallerNr"), "ChannelType", "QueueId",
        "CaseId", F.col("_last.Status").alias("Status"), "Duration", "TalkTimeInSec",
    ).where(not_listed(F.col("QueueId"), excluded_queues))


def enrich_calls(
    calls: DataFrame, mapping: DataFrame, settings: Settings, excluded: DataFrame | None = None
) -> DataFrame:
    """Attach customer and service to calls.

    Listed and empty landing numbers are removed; a null number stays as an unknown customer.
    ``mapping`` must hold one row per landing number (``one_row_per_number``).
    """
    number = trim_blanks(F.col("LandingNumber"))
    cleaned = calls.withColumn("LandingNumber", number).where(
        F.col("LandingNumber").isNull() | (F.col("LandingNumber") != "")
    )
    if excluded is not None:
        cleaned = lookup_join(
            cleaned, excluded.select("LandingNumber"), "LandingNumber", "left_anti",
            spread_by=["CallId"], settings=settings,
        )
    enriched = lookup_join(
        cleaned, mapping, "LandingNumber", "left", spread_by=["CallId"], settings=settings
    )
    enriched = enriched.withColumns({
        SUBSIDIARY: has_parent(F.col("ParentId")),
        "Name": F.coalesce("Name", F.lit(UNKNOWN_CUSTOMER_NAME)),
        "CustomerKey": F.coalesce("CustomerKey", F.lit(UNKNOWN_CUSTOMER_KEY)),
    })
    return map_values(enriched, "QueueId", settings.queue_to_service, SERVICE, UNKNOWN_QUEUE)


def flag_redials(calls: DataFrame, threshold_sec: int = 300, slot_sec: int | None = None) -> DataFrame:
    """Add ``is_redial``: the caller's previous call was abandoned in the same queue and ended
    up to ``threshold_sec`` earlier. Numbers of fewer than 7 digits are never redials."""
    digits = F.col("_digits")  # a column of its own, so the pattern runs once per call
    return flag_follow_ups(
        calls.withColumn("_digits", digits_only(F.col("CallerNr"))),
        party=F.when(F.length(digits) >= 7, digits),
        at="Created", tie="CallId",
        previous_hit=status_is(F.col("Status"), ABANDONED),
        same_as_previous="QueueId",
        within_sec=threshold_sec, flag="is_redial", slot_sec=slot_sec,
    ).drop("_digits")


def with_date(df: DataFrame, ts: str = "Created", name: str = "Datum") -> DataFrame:
    return df.withColumn(name, F.to_date(ts))


def abandoned_report(enriched: DataFrame) -> DataFrame:
    return with_date(enriched.where(status_is(F.col("Status"), ABANDONED)))


def training_data(enriched: DataFrame) -> DataFrame:
    return with_date(keep_existing(enriched, TRAINING_COLUMNS))


def call_measures(calls: DataFrame) -> DataFrame:
    """Add ``is_abandoned``, ``is_answered`` and ``WaitTime``."""
    abandoned = status_is(F.col("Status"), ABANDONED).cast("int")
    return calls.withColumns({
        "is_abandoned": abandoned,
        "is_answered": F.lit(1) - abandoned,
        "WaitTime": at_least_zero(F.col("Duration") - F.col("TalkTimeInSec")),
    })

