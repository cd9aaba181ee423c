"""Window operators over groups whose size is bounded by the calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callstrata.functions.calendar import wall_seconds
from callstrata.functions.numbers import ratio


def lag_days(
    df: DataFrame, groups: Sequence[str], ds: str, target: str, days: Sequence[int],
    rows_per_day: int,
) -> DataFrame:
    """Add ``<target>_lag_<k>d`` columns on a gap-free series of every group.

    ``rows_per_day`` is explicit (24 on an hourly grid, 1 on a daily one). All lags share one
    window specification and therefore one sort.
    """
    series = Window.partitionBy(*groups).orderBy(ds)
    return df.withColumns(
        {f"{target}_lag_{k}d": F.lag(target, k * rows_per_day).over(series) for k in days}
    )


def share(value: Column, groups: Sequence[str]) -> Column:
    """Share of a value in the total of its group, 0 where the total is not positive."""
    return ratio(value, F.sum(value).over(Window.partitionBy(*groups)))


def apportion(df: DataFrame, parts: Sequence[str], groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Round columns to whole numbers so that each keeps the (whole) total of its group.

    Every part is cut down, and what the group then lacks goes, one each, to the largest fractions;
    equal ones in the given order. Fractions are compared to nine digits, as sums carry noise.
    """
    whole = Window.partitionBy(*groups)
    fine = {p: F.round(F.col(f"`{p}`").cast("double"), 9) for p in parts}
    cut = df.withColumns({f"_{p}_cut": F.floor(x) for p, x in fine.items()})
    rest = {f"_{p}_rest": F.round(x - F.col(f"_{p}_cut"), 9) for p, x in fine.items()}
    lacking = {f"_{p}_lacks": (F.round(F.sum(F.col(f"`{p}`")).over(whole), 0) - F.sum(f"_{p}_cut").over(whole)) for p in parts}
    placed = cut.withColumns(rest).withColumns(lacking).withColumns({
        f"_{p}_place": F.row_number().over(whole.orderBy(F.desc(f"_{p}_rest"), *order)) for p in parts})
    raised = {p: (F.col(f"_{p}_cut") + (F.col(f"_{p}_place") <= F.col(f"_{p}_lacks")).cast("int")).cast("bigint") for p in parts}
    return placed.withColumns(raised).drop(*[f"_{p}_{x}" for p in parts for x in ("cut", "rest", "lacks", "place")])


def top_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int, rank: str
) -> DataFrame:
    """The k first rows of every group with their position."""
    position = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn(rank, position).where(F.col(rank) <= k)


def flag_follow_ups(
    df: DataFrame,
    party: Column,
    at: str,
    tie: str,
    previous_hit: Column,
    same_as_previous: str,
    within_sec: int,
    flag: str,
    slot_sec: int | None = None,
) -> DataFrame:
    """Flag rows whose immediately preceding row of the same party came at most ``within_sec``
    before, satisfied ``previous_hit`` and agrees on ``same_as_previous``.

    A row can only be flagged by a predecessor at most ``within_sec`` older, so time is cut into
    slots and the window runs per (party, slot). A row is repeated as context into every later
    slot it reaches and dropped there afterwards. A party that holds a large part of all rows is
    spread over as many tasks as there are slots, and the result is the same as over one unbroken
    window, whatever the slot's length. Rows without a party or a time (null) can never be flagged;
    they are neither shuffled nor sorted.
    """
    slot_sec = slot_sec or max(3600, 4 * within_sec)
    known = df.withColumn("_party", party)
    eligible = F.col("_party").isNotNull() & F.col(at).isNotNull()
    alone = known.where(~eligible).withColumn(flag, F.lit(0)).drop("_party")
    keyed = known.where(eligible).withColumn(
        "_sec", wall_seconds(F.col(at))
    ).withColumn("_own", F.col("_sec") - F.pmod(F.col("_sec"), F.lit(slot_sec)))
    # One second more than needed, as fractions of a second are cut off.
    reach = F.col("_sec") + within_sec + 1
    last = F.greatest(F.col("_own"), reach - F.pmod(reach, F.lit(slot_sec)))
    placed = keyed.withColumn("_slot", F.explode(F.sequence(F.col("_own"), last, F.lit(slot_sec))))

    series = Window.partitionBy("_party", "_slot").orderBy(at, tie)
    before = F.lag(at).over(series)
    latest = before + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(within_sec))
    hit = (
        (F.col(at) > before) & (F.col(at) <= latest)
        & F.lag(previous_hit.cast("boolean")).over(series)
        & (F.col(same_as_previous) == F.lag(same_as_previous).over(series))
    )
    flagged = placed.withColumn(flag, F.coalesce(hit, F.lit(False)).cast("int")).where(
        F.col("_slot").eqNullSafe(F.col("_own")))
    return flagged.drop("_party", "_sec", "_own", "_slot").unionByName(alone)
