"""Gap-free time grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_STEPS = {"hour": "INTERVAL '1' HOUR", "day": "INTERVAL '1' DAY"}


def fill_grid(
    df: DataFrame, groups: Sequence[str], ds: str, measures: Sequence[str],
    first: Column, last: Column, step: str,
) -> DataFrame:
    """Give every group one row per step from ``first`` to ``last``, 0 where it had none.

    Same rows as crossing all steps with the distinct groups and joining the facts back, but
    every fact row itself emits the steps up to the next fact of its group. That needs one
    shuffle by group, which later windows over the same group reuse, and no join at all.
    Requires unique (groups, ds) within the bounds.
    """
    interval = F.expr(_STEPS[step])
    series = Window.partitionBy(*groups).orderBy(ds)
    begin = F.when(F.lag(ds).over(series).isNull(), first).otherwise(F.col(ds))
    end = F.coalesce(F.lead(ds).over(series) - interval, last)
    placed = df.withColumns({"_begin": begin, "_end": end})
    emitted = placed.withColumn(
        "_step", F.explode(F.sequence(F.col("_begin"), F.col("_end"), interval))
    )
    own = F.col("_step") == F.col(ds)
    return emitted.select(
        F.col("_step").alias(ds), *groups,
        *[F.when(own, F.col(m)).otherwise(F.lit(0)).cast("bigint").alias(m) for m in measures],
    )


def expand_hours(df: DataFrame, day: str, ds: str) -> DataFrame:
    """24 hourly rows for every row of a day."""
    start = F.col(day).cast("timestamp_ntz")
    end = start + F.expr("INTERVAL '23' HOUR")
    return df.withColumn(ds, F.explode(F.sequence(start, end, F.expr(_STEPS["hour"]))))
