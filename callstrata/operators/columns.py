"""Projections over whole tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_name(name: str) -> str:
    """Replace every run outside ``[A-Za-z0-9_]`` by one underscore."""
    return re.sub(r"[^A-Za-z0-9_]+", "_", name)


def fold_names(df: DataFrame) -> DataFrame:
    folded = [fold_name(c) for c in df.columns]
    clashes = {c for c in folded if folded.count(c) > 1}
    if clashes:
        raise ValueError(f"folded column names collide: {sorted(clashes)}")
    return df.toDF(*folded)


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project the wanted columns that the table has, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(value)) for c, value in defaults.items()}
    )


def wall_time(df: DataFrame, *columns: str) -> DataFrame:
    """Turn texts and zoned timestamps into zone-less ones, keeping the time on the clock."""
    zoned = [c for c in columns if dict(df.dtypes)[c] != "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def require_columns(df: DataFrame, wanted: Sequence[str]) -> None:
    """Fail loudly when a column is absent, where filling it would hide the mistake."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
