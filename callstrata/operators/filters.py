"""Row predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_listed(key: Column, listed: Sequence) -> Column:
    """SQL ``NOT IN``: a null key is dropped; an empty list only drops nulls."""
    present = key.isNotNull()
    return present & ~key.isin(list(listed)) if listed else present


def not_listed_if_any(key: Column, listed: Sequence) -> Column:
    """``NOT IN`` that does nothing at all when there is no list."""
    return not_listed(key, listed) if listed else F.lit(True)


def in_period(ts: Column, start: Column, end: Column) -> Column:
    """Half-open [start, end), so no fraction of the last second is lost."""
    return (ts >= start) & (ts < end)


def on_days(ts: Column, first: Column, last: Column) -> Column:
    """Calendar days first..last, both included, without wrapping the column in a function,
    so the bound reaches the file scan."""
    start = first.cast("date").cast("timestamp_ntz")
    end = F.date_add(last.cast("date"), 1).cast("timestamp_ntz")
    return in_period(ts, start, end)
