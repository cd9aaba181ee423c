"""Copying source tables into the bronze layer."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.operators.columns import wall_time
from callstrata.session import cut_lineage
from callstrata.settings import Settings
from callstrata.sources.readers import SourceSpec, read_source
from callstrata.sources.warehouse import LOAD_DAY, Warehouse

INCREMENTAL = "INCREMENTAL"
CHANGES = "CHANGES"
FULL = "FULL"


@dataclass(frozen=True)
class IngestSpec:
    """``INCREMENTAL`` adds later rows, ``CHANGES`` also takes over rows that differ, ``FULL`` replaces all."""

    source: SourceSpec
    target: str
    load_type: str
    time_col: str | None = None
    key_cols: Sequence[str] = ()


def bronze_specs(sources: dict[str, SourceSpec], settings: Settings) -> list[IngestSpec]:
    """Calls and cases grow and are loaded incrementally; the registers are replaced."""
    tables = settings.bronze_tables
    return [
        IngestSpec(sources["cdr"], tables["cdr"], INCREMENTAL, "Created"),
        IngestSpec(sources["cases"], tables["cases"], INCREMENTAL, "Created", ("CaseId",)),
        IngestSpec(sources["customers"], tables["customers"], FULL),
        IngestSpec(sources["groups"], tables["groups"], FULL),
        IngestSpec(sources["users"], tables["users"], FULL),
    ]


def high_watermark(target: DataFrame | None, time_col: str) -> str | None:
    """Latest time stored in the target as text; None for a missing or empty target."""
    if target is None:
        return None
    return target.agg(F.max(time_col).cast("string").alias("latest")).first()["latest"]


def new_rows(
    source: DataFrame, target: DataFrame | None, time_col: str,
    key_cols: Sequence[str] = (), strict: bool = False, latest: str | None = None,
) -> DataFrame:
    """Source rows the target does not hold yet, judged by the target's latest time.

    The latest time (looked up unless given) enters as a literal, so the source (a database or
    files) filters by it instead of sending everything. The strict form takes only later rows. The
    default form also takes the rows of exactly the latest time that are not stored yet, so late
    arrivals with an equal time are kept. They are compared by key, or without key columns as whole
    rows, where repeats count separately.
    """
    latest = latest or high_watermark(target, time_col)
    if latest is None:
        return source
    time = F.col(time_col)
    watermark = F.lit(latest).cast(source.schema[time_col].dataType)
    later = source.where(time > watermark)
    if strict:
        return later
    # Only rows of one instant are compared, so the bulk of the load is never shuffled.
    tied, stored = source.where(time == watermark), target.where(time == watermark)
    if key_cols:
        missed = tied.join(stored.select(*key_cols).distinct(), list(key_cols), "left_anti")
    else:
        missed = tied.exceptAll(stored.select(*source.columns))
    return later.unionByName(missed.select(*source.columns))


def content_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row. Nulls are hashed as such, so a value that moves to a neighbouring column shows."""
    return F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def newest_rows(df: DataFrame, key_cols: Sequence[str], time_col: str) -> DataFrame:
    """One row per key: that of the latest time, nulls first; equal times go to the greatest content hash."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    newest = df.groupBy(*[F.col(f"`{k}`") for k in key_cols]).agg(
        F.max_by(row, F.struct(F.col(f"`{time_col}`"), content_hash(df.columns))).alias("row"))
    return newest.select("row.*")


def changed_rows(source: DataFrame, target: DataFrame, key_cols: Sequence[str], time_col: str) -> DataFrame:
    """Source rows whose key is not in the target, or is there with other content, once for every stored row
    that differs: ``row`` is the source's row, ``was`` the day that row is kept under, null for a new key.

    Keys are compared null-safely. Of the target only keys, days and hashes are shuffled. ``target`` has the
    hidden day column; a source column it lacks is null there.
    """
    stored = {c.lower(): c for c in target.columns}
    named = {f.name.lower(): f for f in source.schema}
    alike = target.select(F.col(LOAD_DAY).alias("_was"), *[
        (F.col(f"`{stored[low]}`") if low in stored else F.lit(None)).cast(f.dataType).alias(f.name)
        for low, f in named.items()])

    def digest(rows: DataFrame, key: str, *more: Column) -> DataFrame:
        keys = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(key_cols)])
        return rows.select(keys.alias(key), content_hash(source.columns).alias(f"{key}_hash"), *more)

    ours = digest(
        newest_rows(source, key_cols, time_col), "ours",
        F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("row"))
    theirs = digest(alike, "theirs", F.col("_was").alias("was"), F.lit(True).alias("held"))
    same = F.lit(True)
    for i in range(len(key_cols)):
        same = same & F.col(f"ours.k{i}").eqNullSafe(F.col(f"theirs.k{i}"))
    differs = F.col("held").isNull() | (F.col("ours_hash") != F.col("theirs_hash"))
    return ours.join(theirs, same, "left").where(differs).select("row", "was", "held")


def merge_changes(
    warehouse: Warehouse, source: DataFrame, table: str, key_cols: Sequence[str], time_col: str,
) -> int:
    """Bring new and changed rows of the source into a growing table; returns their number.

    Only days that lose or get a row are written anew, in one step each; other days keep their files. A
    row whose time moved to another day leaves the old one. Rows the source no longer has stay. As rows
    are found by key and content, a merge that broke off is completed by the next.
    """
    if not key_cols:
        raise ValueError(f"{table}: changed rows are found by key, none is named")
    if not warehouse.exists(table):
        return warehouse.append(newest_rows(source, key_cols, time_col), table, time_col)
    target = warehouse.with_days(table)
    changed = cut_lineage(changed_rows(source, target, key_cols, time_col))
    day = F.to_date(f"row.`{time_col}`")
    # A table's days are few, so the list of touched ones is a literal that prunes the target's folders.
    touched = changed.select(day.alias("day"), F.when(F.col("held"), F.col("was")).otherwise(day).alias("was")).distinct().collect()
    if not touched:
        return 0
    days, left = {r["day"] for r in touched} | {r["was"] for r in touched}, {r["was"] for r in touched if r["was"] != r["day"]}
    incoming = newest_rows(changed.select("row.*"), key_cols, time_col)
    kept = _on_days(target, days)
    keys = incoming.select(*[F.col(f"`{k}`").alias(f"_changed_{i}") for i, k in enumerate(key_cols)])
    match = F.lit(True)
    for i, k in enumerate(key_cols):
        match = match & F.col(f"`{k}`").eqNullSafe(F.col(f"_changed_{i}"))
    kept = kept.join(keys, match, "left_anti")
    # Days that only lose rows and keep none are not among the rows written, so they are dropped.
    emptied = left - {r[0] for r in _on_days(kept, left).select(LOAD_DAY).distinct().collect()} - {r["day"] for r in touched} if left else set()
    merged = kept.drop(LOAD_DAY).unionByName(incoming, allowMissingColumns=True)
    warehouse.replace_days(merged, table, time_col)
    warehouse.drop_days(table, sorted(emptied, key=str))
    return incoming.count()


def _on_days(rows: DataFrame, days: set[date | None]) -> DataFrame:
    known = [d for d in days if d is not None]
    wanted = F.col(LOAD_DAY).isin(known) if known else F.lit(False)
    return rows.where(wanted | F.col(LOAD_DAY).isNull() if None in days else wanted)


def load_one(
    spark: SparkSession, warehouse: Warehouse, spec: IngestSpec, strict: bool = False
) -> int:
    """Load one table and return the number of rows written."""
    source = read_source(spark, spec.source)
    if spec.load_type == INCREMENTAL:
        source = wall_time(source, spec.time_col)
        latest, target = warehouse.latest(spec.target, spec.time_col), None
        if latest is not None:
            day = date.fromisoformat(latest[:10])
            target = warehouse.read_days(spec.target, day, day + timedelta(days=1))
        fresh = new_rows(source, target, spec.time_col, spec.key_cols, strict, latest)
        return warehouse.append(fresh, spec.target, spec.time_col)
    if spec.load_type == CHANGES:
        return merge_changes(
            warehouse, wall_time(source, spec.time_col), spec.target, spec.key_cols, spec.time_col)
    if spec.load_type == FULL:
        if source.isEmpty():
            return 0  # an empty source never empties the target
        return warehouse.publish(source, spec.target)
    raise ValueError(f"unknown load type {spec.load_type}")


def load_all(
    spark: SparkSession, warehouse: Warehouse, specs: Sequence[IngestSpec], strict: bool = False, at_once: int = 4,
) -> DataFrame:
    """Load every table, up to `at_once` side by side; one failure does not stop the others.

    Returns one status row each, in the given order. Where the session schedules fairly, every load has
    a pool of its own, so a small table does not wait for a large one.
    """
    def status(spec: IngestSpec) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"load-{spec.target}")
        try:
            written = load_one(spark, warehouse, spec, strict)
            return spec.target, spec.load_type, "LOADED" if written else "EMPTY", written, None
        except Exception as error:  # reported per table, as the caller needs all of them
            return spec.target, spec.load_type, "FAILED", 0, str(error)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        # every load starts with the caller's local properties
        rows = [pool.submit(inheritable_thread_target(spark)(status), spec) for spec in specs]
        rows = [row.result() for row in rows]
    return spark.createDataFrame(
        rows, "target string, load_type string, status string, written bigint, error string"
    )
