"""Declarative sources."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from callstrata.functions.text import trim_blanks
from callstrata.schemas import EXCLUDED_NUMBERS


@dataclass(frozen=True)
class SourceSpec:
    """Where a table comes from: any Spark reader format and its options."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    schema: T.StructType | str | None = None


def jdbc_source(
    url: str, table: str, partition_column: str | None = None, lower: str | None = None,
    upper: str | None = None, partitions: int = 64, fetch_size: int = 50_000, **options: str,
) -> SourceSpec:
    """A database table read in parallel ranges of ``partition_column``."""
    opts = {
        "url": url, "dbtable": table, "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true", **options,
    }
    if partition_column:
        opts |= {
            "partitionColumn": partition_column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions),
        }
    return SourceSpec("jdbc", opts)


def parquet_source(path: str, schema: T.StructType | str | None = None) -> SourceSpec:
    return SourceSpec("parquet", path=path, schema=schema)


def read_source(spark: SparkSession, source: SourceSpec) -> DataFrame:
    reader = spark.read.format(source.format).options(**source.options)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    return reader.load(source.path) if source.path else reader.load()


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() in {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def read_exclusion_list(spark: SparkSession, path: str | None) -> DataFrame:
    """Landing numbers to leave out, kept as text; a missing file is an empty list."""
    empty = spark.createDataFrame([], EXCLUDED_NUMBERS)
    if not path:
        return empty
    try:
        listed = spark.read.schema(EXCLUDED_NUMBERS).option("header", True).csv(path)
    except AnalysisException as error:
        if is_missing(error):
            return empty
        raise
    return listed.select(trim_blanks(listed.LandingNumber).alias("LandingNumber")).distinct()
