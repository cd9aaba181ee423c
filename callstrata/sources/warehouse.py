"""Tables of the warehouse in the session's catalog: publishing, growing tables, archive, models."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import UTC, date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from callstrata.session import shared_path
from callstrata.sources.readers import is_missing

#: Hidden partition column of growing tables.
LOAD_DAY = "_load_day"
_STAMP = "%Y%m%d%H%M%S%f"


class PublishError(RuntimeError):
    pass


class _Counter:
    """Counts the rows of a write while it runs."""

    def __init__(self, df: DataFrame):
        self._seen = Observation(f"rows_{uuid.uuid4().hex}")
        self.df = df.observe(self._seen, F.count(F.lit(1)).alias("rows"))

    def rows(self) -> int:
        try:
            return self._seen.get["rows"]
        except Py4JJavaError:
            # Proven empty, the input was planned away and the observation with it.
            if self.df.isEmpty():
                return 0
            raise


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Few files per partition, and a partition holding most rows is split again."""
    return df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by]) if partition_by else df


class Warehouse:
    """Parquet tables of one catalog database kept below one root folder.

    A published table is a view over a version, itself a table of the catalog. A new version is written
    and checked first; replacing the view is one step, so readers see the old rows or the new, and a
    failed run leaves the old ones. Versions without a view stay for ``grace_sec``, as readers may still
    be busy with them. Growing tables and the archive are partitioned tables that rows are inserted into.

    With a persistent catalog (``spark.sql.catalogImplementation=hive``) later applications find what an
    earlier one stored. Where the catalog ends with the application, Spark refuses to create a table
    over files left by another, so nothing is loaded twice unseen. One writer per table at a time.
    """

    def __init__(
        self, spark: SparkSession, root: str, database: str = "callstrata", grace_sec: float = 7 * 86_400,
    ):
        self.spark = spark
        self.root = shared_path(spark, root).rstrip("/")
        self.database = database
        self.grace_sec = grace_sec
        place = self.root.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{place}'")
        kept = spark.catalog.getDatabase(database).locationUri.rstrip("/")
        if not kept.endswith(self.root.split("://")[-1].removeprefix("file:")):
            raise ValueError(f"database {database} lies in {kept}, not in {self.root}")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def _stored(self, table: str) -> DataFrame:
        if not self.exists(table):
            raise LookupError(f"{self.database} has no table {table}")
        return self.spark.table(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self._stored(table).drop(LOAD_DAY)

    def read_or_none(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def with_days(self, table: str) -> DataFrame:
        """A growing table with the day that each row is kept under."""
        rows = self._stored(table)
        if LOAD_DAY not in rows.columns:
            raise ValueError(f"{table} is not kept by day")
        return rows

    def read_days(self, table: str, first: date, end: date) -> DataFrame:
        """Rows of the days [first, end) of a growing table; other days' files are not opened."""
        day = F.col(LOAD_DAY)
        return self.with_days(table).where((day >= F.lit(first)) & (day < F.lit(end))).drop(LOAD_DAY)

    def latest(self, table: str, time_col: str) -> str | None:
        """Latest time of a growing table as text: the catalog names the last day, only its files are read."""
        if not self.exists(table):
            return None
        rows = self.with_days(table)
        days = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}")
        last = days.agg(F.max(F.split_part("partition", F.lit("="), F.lit(2)).try_cast("date"))).first()[0]
        if last is None:
            return None
        return rows.where(F.col(LOAD_DAY) == F.lit(last)).agg(F.max(time_col).cast("string")).first()[0]

    def _versions(self, table: str) -> list[str]:
        """The versions of a published table, oldest first."""
        wanted = re.compile(re.escape(table.lower()) + r"__\d{20}_[0-9a-f]{8}")
        names = self.spark.sql(f"SHOW TABLES IN `{self.database}` LIKE '{table.lower()}__*'").collect()
        return sorted(r["tableName"] for r in names if wanted.fullmatch(r["tableName"].lower()))

    def _drop_old(self, table: str, current: str) -> None:
        """Drop the versions that were followed by another one at least ``grace_sec`` ago."""
        now = datetime.now(UTC)
        versions = [v for v in self._versions(table) if v != current] + [current]
        for version, follower in zip(versions, versions[1:]):
            followed = now if follower == current else datetime.strptime(
                follower.split("__")[-1].split("_")[0], _STAMP).replace(tzinfo=UTC)
            if (now - followed).total_seconds() >= self.grace_sec:
                self.spark.sql(f"DROP TABLE {self.name(version)}")

    def _show(self, table: str, version: str, columns: Sequence[str]) -> None:
        listed = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} AS SELECT {listed} FROM {self.name(version)}")

    def publish(
        self, df: DataFrame, table: str, partition_by: Sequence[str] = (),
        projections: Mapping[str, Sequence[str]] | None = None,
    ) -> int:
        """Replace a table; returns its row count.

        ``projections`` names further tables that are columns of this one: they are views of the same
        version instead of being written again.
        """
        version = f"{table.lower()}__{datetime.now(UTC).strftime(_STAMP)}_{uuid.uuid4().hex[:8]}"
        try:
            written = self._insert(df, version, partition_by, overwrite=False)
            stored = self.spark.table(self.name(version)).count()
            if stored != written:
                raise PublishError(f"{table}: wrote {written} rows but stored {stored}")
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(version)}")
            raise
        for shown, columns in {table: df.columns, **(projections or {})}.items():
            self._show(shown, version, columns)
        self._drop_old(table, version)
        return written

    def _insert(self, df: DataFrame, table: str, partition_by: Sequence[str], overwrite: bool) -> int:
        """Insert by column name; new columns join the table, columns that are missing are null.

        A missing table is created. Overwriting replaces only the partitions among the rows.
        """
        if not self.exists(table):
            # Made empty, as rows inserted name their partitions while a filled table's are searched for.
            df.limit(0).write.format("parquet").partitionBy(*partition_by).option(
                "partitionOverwriteMode", "dynamic").saveAsTable(self.name(table))
            try:
                return self._insert(df, table, partition_by, overwrite)
            except Exception:
                self.spark.sql(f"DROP TABLE {self.name(table)}")
                raise
        stored = self._stored(table).schema
        new = [f for f in df.schema if f.name.lower() not in {c.lower() for c in stored.names}]
        if new:
            listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({listed})")
            stored = self._stored(table).schema
        given = {c.lower(): c for c in df.columns}
        # Counted after any shuffle: tasks of the last stage are counted once even when repeated.
        counter = _Counter(_rebalanced(df.select(*[
            (F.col(f"`{given[f.name.lower()]}`") if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in stored]), partition_by))
        counter.df.write.insertInto(self.name(table), overwrite=overwrite)
        return counter.rows()

    def append(self, df: DataFrame, table: str, time_col: str) -> int:
        """Add rows to a table, creating it on first use; returns the number of rows added.

        The table is partitioned by the day of ``time_col`` in a hidden column, so reading a period
        touches the days concerned and not the whole past.
        """
        return self._insert(self._dated(df, time_col), table, [LOAD_DAY], overwrite=False)

    def replace_days(self, df: DataFrame, table: str, time_col: str) -> int:
        """Write the days found among the rows anew; every other day keeps its files."""
        return self._insert(self._dated(df, time_col), table, [LOAD_DAY], overwrite=True)

    def drop_days(self, table: str, days: Sequence[date | None]) -> None:
        for day in days:
            value = "NULL" if day is None else f"DATE '{day.isoformat()}'"
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION (`{LOAD_DAY}` = {value})")

    def compact(self, table: str, time_col: str, first: date, end: date) -> int:
        """Rewrite the days [first, end) of a growing table, each load's small files as few large ones."""
        return self.replace_days(self.read_days(table, first, end), table, time_col)

    @staticmethod
    def _dated(df: DataFrame, time_col: str) -> DataFrame:
        if LOAD_DAY in df.columns:
            raise ValueError(f"a source may not have a column {LOAD_DAY}")
        return df.withColumn(LOAD_DAY, F.to_date(time_col))

    def archive(self, df: DataFrame, table: str, run_column: str) -> int:
        """Replace only the runs present in ``df``; every other run of the table stays."""
        return self._insert(df, table, [run_column], overwrite=True)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """The saved model with its feature list and categories, or None when there is none."""
    try:
        spark.read.text(f"{path}/metadata").schema  # noqa: B018 - resolves the path
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise
    return PipelineModel.load(path)
