"""Session defaults and the reliable checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "callstrata", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Only a local-mode session may fall back to a folder of its own machine; on a cluster the
    folder has to be configured, since other executors must be able to read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="callstrata-checkpoint-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def shared_path(spark: SparkSession, path: str) -> str:
    """The path as given; off local mode a relative or machine-local one is refused."""
    if not spark.sparkContext.master.startswith("local") and (
            path.startswith("file:") or not (path.startswith("/") or "://" in path)):
        raise RuntimeError(f"{path} is not a folder all executors share")
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it from there.

    Used for results that are small beside their input and read more than once. A lost executor
    then costs a re-read and not the whole past; unlike a checkpointed RDD the stored columns are
    pruned and their size is known to the optimizer.
    """
    spark = df.sparkSession
    path = f"{use_checkpoint_dir(spark).rstrip('/')}/callstrata/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
