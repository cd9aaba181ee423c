"""Token ids in Parquet: dictionary-coded lists, delta-coded numbers, small row groups, page indexes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.llm.common import sized
from callstrata.llm.tokens import encoded_lists, task_number, texts_of


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int,
    row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10, page_rows: int = 2_000,
) -> None:
    """Encode whole texts (null: empty), append end_id, and write them below `path` by ascending doc_id.

    path/ids has one row per document: doc_id, part (its file's number, ascending with doc_id),
    local_start (ids before it in that part), n_tokens, ids. ids is a dictionary-coded list; the
    numbers are delta-coded; row groups and pages are kept small and carry min/max indexes, so a
    reader of some documents or of the numbers alone skips the rest. path/parts has the number of
    ids before each part; it is written last, so a folder without it is unfinished.

    Null doc_ids come first, equal ones are ordered by text. No rows give an empty table. Only
    doc_id and text are read.
    """
    ordered = texts_of(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    kind = ordered.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = task_number(), 0
        for ids, tokens in encoded_lists(batches, tokenizer, end_id):
            n = np.diff(tokens.offsets.to_numpy()).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.full(len(n), part, np.int32)), pa.array(start + np.cumsum(n) - n),
                 pa.array(n), tokens],
                ["doc_id", "part", "local_start", "n_tokens", "ids"])
            start += int(n.sum())

    rows = ordered.mapInArrow(
        run, f"doc_id {kind}, part int, local_start bigint, n_tokens bigint, ids array<int>")
    writer = rows.write.mode("overwrite")
    for key, value in {
        "parquet.writer.version": "v2",  # delta coding where there is no dictionary
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": "true",
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "compression": "zstd",
    }.items():
        writer = writer.option(key, value)
    writer.parquet(f"{path}/ids")
    spark = docs.sparkSession
    sums = spark.read.parquet(f"{path}/ids").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base, parts = 0, []
    for row in sums.orderBy("part").collect():  # one row per file
        parts.append((row["part"], base))
        base += row["n"]
    spark.createDataFrame(parts, "part int, base bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids, or those of them named.

    Filters on doc_id reach row groups and pages; without ids the lists are not read.
    """
    parts = spark.read.parquet(f"{path}/parts")
    rows = spark.read.parquet(f"{path}/ids").join(sized(parts, parts.count()), "part")
    wanted = columns or ("doc_id", "start", "n_tokens", "ids")
    return rows.withColumn("start", F.col("base") + F.col("local_start")).select(*wanted)
