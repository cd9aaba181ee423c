"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callstrata.llm.common import sized, stored
from callstrata.llm.tokens import encoded, task_number, texts_of


def best_fit(histogram: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots for pieces by length: (length, from rank, to rank, first sequence, offset).

    Piece number k of a length, with k in [from, to), goes to sequence first + k - from. Lengths
    are taken from the longest; each goes to the open sequences it fills best. Sequences filled
    alike are handled together, so the work depends on the capacity and not on the counts.
    """
    room: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]  # by free space: (first, count)
    slots, opened = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            free = next((r for r in range(length, capacity) if room[r]), capacity)
            if free == capacity:
                count = -(-left // (capacity // length))
                room[capacity].append((opened, count))
                opened += count
            first, count = room[free].popleft()
            taken = min(left, count)
            slots.append((length, rank, rank + taken, first, capacity - free))
            if taken < count:
                room[free].appendleft((first + taken, count - taken))
            room[free - length].append((first, taken))
            rank, left = rank + taken, left - taken
    return slots


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids, ids_crc32 of the ids as little-endian unsigned 32-bit integers)
    with the task that made them (chunk) and their number among that task's pieces of their length (nth)."""
    texts = texts_of(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, seen = task_number(), np.zeros(capacity + 1, np.int64)
        for ids, tokens in encoded(batches, tokenizer, end_id):
            sizes = np.array([len(x) // 4 for x in tokens], np.int64)
            counts = -(-sizes // capacity)
            rows = np.repeat(np.arange(len(sizes)), counts)
            places = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
            rest = (sizes - (counts - 1) * capacity)[rows]  # of the first piece
            starts = np.where(places > 0, rest + (places - 1) * capacity, 0)
            lengths = np.where(places > 0, capacity, rest)
            data = b"".join(tokens)
            ends = 4 * np.cumsum(lengths)
            crc = [zlib.crc32(data[a:b]) for a, b in zip((ends - 4 * lengths).tolist(), ends.tolist(), strict=True)]
            order = np.argsort(lengths, kind="stable")  # equal lengths numbered in order
            first = np.searchsorted(lengths[order], lengths[order])
            nth = np.empty(len(rows), np.int64)
            nth[order] = seen[lengths[order]] + np.arange(len(rows)) - first
            seen += np.bincount(lengths, minlength=capacity + 1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(np.frombuffer(data, "<i4")))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows)), pa.array(places.astype(np.int32)), pa.array(starts), pa.array(lengths), lists,
                 pa.array(crc, pa.int64()), pa.array(np.full(len(rows), chunk, np.int32)), pa.array(nth)],
                ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "chunk", "nth"])

    return texts.mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids array<int>, ids_crc32 bigint, chunk int, nth bigint")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    Texts are encoded whole (null: empty) and get end_id, so every row has a token. Only documents
    longer than the capacity are cut; then the first piece takes what the full ones leave. Places
    are planned on the counts of lengths (at most `capacity` numbers) and joined to the pieces by
    length and rank. The rank of a piece is its number in the task that wrote it plus the pieces of
    that length in earlier tasks, so no length is ever numbered in one place, however common.

    Repeated rows are packed each. No rows give no rows. Only doc_id and text are read.
    """
    pieces = stored(cut(docs, tokenizer, end_id, capacity))
    counts = stored(pieces.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n")))
    before = W.partitionBy("length").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    bases = stored(counts.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = docs.sparkSession.createDataFrame(
        best_fit(histogram, capacity),
        "slot_length bigint, from_rank bigint, to_rank bigint, first bigint, offset bigint")
    ranked = pieces.join(sized(bases, bases.count()), ["length", "chunk"]).withColumn(
        "rank", F.col("base") + F.col("nth"))
    # the plan's size depends on the capacity alone
    return ranked.join(
        F.broadcast(slots),
        (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")),
    ).select(
        "doc_id", "piece", "start", "length", "ids", "ids_crc32",
        (F.col("first") + F.col("rank") - F.col("from_rank")).alias("sequence_id"), "offset",
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts): the packed sequences; a group is at most one capacity long."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return pieces.groupBy("sequence_id").agg(inside.alias("own")).select(
        "sequence_id", F.flatten("own.ids").alias("ids"), F.col("own.doc_id").alias("doc_ids"),
        F.col("own.offset").alias("starts"))
