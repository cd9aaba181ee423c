"""Ranked lexical search with impact-sorted lists read in turn until every answer is settled (NRA)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callstrata.llm.common import limit_batches, remember_only, slices, stored

#: Bytes that end a term become spaces, A-Z lower case; every other byte, letters outside ASCII too, is kept.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Items searched in one pass over the documents; more are taken in blocks.
BLOCK = 2_000
#: Postings of one segment, the documents whose lists a task holds at once.
SEGMENT = 2_000_000
#: Postings read from each list in the first round; every round reads twice as many as the one before.
FIRST_READ = 64


def terms(data: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats; null has none."""
    return (data or b"").translate(TERM_BYTES).split()


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, all their terms, and for each wanted term the documents that hold it."""

    documents: int
    terms: int
    holding: dict[int, int]

    def weight(self, term: int) -> int:
        return floor(1000 * log((2 * self.documents + 2) / (2 * self.holding.get(term, 0) + 1)))

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What a term adds to a document's score, for weight 1."""
        length = 100 - 90 + (90 * n * self.documents) // max(self.terms, 1)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * length)


def postings(docs: DataFrame, wanted: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf): a row per row of docs with its number of terms, and the wanted terms it
    holds with their occurrences. Whole texts are read; the lists are at most as long as `wanted`."""
    limit_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(wanted)  # the terms of one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_only()
        number = known.value
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                sizes, ends, ids, times = [], [0], [], []
                for text in texts:
                    own = terms(text)
                    sizes.append(len(own))
                    held = [(number[t], k) for t, k in Counter(own).items() if t in number]
                    ids += [t for t, _ in held]
                    times += [k for _, k in held]
                    ends.append(len(ids))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))], ["doc_id", "n", "term", "tf"])

    rows = docs.select("doc_id", F.col("text").cast("binary"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, term array<int>, tf array<int>")


def statistics(rows: DataFrame) -> Statistics:
    """Counts over all rows of `postings`; as many numbers come to the driver as there are wanted terms."""
    n, total = rows.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    holding = rows.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()
    return Statistics(n, total or 0, {r["term"]: r["n"] for r in holding})


def nearest(lists: list[tuple[np.ndarray, np.ndarray]], tie: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents (places, scores) of lists (documents, additions), each sorted by addition, highest first.

    No list is looked up at random: all are read in turn from their heads, and a document's score lies between
    what its read postings add up to and that plus the last addition read of every list that has not shown it.
    Reading ends when every document whose upper bound reaches the k-th best lower bound has both bounds
    equal, so that members, their order, ties (the lower `tie` first) and scores can no longer change.
    """
    lower = np.zeros(len(tie), np.int64)
    shown = np.zeros((len(lists), len(tie)), bool)
    at, step = 0, FIRST_READ
    while True:
        last = np.zeros(len(lists), np.int64)
        for j, (where, adds) in enumerate(lists):
            part = slice(at, at + step)
            lower[where[part]] += adds[part]  # a list names a document once
            shown[j, where[part]] = True
            if at + step < len(where):
                last[j] = adds[at + step]  # nothing further down adds more
        at, step = at + step, step * 2
        least = int(np.partition(lower, -k)[-k]) if len(lower) >= k else 0
        open_ = last > 0
        more = np.full(len(tie), last.sum())
        for j in np.flatnonzero(open_):
            more -= last[j] * shown[j]
        if not open_.any() or not ((more > 0) & (lower + more >= max(least, 1))).any():
            break
    best = np.flatnonzero(lower >= max(least, 1))
    best = best[np.lexsort((tie[best], -lower[best]))][:k]
    return best, lower[best]


def _segment(ids: pa.Array, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray,
             counts: Statistics, weights: np.ndarray, items: list[np.ndarray], k: int) -> pa.RecordBatch:
    """The k best of one segment for every item: (item, doc_id, score)."""
    owner = np.repeat(np.arange(len(n)), sizes)
    impact = counts.impacts(tf, n[owner])
    order = np.lexsort((owner, -impact, term))
    term, owner, impact = term[order], owner[order], impact[order]
    edges = np.searchsorted(term, np.arange(len(weights) + 1))
    tie = np.empty(len(n), np.int64)  # places of the ids in ascending order, nulls last
    tie[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(n))
    places, scores, found = [], [], []
    for item, own in enumerate(items):
        lists = [(owner[edges[t]:edges[t + 1]], impact[edges[t]:edges[t + 1]] * weights[t]) for t in own.tolist()
                 if weights[t] > 0 and edges[t] < edges[t + 1]]
        if lists:
            best, score = nearest(lists, tie, k)
            places.append(best)
            scores.append(score)
            found.append(np.full(len(best), item, np.int32))
    empty = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([*found, np.zeros(0, np.int32)])), ids.take(pa.array(np.concatenate(places + empty))),
         pa.array(np.concatenate(scores + empty))], ["item", "doc_id", "score"])


def _search(rows: DataFrame, counts: Statistics, weights: np.ndarray, items: list[np.ndarray], k: int) -> DataFrame:
    """The k best of every segment; a segment is what a task reads next, up to SEGMENT postings."""
    shared = rows.sparkSession.sparkContext.broadcast((counts, weights, items))  # one block's terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_only()
        held, size = [], 0

        def searched() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lists = whole.column(2)
            return _segment(
                whole.column(0), whole.column(1).to_numpy(), np.diff(lists.offsets.to_numpy()),
                lists.flatten().to_numpy().astype(np.int64), whole.column(3).flatten().to_numpy().astype(np.int64), *shared.value, k)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += len(batch.column(2).flatten())
            if size >= SEGMENT:
                yield searched()
                held, size = [], 0
        if held:
            yield searched()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"item int, doc_id {kind}, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest score above 0 for every item.

    Items (item_id, text) are few beside the documents and taken in blocks of 2,000. Documents and items are cut
    into terms alike, an item's repeated terms count once. Statistics cover all documents. A document lies in
    one segment, whose impact-sorted lists are read until the segment's k best are final (`nearest`); the
    best of all segments are the best of all. No posting is shuffled, and what is, k rows per item and
    segment, does not depend on how common a term is.

    Equal scores rank by ascending doc_id, nulls last. Null and wordless texts have no terms: such documents
    are in no count, such items have no rows. Equal items (id and text) are one; equal ids with different
    texts are ranked apart. Repeated rows of docs are documents of their own. Empty tables give no rows.
    """
    spark = docs.sparkSession
    texts = stored(items.select("item_id", "text").distinct())
    total, out = texts.count(), None
    blocks = -(-total // BLOCK)
    numbered = texts.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))))
    kind = texts.schema["item_id"].dataType.simpleString()
    for block in range(blocks):
        rows = numbered.where(F.col("block") == block).select("item_id", F.col("text").cast("binary")).collect()
        rows.sort(key=lambda r: (str(r["item_id"]), bytes(r["text"] or b"")))
        own = [sorted(set(terms(bytes(r["text"] or b"")))) for r in rows]
        wanted = {t: i for i, t in enumerate(sorted({t for x in own for t in x}))}
        held = stored(postings(docs, wanted))
        counts = statistics(held)
        weights = np.array([counts.weight(t) for t in range(len(wanted))], np.int64)
        found = _search(held, counts, weights, [np.array([wanted[t] for t in x], np.int64) for x in own], k)
        names = F.broadcast(spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {kind}"))
        ranked = found.withColumn("rank", F.row_number().over(
            W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= k)
        ranked = ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        ids = docs.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {ids}, score bigint")
    return out
