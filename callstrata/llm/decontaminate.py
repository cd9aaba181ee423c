"""Benchmark passages in documents, found by spaced seeds and verified with substitutions allowed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import Codes, anti, hash_set, in_set, limit_batches, packed, remember_only, sized, slices, stored, text_key

WORD = regex.compile(r"\w+")
#: Words looked at around a hit, and how many of them must agree.
WINDOW, EQUAL = 13, 11
#: Word positions a mask compares; it ignores those between. With at most two unequal words in a
#: window, two of its four position classes (modulo 4) are clean, and one of these masks, shifted by
#: up to three words, compares positions of two clean classes only. So no such window is missed.
MASKS = ((0, 1, 4, 5, 8, 9), (0, 2, 4, 6, 8, 10))
#: Items of fewer words than EQUAL must occur whole; shorter ones than SHORTEST are no evidence.
SHORTEST = 6
#: Words kept around a hit: three before it and twelve after its first.
BEFORE, AROUND = 3, 16

CODES = Codes()


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of the texts one after another, the first place of each text, and its words."""
    found = [WORD.findall(x.lower()) for x in texts]
    sizes = np.array([len(x) for x in found], np.int64)
    codes = np.concatenate([np.zeros(0, np.uint64), *[CODES.of(x, len(x)) for x in found if x]])
    return codes, np.cumsum(sizes) - sizes, sizes


def seeds(codes: np.ndarray, ends: np.ndarray, positions: tuple[int, ...]) -> np.ndarray:
    """Hash of the compared words at every place (0 where the mask reaches beyond the text)."""
    out = np.zeros(len(codes), np.uint64)
    n = len(codes) - positions[-1]
    if n <= 0:
        return out
    with np.errstate(over="ignore"):
        total = np.full(n, len(positions) * 31 + positions[1] if len(positions) > 1 else 1, np.uint64)
        for p in positions:
            total = (total ^ codes[p: p + n]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
    out[:n] = np.where(np.arange(n) + positions[-1] < ends[:n], total | np.uint64(1), 0)
    return out


def context(codes: np.ndarray, at: np.ndarray, first: np.ndarray, end: np.ndarray, filler: int) -> np.ndarray:
    """The words around places; beyond a text's ends a filler that no word equals."""
    spots = at[:, None] + np.arange(-BEFORE, AROUND - BEFORE)[None, :]
    inside = (spots >= first[:, None]) & (spots < end[:, None])
    return np.where(inside, codes[np.clip(spots, 0, max(len(codes) - 1, 0))], np.uint64(filler))


def _hits(codes, first, sizes, masks, chosen):
    """(mask, place, text) of the seeds that `chosen(mask, hashes, text)` keeps."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ends = (first + sizes)[owner]
    for m, positions in masks:
        hashes = seeds(codes, ends, positions)
        at = np.nonzero(chosen(m, hashes, owner) & (hashes != 0))[0]
        if len(at):
            yield m, at, owner[at], hashes[at]


def masks_for(short: tuple[int, ...]) -> list[tuple[int, tuple[int, ...]]]:
    """The fixed masks (0, 1), and a whole run of n words (mask number n) for each short item length."""
    return [*enumerate(MASKS), *[(n, tuple(range(n))) for n in short]]


def _emit(found, ids, extra, codes, first, sizes, filler, names):
    m, at, own, hashes = found
    around = context(codes, at, first[own], (first + sizes)[own], filler).astype(np.uint64).view(np.int64)
    lists = pa.FixedSizeListArray.from_arrays(pa.array(around.ravel()), AROUND).cast(pa.list_(pa.int64()))
    rows = pa.array(own)
    return pa.RecordBatch.from_arrays(
        [ids.take(rows), *[x.take(rows) for x in extra], pa.array((at - first[own]).astype(np.int32)),
         pa.array(np.full(len(at), m, np.int32)), pa.array(hashes.view(np.int64)), lists], names)


def item_seeds(benchmark: DataFrame) -> tuple[DataFrame, DataFrame, tuple[int, ...]]:
    """Distinct (mask, hash, item_words, context) of the benchmark, the items of every context, and the lengths
    of its short items. A context is a seed with the words around it; items that share a passage share it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, first, sizes = coded([x or "" for x in batch.column(1).to_pylist()])
            masks = masks_for(tuple(range(SHORTEST, EQUAL)))

            def chosen(m, hashes, owner, sizes=sizes, first=first):
                if m < len(MASKS):
                    return sizes[owner] >= EQUAL
                return (sizes[owner] == m) & (np.arange(len(owner)) == first[owner])

            for found in _hits(codes, first, sizes, masks, chosen):
                yield _emit(found, batch.column(0), [], codes, first, sizes, 2,
                            ["item_id", "item_word", "mask", "hash", "item_words"])

    rows = benchmark.select("item_id", "text")
    kind = rows.schema["item_id"].dataType.simpleString()
    rows = stored(rows.mapInArrow(
        run, f"item_id {kind}, item_word int, mask int, hash bigint, item_words array<bigint>"
    ).withColumn("context", F.xxhash64("mask", "hash", "item_words")))
    once = stored(rows.select("mask", "hash", "item_words", "context").dropDuplicates(["context"]))
    owners = stored(rows.select("context", "item_id").distinct())
    short = once.where(F.col("mask") >= len(MASKS)).select("mask").distinct().collect()  # at most five
    return once, owners, tuple(sorted(r["mask"] for r in short))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, first_word, last_word, equal_words, windows), a row per document and item.

    Words are runs of letters, digits and underscores, lower-cased. A document holds an item's
    passage if 13 places of it, aligned with 13 of the item, agree in at least 11 words (places
    beyond an end agree with nothing), or if it holds a short item (6 to 10 words) whole. Seeds of
    the documents are tested against a fixed-size set, those that pass are joined with the
    benchmark's by hash, and the words around each hit are compared.

    Null and empty texts, null benchmark texts and items under six words match nothing. Every item that has the
    passage is reported; repeated rows of docs and of the benchmark once. Empty tables give no rows.
    """
    limit_batches(docs.sparkSession)
    once, owners, short = item_seeds(benchmark)
    bits = docs.sparkSession.sparkContext.broadcast(hash_set(once, "hash"))
    masks = masks_for(short)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_only(CODES)
        table = bits.value

        def chosen(m, hashes, owner):
            return in_set(table, hashes)

        for batch in batches:
            for at, texts in slices(batch.column(2)):
                codes, first, sizes = coded(texts)
                ids, keys = (batch.column(k).slice(at, len(texts)) for k in (0, 1))
                for found in _hits(codes, first, sizes, masks, chosen):
                    yield _emit(found, ids, [keys], codes, first, sizes, 4,
                                ["doc_id", "text_key", "word", "mask", "hash", "words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.where(F.col("text").isNotNull()).select(
        "doc_id", text_key(F.col("text")).alias("text_key"), "text"
    ).mapInArrow(run, f"doc_id {kind}, text_key bigint, word int, mask int, hash bigint, words array<bigint>")
    items = sized(once, once.count() * AROUND // 2)
    pair = found.alias("d").join(items.alias("b"), ["mask", "hash"])

    def same(a: int, n: int):
        return sum(
            (F.col("words")[BEFORE + k] == F.col("item_words")[BEFORE + k]).cast("int") for k in range(a, a + n))

    best = F.greatest(*[same(-shift, WINDOW) for shift in range(BEFORE + 1)])
    whole = F.lit(False)
    equal = best
    for n in short:
        whole = whole | ((F.col("mask") == n) & (same(0, n) == n))
        equal = F.when(F.col("mask") == n, n).otherwise(equal)
    held = pair.where(((F.col("mask") < len(MASKS)) & (best >= EQUAL)) | whole)
    # contexts are few beside the documents' words, and what is left of those is what matched
    hits = held.select("doc_id", "text_key", "word", equal.alias("equal"), "context").join(sized(owners, owners.count()), "context")
    return hits.groupBy("doc_id", "text_key", "item_id").agg(
        F.min("word").cast("bigint").alias("first_word"), F.max("word").cast("bigint").alias("last_word"),
        F.max("equal").cast("bigint").alias("equal_words"), F.countDistinct("word").alias("windows"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no passage of the benchmark; columns as given."""
    found = contaminated(docs, benchmark).select("doc_id", "text_key").distinct()
    keyed = packed(docs, "doc_id", text_key(F.col("text")).alias("text_key"))
    return anti(keyed, found, ["doc_id", "text_key"]).select("row.*")
