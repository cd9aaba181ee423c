"""Helpers shared by the corpus operators: row keys, joins that survive hot keys, stored tables, word codes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.session import cut_lineage as stored

__all__ = ["STORES", "Codes", "anti", "empty_as_blank", "hash_set", "hot_join", "in_set", "limit_batches", "mixed", "packed", "remember_only", "semi", "sized", "slices", "stored", "table", "text_key"]

#: A side of two or three numbers per row may be broadcast up to so many rows (some 30 MB in a task).
BROADCAST_ROWS = 250_000
#: A key is hot when it holds more than this share of all rows, so at most 1,000 keys are hot.
HOT_SHARE = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def empty_as_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def text_key(text: Column) -> Column:
    """Tells rows of one document id apart; equal rows are the same document."""
    return F.xxhash64(text)


def packed(docs: DataFrame, *more: Column | str) -> DataFrame:
    """Whole rows in one column `row`, so that their columns' names meet no others; select("row.*") gives them back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *more)


def sized(keys: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast only if its counted rows are within the bound."""
    return F.broadcast(keys) if rows <= BROADCAST_ROWS else keys


def _matched(docs: DataFrame, keys: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    renamed = keys.select(*[F.col(c).alias(f"__k_{i}") for i, c in enumerate(on)])
    renamed = stored(renamed)
    side = sized(renamed, renamed.count())
    same = [docs[c].eqNullSafe(side[f"__k_{i}"]) for i, c in enumerate(on)]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return docs.join(side, condition, how)


def semi(docs: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key (nulls equal) is listed; the list is broadcast if small, else both sides shuffle."""
    return _matched(docs, keys, on, "left_semi")


def anti(docs: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return _matched(docs, keys, on, "left_anti")


def hot_join(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], count: str, spread: Column, merge: bool = False
) -> DataFrame:
    """Left join rows to groups (unique, non-null keys; `count` = rows of the key), hot keys apart.

    Keys with more than a thousandth of all rows number below a thousand: they are broadcast, and
    their rows carry a salt that spreads them over the shuffle of the rest instead of piling up.
    With `merge` the rest is joined by sorting at every size; else the optimizer may choose.
    """
    values = [c for c in groups.columns if c not in (*keys, count)]
    total = groups.agg(F.sum(count).alias("n")).first()["n"] or 0
    limit = max(1_000, total // HOT_SHARE)

    def side(prefix: str, part: DataFrame) -> DataFrame:
        return part.select(
            *[F.col(k).alias(f"__{prefix}_key_{k}") for k in keys], F.lit(0).alias(f"__{prefix}"),
            *[F.col(c).alias(f"__{prefix}_{c}") for c in values])

    def same(prefix: str) -> Column:
        condition = F.lit(True)
        for k in keys:
            condition = condition & (F.col(k) == F.col(f"__{prefix}_key_{k}"))
        return condition

    hot = side("hot", groups.where(F.col(count) > limit))
    cold = side("cold", groups.where(F.col(count) <= limit))
    cold = cold.hint("merge") if merge else cold
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    marked = rows.join(F.broadcast(hot), same("hot"), "left").withColumn(
        "__salt",
        F.when(F.col("__hot").isNull() & known, 0)  # a null key matches nothing and is spread as well
        .otherwise((F.pmod(F.xxhash64(spread), F.lit(4096)) + 1).cast("int")),
    )
    joined = marked.join(cold, same("cold") & (F.col("__salt") == F.col("__cold")), "left")
    return joined.select(
        *[rows[c] for c in rows.columns],
        *[F.coalesce(F.col(f"__hot_{c}"), F.col(f"__cold_{c}")).alias(c) for c in values],
    )


#: Bits of a set of hashes that is sent to every task (8 MB).
SET_BITS = 26


def hash_set(rows: DataFrame, column: str) -> np.ndarray:
    """A set of 64-bit hashes by their upper bits: 8 MB, however many there are. Members are always
    found; of others a share, small while members are few beside 2^26, is found as well."""
    spot = F.shiftrightunsigned(column, 64 - SET_BITS)
    words = rows.select(F.shiftright(spot, 6).alias("word"), F.pmod(spot, F.lit(64)).cast("int").alias("bit")).groupBy(
        "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    out = np.zeros(1 << (SET_BITS - 6), np.int64)
    for row in words.toLocalIterator():  # at most 2^20 numbers
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def in_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    spot = hashes >> np.uint64(64 - SET_BITS)
    return (table[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def limit_batches(spark: SparkSession) -> None:
    """Let an Arrow batch hold 8 MB instead of 64, as texts are long; a limit the session sets itself stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("64m", "67108864", "67108864b"):
        spark.conf.set(key, str(8 << 20))


def slices(column: pa.Array, size: int = 1_000_000) -> Iterator[tuple[int, list]]:
    """Texts of a column a bounded number of bytes at a time (one text at least), with the place of the first."""
    total = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + size, side="right")))
        yield at, column.slice(at, end - at).to_pylist()
        at = end


#: All stores of words of this Python process.
STORES: list = []
#: Gives freed memory back to the system, where the C library can.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def remember_only(*stores) -> None:
    """Empty all other stores of words in this Python worker, which serves one task after another, and give
    the memory back that earlier tasks have left."""
    for store in STORES:
        if not any(store is x for x in stores):
            store.clear()
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


class Codes(dict):
    """Number of a word, remembered up to a bound; the number depends on the word alone."""

    bound = 120_000

    def __init__(self):
        super().__init__()
        STORES.append(self)

    def __missing__(self, word: str) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = self.number(word)
        return value

    def number(self, word: str) -> int:
        return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) | 1

    def of(self, words: Iterable[str], n: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=n)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (finaliser of a public-domain mixing function)."""
    with np.errstate(over="ignore"):
        v = values ^ (values >> np.uint64(33))
        v = v * np.uint64(0xFF51AFD7ED558CCD)
        v ^= v >> np.uint64(33)
        v = v * np.uint64(0xC4CEB9FE1A85EC53)
        return v ^ (v >> np.uint64(33))
