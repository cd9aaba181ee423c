"""Quality score: logistic regression over hashed word n-grams, fitted with FTRL-proximal updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import Codes, empty_as_blank, limit_batches, mixed, packed, remember_only, slices, stored

WORD = regex.compile(r"\w+|[^\w\s]+")
BITS = 18


@dataclass(frozen=True)
class Settings:
    """sample_rows bounds the labelled rows the model is fitted on (both classes by the same share)."""

    sample_rows: int = 16_000
    shards: int = 8
    rounds: int = 3
    passes: int = 2
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 1e-3
    scale: float = 24.0
    accept: float = 0.7


class Shaped(Codes):
    """A word's number; the low four bits say how it is written."""

    def number(self, word: str) -> int:
        lower = word.lower()
        if not (word[0].isalnum() or word[0] == "_"):
            shape = 1 + min(len(word), 3)
        elif word.isdigit():
            shape = 5
        elif word == lower:
            shape = 6 + (len(word) > 2) + (len(word) > 12)
        elif word.isupper():
            shape = 9 + (len(word) > 1)
        elif word[1:] == lower[1:]:
            shape = 11
        else:
            shape = 12
        return super().number(lower) >> 4 << 4 | shape


CODES = Shaped()
REPEATED = np.uint64(13)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, the text each belongs to, and n-grams per text.

    Words, pairs of words, and runs of three writing shapes (a word equal to its predecessor has
    a shape of its own), each hashed to one of 2^18 buckets.
    """
    found = [WORD.findall(x) for x in texts]
    sizes = np.array([len(x) for x in found], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    if not len(owner):
        return np.zeros(0, np.int64), owner, np.zeros(len(texts), np.int64)
    codes = np.concatenate([CODES.of(x, len(x)) for x in found if x])
    shape = codes & np.uint64(15)
    with np.errstate(over="ignore"):
        follows = owner[1:] == owner[:-1]
        shape[1:][follows & (codes[1:] == codes[:-1])] = REPEATED
        pair = mixed(codes[:-1] * np.uint64(3) + mixed(codes[1:]))[follows]
        three = shape[:-2] * np.uint64(256) + shape[1:-1] * np.uint64(16) + shape[2:]
        inside = owner[2:] == owner[:-2]
        three = mixed(three[inside] + np.uint64(1 << 40))
        hashes = np.concatenate([mixed(codes), pair, three])
    owners = np.concatenate([owner, owner[1:][follows], owner[2:][inside]])
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64), owners, np.bincount(owners, minlength=len(texts))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4 (null id: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _features(rows: DataFrame) -> DataFrame:
    """(shard order, label, buckets, values) of labelled texts; values are scaled shares of the n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_only(CODES)
        for batch in batches:
            out = []
            for text in (x for _, part in slices(batch.column(2)) for x in part):
                ids, _, n = grams([text])
                at, times = np.unique(ids, return_counts=True)
                out.append((at.astype(np.int32), (times / max(n[0], 1)).astype(np.float32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a for a, _ in out], pa.list_(pa.int32())),
                 pa.array([v for _, v in out], pa.list_(pa.float32()))], ["place", "label", "at", "share"])

    return rows.mapInArrow(run, "place bigint, label int, at array<int>, share array<float>")


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """A bounded share of the labelled documents that are not held out: (place, label, text).

    Labels without id, without value or that contradict each other for one id are left out. The
    share is drawn by a hash of the id, so it is the same on every run.
    """
    known = stored(
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
        .where("label = other").select("doc_id", F.col("label").cast("int").alias("label"),
                                       F.xxhash64("doc_id", F.lit(7)).alias("place"))
    )
    share = min(1.0, settings.sample_rows / max(1, known.count()))
    limit = int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1
    picked = known.where(F.col("place") <= F.lit(limit)).withColumnRenamed("doc_id", "__id")
    texts = docs.select(F.col("doc_id").alias("__doc"), empty_as_blank(F.col("text")).alias("__text"))
    return texts.join(F.broadcast(picked), F.col("__doc") == F.col("__id")).select(
        "place", "label", F.col("__text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Weights of the buckets, the last one the intercept; zeros where nothing was learned.

    Shards run the updates on their rows side by side, then their states are averaged and the next
    round starts from the average. A state has a fixed size, the sample a documented bound, so what
    reaches the driver does not grow with the corpus.
    """
    limit_batches(docs.sparkSession)
    rows = stored(_features(training_rows(docs, labels, settings)).withColumn(
        "shard", F.pmod(F.xxhash64("place"), F.lit(settings.shards))))
    size = (1 << BITS) + 1
    z, n = np.zeros(size, np.float32), np.zeros(size, np.float32)
    for _ in range(settings.rounds):
        states = rows.groupBy("shard").applyInPandas(_shard(z, n, settings), "z binary, n binary").collect()
        if not states:
            break
        z = np.mean([np.frombuffer(s["z"], np.float32) for s in states], axis=0)
        n = np.mean([np.frombuffer(s["n"], np.float32) for s in states], axis=0)
    return _weights(z, n, settings)


def _weights(z, n, settings):
    shrunk = np.sign(z) * np.maximum(np.abs(z) - settings.l1, 0)
    return (-shrunk / ((settings.beta + np.sqrt(n)) / settings.alpha + settings.l2)).astype(np.float32)


def _shard(z0, n0, s: Settings):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        z, n = z0.astype(np.float64), n0.astype(np.float64)
        rows = rows.sort_values(["place", "label"])
        last = len(z) - 1
        examples = [
            (np.append(at, last), np.append(np.asarray(share, np.float64) * s.scale, 1.0), label)
            for at, share, label in zip(rows["at"], rows["share"], rows["label"], strict=True)
        ]
        for _ in range(s.passes):
            for at, x, label in examples:
                zi, ni = z[at], n[at]
                root = np.sqrt(ni)
                w = -(np.sign(zi) * np.maximum(np.abs(zi) - s.l1, 0)) / ((s.beta + root) / s.alpha + s.l2)
                p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
                g = (p - label) * x
                step = (np.sqrt(ni + g * g) - root) / s.alpha
                z[at] = zi + g - step * w
                n[at] = ni + g * g
        return pd.DataFrame({"z": [z.astype(np.float32).tobytes()], "n": [n.astype(np.float32).tobytes()]})

    return run


def score(docs: DataFrame, weights: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """docs with __score, the chance of label 1: a sparse dot product of n-gram shares and weights.

    Null and empty texts get the intercept's score; with nothing learned every score is 0.5.
    Repeated rows score alike; no rows give no rows; other columns pass unchanged.
    """
    limit_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # fixed size, one megabyte

    @F.arrow_udf("double")
    def scores(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        remember_only(CODES)
        w = shared.value
        for column in parts:
            out = np.empty(len(column))
            for at, texts in slices(column):
                ids, owner, n = grams([x or "" for x in texts])
                total = np.bincount(owner, weights=w[ids], minlength=len(texts))
                out[at: at + len(texts)] = total * settings.scale / np.maximum(n, 1) + w[-1]
            yield pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return docs.withColumn("__score", scores(F.col("text")))


def accepted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents the fitted model accepts, with the columns given.

    With nothing to learn from, no document can be judged and all are kept.
    """
    weights = fit(docs, labels, settings)
    if not weights.any():
        return docs
    scored = score(packed(docs, "text"), weights, settings)
    return scored.where(F.col("__score") >= settings.accept).select("row.*")
