"""SimHash near-duplicates, searched by the generalised pigeonhole principle."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import anti, hot_join, limit_batches, packed, remember_only, semi, slices, stored, text_key
from callstrata.llm.components import components

BITS = 64
BLOCK = 8
#: Fingerprints looked at to compare numbers of partitions.
SAMPLE = 4_096
#: Buckets counted to find crowded partition values.
CROWD = 1 << 20


def fingerprint(data: bytes | None, width: int) -> int:
    """Majority of the XXH64 (seed 42) bits over all word shingles of a text; no words give 0.

    A-Z are lower-cased and words end at bytes 09-0D and 20, which is what bytes.lower and
    bytes.split do.
    """
    words = (data or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: 1 - width].tolist(), ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 65_536):
        hashes = np.array(
            [digest(joined[s:e], 42) for s, e in zip(starts[at:at + 65_536], ends[at:at + 65_536], strict=True)],
            dtype="<u8",
        )
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, text_key, fp) of every row; fp is the unsigned fingerprint's bits in a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_only()
        for batch in batches:
            found = np.array(
                [fingerprint(x, width) for _, part in slices(batch.column(2)) for x in part], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                ["doc_id", "text_key", "fp"])

    limit_batches(docs.sparkSession)
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.col("text").cast("binary"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key bigint, fp bigint")


# ---- the search plan -------------------------------------------------------------------------

def bit_groups(together: np.ndarray, ones: np.ndarray, n: int) -> list[list[int]]:
    """Eight blocks of eight bits, each bit placed with those it is most correlated with."""
    p = ones / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    like = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(like, 0)
    left, blocks = set(range(BITS)), []
    while left:
        seed = max(sorted(left), key=lambda b: like[b, sorted(left)].sum())
        block = [seed]
        left.remove(seed)
        while len(block) < BLOCK:
            best = max(sorted(left), key=lambda b: like[b, block].sum())
            block.append(best)
            left.remove(best)
        blocks.append(sorted(block))
    return blocks


@dataclass(frozen=True)
class Plan:
    """Blocks of correlated bits, how many rows hold each block value, and the partitions made of blocks."""

    radius: int
    n: int
    blocks: tuple[tuple[int, ...], ...]
    counts: np.ndarray
    parts: tuple[tuple[int, ...], ...]

    def masks(self) -> list[int]:
        return [sum(1 << b for k in part for b in self.blocks[k]) for part in self.parts]

    def thresholds(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per fingerprint the threshold of each partition (-1: not probed) and the cost expected.

        Two fingerprints within `radius` bits differ by at most t_i bits in some partition i if
        the thresholds sum to radius - parts + 1. A dynamic programme over the partitions picks
        the sum's cheapest split, counting signatures enumerated and candidates expected.
        """
        r, masks = self.radius, self.masks()
        distance = np.array([bin(x).count("1") for x in range(256)])[np.arange(256)[:, None] ^ np.arange(256)]
        spread = np.stack([(distance == d) @ self.counts.T.astype(float) for d in range(r + 1)])  # d, value, block
        spread /= max(self.n, 1)
        values = np.stack([block_values(fps, b) for b in self.blocks], axis=1)
        cost = np.zeros((len(self.parts), r + 2, len(fps)))
        for i, part in enumerate(self.parts):
            mass = np.zeros((r + 1, len(fps)))
            mass[0] = 1
            for k in part:
                own = spread[:, values[:, k], k]
                mass = np.stack([sum(mass[d - e] * own[e] for e in range(d + 1)) for d in range(r + 1)])
            width = bin(masks[i]).count("1")
            for t in range(r + 1):
                cost[i, t + 1] = sum(comb(width, d) for d in range(t + 1)) + self.n * mass[: t + 1].sum(axis=0)
        best = np.full((len(self.parts) + 1, r + 2, len(fps)), np.inf)
        best[0, 0] = 0
        choice = np.zeros((len(self.parts), r + 2, len(fps)), np.int64)
        for i in range(len(self.parts)):
            for total in range(r + 2):
                options = np.stack([best[i, total - u] + cost[i, u] for u in range(total + 1)])
                choice[i, total] = options.argmin(axis=0)
                best[i + 1, total] = options.min(axis=0)
        rest = np.full(len(fps), r + 1)
        out = np.zeros((len(fps), len(self.parts)), np.int64)
        for i in reversed(range(len(self.parts))):
            picked = choice[i, rest, np.arange(len(fps))]
            out[:, i] = picked - 1
            rest = rest - picked
        return out, best[-1, r + 1]


def block_values(fps: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for k, b in enumerate(bits):
        out |= (((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)).astype(np.int64)
    return out


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    def run(batches):
        n, total = 0, np.zeros((BITS, BITS))
        for batch in batches:
            fps = _unsigned(batch.column(0))
            bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.astype(np.float32).T @ bits.astype(np.float32)
            n += len(fps)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, -1)), pa.array(np.append(j, -1)),
             pa.array(np.append(total[i, j], n).astype(np.int64))], ["i", "j", "n"])

    rows = distinct.select("fp").mapInArrow(run, "i bigint, j bigint, n bigint").groupBy("i", "j").agg(
        F.sum("n").alias("n")).collect()  # at most 64 x 64 + 1 rows
    together, n = np.zeros((BITS, BITS)), 0
    for row in rows:
        if row["i"] < 0:
            n = row["n"]
        else:
            together[row["i"], row["j"]] = row["n"]
    return n, together


def make_plan(distinct: DataFrame, radius: int) -> Plan:
    """Statistics over all distinct fingerprints: 64 x 64 pair counts, then 8 x 256 block values."""
    n, together = _statistics(distinct)
    blocks = tuple(tuple(b) for b in bit_groups(together, np.diag(together).copy(), n))

    def run(batches):
        total = np.zeros((len(blocks), 256), np.int64)
        for batch in batches:
            fps = _unsigned(batch.column(0))
            for k, block in enumerate(blocks):
                total[k] += np.bincount(block_values(fps, block), minlength=256)
        k, v = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(v), pa.array(total[k, v])], ["k", "v", "n"])

    counts = np.zeros((len(blocks), 256), np.int64)
    for row in distinct.select("fp").mapInArrow(run, "k bigint, v bigint, n bigint").groupBy("k", "v").agg(
            F.sum("n").alias("n")).collect():  # at most 8 x 256 rows
        counts[row["k"], row["v"]] = row["n"]
    sample = [x["fp"] for x in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    fps = np.array(sample, np.int64).view(np.uint64)
    plans = [
        Plan(radius, n, blocks, counts, tuple(tuple(int(x) for x in g) for g in np.array_split(np.arange(len(blocks)), m)))
        for m in range(2, min(radius + 3, len(blocks)) + 1)
    ]
    return min(plans, key=lambda plan: plan.thresholds(fps)[1].sum())


# ---- links and groups ------------------------------------------------------------------------

def _bucket(part: int, keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((keys + np.uint64(part + 1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(BITS - 20)


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs (a, b), a below b, of fingerprints that differ in at most `radius` bits.

    `distinct` has one row per fingerprint (column fp). Every fingerprint is indexed once per
    partition; it probes the signatures within its own thresholds. A partition value shared by
    many fingerprints is split further: what agrees there and lies within the radius must also
    agree on one of radius + 1 slices of the other bits, so crowded values are matched by value
    and slice. That changes which pairs meet as candidates, never which links are found.
    """
    distinct = distinct.select("fp")
    plan = make_plan(distinct, radius)
    masks, every = plan.masks(), (1 << BITS) - 1
    slices = []
    for mask in masks:
        rest = [b for block in plan.blocks for b in block if not mask >> b & 1]
        slices.append([sum(1 << int(b) for b in s) for s in np.array_split(rest, radius + 1)])

    def crowds(batches):
        total = np.zeros(CROWD, np.int64)
        for batch in batches:
            fps = _unsigned(batch.column(0))
            for i, mask in enumerate(masks):
                total += np.bincount(_bucket(i, fps & np.uint64(mask)).astype(np.int64), minlength=CROWD)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    limit = max(128, 8 * len(masks) * plan.n // CROWD)  # so at most an eighth of the buckets
    crowded = np.zeros(CROWD, bool)
    for row in distinct.mapInArrow(crowds, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).where(
            F.col("n") > limit).select("at").collect():
        crowded[row["at"]] = True
    crowded_bits = np.packbits(crowded)

    def keyed(part: int, keys: np.ndarray, fps: np.ndarray):
        """(kind, key, fp) of matching keys; crowded values once per slice."""
        many = np.unpackbits(crowded_bits)[_bucket(part, keys).astype(np.int64)].astype(bool)
        yield np.full((~many).sum(), part * 64), keys[~many], fps[~many]
        for s, mask in enumerate(slices[part]):
            yield np.full(many.sum(), part * 64 + 1 + s), keys[many] | (fps[many] & np.uint64(mask)), fps[many]

    def batch_of(found, name):
        kind, key, fp = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(key.astype(np.uint64).view(np.int64)),
             pa.array(fp.astype(np.uint64).view(np.int64))], ["kind", "key", name])

    def index(batches):
        for batch in batches:
            fps = _unsigned(batch.column(0))
            yield batch_of([x for i, mask in enumerate(masks) for x in keyed(i, fps & np.uint64(mask), fps)], "y")

    def probes(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2_048):
                fps = _unsigned(batch.column(0).slice(at, 2_048))
                wanted, _ = plan.thresholds(fps)
                found = []
                for i, mask in enumerate(masks):
                    bits = [1 << b for b in range(BITS) if mask >> b & 1]
                    for t in range(radius + 1):
                        own = fps[wanted[:, i] >= t]
                        if len(own):
                            for flips in combinations(bits, t):
                                found += keyed(i, (own ^ np.uint64(sum(flips) & every)) & np.uint64(mask), own)
                if found:
                    yield batch_of(found, "x")

    indexed = distinct.mapInArrow(index, "kind int, key bigint, y bigint")
    probed = distinct.mapInArrow(probes, "kind int, key bigint, x bigint")
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= radius
    pairs = probed.alias("p").join(
        indexed.alias("i"),
        (F.col("p.kind") == F.col("i.kind")) & (F.col("p.key") == F.col("i.key")) & (F.col("x") != F.col("y")) & near,
    )
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of docs: doc_id, text_key, fp, component_id, keeps.

    Texts are compared by 64-bit SimHash over shingles of `width` words; fingerprints within
    `radius` bits are linked and groups are what links reach. component_id is the smallest
    doc_id of the group (null only if it has no other). `keeps` marks the rows of the group's
    first document (smallest doc_id, nulls last, then smallest text_key).

    Null and wordless texts have fingerprint 0 and are linked like any other. Repeated rows have
    equal results. No rows give no rows. Only doc_id and text are read. Equal fingerprints are
    counted before they are shuffled and searched once, however many documents share them.
    """
    rows = stored(fingerprints(docs, width))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    groups = stored(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first")))
    roots = components(links(groups, radius)).select(F.col("node").alias("fp"), "root")
    member = stored(
        groups.join(roots, "fp", "left").select("fp", "n", "first", F.coalesce("root", "fp").alias("root"))
    )
    leaders = member.groupBy("root").agg(F.min("first").alias("lead"))
    known = stored(member.join(leaders, "root").select("fp", "n", "lead"))
    return hot_join(rows, known, ["fp"], "n", F.col("doc_id")).select(
        "doc_id", "text_key", "fp", F.col("lead.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("text_key") == F.col("lead.text_key"))).alias("keeps"),
    )


def keep_one(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """Documents without all but one row of each near-duplicate group; columns as given."""
    return keep_first(docs, stored(near_duplicates(docs, width, radius)))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents that `found` (doc_id, text_key, keeps) marks, one row each; columns as given."""
    keyed = packed(docs, "doc_id", text_key(F.col("text")).alias("text_key"))
    drop = found.where(~F.col("keeps")).select("doc_id", "text_key").distinct()
    kept = anti(keyed, drop, ["doc_id", "text_key"])
    again = found.where("keeps").groupBy("doc_id", "text_key").count().where("count > 1")
    if again.isEmpty():
        return kept.select("row.*")
    again = again.select("doc_id", "text_key")
    single = anti(kept, again, ["doc_id", "text_key"])
    repeated = semi(kept, again, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    return single.unionByName(repeated).select("row.*")
