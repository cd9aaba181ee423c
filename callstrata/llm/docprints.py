"""Document fingerprints: weighted term hashes vote on signed bits, block tables find all near ones.

DataFrame functions only. A fingerprint is two longs, `a` and `b`: 128 bits.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callstrata.llm.common import anti, hot_join, semi, sized, stored

BITS = 128
#: Documents of a stretch, the unit that is put in order at once, and the most stretches there are.
STRETCH, STRETCHES = 512, 4_096
#: Stretches are cut at documents of a sample of so many per stretch.
SAMPLED = 8
#: A table's value is split further when more fingerprints than this share it.
CROWD = 1_000
_LOW = 0xFFFFFFFF


# ---- fingerprints ----------------------------------------------------------------------------

def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")


def _terms() -> Column:
    """Every word of `words` with the word behind it (none behind the last)."""
    return F.arrays_zip("words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))))


def _votes() -> list[Column]:
    """How many terms set each bit: bits k and k + 32 of a hash are counted in one long."""
    both = F.lit((1 << 32) | 1)
    return [
        F.sum(F.shiftrightunsigned(h, k).bitwiseAND(both)).alias(f"{h}_{k}")
        for h in ("h0", "h1") for k in range(32)
    ] + [F.count("h0").alias("total")]


def _voted(h: str) -> Column:
    """A bit is 1 if the terms that set it outweigh those that clear it."""
    out = F.lit(0).cast("bigint")
    for k in range(32):
        for lane, place in ((F.col(f"{h}_{k}").bitwiseAND(F.lit(_LOW)), k), (F.shiftrightunsigned(f"{h}_{k}", 32), k + 32)):
            value = 1 << place
            out = out.bitwiseOR(F.when(2 * lane > F.col("total"), F.lit(value - (1 << 64) if place == 63 else value)).otherwise(F.lit(0)).cast("bigint"))
    return out


def fingerprinted(texts: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """keys, a and b for every row; rows must differ in keys.

    A term is a word with the word behind it, its weight the times it occurs. Bits of its hash
    vote for 1 or against; texts without words have fingerprint 0. Terms are summed up in the task that
    holds the text: nothing is shuffled if the rows are already partitioned by some of the keys.
    """
    spread = texts.select(*keys, words(F.col(text)).alias("words")).select(*keys, F.explode_outer(_terms()).alias("term"))
    known = F.col("term").isNotNull()
    hashed = spread.select(*keys, *[
        F.when(known, F.xxhash64(F.lit(i), "term.words", "term.1")).alias(f"h{i}") for i in range(2)])
    return hashed.groupBy(*keys).agg(*_votes()).select(*keys, _voted("h0").alias("a"), _voted("h1").alias("b"))


def likeness(x: tuple[str, str], y: tuple[str, str]) -> Column:
    """The share of equal bits."""
    apart = sum(F.bit_count(F.col(p).bitwiseXOR(F.col(q))) for p, q in zip(x, y, strict=True))
    return 1.0 - apart.cast("double") / BITS


def spelled(a: str, b: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


# ---- neighbours in order ---------------------------------------------------------------------

def _cuts(keys: DataFrame, total: int) -> Column | None:
    """Documents at which stretches begin, descending, in runs of 64; None if one stretch holds all."""
    stretches = min(STRETCHES, total // STRETCH)
    if stretches < 2:
        return None
    share = int(min(1.0, stretches * SAMPLED / total) * (1 << 30))
    sample = keys.where(F.pmod(F.xxhash64("doc_id", "key", F.lit(3)), F.lit(1 << 30)) < share)
    rows = sample.select("doc_id", "key").orderBy(F.desc("doc_id"), F.desc("key")).collect()  # some 8 x 4,096 at most
    cuts = [tuple(r) for r in rows[SAMPLED - 1::SAMPLED]]
    if not cuts:
        return None
    kind = keys.schema["doc_id"].dataType.simpleString()
    nested = [cuts[k:k + 64] for k in range(0, len(cuts), 64)]
    return keys.sparkSession.createDataFrame(
        [(nested,)], f"cuts array<array<struct<doc_id:{kind},key:bigint>>>").scalar()


def _in_stretches(rows: DataFrame, cuts: Column | None) -> DataFrame:
    """rows with `home`, the number of cuts that do not lie behind a document, in descending order of (doc_id, key)."""
    if cuts is None:
        return rows.withColumn("home", F.lit(0))
    own, runs = F.struct("doc_id", "key"), F.col("cuts")
    run = F.size(F.filter(runs, lambda c: c[0] >= own))
    home = F.when(run == 0, 0).otherwise((run - 1) * 64 + F.size(F.filter(F.get(runs, run - 1), lambda c: c >= own)))
    return rows.withColumn("cuts", cuts).withColumn("home", home).drop("cuts")


def with_next(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """texts (doc_id, key, text) with stretch, guest and next_text, the text of the next document in
    descending order of (doc_id, key), of the first after the last.

    Rows must differ in (doc_id, key); keys lists them. Documents are dealt into stretches of that
    order, and the first of each stretch also visits the stretch before it (guest 1), so that every
    text is shuffled once and no stretch grows with the table beyond a 4,096th.
    """
    total = keys.count()
    cuts = _cuts(keys, total)
    first = sorted(
        (r["home"], r["own"]) for r in _in_stretches(keys, cuts).groupBy("home").agg(
            F.max(F.struct("doc_id", "key")).alias("own")).collect())  # one row per stretch
    kind = keys.schema["doc_id"].dataType.simpleString()
    visits = keys.sparkSession.createDataFrame(
        [(own["doc_id"], own["key"], first[k - 1][0]) for k, (_, own) in enumerate(first)],
        f"first_id {kind}, first_key bigint, visited int")
    dealt = _in_stretches(texts, cuts).join(
        F.broadcast(visits), F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key")), "left")
    home = F.struct(F.lit(0).alias("guest"), F.col("home").alias("stretch"))
    away = F.struct(F.lit(1).alias("guest"), F.col("visited").alias("stretch"))
    placed = dealt.select(
        "doc_id", "key", "text",
        F.explode(F.when(F.col("visited").isNull(), F.array(home)).otherwise(F.array(home, away))).alias("at"),
    ).select("doc_id", "key", "text", "at.guest", "at.stretch")
    return placed.withColumn("next_text", F.lead("text").over(_in_order()))


def _in_order():
    return W.partitionBy("stretch").orderBy("guest", F.desc("doc_id"), F.desc("key"))


# ---- near fingerprints -----------------------------------------------------------------------

def _mask(bits: list[int]) -> tuple[int, int]:
    """Of bits numbered through both longs the mask of each, as signed numbers."""
    masks = [sum(1 << (b - 64 * half) for b in bits if b // 64 == half) for half in (0, 1)]
    return tuple(m - (1 << 64) if m >> 63 else m for m in masks)


def tables(radius: int) -> tuple[list[tuple[int, int]], list[list[tuple[int, int]]]]:
    """Masks of the tables, and of their finer ones.

    The bits are cut into radius + 2 blocks. Fingerprints within the radius differ in at most `radius`
    blocks, so they agree on two whole blocks: every pair of blocks, moved to the front, is a table.
    The other bits are cut into radius + 1 slices, on one of which they agree as well.
    """
    blocks = [list(map(int, x)) for x in np.array_split(np.arange(BITS), radius + 2)]
    coarse, fine = [], []
    for pair in combinations(range(len(blocks)), 2):
        front = [b for k in pair for b in blocks[k]]
        rest = [b for k, block in enumerate(blocks) if k not in pair for b in block]
        coarse.append(_mask(front))
        fine.append([_mask(front + list(map(int, s))) for s in np.array_split(rest, radius + 1)])
    return coarse, fine


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b, a2, b2): all pairs of different fingerprints that differ in at most `radius` bits, each once.

    `distinct` has one row per fingerprint. Every fingerprint stands in every table under the bits that
    come first there. A value that more than CROWD fingerprints share is replaced by the values of
    its finer tables; this changes which pairs are compared, never which are found.
    """
    coarse, fine = tables(radius)

    def cut(table: int, masks: tuple[int, int]) -> Column:
        x, y = (F.col(c).bitwiseAND(F.lit(m)) for c, m in zip("ab", masks, strict=True))
        return F.struct(F.lit(table).alias("t"), x.alias("x"), y.alias("y"))

    every = distinct.select("a", "b", F.explode(F.array(*[cut(t, m) for t, m in enumerate(coarse)])).alias("at"))
    crowded = stored(every.groupBy("at").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).select(
        F.col("at").alias("full")))
    marked = every.join(sized(crowded, crowded.count()), F.col("at") == F.col("full"), "left")
    finer = F.lit(None)
    for t, masks in enumerate(fine):
        own = F.array(*[cut(len(coarse) + t * len(masks) + s, m) for s, m in enumerate(masks)])
        finer = F.when(F.col("at.t") == t, own).otherwise(finer)
    keyed = marked.select("a", "b", F.explode(F.when(F.col("full").isNull(), F.array("at")).otherwise(finer)).alias("at")).select("a", "b", "at.*")
    other = keyed.select(*[F.col(c).alias(f"{c}2") for c in keyed.columns])
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("a2"))) + F.bit_count(F.col("b").bitwiseXOR(F.col("b2")))
    before = (F.col("a") < F.col("a2")) | ((F.col("a") == F.col("a2")) & (F.col("b") < F.col("b2")))
    return keyed.join(
        other, (F.col("t") == F.col("t2")) & (F.col("x") == F.col("x2")) & (F.col("y") == F.col("y2")) & before & (apart <= radius)
    ).select("a", "b", "a2", "b2").distinct()


def classes(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b, n, class_id, links): every fingerprint with its documents' number and smallest doc_id, and
    the number of other fingerprints within the radius."""
    groups = stored(prints.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("class_id")))
    near = stored(links(groups.select("a", "b"), radius))
    ends = near.select("a", "b").unionByName(near.select(F.col("a2").alias("a"), F.col("b2").alias("b")))
    counted = ends.groupBy("a", "b").agg(F.count(F.lit(1)).alias("links"))
    return groups.join(counted, ["a", "b"], "left").withColumn("links", F.coalesce("links", F.lit(0).cast("bigint")))


def _once(texts: DataFrame, again: DataFrame) -> DataFrame:
    """texts with one row of every repeated (doc_id, key)."""
    if again.isEmpty():
        return texts
    repeated = semi(texts, again, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"])
    return anti(texts, again, ["doc_id", "key"]).unionByName(repeated)


def edited_likeness(docs: DataFrame, radius: int = 3) -> DataFrame:
    """A row per row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, class_id, links.

    The edited text has the last third of its code points (rounded down) replaced by as many first ones of
    the next document, or all it has; the next is the next lower doc_id, that of the highest after
    the lowest. Likeness is the share of equal bits. class_id is the smallest doc_id with the same
    fingerprint, links the number of other fingerprints within `radius` bits.

    Null texts are empty; null ids come last. Documents of one id are ordered by a hash of their text;
    equal rows are one document, whose result each of them gets. One document is followed by itself. No
    rows give no rows. Only doc_id and text are read.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    keys = stored(texts.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")))
    again = stored(keys.where("n > 1"))
    ordered = with_next(_once(texts, again.select("doc_id", "key")), keys)
    ordered = ordered.withColumn("n_chars", F.length("text").cast("bigint"))
    kept, given = "n_chars - n_chars div 3", "n_chars div 3"
    edited = F.concat(F.expr(f"substring(text, 1, CAST({kept} AS INT))"), F.expr(f"substring(next_text, 1, CAST({given} AS INT))"))
    both = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text"), F.lit(None).cast("binary").alias("sha")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"), F.unhex(F.sha2("edited", 256)).alias("sha")))
    kinds = ordered.withColumn("edited", edited).select(
        "stretch", "guest", "doc_id", "key", "n_chars", F.explode(both).alias("k")
    ).where("guest = 0 OR k.kind = 0").select("stretch", "guest", "doc_id", "key", "n_chars", "k.*")
    place = ["stretch", "guest", "doc_id", "key", "n_chars"]
    prints = fingerprinted(kinds, "text", [*place, "kind", "sha"])

    def of(kind: int, column: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    paired = prints.groupBy(*place).agg(
        of(0, "a").alias("a"), of(0, "b").alias("b"), of(1, "a").alias("edited_a"), of(1, "b").alias("edited_b"),
        F.max("sha").alias("sha"))
    followed = paired.withColumns({f"next_{c}": F.lead(c).over(_in_order()) for c in "ab"}).where("guest = 0")
    rows = stored(followed.select("doc_id", "key", "n_chars", "sha", "a", "b", "edited_a", "edited_b", "next_a", "next_b"))
    if not again.isEmpty():  # equal rows get equal results
        side = again.select(F.col("doc_id").alias("id"), F.col("key").alias("of"), "n")
        rows = rows.join(sized(side, side.count()), rows["doc_id"].eqNullSafe(side["id"]) & (rows["key"] == side["of"]), "left").withColumn(
            "copy", F.explode(F.sequence(F.lit(1), F.coalesce("n", F.lit(1))))).drop("id", "of", "n", "copy")
    own = F.struct("doc_id", "key")
    return hot_join(rows, stored(classes(rows, radius)), ["a", "b"], "n", own).select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), spelled("a", "b").alias("fingerprint"),
        spelled("edited_a", "edited_b").alias("edited_fingerprint"),
        likeness(("a", "b"), ("edited_a", "edited_b")).alias("near_edited"),
        likeness(("a", "b"), ("next_a", "next_b")).alias("near_next"), "class_id", "links")
