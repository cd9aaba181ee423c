import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from callstrata.llm import simhash as S
from callstrata.llm.components import components
from tests.llm.helpers import docs, empty, messy, prose, unchanged, words


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [
    None, "", " \n", "One", "A b", "a b c", "É É a\x0bB\x0cc\x1cd e f", prose(3, 30), "x " * 70_000])
def test_fingerprint(text):
    assert S.fingerprint(None if text is None else text.encode(), 3) == plain_fingerprint(text)


def near_numbers(n, spread, seed=1):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64) if rng.random() < 0.3 or not out else rng.choice(sorted(out)[:40])
        for _ in range(rng.randrange(spread)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_links_equal_all_pairs(spark, radius):
    numbers = near_numbers(1_500, 7)
    df = spark.createDataFrame([(int(np.array([x], np.uint64).view(np.int64)[0]),) for x in numbers], "fp bigint")
    signed = [r["fp"] for r in df.collect()]
    wanted = {
        (min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i]
        if bin((a ^ b) & (2**64 - 1)).count("1") <= radius}
    assert wanted
    assert {tuple(r) for r in S.links(df, radius).collect()} == wanted


def test_crowded_values_are_split_without_loss(spark):
    """All fingerprints agree on most bits, so whole partitions hold one value."""
    rng = random.Random(3)
    numbers = sorted({sum(1 << b for b in rng.sample(range(0, 24), 6)) for _ in range(900)})
    df = spark.createDataFrame([(x,) for x in numbers], "fp bigint")
    wanted = {(a, b) for i, b in enumerate(numbers) for a in numbers[:i] if bin(a ^ b).count("1") <= 2}
    assert {tuple(r) for r in S.links(df).collect()} == wanted


def test_thresholds_cover_every_split():
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 2**63, 200).astype(np.uint64)
    blocks = tuple(tuple(range(k * 8, k * 8 + 8)) for k in range(8))
    counts = rng.integers(1, 50, (8, 256))
    for parts in (((0, 1, 2, 3), (4, 5, 6, 7)), ((0, 1, 2), (3, 4, 5), (6, 7))):
        plan = S.Plan(2, 12_800, blocks, counts, parts)
        got, cost = plan.thresholds(fps)
        assert (got.sum(axis=1) == 2 - len(parts) + 1).all() and (got >= -1).all() and (cost > 0).all()


def test_bits_that_move_together_share_a_block():
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 2, (4_000, 64))
    bits[:, [1, 17, 33, 49]] = bits[:, [1]]
    together = (bits.T @ bits).astype(float)
    blocks = S.bit_groups(together, np.diag(together).copy(), len(bits))
    assert sorted(b for block in blocks for b in block) == list(range(64))
    assert any({1, 17, 33, 49} <= set(block) for block in blocks)


def test_components_of_paths_stars_and_cycles(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    df = spark.createDataFrame([*pairs, *pairs[:5]], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    want = groups(pairs, {x for p in pairs for x in p})
    assert got.keys() == want.keys()
    assert len({(got[n], want[n]) for n in want}) == len(set(want.values())) == len(set(got.values()))
    assert components(df.limit(0)).count() == 0


def test_near_duplicates_equal_brute_force(spark):
    base = words(9, 400)
    texts = [" ".join(base[:i] + ["new"] + base[i + 1:]) for i in range(0, 400, 25)] + [prose(i, 5) for i in range(60)]
    rows = [(i * 7 % 101, t) for i, t in enumerate([*texts, texts[0], texts[0], "", None])]
    got = {r["doc_id"]: (r["fp"], r["component_id"]) for r in S.near_duplicates(docs(spark, rows)).collect()}
    fps = {d: plain_fingerprint(t) for d, t in rows}
    pairs = [(a, b) for a in fps for b in fps if bin(fps[a] ^ fps[b]).count("1") <= 2]
    root = groups(pairs, fps)
    least = {r: min(d for d in fps if root[d] == r) for r in root.values()}
    assert {d: (f & (2**64 - 1), c) for d, (f, c) in got.items()} == {d: (fps[d], least[root[d]]) for d in fps}


def test_hot_group_and_messy_rows(spark):
    df = messy(spark)
    found = S.near_duplicates(df)
    assert found.count() == df.count()
    none = found.where("fp = 0")
    assert {r["component_id"] for r in none.collect()} == {1}
    kept = S.keep_one(df)
    unchanged(df, kept)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] in (1, 2, 3, 6, 7)) == [1, 6, 6]
    many = docs(spark, [(i, "same text every time") for i in range(3_000)] + [(5_000 + i, prose(i, 4)) for i in range(300)])
    assert {r["doc_id"] for r in S.keep_one(many).collect()} == {0, *range(5_000, 5_300)}
    assert S.keep_one(empty(spark)).count() == 0 and S.near_duplicates(empty(spark)).count() == 0


def test_same_id_with_other_text_is_another_document(spark):
    df = docs(spark, [(1, prose(1, 5)), (1, prose(1, 5)), (1, prose(2, 5))])
    assert sorted(r["text"] for r in S.keep_one(df).collect()) == sorted([prose(1, 5), prose(2, 5)])
    assert S.keep_one(df.where(F.lit(True))).count() == 2
