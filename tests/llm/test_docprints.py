import hashlib
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from callstrata.llm import docprints as H
from tests.helpers import plan
from tests.llm.helpers import docs, empty, messy, prose, words


def apart(x, y):
    return bin(int(x, 16) ^ int(y, 16)).count("1")


def check(df):
    """Every row against the definition, from the texts; likeness and links from the fingerprints."""
    rows = df.select("doc_id", "text").distinct().collect()
    got = H.edited_likeness(df).collect()
    assert len(got) == df.count()
    by = {(r["doc_id"], r["n_chars"], r["edited_sha256"]): r for r in got}
    ordered = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text")).distinct().orderBy(
        F.desc("doc_id"), F.desc("key")).collect()
    texts = [r["text"] for r in ordered]
    found = []
    for i, r in enumerate(ordered):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        found.append(by[r["doc_id"], len(text), hashlib.sha256(edited.encode()).hexdigest()])
    for i, r in enumerate(found):
        assert r["near_edited"] == 1 - apart(r["fingerprint"], r["edited_fingerprint"]) / H.BITS
        assert r["near_next"] == 1 - apart(r["fingerprint"], found[(i + 1) % len(found)]["fingerprint"]) / H.BITS
    prints = {}
    for r in got:
        prints.setdefault(r["fingerprint"], []).append(r)
    for f, own in prints.items():
        ids = [r["doc_id"] for r in own if r["doc_id"] is not None]
        links = sum(apart(f, x) <= 3 for x in prints if x != f)
        assert {(r["class_id"], r["links"]) for r in own} == {(min(ids, default=None), links)}
    same = {}
    for text, r in zip(texts, found, strict=True):
        assert same.setdefault(text, r["fingerprint"]) == r["fingerprint"]  # equal texts
    assert rows
    return found


def test_messy_and_empty(spark):
    check(messy(spark))
    assert H.edited_likeness(empty(spark)).count() == 0


def test_one_document_follows_itself(spark):
    row = H.edited_likeness(docs(spark, [(5, "one two three four five six")])).first()
    assert (row["near_next"], row["class_id"], row["links"]) == (1.0, 5, 0)


@pytest.mark.parametrize("stretch", [3, 16])
def test_many_stretches(spark, monkeypatch, stretch):
    monkeypatch.setattr(H, "STRETCH", stretch)
    rng = random.Random(stretch)
    rows = [(rng.randrange(10_000) * 7, prose(i, 1 + i % 5)) for i in range(150)] + [(None, prose(3, 2))] + [(3, prose(9, 2))] * 9
    check(docs(spark, rows))


def test_the_edited_text_is_nearer_than_the_next(spark):
    found = check(docs(spark, [(i, prose(i, 30)) for i in range(60)]))
    assert min(r["near_edited"] for r in found) > max(r["near_next"] for r in found)


def test_a_term_has_its_number_as_weight(spark):
    """A bit is 1 if the hashes of all pairs of words that set it are more than those that do not."""
    text = " ".join(words(1, 40, 6))
    own = text.split()
    pairs = spark.createDataFrame(list(zip(own, [*own[1:], None], strict=True)), "x string, y string")
    hashes = pairs.select(*[F.xxhash64(F.lit(i), "x", "y").alias(f"h{i}") for i in (0, 1)]).collect()
    want = [sum(1 << b for b in range(64) if 2 * sum(h[i] >> b & 1 for h in hashes) > len(hashes)) for i in (0, 1)]
    got = H.edited_likeness(docs(spark, [(1, text)])).first()["fingerprint"]
    assert got == "".join(f"{x:016x}" for x in want)


@pytest.mark.parametrize(("radius", "crowd"), [(3, 1_000), (3, 2), (6, 5), (1, 1)])
def test_links_equal_all_pairs(spark, monkeypatch, radius, crowd):
    monkeypatch.setattr(H, "CROWD", crowd)
    rng = random.Random(radius)
    base = [rng.getrandbits(128) for _ in range(6)]
    prints = {0, (1 << 128) - 1, *base}
    while len(prints) < 160:
        near = rng.choice(base)
        for b in rng.sample(range(128), rng.randrange(1, 5)):
            near ^= 1 << b
        prints.add(near)

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    halves = {p: (signed(p & (1 << 64) - 1), signed(p >> 64)) for p in prints}
    back = {v: k for k, v in halves.items()}
    df = spark.createDataFrame(list(halves.values()), "a bigint, b bigint")
    got = {frozenset((back[r["a"], r["b"]], back[r["a2"], r["b2"]])) for r in H.links(df, radius).collect()}
    want = {frozenset(p) for p in combinations(prints, 2) if bin(p[0] ^ p[1]).count("1") <= radius}
    assert len(want) > 20 and got == want and H.links(df, radius).count() == len(want)


def test_no_python_on_the_main_path(spark):
    assert not any(x in plan(H.edited_likeness(messy(spark))) for x in ("Python", "Pandas", "Arrow"))
