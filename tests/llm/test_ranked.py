import random
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from callstrata.llm import ranked as K
from tests.llm.helpers import docs, empty, messy, words


def plain(rows, items, k=10):
    """(item, rank, doc, score) by scoring every document for every item."""
    held = [(d, K.terms((t or "").encode())) for d, t in rows]
    n_docs, total = sum(bool(x) for _, x in held), sum(len(x) for _, x in held)
    df = Counter(t for _, x in held for t in set(x))
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for d, own in held:
            tf, score = Counter(own), 0
            for t in set(K.terms((text or "").encode())):
                if tf[t]:
                    m = 100 - 90 + (90 * len(own) * n_docs) // total
                    score += floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, df, items, k=10):
    table = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted([tuple(r) for r in K.search(df, table, k).collect()], key=str)


@pytest.mark.parametrize("seed", range(3))
def test_search_equals_scoring_all(spark, monkeypatch, seed):
    monkeypatch.setattr(K, "FIRST_READ", 2)
    rng = random.Random(seed)
    rows = [(i, " ".join(words(seed * 500 + i, rng.randrange(1, 60), 40))) for i in range(300)] + [(i, "same words here") for i in range(400, 430)]
    items = [(i, " ".join(words(9_000 + i, 12, 60))) for i in range(15)] + [(90, "same here"), (91, "absent-term"), (92, None), (92, "same"), (92, "same")]
    df = docs(spark, rows).repartition(5)
    assert found(spark, df, items) == plain(rows, items)
    assert found(spark, df, items, 3) == plain(rows, items, 3)


def test_segments_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(K, "SEGMENT", 50)
    monkeypatch.setattr(K, "BLOCK", 2)
    rows = [(i, " ".join(words(i, 30, 50))) for i in range(120)]
    items = [(i, " ".join(words(700 + i, 8, 50))) for i in range(7)]
    assert found(spark, docs(spark, rows), items) == plain(rows, items)


def test_messy_and_empty(spark):
    df = messy(spark)
    items = [(1, "one ÜNÏCODE 漢字"), (None, "w1x"), (3, ""), (4, "endoftext 12")]
    assert found(spark, df, items) == plain([(r["doc_id"], r["text"]) for r in df.collect()], items)
    assert found(spark, empty(spark), items) == []
    assert found(spark, df, []) == []


def test_terms():
    assert K.terms("It's A-b_9 Å漢\x7f z".encode()) == [x.encode() for x in ("it", "s", "a", "b", "9", "Å漢", " z")]


def test_reading_ends_early_only_when_all_is_settled():
    """Of a long flat list nothing more is read once no document can still reach the best ones."""

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, at):
            if isinstance(at, slice):
                Counted.read = max(Counted.read, at.stop or 0)
            return super().__getitem__(at)

    n = 100_000
    flat = np.arange(n).view(Counted)
    lists = [(flat, np.full(n, 5)), (np.arange(10), np.full(10, 1_000))]
    best, scores = K.nearest(lists, np.arange(n), 10)
    assert best.tolist() == list(range(10)) and set(scores.tolist()) == {1_005} and Counted.read < n
    tied, _ = K.nearest([(np.arange(n)[::-1].copy(), np.full(n, 5))], np.arange(n), 3)
    assert tied.tolist() == [0, 1, 2]
