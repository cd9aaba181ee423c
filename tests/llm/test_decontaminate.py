import random
import re
from itertools import combinations

import pytest

from callstrata.llm import decontaminate as D
from tests.llm.helpers import docs, empty, messy, unchanged, words

ITEM = "item_id bigint, text string"


def plain(rows, items):
    """(doc, item) by comparing every aligned stretch of 13 places."""
    def cut(t):
        return re.findall(r"\w+", (t or "").lower())

    out = set()
    for d, text in rows:
        a = cut(text)
        for i, item in items:
            b = cut(item)
            if len(b) < D.SHORTEST:
                continue
            if len(b) < D.EQUAL:
                if any(a[k:k + len(b)] == b for k in range(len(a) - len(b) + 1)):
                    out.add((d, i))
                continue
            for shift in range(-len(a), len(b)):
                same = [0 <= k + shift < len(b) and a[k] == b[k + shift] for k in range(len(a))]
                if any(sum(same[k:k + 13]) >= 11 for k in range(len(same))):
                    out.add((d, i))
                    break
    return out


def test_masks_miss_no_window_with_two_unequal_words():
    for wrong in combinations(range(13), 2):
        assert any(
            all(s + p not in wrong and s + p < 13 for p in mask) for mask in D.MASKS for s in range(D.BEFORE + 1))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_brute_force(spark, seed):
    rng = random.Random(seed)
    items = [(i, " ".join(words(100 + i, rng.choice([3, 7, 10, 11, 13, 20, 30]), 60))) for i in range(25)]
    rows = []
    for d in range(120):
        w = words(5000 + d, rng.randrange(40), 60)
        part = rng.choice(items)[1].split()
        a = rng.randrange(max(1, len(part) - 9))
        part = part[a: a + rng.randrange(9, 16)]
        for _ in range(rng.randrange(4)):
            part[rng.randrange(len(part))] = "Changed"
        at = rng.randrange(len(w) + 1)
        rows.append((d, " ".join([*w[:at], *part, *w[at:]]).upper().replace(" ", ", ", 3)))
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs(spark, rows), spark.createDataFrame(items, ITEM)).collect()}
    want = plain(rows, items)
    assert want and len({d for d, _ in want}) < 110 and got == want


def test_where_a_passage_lies(spark):
    item = words(1, 20)
    text = [*words(2, 30), *item, *words(3, 5)]
    row = D.contaminated(docs(spark, [(4, " ".join(text))]), spark.createDataFrame([(8, " ".join(item))], ITEM)).collect()
    assert [(r["doc_id"], r["item_id"], r["first_word"], r["equal_words"]) for r in row] == [(4, 8, 30, 13)]


def test_hot_passage_and_equal_items(spark):
    item = " ".join(words(1, 16))
    df = docs(spark, [(i, f"{i} {item}") for i in range(2_000)] + [(5_000, " ".join(words(9, 40)))])
    items = spark.createDataFrame([(7, item), (3, item), (3, item), (4, None)], ITEM)
    got = D.contaminated(df, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(d, i) for d in range(2_000) for i in (3, 7)} and len(got) == 4_000
    assert [r["doc_id"] for r in D.clean(df, items).collect()] == [5_000]


def test_items_that_share_a_passage_and_items_named_by_text(spark):
    shared, own = " ".join(words(1, 20)), " ".join(words(2, 20))
    items = spark.createDataFrame([("a", f"{shared} {own}"), ("b", shared), ("c", own)], "item_id string, text string")
    got = D.contaminated(docs(spark, [(1, shared), (2, own), (3, " ".join(words(3, 40)))]), items)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(1, "a"), (1, "b"), (2, "a"), (2, "c")}


def test_messy_and_empty(spark):
    df = messy(spark)
    text = next(r["text"] for r in df.collect() if r["doc_id"] == 5).split()
    items = spark.createDataFrame([(1, " ".join(text[40_000:40_013])), (2, ""), (None, None)], ITEM).withColumnRenamed("text", "text")
    kept = D.clean(df, items)
    unchanged(df, kept)
    assert kept.count() == df.count() - 1 and kept.where("doc_id = 5").count() == 0
    assert D.clean(df, items.limit(0)).count() == df.count()
    assert D.clean(empty(spark), items).count() == 0 and D.contaminated(empty(spark), items).count() == 0
