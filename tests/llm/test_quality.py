import zlib

import numpy as np
from pyspark.sql import functions as F

from callstrata.llm import quality as Q
from tests.llm.helpers import docs, empty, messy, prose, unchanged, words

SMALL = Q.Settings(sample_rows=2_000, shards=4)


def corpus(spark, n=400):
    """Even ids are prose, odd ones shouted word lists."""
    rows = [(i, prose(i, 6) if i % 2 == 0 else " ".join(w.upper() + "!!" for w in words(i, 50))) for i in range(n)]
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(0, n)], "doc_id bigint, quality int, toxic int")
    return docs(spark, rows), labels


def test_learns_what_is_not_held_out(spark):
    df, labels = corpus(spark)
    weights = Q.fit(df, labels, SMALL)
    rows = Q.score(df, weights, SMALL).select("doc_id", "__score", Q.held_out(F.col("doc_id")).alias("out")).collect()
    assert {r["doc_id"] for r in rows if r["out"]} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    held = [(r["__score"] >= 0.7) == (r["doc_id"] % 2 == 0) for r in rows if r["out"]]
    assert len(held) > 50 and np.mean(held) > 0.97


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    df, labels = corpus(spark)
    turned = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = df.withColumns({"lang": F.lit("xx"), "source": F.col("doc_id").cast("string"), "n_chars": F.col("doc_id")})
    assert np.array_equal(Q.fit(df, labels, SMALL), Q.fit(other, turned.withColumn("toxic", F.lit(1)), SMALL))


def test_sample_is_bounded(spark):
    df, labels = corpus(spark)
    n = Q.training_rows(df, labels, Q.Settings(sample_rows=60)).count()
    assert 30 <= n <= 95


def test_score_is_the_plain_dot_product(spark):
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(1 << Q.BITS) + 1).astype(np.float32)
    texts = ["", "One two two THREE!", prose(1, 20), "a b a b a b"]
    got = {r["doc_id"]: r["__score"] for r in Q.score(docs(spark, list(enumerate(texts))), weights).collect()}
    for i, text in enumerate(texts):
        ids, _, n = Q.grams([text])
        z = float(weights[-1]) + Q.Settings.scale * sum(float(weights[b]) for b in ids) / max(n[0], 1)
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-6


def test_contradicting_null_and_repeated_labels(spark):
    df = docs(spark, [(i, prose(i, 3)) for i in range(6)])
    labels = spark.createDataFrame(
        [(0, 1), (0, 0), (1, None), (None, 1), (3, 1), (3, 1), (4, 7), (99, 1)], "doc_id bigint, quality int")
    rows = Q.training_rows(df, labels, SMALL).collect()
    assert [r["text"] for r in rows] == [prose(3, 3)] * (zlib.crc32(b"3") % 4 != 2)


def test_messy_and_empty(spark):
    df = messy(spark)
    _, labels = corpus(spark)
    none = labels.limit(0)
    assert not Q.fit(df, none, SMALL).any()
    assert Q.accepted(df, none, SMALL).count() == df.count()
    unchanged(df, Q.accepted(df, labels, SMALL))
    weights = Q.fit(df, labels, SMALL)
    scores = {(r["doc_id"], r["text"]): r["__score"] for r in Q.score(df, weights, SMALL).collect()}
    assert scores[1, None] == scores[2, ""] == scores[3, " \t\n "] and all(0 <= x <= 1 for x in scores.values())
    assert Q.score(empty(spark), weights, SMALL).count() == 0 and not Q.fit(empty(spark), labels, SMALL).any()
