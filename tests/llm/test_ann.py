import numpy as np
import pytest
from pyspark.sql import functions as F

from callstrata.llm import ann as A

VEC = "vec_id bigint, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(int(i) if i is not None else None, v if v is None else [x if x is None else float(x) for x in v], 0) for i, v in rows], VEC)


def exact(rows, k=20, every=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([np.asarray(v, np.float32) for _, v in rows]).astype(float)
    out = {}
    for q in sorted({int(i) for i in ids if i % every == 0}):
        score = (x * x[np.nonzero(ids == q)[0][0]]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def found(df, s=A.Settings()):
    out = {}
    for r in A.nearest(df, F.col("vec_id") % 20 == 0, s).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return np.mean([len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) / len(w) for q, w in want.items()])


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 24))
    x = centres[rng.integers(0, 30, 4_000)] + 0.5 * rng.normal(size=(4_000, 24))
    x *= rng.uniform(0.5, 2, (4_000, 1))  # lengths differ, so inner product and distance do too
    rows = list(enumerate(x))
    got, want = found(frame(spark, rows)), exact(rows)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    true = {(q, v): s for q, w in exact(rows, 4_000).items() for v, s in w}
    assert all(abs(true[q, v] - s) < 1e-9 for q, own in got.items() for v, s in own)
    assert all(own == sorted(own, key=lambda r: (-r[1], r[0])) for own in got.values())


def test_blocks_do_not_change_the_result(spark):
    rng = np.random.default_rng(2)
    rows = list(enumerate(rng.normal(size=(1_500, 8))))
    df = frame(spark, rows)
    small = A.Settings(group_rows=100, query_rows=7)
    assert found(df, small) == found(df)


def test_equal_vectors_and_ties(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=8)
    rows = [(i, hot if i % 3 else rng.normal(size=8)) for i in range(1_200)]
    got, want = found(frame(spark, rows)), exact(rows)
    for q, own in got.items():
        if q % 3:
            assert [v for v, _ in own] == [v for v, _ in want[q]]
    assert recall(got, want) >= 0.9


def test_few_candidates_are_all_returned(spark):
    rows = [(i, np.eye(5)[i % 5] * (1 + i)) for i in range(0, 12)]
    assert found(frame(spark, rows)) == exact(rows)


def test_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=4)) for i in range(0, 200, 10)]
    bad = [(1, None), (2, []), (3, [0, 0, 0, 0]), (40 * 20, [1, None, 1, 1]), (5, [1, float("nan"), 0, 0]),
           (6, [float("inf"), 0, 0, 0]), (7, [1, 2, 3]), (None, [1, 2, 3, 4])]
    df = frame(spark, [*good, *bad]).withColumns({c: F.lit("kept") for c in ("vec", "lists", "copy", "score", "rank", "n")})
    assert found(df) == exact(good)
    assert found(df.limit(0)) == {} and found(frame(spark, bad[:3])) == {}


def test_repeated_rows_count_once(spark):
    """Thirty rows of one vector and id are one candidate and crowd out no equal vector."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4)) for i in range(30)] + [(50 + i, np.ones(4)) for i in range(25)]
    got = found(frame(spark, [*rows, *[rows[-1]] * 40, *[rows[30]] * 40, *rows]))
    want = exact(rows)
    assert all(len({v for v, _ in own}) == len(own) == 20 for own in got.values())
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    assert [v for v, _ in got[60]] == [v for v, _ in want[60]]


@pytest.mark.parametrize("n", [1, 2, 40, 500])
def test_graph_reaches_what_lies_within_reach(n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(max(n * 8, 4), 16)).astype(np.float32)
    index = A.fit(x, float(np.linalg.norm(x, axis=1).max()), n, A.Settings())
    asked = index.asked(x[:50])
    reached, true = index.search(asked, 1.2), A._distances(asked, index.centroids)
    inside = true <= 1.2 * np.maximum(true.min(axis=1, keepdims=True), index.usual)
    assert np.isfinite(reached[inside]).mean() > 0.95


def test_lists_looked_into_hold_the_neighbours_of_random_directions():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6_000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = A.Settings()
    index = A.fit(x, 1.0, len(x) // s.list_rows, s)
    lists, apart = A.memberships(index, x, s), index.search(index.asked(x[:300]), s.reach)
    limit, held = s.reach * np.maximum(apart.min(axis=1), index.usual), 0
    for i in range(300):
        seen, score = set(np.nonzero(apart[i] <= limit[i])[0].tolist()), x @ x[i]
        score[i] = -np.inf
        held += sum(bool(seen & set(lists[v])) for v in np.argsort(-score)[: s.k].tolist())
    assert held / (300 * s.k) > 0.95
