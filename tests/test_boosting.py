from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from callstrata.operators.windows import apportion
from callstrata.plans import boosting as B
from tests.helpers import frame

SMALL = B.Growth(trees=40, min_rows=5)


def data(n=600, seed=1):
    rng = np.random.default_rng(seed)
    df = pd.DataFrame({"a": rng.normal(size=n), "b": rng.normal(size=n), "s": rng.choice(list("ABCDEF"), n)})
    df.loc[rng.random(n) < 0.1, "a"] = np.nan
    df.loc[rng.random(n) < 0.05, "s"] = None
    df["y"] = rng.poisson(np.exp(1 + 0.8 * df["a"].fillna(2) + df["s"].isin(["A", "C", "F"]))).astype(float)
    return df


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(data().astype(object).where(lambda x: x.notna(), None), "a double, b double, s string, y double").persist()


def test_categories_are_split_as_well_as_by_trying_all_subsets():
    for seed in range(5):
        df = data(seed=seed)
        binned = B.Binned(df, [], ["s"], 255)
        g, h = B.Loss("tweedie").slopes(df["y"].to_numpy(), np.full(len(df), 1.0))
        hist = binned.histogram(np.arange(len(df)), g, h)
        names = range(hist.shape[2])
        best = max(float(B._gain(hist[:, 0, list(c)].sum(1), hist[:, 0].sum(1), 1)) for k in range(1, len(names)) for c in combinations(names, k))
        assert B.best_split(hist, 0, 1).gain == pytest.approx(best)


def test_slopes_are_derivatives():
    y, s, e = np.array([0.0, 1.0, 7.0]), np.array([0.3, -0.4, 1.2]), 1e-5

    def tweedie(score):
        return y * np.exp(-0.5 * score) / 0.5 + np.exp(0.5 * score) / 0.5

    loss = {"tweedie": tweedie, "squared": lambda score: (score - y) ** 2 / 2}
    for kind, f in loss.items():
        g, h = B.Loss(kind).slopes(y, s)
        assert g == pytest.approx((f(s + e) - f(s - e)) / (2 * e), rel=1e-4, abs=1e-6)
        assert h == pytest.approx((f(s + e) - 2 * f(s) + f(s - e)) / e ** 2, rel=1e-3, abs=1e-3)


@pytest.mark.parametrize("parts", [1, 3])
def test_models_score_alike_in_both_forms_and_learn(spark, rows, tmp_path, parts):
    losses = {"t": B.Loss("tweedie"), "m": B.Loss("squared"), "q": B.Loss("quantile", 0.9)}
    growth = B.Growth(trees=40, min_rows=5, group_rows=-(-600 // parts))
    models = B.fit(rows, "y", ["a", "b"], ["s"], losses, growth)
    models.save(str(tmp_path / "m"))
    loaded = B.load_boosted(spark, str(tmp_path / "m"))
    unseen = frame(spark, "a DOUBLE, b DOUBLE, s STRING, y DOUBLE", (None, 1.0, "new", 1.0), (float("nan"), None, None, 2.0))
    every = rows.unionByName(unseen)
    out = models.predict(every, t="t", m="m", q="q").withColumns({f"v{m}": loaded.value(m) for m in losses}).withColumns(
        {f"s{m}": loaded.score(m, F.col(f"v{m}")) for m in losses}).toPandas()
    for m in losses:
        assert out[m].to_numpy() == pytest.approx(out[f"s{m}"].to_numpy(), rel=1e-9)
    y = out["y"]
    assert ((out["t"] - y) ** 2).mean() < 0.5 * y.var() and ((out["m"] - y) ** 2).mean() < 0.5 * y.var() and (out["t"] > 0).all()
    assert 0.8 < (y <= out["q"]).mean() <= 1
    assert B.load_boosted(spark, str(tmp_path / "none")) is None
    with pytest.raises(LookupError):
        models.predict(rows, x="absent").count()
    with pytest.raises(ValueError):
        models.predict(rows.drop("a"), x="t")


def test_fits_are_repeatable(rows):
    def leaves(df):
        return B.fit(df, "y", ["a"], ["s"], {"t": B.Loss("tweedie")}, SMALL).trees.orderBy("tree").toPandas()["v"].map(list).tolist()

    assert leaves(rows) == leaves(rows.repartition(5))


def test_apportion(spark):
    df = frame(spark, "g STRING, h INT, x DOUBLE", *[("a", h, 10 / 3) for h in range(3)], ("b", 0, 0.0), ("b", 1, 0.0),
               ("c", 0, 0.5), ("c", 1, 0.5), ("c", 2, 2.0), ("d", 0, 0.2), ("d", 1, 0.9), ("d", 2, 1.9))
    got = {(r["g"], r["h"]): r["x"] for r in apportion(df, ["x"], ["g"], ["h"]).collect()}
    assert [got["a", h] for h in range(3)] == [4, 3, 3] and [got["b", h] for h in range(2)] == [0, 0]
    assert [got["c", h] for h in range(3)] == [1, 0, 2] and [got["d", h] for h in range(3)] == [0, 1, 2]
