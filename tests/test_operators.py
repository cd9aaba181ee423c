import random
import statistics
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from callstrata.operators import filters as flt
from callstrata.operators.aggregates import exact_quantiles, first_rows, weighted_error
from callstrata.operators.grid import expand_hours, fill_grid
from callstrata.operators.joins import lookup_join, map_values, measured_bytes
from callstrata.operators.windows import lag_days, share, top_per_group
from callstrata.settings import Settings
from tests.helpers import at, day, dicts, frame, plan

NO_BROADCAST = replace(Settings(), broadcast_bytes=0, join_salts=5)


def skewed(spark):
    """A third of all rows on one key, some on the null key."""
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") < 1000, F.lit("hot")).when(F.col("id") < 1200, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
    )


def lookup(spark):
    return frame(spark, "k STRING, v INT", ("hot", 1), ("k1", 2), ("k7", 3), (None, 4))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_equals_plain_join(spark, how):
    expected = skewed(spark).join(lookup(spark), "k", how)
    got = lookup_join(skewed(spark), lookup(spark), "k", how, ["id"], NO_BROADCAST)
    assert sorted(map(repr, expected.collect())) == sorted(map(repr, got.collect()))
    assert got.columns == expected.columns


def test_salted_lookup_spreads_the_hot_key(spark):
    facts, dim = skewed(spark), lookup(spark)
    joined = lookup_join(facts, dim, "k", "left", ["id"], NO_BROADCAST)
    assert "_salt" in plan(joined) and "_salt" not in joined.columns
    assert "_salt" not in plan(lookup_join(facts, dim, "k", "left", ["id"]))


def test_measured_bytes_counts_values(spark):
    assert measured_bytes(lookup(spark).limit(0)) == 0
    big = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 100, "x").alias("s"))
    assert measured_bytes(big) >= 100_000


def test_map_values_default(spark):
    df = frame(spark, "q STRING", ("1",), ("9",), (None,))
    assert [r["s"] for r in dicts(map_values(df, "q", {1: "A"}, "s", "?"))] == ["A", "?", "?"]
    assert [r["s"] for r in dicts(map_values(df, "q", {}, "s", "?"))] == ["?"] * 3


def test_not_listed(spark):
    df = frame(spark, "q STRING", ("1",), ("2",), (None,))
    assert [r["q"] for r in dicts(df.where(flt.not_listed(F.col("q"), ["1"])))] == ["2"]
    assert [r["q"] for r in dicts(df.where(flt.not_listed(F.col("q"), [])))] == ["1", "2"]
    assert df.where(flt.not_listed_if_any(F.col("q"), [])).count() == 3


def test_period_is_half_open_and_reaches_the_scan(spark, tmp_path):
    df = frame(spark, "t TIMESTAMP_NTZ", (at("2024-01-01 23:59:59.500"),), (at("2024-01-02"),))
    days = F.lit(day("2024-01-01"))
    assert df.where(flt.on_days(F.col("t"), days, days)).count() == 1
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t")).where(flt.on_days(F.col("t"), days, days))
    assert "GreaterThanOrEqual(t" in plan(stored) and "LessThan(t" in plan(stored)


@pytest.mark.parametrize("seed", range(8))
def test_quantiles_are_exact(spark, seed):
    rng = random.Random(seed)
    kinds = [
        lambda: rng.random() * 1e6, lambda: rng.choice([1, 1, 1, 2, 500]),
        lambda: rng.randint(-3, 3), lambda: rng.expovariate(1e-3),
    ]
    values = [float(kinds[seed % 4]()) for _ in range([8, 30_000, 997, 50_000, 1, 2, 3, 25_000][seed])]
    df = frame(spark, "x DOUBLE, y DOUBLE", *[(v, -v) for v in values], (None, None))
    wanted = {"a": ("x", 0.0), "b": ("x", 0.33), "c": ("x", 0.8), "d": ("x", 1.0), "e": ("y", 0.5)}
    got = exact_quantiles(df, wanted).first().asDict()
    for name, (column, p) in wanted.items():
        signed = values if column == "x" else [-v for v in values]
        assert got[name] == pytest.approx(np.quantile(signed, p), rel=1e-12), (name, len(values))


def test_quantiles_in_several_passes(spark, monkeypatch):
    """A million distinct values with a third of all rows on one more; no window, and few rows are ordered."""
    from callstrata.operators import aggregates

    monkeypatch.setattr(aggregates, "_ORDERED", 40)
    df = spark.range(1_500_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.25)).otherwise(F.rand(7)).alias("x"))
    df = df.persist()
    values = np.array([r[0] for r in df.collect()])
    wanted = {f"q{p}": ("x", p) for p in (0.0, 0.1, 0.3, 0.5, 0.77777, 1.0)}
    got = exact_quantiles(df, wanted).first().asDict()
    for name, (_, p) in wanted.items():
        assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12), name
    assert "Window" not in plan(exact_quantiles(df, wanted))
    df.unpersist()


def test_quantiles_of_nothing(spark):
    empty = frame(spark, "x DOUBLE", (None,))
    assert exact_quantiles(empty, {"a": ("x", 0.5)}).first()["a"] is None


def test_quantiles_of_one_column_missing(spark):
    df = frame(spark, "x DOUBLE, y DOUBLE", (1.0, None), (3.0, None))
    assert tuple(exact_quantiles(df, {"a": ("x", 0.5), "b": ("y", 0.5)}).first()) == (2.0, None)


def test_median_matches_the_standard_library(spark):
    values = [float(v) for v in (5, 1, 4, 4, 9, 2)]
    df = frame(spark, "x DOUBLE", *[(v,) for v in values])
    assert exact_quantiles(df, {"m": ("x", 0.5)}).first()["m"] == statistics.median(values)


def test_first_rows(spark):
    df = frame(spark, "k STRING, o INT, v STRING", ("a", 2, "x"), ("a", 1, None), ("b", 1, "z"))
    assert sorted(tuple(r) for r in first_rows(df, ["k"], ["o"]).collect()) == [("a", 1, None), ("b", 1, "z")]


def test_weighted_error(spark):
    df = frame(spark, "a BIGINT, f BIGINT", (10, 8), (0, 1), (10, 11))
    row = weighted_error(df, "a", "f").first()
    assert (row["wMAPE"], row["Accuracy"], row["Diff"], row["Diff_Ratio"]) == (20.0, 80.0, 0, 0.0)
    zero = weighted_error(frame(spark, "a BIGINT, f BIGINT", (0, 5)), "a", "f").first()
    assert (zero["wMAPE"], zero["Accuracy"], zero["Diff_Ratio"]) == (0.0, 0.0, None)
    nothing = weighted_error(df.limit(0), "a", "f").first()
    assert (nothing["Actual_Total"], nothing["wMAPE"]) == (0, 0.0)


def test_grid_fills_every_hour_across_daylight_saving(spark, in_stockholm):
    df = frame(spark, "g STRING, ds TIMESTAMP_NTZ, n BIGINT",
               ("a", at("2024-03-31 00:00:00"), 3), ("a", at("2024-03-31 05:00:00"), 4),
               ("b", at("2024-03-31 02:00:00"), 5))
    bounds = df.agg(F.struct(F.min("ds").alias("lo"), F.max("ds").alias("hi"))).scalar()
    grid = fill_grid(df, ["g"], "ds", ["n"], bounds.getField("lo"), bounds.getField("hi"), "hour")
    got = {(r["g"], r["ds"].hour): r["n"] for r in grid.collect()}
    assert got == {(g, h): {("a", 0): 3, ("a", 5): 4, ("b", 2): 5}.get((g, h), 0)
                   for g in "ab" for h in range(6)}
    assert "CartesianProduct" not in plan(grid) and "NestedLoop" not in plan(grid)


def test_expand_hours(spark, in_stockholm):
    hours = [r["t"] for r in expand_hours(frame(spark, "d DATE", (day("2024-03-31"),)), "d", "t").collect()]
    assert [h.hour for h in hours] == list(range(24)) and {h.date() for h in hours} == {day("2024-03-31")}


def test_lag_equals_self_join_on_a_full_grid(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-03-01')) AS ds")
    df = days.select("ds", F.lit("a").alias("g"), F.dayofyear("ds").cast("bigint").alias("n"))
    lagged = lag_days(df, ["g"], "ds", "n", [1, 7, 28], rows_per_day=1)
    before = df.select(F.date_add("ds", 7).alias("ds"), F.col("n").alias("expected"))
    both = lagged.join(before, "ds", "left")
    assert both.where(~F.col("n_lag_7d").eqNullSafe(F.col("expected"))).count() == 0
    assert plan(lagged).count("Window [") == 1


def test_share_and_top(spark):
    df = frame(spark, "g STRING, n BIGINT", ("a", 1), ("a", 3), ("z", 0))
    got = dicts(df.withColumn("s", share(F.col("n"), ["g"])))
    assert sorted((r["g"], r["n"], r["s"]) for r in got) == [("a", 1, 0.25), ("a", 3, 0.75), ("z", 0, 0.0)]
    top = top_per_group(df, ["g"], [F.desc("n")], 1, "r")
    assert sorted((r["g"], r["n"]) for r in dicts(top)) == [("a", 3), ("z", 0)]
    assert "WindowGroupLimit" in plan(top)
