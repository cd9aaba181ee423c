"""Aggregates that stay distributed whatever the distribution of the values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rank error of a sketch is at most rows / _ACCURACY.
_ACCURACY = 10_000
#: Values of one bracket that are ordered on the driver; wider brackets are narrowed by another pass.
_ORDERED = 5_000


@dataclass
class _Bracket:
    """A rank (from 0) of a column, known to lie strictly between two values or to be `value`."""

    of: int
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    value: float | None = None

    def inside(self) -> Column:
        v, out = F.col(f"v{self.of}"), F.col(f"v{self.of}").isNotNull()
        if self.low is not None:
            out = out & (v > F.lit(self.low))
        return out if self.high is None else out & (v < F.lit(self.high))

    def cuts(self) -> Column:
        """Two values inside that enclose the rank but for the sketch's error, which the next count corrects."""
        at = (self.rank - self.below) / max(self.rows - 1, 1)
        points = F.array(*[F.lit(min(max(at + s * 2.0 / _ACCURACY, 0.0), 1.0)) for s in (-1, 1)])
        return F.percentile_approx(F.when(self.inside(), F.col(f"v{self.of}")), points, F.lit(_ACCURACY))

    def counts(self, cuts: Sequence[float]) -> list[Column]:
        v = F.col(f"v{self.of}")
        return [F.count(F.when(self.inside() & test, 1)) for c in cuts for test in (v < F.lit(c), v <= F.lit(c))]

    def narrow(self, cuts: Sequence[float], counts: Sequence[int]) -> None:
        under_low, to_low, under_high, to_high = (self.below + n for n in counts)
        edges = [(under_low, to_low, cuts[0]), (under_high, to_high, cuts[1])]
        for under, upto, value in edges:
            if under <= self.rank < upto:
                self.value = value
                return
        end = self.below + self.rows
        for under, upto, value in edges:
            if self.rank < under:
                self.high, end = value, under
                break
            self.low, self.below = value, upto
        self.rows = end - self.below


def exact_quantiles(df: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Exact, linearly interpolated quantiles as one row: name -> (column, probability).

    ``percentile`` keeps every distinct value in the buffer of a single task. Here a rank is bracketed
    by a bounded sketch, rows below and at the bracket's ends are counted exactly, and the rows
    strictly inside are bracketed again until a few thousand are left, which alone are ordered. All ranks
    are narrowed in the same passes; each makes the rest some thousand times smaller, and a value
    that fills a bracket, however often it occurs, ends the search. Every step is a plain aggregate: nothing
    that grows with the table is held in one place. The table is read two or three times (more beyond some
    10^7 rows). Nulls do not count; a column without values gives null.
    """
    columns = list(dict.fromkeys(column for column, _ in wanted.values()))
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    totals = values.agg(*[F.count(f"v{i}").alias(f"v{i}") for i in range(len(columns))]).first()
    brackets: dict[tuple[int, int], _Bracket] = {}
    for column, p in wanted.values():
        of = columns.index(column)
        place = float(p) * (totals[of] - 1)
        for rank in {floor(place), ceil(place)} if totals[of] else ():
            brackets[of, rank] = _Bracket(of, rank, totals[of])
    while wide := [b for b in brackets.values() if b.value is None and b.rows > _ORDERED]:
        cuts = list(values.agg(*[b.cuts() for b in wide]).first())
        counted = list(values.agg(*[c for b, own in zip(wide, cuts, strict=True) for c in b.counts(own)]).first())
        for k, b in enumerate(wide):
            b.narrow(cuts[k], counted[4 * k:4 * k + 4])
    left = [b for b in brackets.values() if b.value is None]
    if left:
        tagged = F.array(*[F.when(b.inside(), F.struct(F.lit(k).alias("k"), F.col(f"v{b.of}").alias("v"))) for k, b in enumerate(left)])
        rows = values.select(F.explode(tagged).alias("at")).where("at IS NOT NULL").select("at.*")
        ordered: dict[int, list[float]] = {}
        for k, v in rows.orderBy("k", "v").collect():  # at most _ORDERED for each rank
            ordered.setdefault(k, []).append(v)
        for k, b in enumerate(left):
            b.value = ordered[k][b.rank - b.below]

    def quantile(column: str, p: float) -> float | None:
        of = columns.index(column)
        if not totals[of]:
            return None
        place = float(p) * (totals[of] - 1)
        low, high = brackets[of, floor(place)].value, brackets[of, ceil(place)].value
        return low if low == high else low + (high - low) * (place - floor(place))

    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in wanted])
    return df.sparkSession.createDataFrame([tuple(quantile(c, p) for c, p in wanted.values())], schema)


def weighted_error(df: DataFrame, actual: str, forecast: str) -> DataFrame:
    """Totals, wMAPE and accuracy over all rows, as one row."""
    totals = df.agg(
        F.coalesce(F.sum(actual), F.lit(0)).cast("bigint").alias("Actual_Total"),
        F.coalesce(F.sum(forecast), F.lit(0)).cast("bigint").alias("Forecast_Total"),
        F.coalesce(F.sum(F.abs(F.col(actual) - F.col(forecast))), F.lit(0))
        .cast("double").alias("abs_error"),
    )
    scored = F.col("Actual_Total") > 0
    wmape = F.col("abs_error") / F.col("Actual_Total") * 100
    diff = F.col("Forecast_Total") - F.col("Actual_Total")
    return totals.select(
        "Actual_Total", "Forecast_Total", diff.alias("Diff"),
        F.when(scored, diff / F.col("Actual_Total")).alias("Diff_Ratio"),
        F.when(scored, wmape).otherwise(0.0).alias("wMAPE"),
        F.when(scored, 100 - wmape).otherwise(0.0).alias("Accuracy"),
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in the given order, nulls first.

    The least value of the first order column is a plain minimum, which combines by hash before the
    shuffle whatever the key holds; only rows that have it are compared in full. A side of few keys
    is broadcast by the optimizer, a hot key's rows never meet unreduced.
    """
    lead = F.col(order[0])
    least = df.groupBy(*keys).agg(
        F.min(lead).alias("_least"), F.max(lead.isNull()).alias("_null")
    ).select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.when(F.col("_null"), F.lit(None)).otherwise(F.col("_least")).alias("_first"),
    )
    same = lead.eqNullSafe(F.col("_first"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = [c for c in order if c not in keys]
    first = df.join(least, same, "left_semi").groupBy(*keys).agg(
        F.min(F.struct(*ordered, *rest)).alias("first"))
    return first.select(
        *[F.col(c) if c in keys else F.col(f"first.`{c}`").alias(c) for c in df.columns]
    )
