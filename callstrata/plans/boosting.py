"""Boosted trees with Tweedie, quantile and squared loss: fitted group by group, scored as one expression.

Every model is fitted on all rows. Rows are dealt into groups of at most `group_rows`, each group
grows its own trees as a Spark task, and a model is the mean of its groups' trees; a training set of that
size or less is one group and one plain boosted model. Trees are rows of arrays; scoring is a
fold over them inside the JVM, which can stand anywhere a column can.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.operators.columns import require_columns
from callstrata.session import cut_lineage
from callstrata.sources.readers import is_missing


@dataclass(frozen=True)
class Loss:
    """kind: tweedie (log link, power between 1 and 2), quantile (alpha) or squared."""

    kind: str = "squared"
    alpha: float = 0.5
    power: float = 1.5

    def start(self, y: np.ndarray) -> float:
        if self.kind == "tweedie":
            return float(np.log(max(y.mean(), 1e-9)))
        return float(np.quantile(y, self.alpha) if self.kind == "quantile" else y.mean())

    def slopes(self, y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and second derivative of the loss by the score."""
        if self.kind == "tweedie":
            low, high = np.exp((1 - self.power) * score), np.exp((2 - self.power) * score)
            return high - y * low, (2 - self.power) * high - (1 - self.power) * y * low
        if self.kind == "quantile":
            return np.where(y > score, -self.alpha, 1 - self.alpha), np.ones(len(y))
        return score - y, np.ones(len(y))


@dataclass(frozen=True)
class Growth:
    """How trees grow (the studied learner's defaults), and the rows one task may hold."""

    trees: int = 500
    rate: float = 0.1
    leaves: int = 31
    min_rows: int = 20
    bins: int = 255
    group_rows: int = 100_000


# ---- one group's trees -----------------------------------------------------------------------

class Binned:
    """Columns as small numbers: numeric ones 1, 2, ... by value with 0 for null, categories by name."""

    def __init__(self, rows: pd.DataFrame, numeric: Sequence[str], categories: Sequence[str], bins: int):
        self.numeric, self.edges, codes = len(numeric), [], []
        for name in numeric:
            x = rows[name].to_numpy(np.float64)
            known = np.unique(x[~np.isnan(x)])
            if len(known) > bins:
                known = np.unique(np.quantile(x[~np.isnan(x)], np.linspace(0, 1, bins), method="nearest"))
            edges = np.append((known[:-1] + known[1:]) / 2, np.inf)
            codes.append(np.where(np.isnan(x), 0, 1 + np.searchsorted(edges[:-1], x)))
            self.edges.append(edges)
        self.names = []
        for name in categories:
            values, at = np.unique(rows[name].fillna("").to_numpy(str), return_inverse=True)
            self.names.append(values.tolist())
            codes.append(at)
        self.width = 1 + max((int(c.max()) for c in codes if len(c)), default=0)
        self.codes = np.stack(codes, axis=1) if codes else np.zeros((len(rows), 0), np.int64)
        self.spots = self.codes + np.arange(self.codes.shape[1]) * self.width

    def histogram(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Sums of g, h and rows by (column, code)."""
        n = self.codes.shape[1]
        spots = self.spots[rows].ravel()
        return np.stack([
            np.bincount(spots, w, n * self.width).reshape(n, self.width)
            for w in (np.repeat(g[rows], n), np.repeat(h[rows], n), None)])


@dataclass
class Split:
    gain: float
    column: int = -1
    left: np.ndarray | None = None  # codes that go left
    code: int = 0
    nulls_left: bool = False


def _gain(left: np.ndarray, whole: np.ndarray, min_rows: int) -> np.ndarray:
    """What a split lowers the loss by, -inf where a side is too small; sums of g, h, rows in the first axis."""
    right = whole - left
    fits = (left[2] >= min_rows) & (right[2] >= min_rows) & (left[1] > 1e-3) & (right[1] > 1e-3)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - whole[0] ** 2 / whole[1]
    return np.where(fits, gain, -np.inf)


def best_split(hist: np.ndarray, numeric: int, min_rows: int) -> Split:
    """The split of highest gain. Categories are ordered by their ratio of first to second derivative and cut
    along that order, which finds the best of all subsets."""
    best = Split(1e-12)
    if numeric:
        own = hist[:, :numeric]
        whole = own.sum(axis=2, keepdims=True)
        upto = np.cumsum(own, axis=2)
        sides = [(True, upto)]
        if own[2, :, 0].any():  # nulls on either side
            sides.append((False, upto - own[:, :, :1]))
        for nulls_left, left in sides:
            gain = _gain(left, whole, min_rows)
            at = int(gain.argmax())
            if gain.flat[at] > best.gain:
                best = Split(float(gain.flat[at]), *divmod(at, gain.shape[1])[:1], None, at % gain.shape[1], nulls_left)
    for column in range(numeric, hist.shape[1]):
        own = hist[:, column]
        seen = np.flatnonzero(own[2] > 0)
        order = seen[np.argsort(own[0, seen] / own[1, seen], kind="stable")]
        gain = _gain(np.cumsum(own[:, order], axis=1), own.sum(axis=1, keepdims=True), min_rows)
        if len(gain) and gain.max() > best.gain:
            best = Split(float(gain.max()), column, order[:int(gain.argmax()) + 1])
    return best


def grow(binned: Binned, g: np.ndarray, h: np.ndarray, growth: Growth) -> tuple[dict, list[tuple[int, np.ndarray]]]:
    """One tree, best leaf first, as arrays over its nodes, and (node, rows) of its leaves."""
    tree: dict[str, list] = {"f": [-1], "t": [0.0], "c": [[]], "l": [0], "r": [0], "m": [False], "v": [0.0], "depth": [0]}
    every = np.arange(len(g))
    hist = binned.histogram(every, g, h)
    heap, leaves = [], {0: every}

    def offer(node: int, own: np.ndarray) -> None:
        if len(leaves[node]) < 2 * growth.min_rows:
            return
        split = best_split(own, binned.numeric, growth.min_rows)
        if split.column >= 0:
            heappush(heap, (-split.gain, node, split, own))

    offer(0, hist)
    while heap and len(leaves) < growth.leaves:
        _, node, split, own = heappop(heap)
        rows = leaves.pop(node)
        code = binned.codes[rows, split.column]
        if split.left is None:
            to_left = np.where(code == 0, split.nulls_left, code <= split.code)
        else:
            to_left = np.isin(code, split.left)
        sides = rows[to_left], rows[~to_left]
        children = len(tree["f"]), len(tree["f"]) + 1
        small = int(len(sides[1]) < len(sides[0]))
        part = binned.histogram(sides[small], g, h)
        parts = (own - part, part) if small else (part, own - part)
        tree["f"][node], tree["l"][node], tree["r"][node] = split.column, *children
        if split.left is None:
            tree["t"][node], tree["m"][node] = float(binned.edges[split.column][split.code - 1]) if split.code else -np.inf, bool(split.nulls_left)
        else:  # the smaller side's values are listed; all others, unseen ones too, take the larger side
            held = np.unique(code[~to_left]) if small else split.left
            tree["c"][node] = [binned.names[split.column - binned.numeric][k] for k in held]
            tree["m"][node] = not small
        for k, child in enumerate(children):
            for name, value in (("f", -1), ("t", 0.0), ("c", []), ("l", 0), ("r", 0), ("m", False), ("v", 0.0)):
                tree[name].append(value)
            tree["depth"].append(tree["depth"][node] + 1)
            leaves[child] = sides[k]
            offer(child, parts[k])
    tree["depth"] = max(tree["depth"])
    return tree, list(leaves.items())


def boosted(rows: pd.DataFrame, label: str, numeric: Sequence[str], categories: Sequence[str],
            loss: Loss, growth: Growth) -> tuple[float, list[dict]]:
    """Start value and trees of one group; fewer trees when no split lowers the loss any more."""
    y = rows[label].to_numpy(np.float64)
    binned = Binned(rows, numeric, categories, growth.bins)
    start = loss.start(y)
    score, trees = np.full(len(y), start), []
    for _ in range(growth.trees):
        g, h = loss.slopes(y, score)
        tree, leaves = grow(binned, g, h, growth)
        if len(leaves) < 2:
            break
        for node, own in leaves:
            if loss.kind == "quantile":  # the exact quantile of what is left over
                value = np.quantile(y[own] - score[own], loss.alpha)
            else:
                value = -g[own].sum() / max(h[own].sum(), 1e-9)
            tree["v"][node] = float(growth.rate * value)
            score[own] += tree["v"][node]
        trees.append(tree)
    return start, trees


# ---- models ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Walk:
    """A tree over many rows at once."""

    f: np.ndarray
    t: np.ndarray
    c: list
    l: np.ndarray  # noqa: E741
    r: np.ndarray
    m: np.ndarray
    v: np.ndarray
    depth: int

    @classmethod
    def of(cls, row: Mapping) -> Walk:
        return cls(*[np.asarray(row[k]) for k in "ft"], [None if x is None else set(x) for x in row["c"]], *[np.asarray(row[k]) for k in "lrmv"], int(row["depth"]))

    def values(self, x: np.ndarray, coded: Sequence[tuple[np.ndarray, np.ndarray]], split: int) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        listed = {n: np.array([v in self.c[n] for v in coded[k - split][1]], bool) for n, k in enumerate(self.f.tolist()) if k >= split}
        for _ in range(self.depth):
            column = self.f[at]
            inner = np.flatnonzero(column >= 0)
            if not len(inner):
                break
            node, own = at[inner], column[inner]
            left = np.zeros(len(inner), bool)
            by_number = own < split
            k = np.flatnonzero(by_number)
            if len(k):
                value = x[inner[k], own[k]]
                left[k] = np.where(np.isnan(value), self.m[node[k]], value <= self.t[node[k]])
            for n in np.unique(node[~by_number]).tolist():
                k = np.flatnonzero(node == n)
                left[k] = listed[n][coded[self.f[n] - split][0][inner[k]]] == self.m[n]
            at[inner] = np.where(left, self.l[node], self.r[node])
        return self.v[at]


TREE = "f array<int>, t array<double>, c array<array<string>>, l array<int>, r array<int>, m array<boolean>, v array<double>"
COLUMNS = f"model string, loss string, part int, tree int, depth int, start double, {TREE}"


@dataclass(frozen=True)
class BoostedModels:
    """Models over the same inputs. trees: a row per tree, and one (tree -1) with each group's start value."""

    trees: DataFrame
    numeric: tuple[str, ...]
    categories: tuple[str, ...]
    log_link: frozenset[str]

    def value(self, model: str) -> Column:
        """A model as one value: its start and its trees, averaged over the groups it was fitted in."""
        own = self.trees.where(F.col("model") == model)
        parts = own.agg(F.count_distinct("part")).first()[0]
        if not parts:
            raise LookupError(f"no model {model}")
        grown = F.struct("part", "tree", "depth", "f", "t", "c", "l", "r", "m", "v")
        return own.agg(F.struct(
            (F.sum("start") / F.lit(parts)).alias("start"), F.lit(1.0 / parts).alias("weight"),
            F.array_sort(F.collect_list(F.when(F.col("tree") >= 0, grown))).alias("trees"))).scalar()

    def score(self, model: str, value: Column, inputs: Mapping[str, Column] | None = None) -> Column:
        """The prediction of a model, given as its value, from `inputs` (by default columns of the same names).

        A null number goes where the learner found nulls best placed, a name never seen with the larger side.
        """
        given = {c: F.col(f"`{c}`") for c in (*self.numeric, *self.categories)} | dict(inputs or {})
        numbers = F.array(*[given[c].cast("double") for c in self.numeric]) if self.numeric else F.array(F.lit(None).cast("double"))
        names = F.array(*[F.coalesce(given[c].cast("string"), F.lit("")) for c in self.categories]) if self.categories else F.array(F.lit(""))
        split = len(self.numeric)

        def step(tree: Column, node: Column) -> Column:
            column, marked = F.get(tree["f"], node), F.get(tree["m"], node)
            x = F.get(numbers, column)
            by_number = F.when(x.isNull() | F.isnan(x), marked).otherwise(x <= F.get(tree["t"], node))
            by_name = F.array_contains(F.get(tree["c"], node), F.get(names, column - split)) == marked
            left = F.when(column < split, by_number).otherwise(by_name)
            return F.when(column < 0, node).otherwise(
                F.when(left, F.get(tree["l"], node)).otherwise(F.get(tree["r"], node)))

        def leaf(tree: Column) -> Column:
            return F.get(tree["v"], F.aggregate(F.sequence(F.lit(1), tree["depth"]), F.lit(0), lambda n, _: step(tree, n)))

        total = value["start"] + F.aggregate(value["trees"], F.lit(0.0), lambda s, tree: s + leaf(tree)) * value["weight"]
        return F.exp(total) if model in self.log_link else total

    def with_scores(self, df: DataFrame, **columns: str) -> DataFrame:
        """df with the named models' predictions as expressions, so rows stay in Spark; an absent input is an error."""
        require_columns(df, [*self.numeric, *self.categories])
        held = {name: f"_{name}_trees" for name in columns}  # a value of its own first, as a fold may hold no subquery
        return df.withColumns({held[name]: self.value(model) for name, model in columns.items()}).withColumns(
            {name: self.score(model, F.col(held[name])) for name, model in columns.items()}).drop(*held.values())

    def predict(self, df: DataFrame, **columns: str) -> DataFrame:
        """df with the named models' predictions; an absent input is an error, never a silent default.

        The same values as `score` gives, for many rows: the trees are walked a batch of rows at a time.
        """
        require_columns(df, [*self.numeric, *self.categories])
        numbers = [F.col(f"`{c}`").cast("double") for c in self.numeric]
        names = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in self.categories]
        return df.withColumns({name: self._walker(model)(*numbers, *names) for name, model in columns.items()})

    def _walker(self, model: str):
        rows = self.trees.where(F.col("model") == model).orderBy("part", "tree").toPandas()
        parts, split = rows["part"].nunique(), len(self.numeric)
        if not parts:
            raise LookupError(f"no model {model}")
        starts = rows.loc[rows["tree"] < 0, "start"].sum() / parts
        trees = [Walk.of(r) for r in rows[rows["tree"] >= 0].to_dict("records")]  # as many as were fitted, whatever the rows
        log_link = model in self.log_link

        @F.pandas_udf("double")
        def walked(*columns: pd.Series) -> pd.Series:
            x = np.stack([c.to_numpy(np.float64) for c in columns[:split]], axis=1) if split else np.zeros((len(columns[0]), 0))
            y = np.stack([c.to_numpy(object) for c in columns[split:]], axis=1) if len(columns) > split else np.zeros((len(x), 0), object)
            total = np.full(len(x), starts)
            coded = [pd.factorize(y[:, k]) for k in range(y.shape[1])]
            for tree in trees:
                total += tree.values(x, coded, split) / parts
            return pd.Series(np.exp(total) if log_link else total)

        return walked

    def save(self, path: str) -> None:
        self.trees.write.mode("overwrite").parquet(f"{path}/trees")
        spark = self.trees.sparkSession
        spark.createDataFrame(
            [(list(self.numeric), list(self.categories), sorted(self.log_link))],
            "numeric array<string>, categories array<string>, log_link array<string>",
        ).write.mode("overwrite").parquet(f"{path}/inputs")


def load_boosted(spark: SparkSession, path: str) -> BoostedModels | None:
    """The saved models with their inputs, or None when there are none."""
    try:
        row = spark.read.parquet(f"{path}/inputs").first()
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise
    return BoostedModels(spark.read.schema(COLUMNS).parquet(f"{path}/trees"), tuple(row["numeric"]), tuple(row["categories"]),
                         frozenset(row["log_link"]))


def fit(
    training: DataFrame, label: Mapping[str, str] | str, numeric: Sequence[str], categories: Sequence[str],
    losses: Mapping[str, Loss], growth: Growth = Growth(),
) -> BoostedModels:
    """Fit one model per entry of `losses`, all side by side. `label` names their columns (or one for all).

    Rows without a label are left out; a model without rows is an error. Each group of rows is sorted before it
    is used, so a fit is the same on every run.
    """
    inputs = [*numeric, *categories]
    labels = {m: label if isinstance(label, str) else label[m] for m in losses}
    require_columns(training, [*inputs, *labels.values()])
    fed = F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"`{c}`").cast("double").alias("label")) for m, c in labels.items()])).alias("of")
    rows = cut_lineage(training.select(
        *[F.col(f"`{c}`").cast("double").alias(f"n{i}") for i, c in enumerate(numeric)],
        *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(categories)], fed,
    ).select("*", "of.*").drop("of").where(F.col("label").isNotNull()))
    parts = -(-rows.groupBy("model").count().agg(F.max("count")).first()[0] // growth.group_rows)
    own = [c for c in rows.columns if c != "model"]
    numbers, names = [c for c in own if c[0] == "n"], [c for c in own if c[0] == "c"]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        model, part = group["model"].iloc[0], int(group["part"].iloc[0])
        ordered = group.sort_values(own, kind="stable").reset_index(drop=True)
        start, trees = boosted(ordered, "label", numbers, names, losses[model], growth)
        empty = {"f": [], "t": [], "c": [], "l": [], "r": [], "m": [], "v": [], "depth": 0}
        return pd.DataFrame([
            {"model": model, "loss": losses[model].kind, "part": part, "tree": k, "start": start if k < 0 else None, **tree}
            for k, tree in enumerate([empty, *trees], -1)])[[c.split()[0] for c in COLUMNS.split(", ")]]

    dealt = rows.withColumn("part", F.pmod(F.xxhash64(*own), F.lit(parts)).cast("int"))
    trees = cut_lineage(dealt.groupBy("model", "part").applyInPandas(run, COLUMNS))
    return BoostedModels(trees, tuple(numeric), tuple(categories), frozenset(m for m, x in losses.items() if x.kind == "tweedie"))
