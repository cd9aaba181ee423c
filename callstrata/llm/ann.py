"""Nearest neighbours by inner product from balanced posting lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callstrata.llm.common import stored


#: Centroids a search goes on from, however far they are.
BEAM = 24


@dataclass(frozen=True)
class Settings:
    """sample_rows bounds the vectors the lists are fitted on; every vector is indexed.

    replicas: lists a vector may be in, if their centroids are within `boundary` times its nearest
    distance. reach: a query looks into the lists within `reach` times its nearest distance (but no
    less than the usual one). group_rows and query_rows bound what meets in one task at a time.
    """

    k: int = 20
    sample_rows: int = 24_576
    list_rows: int = 32
    most_lists: int = 2_048
    replicas: int = 8
    boundary: float = 1.15
    reach: float = 1.22
    degree: int = 16
    group_rows: int = 4_096
    query_rows: int = 2_048


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vec) of vectors that are neither null, empty nor zero, with finite components only, and of
    the commonest length (the longer of equally common ones)."""
    vec = F.col(vector).cast("array<float>")
    finite = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    good = vectors.where(
        F.col("vec_id").isNotNull() & (F.size(vector) > 0) & finite & F.exists(vec, lambda x: x != 0)
    ).select("vec_id", vec.alias("vec"))
    usual = good.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.where(F.size("vec") == (usual["d"] if usual else 0))


def first_copies(vectors: DataFrame, k: int) -> DataFrame:
    """Rows that can be among anyone's k nearest: of equal vectors the k + 1 smallest ids.

    All others lose every tie against k of these, so leaving them out changes no result. The
    limit applies before the shuffle as well, so a vector with very many copies does not pile up.
    """
    of_equal = W.partitionBy("vec").orderBy("vec_id")
    once = vectors.dropDuplicates(["vec_id", "vec"])
    return once.withColumn("copy", F.row_number().over(of_equal)).where(F.col("copy") <= k + 1).drop("copy")


@dataclass(frozen=True)
class Index:
    """Centroids (lengthened by one number), their neighbour graph, and the usual nearest distance."""

    centroids: np.ndarray
    edges: np.ndarray
    first_edge: np.ndarray
    entries: np.ndarray
    usual: float
    longest: float

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        """Inner products become distances: each vector gets the number that makes all equally long."""
        rest = np.sqrt(np.maximum(self.longest**2 - (vectors.astype(np.float64) ** 2).sum(axis=1), 0))
        return np.column_stack([vectors, rest]).astype(np.float32)

    def asked(self, queries: np.ndarray) -> np.ndarray:
        """A query's direction at the common length; its own length changes no order."""
        norm = np.linalg.norm(queries.astype(np.float64), axis=1, keepdims=True)
        return np.column_stack([queries / norm * self.longest, np.zeros(len(queries))]).astype(np.float32)

    def search(self, queries: np.ndarray, reach: float) -> np.ndarray:
        """Distances from queries to the centroids the graph search reached; infinite for others.

        From a few entries the search goes on from the nearest centroids seen, `BEAM` at least, and
        from all within `reach` times the nearest distance, until none of them has news.
        """
        count = len(self.centroids)
        distance = np.full((len(queries), count), np.inf, np.float32)
        distance[:, self.entries] = _distances(queries, self.centroids[self.entries])
        done = np.zeros(distance.shape, bool)
        while True:
            limit = reach * np.maximum(distance.min(axis=1), self.usual)
            if count > BEAM:
                limit = np.maximum(limit, np.partition(distance, BEAM - 1, axis=1)[:, BEAM - 1])
            q, node = np.nonzero((distance <= limit[:, None]) & ~done & np.isfinite(distance))
            if not len(q):
                return distance
            done[q, node] = True
            many = self.first_edge[node + 1] - self.first_edge[node]
            edge = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - self.first_edge[node], many)
            spots = np.repeat(q, many) * count + self.edges[edge]
            fresh = np.zeros(distance.size, bool)
            fresh[spots] = True
            spots = np.nonzero(fresh & np.isinf(distance.ravel()))[0]
            for at in range(0, len(spots), 100_000):
                some = spots[at: at + 100_000]
                gap = queries[some // count] - self.centroids[some % count]
                distance.ravel()[some] = np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(square, 0))


def fit(sample: np.ndarray, longest: float, lists: int, s: Settings) -> Index:
    """Lists on a sample: k-means whose crowded clusters take over the centroids of the emptiest."""
    rng = np.random.default_rng(5)
    nothing = np.zeros(0, np.int64)
    points = Index(sample, nothing, nothing, nothing, 0.0, longest).lengthened(sample)
    lists = max(1, min(lists, len(points)))
    centroids = points[rng.choice(len(points), lists, replace=False)]
    for turn in range(10):
        near = np.concatenate([
            _distances(points[a: a + 4096], centroids).argmin(axis=1) for a in range(0, len(points), 4096)])
        size = np.bincount(near, minlength=lists)
        total = np.zeros((lists, points.shape[1]))
        np.add.at(total, near, points)
        centroids = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centroids).astype(np.float32)
        crowded = np.argsort(-size, kind="stable")
        crowded = crowded[size[crowded] > 2 * len(points) / lists]
        spare = np.argsort(size, kind="stable")[: len(crowded)]
        if turn < 8:
            for full, empty in zip(crowded, spare, strict=False):
                if full != empty and size[empty] < size[full] / 4:
                    centroids[empty] = points[rng.choice(np.nonzero(near == full)[0])]
    degree = min(s.degree, lists)
    apart = _distances(centroids, centroids)
    close = np.argpartition(apart, degree - 1, axis=1)[:, :degree]
    far = rng.integers(0, lists, (lists, 2))  # a few long edges keep the graph in one piece
    own, other = np.repeat(np.arange(lists), degree + 2), np.column_stack([close, far]).ravel()
    pairs = np.unique(np.concatenate([own * lists + other, other * lists + own]))  # both ways
    first_edge = np.searchsorted(pairs, np.arange(lists + 1) * lists)
    usual = float(np.median(_distances(points[: 4096], centroids).min(axis=1)))
    entries = rng.choice(lists, min(lists, 32), replace=False)
    return Index(centroids, pairs % lists, first_edge, entries, usual, longest)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float32)


def memberships(index: Index, vectors: np.ndarray, s: Settings) -> list[list[int]]:
    """The lists of each vector, nearest first."""
    apart = _distances(index.lengthened(vectors), index.centroids)
    width = min(s.replicas, apart.shape[1])
    near = np.argpartition(apart, width - 1, axis=1)[:, :width]
    found = np.take_along_axis(apart, near, axis=1)
    order = found.argsort(axis=1, kind="stable")
    near, found = np.take_along_axis(near, order, axis=1), np.take_along_axis(found, order, axis=1)
    inside = found <= np.maximum(found[:, :1] * s.boundary, 1e-6)
    inside[:, 0] = True
    return [n[i].tolist() for n, i in zip(near, inside, strict=True)]


@dataclass(frozen=True)
class Sample:
    """The fitted vectors by list: what k of them reach in a query's lists bounds its k nearest from below."""

    ids: np.ndarray
    vectors: np.ndarray
    members: list[np.ndarray]

    def bound(self, number: int, query: np.ndarray, lists: np.ndarray, k: int) -> float:
        here = np.unique(np.concatenate([self.members[x] for x in lists]))
        here = here[self.ids[here] != number]
        if len(here) < k:
            return float("-inf")
        rough = self.vectors[here] @ query
        best = here[np.argpartition(rough, -k)[-k:]]
        # the least of k true scores, summed as the final scores are
        return float((query.astype(np.float64) * self.vectors[best].astype(np.float64)).sum(axis=1).min())


def nearest(vectors: DataFrame, is_query: Column, s: Settings = Settings(), vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): per query its s.k nearest by inner product, in double precision.

    Queries and candidates are rows of `vectors`; a query's own vec_id is no candidate. Score ties go
    to the smaller vec_id. Rows that share a vec_id are one candidate with its best score, and one
    query, of their least vector. Vectors that are null, zero, of odd length or hold null or non-finite components take no part. Fewer
    candidates than k are all returned; no vectors give no rows. Only vec_id and the vector are read.

    Every vector is indexed, boundary vectors in several lists. Lists near each other form groups;
    a large group's vectors and a popular group's queries are dealt out in blocks of bounded size.
    """
    spark = vectors.sparkSession
    good = stored(usable(vectors, vector))
    queries = good.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    rows = stored(first_copies(good, s.k))
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(squares).alias("m")).first()
    if not facts["n"]:
        return good.selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "0D AS score").limit(0)
    share = min(1.0, s.sample_rows / facts["n"])
    place = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30))
    # the share keeps the sample near its bound; the limit makes the bound hold
    picked = rows.where(place <= int(share * (1 << 30))).orderBy(place, "vec_id").select("vec_id", "vec").limit(s.sample_rows)
    taken = {r["vec_id"]: np.array(r["vec"], np.float32) for r in picked.collect()}
    drawn = np.stack(list(taken.values()))
    fitted = fit(drawn, float(np.sqrt(facts["m"])), min(s.most_lists, facts["n"] // s.list_rows), s)
    members: list[list[int]] = [[] for _ in fitted.centroids]
    for at in range(0, len(drawn), 2_048):
        for i, lists in enumerate(memberships(fitted, drawn[at: at + 2_048], s), at):
            for x in lists:
                members[x].append(i)
    index = spark.sparkContext.broadcast(fitted)
    known = spark.sparkContext.broadcast(
        Sample(np.array(list(taken)), drawn, [np.array(m, np.int32) for m in members]))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2_048):
                part = batch.slice(at, 2_048)
                found = memberships(own, _matrix(part.column(1)), s)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.list_(pa.int32()))], ["vec_id", "vec", "lists"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    posted = stored(rows.mapInArrow(assign, f"vec_id {kind}, vec array<float>, lists array<int>"))
    count = len(index.value.centroids)
    sizes, primary = np.zeros(count, np.int64), np.zeros(count, np.int64)
    for r in posted.select(F.posexplode("lists").alias("p", "l")).groupBy("l").agg(
            F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("p") == 0, 1)).alias("own")).collect():  # a row per list
        sizes[r["l"]], primary[r["l"]] = r["n"], r["own"]
    group = grouped(index.value, sizes, s.group_rows)
    rows_in = np.bincount(group, weights=sizes)
    splits = np.maximum(1, np.ceil(rows_in / s.group_rows)).astype(np.int64)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                plain, numbers = _matrix(part.column(1)), part.column(0).to_pylist()
                asked = own.asked(plain)
                apart = own.search(asked, s.reach)
                limit = s.reach * np.maximum(apart.min(axis=1), own.usual)
                lists, bounds = [], []
                for i in range(len(asked)):
                    chosen = np.nonzero(apart[i] <= limit[i])[0]
                    chosen = chosen[np.argsort(apart[i][chosen], kind="stable")]
                    if primary[chosen].sum() < 2 * s.k + 2:  # too few vectors: go on by distance
                        order = np.argsort(_distances(asked[i: i + 1], own.centroids)[0], kind="stable")
                        enough = np.searchsorted(np.cumsum(primary[order]), 2 * s.k + 2) + 1
                        chosen = order[: max(enough, len(chosen))]
                    lists.append(chosen.tolist())
                    bounds.append(known.value.bound(numbers[i], plain[i], chosen, s.k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lists, pa.list_(pa.int32())), pa.array(bounds, pa.float64())],
                    ["vec_id", "vec", "lists", "bound"])

    asked = stored(queries.select("vec_id", "vec").mapInArrow(
        probe, f"vec_id {kind}, vec array<float>, lists array<int>, bound double"))
    map_group = F.array(*[F.lit(int(g)) for g in group])
    to_groups = F.array_distinct(F.transform("lists", lambda x: F.get(map_group, x)))
    blocks = np.ones(len(splits), np.int64)
    for r in asked.select(F.explode(to_groups).alias("g")).groupBy("g").count().collect():  # a row per group
        blocks[r["g"]] = -(-r["count"] // s.query_rows)

    def deal(query_side: bool):
        """Rows or queries once per block they meet in: (g, a, b), a of a group's rows, b of its queries."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                source, out = [], []
                for i, (number, lists) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                    own: dict[int, list[int]] = {}
                    for x in lists:
                        own.setdefault(int(group[x]), []).append(x)
                    for g, inside in own.items():
                        sub = range(splits[g]) if query_side else (hash_of(number, splits[g]),)
                        block = (hash_of(number, blocks[g]),) if query_side else range(blocks[g])
                        for a in sub:
                            for b in block:
                                source.append(i)
                                out.append((g, a, b, inside))
                    if len(out) > 20_000:
                        yield dealt(batch, source, out)
                        source, out = [], []
                if out:
                    yield dealt(batch, source, out)

        return run

    def dealt(batch, source, out):
        where = pa.array(source)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(where), batch.column(1).take(where), batch.column(3).take(where),
             *[pa.array([o[k] for o in out], pa.int32()) for k in range(3)], pa.array([o[3] for o in out], pa.list_(pa.int32()))],
            ["vec_id", "vec", "bound", "g", "a", "b", "lists"])

    schema = f"vec_id {kind}, vec array<float>, bound double, g int, a int, b int, lists array<int>"

    sides = [
        df.select("vec_id", "vec", "lists", "bound").mapInArrow(deal(side), schema).groupBy("g", "a", "b")
        for side, df in ((True, asked), (False, posted.withColumn("bound", F.lit(0.0))))]
    best = sides[0].cogroup(sides[1]).applyInPandas(scan(s.k), f"query_id {kind}, vec_id {kind}, score double")
    first = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= s.k).select(
        "query_id", "rank", "vec_id", "score")


def hash_of(number: int, parts: int) -> int:
    return (number * 0x9E3779B97F4A7C15 >> 20) % int(parts)


def grouped(index: Index, sizes: np.ndarray, group_rows: int) -> np.ndarray:
    """Group of each list: walk from list to nearest list not yet taken, closing a group when it is full."""
    group, left = np.zeros(len(sizes), np.int64), np.ones(len(sizes), bool)
    at, number, held = 0, 0, 0
    for _ in range(len(sizes)):
        left[at] = False
        if held and held + sizes[at] > group_rows:
            number, held = number + 1, 0
        group[at] = number
        held += sizes[at]
        if left.any():
            rest = np.nonzero(left)[0]
            at = rest[_distances(index.centroids[at: at + 1], index.centroids[rest])[0].argmin()]
    return group


def scan(k: int):
    """Best k candidates of each query among the vectors of the lists it asks for, in one block, if
    they reach the query's bound."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if not len(queries) or not len(rows):
            return empty
        vectors = np.stack(rows["vec"].to_numpy()).astype(np.float64)
        asked = np.stack(queries["vec"].to_numpy()).astype(np.float64)
        ids, numbers, bounds = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy(), queries["bound"].to_numpy()
        lists = sorted({x for own in rows["lists"] for x in own} | {x for own in queries["lists"] for x in own})
        where = {x: i for i, x in enumerate(lists)}
        holds, wants = np.zeros((len(rows), len(lists)), np.float32), np.zeros((len(queries), len(lists)), np.float32)
        for table, column in ((holds, rows["lists"]), (wants, queries["lists"])):
            for i, own in enumerate(column):
                table[i, [where[x] for x in own]] = 1
        out = []
        for at in range(0, len(asked), 256):
            score = asked[at: at + 256] @ vectors.T
            met = (wants[at: at + 256] @ holds.T > 0) & (ids[None, :] != numbers[at: at + 256, None])
            score[~met] = -np.inf
            least = bounds[at: at + 256]
            if score.shape[1] > k:
                least = np.maximum(least, np.partition(score, -k, axis=1)[:, -k])
            # a hair below, so that rounding loses no tie
            near = least - 1e-9 * (1 + np.abs(np.where(met, score, 0)).max(axis=1))
            q, v = np.nonzero(met & (score >= near[:, None]))
            exact = (asked[at + q] * vectors[v]).sum(axis=1)
            reached = exact >= bounds[at + q]
            part = pd.DataFrame({"query_id": numbers[at + q], "vec_id": ids[v], "score": exact})[reached]
            part = part.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True], kind="stable")
            out.append(part.groupby("query_id").head(k))
        return pd.concat(out) if out else empty

    return run
