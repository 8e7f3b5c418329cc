"""Nearest neighbours by inner product with vantage-point trees over cells of vectors.

One more coordinate makes all vectors equally long, which turns the largest inner
product into the smallest Euclidean distance. A bounded sample of vectors gives
outer vantage points; every vector belongs to the cell of its nearest one, and
each cell knows its least and largest distance to every point. Large cells are cut
into shards by id. A shard builds a tree: a node's vantage point divides its
vectors at the median distance.

A query is answered in its own cell first. With the worst of the neighbours found
it goes to those other cells only whose distance bound, by the triangle
inequality, times ``factor`` is not above it; in a tree, branches are left out by
the same rule. Factor 1 is exact, larger factors look at fewer cells and branches.
The best of all cells are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.sources.sinks import materialise

SHARD_ROWS = 16_384
CELL_ROWS = 4096  # rows for each outer vantage point, as long as there are no more than MOST_POINTS
MOST_POINTS = 256
LEAF = 256
_BLOCK = 1024
_SLACK = 1e-9


@dataclass
class Node:
    rows: np.ndarray | None = None  # of a leaf
    point: np.ndarray | None = None
    median: float = 0.0
    near: Node | None = None
    far: Node | None = None
    near_range: tuple[float, float] = (0.0, 0.0)
    far_range: tuple[float, float] = (0.0, 0.0)


class Tree:
    """Index of the distinct vectors of a shard. ``ids`` and ``vectors`` may repeat; equal pairs count once."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, keep: int, seed: int = 1):
        self.vectors, copy = np.unique(vectors.astype(np.float64), axis=0, return_inverse=True)
        order = np.lexsort((ids, copy.ravel()))
        ids, copy = ids[order], copy.ravel()[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (ids[1:] != ids[:-1]) | (copy[1:] != copy[:-1])
        ids, copy = ids[fresh], copy[fresh]
        first = np.searchsorted(copy, np.arange(len(self.vectors)))
        place = np.arange(len(ids)) - first[copy]
        self.copies = np.full((len(self.vectors), keep), -1, np.int64)  # the smallest ids of each vector suffice
        self.has = np.zeros(self.copies.shape, bool)
        some = place < keep
        self.copies[copy[some], place[some]] = ids[some]
        self.has[copy[some], place[some]] = True
        squares = (self.vectors**2).sum(1)
        self.radius2 = float(squares.max(initial=0.0))
        self.points = np.concatenate([self.vectors, np.sqrt(np.maximum(self.radius2 - squares, 0))[:, None]], axis=1)
        self.random = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(self.vectors)))

    def _build(self, rows: np.ndarray) -> Node:
        if len(rows) <= LEAF:
            return Node(rows=rows)
        point = self.points[rows[self.random.integers(len(rows))]]
        distance = np.sqrt(((self.points[rows] - point) ** 2).sum(1))
        median = float(np.median(distance))
        near = distance <= median
        if near.all():  # the outer half lies on the median: cut just below it
            near = distance < median
            if not near.any():
                return Node(rows=rows)
        a, b = distance[near], distance[~near]
        return Node(
            point=point, median=median, near=self._build(rows[near]), far=self._build(rows[~near]),
            near_range=(a.min(), a.max()), far_range=(b.min(), b.max()),
        )

    def search(
        self, queries: np.ndarray, names: np.ndarray, k: int, factor: float, floor: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the ``k`` best distinct vectors of each query and their inner products, best first; row -1 if fewer.

        Vectors that only the query's own id in ``names`` has are left out, however
        many there are. Ties go to the vector with the smallest other id. Vectors with
        products below a query's ``floor`` may be left out.
        """
        self.floor = np.full(len(queries), -np.inf) if floor is None else floor - _SLACK * (1 + np.abs(floor))
        self.names = names
        self.queries = queries.astype(np.float64)
        self.lengths = (self.queries**2).sum(1) + self.radius2
        self.scores = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), -1, np.int64)
        self._visit(self.root, np.arange(len(queries)), factor)
        return self.found, self.scores

    def _worst(self, active: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.lengths[active] - 2 * self._least(active), 0))

    def _least(self, active: np.ndarray) -> np.ndarray:
        """The product that a vector must reach to count."""
        return np.maximum(self.scores[active, -1], self.floor[active])

    def _visit(self, node: Node, active: np.ndarray, factor: float) -> None:
        if not len(active):
            return
        if node.rows is not None:
            self._leaf(node.rows, active)
            return
        own = self.queries[active]
        inner = own @ node.point[:-1]
        distance = np.sqrt(np.maximum(self.lengths[active] - self.radius2 + (node.point**2).sum() - 2 * inner, 0))
        close = distance <= node.median
        sides = ((node.near, node.near_range), (node.far, node.far_range))
        for chosen, order in ((close, sides), (~close, sides[::-1])):
            for child, (low, high) in order:
                some = np.flatnonzero(chosen)
                bound = np.maximum(distance[some] - high, low - distance[some])
                open_ = factor * bound <= self._worst(active[some]) + _SLACK * (1 + distance[some])
                self._visit(child, active[some[open_]], factor)

    def _leaf(self, rows: np.ndarray, active: np.ndarray) -> None:
        k = self.scores.shape[1]
        products = self.queries[active] @ self.vectors[rows].T
        useful = (products >= self._least(active)[:, None]).any(1)
        if not useful.all():
            active, products = active[useful], products[useful]
        if not len(active):
            return
        scores = np.concatenate([self.scores[active], products], axis=1)
        found = np.concatenate([self.found[active], np.broadcast_to(rows, (len(active), len(rows)))], axis=1)
        smallest = np.where(found >= 0, self.copies[found, 0], np.iinfo(np.int64).max)
        own = np.nonzero((found >= 0) & (smallest == self.names[active][:, None]))
        if len(own[0]):
            shared = self.has[found[own], 1]
            smallest[own] = np.where(shared, self.copies[found[own], 1], np.iinfo(np.int64).max)
            alone = own[0][~shared], own[1][~shared]
            scores[alone], found[alone] = -np.inf, -1
        best = np.lexsort((smallest, -scores), axis=1)[:, :k]
        self.scores[active] = np.take_along_axis(scores, best, 1)
        self.found[active] = np.take_along_axis(found, best, 1)


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass
class Outer:
    """Outer vantage points by vector length, and what each cell is from each point: least and largest distance."""

    points: dict[int, np.ndarray]
    radius2: float
    low: dict[int, np.ndarray] | None = None
    high: dict[int, np.ndarray] | None = None

    def of_vectors(self, vectors: np.ndarray) -> np.ndarray:
        """Distances of vectors, made equally long, to the points."""
        points = self.points[vectors.shape[1]]
        extra, theirs = (np.sqrt(np.maximum(self.radius2 - (x**2).sum(1), 0)) for x in (vectors, points))
        return np.sqrt(np.maximum(2 * self.radius2 - 2 * (vectors @ points.T + np.outer(extra, theirs)), 0))

    def of_queries(self, queries: np.ndarray) -> np.ndarray:
        lengths = (queries**2).sum(1)[:, None] + self.radius2
        return np.sqrt(np.maximum(lengths - 2 * (queries @ self.points[queries.shape[1]].T), 0))

    def open_cells(self, queries: np.ndarray, floor: np.ndarray, factor: float) -> np.ndarray:
        """For each query which cells may hold a vector whose product reaches its floor."""
        dim = queries.shape[1]
        distance = self.of_queries(queries)
        worst = np.sqrt(np.maximum((queries**2).sum(1) + self.radius2 - 2 * floor, 0))
        bound = np.zeros(distance.shape)
        for low, high, own in zip(self.low[dim].T, self.high[dim].T, distance.T):  # one point after the other
            bound = np.maximum(bound, np.maximum(own[:, None] - high, low - own[:, None]))
        return factor * bound <= worst[:, None] + _SLACK * (1 + np.sqrt(self.radius2) + worst[:, None])


def _blocks(part: pa.RecordBatch, dims: np.ndarray, vectors: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and vectors of each group of equally long vectors."""
    column = part.column(vectors)
    for dim in np.unique(dims).tolist():
        some = np.flatnonzero(dims == dim)
        yield dim, some, column.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False).reshape(len(some), dim).astype(np.float64)


def _assigned(rows: DataFrame, outer: Outer) -> DataFrame:
    """``cell`` and, for queries, ``home`` of each row (-1 without points of its length); rows without ``key`` have a cell's
    least and largest distance to a point, as far as one task knows it.
    """
    schema = rows.select("*").schema  # a new object, as it is added to
    for name, kind in (("cell", "integer"), ("home", "integer"), ("point", "integer"), ("low", "double"), ("high", "double")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = {d: np.full((len(p), len(p)), np.inf) for d, p in outer.points.items()}
        high = {d: np.full((len(p), len(p)), -np.inf) for d, p in outer.points.items()}
        kinds = None
        for batch in batches:
            kinds = batch.schema
            for first in range(0, batch.num_rows, 4 * _BLOCK):
                part = batch.slice(first, 4 * _BLOCK)
                dims = part.column(0).to_numpy(zero_copy_only=False)
                cell, home = np.full(len(dims), -1, np.int32), np.full(len(dims), -1, np.int32)
                for dim, some, block in _blocks(part, dims, 3):
                    if dim not in outer.points:
                        continue
                    distance = outer.of_vectors(block)
                    cell[some] = distance.argmin(1)
                    home[some] = outer.of_queries(block).argmin(1)
                    for c in np.unique(cell[some]).tolist():
                        own = distance[cell[some] == c]
                        low[dim][c] = np.minimum(low[dim][c], own.min(0))
                        high[dim][c] = np.maximum(high[dim][c], own.max(0))
                n = len(dims)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell), pa.array(home), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64())],
                    [*part.schema.names, "cell", "home", "point", "low", "high"])
        for dim in low if kinds is not None else ():
            cell, point = (x.astype(np.int32) for x in np.nonzero(np.isfinite(low[dim])))
            n = len(cell)
            empty = {f.name: pa.nulls(n, f.type) for f in kinds} | {"dim": pa.array(np.full(n, dim, np.int32))}
            yield pa.RecordBatch.from_arrays(
                [*(empty[f.name] for f in kinds), pa.array(cell), pa.nulls(n, pa.int32()), pa.array(point),
                 pa.array(low[dim][cell, point]), pa.array(high[dim][cell, point])],
                [*kinds.names, "cell", "home", "point", "low", "high"])

    return rows.mapInArrow(run, schema)


def _routed(queries: DataFrame, outer: Outer, factor: float) -> DataFrame:
    """A row for each query and other cell that it must visit; ``queries`` has dim, key, id, v, home, floor (null: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(first, _BLOCK)
                dims, home = (part.column(c).to_numpy(zero_copy_only=False) for c in (0, 4))
                floor = part.column(5).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                for dim, some, block in _blocks(part, dims, 3):
                    if dim not in outer.points:
                        continue
                    open_ = outer.open_cells(block, floor[some], factor)
                    open_[np.arange(len(some)), home[some]] = False
                    query, cell = np.nonzero(open_)
                    yield pa.RecordBatch.from_arrays(
                        [*part.take(pa.array(some[query])).columns, pa.array(cell.astype(np.int32))], [*part.schema.names, "cell"])

    return queries.mapInArrow(run, queries.select("*").schema.add("cell", "integer"))


def neighbours(
    table: DataFrame, is_query: Column, k: int = 20, factor: float = 1.0, id: str = "vec_id", vector: str = "embedding",
    shard_rows: int = SHARD_ROWS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """The ``k`` nearest rows of ``table`` (ids are whole numbers) for each of its rows that meets ``is_query``, by largest inner product.

    Returns ``query_id``, ``rank`` (from 1), ``id`` and ``score`` (in double
    precision); fewer rows if there are fewer candidates; ties go to the smaller
    id. Rows without id and vectors that are null, empty, zero or hold null or
    non-finite components take no part. Repeated rows count once, and a row
    with the query's id is never its neighbour; different vectors under one
    query id are answered one by one. Vectors of different lengths are not
    compared. Only ids and vectors are read, and all rows are indexed.

    There is an outer vantage point for each ``cell_rows`` rows, ``MOST_POINTS`` at most (the
    sample), and shards hold about ``shard_rows`` rows at most, whatever their number.
    """
    rows = table.withColumn("_q", F.coalesce(is_query, F.lit(False)))
    rows = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"), "_q")
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("v"))).groupBy("id", "v").agg(F.max("_q").alias("q"))
    rows = materialise(rows.select(F.size("v").alias("dim"), F.xxhash64("id", "v").alias("key"), "id", "v", "q"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(squares).alias("radius2")).first()
    sample = rows.orderBy("key", "id").limit(max(1, min(MOST_POINTS, seen["n"] // cell_rows))).select("v").collect()
    points: dict[int, list] = {}
    for r in sample:
        points.setdefault(len(r["v"]), []).append(r["v"])
    outer = Outer({d: np.array(p, np.float64) for d, p in points.items()}, seen["radius2"] or 0.0)

    placed = materialise(_assigned(rows, outer))
    vectors = placed.filter("key IS NOT NULL").drop("point", "low", "high")
    limits = placed.filter("key IS NULL").groupBy("dim", "cell", "point").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    outer.low, outer.high = ({d: np.full((len(p), len(p)), start) for d, p in outer.points.items()} for start in (np.inf, -np.inf))
    for r in limits:  # at most MOST_POINTS squared
        outer.low[r["dim"]][r["cell"], r["point"]] = r["low"]
        outer.high[r["dim"]][r["cell"], r["point"]] = r["high"]
    counts = vectors.filter("cell >= 0").groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"))
    rest = max(1, -(-seen["n"] // shard_rows))  # for vectors of lengths without points
    shards = F.coalesce("shards", F.lit(rest)).cast("int")
    counts = materialise(counts)  # at most MOST_POINTS rows
    name = F.pmod(F.xxhash64("id"), shards).cast("int").alias("shard")
    no_floor = F.lit(None).cast("double").alias("floor")
    stored = vectors.join(F.broadcast(counts), ["dim", "cell"], "left").select("dim", "cell", name, F.lit(1).alias("kind"), "key", "id", "v", no_floor)

    def visits(asked: DataFrame) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0), shards - 1)).alias("shard")
        return asked.join(F.broadcast(counts), ["dim", "cell"], "left").select("dim", "cell", each, F.lit(2).alias("kind"), "key", "id", "v", "floor")

    queries = vectors.filter("q").select("dim", "key", "id", "v", "home")
    first = materialise(_searched(stored, visits(queries.withColumn("cell", F.col("home")).withColumn("floor", F.lit(None).cast("double"))), k, factor))
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("key", "query_id").orderBy(F.desc("score"), "found")))
    floors = best.filter(F.col("rank") == k).select("key", F.col("query_id").alias("id"), F.col("score").alias("floor"))
    waiting = queries.filter("home >= 0").join(floors, ["key", "id"], "left").select("dim", "key", "id", "v", "home", "floor")
    others = _searched(stored, visits(_routed(waiting, outer, factor)), k, factor)
    rank = F.row_number().over(Window.partitionBy("key", "query_id").orderBy(F.desc("score"), "found"))
    return first.unionByName(others).withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("found").alias(id), "score"
    )


def _searched(stored: DataFrame, asked: DataFrame, k: int, factor: float) -> DataFrame:
    """What each shard has for the queries that visit it; shards without queries build no tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vectors, tree = None, [], [], None
        for batch in batches:
            for first in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(first, _BLOCK)
                dim, cell, shard, kind, key, name = (part.column(c).to_numpy(zero_copy_only=False) for c in range(6))
                floor = part.column(7).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                places = np.stack([dim, cell, shard, kind], axis=1)
                cuts = np.flatnonzero((places[1:] != places[:-1]).any(1)) + 1
                for a, b in zip([0, *cuts], [*cuts, len(places)]):
                    if at != (dim[a], cell[a], shard[a]):
                        at, ids, vectors, tree = (dim[a], cell[a], shard[a]), [], [], None
                    flat = part.column(6).slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
                    block = flat.reshape(b - a, int(dim[a]))
                    if kind[a] == 1:
                        ids.append(name[a:b])
                        vectors.append(block)
                        continue
                    if not ids and tree is None:
                        continue  # no vectors in the shard
                    if tree is None:
                        tree = Tree(np.concatenate(ids), np.concatenate(vectors), k + 1)
                        ids, vectors = [], []
                    yield _answers(tree, key[a:b], name[a:b], block, k, factor, floor[a:b])

    schema = "key bigint, query_id bigint, found bigint, score double"
    placed = stored.unionByName(asked).repartition("dim", "cell", "shard").sortWithinPartitions("dim", "cell", "shard", "kind")
    return placed.mapInArrow(run, schema)


def _answers(tree: Tree, keys, names, queries, k: int, factor: float, floor: np.ndarray) -> pa.RecordBatch:
    rows, _ = tree.search(queries, names, k + 1, factor, floor)  # one more, as scores are added up in order only below
    out: list[tuple] = []
    for q, (key, name) in enumerate(zip(keys, names)):
        some = rows[q][rows[q] >= 0]
        if not len(some):
            continue
        products = tree.vectors[some] * queries[q].astype(np.float64)
        scores = np.repeat(products.cumsum(1)[:, -1], tree.copies.shape[1])  # added up in order, like a plain loop
        ids, has = tree.copies[some].ravel(), tree.has[some].ravel() & (tree.copies[some].ravel() != name)
        has &= scores >= floor[q] - _SLACK * (1 + abs(floor[q])) if np.isfinite(floor[q]) else True  # the others have k better ones
        ids, scores = ids[has], scores[has]
        best = np.lexsort((ids, -scores))[:k]
        out.append((np.full(len(best), key), np.full(len(best), name), ids[best], scores[best]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "query_id", "found", "score"])
