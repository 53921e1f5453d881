"""Exact top-k by inner product with M-trees.

Vectors of whole numbers get one more coordinate that makes all of them equally long,
so that the largest inner product is the smallest distance, and distance is a metric.
Vectors are dealt to shards of bounded size; each shard becomes one M-tree of paged
nodes, each with a centre, a covering radius and the distance to its parent's centre.
Every block of queries then searches every shard best first. Stored distances and the
triangle inequality spare nodes and entries that cannot reach the query's k-th score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorstar.llm.common import stored

# Vectors of one shard, queries of one block, entries of one page, pages of one node.
SHARD = 8192
BLOCK = 1024
PAGE = 192
FANOUT = 16
# Slack for rounding in distances; scores are whole numbers.
SLACK = 1e-6

NODES = (
    "shard bigint, node int, parent int, leaf boolean, centre array<bigint>, radius double, to_parent double, "
    "longest bigint, ids array<bigint>, entries array<bigint>, to_centre array<double>"
)
HITS = "query_id bigint, vec_id bigint, score bigint"


def whole_numbers(embedding: str) -> Column:
    """``floor(64 * x)`` of each component; NULL if any is null or not finite."""
    component = F.transform(embedding, lambda x: x.cast("double"))
    bad = F.exists(component, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(component, lambda x: F.floor(F.lit(64.0) * x)))


def _matrix(rows: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of any length, filled up with zeros."""
    found = np.zeros((len(rows), width), np.int64)
    for n, row in enumerate(rows):
        values = row.values.to_numpy(zero_copy_only=False)
        found[n, : len(values)] = values
    return found


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products: by floats where every sum is a whole number they can hold."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _extra(squares: np.ndarray, longest: int) -> np.ndarray:
    return np.sqrt(np.maximum(longest - squares, 0).astype(np.float64))


class _Builder:
    """One shard's vectors as nodes, split by the nearest of a few pivots."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int) -> None:
        self.ids, self.vectors = ids, vectors
        self.squares = (vectors * vectors).sum(axis=1)
        self.longest = int(self.squares.max(initial=0))
        self.extra = _extra(self.squares, self.longest)
        self.random = np.random.default_rng(seed)
        self.nodes: list[dict] = []

    def distances(self, rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        inner = _dot(self.vectors[rows], self.vectors[pivots])
        plain = self.squares[rows][:, None] + self.squares[pivots][None, :] - 2 * inner
        return np.sqrt(np.maximum(plain, 0) + (self.extra[rows][:, None] - self.extra[pivots][None, :]) ** 2)

    def build(self) -> list[dict]:
        everything = np.arange(len(self.ids))
        todo = [(everything, 0, -1)]
        while todo:
            rows, pivot, parent = todo.pop()
            number = len(self.nodes)
            to_centre = self.distances(rows, np.array([pivot]))[:, 0]
            above = self.nodes[parent]["pivot"] if parent >= 0 else pivot
            to_parent = float(self.distances(np.array([pivot]), np.array([above]))[0, 0])
            leaf = len(rows) <= PAGE
            self.nodes.append(
                {
                    "node": number,
                    "parent": parent,
                    "leaf": leaf,
                    "pivot": pivot,
                    "radius": float(to_centre.max(initial=0)),
                    "to_parent": to_parent,
                    "rows": rows if leaf else rows[:0],
                    "to_centre": to_centre if leaf else to_centre[:0],
                }
            )
            if not leaf:
                todo += [(part, int(centre), number) for centre, part in self._split(rows)]
        return self.nodes

    def _split(self, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        fanout = min(FANOUT, -(-len(rows) // PAGE) + 1)
        pivots = self.random.choice(rows, fanout, replace=False)
        nearest = self.distances(rows, pivots).argmin(axis=1)
        parts = [(pivots[n], rows[nearest == n]) for n in range(fanout) if (nearest == n).any()]
        if max(len(part) for _, part in parts) > 0.9 * len(rows):
            cut = np.array_split(rows, fanout)  # equal vectors: no pivot tells them apart
            return [(part[0], part) for part in cut if len(part)]
        return parts


def _build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The nodes of one shard. Of rows that repeat an id, the smallest vector stays."""
    width = max((len(v) for v in table.column("vector")), default=0)
    vectors = _matrix(table.column("vector"), width)
    ids = table.column("vec_id").to_numpy()
    order = np.lexsort((*vectors.T[::-1], ids))
    order = order[np.concatenate(([True], ids[order][1:] != ids[order][:-1]))]
    shard = key[0].as_py()
    builder = _Builder(ids[order], vectors[order], shard)
    nodes = builder.build()
    long_list = pa.list_(pa.int64())
    return pa.table(
        {
            "shard": pa.array([shard] * len(nodes), pa.int64()),
            "node": pa.array([n["node"] for n in nodes], pa.int32()),
            "parent": pa.array([n["parent"] for n in nodes], pa.int32()),
            "leaf": pa.array([n["leaf"] for n in nodes]),
            "centre": pa.array([builder.vectors[n["pivot"]] for n in nodes], long_list),
            "radius": pa.array([n["radius"] for n in nodes], pa.float64()),
            "to_parent": pa.array([n["to_parent"] for n in nodes], pa.float64()),
            "longest": pa.array([builder.longest] * len(nodes), pa.int64()),
            "ids": pa.array([builder.ids[n["rows"]] for n in nodes], long_list),
            "entries": pa.array([builder.vectors[n["rows"]].ravel() for n in nodes], long_list),
            "to_centre": pa.array([n["to_centre"] for n in nodes], pa.list_(pa.float64())),
        }
    )


class _Search:
    """All queries of a block in one tree, each best first: in every round a query
    opens the nearest node on its list, and queries that open the same node share
    the products."""

    def __init__(self, nodes: pa.Table, query_ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        order = np.argsort(nodes.column("node").to_numpy())
        nodes = nodes.take(order)
        self.k, self.query_ids, self.queries = k, query_ids, queries
        width = queries.shape[1]
        self.leaf = nodes.column("leaf").to_pylist()
        self.radius, self.to_parent = (nodes.column(c).to_numpy() for c in ("radius", "to_parent"))
        self.centres = _matrix(nodes.column("centre"), width)
        self.longest = nodes.column("longest")[0].as_py()
        self.ids = [x.values.to_numpy() for x in nodes.column("ids")]
        own = len(nodes.column("centre")[0].values)
        self.entries = []
        for found, ids in zip(nodes.column("entries"), self.ids, strict=True):
            page = np.zeros((len(ids), width), np.int64)
            page[:, :own] = found.values.to_numpy().reshape(len(ids), own) if own else 0
            self.entries.append(page)
        self.to_centre = [x.values.to_numpy() for x in nodes.column("to_centre")]
        self.children: list[list[int]] = [[] for _ in self.leaf]
        for node, parent in enumerate(nodes.column("parent").to_pylist()):
            if parent >= 0:
                self.children[parent].append(node)
        squares = (queries * queries).sum(axis=1)
        #: A query stands at height 0 of the further coordinate: score = (base - distance^2) / 2.
        self.base = (squares + self.longest).astype(np.float64)
        self.scores = np.full((len(queries), k), np.iinfo(np.int64).min)
        self.best = np.full((len(queries), k), -1, np.int64)

    def _distance(self, rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.base[rows][:, None] - 2.0 * _dot(self.queries[rows], points), 0))

    def _reach(self, rows: np.ndarray, nearest: np.ndarray) -> np.ndarray:
        """Whether something this near could enter the best k (a tie could)."""
        bound = (self.base[rows][:, None] - np.maximum(nearest - SLACK, 0) ** 2) / 2
        return bound + SLACK >= self.scores[rows, -1][:, None]

    def run(self) -> pa.Table:
        count = len(self.queries)
        waiting = np.full((count, len(self.leaf)), np.inf)
        near = np.zeros((count, len(self.leaf)))
        everyone = np.arange(count)
        near[:, 0] = self._distance(everyone, self.centres[:1])[:, 0]
        waiting[:, 0] = np.maximum(near[:, 0] - self.radius[0], 0)
        while len(everyone):
            node = waiting[everyone].argmin(axis=1)
            nearest = waiting[everyone, node]
            going = np.isfinite(nearest)
            going[going] = self._reach(everyone[going], nearest[going][:, None])[:, 0]
            everyone, node = everyone[going], node[going]
            waiting[everyone, node] = np.inf
            order = np.argsort(node, kind="stable")
            for rows in np.split(everyone[order], np.flatnonzero(np.diff(node[order])) + 1) if len(order) else []:
                opened = int(node[np.searchsorted(everyone, rows[0])])
                if self.leaf[opened]:
                    self._open_page(rows, opened, near[rows, opened])
                else:
                    self._open_node(rows, opened, near, waiting)
        hits = self.best >= 0
        return pa.table(
            {
                "query_id": pa.array(np.repeat(self.query_ids, hits.sum(axis=1)), pa.int64()),
                "vec_id": pa.array(self.best[hits], pa.int64()),
                "score": pa.array(self.scores[hits], pa.int64()),
            }
        )

    def _open_node(self, rows: np.ndarray, node: int, near: np.ndarray, waiting: np.ndarray) -> None:
        children = np.array(self.children[node])
        apart = np.abs(near[rows, node][:, None] - self.to_parent[children][None, :]) - self.radius[children][None, :]
        possible = self._reach(rows, apart)
        some = possible.any(axis=0)
        children, possible = children[some], possible[:, some]
        if not len(children):
            return
        distance = self._distance(rows, self.centres[children])
        near[np.ix_(rows, children)] = distance
        bound = np.maximum(distance - self.radius[children][None, :], 0)
        waiting[np.ix_(rows, children)] = np.where(possible, bound, np.inf)

    def _open_page(self, rows: np.ndarray, node: int, near: np.ndarray) -> None:
        possible = self._reach(rows, np.abs(near[:, None] - self.to_centre[node][None, :]))
        some = np.flatnonzero(possible.any(axis=0))
        if not len(some):
            return
        ids = self.ids[node][some]
        scores = _dot(self.queries[rows], self.entries[node][some])
        enter = (scores >= self.scores[rows, -1][:, None]) & (ids[None, :] != self.query_ids[rows][:, None])
        for n in np.flatnonzero(enter.any(axis=1)):
            row, chosen = rows[n], enter[n]
            all_scores = np.concatenate([self.scores[row], scores[n, chosen]])
            all_ids = np.concatenate([self.best[row], ids[chosen]])
            order = np.lexsort((all_ids, ~all_scores))[: self.k]
            self.scores[row], self.best[row] = all_scores[order], all_ids[order]


def _search(k: int):
    def search(nodes: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(nodes) or not len(queries):
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        width = max([len(v) for v in queries.column("vector")] + [len(nodes.column("centre")[0])])
        found = _Search(nodes, queries.column("vec_id").to_numpy(), _matrix(queries.column("vector"), width), k)
        return found.run()

    return search


def _numbers(count: int) -> Column:
    """A row for each number below ``count``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products of each
    query with ``vectors``, ties to the smaller id, the query's own id left out.

    Both have ``(vec_id, vector)`` with whole numbers; rows with a null id or vector
    take no part. A shorter vector counts as filled up with zeros. Rows that repeat an
    id count once. Fewer than ``k`` others give fewer rows; none give none. Sums must
    fit a 64-bit number.
    """
    vectors = stored(vectors.select(F.col("vec_id").cast("long"), "vector").dropna())
    queries = queries.select(F.col("vec_id").cast("long"), "vector").dropna()
    shards = max(1, -(-vectors.count() // SHARD))
    blocks = max(1, -(-queries.count() // BLOCK))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard")
    nodes = stored(vectors.select(shard, "vec_id", "vector").groupBy("shard").applyInArrow(_build, NODES))

    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).alias("block")
    asked = queries.select("vec_id", "vector", block, _numbers(shards).alias("shard"))
    sent = nodes.withColumn("block", _numbers(blocks))
    hits = sent.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(_search(k), HITS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = hits.distinct().select("query_id", rank.cast("int").alias("rank"), "vec_id", "score")
    return best.where(F.col("rank") <= k)


def embedding_top_k(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The same for the rows of ``embeddings (vec_id, embedding)`` whose id is divisible
    by ``every``, against all rows, on ``floor(64 * x)`` of each component."""
    vectors = embeddings.select("vec_id", whole_numbers("embedding").alias("vector"))
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)
