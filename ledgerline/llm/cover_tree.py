"""Exact top-k inner-product search with two cover trees.

Vectors are dealt into blocks by id, queries into groups; each (group, block) pair
is one Spark task that builds a cover tree over either side and walks both trees
together. A pair of nodes with centres q, x and covering radii R, S holds no score above

    q.x + |q| S + |x| R + R S

so it is dropped when that is below the worst k-th score among the query node's
queries. What remains is scored exactly: where the products of a pair of blocks may pass 2**52, bounds are still float64
(with their rounding added), and scores are Python integers. The k best of each pair are merged per query.

Scale: a task holds one group and one block, whose sizes are parameters. Every query
has to meet every vector, so data move once per query group; groups are large.
The hash of the id deals rows, so equal vectors spread over the blocks.

Defined results: vectors that are null or hold null or non-finite components, and
rows without an id, take no part; components and scores beyond a 64-bit integer count as the nearest one; vectors of different lengths are not compared; rows
that repeat an id are candidates of their own, but never for a query with that id; a query row
repeated with the same vector is one query; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, table

BLOCK_ROWS = 8_192
GROUP_ROWS = 8_192
LEAF = 24
QUERY_LEAF = 4  # queries that share bounds to the end; more of them loosen the bounds
SCORED = 96  # points scored before bounds are compared again
TOGETHER = 256  # query nodes whose bounds are computed in one product
NONE = np.iinfo(np.int64).min


class CoverTree:
    """Node n has the centre point ``centre[n]``, covers the points
    ``order[start[n]:end[n]]`` within ``radius[n]`` and has the children
    ``first[n]`` to ``last[n]`` (none: a leaf). Children's centres lie within half
    their parent's radius of their points and further than that from each other."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.norm = points, np.linalg.norm(points, axis=1)
        self.order = np.arange(len(points))
        centre, radius, start, end, first, last = [0], [0.0], [0], [len(points)], [0], [0]
        reach = self.distances(self.order, 0)
        radius[0] = float(reach.max(initial=0))
        at = 0
        while at < len(centre):  # breadth first, so a node's children are neighbours
            lo, hi = start[at], end[at]
            first[at] = last[at] = len(centre)
            if hi - lo > leaf and radius[at] > 0:
                half, left, place = radius[at] / 2, self.order[lo:hi].copy(), lo
                while len(left):
                    reach = self.distances(left, left[0])
                    near = reach <= half
                    near[0] = True  # rounding
                    group = left[near]
                    self.order[place : place + len(group)] = group
                    for column, value in ((centre, group[0]), (radius, float(reach[near].max())), (start, place), (end, place + len(group)), (first, 0), (last, 0)):
                        column.append(value)
                    place, left = place + len(group), left[~near]
                last[at] = len(centre)
            at += 1
        self.centre, self.radius = np.array(centre), np.array(radius)
        self.start, self.end, self.first, self.last = np.array(start), np.array(end), np.array(first), np.array(last)

    def distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        square = self.norm[rows] ** 2 + self.norm[centre] ** 2 - 2 * (self.points[rows] @ self.points[centre])
        return np.sqrt(np.maximum(square, 0))

    def children(self, nodes: np.ndarray) -> np.ndarray:
        return ranges(self.first[nodes], self.last[nodes])

    def members(self, nodes: np.ndarray) -> np.ndarray:
        return self.order[ranges(self.start[nodes], self.end[nodes])]

    def inner(self, nodes: np.ndarray) -> np.ndarray:
        return self.last[nodes] > self.first[nodes]


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """lo[0], ..., hi[0] - 1, lo[1], ..."""
    n = hi - lo
    return np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


class Search:
    """The k best (score, id) of each query, ties to the smaller id."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int):
        most = float(abs(queries).max(initial=0)) * float(abs(points).max(initial=0)) * max(1, queries.shape[1])
        self.whole = None if most < 1 << 52 else (queries.astype(object), points.astype(object))
        self.q, self.x = CoverTree(queries.astype(np.float64), QUERY_LEAF), CoverTree(points.astype(np.float64))
        self.query_ids, self.ids, self.k = query_ids, ids, k
        self.scores = np.full((len(queries), k), NONE, np.int64)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max, np.int64)
        # of the bounds' rounding: a radius is a root of a difference, so it is off by the root of a product's rounding
        self.slack = 1e-6 + 2e-7 * max(1, queries.shape[1]) ** 0.5 * self.q.norm.max() * self.x.norm.max()
        self.scored = 0

    def bounds(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """What no score of a query below q[i] with a point below x[j] exceeds."""
        qc, xc, qr, xr = self.q.centre[q], self.x.centre[x], self.q.radius[q][:, None], self.x.radius[x]
        return self.q.points[qc] @ self.x.points[xc].T + self.q.norm[qc][:, None] * xr + qr * (self.x.norm[xc] + xr) + self.slack

    def run(self) -> None:
        root = np.zeros(1, np.int64)
        self.walk(0, root, self.bounds(root, root)[0])

    def walk(self, q: int, x: np.ndarray, bounds: np.ndarray) -> None:
        """Scores the points below ``x`` (nodes) for the queries below ``q`` (a node),
        the most promising first. Drops what its bound excludes."""
        node = np.array([q])
        queries = self.q.members(node)
        while True:
            keep = bounds >= self.scores[queries, -1].min()
            x, bounds = x[keep], bounds[keep]
            if not len(x):
                return
            inner = self.x.inner(x)
            if self.q.inner(node)[0]:
                if inner.any() and self.x.radius[x[inner]].max() > self.q.radius[q]:
                    opened = self.x.children(x[inner])
                    x = np.concatenate([x[~inner], opened])
                    bounds = np.concatenate([bounds[~inner], self.bounds(node, opened)[0]])
                    continue
                kids = self.q.children(node)
                for at in range(0, len(kids), TOGETHER):
                    some = kids[at : at + TOGETHER]
                    for kid, row in zip(some, self.bounds(some, x), strict=True):
                        self.walk(int(kid), x, row)
                return
            best = np.argsort(-bounds, kind="stable")
            x, bounds, inner = x[best], bounds[best], inner[best]
            points = np.cumsum(np.where(inner, 0, self.x.end[x] - self.x.start[x]))
            n = int(np.searchsorted(points, SCORED)) + 1
            opened = self.x.children(x[:n][inner[:n]])
            rows = self.x.members(x[:n][~inner[:n]])
            if len(rows):
                self.score(queries, rows)
            x, bounds = x[n:], bounds[n:]
            if len(opened):
                x, bounds = np.concatenate([opened, x]), np.concatenate([self.bounds(node, opened)[0], bounds])

    def score(self, queries: np.ndarray, rows: np.ndarray) -> None:
        self.scored += len(queries) * len(rows)
        if self.whole is None:
            scores = (self.q.points[queries] @ self.x.points[rows].T).astype(np.int64)
        else:
            exact = self.whole[0][queries] @ self.whole[1][rows].T
            scores = np.clip(exact, NONE + 1, np.iinfo(np.int64).max).astype(np.int64)
        scores[self.query_ids[queries][:, None] == self.ids[rows][None, :]] = NONE
        useful = ((scores >= self.scores[queries, -1:]) & (scores > NONE)).any(0)
        if not useful.any():
            return
        scores = np.concatenate([self.scores[queries], scores[:, useful]], 1)
        ids = np.concatenate([self.found[queries], np.broadcast_to(self.ids[rows[useful]], (len(queries), int(useful.sum())))], 1)
        best = np.lexsort((ids, ~scores), axis=1)[:, : self.k]  # ~x falls as x rises, without overflow
        self.scores[queries] = np.take_along_axis(scores, best, 1)
        self.found[queries] = np.take_along_axis(ids, best, 1)


def exact_numbers(rows: list) -> np.ndarray:
    return np.array([np.asarray(r, np.int64) for r in rows], np.int64).reshape(len(rows), -1)


def top_k_of_block(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """left: query_id, query_no, vector; right: vec_id, vector. One row per kept pair."""
    empty = pd.DataFrame({"query_no": pd.Series(dtype="int64"), "query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
    if left.empty or right.empty:
        return empty
    left = left.sort_values(["query_id", "query_no"], ignore_index=True)
    right = right.sort_values("vec_id", kind="stable", ignore_index=True)
    q, x = exact_numbers(left["vector"].tolist()), exact_numbers(right["vector"].tolist())
    query_ids, ids = left["query_id"].to_numpy(), right["vec_id"].to_numpy()
    s = Search(q, query_ids, x, ids, k)
    s.run()
    scores, found = s.scores, s.found
    there = scores > NONE
    row = np.nonzero(there)[0]
    return pd.DataFrame({"query_no": left["query_no"].to_numpy()[row], "query_id": query_ids[row], "vec_id": found[there], "score": scores[there]})


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, null unless all are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): ``vectors`` has vec_id and vector (integers)."""
    rows = vectors.select("vec_id", "vector", is_query.alias("asked"), F.size("vector").alias("dims"))
    rows = materialize(rows.filter("vec_id is not null and vector is not null"), "topk-vectors")
    asked = rows.filter("asked").dropDuplicates(["vec_id", "vector"])
    asked = asked.select(F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("query_no"), "vector", "dims")
    n, m = rows.count(), asked.count()
    blocks, groups = max(1, -(-n // block_rows)), max(1, -(-m // group_rows))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    rows = rows.drop("asked")
    asked = asked.withColumn("group", part("query_id", groups)).withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    rows = rows.withColumn("block", part("vec_id", blocks)).withColumn("group", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    pair = ["dims", "group", "block"]
    best = asked.groupBy(*pair).cogroup(rows.groupBy(*pair)).applyInPandas(
        lambda a, b: top_k_of_block(a, b, k), "query_no long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "query_no").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return top_k(vectors, F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS vector FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.vector::DOUBLE[], x.vector::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.vector) = len(x.vector) WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
