"""Exact top-k by inner product, by dual-tree search over cover trees.

Rows are dealt into shards of bounded size, by regions, and queries into blocks; each becomes a cover tree over its distinct
vectors (a node at scale i covers its points within 2**i, its children are more than 2**(i-1) apart; equal vectors are
one point with its smallest ids). For a block and a shard both trees are descended together: a pair of nodes with
centres q, x and covering radii r, s can hold no product above q.x + r|x| + s|q| + rs, and is left out where that is
below the worst k-th score among the node's queries. A query meets the shards of those regions alone whose bound
reaches the k-th score of its first shard (see `vectors`), and shards' answers are merged.

Scores are integers: components are floor(256 x). Sums below 2**53 are exact in double precision; a shard or block
with larger ones is multiplied in whole numbers of any size, and scores beyond 64 bits are reported as the nearest
64-bit number (ranked by what is reported).

Defined results: vectors that are null or hold null or non-finite components, and rows without an id, take no part;
zero and empty vectors do. Rows of one id count as one, by their best score; of several vectors of a query's id the
least one asks, compared component by component; a query never finds its own id. Ties go to the smaller vec_id. Fewer candidates than k: all. An empty table, or one without queries: no rows. Shorter
vectors count as filled up with zeros. Extra columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .vectors import answered, common_width, divisible, usable

#: Rows of a shard, of a query block, and of a leaf.
SHARD, BLOCK, LEAF = 8192, 1024, 64
_MOST, _LEAST = (1 << 63) - 1, -(1 << 63)


class Node:
    """Points under a centre: `own` lie in the node itself, the rest in its children."""

    __slots__ = ("centre", "radius", "length", "own", "kids", "worst")

    def __init__(self, vecs: np.ndarray, points: np.ndarray, centre: np.ndarray, own: np.ndarray, kids: list):
        self.centre, self.own, self.kids, self.worst = centre, own, kids, -np.inf
        self.radius = float(np.sqrt(((vecs[points] - centre) ** 2).sum(axis=1).max())) if len(points) else 0.0
        self.length = float(np.sqrt((centre * centre).sum()))


def cover_tree(vecs: np.ndarray) -> Node:
    """The cover tree of distinct vectors. Children that are single points are kept together as the node's own."""

    def leaf(points):
        return Node(vecs, points, vecs[points].mean(axis=0), points, [])

    def grow(points, scale):
        while True:
            if len(points) <= LEAF:
                return leaf(points)
            reach, left, groups = 2.0 ** (scale - 1), points, []
            while len(left):
                d = ((vecs[left] - vecs[left[0]]) ** 2).sum(axis=1)
                near = d <= reach * reach
                groups.append(left[near])
                left = left[~near]
            scale -= 1
            if len(groups) > 1:
                break
        kids = [grow(g, scale) for g in groups if len(g) > 1]
        single = [g for g in groups if len(g) == 1]
        for i in range(0, len(single), 4 * LEAF):
            kids.append(leaf(np.concatenate(single[i : i + 4 * LEAF])))
        return Node(vecs, points, vecs[points[0]], np.zeros(0, np.int64), kids)

    points = np.arange(len(vecs))
    far = float(np.sqrt(((vecs - vecs[0]) ** 2).sum(axis=1).max()))
    return grow(points, int(np.ceil(np.log2(far))) if far > 0 else 0)


def whole(vecs: np.ndarray) -> np.ndarray:
    return np.floor(256 * vecs) + 0.0


def pack_points(ids: np.ndarray, vecs: np.ndarray, k: int | None) -> bytes:
    """A cover tree over the distinct vectors, with the k + 1 smallest ids of each (k None: all ids), and the most
    distinct vectors that one id has."""
    distinct, which = np.unique(vecs, axis=0, return_inverse=True)
    which = which.ravel()
    order = np.lexsort((ids, which))
    cut = np.searchsorted(which[order], np.arange(len(distinct) + 1))
    members = [np.unique(ids[order[a:b]])[: None if k is None else k + 1].tolist() for a, b in zip(cut[:-1], cut[1:], strict=True)]
    several = int(np.unique(np.unique(np.stack([ids, which]), axis=1)[0], return_counts=True)[1].max())
    return pickle.dumps((distinct, members, cover_tree(distinct), several), protocol=5)


def dual_search(data: bytes, asked: bytes, k: int) -> tuple[list, list, list]:
    """The k best rows of a shard for each query of a block: query ids, row ids, scores."""
    rows, members, tree, several = pickle.loads(data)
    queries, askers, asking, _ = pickle.loads(asked)
    wide = common_width(rows, queries)
    if wide[0].shape[1] != rows.shape[1] or wide[1].shape[1] != queries.shape[1]:
        rows, queries = wide
        tree, asking = cover_tree(rows), cover_tree(queries)
    size = max(float(np.abs(rows).max(initial=0)), 1.0) * max(float(np.abs(queries).max(initial=0)), 1.0) * max(rows.shape[1], 1)
    exact = size < 2.0**53
    big_rows, big_queries = (None, None) if exact else (_whole(rows), _whole(queries))
    # queries with one vector share its answers: k + 1 rows, as one of them may be the asker itself
    most = k + 1
    best: list[list] = [[] for _ in queries]
    kth = np.full(len(queries), -np.inf)

    def bound(q: Node, x: Node) -> float:
        b = float(q.centre @ x.centre) + q.radius * x.length + x.radius * q.length + q.radius * x.radius
        return b + 1e-9 * (abs(b) + q.length * x.length) + 1e-3

    def meet(q: Node, x: Node) -> None:
        scores = queries[q.own] @ rows[x.own].T if exact else big_queries[q.own].dot(big_rows[x.own].T)
        for i, row in zip(q.own.tolist(), scores, strict=True):
            hit = np.flatnonzero(row >= kth[i])
            if len(hit) > most * several and exact:
                hit = hit[row[hit] >= np.partition(row[hit], len(hit) - most * several)[len(hit) - most * several]]
            if len(hit):
                more = [(-int(row[j]), v) for j in hit.tolist() for v in members[x.own[j]]]
                best[i] = _first_of_each(sorted(best[i] + more), most)
                if len(best[i]) == most:
                    kth[i] = -best[i][-1][0]
        q.worst = float(kth[q.own].min())

    def down(q: Node, x: Node) -> None:
        if bound(q, x) < q.worst:
            return
        if not q.kids and not x.kids:
            meet(q, x)
        elif q.kids and (not x.kids or q.radius >= x.radius):
            for c in q.kids:
                down(c, x)
            q.worst = min(c.worst for c in q.kids)
        else:
            for c in sorted(x.kids, key=lambda c: -bound(q, c)):
                down(q, c)

    for node in _all(asking):
        node.worst = -np.inf
    down(asking, tree)
    out_q, out_v, out_s = [], [], []
    for own, found in zip(askers, best, strict=True):
        for q in own:
            for s, v in [f for f in found if f[1] != q][:k]:
                out_q.append(q)
                out_v.append(v)
                out_s.append(min(max(-s, _LEAST), _MOST))
    return out_q, out_v, out_s


def _first_of_each(ranked: list[tuple], most: int) -> list[tuple]:
    """The first pair (score, id) of each id, as many as are wanted."""
    out, seen = [], set()
    for s, v in ranked:
        if v not in seen:
            seen.add(v)
            out.append((s, v))
            if len(out) == most:
                break
    return out


def _whole(a: np.ndarray) -> np.ndarray:
    out = np.empty(a.shape, dtype=object)
    out[...] = [[int(x) for x in row] for row in a]
    return out


def _all(node: Node):
    yield node
    for c in node.kids:
        yield from _all(c)


def exact_topk(rows: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k highest scores; both sides have the named columns."""
    data, asked = usable(rows, vec_id, embedding, zero=True), usable(queries, vec_id, embedding, zero=True)
    return answered(data, asked, k, (SHARD, BLOCK), whole, lambda i, v: pack_points(i, v, k), lambda i, v: pack_points(i, v, None), lambda d, q: dual_search(d, q, k), "long", Scratch(rows.sparkSession))


def op4_cover_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th vector's 5 highest scores among all others."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_topk(rows, rows.where(divisible(F.col("vec_id"), 50)), 5)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT vec_id, min(e) AS e FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
s AS (
  SELECT a.vec_id AS query_id, c.vec_id, max(list_sum(list_transform(list_zip(a.e, c.e), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT) AS score
  FROM a JOIN v c ON a.vec_id <> c.vec_id GROUP BY a.vec_id, c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
