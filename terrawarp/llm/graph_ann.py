"""Approximate nearest neighbours by a robust-pruned directed graph in each shard.

Rows are dealt into shards of bounded size, by regions; shards grow with the table up to MOST rows, so that a query meets
a bounded number of them until that size is reached. In a shard each row's NEAR nearest are its candidates, relaxed
distance pruning keeps edges to diverse ones (a candidate is dropped if a kept neighbour is nearer to it by the factor
ALPHA), edges are made both ways and pruned again. One row in ENTRIES and the longest are entries, and rows that no entry leads to become
entries too, so every row can be reached. A query beams through the graph of a shard from its nearest entries, first
through one shard and then through those of the regions whose bound reaches its k-th score so far (see `vectors`), and
the shards' best answers are merged.

Nearness is the inner product. Vectors get one component more, sqrt(M^2 - |x|^2) with M the shard's longest, under
which the largest inner product is the smallest distance. Graphs are built and searched in single precision, about the
shard's mean and in units of its extent; the beam's scores are inner products of the original vectors in double
precision. Equal vectors of a shard are one node that keeps its smallest ids, so copies neither
crowd the beam nor break ties wrongly.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows without an id, take no
part. Rows of one id count as one, by their best score that is found; of several vectors of a query's id the least one
asks, compared component by component; a query never finds its own id. Fewer candidates than
asked for: all that are found. An empty table, or one without queries: no rows. Shorter vectors count as filled up
with zeros. Extra columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .vectors import answered, common_width, divisible, usable

#: Least and most rows of a shard, shards below the most, queries of a block; edges of a node, candidates for them, beam,
#: pruning factor; rows for an entry, entries that a beam begins with, nodes that a step expands.
SHARD, MOST, SHARDS, BLOCK = 4096, 32768, 24, 1024
DEGREE, NEAR, BEAM, ALPHA = 24, 64, 160, 1.2
ENTRIES, START, EXPAND = 8, 64, 16
#: Nodes or queries that are worked on together.
BATCH = 256
#: A place of a beam: distance, node, and in the lowest bit whether it is still to be expanded. This one is empty.
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _places(dist: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Open places of a beam, which sort by distance (of single precision, any sign) and then by node."""
    bits = dist.astype(np.float32).view(np.uint32)
    rising = bits ^ np.where(bits >> np.uint32(31), np.uint32(0xFFFFFFFF), np.uint32(0x80000000))
    return (rising.astype(np.uint64) << np.uint64(32)) | (nodes.astype(np.uint64) << np.uint64(1)) | np.uint64(1)


def _nodes(places: np.ndarray) -> np.ndarray:
    return np.where(places == EMPTY, -1, ((places & np.uint64(0xFFFFFFFF)) >> np.uint64(1)).astype(np.int64))


def beam_search(points: np.ndarray, norms: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> np.ndarray:
    """Greedy beam search of many queries at once: (queries, beam) nodes by rising distance, -1 where there are fewer.
    Each step expands every query's EXPAND nearest open nodes."""
    n, q, every = len(points), len(queries), np.arange(len(queries))[:, None]
    start, width = min(len(entries), START, beam), min(EXPAND, beam)
    first = _places(norms[entries] - 2 * queries @ points[entries].T, np.broadcast_to(entries, (q, len(entries))))
    beams = np.full((q, beam), EMPTY)
    beams[:, :start] = np.partition(first, start - 1, axis=1)[:, :start]
    # the column by which a node was met; -1 for those that were not
    met = np.full((q, n), -1, dtype=np.int16)
    met[every, _nodes(beams[:, :start])] = 0
    live = np.arange(q)
    while len(live):
        now = beams[live]
        opened = np.where(now & np.uint64(1), now, EMPTY)
        pick = np.partition(opened, width - 1, axis=1)[:, :width]
        some = (pick != EMPTY).any(axis=1)
        live, now, opened, pick = live[some], now[some], opened[some], pick[some]
        if not len(live):
            break
        now[(opened <= pick.max(axis=1)[:, None]) & (opened != EMPTY)] -= np.uint64(1)
        at = _nodes(pick)
        near = np.where(at[:, :, None] >= 0, edges[at], -1).reshape(len(live), -1)
        row, column = np.nonzero(near >= 0)
        node, of = near[row, column], live[row]
        new = met[of, node] < 0
        row, column, node, of = row[new], column[new], node[new], of[new]
        met[of, node] = column
        once = met[of, node] == column
        row, node, of = row[once], node[once], of[once]
        places = _places(norms[node] - 2 * np.einsum("md,md->m", points[node], queries[of]), node)
        better = places < now.max(axis=1)[row]
        row, places = row[better], places[better]
        if len(row):
            column = np.arange(len(row)) - np.searchsorted(row, row)
            more = np.full((len(live), int(column.max()) + 1), EMPTY)
            more[row, column] = places
            now = np.partition(np.concatenate([now, more], axis=1), beam - 1, axis=1)[:, :beam]
        beams[live] = now
    return _nodes(np.sort(beams, axis=1))


def prune(points: np.ndarray, norms: np.ndarray, at: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning of the candidates (a row for each node of `at`, -1 for none): nearest first, dropping those that a
    kept one covers. (nodes, degree), -1 where there are fewer."""
    candidates = np.sort(candidates, axis=1)
    bad = (candidates < 0) | (candidates == at[:, None])
    bad[:, 1:] |= candidates[:, 1:] == candidates[:, :-1]
    own = norms[candidates] + norms[at][:, None] - 2 * np.matmul(points[candidates], points[at][:, :, None])[:, :, 0]
    own[bad] = np.inf
    order = np.argsort(own, axis=1, kind="stable")
    own, candidates = np.take_along_axis(own, order, axis=1), np.take_along_axis(candidates, order, axis=1)
    x, size = points[candidates], norms[candidates]
    between = size[:, :, None] + size[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
    covers = alpha * alpha * between <= own[:, None, :]
    left, count = np.isfinite(own), np.zeros(len(at), dtype=np.int64)
    out = np.full((len(at), degree), -1, dtype=np.int32)
    for i in range(candidates.shape[1]):
        row = np.flatnonzero(left[:, i] & (count < degree))
        out[row, count[row]] = candidates[row, i]
        count[row] += 1
        left[row] &= ~covers[row, i]
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, near: int = NEAR, alpha: float = ALPHA, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(edges, entries): edges (n, degree), -1 where there are fewer; from the entries every node is reached.
    Deterministic for the same points."""
    n, near = len(points), min(near, len(points) - 1)
    norms = (points * points).sum(axis=1)
    edges = np.full((n, degree), -1, dtype=np.int32)
    for i in range(0, n if near else 0, BATCH):
        at = np.arange(i, min(n, i + BATCH))
        d = norms - 2 * points[at] @ points.T
        d[at - i, at] = np.inf
        edges[at] = prune(points, norms, at, np.argpartition(d, near - 1, axis=1)[:, :near], degree, alpha)
    # edges both ways: of those that lead to a node the nearest are its candidates too
    far = np.zeros(edges.shape, dtype=np.float32)
    for i in range(0, n, BATCH):
        at = np.arange(i, min(n, i + BATCH))
        far[at] = norms[edges[at]] + norms[at][:, None] - 2 * np.matmul(points[edges[at]], points[at][:, :, None])[:, :, 0]
    a, i = np.nonzero(edges >= 0)
    b = edges[a, i]
    order = np.lexsort((far[a, i], b))
    a, b = a[order], b[order]
    place = np.arange(len(b)) - np.searchsorted(b, b)
    few = place < degree
    back = np.full((n, degree), -1, dtype=np.int32)
    back[b[few], place[few]] = a[few]
    for i in range(0, n, BATCH):
        at = np.arange(i, min(n, i + BATCH))
        edges[at] = prune(points, norms, at, np.concatenate([edges[at], back[at]], axis=1), degree, alpha)
    # the last component is smallest for the longest vectors, which are near to most queries
    some = np.random.default_rng(seed).permutation(n)[: max(min(n, START), n // ENTRIES)]
    entries = np.union1d(some, np.argsort(points[:, -1], kind="stable")[:START]).tolist()
    reached, new = np.zeros(n, dtype=bool), np.array(entries)
    while True:
        while len(new):
            reached[new] = True
            new = np.unique(edges[new])
            new = new[(new >= 0) & ~reached[new]]
        rest = np.flatnonzero(~reached)
        if not len(rest):
            return edges, np.sort(np.array(entries))
        entries.append(int(rest[0]))
        new = rest[:1]


def _centred(vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Points of single precision for vectors, and what takes queries among them: mean, extent, and the longest length."""
    most = float(np.abs(vecs).max(initial=0)) or 1.0
    norms = ((vecs / most) ** 2).sum(axis=1)
    x = np.concatenate([vecs / most, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]], axis=1)
    mean = x.mean(axis=0)
    extent = max(float(np.abs(x - mean).max()), 1e-12)
    return ((x - mean) / extent).astype(np.float32), mean, extent, float(np.sqrt(norms.max()))


def _asked(queries: np.ndarray, mean: np.ndarray, extent: float, longest: float) -> np.ndarray:
    """Queries among the points of `_centred`, all as long as the longest vector: a query's length changes no order."""
    q = queries / np.abs(queries).max(axis=1, keepdims=True)
    q = q * (longest / np.sqrt((q * q).sum(axis=1, keepdims=True)))
    return ((np.pad(q, ((0, 0), (0, 1))) - mean) / extent).astype(np.float32)


def pack_shard(ids: np.ndarray, vecs: np.ndarray, k: int) -> bytes:
    """A shard's graph over its distinct vectors, with the k + 1 smallest ids of each, and the most distinct vectors
    that one id has."""
    distinct, which = np.unique(vecs, axis=0, return_inverse=True)
    which = which.ravel()
    order = np.lexsort((ids, which))
    cut = np.searchsorted(which[order], np.arange(len(distinct) + 1))
    if len(distinct) == len(ids):
        members = ids[order]
    else:
        members = [np.unique(ids[order[a:b]])[: k + 1] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    several = int(np.unique(np.unique(np.stack([ids, which]), axis=1)[0], return_counts=True)[1].max())
    edges, entries = build_graph(_centred(distinct)[0])
    with np.errstate(over="ignore"):
        short = distinct.astype(np.float32)
    return pickle.dumps((short if np.array_equal(short, distinct) else distinct, members, edges, entries, several), protocol=5)


def search_shard(data: bytes, asked: bytes, k: int, beam: int) -> tuple:
    """The k best candidates of each query of a block in a shard, by exact inner product and smaller id."""
    vecs, members, edges, entries, several = pickle.loads(data)
    ids, queries = pickle.loads(asked)
    vecs, queries = common_width(vecs.astype(np.float64), queries)
    points, *frame = _centred(vecs)
    norms = (points * points).sum(axis=1)
    counts = None if not isinstance(members, list) else np.array([len(m) for m in members])
    every, out_q, out_v, out_s = np.arange(BATCH)[:, None], [], [], []
    for i in range(0, len(ids), BATCH):
        own, q = ids[i : i + BATCH], queries[i : i + BATCH]
        found = beam_search(points, norms, edges, entries, _asked(q, *frame), max(beam, (k + 1) * several))
        scores = np.matmul(vecs[found], q[:, :, None])[:, :, 0]
        if several == 1 and counts is None:
            named = members[found]
            none = (found < 0) | (named == own[:, None])
            order = np.lexsort((named, -scores, none), axis=1)[:, :k]
            stay = ~np.take_along_axis(none, order, axis=1)
            out_q.append(np.broadcast_to(own[:, None], order.shape)[stay])
            out_v.append(np.take_along_axis(named, order, axis=1)[stay])
            out_s.append(np.take_along_axis(scores, order, axis=1)[stay])
            continue
        # nodes beyond those that hold enough ids, and their ties, can't be among the best
        scores[found < 0] = -np.inf
        order = np.argsort(-scores, axis=1, kind="stable")
        held = np.cumsum(np.where(found < 0, 0, 1 if counts is None else counts[found])[every[: len(own)], order], axis=1)
        last = np.minimum((held < (k + 1) * several).sum(axis=1), found.shape[1] - 1)
        least = scores[every[: len(own)], order][np.arange(len(own)), last]
        for x, near, score, low in zip(own.tolist(), found, scores, least, strict=True):
            some = (near >= 0) & (score >= low)
            got = [(-s, v) for s, p in zip(score[some].tolist(), near[some].tolist(), strict=True) for v in np.atleast_1d(members[p]).tolist() if v != x]
            best: dict[int, float] = {}
            for s, v in sorted(got):
                best.setdefault(v, s)
            top = list(best.items())[:k]
            out_q.append(np.full(len(top), x))
            out_v.append(np.array([v for v, _ in top], dtype=np.int64))
            out_s.append(np.array([-s for _, s in top]))
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def graph_search(rows: DataFrame, queries: DataFrame, k: int, beam: int = BEAM, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found for each query; both sides have the named columns."""
    data, asked = usable(rows, vec_id, embedding, zero=False, single=True), usable(queries, vec_id, embedding, zero=False, single=True)
    size = min(max(SHARD, -(-data.count() // SHARDS)), max(SHARD, MOST))
    return answered(data, asked, k, (size, BLOCK), lambda v: v, lambda i, v: pack_shard(i, v, k), lambda i, v: pickle.dumps((i, v), protocol=5), lambda d, q: search_shard(d, q, k, beam), "double", Scratch(rows.sparkSession))


def op6_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 20th vector's 20 nearest among all others."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph_search(rows, rows.where(divisible(F.col("vec_id"), 20)), 20)
