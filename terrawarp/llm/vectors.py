"""What both vector searches share: usable rows, regions and shards of rows, blocks of queries, bounds that spare
shards, and the merge of their answers.

Rows are dealt into regions, each that of the nearest centre; centres are a bounded sample of the rows. A region above
the size of a shard is dealt into several by its ids' hashes, so no group of near or equal vectors meets in one task.
What the driver holds is a centre, a radius and a count for each of REGIONS regions at most.

Queries travel to shards in packs, and a task reads a shard and then its packs as a stream: a shard crosses the network
once, whatever number of queries meets it, and answers below a query's k-th score so far stay where they are found.

A query first meets one shard of the region that promises most. A region of centre c and radius r holds no product
with q above q.c + r|q|; the query then meets the shards of those regions alone whose bound reaches the k-th score that
it has by then. Both are left out of no answer: what is spared can't hold one.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Regions at most; centres are this many rows at most, those of the smallest hashes.
REGIONS = 1024
#: Queries that a task holds while it packs them, and blocks of queries that one task meets a shard with.
HELD, TURN = 1 << 14, 64


def usable(vectors: DataFrame, vec_id: str, embedding: str, zero: bool, single: bool = False) -> DataFrame:
    """(vec_id, embedding array<double>) of rows with an id whose vector is not null, holds neither null nor non-finite
    components and, if `zero` is not wanted, is not all zeros. An empty vector counts as zero. `single`: components that
    are of single precision stay so, which takes half the bytes."""
    e = vectors[embedding]
    if not (single and e_type(vectors.select(e.alias("embedding"))) == "array<float>"):
        e = e.cast("array<double>")
    limit = F.lit(float("inf"))
    ok = vectors[vec_id].isNotNull() & F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)), F.lit(False))
    if not zero:
        ok = ok & F.exists(e, lambda x: x != 0)
    return vectors.where(ok).select(vectors[vec_id].cast("long").alias("vec_id"), e.alias("embedding"))


def e_type(vectors: DataFrame) -> str:
    return vectors.schema["embedding"].dataType.simpleString()


def rows_of(vectors: pa.Array) -> np.ndarray:
    """A matrix of a column of vectors; those shorter than the longest are filled up with zeros."""
    n = np.asarray(vectors.value_lengths()).astype(np.int64)
    out, flat = np.zeros((len(n), int(n.max(initial=0)))), np.asarray(vectors.flatten())
    out[np.arange(out.shape[1])[None, :] < n[:, None]] = flat
    return out


def matrix(ids: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, sorted by id."""
    ids, out = np.asarray(ids), rows_of(vectors)
    order = np.argsort(ids, kind="stable")
    return ids[order], out[order]


def common_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices at the larger width."""
    w = max(a.shape[1], b.shape[1])
    return np.pad(a, ((0, 0), (0, w - a.shape[1]))), np.pad(b, ((0, 0), (0, w - b.shape[1])))


def _lists(rows: np.ndarray, kind: str) -> pa.ListArray:
    at = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    flat = rows.ravel().astype(np.float32 if kind == "array<float>" else np.float64)
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat))


@dataclass
class Regions:
    """Centres, radii, and the first shard and the number of shards of each region."""

    centres: np.ndarray
    radii: np.ndarray
    first: np.ndarray
    shards: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(query, region): what no product of the query with a row of the region is above."""
        q, c = common_width(queries, self.centres)
        product, length = q @ c.T, np.sqrt((q * q).sum(axis=1))[:, None]
        out = product + length * self.radii[None, :]
        # room for rounding, here and in the scores
        return out + 1e-9 * (np.abs(out) + length * (self.radii + np.sqrt((c * c).sum(axis=1)))[None, :]) + 1e-9


def placed(rows: DataFrame, size: int, prepare: Callable, scratch: Scratch) -> tuple[DataFrame, Regions]:
    """(vec_id, embedding, part) with prepared vectors, and the regions that parts belong to."""
    wanted = min(REGIONS, max(1, -(-rows.count() // size)))
    sample = rows.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(wanted).collect()
    if not sample:
        return rows.withColumn("part", F.lit(0)), Regions(np.zeros((0, 0)), np.zeros(0), np.zeros(0, int), np.zeros(0, int))
    centres, kind = np.unique(prepare(rows_of(pa.array([r.embedding for r in sample], pa.list_(pa.float64())))), axis=0), e_type(rows)

    def assign(batches):
        for batch in batches:
            x, c = common_width(prepare(rows_of(batch.column(1))), centres)
            near = ((c * c).sum(axis=1)[None, :] - 2 * x @ c.T).argmin(axis=1)
            far = np.sqrt(((x - c[near]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(x, kind), pa.array(near.astype(np.int32)), pa.array(far)], ["vec_id", "embedding", "region", "far"])

    kept = scratch.keep(rows.mapInArrow(assign, f"vec_id long, embedding {kind}, region int, far double"))
    radii, shards = np.zeros(len(centres)), np.zeros(len(centres), dtype=np.int64)
    for r in kept.groupBy("region").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect():  # a row a region
        radii[r.region], shards[r.region] = r.far, -(-r.n // size)
    first = np.cumsum(shards) - shards
    of = lambda numbers: F.element_at(F.array(*map(F.lit, numbers.tolist())), F.col("region") + 1)
    part = of(first) + F.pmod(F.xxhash64("vec_id"), F.greatest(of(shards), F.lit(1)))
    return kept.select("vec_id", "embedding", part.cast("int").alias("part")), Regions(centres, radii, first, shards)


def packed(rows: DataFrame, keys: list[str], groups: int, build: Callable, scratch: Scratch) -> DataFrame:
    """(part int, data binary): the rows of each value of the keys, the first of which is `part`, built into one value."""

    def run(group):
        ids, vecs = matrix(group["vec_id"].combine_chunks(), group["embedding"].combine_chunks())
        return pa.table({"part": pa.array([group["part"][0].as_py()], pa.int32()), "data": pa.array([build(ids, vecs)], pa.binary())})

    # few bytes but much work: the stated number keeps groups from being put together into few tasks
    dealt = rows.repartition(4 * max(1, groups), *keys)
    return scratch.keep(dealt.groupBy(*keys).applyInArrow(run, "part int, data binary"))


def asked_once(queries: DataFrame, prepare: Callable, scratch: Scratch) -> DataFrame:
    """(vec_id, embedding) of queries, prepared; of several vectors of one id the least asks."""
    kind = e_type(queries)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(prepare(rows_of(batch.column(1))), kind)], ["vec_id", "embedding"])

    ready = queries.mapInArrow(run, f"vec_id long, embedding {kind}")
    return scratch.keep(ready.groupBy("vec_id").agg(F.min("embedding").alias("embedding")))


def first_routes(asked: DataFrame, regions: Regions) -> DataFrame:
    """(vec_id, embedding, part): one shard of the region of the highest bound, for each query."""

    def run(batches):
        for batch in batches:
            q, ids = rows_of(batch.column(1)), np.asarray(batch.column(0))
            best = regions.bounds(q).argmax(axis=1)
            part = regions.first[best] + ids % regions.shards[best]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(part.astype(np.int32))], ["vec_id", "embedding", "part"])

    return asked.mapInArrow(run, f"vec_id long, embedding {e_type(asked)}, part int")


def other_routes(met: DataFrame, regions: Regions) -> DataFrame:
    """(vec_id, embedding, part, kth): the other shards that each query has to meet, from rows (vec_id, embedding, part,
    kth) of the shard that it has met and its k-th score so far (null: fewer than k)."""

    def run(batches):
        for batch in batches:
            kth = np.array([-np.inf if x is None else float(x) for x in batch.column(3).to_pylist()])
            open_ = regions.bounds(rows_of(batch.column(1))) >= kth[:, None]
            parts = []
            for own, row in zip(batch.column(2).to_pylist(), open_, strict=True):
                to = [p for r in np.flatnonzero(row).tolist() for p in range(regions.first[r], regions.first[r] + regions.shards[r])]
                parts.append([p for p in to if p != own])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.list_(pa.int32())), batch.column(3)], ["vec_id", "embedding", "part", "kth"])

    routed = met.select("vec_id", "embedding", "part", "kth")
    routed = routed.mapInArrow(run, f"vec_id long, embedding {e_type(met)}, part array<int>, kth {routed.schema['kth'].dataType.simpleString()}")
    return routed.withColumn("part", F.explode("part"))


def joined(packs: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors, k-th scores and whether they are known, of packs put together, by rising id."""
    wide = max(p[1].shape[1] for p in packs)
    ids, vecs = np.concatenate([p[0] for p in packs]), np.concatenate([np.pad(p[1], ((0, 0), (0, wide - p[1].shape[1]))) for p in packs])
    kth, known = np.concatenate([p[2] for p in packs]), np.concatenate([p[3] for p in packs])
    order = np.argsort(ids, kind="stable")
    return ids[order], vecs[order], kth[order], known[order]


def query_packs(routes: DataFrame, most: int, turns: int) -> DataFrame:
    """(part, turn, data): routes (vec_id, embedding, part, kth) packed by shard, in the tasks that have them. A task
    holds HELD queries at most and few more than `most` are in a pack. Turns deal the packs of a shard to tasks."""
    kind = e_type(routes)

    def run(batches):
        held: dict[int, list[tuple]] = {}
        size: dict[int, int] = {}

        def out(parts):
            rows = []
            for p in parts:
                ids, vecs, kth, known = joined(held.pop(p))
                rows.append((p, int(ids[0]) % turns, pickle.dumps((ids, vecs.astype(np.float32 if kind == "array<float>" else np.float64), kth, known), protocol=5)))
                del size[p]
            part, turn, data = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(turn, pa.int32()), pa.array(data, pa.binary())], ["part", "turn", "data"])

        for whole in batches:
            for i in range(0, whole.num_rows, most):
                batch = whole.slice(i, most)
                ids, vecs, part = np.asarray(batch.column(0)), rows_of(batch.column(1)), np.asarray(batch.column(2))
                known = np.asarray(batch.column(3).is_valid())
                kth = np.asarray(batch.column(3).fill_null(0))
                order = np.argsort(part, kind="stable")
                for at in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                    p = int(part[at[0]])
                    held.setdefault(p, []).append((ids[at], vecs[at], kth[at], known[at]))
                    size[p] = size.get(p, 0) + len(at)
                full = [p for p, n in size.items() if n >= most]
                if full:
                    yield out(full)
                if sum(size.values()) > HELD:
                    yield out(list(size))
        if size:
            yield out(list(size))

    return routes.select("vec_id", "embedding", "part", "kth").mapInArrow(run, "part int, turn int, data binary")


def answered(rows: DataFrame, queries: DataFrame, k: int, sizes: tuple[int, int], prepare: Callable, shard: Callable, block: Callable, search: Callable, score: str, scratch: Scratch) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best answers of the shards that each query meets. `sizes`: rows of a shard
    and queries of a block. Each shard gives k at most for a query, by the best score of each vec_id."""
    out = "query_id long, vec_id long, score " + score
    data, regions = placed(rows, sizes[0], prepare, scratch)
    if not len(regions.first):
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score " + score)
    shards = packed(data, ["part"], int(regions.shards.sum()), shard, scratch)
    asked = asked_once(queries, prepare, scratch)
    blocks = max(1, -(-asked.count() // sizes[1]))

    turns, number = max(1, -(-blocks // TURN)), pa.int64() if score == "long" else pa.float64()

    def run(batches):
        shard, waiting = None, []

        def met_by():
            ids, vecs, kth, known = joined(waiting)
            found = search(shard, block(ids, vecs.astype(np.float64)))
            q, v, s = (np.asarray(x, dtype=t) for x, t in zip(found, (np.int64, np.int64, number.to_pandas_dtype()), strict=True))
            at = np.searchsorted(ids, q)
            stay = ~known[at] | (s >= kth[at])
            return pa.RecordBatch.from_arrays([pa.array(q[stay]), pa.array(v[stay]), pa.array(s[stay], number)], ["query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column(0)[i].as_py():
                    waiting.append(pickle.loads(batch.column(1)[i].as_py()))
                    if sum(len(w[0]) for w in waiting) >= sizes[1]:
                        yield met_by()
                        waiting = []
                else:
                    if waiting:
                        yield met_by()
                    shard, waiting = batch.column(1)[i].as_py(), []
        if waiting:
            yield met_by()

    def met(routes):
        packs = query_packs(routes, sizes[1], turns).withColumn("asks", F.lit(True))
        every = shards.select("part", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn"), "data", F.lit(False).alias("asks")).unionByName(packs)
        # the stated number keeps the few groups, of much work, from being put together into few tasks
        dealt = every.repartition(4 * turns * int(regions.shards.sum()), "part", "turn").sortWithinPartitions("part", "turn", "asks")
        return scratch.keep(dealt.select("asks", "data").mapInArrow(run, out))

    routes = scratch.keep(first_routes(asked, regions))
    near = met(routes.withColumn("kth", F.lit(None).cast(score)))
    kth = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    far = met(other_routes(routes.join(kth, "vec_id", "left"), regions))
    # an id of several vectors counts by its best
    best = near.unionByName(far).repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def divisible(column: Column, by: int) -> Column:
    return column % by == 0
