"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming verification, connected components.

Two entries share the method:

* `link_fingerprints` is exact: 64-bit fingerprints at most 2 bits apart are linked. Four blocks of 16 bits, of
  which any close pair shares two, give six keys of 32 bits; documents of one fingerprint are one node. Pairs
  within a bucket are verified. A bucket above LIMIT nodes is not paired: each node names every value that is its
  own but for at most one of the bits outside the key, and nodes that name the same value are at most 2 bits apart;
  two nodes 1 or 2 bits apart always name a value in common. So the links of a hot bucket come from rows that grow
  with its nodes, and no group of equal values has more than 33 nodes a key.
* `near_duplicates` finds texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more. At that
  similarity 15 % of a fingerprint's bits differ, which 64 bits and two of distance can't hold. Candidates share one
  of as many blocks as make a similar pair share one with probability RECALL, their width following the number of
  texts so that a random text meets a constant number of others. The verdict is the same at every number of texts: a
  candidate passes NEAR_BITS fingerprint bits with 4 deviations of slack, and then the exact similarity of the sets.

Defined results: see the functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import blocks
from .common import Scratch, components, free_name, table

#: Fixed: seed of a shingle's XXH64, bits and blocks of the exact fingerprint, most bits apart.
SEED, BITS, BLOCKS, APART = 42, 64, 4, 2
#: Buckets above this number of nodes take the linear way.
LIMIT = 32
#: Nodes outside a hot bucket's largest group that are still paired with all of the bucket.
WIDE = 256
#: Similarity by which fingerprints put the nodes of hot buckets into groups. It decides on the way, not on links.
RELATED = 0.65
#: Probability with which a pair at the similarity sought shares a block, at least.
RECALL = 0.997
#: Fingerprint bits that filter candidates, at every number of texts.
NEAR_BITS = 640
#: Ties of even sets shift the share of differing bits: at 0.8 it is up to 1.07 times that of `differing`, and 1.25
#: times in pairs of sets of up to TINY shingles (4 of 5 shared).
UNEVEN, UNEVEN_TINY, TINY = 1.07, 1.25, 5


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each run of `words` words (ASCII lower-cased, repeats included); of all words if there are fewer;
    nothing if there is none."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    runs = zip(*(w[i:] for i in range(words)), strict=False) if len(w) > words else [w]
    return np.array(list(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED))), dtype=np.uint64)


def bits_of(hashes: np.ndarray, step: int = 1 << 13) -> np.ndarray:
    """For each bit of the rows of hashes, (n,) or (n, k), lowest first, whether over half of them have it. Counts are
    of bytes for 255 rows at a time, and a bounded slice is unpacked at once."""
    wide = (hashes if hashes.ndim > 1 else hashes[:, None]).astype("<u8", copy=False)
    total = np.zeros(64 * wide.shape[1], np.int64)
    for i in range(0, len(wide), step):
        bits = np.unpackbits(np.ascontiguousarray(wide[i : i + step]).view(np.uint8), axis=1, bitorder="little")
        for j in range(0, len(bits), 255):
            total += np.add.reduce(bits[j : j + 255], axis=0, dtype=np.uint8)
    return total * 2 > len(wide)


def _word(bits: np.ndarray) -> int:
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp long) of every document. No shuffle."""
    source = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            for part in blocks(batch.column(1)):
                fps = [_word(bits_of(shingle_hashes(t, words))) for t in batch.column(1)[part].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return source.mapInArrow(run, schema)


def _exact_keys(fp: Column) -> Column:
    width = BITS // BLOCKS
    block = [F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(BLOCKS)]
    return F.array(*[F.lit(k << (2 * width)).bitwiseOR(F.shiftleft(block[i], width)).bitwiseOR(block[j]) for k, (i, j) in enumerate(combinations(range(BLOCKS), 2))])


def link_fingerprints(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (fp long, distinct) at most 2 bits apart."""
    keys = nodes.select("fp", F.explode(_exact_keys(F.col("fp"))).alias("k"))
    load = keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    shared = scratch.keep(keys.join(load, "k"))
    small = shared.where(F.col("n") <= LIMIT).select("k", "fp")
    x, y = small.select("k", F.col("fp").alias("a")), small.select("k", F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= APART
    pairs = x.join(y, "k").where((F.col("a") < F.col("b")) & close).select("a", "b")
    width, masks = BITS // BLOCKS, []
    for pair in combinations(range(BLOCKS), 2):
        free = [b for b in range(BITS) if b // width not in pair]
        masks.append(F.array(F.lit(0).cast("long"), *[F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long") for b in free]))
    large = shared.where(F.col("n") > LIMIT).select("fp", F.explode(F.element_at(F.array(*masks), (F.shiftright("k", 2 * width) + 1).cast("int"))).alias("m"))
    named = large.select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("v"))
    low = named.groupBy("v").agg(F.min("fp").alias("b"), F.count("*").alias("c")).where("c > 1")
    stars = named.join(low, "v").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars)


def simhash_components(docs: DataFrame, words: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint of 16 hex digits, component_id) of every document; the component's id is the smallest
    doc_id that links reach.

    Null or empty text: fingerprint zero, linked like any other. Repeated rows: a row each, one component. A null
    doc_id is no smallest id, unless its component has no other (then component_id is null). An empty table: no rows.
    """
    scratch = Scratch(docs.sparkSession)
    fps = scratch.keep(fingerprints(docs, words, doc_id, text))
    nodes = scratch.keep(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    group = components(link_fingerprints(nodes.select("fp"), scratch), scratch)
    labelled = nodes.join(group.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    first = labelled.groupBy("label").agg(F.min("low").alias("component_id"))
    of = labelled.select("fp", "label").join(first, "label").select("fp", "component_id")
    return fps.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def differing(similarity: float) -> float:
    """The share of fingerprint bits in which sets of that Jaccard similarity differ: the angle between them by pi."""
    return math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi


def plan_blocks(texts: int, similarity: float) -> tuple[int, int, int]:
    """(width, blocks, blocks of tiny sets): a random text shares a block of that width with about 16 others."""
    width = min(30, max(8, math.ceil(math.log2(max(texts, 2))) - 4))

    def enough(share):
        p = (1 - share) ** width
        return max(math.ceil(math.log(1 - RECALL) / math.log(1 - p)) if p < 1 else 1, math.ceil(NEAR_BITS / width))

    return width, enough(differing(similarity) * UNEVEN), enough(differing(similarity) * UNEVEN_TINY)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The first k hashes of each shingle, from its own: (n, k)."""
    x = h[:, None] + (np.arange(k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_bits(h: np.ndarray, bits: int, step: int = 1 << 13) -> np.ndarray:
    """At least so many fingerprint bits of a set of shingles, a bounded slice of hash functions at a time."""
    k = -(-bits // 64)
    if len(h) <= step:
        return bits_of(_mixed(h, k))
    return np.concatenate([bits_of(_mixed(h + np.uint64(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF), 1)) for i in range(k)])


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.append(True, h[1:] != h[:-1])[: len(h)]]


def _short(h: np.ndarray) -> np.ndarray:
    """The 32 bits by which the shingles of a set are told apart."""
    return _distinct(h.astype(np.uint32)).view(np.int32)


def _wide(docs: DataFrame, words: int, width: int, blocks_: int, tiny: int, doc_id: str, text: str, sets: bool = True) -> DataFrame:
    """(doc_id, th, node, n, fp array<long>, keys array<long>, shingles array<int>): th names the text, node its set of
    shingles, which are told apart by 32 bits of their hashes. Sets of up to TINY shingles have `tiny` keys, the first `blocks_` of them like those of others.
    Without `sets` no column shingles."""
    source = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("th"), docs[text].alias("text"))
    more = "node long, n long, fp array<long>, keys array<long>" + (", shingles array<int>" if sets else "")
    schema = T.StructType([*source.schema.fields[:2], *T.StructType.fromDDL(more).fields])

    def run(batches):
        weights = 1 << np.arange(width, dtype=np.int64)
        for batch in batches:
            for part in blocks(batch.column(2)):
                node, n, fp, keys, shingles = [], [], [], [], []
                for t in batch.column(2)[part].to_pylist():
                    h = _distinct(shingle_hashes(t, words))
                    own = tiny if len(h) <= TINY else blocks_
                    bits = wide_bits(h, width * own)
                    node.append(xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63))
                    n.append(len(h))
                    fp.append(np.packbits(bits[:NEAR_BITS], bitorder="little").view("<i8"))
                    keys.append(bits[: width * own].reshape(own, width) @ weights + (np.arange(own, dtype=np.int64) << width))
                    if sets:
                        shingles.append(_short(h))
                own = [_lists(shingles, pa.int32())] if sets else []
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], batch.column(1)[part], pa.array(node, pa.int64()), pa.array(n, pa.int64()), _lists(fp), _lists(keys), *own], schema.names)

    return source.mapInArrow(run, schema)


def sets_of_texts(docs: DataFrame, places: DataFrame, words: int, doc_id: str, text: str, scratch: Scratch) -> Callable[[DataFrame], DataFrame]:
    """What makes the sets (node, shingles) of the nodes it is given (node, distinct) from their texts, which places
    (doc_id, th, node) name. The sets of all texts take as many bytes as these, and few nodes have any candidate."""
    source = docs.select(docs[doc_id].alias("_d"), F.xxhash64(docs[text]).alias("_h"), docs[text].alias("_t"))

    def run(batches):
        for batch in batches:
            for part in blocks(batch.column(1)):
                shingles = [_short(_distinct(shingle_hashes(t, words))) for t in batch.column(1)[part].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], _lists(shingles, pa.int32())], ["node", "shingles"])

    def make(named):
        # a text of each node; written first, so that its size is known and few rows never shuffle the texts
        one = scratch.keep(places.join(named, "node", "left_semi").groupBy("node").agg(F.min(F.struct("th", "doc_id")).alias("at")).select("node", "at.*"))
        met = source.join(one, (F.col("_h") == F.col("th")) & F.col("_d").eqNullSafe(F.col("doc_id")))
        return scratch.keep(met.select("node", F.col("_t").alias("text")).mapInArrow(run, "node long, shingles array<int>"))

    return make


def _sets(sets: DataFrame | Callable[[DataFrame], DataFrame], named: DataFrame) -> DataFrame:
    return sets(named) if callable(sets) else sets.join(named, "node", "left_semi")


def _lists(rows: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.ListArray:  # noqa: B008
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(rows), kind))


def verified(pairs: DataFrame, sets: DataFrame | Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """Those pairs (a, b) of nodes whose sets (node, shingles; a row each at least, or what makes them from nodes) have
    that Jaccard similarity."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    own = _sets(sets, named).groupBy("node").agg(F.first("shingles").alias("h"))
    both = pairs.join(own.select(F.col("node").alias("a"), F.col("h").alias("ha")), "a").join(own.select(F.col("node").alias("b"), F.col("h").alias("hb")), "b")
    # |common| (1 + s) >= s (|a| + |b|), with room for rounding below any step of the counts
    enough = F.size(F.array_intersect("ha", "hb")) * (1 + similarity) >= (F.size("ha") + F.size("hb")) * similarity - 1e-6
    return both.where(enough).select("a", "b")


def near_links(nodes: DataFrame, sets: DataFrame | Callable[[DataFrame], DataFrame], similarity: float, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that connect all nodes (node, n, fp, keys) that share a block and whose sets (node, shingles) have
    that similarity.

    In a bucket of more than LIMIT nodes every node meets one pivot; those that are alike (RELATED, by fingerprints) are
    of one group, over all buckets. Links within groups of more than LIMIT nodes are found by `group_links`, whether a
    block is shared or not.
    So variants of one text are never paired for being in a bucket. Of such a bucket, the nodes outside its largest
    group are paired with all of its nodes of other groups. Where more than WIDE are outside, all nodes of the bucket are
    made one group. All other buckets are paired, across groups. Paired nodes pass a filter of fingerprint bits and sizes,
    and all are verified exactly."""
    fp = nodes.select("node", "n", "fp")
    exploded = lambda of, *more: of.select(F.explode("keys").alias("k"), "node", "n", F.get("fp", 0).alias("s"), *more)
    load = scratch.keep(exploded(nodes).groupBy("k").agg(F.count("*").alias("c"), F.min("node").alias("b")).where(F.col("c") > LIMIT).select("k", "b"))
    if not load.take(1):
        pairs = _across(exploded(nodes, F.col("node").alias("label")), None, ["k"], similarity)
        return verified(_close(pairs.distinct(), fp, similarity, scratch), sets, similarity)
    hot = scratch.keep(exploded(nodes).join(load, "k"))
    pivot = hot.where("node = b").select("k", F.col("n").alias("nb"), F.col("s").alias("sb"))
    own = hot.select("k", "b", F.col("node").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    near = own.join(pivot, "k").where((F.col("a") != F.col("b")) & _may("a", "b", similarity)).select("a", "b")
    alike = _close(near.distinct(), fp, RELATED, scratch)

    def labelled(edges):
        # pivots that share a node are joined, and each node takes the label of its least pivot: few edges for components
        least = scratch.keep(edges.groupBy("a").agg(F.min("b").alias("m")))
        pivots = scratch.keep(edges.select(F.col("b").alias("a")).distinct())
        joined = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(pivots.join(least, "a").select("a", F.col("m").alias("b")))
        label = components(joined.distinct(), scratch).withColumnRenamed("node", "m")
        every = least.unionByName(pivots.withColumn("m", F.col("a"))).join(label, "m", "left")
        every = scratch.keep(every.select(F.col("a").alias("node"), F.coalesce("label", "m").alias("label")).distinct())
        group = scratch.keep(every.join(every.groupBy("label").agg(F.count("*").alias("m")).where(F.col("m") > LIMIT).select("label"), "label").select("node", "label"))
        named = scratch.keep(nodes.join(group, "node", "left").withColumn("label", F.coalesce("label", "node")))
        rows = scratch.keep(exploded(named, "label").join(load.select("k"), "k"))
        sizes = rows.groupBy("k", "label").agg(F.count("*").alias("m"))
        return group, named, rows, scratch.keep(sizes.groupBy("k").agg(F.max_by("label", "m").alias("bulk"), (F.sum("m") - F.max("m")).alias("rest")).where("rest > 0"))

    group, named, rows, bulk = labelled(alike)
    wide = bulk.where(F.col("rest") > WIDE).select("k")
    if wide.take(1):
        group, named, rows, bulk = labelled(alike.unionByName(hot.join(wide, "k").select(F.col("node").alias("a"), "b")))
    pairs = _across(rows, bulk, ["k"], similarity)
    few = exploded(named, "label").join(load.select("k"), "k", "left_anti")
    pairs = pairs.unionByName(_across(few, None, ["k"], similarity))
    centre = rows.groupBy("node").agg(F.count("*").alias("c"))
    edges = group_links(group.join(centre, "node", "left"), sets, similarity, scratch)
    return edges.unionByName(verified(_close(pairs.distinct(), fp, similarity, scratch), sets, similarity))


def group_links(group: DataFrame, sets: DataFrame | Callable[[DataFrame], DataFrame], similarity: float, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that connect all nodes of a group (node, label, c) whose sets (node, shingles) have that similarity.
    Exact.

    Of each group the node of the highest c is its pivot p. A node x is held as its difference X from p, the shingles that
    one of the two has, and the pivot's own links follow from it. Sets of that similarity differ in share (|x| + |y|)
    shingles at most, with share = (1 - s) / (1 + s). X and Y differ in the same ones, so they have
    t = (|X| - share |x| + |Y| - share |y|) / 2 in common at least, which is above 0 unless both are linked to p. In one
    order of the shingles, the rarest of the group first, the first |X| - t + 1 of X and |Y| - t + 1 of Y then have one in
    common. What a variant has for itself comes first, so variants of one text that are not near copies seldom meet, and
    what all have is met by none. Where more than LIMIT nodes meet in a shingle, all are first verified against one of
    them, and only nodes of different components are paired."""
    share, low = (1 - similarity) / (1 + similarity), 1e-6
    own = _sets(sets, group.select("node")).join(group, "node").groupBy("node").agg(F.first("label").alias("g"), F.first("c").alias("c"), F.first("shingles").alias("h"))
    own = scratch.keep(own)
    sets = own.select("node", F.col("h").alias("shingles"))
    pivot = own.groupBy("g").agg(F.max_by(F.struct("node", "h"), F.struct(F.coalesce("c", F.lit(0)), F.col("node"))).alias("p"))
    met = own.join(pivot.select("g", F.col("p.node").alias("b"), F.col("p.h").alias("hb")), "g").where("node <> b")
    apart = F.concat(F.array_except("h", "hb"), F.array_except("hb", "h"))
    met = met.select("g", "b", "node", F.size("h").alias("n"), F.size("hb").alias("nb"), apart.alias("r")).withColumn("d", F.size("r"))
    u, linked = F.col("d") - F.lit(share) * F.col("n"), F.col("d") <= F.lit(share) * (F.col("n") + F.col("nb")) + low
    met = scratch.keep(met.withColumn("u", u).withColumn("linked", linked))
    star = met.where("linked").select(F.col("node").alias("a"), "b")
    # only groups with nodes that are not linked to the pivot have more to find
    least = met.groupBy("g").agg(F.min("u").alias("least"), F.bool_and("linked").alias("done")).where("NOT done").select("g", "least")
    needed = lambda x, y: F.greatest(F.ceil((x + y) / 2 - low), F.lit(1)).cast("int")
    other = F.when(F.col("linked"), F.lit(share) * F.col("nb")).otherwise(F.col("least"))
    left = met.join(least, "g").withColumn("first", F.col("d") - needed(F.col("u"), other) + 1).where("first > 0")
    every = met.join(least, "g").select("g", "node", F.explode("r").alias("t"))
    # shingles of one node alone come first in its order, and nobody is met there
    often = every.groupBy("g", "t").agg(F.count("*").alias("f")).where("f > 1")
    ranked = every.join(often, ["g", "t"]).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "t"))).alias("ts"))
    alone = F.col("d") - F.size("ts")
    posting = left.join(ranked, "node").select("g", "node", "n", "d", "u", "linked", alone.alias("alone"), F.posexplode(F.slice("ts", F.lit(1), F.greatest(F.col("first") - alone, F.lit(0)))).alias("i", "ft"))
    posting = scratch.keep(posting.select("g", F.col("ft.t").alias("t"), "node", "n", "d", "u", "linked", (F.col("i") + F.col("alone")).alias("i")))
    crowd = posting.groupBy("g", "t").agg(F.count("*").alias("c"), F.min("node").alias("b")).where(F.col("c") > LIMIT).select("g", "t", "b")
    near = star.select(F.col("a").alias("b"), F.lit(True).alias("linked_b"))
    first = posting.join(crowd, ["g", "t"]).where("node <> b").select(F.col("node").alias("a"), "b", "linked").distinct()
    first = first.join(near, "b", "left").where("NOT (linked AND coalesce(linked_b, false))").select("a", "b")
    edges = scratch.keep(star.unionByName(verified(scratch.keep(first), sets, similarity)))
    label = components(edges, scratch)
    named = scratch.keep(posting.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))
    x, y = (named.select("g", "t", F.col("node").alias(i), *[F.col(c).alias(c + i) for c in ("n", "d", "u", "i", "label")]) for i in "ab")
    common = needed(F.col("ua"), F.col("ub"))
    once = (F.col("labela") != F.col("labelb")) & (F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.greatest("na", "nb") * similarity - low)
    pairs = x.join(y, ["g", "t"]).where(once & (F.col("ia") <= F.col("da") - common) & (F.col("ib") <= F.col("db") - common)).select("a", "b")
    return label.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(verified(scratch.keep(pairs.distinct()), sets, similarity))


def _most(bits: int, n: Column, similarity: float) -> Column:
    """Bits in which similar sets may differ, the smaller of n shingles: 4 deviations above the mean."""
    tiny, other = (math.floor(bits * p + 4 * math.sqrt(bits * p * (1 - p))) for p in (differing(similarity) * u for u in (UNEVEN_TINY, UNEVEN)))
    return F.when(n <= TINY, tiny).otherwise(other)


def _may(a: str, b: str, similarity: float) -> Column:
    """Whether the sizes (na, nb) and first 64 bits (sa, sb) of two nodes allow the similarity."""
    x, y = F.col(f"n{a}"), F.col(f"n{b}")
    return (F.least(x, y) >= F.greatest(x, y) * similarity - 1e-6) & (F.bit_count(F.col(f"s{a}").bitwiseXOR(F.col(f"s{b}"))) <= _most(64, F.least(x, y), similarity))


def _across(rows: DataFrame, buckets: DataFrame | None, keys: list[str], similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes of a bucket that belong to different components and may be similar: of all buckets, or of
    those given with the label of their bulk, outside which one of the two lies."""
    x, y = (rows.select(*keys, F.col("node").alias(i), F.col("label").alias(f"l{i}"), F.col("n").alias(f"n{i}"), F.col("s").alias(f"s{i}")) for i in "ab")
    once = F.col("la") < F.col("lb")
    if buckets is not None:
        x = x.join(buckets.select(*keys, "bulk"), keys).where("la <> bulk")
        once = (F.col("la") != F.col("lb")) & ((F.col("lb") == F.col("bulk")) | (F.col("la") < F.col("lb")))
    met = x.join(y, keys).where(once & _may("a", "b", similarity))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _close(pairs: DataFrame, fp: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Those pairs (a, b) whose fingerprints of NEAR_BITS (node, n, fp) are near enough."""
    left, right = (fp.select(F.col("node").alias(i), F.col("n").alias(f"n{i}"), F.col("fp").alias(f"f{i}")) for i in "ab")
    words = [F.bit_count(F.get("fa", i).bitwiseXOR(F.get("fb", i))) for i in range(NEAR_BITS // 64)]
    apart = sum(words[1:], words[0])
    met = pairs.join(left, "a").join(right, "b").where(apart <= _most(NEAR_BITS, F.least("na", "nb"), similarity))
    return scratch.keep(met.select("a", "b"))


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, th, node, label): documents of one label are near copies of each other, directly or by others.

    Null and empty texts are alike. Repeated rows have one label each time. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    width, blocks, tiny = plan_blocks(docs.count(), similarity)
    made, path = scratch.write(_wide(docs, words, width, blocks, tiny, doc_id, text, sets=False))
    nodes = scratch.keep(made.groupBy("node").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("keys").alias("keys")))
    places = scratch.keep(made.select("doc_id", "th", "node"))
    scratch.drop(path)
    label = components(near_links(nodes, sets_of_texts(docs, places, words, doc_id, text, scratch), similarity, scratch), scratch)
    labelled = Scratch(docs.sparkSession).keep(places.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))
    scratch.close()
    return labelled


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without near copies: of each group the row of the smallest doc_id stays (null last), of rows that agree in
    doc_id and group one. Columns are as before."""
    got = near_duplicates(docs, words, similarity, doc_id, text)
    low = got.groupBy("label").agg(F.min("doc_id").alias("low"))
    stay = got.join(low, "label").where(F.col("doc_id").eqNullSafe(F.col("low"))).groupBy("label", "doc_id").agg(F.min("th").alias("th"), F.count("*").alias("c"))
    scratch = Scratch(docs.sparkSession)
    stay = scratch.keep(stay)
    d, h = free_name(docs, "_d"), free_name(docs, "_h")
    keep = stay.select(F.col("doc_id").alias(d), F.col("th").alias(h)).distinct()
    # the same plan at every size: texts meet the ids of kept documents by a shuffle
    out = docs.join(keep.hint("shuffle_hash"), docs[doc_id].eqNullSafe(keep[d]) & (F.xxhash64(docs[text]) == keep[h]), "left_semi")
    if stay.where("c > 1").take(1):
        out = out.withColumn(h, F.xxhash64(F.col(text))).dropDuplicates([doc_id, h]).drop(h)
    return out


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, 64 bits, links at 2 bits, over all documents."""
    return simhash_components(table(spark, sf_dir, "documents"))
