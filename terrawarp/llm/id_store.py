"""Token-id output as a content-addressed store.

Format (a folder):
* chunks/  Parquet (key binary, data binary): every distinct run of ids once, named by the BLAKE2b-128 of its bytes.
  They are little-endian, 2 an id where all its ids fit, else 4, after a byte that says so.
* docs/    Parquet in ascending order of doc_id (null first): doc_id, start, n_tokens, chunks (the recipe: each chunk's
  key and its number of ids in 4 bytes, joined) and root (the Merkle root over the recipe's entries).
* manifest/ Parquet (part, docs, n_tokens, root): the Merkle root over the roots of each file part's documents.

A rolling hash over the last 16 ids cuts each document's id stream where its top bits are zero, so equal passages
give equal chunks wherever they stand. One job encodes, cuts and deals chunks by key, with copies dropped in each
task before and in each partition after the shuffle: the ids cross the network once, and no task gets a hot chunk
more than once from each other task. Recipes are a few bytes a chunk.

Reading verifies: each chunk against its key, each recipe against its root, each part against the manifest.

Defined results
* Null text counts as empty: its stream is the end id alone, or nothing without one. Null doc_ids come first, each a document of its own.
* Repeated rows are documents of their own with the same recipe; rows of one doc_id are ordered by content.
* Very long texts are streams of many chunks. An empty table gives an empty store. Extra columns are not stored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import blocks, codec
from .common import Scratch, prefix_sum, table

#: Chunks end where the rolling hash's top bits are zero: 512 ids on average, within these bounds.
TOP_BITS, LEAST, MOST = 9, 64, 4096
KEY, ENTRY = 16, 20


def marks(ids: np.ndarray) -> np.ndarray:
    """Places after which a chunk may end. A place's mark depends on its last 16 ids alone, so streams may lie one
    after another: no chunk ends within the first LEAST ids of its stream."""
    h = ids.astype(np.uint32) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    for k in (1, 2, 4, 8):  # the sum of the last 16 ids' hashes, each shifted by its age
        older = np.zeros_like(h)
        older[k:] = h[:-k] if k < len(h) else 0
        h = h + (older << np.uint32(k))
    return np.flatnonzero(h >> np.uint32(32 - TOP_BITS) == 0) + 1


def cuts(marked: list[int], at: list[int]) -> list[list[int]]:
    """Where the chunks of each stream end; streams lie one after another, at[i] to at[i + 1], and `marked` rises."""
    out, k, n = [], 0, len(marked)
    for last, stop in zip(at, at[1:], strict=False):
        ends = []
        while k < n and marked[k] < stop:
            mark = marked[k]
            k += 1
            while mark - last > MOST:
                last += MOST
                ends.append(last)
            if mark - last >= LEAST:
                ends.append(mark)
                last = mark
        while stop - last > MOST:
            last += MOST
            ends.append(last)
        if last < stop:
            ends.append(stop)
        out.append(ends)
    return out


def merkle(keys: list[bytes]) -> bytes:
    """The root over leaves in order; an odd last node moves up as it is."""
    if not keys:
        return bytes(KEY)
    blake = hashlib.blake2b
    level = [blake(b"\0" + k, digest_size=KEY).digest() for k in keys]
    while len(level) > 1:
        up = [blake(b"\1" + a + b, digest_size=KEY).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        if len(level) & 1:
            up.append(level[-1])
        level = up
    return level[0]


def recipe_root(recipe: bytes) -> bytes:
    return merkle([recipe[i : i + ENTRY] for i in range(0, len(recipe), ENTRY)])


def packer(ids: np.ndarray, edges: np.ndarray):
    """A function of (from, to) that packs the ids between two neighbouring edges: 2 bytes an id where all fit."""
    narrow, wide = memoryview(ids.astype("<u2")).cast("B"), memoryview(ids.astype("<u4")).cast("B")
    if not len(ids) or int(ids.max()) < 65536:
        return lambda a, b: b"\2" + narrow[2 * a : 2 * b]
    large = set(edges[:-1][np.maximum.reduceat(ids, edges[:-1]) >= 65536].tolist())
    return lambda a, b: b"\4" + wide[4 * a : 4 * b] if a in large else b"\2" + narrow[2 * a : 2 * b]


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u2" if data[0] == 2 else "<u4", offset=1).astype("<u4")


def _crc_tables(power: int, known: dict[int, list[list[int]]] = {}) -> list[list[int]]:  # noqa: B006
    """Tables that carry a CRC-32 over 2**power zero bytes, by each byte of it."""
    if power not in known:
        if power == 0:
            base = [zlib.crc32(bytes([b])) for b in range(256)]
            zero = base[0]
            step = [b ^ zero for b in base]  # the reflected CRC's table
            bit = lambda v: step[v & 255] ^ (v >> 8)
        else:
            t = _crc_tables(power - 1)
            over = lambda v: t[0][v & 255] ^ t[1][v >> 8 & 255] ^ t[2][v >> 16 & 255] ^ t[3][v >> 24]
            bit = lambda v: over(over(v))
        known[power] = [[bit(b << s) for b in range(256)] for s in (0, 8, 16, 24)]
    return known[power]


def crc_before(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What each run of bytes, by its CRC-32, adds to that of a whole in which so many bytes follow it: the CRC-32 of
    the whole is the exclusive or over its runs."""
    crcs, power = crcs.astype(np.int64), 0
    while len(lengths) and int(lengths.max()) >> power:
        at = np.flatnonzero(lengths >> power & 1)
        t, v = np.array(_crc_tables(power), dtype=np.int64), crcs[at]
        crcs[at] = t[0][v & 255] ^ t[1][v >> 8 & 255] ^ t[2][v >> 16 & 255] ^ t[3][v >> 24]
        power += 1
    return crcs


def chunked(ids: np.ndarray, at: np.ndarray, seen: set[bytes]) -> tuple[tuple[list, list, list], list[bytes]]:
    """The chunks (keys, lengths, packed ids) of a run of streams that are not in `seen`, which they join, and the
    recipe of each stream: each of its chunks' keys, followed by its length in 4 bytes."""
    ends = cuts(marks(ids).tolist(), at.tolist())
    edges = np.unique(np.concatenate([at[:1], np.array([e for x in ends for e in x], dtype=np.int64)]))
    pack, blake = packer(ids, edges), hashlib.blake2b
    keys, sizes, data, recipes = [], [], [], []
    for start, stops in zip(at.tolist(), ends, strict=False):
        recipe = []
        for stop in stops:
            packed = pack(start, stop)
            key = blake(packed, digest_size=KEY).digest()
            recipe += (key, (stop - start).to_bytes(4, "little"))
            if key not in seen:
                seen.add(key)
                keys.append(key)
                sizes.append(stop - start)
                data.append(packed)
            start = stop
        recipes.append(b"".join(recipe))
    return (keys, sizes, data), recipes


def write_store(docs: DataFrame, to: str, path: str, pattern: str | None = None, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encodes all documents and writes the store to the folder `to`, which executors and driver share."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    source = docs.select(docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    names = ["kind", "key", "doc_id", "n", "data"]
    schema = "kind int, key binary, doc_id long, n long, data binary"

    def run(batches):
        c, seen, task, row = codec(path, pattern), set(), TaskContext.get().partitionId().to_bytes(8, "big"), 0
        for batch in batches:
            for part in blocks(batch.column(1)):
                if len(seen) > 1_000_000:
                    seen.clear()
                ids, at = c.encode(batch.column(1)[part])
                if end_id is not None:
                    ids, at = np.insert(ids, at[1:], end_id), at + np.arange(len(at))
                chunks, recipes = chunked(ids, at, seen)
                recipes = [recipe_root(r) + r for r in recipes]
                docs = len(recipes)
                names_of = [task + i.to_bytes(8, "big") for i in range(row, row + docs)]
                row += docs
                for kind, cols in ((0, [*chunks[:1], pa.nulls(len(chunks[0]), pa.int64()), *chunks[1:]]), (1, [names_of, batch.column(0)[part], np.diff(at), recipes])):
                    if len(cols[0]):
                        yield pa.RecordBatch.from_arrays([pa.array([kind] * len(cols[0]), pa.int32()), *[pa.array(x, k) for x, k in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.binary()), strict=True)]], names)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = source.mapInArrow(run, schema).repartition(n, "key").dropDuplicates(["kind", "key"])
    staged = f"{to}/staged"
    # chunks and recipes do not repeat, so a dictionary would be work for nothing
    plain = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}
    dealt.write.partitionBy("kind").options(**plain).parquet(staged)
    move = spark._jvm.org.apache.hadoop.fs.Path
    fs = move(to).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(move(f"{staged}/kind=0")):
        fs.rename(move(f"{staged}/kind=0"), move(f"{to}/chunks"))
    else:
        spark.createDataFrame([], "key binary, doc_id long, n long, data binary").write.parquet(f"{to}/chunks")
    rows = spark.read.schema("key binary, doc_id long, n long, data binary").parquet(f"{staged}/kind=1") if fs.exists(move(f"{staged}/kind=1")) else spark.createDataFrame([], "key binary, doc_id long, n long, data binary")
    order = [F.col("doc_id").asc_nulls_first(), F.col("data"), F.col("key")]
    placed = prefix_sum(rows, order, F.col("n"), "start", scratch)

    # a staged recipe follows its root
    split = [F.expr(f"substring(data, {KEY + 1}, octet_length(data) - {KEY})").alias("chunks"), F.expr(f"substring(data, 1, {KEY})").alias("root")]
    listed = placed.select("doc_id", "start", F.col("n").alias("n_tokens"), *split, "key")
    listed = listed.repartitionByRange(n, "start", "key").sortWithinPartitions("start", "key").drop("key")
    listed.write.options(**plain).parquet(f"{to}/docs")
    parts = _parts(spark.read.parquet(f"{to}/docs"))
    parts.write.parquet(f"{to}/manifest")
    fs.delete(move(staged), True)


def _parts(docs: DataFrame) -> DataFrame:
    """The manifest's row of each file part: its documents, ids and Merkle root. A part's documents are one group of
    roots (16 bytes each) in order; parts are as large as shuffle partitions, so a group has their bound."""
    named = docs.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("part"), "start", "n_tokens", "root")

    def root(key, rows):
        rows = rows.sort_by([("start", "ascending"), ("n_tokens", "ascending"), ("root", "ascending")])
        return pa.table({"part": [key[0].as_py()], "docs": pa.array([rows.num_rows], pa.int64()), "n_tokens": pa.array([sum(rows["n_tokens"].to_pylist())], pa.int64()), "root": pa.array([merkle(rows["root"].to_pylist())], pa.binary())})

    return named.groupBy("part").applyInArrow(root, "part string, docs long, n_tokens long, root binary")


def _recipes(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    """Every chunk reference (doc_id, start, n_tokens, tail, key, n): the chunk's ids, and those after it in its
    document; and the documents without ids (doc_id, start, n_tokens). Raises where a manifest or root does not hold.
    The starts of documents with ids are distinct."""
    docs = spark.read.schema("doc_id long, start long, n_tokens long, chunks binary, root binary").parquet(f"{store}/docs")
    was = spark.read.schema("part string, docs long, n_tokens long, root binary").parquet(f"{store}/manifest")
    now = _parts(docs)
    broken = was.alias("w").join(now.alias("n"), "part", "full").where("NOT (w.docs <=> n.docs AND w.n_tokens <=> n.n_tokens AND w.root <=> n.root)")
    if broken.take(1):
        raise ValueError("the store's documents do not match its manifest")

    def refer(batches):
        for batch in batches:
            recipes = batch.column(3).to_pylist()
            if any(recipe_root(r) != root for r, root in zip(recipes, batch.column(4).to_pylist(), strict=True)):
                raise ValueError("a recipe does not match its root")
            size = np.array([len(r) // ENTRY for r in recipes], dtype=np.int64)
            entries = np.frombuffer(b"".join(recipes), dtype=np.dtype([("key", f"V{KEY}"), ("n", "<u4")]))
            doc, n = np.repeat(np.arange(len(recipes)), size), entries["n"].astype(np.int64)
            total = np.asarray(batch.column(2))
            if not np.array_equal(np.bincount(doc, weights=n, minlength=len(total)).astype(np.int64), total):
                raise ValueError("a document's chunks do not have its length")
            tail = np.cumsum(total)[doc] - np.cumsum(n)
            keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY), len(n), [None, pa.py_buffer(np.ascontiguousarray(entries["key"]).tobytes())])
            own = [batch.column(i).take(pa.array(doc)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(tail), keys.cast(pa.binary()), pa.array(n)], ["doc_id", "start", "n_tokens", "tail", "key", "n"])

    return docs.mapInArrow(refer, "doc_id long, start long, n_tokens long, tail long, key binary, n long"), docs.where("n_tokens = 0").select("doc_id", "start", "n_tokens")


def _verified(batches, give, kind: pa.DataType, name: str):
    """Batches of (key, n, what `give` makes of a chunk's bytes) of chunks that match their keys."""
    for batch in batches:
        keys, sizes, made = batch.column(0).to_pylist(), [], []
        blake = hashlib.blake2b
        for key, data in zip(keys, batch.column(1).to_pylist(), strict=True):
            if blake(data, digest_size=KEY).digest() != key:
                raise ValueError("a chunk does not match its key")
            raw = unpack(data)
            sizes.append(len(raw))
            made.append(give(raw))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(made, kind)], ["key", "n", name])


def _met(chunks: DataFrame, refs: DataFrame) -> DataFrame:
    """References with what their chunks have; a chunk that the store lacks has null in the column `known`."""
    return refs.join(chunks.withColumnRenamed("n", "known"), "key", "left")


def _check(batch: pa.RecordBatch) -> None:
    if not pc.all(pc.fill_null(pc.equal(batch.column("n"), batch.column("known")), False)).as_py() and batch.num_rows:
        raise ValueError("the store lacks a chunk")


def read_ids(spark: SparkSession, store: str) -> DataFrame:
    """doc_id, start, n_tokens and ids array<int>, put together from verified chunks; the ids cross the network once."""

    def run(batches):
        yield from _verified(batches, np.ndarray.tobytes, pa.binary(), "ids")

    def whole(batches):
        for batch in batches:
            parts = batch.column("got").to_pylist()
            if any(x["known"] != x["n"] for got in parts for x in got):
                raise ValueError("the store lacks a chunk")
            ids = [np.frombuffer(b"".join(x["ids"] for x in got), dtype="<i4") for got in parts]
            at = pa.array(np.concatenate([[0], np.cumsum(list(map(len, ids)))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(at, pa.array(np.concatenate(ids), pa.int32()))], ["doc_id", "start", "n_tokens", "ids"])

    chunks = spark.read.schema("key binary, data binary").parquet(f"{store}/chunks").mapInArrow(run, "key binary, n long, ids binary")
    refs, bare = _recipes(spark, store)
    order = F.struct((-F.col("tail")).alias("at"), "n", "known", "ids")
    got = _met(chunks, refs).groupBy("doc_id", "start", "n_tokens").agg(F.sort_array(F.collect_list(order)).alias("got"))
    schema = "doc_id long, start long, n_tokens long, ids array<int>"
    return got.mapInArrow(whole, schema).unionByName(bare.withColumn("ids", F.array().cast("array<int>")))


def read_digests(spark: SparkSession, store: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, the CRC-32 of the document's ids as little-endian unsigned 32-bit
    integers. Each chunk is read, verified and summed where it lies; only its CRC and length go to documents, whose
    CRC follows from them. So a chunk that many documents share is read once."""

    def run(batches):
        yield from _verified(batches, zlib.crc32, pa.int64(), "crc")

    def share(batches):
        for b in batches:
            _check(b)
            own = crc_before(np.asarray(b.column("crc")), 4 * np.asarray(b.column("tail")))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(own)], ["doc_id", "start", "n_tokens", "crc"])

    chunks = spark.read.schema("key binary, data binary").parquet(f"{store}/chunks").mapInArrow(run, "key binary, n long, crc long")
    refs, bare = _recipes(spark, store)
    shares = _met(chunks, refs).select("doc_id", "start", "n_tokens", "tail", "n", "known", "crc").mapInArrow(share, "doc_id long, start long, n_tokens long, crc long")
    got = shares.groupBy("doc_id", "start", "n_tokens").agg(F.bit_xor("crc").alias("ids_crc32"))
    return got.unionByName(bare.withColumn("ids_crc32", F.lit(0).cast("long")))


def op7_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the public 50k vocabulary with end id 2, written to a store in the shared folder and read back."""
    import public_tokenizers

    to = Scratch(spark).path()
    write_store(table(spark, sf_dir, "documents"), to, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_digests(spark, to)
