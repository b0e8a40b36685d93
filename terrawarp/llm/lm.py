"""LM scoring with a weighted backoff automaton over smoothed n-grams.

Model: P(w | h) = (c(hw) + MU * P(w | h')) / (c(h) + MU), h' the context without its first word; without context
P(w) = (c(w) + 1) / (N + V + 1), whose last unit of mass is that of all unknown words. Counts are of all training
documents, with none cut off. As an automaton: a state for each context seen, an arc for each n-gram seen, and a
failure arc to the state of h' that costs log10(MU / (c(h) + MU)). Texts are read from left to right: the state that
the arc of one place leads to is the one that the next is entered with, failure arcs are followed until an arc fits,
and the log-probabilities add up. NumPy does so for all places of a block at once: an arc leads to the state of the
longest n-gram seen that ends there, so the states of all places are known before the failure arcs are followed.

Distribution: documents are dealt into blocks of about BLOCK_BYTES once. A block sends the hashes of its n-grams with
its own training counts to as many hash ranges, each range adds them up over all blocks and answers each block with
the totals of what it sent, in its order. So a block gets just the part of the automaton that its texts can touch;
nothing that grows with the corpus is broadcast or collected, a frequent n-gram is one entry a block, and no task sees
a whole table. The traffic is about 6 bytes for each distinct n-gram of a block, in one message for each block and
range, and its texts cross the network once.

Defined results
* Null or empty text: the end alone is scored. Very long texts are read whole. Repeated rows: a row each, all learnt.
* A null doc_id is learnt from, not held out. No training documents: N and V are 0, every token scores log10(1/1) = 0.
* An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .toxicity import fold

#: Order of the model and the weight of the shorter context.
ORDER, MU = 3, 32.0
END, START = 0, 1
#: Bytes of texts in a block, about.
BLOCK_BYTES = 12_000_000
#: n-grams are told apart by 56 bits of their hashes: of 10**12 n-grams one in 70,000 shares its hash with another.
_BITS, _DROP = 56, np.uint64(8)
_MIX, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


class _Ids(dict):
    """Words to numbers, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """The tokens of a block's texts and its distinct n-grams.

    Texts lie one after another as START, words, END. grams[k] holds the sorted hashes of distinct (k+1)-grams,
    at[k] for each place the number of the (k+1)-gram that ends there (-1: none)."""

    def __init__(self, texts: list[str | None], order: int):
        names = _Ids({b"\0end": END, b"\0start": START})
        rows, sizes = [], []
        for t in texts:
            row = [START, *map(names.__getitem__, (t or "").encode().lower().split()), END]
            rows.append(np.array(row, dtype=np.int32))
            sizes.append(len(row))
        self.tokens = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.sizes = np.array(sizes, dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1].astype(np.int64)
        word = np.array(list(map(xxhash.xxh64_intdigest, names, repeat(7))), dtype=np.uint64)[self.tokens]
        back = np.arange(len(self.tokens)) - np.repeat(self.starts, self.sizes)
        self.counted = back > 0
        key = _scrambled(word + _ADD)
        self.grams, self.at = [], []
        for k in range(order):
            if k:
                older = np.zeros_like(key)
                older[1:] = key[:-1]
                key = _scrambled(older * _MIX + word + np.uint64(k))
            valid = back >= max(k, 1) if k else np.ones(len(key), bool)
            found, inverse = np.unique(key[valid] >> _DROP, return_inverse=True)
            at = np.full(len(key), -1, dtype=np.int32)
            at[valid] = inverse
            self.grams.append(found)
            self.at.append(at)

    def counts(self, learn: np.ndarray) -> list[np.ndarray]:
        """Of each distinct n-gram, how often it ends in texts that are learnt from. START is not counted."""
        use = np.repeat(learn, self.sizes) & self.counted
        return [np.bincount(at[use & (at >= 0)], minlength=len(g)) for g, at in zip(self.grams, self.at, strict=True)]


class Automaton:
    """States and arcs that a block's texts can touch, from the totals of its n-grams.

    A state of length k is a context of k words, numbered like the block's k-grams; an arc of length k is a
    (k+1)-gram that training texts hold. Words alone are arcs of length 0 and always there."""

    def __init__(self, block: Block, totals: list[np.ndarray], tokens: int, words: int, mu: float):
        self.block, at = block, block.at
        logs = np.log10((totals[0] + 1.0) / (tokens + words + 1.0)) if len(totals[0]) else np.zeros(0)
        uses = totals[0].astype(np.float64)  # as contexts; START comes before each text that is learnt from
        first, last = at[0][block.tokens == START][:1], at[0][block.tokens == END][:1]
        if len(first):
            uses[first] = totals[0][last]
        self.logs, self.seen, self.fail_cost = [logs], [np.ones(len(logs), dtype=bool)], []
        below = 10.0**logs
        for k in range(1, len(totals)):
            ends = np.full(len(block.grams[k]), -1, dtype=np.int64)
            where = np.flatnonzero(at[k] >= 0)
            ends[at[k][where]] = where  # one place of each distinct n-gram
            context, shorter = at[k - 1][ends - 1], at[k - 1][ends]
            below = (totals[k] + mu * below[shorter]) / (uses[context] + mu)
            self.logs.append(np.log10(below))
            self.seen.append(totals[k] > 0)
            self.fail_cost.append(np.log10(mu / (uses + mu)))
            uses = totals[k].astype(np.float64)

    def scores(self) -> np.ndarray:
        """log10 of each text's probability."""
        at, longest = self.block.at, len(self.logs) - 1
        # the length of the arc that each place takes, and of the state that it leads to
        taken = np.zeros(len(self.block.tokens), dtype=np.int64)
        for k in range(1, longest + 1):
            there = at[k] >= 0
            taken[there] = np.where(self.seen[k][at[k][there]], k, taken[there])
        state = np.minimum(taken + 1, longest)
        entered, total = np.concatenate([[0], state[:-1]]), np.zeros(len(taken))
        for k in range(longest, 0, -1):  # states of length k whose arc is missing fail to the next shorter context
            failing = np.flatnonzero((entered >= k) & (taken < k) & self.block.counted)
            total[failing] += self.fail_cost[k - 1][at[k - 1][failing - 1]]
        for k in range(longest + 1):
            here = np.flatnonzero((taken == k) & self.block.counted)
            total[here] += self.logs[k][at[k][here]]
        return np.add.reduceat(total, self.block.starts) if len(total) else total


def _planes(a: np.ndarray) -> bytes:
    """Numbers by their bytes' places, compressed: what changes little shrinks."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).view("<u8").reshape(-1)


def _labels(spark: SparkSession, n: int) -> list[int]:
    """For each of n hash partitions one int that Spark puts there, so that a block or range is a partition."""
    got: dict[int, int] = {}
    size = 16 * n + 64
    while len(got) < n:
        for r in spark.range(size).select(F.col("id").cast("int").alias("i"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p")).groupBy("p").agg(F.min("i").alias("i")).collect():
            got[r.p] = r.i
        size *= 4
    return [got[p] for p in range(n)]


def score_documents(docs: DataFrame, learn: Column, order: int = ORDER, mu: float = MU, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, learnt, n_tokens, n_known, train_tokens, base_score, score) of every document. `learn`, over the
    columns of docs, says which documents are counted; n_known counts tokens that training texts hold."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(docs[text]) + 8)).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    labels = _labels(spark, n)
    pick = F.element_at(F.array(*map(F.lit, labels)), (F.pmod(F.xxhash64(docs[doc_id], docs[text]), F.lit(n)) + 1).cast("int"))
    dealt = docs.select(pick.alias("block"), docs[doc_id].alias("doc_id"), docs[text].alias("text"), F.coalesce(learn, F.lit(False)).alias("learn")).repartition(n, "block")
    edges = np.array([(i << _BITS) // n for i in range(n)], dtype=np.uint64)

    def split(keys: np.ndarray) -> list[int]:
        return [0, *np.searchsorted(keys, edges[1:]).tolist(), len(keys)]

    def profile(batches):
        by: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for b, t, y in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                texts, learnt = by.setdefault(b, ([], []))
                texts.append(t)
                learnt.append(y)
        for b, (texts, learnt) in by.items():
            block = Block(texts, order)
            counts = block.counts(np.array(learnt, dtype=bool))
            cut = [split(g) for g in block.grams]
            for i in range(n):
                pieces = [(g[c[i] : c[i + 1]], x[c[i] : c[i + 1]]) for g, x, c in zip(block.grams, counts, cut, strict=True)]
                # the marks of START are not counted, so its unigram has no count and is no word
                yield pa.RecordBatch.from_arrays([pa.array([labels[i]], pa.int32()), pa.array([b], pa.int32()), pa.array([i], pa.int32()), pa.array([[_planes(np.diff(g, prepend=np.uint64(0))) for g, _ in pieces]], pa.list_(pa.binary())), pa.array([[_planes(x) for _, x in pieces]], pa.list_(pa.binary()))], ["span", "block", "i", "keys", "counts"])

    def add(group):
        keys, counts = group["keys"].to_pylist(), group["counts"].to_pylist()
        answers, tokens, words = [[] for _ in keys], 0, 0
        for k in range(order):
            each = [np.cumsum(_numbers(x[k]), dtype=np.uint64) for x in keys]
            sizes = [len(x) for x in each]
            _, inverse = np.unique(np.concatenate(each), return_inverse=True)
            total = np.bincount(inverse, weights=np.concatenate([_numbers(x[k]) for x in counts]).astype(np.float64)).astype(np.uint64) if len(inverse) else np.zeros(0, np.uint64)
            if k == 0:
                tokens, words = int(total.sum()), int((total > 0).sum())
            for a, part in zip(answers, np.split(total[inverse], np.cumsum(sizes)[:-1]), strict=True):
                a.append(_planes(part))
        return pa.table({"block": group["block"], "i": group["i"], "totals": pa.array(answers, pa.list_(pa.binary())), "tokens": pa.array([tokens] * len(keys), pa.int64()), "words": pa.array([words] * len(keys), pa.int64())})

    out = T.StructType([dealt.schema["doc_id"], *T.StructType.fromDDL("learnt boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])

    def read(left, right):
        block = Block(left["text"].to_pylist(), order)
        rows = sorted(zip(right["i"].to_pylist(), right["totals"].to_pylist(), right["tokens"].to_pylist(), right["words"].to_pylist(), strict=True))
        totals = [np.concatenate([_numbers(r[1][k]) for r in rows]).astype(np.float64) for k in range(order)]
        tokens, words = sum(r[2] for r in rows), sum(r[3] for r in rows)
        machine = Automaton(block, totals, tokens, words, mu)
        counted, word = block.counted, block.at[0]
        base = np.add.reduceat(np.where(counted, machine.logs[0][word], 0.0), block.starts)
        known = np.add.reduceat((counted & (totals[0][word] > 0)).astype(np.int64), block.starts)
        return pa.table({"doc_id": left["doc_id"], "learnt": left["learn"], "n_tokens": pa.array(block.sizes - 1), "n_known": pa.array(known), "train_tokens": pa.array([tokens] * len(known), pa.int64()), "base_score": pa.array(base), "score": pa.array(machine.scores())})

    sent = dealt.mapInArrow(profile, "span int, block int, i int, keys array<binary>, counts array<binary>")
    totals = sent.groupBy("span").applyInArrow(add, "block int, i int, totals array<binary>, tokens long, words long")
    return dealt.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(read, out)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents outside fold 2 of 7 and scores all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = score_documents(docs, fold(F.col("doc_id"), 7) != 2)
    return got.select("doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
