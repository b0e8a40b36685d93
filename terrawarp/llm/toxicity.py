"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its words (ASCII lower-cased, punctuation at the ends dropped), pairs of neighbours and pairs
with one word between, each hashed to 32 bits, present or not. Per-coordinate learning rates and the L1 term leave
a few thousand weights at most that are not zero; they travel to the executors with the scoring function.

The fit takes a bounded sample: `sample` labelled rows (expected number; rows whose id hashes below a threshold that
follows from their count, so no sort and the same rows each time), whose features meet in one task. Scoring reads
every whole text, without a shuffle.

Defined results
* Null or empty text: no features, the score is the bias alone. Very long texts are read whole.
* Labels that are neither 0 nor 1, and null doc_ids in labels, teach nothing. Repeated labels each teach.
* No labels to learn from: every score is 0.5 less a hair (predicted 0). Repeated documents score alike.
* A null doc_id is kept and not held out. An empty table gives no rows.
* `score` keeps other columns; score and predicted replace columns of those names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import blocks
from .common import free_name, table

#: FTRL: alpha, beta, L1, L2, passes; labelled rows to learn from.
ALPHA, BETA, L1, L2, PASSES, SAMPLE = 1.0, 1.0, 3.0, 0.5, 3, 16_000
_EDGES = b".,;:!?%&*#$\"'()|[]{}<>-_/\\"


def features(text: str | None) -> np.ndarray:
    """The distinct hashed features of a text, as unsigned 32-bit integers."""
    words = [w.strip(_EDGES) for w in (text or "").encode().lower().split()]
    h = np.array(list(map(xxhash.xxh64_intdigest, words)), dtype=np.uint64)
    pair = lambda a, b, k: (a * np.uint64(0x9E3779B97F4A7C15) ^ (b + np.uint64(k))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.concatenate([h >> np.uint64(32), pair(h[:-1], h[1:], 1) >> np.uint64(32), pair(h[:-2], h[2:], 2) >> np.uint64(32)]).astype(np.uint32)


@dataclass
class Model:
    """Sorted feature hashes with a weight, and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.near = np.zeros(1 << 20, dtype=bool)
        self.near[self.keys & np.uint32((1 << 20) - 1)] = True

    def score(self, text: str | None) -> float:
        f = features(text)
        f = np.unique(f[self.near[f & np.uint32((1 << 20) - 1)]])
        z = self.bias
        if len(f) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, f), len(self.keys) - 1)
            z += float(self.weights[at][self.keys[at] == f].sum())
        return float(1 / (1 + np.exp(-min(max(z, -35.0), 35.0))))


def ftrl(examples: list[np.ndarray], labels: np.ndarray, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2, passes: int = PASSES) -> Model:
    """FTRL-proximal over the examples (feature hashes) in the given order, `passes` times."""
    if not len(labels):
        return Model(np.zeros(0, np.uint32), np.zeros(0), -1e-9)
    sets = [x if (x[1:] > x[:-1]).all() else np.unique(x) for x in examples]
    flat = np.concatenate(sets)
    flat.sort()  # in place, as the sample's features are the most that a worker holds
    first = np.append(True, flat[1:] != flat[:-1])[: len(flat)]
    again = np.append(~first[1:], False)[: len(flat)]
    every = flat[first & again]  # a feature of one example says nothing of others
    del flat, first, again

    def placed(features):
        i = np.searchsorted(every, features)
        near = i < len(every)
        i, features = i[near], features[near]
        return np.append(i[every[i] == features], len(every)).astype(np.int32)

    at = [placed(x) for x in sets]
    z, n = np.zeros(len(every) + 1), np.zeros(len(every) + 1)

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(z[i]) <= l1, 0.0, w)

    for _ in range(passes):
        for i, y in zip(at, labels.tolist(), strict=True):
            w = weights(i)
            g = 1 / (1 + np.exp(-min(max(float(w.sum()), -35.0), 35.0))) - y
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - s * w
            n[i] += g * g
    w = weights(np.arange(len(every) + 1))
    kept = np.flatnonzero(w[:-1])
    return Model(every[kept], w[kept], float(w[-1]) if w[-1] < 0 or w[-1] > 0 else -1e-9)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fits on rows of `labels` for which `learn` (over its columns) holds, joined to their texts."""
    spark = docs.sparkSession
    rows = labels.where(learn & F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y"))
    total = rows.count()
    order = F.xxhash64(F.lit("toxicity"), "_id").bitwiseAND(F.lit((1 << 40) - 1))
    rows = rows.where(order < int(min(1.0, sample / max(total, 1)) * (1 << 40)))  # bounded by `sample`, so it may be broadcast
    texts = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text")).join(F.broadcast(rows), "_id")

    def extract(batches):
        for batch in batches:
            for part in blocks(batch.column(1)):
                found = [np.unique(features(t)).tobytes() for t in batch.column(1)[part].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], batch.column(2)[part], pa.array(found, pa.binary())], ["id", "y", "f"])

    def train(group):
        got = zip(group["id"].to_pylist(), group["y"].to_pylist(), [v.as_buffer() for c in group["f"].chunks for v in c], strict=True)
        key = lambda r: (xxhash.xxh64_intdigest(str(r[0]).encode(), 1), r[0], r[1], xxhash.xxh64_intdigest(r[2]))
        got = sorted(got, key=key)
        m = ftrl([np.frombuffer(r[2], dtype=np.uint32) for r in got], np.array([r[1] for r in got], dtype=float))
        return pa.table({"keys": pa.array([m.keys.tobytes()], pa.binary()), "weights": pa.array([m.weights.tobytes()], pa.binary()), "bias": pa.array([m.bias], pa.float64())})

    id_type = texts.schema["_id"]
    made = texts.select("_id", "_text", "_y").mapInArrow(extract, T.StructType([T.StructField("id", id_type.dataType), T.StructField("y", T.IntegerType()), T.StructField("f", T.BinaryType())]))
    got = made.groupBy().applyInArrow(train, "keys binary, weights binary, bias double").collect()
    if not got:
        return ftrl([], np.zeros(0))
    return Model(np.frombuffer(got[0].keys, dtype=np.uint32), np.frombuffer(got[0].weights), got[0].bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score double and predicted int added. No shuffle."""
    base = docs.drop(*[c for c in docs.columns if c.lower() in ("score", "predicted") and c != text])
    kept = [c for c in base.columns if c.lower() not in ("score", "predicted")]
    t = free_name(base, "_t")
    source = base.withColumn(t, F.col(text)).select(*kept, t)
    keys, weights, bias = model.keys, model.weights, model.bias

    def run(batches):
        m = Model(keys, weights, bias)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for part in blocks(texts):
                s = np.array([m.score(x) for x in texts[part].to_pylist()], dtype=float)
                yield pa.RecordBatch.from_arrays([*(c[part] for c in batch.columns[:-1]), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())], [*kept, "score", "predicted"])

    return source.mapInArrow(run, T.StructType([*[source.schema[c] for c in kept], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def fold(doc_id: Column, of: int, null: int = -1) -> Column:
    """crc32 of the id as text, modulo `of`."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of, F.lit(null))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the labels outside the held-out fifth and scores all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return score(docs, model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
