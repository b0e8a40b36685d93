"""The training-data operators against brute force, on small and on nasty inputs."""

import collections
import hashlib
import math
import pickle
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from terrawarp.llm import bpe, cover_topk, graph_ann, id_store, line_dedup, lm, mixing, queries, simhash, toxicity, url_filter
from terrawarp.llm import vectors as vectors_
from terrawarp.llm.common import Scratch, components, prefix_sum, word_count

DOCS = "doc_id long, text string, source string, size int, Score string"
WORD = re.compile("[^\x20\x09-\x0d]+")
NASTY = [None, "", " ", "\n\n", "A", "a b", "Ä ß x", "é😀 日本語  x\t\ty", "<|endoftext|> a", "x" * 3000, "w " * 4000, "Same Text here again"]


def nasty(spark, rows=1):
    """Null, empty, long and repeated texts, null and repeated ids, null sources, and columns whose names clash."""
    data = [(None if i == 3 else i, t, None if i % 4 == 0 else f"s{i % 3}", i, "z") for i, t in enumerate(NASTY)] * rows
    return spark.createDataFrame([*data, (11, "Same Text here again", "s2", 11, "z"), (40, None, None, None, None)], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_word_count(spark):
    rows = nasty(spark).select("text", word_count(F.col("text")).alias("n")).collect()
    assert all(r.n == len(words(r.text)) for r in rows)


def test_prefix_sum_and_components(spark):
    scratch = Scratch(spark)
    df = spark.range(500).select(F.hash("id").alias("o"), "id")
    got = {r.id: r.s for r in prefix_sum(df, [F.col("o"), F.col("id")], F.col("id"), "s", scratch).collect()}
    total, want = 0, {}
    for r in sorted(df.collect(), key=lambda r: (r.o, r.id)):
        want[r.id] = total
        total += r.id
    assert got == want
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(150)] + [(500, k) for k in range(501, 600)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0


def test_components_of_many_edges(spark):
    n = 1_200_000
    edges = spark.range(n).select((F.col("id") * 3 + 1).alias("a"), (F.col("id") * 3).alias("b"))
    got = components(edges, Scratch(spark))
    assert got.where("label <> node - node % 3").count() == 0 and got.distinct().count() == got.count() == 2 * n


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w, fixed, total = {s: weights[i % 3] for i, s in enumerate(order)}, {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left, by = total - sum(fixed.values()), sum(w[s] for s in free)
        now = {s: left * w[s] / by for s in free}
        over = [s for s in free if now[s] > cap * sizes[s] + 1e-9]
        if not over:
            return {**fixed, **now}
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("n", [1, 2, 3, 8, 25])
def test_mix_targets(spark, n):
    rng = random.Random(n)
    sizes = {(None if i == 2 else f"s{i:02d}"): rng.choice([0, 1, 30, 900, 5000]) * rng.randint(1, 9) for i in range(n)}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), (3, 1, 2), 1.5, 2.0).collect()
    want = brute_targets(sizes)
    assert all(math.isclose(r.target, want[r.source], abs_tol=1e-6) for r in got)


def test_mix_meets_targets(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 60), f"s{min(i % 9, 3)}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    by = collections.defaultdict(list)
    for r in got:
        assert r.size == len(words(r.text)) and 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies
        by[r.source].append(r)
    want = brute_targets({s: sum(r.size for r in g) for s, g in by.items()})
    for s, g in by.items():
        assert math.isclose(g[0].target, want[s]) and abs(sum(r.taken for r in g) - want[s]) <= 30
    assert sorted((r.doc_id, r.taken) for r in mixing.mix(docs).collect()) == sorted((r.doc_id, r.taken) for r in got)
    assert mixing.mixed(docs).groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    assert mixing.mix(empty(spark)).count() == 0
    odd = mixing.mix(nasty(spark))
    assert odd.count() == len(NASTY) + 2 and {"Score", "taken"} <= set(odd.columns)


def brute_fingerprint(text, n):
    w = words(ascii_lower(text))
    if not w:
        return 0
    sh = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_fingerprints(spark):
    got = simhash.simhash_components(nasty(spark)).collect()
    assert len(got) == len(NASTY) + 2
    want = collections.Counter((r.doc_id, f"{brute_fingerprint(r.text, 3):016x}") for r in nasty(spark).collect())
    assert collections.Counter((r.doc_id, r.fingerprint) for r in got) == want
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {0}
    assert simhash.simhash_components(empty(spark)).count() == 0


@pytest.mark.parametrize("limit", [32, 2, 1])
def test_simhash_links(spark, monkeypatch, limit):
    """All pairs at most 2 bits apart are connected, by pairs and by the linear way of hot buckets."""
    monkeypatch.setattr(simhash, "LIMIT", limit)
    rng, fps = random.Random(3), set()
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(6):
            for _ in range(rng.choice([1, 1, 2, 3])):
                x ^= 1 << rng.choice([0, 5, 17, 31, 32, 47, 48, 62, 63])
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.link_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"), Scratch(spark))
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2 for r in edges.collect())
    group = {r.node: r.label for r in components(edges, Scratch(spark)).collect()}
    for i, a in enumerate(signed):
        for b in signed[i + 1 :]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2:
                assert group[a] == group[b]


def vocabulary(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


@pytest.mark.parametrize(("limit", "wide"), [(32, 256), (2, 256), (2, 1)])
def test_near_duplicates(spark, monkeypatch, limit, wide):
    monkeypatch.setattr(simhash, "LIMIT", limit)
    monkeypatch.setattr(simhash, "WIDE", wide)
    rng, vocab, rows = random.Random(2), vocabulary(2000, 1), []
    for k in range(40):
        base = [rng.choice(vocab) for _ in range(200)]
        rows.append((10 * k, " ".join(base)))
        for j in range(1, 5):  # up to two words changed: Jaccard of five-word shingles 0.9 and more
            copy = list(base)
            for _ in range(j % 3):
                copy[rng.randrange(200)] = rng.choice(vocab)
            rows.append((10 * k + j, " ".join(copy)))
    rows += [(1000 + k, " ".join(rng.choice(vocab) for _ in range(100))) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    assert left == {10 * k for k in range(40)} | {1000 + k for k in range(50)}


def shingled(at, n, vocab):
    """A text of n shingles of its own, whose words name the place."""
    return " ".join(vocab[(at + i) % len(vocab)] for i in range(n + 4))


def brute_shingles(text):
    w = words(ascii_lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


@pytest.mark.parametrize("width", [8, 20])
def test_near_duplicates_verdict(spark, monkeypatch, width):
    """Pairs of 0.7 to 0.85 and of 8 to 10 words against brute force, with the blocks of few and of many texts."""
    plan = simhash.plan_blocks
    monkeypatch.setattr(simhash, "plan_blocks", lambda texts, similarity: plan(2 ** (width + 4), similarity))
    vocab, rows, at = vocabulary(80_000, 5), [], 0
    for k in range(60):
        for n, m in ((70, 100), (75, 100), (79, 100), (80, 100), (85, 100), (4, 5), (5, 6), (3, 4)):
            rows += [(len(rows), shingled(at, n, vocab)), (len(rows) + 1, shingled(at, m, vocab))]
            at += m + 4
    label = {r.doc_id: r.label for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = similar = 0
    for (i, x), (j, y) in zip(rows[::2], rows[1::2], strict=True):
        x, y = brute_shingles(x), brute_shingles(y)
        alike = 5 * len(x & y) >= 4 * len(x | y)
        assert alike or label[i] != label[j]
        similar, found = similar + alike, found + (alike and label[i] == label[j])
    assert similar == 240 and found >= 0.98 * similar


def variants(n, seed, words=120, least=0, most=9):
    """Texts made of one by changing some words, few of them near copies of each other."""
    rng, vocab, rows = random.Random(seed), vocabulary(4000, seed), []
    base = [rng.choice(vocab) for _ in range(words)]
    for _ in range(n):
        text = list(base)
        for at in rng.sample(range(words), rng.randint(least, most)):
            text[at] = rng.choice(vocab)
        rows.append((len(rows), " ".join(text)))
    return rows


def brute_classes(rows):
    """The classes of the links of all pairs."""
    of, got = list(range(len(rows))), [brute_shingles(t) for _, t in rows]
    find = lambda i: i if of[i] == i else find(of[i])
    for i, x in enumerate(got):
        for j in range(i):
            if 5 * len(x & got[j]) >= 4 * len(x | got[j]):
                of[find(i)] = find(j)
    return sorted(sorted(rows[i][0] for i in range(len(rows)) if find(i) == k) for k in {find(i) for i in range(len(rows))})


def classes(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.label, []).append(r.doc_id)
    return sorted(map(sorted, found.values()))


def test_group_links_are_exact(spark, monkeypatch):
    """Groups of variants, of several texts at once and of unrelated ones, with nodes that meet in crowds, against all pairs."""
    monkeypatch.setattr(simhash, "LIMIT", 4)
    rows = variants(150, 1) + variants(100, 2, 60, 3, 9) + [r for k in range(40) for r in variants(2, 10 + k, 40, 0, 2)]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    made = simhash._wide(spark.createDataFrame(rows, "doc_id long, text string"), 5, 8, 80, 80, "doc_id", "text").cache()
    nodes = made.groupBy("node").agg(F.first("doc_id").alias("c"))
    for group in (nodes.withColumn("label", F.lit(1).cast("long")), nodes.withColumn("label", (F.col("c") >= 150).cast("long"))):
        scratch = Scratch(spark)
        label = components(simhash.group_links(group, made.select("node", "shingles"), 0.8, scratch), scratch)
        got = classes(made.select("doc_id", "node").join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))
        assert got == brute_classes(rows)


def test_near_links_of_one_shared_block(spark, monkeypatch):
    """Near copies that share one block alone, a hot one of many unrelated texts, are linked."""
    monkeypatch.setattr(simhash, "LIMIT", 8)
    monkeypatch.setattr(simhash, "WIDE", 8)
    rows = [r for k in range(60) for r in variants(2, 50 + k, 80, 0, 1)]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    made = simhash._wide(spark.createDataFrame(rows, "doc_id long, text string"), 5, 8, 80, 80, "doc_id", "text").cache()
    nodes = made.select("node", "n", "fp", F.array(F.lit(0).cast("long")).alias("keys")).dropDuplicates(["node"])
    scratch = Scratch(spark)
    label = components(simhash.near_links(nodes, made.select("node", "shingles"), 0.8, scratch), scratch)
    got = classes(made.select("doc_id", "node").join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))
    assert got == brute_classes(rows) and len(got) < 90


def test_near_duplicates_pair_few_variants(spark, monkeypatch):
    """Variants of one text that are no near copies are not paired with each other: pairs grow with the texts."""
    monkeypatch.setattr(simhash, "LIMIT", 8)
    rows, asked, plain = variants(600, 3, 120, 3, 9), [], simhash.verified
    monkeypatch.setattr(simhash, "verified", lambda pairs, *more: asked.append(pairs.count()) or plain(pairs, *more))
    got = classes(simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute_classes(rows) and sum(asked) < 5 * len(rows)


def test_near_duplicates_edges(spark):
    got = simhash.drop_near_duplicates(nasty(spark, 2))
    assert got.columns == [c.split()[0] for c in DOCS.split(", ")]
    ids = [r.doc_id for r in got.collect()]
    assert ids.count(11) == 1 and ids.count(0) == 1 and 1 not in ids and 40 not in ids
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def brute_lines(rows, least):
    """By the definition: every run of `least` words or more that begins at an earlier place too is cut."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    lines = [r[1].split("\n") for r in docs]
    gone = [set() for _ in docs]
    places = [(d, i) for d, x in enumerate(lines) for i in range(len(x))]
    for d, i in places:
        for e, j in places:
            if (e, j) >= (d, i):
                break
            n = 0
            while i + n < len(lines[d]) and j + n < len(lines[e]) and lines[d][i + n] == lines[e][j + n]:
                n += 1
            if sum(len(words(x)) for x in lines[d][i : i + n]) >= least:
                gone[d].update(range(i, i + n))
    return {r: "\n".join(x for k, x in enumerate(ls) if k not in g) for r, ls, g in zip(docs, lines, gone, strict=True)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup(spark, seed):
    rng, rows = random.Random(seed), []
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 4))) for _ in range(6)]
    for k in range(40):
        rows.append((k, "\n".join(rng.choice(pool) if rng.random() < 0.9 else f"own {k} {i}" for i in range(rng.randint(0, 14)))))
    rows += [(99, "x y\n" * 30), (None, rows[5][1]), (98, None), rows[3]]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").withColumn("src", F.col("text")), 6).collect()
    want = brute_lines(rows, 6)
    assert len(got) == len(rows)
    for r in got:
        assert r.text == (None if r.src is None else want[r.doc_id, r.src])
        assert r.n_lines - r.n_removed == (0 if r.src is None or (r.n_removed and r.text == "" and r.n_lines == r.n_removed) else len(r.text.split("\n")))


def test_line_dedup_edges(spark):
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
    out = line_dedup.dedup_lines(nasty(spark).withColumn("n_lines", F.lit("x")))
    assert out.count() == len(NASTY) + 2 and dict(out.dtypes)["n_lines"] == "bigint"
    passage = "\n".join(f"line {i} of a passage that repeats with a few more words" for i in range(6))
    rows = [(1, "own start\n" + passage + "\nown end"), (2, passage), (3, "clean text\nof its own")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "", 3: rows[2][1]}


def brute_top(rows, queries, k, score):
    out = {}
    for q, v in queries:
        best = {}
        for s, i in sorted((-score(v, x), i) for i, x in {(i, tuple(x)) for i, x in rows} if i != q):
            best.setdefault(i, -s)
        out[q] = list(best.items())[:k]
    return out


def vectors(n, seed, dims=8, copies=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims)) / 3
    v[n - copies :] = v[0]
    return [(i, [float(x) for x in np.float32(r)]) for i, r in enumerate(v)]


def test_exact_topk(spark, monkeypatch):
    monkeypatch.setattr(cover_topk, "SHARD", 150)
    monkeypatch.setattr(cover_topk, "LEAF", 8)
    rows = vectors(500, 1, copies=120)
    bad = [(900, None), (None, [1.0] * 8), (901, [float("nan")] + [0.0] * 7), (902, [float("inf")] * 8), (903, [None] * 8), (904, [0.0] * 8), (950, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = collections.defaultdict(list)
    for r in cover_topk.exact_topk(df, df.where("vec_id % 50 = 0"), 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows] + [(904, [0] * 8), (950, [0] * 8)]
    want = brute_top(whole, [w for w in whole if w[0] % 50 == 0], 5, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    assert dict(got) == want
    assert cover_topk.exact_topk(df.where("false"), df.where("false"), 5).count() == 0
    assert cover_topk.exact_topk(df.where("vec_id < 2"), df.where("vec_id = 0"), 5).count() == 1


def test_vectors_of_one_id(spark, monkeypatch):
    """Rows that share an id count by their best, in one shard and across shards; the least vector of an id asks."""
    rows = [(i // 3, x) for i, x in vectors(900, 5, copies=60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asks = [(q, min(x for i, x in rows if i == q)) for q in range(0, 300, 20)]
    for size in (100, 5000):
        monkeypatch.setattr(cover_topk, "SHARD", size)
        got = collections.defaultdict(list)
        for r in cover_topk.exact_topk(df, df.where("vec_id % 20 = 0"), 5).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.vec_id, r.score))
        whole = lambda v: [math.floor(256 * x) for x in v]
        floored = [(q, min(whole(x) for i, x in rows if i == q)) for q, _ in asks]
        assert dict(got) == brute_top([(i, whole(x)) for i, x in rows], floored, 5, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    got = collections.defaultdict(list)
    for r in graph_ann.graph_search(df, df.where("vec_id % 20 = 0"), 20).collect():
        got[r.query_id].append(r.vec_id)
    want = brute_top(rows, asks, 20, lambda a, b: float(np.dot(a, b)))
    assert all(len(set(v)) == len(v) == 20 for v in got.values())
    assert sum(len({i for i, _ in want[q]} & set(got[q])) for q in want) >= 0.9 * 20 * len(want)


def test_regions_spare_shards(spark, monkeypatch):
    """On clustered vectors most shards can't hold an answer, and are not met; nor is a hot cluster one shard."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16)) * 4
    x = np.concatenate([centres[rng.integers(0, 12, 1200)] + rng.normal(size=(1200, 16)) / 9, np.repeat(centres[:1], 600, axis=0)])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(np.float32(x))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    data = vectors_.usable(df, "vec_id", "embedding", zero=True)
    kept, regions = vectors_.placed(data, 100, lambda v: v, Scratch(spark))
    assert max(r["count"] for r in kept.groupBy("part").count().collect()) < 200
    asked = vectors_.asked_once(data.where("vec_id % 10 = 0"), lambda v: v, Scratch(spark))
    routes = vectors_.first_routes(asked, regions)
    exact = brute_top(rows, [(i, v) for i, v in rows if i % 10 == 0], 5, lambda a, b: float(np.dot(a, b)))
    kth = spark.createDataFrame([(q, found[-1][1]) for q, found in exact.items()], "vec_id long, kth double")
    pairs = vectors_.other_routes(routes.join(kth, "vec_id"), regions).count()
    assert pairs < 0.5 * asked.count() * int(regions.shards.sum())
    monkeypatch.setattr(cover_topk, "SHARD", 100)
    monkeypatch.setattr(graph_ann, "SHARD", 100)
    got = collections.defaultdict(list)
    for r in graph_ann.graph_search(df, df.where("vec_id % 10 = 0"), 5).collect():
        got[r.query_id].append(r.vec_id)
    assert sum(len({i for i, _ in exact[q]} & set(got[q])) for q in exact) >= 0.9 * 5 * len(exact)


def test_exact_topk_of_huge_components():
    rng = np.random.default_rng(4)
    v = rng.integers(-(2**40), 2**40, size=(60, 3)).astype(float)
    ids = np.arange(60)
    got = collections.defaultdict(list)
    w = cover_topk.whole(v)
    for q, i, s in zip(*cover_topk.dual_search(cover_topk.pack_points(ids, w, 4), cover_topk.pack_points(ids[:9], w[:9], None), 4), strict=True):
        got[q].append((i, s))
    whole = [(i, [int(256 * x) for x in r]) for i, r in enumerate(v.tolist())]
    clip = lambda s: max(min(s, 2**63 - 1), -(2**63))
    want = brute_top(whole, whole[:9], 4, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    assert {q: [clip(s) for _, s in x] for q, x in got.items()} == {q: [clip(s) for _, s in x] for q, x in want.items()}


def test_graph_search(spark, monkeypatch):
    monkeypatch.setattr(graph_ann, "SHARD", 400)
    rows = vectors(1200, 2, dims=16, copies=300)
    df = spark.createDataFrame([*rows, (2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16)], "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in graph_ann.graph_search(df, df.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = brute_top(rows, [r for r in rows if r[0] % 20 == 0], 20, lambda a, b: float(np.dot(a, b)))
    assert set(got) == set(want)
    by = dict(rows)
    hits = 0
    for q, found in got.items():
        assert len(found) == 20 and q not in dict(found)
        assert all(math.isclose(s, float(np.dot(by[q], by[i])), rel_tol=1e-9, abs_tol=1e-12) for i, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        hits += len({i for i, _ in found} & {i for i, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)
    assert graph_ann.graph_search(df.where("false"), df.where("false"), 20).count() == 0


def test_lm_scores(spark):
    rng, vocab = random.Random(7), vocabulary(60, 3)
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 30)))) for i in range(120)] + [(200, None), (201, "Unknown WORDS only"), (None, "null id here"), (5, "again five"), (5, "again five")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learn = toxicity.fold(F.col("doc_id"), 7) != 2
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    for order in (1, 2, 3):
        grams = [collections.Counter() for _ in range(order)]
        for i, t in rows:
            if not held[i]:
                seq = [0, *ascii_lower(t).split(), 1]
                for k in range(order):
                    grams[k].update(tuple(seq[j - k : j + 1]) for j in range(max(k, 1), len(seq)))
        total, kinds, starts = sum(grams[0].values()), len(grams[0]), grams[0][1,]

        def prob(context, w, grams=grams, total=total, kinds=kinds, starts=starts):
            if not context:
                return (grams[0][w,] + 1) / (total + kinds + 1)
            uses = starts if context == (0,) else grams[len(context) - 1][context]
            return (grams[len(context)][(*context, w)] + lm.MU * prob(context[1:], w)) / (uses + lm.MU)

        got = collections.defaultdict(list)
        for r in lm.score_documents(docs, learn, order=order).collect():
            got[r.doc_id].append(r)
        assert sum(map(len, got.values())) == len(rows)
        for i, t in rows:
            seq = [0, *ascii_lower(t).split(), 1]
            score = sum(math.log10(prob(tuple(seq[max(0, j - order + 1) : j]), seq[j])) for j in range(1, len(seq)))
            base = sum(math.log10(prob((), w)) for w in seq[1:])
            assert any(math.isclose(r.score, score, rel_tol=1e-9) and math.isclose(r.base_score, base, rel_tol=1e-9) and r.n_tokens == len(seq) - 1 and r.n_known == sum((w,) in grams[0] for w in seq[1:]) and r.train_tokens == total and r.learnt != held[i] for r in got[i])
    assert lm.score_documents(empty(spark), learn).count() == 0


@pytest.fixture(scope="module")
def tokenizers_files():
    return pytest.importorskip("public_tokenizers")


def reference_encoder(public):
    import base64

    import tiktoken

    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_bpe_equals_the_rank_library(tokenizers_files):
    want = reference_encoder(tokenizers_files)
    rng = np.random.default_rng(0)
    alphabet = list(" \n\tab'1é! \x1c日　") + ["don't", "  ", "\n\n", "ing "]
    texts = [t or "" for t in NASTY] + ["a\nb", "x\n\n\ny", "a\n", "a\n\n", "\na", "a\n b", "a\t\nb", " a", "a ", "!!!\x1f!! "] + ["".join(rng.choice(alphabet, size=rng.integers(1, 25))) for _ in range(3000)]
    for c in (bpe.codec(tokenizers_files.path("byte_bpe_50k.tiktoken"), tokenizers_files.PATTERN), bpe.codec(tokenizers_files.path("byte_bpe_50k.json"))):
        ids, at = c.encode(pa.array(texts, pa.string()))
        assert [x.tolist() for x in np.split(ids, at[1:-1])] == [want(t) for t in texts]
        raw, to = c.decode(ids, at)
        assert [x.tobytes().decode() for x in np.split(raw, to[1:-1])] == texts
        with pytest.raises(ValueError):
            c.decode(np.array([10**6], dtype="<u4"), at)


def test_bpe_memo_forgets(tokenizers_files, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_PARTS", 4)
    c = bpe.Codec(bpe.codec(tokenizers_files.path("byte_bpe_50k.json")).tokenizer, bpe.codec(tokenizers_files.path("byte_bpe_50k.json")).id_bytes)
    want = reference_encoder(tokenizers_files)
    for t in ("one two three four two three four", "two six six seven seven eight", "one six nine ten", " ".join(["y" * 99, "z", "y" * 99, "y" * 99]), "", "two three"):
        assert c.encode(pa.array([t, None, t]))[0].tolist() == want(t) * 2
        assert len(c.memo) <= 2 and not any(len(p) > bpe.MEMO_LENGTH for p in c.memo | c.memo.older)


def test_bpe_knows_all_white_space():
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    known = bpe.pc.utf8_is_space(pa.array(chars)).to_pylist()
    assert all(k for c, k in zip(chars, known, strict=True) if c.isspace() or re.match(r"\s", c))


def test_bpe_blocks():
    texts = pa.array(["aaaa", None, "bb", "c" * 20, "", "d"])
    cut = [(s.start, s.stop) for s in bpe.blocks(texts, 6)]
    assert cut == [(0, 3), (3, 4), (4, 6)] and not list(bpe.blocks(texts[:0], 6))


def test_encode_decode_frames(spark, tokenizers_files):
    path, pattern = tokenizers_files.path("byte_bpe_50k.tiktoken"), tokenizers_files.PATTERN
    docs = nasty(spark).withColumn("n_tokens", F.lit("clash"))
    out = bpe.encode(docs, path, pattern, offsets=True)
    back = bpe.decode(out, path, pattern)
    want = reference_encoder(tokenizers_files)
    for r in back.collect():
        assert r.ids == want(r.text or "") and r.n_tokens == len(r.ids) and r.decoded == (r.text or "")
        if r.ids and (r.text or "").isascii():
            assert "".join(r.text[o.start : o.end] for o in r.offsets) == r.text
    assert bpe.encode(empty(spark), path, pattern).count() == 0
    trip = bpe.round_trip(nasty(spark), path, pattern, with_ids=True).collect()
    assert {r.decoded_sha256 for r in trip} == {hashlib.sha256((t or "").encode()).hexdigest() for t in NASTY}
    assert all(r.ids_sha256 == hashlib.sha256(np.array(r.ids, dtype="<u4").tobytes()).hexdigest() for r in trip)


def test_id_store(spark, tokenizers_files, tmp_path):
    path = tokenizers_files.path("byte_bpe_50k.json")
    rng, vocab = random.Random(1), vocabulary(3000, 9)
    long = " ".join(rng.choice(vocab) for _ in range(3000))
    docs = nasty(spark).select("doc_id", "text").unionByName(spark.createDataFrame([(70, long), (71, "new start " + long), (72, long)], "doc_id long, text string"))
    store = str(tmp_path / "store")
    id_store.write_store(docs, store, path, end_id=2)
    want, encode, start = [], reference_encoder(tokenizers_files), 0
    rows = collections.Counter()
    for r in docs.collect():
        rows[r.doc_id, tuple([*encode(r.text or ""), 2])] += 1
    whole = id_store.read_ids(spark, store).orderBy("start").collect()
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in whole) == rows
    for r in whole:
        assert r.start == start and r.n_tokens == len(r.ids)
        start += r.n_tokens
        want.append((r.doc_id, r.start, r.n_tokens, zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())))
    assert [r.doc_id for r in whole] == sorted((r.doc_id for r in whole), key=lambda x: (x is not None, x or 0))
    assert sorted(tuple(r) for r in id_store.read_digests(spark, store).collect() if r.doc_id is not None) == sorted(w for w in want if w[0] is not None)
    chunks = spark.read.parquet(f"{store}/chunks")
    stored = chunks.agg(F.sum(F.octet_length("data"))).first()[0]
    assert chunks.count() == chunks.select("key").distinct().count() and stored < 2 * start * 0.75  # three copies, stored about once
    none = str(tmp_path / "none")
    id_store.write_store(empty(spark), none, path, end_id=2)
    assert id_store.read_digests(spark, none).count() == 0


def test_id_store_without_end_id(spark, tokenizers_files, tmp_path):
    docs = spark.createDataFrame([(1, ""), (1, ""), (2, None), (3, "a b"), (4, ""), (None, ""), (None, None)], "doc_id long, text string")
    store, encode = str(tmp_path / "store"), reference_encoder(tokenizers_files)
    id_store.write_store(docs, store, tokenizers_files.path("byte_bpe_50k.json"))
    want = collections.Counter((r.doc_id, tuple(encode(r.text or ""))) for r in docs.collect())
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in id_store.read_ids(spark, store).collect()) == want
    got = collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in id_store.read_digests(spark, store).collect())
    assert got == collections.Counter((i, len(t), zlib.crc32(np.array(t, dtype="<u4").tobytes())) for i, t in want.elements())


def test_id_store_notices_damage(spark, tokenizers_files, tmp_path):
    store = str(tmp_path / "store")
    id_store.write_store(nasty(spark), store, tokenizers_files.path("byte_bpe_50k.json"))
    other = spark.read.parquet(f"{store}/manifest").withColumn("root", F.lit(b"0" * 16)).collect()
    spark.createDataFrame(other, "part string, docs long, n_tokens long, root binary").write.mode("overwrite").parquet(f"{store}/manifest")
    with pytest.raises(ValueError):
        id_store.read_digests(spark, store)


def test_crc_of_runs():
    rng = random.Random(1)
    for _ in range(200):
        runs = [rng.randbytes(rng.randrange(900)) for _ in range(rng.randint(1, 6))]
        tails = np.array([sum(map(len, runs[i + 1 :])) for i in range(len(runs))], dtype=np.int64)
        own = id_store.crc_before(np.array(list(map(zlib.crc32, runs))), tails)
        assert int(np.bitwise_xor.reduce(own)) == zlib.crc32(b"".join(runs))


def test_url_rules(spark):
    rows = [(1, "https://A.Example.COM/en/700?x"), (2, "http://x.com/en/1"), (3, "http://notcom/en/1"), (4, "http://b.example.net/de/80#f"), (5, "http://b.example.net/de/7"), (6, "http://org/es/"), (7, None), (8, "x.com/en/1"), (9, "http://com?/en/"), (None, "http://y.com/en/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.lit(None).cast("string")).withColumn("Host", F.lit("x"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df).collect()}
    assert got == {
        1: ("a.example.com", "/en/700", "example.com/en/7", "allow"), 2: ("x.com", "/en/1", "com/en/", "block"), 3: ("notcom", "/en/1", None, "allow"),
        4: ("b.example.net", "/de/80", "example.net/de/8", "block"), 5: ("b.example.net", "/de/7", "net/de/", "allow"), 6: ("org", "/es/", "org/es/", "block"),
        7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("com", "", None, "allow"), None: ("y.com", "/en/", "com/en/", "block"),
    }
    assert url_filter.filter_urls(df.where("false")).count() == 0


def test_url_aliases_carry_blocks(spark):
    page = lambda t: f'<html><head><LINK href="{t}" rel="canonical"></head>'
    rows = [(1, "http://a.test/1", page("http://b.test/2")), (2, "https://b.test/2#x", page("http://bad.com/en/3")), (3, "http://c.test/9", ""), (4, "http://example.com/en/71", page("http://bad.com/en/3")), (5, "http://d.test/x/y", '<meta http-equiv="refresh" content="0; url=/z">'), (6, "http://d.test/z", None), (7, "http://e.test/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    moved = spark.createDataFrame([("http://e.test/", "http://a.test/1"), (None, "http://q.test/")], "src string, dst string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(df, redirects=moved).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "block"}


def test_toxicity(spark):
    rng, vocab = random.Random(4), vocabulary(800, 5)
    rows, labels = [], []
    for i in range(1500):
        bad = i % 6 == 0
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 80))]
        if bad:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["Vile,", "rotten", "scummy."]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    labels += [(None, 1), (3, None), (5000, 1), (4, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, table, toxicity.fold(F.col("doc_id"), 5) != 0)
    got = {r.doc_id: r for r in toxicity.score(docs.withColumn("predicted", F.lit("x")), model).collect()}
    out = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].predicted == (i % 6 == 0) for i in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert len(model.keys) < 500
    odd = toxicity.score(nasty(spark), model)
    assert odd.count() == len(NASTY) + 2 and odd.columns.count("score") == 1 and "Score" not in odd.columns
    nothing = toxicity.fit(docs, table.where("false"), F.lit(True))
    assert {r.predicted for r in toxicity.score(docs.limit(3), nothing).collect()} == {0}
    assert toxicity.score(empty(spark), model).count() == 0


def test_searches_pickle_small():
    ids, vecs = np.arange(3), np.eye(3)
    assert len(pickle.loads(graph_ann.pack_shard(ids, vecs, 2))[0]) == 3


@pytest.fixture(scope="module")
def duck():
    import os

    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df, want = queries.QUERIES[name](spark, SF), duck.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    fix = lambda v: round(v, 6) if isinstance(v, float) else v
    rows = lambda names, data: sorted(([fix(r[names.index(c)]) for c in sorted(names)] for r in data), key=repr)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want.fetchall())


def test_ftrl_against_a_plain_loop():
    """Each coordinate by itself, as the method is written down."""
    rng = np.random.default_rng(6)
    examples = [rng.integers(0, 40, size=rng.integers(0, 12)).astype(np.uint32) for _ in range(300)]
    labels = np.array([float(np.any(x < 4)) for x in examples])
    alpha, beta, l1, l2, passes = 0.5, 1.0, 0.3, 0.1, 2
    model = toxicity.ftrl(examples, labels, alpha, beta, l1, l2, passes)
    seen = collections.Counter(int(f) for x in examples for f in set(x.tolist()))
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(f):
        if abs(z[f]) <= l1:
            return 0.0
        return -(z[f] - math.copysign(l1, z[f])) / ((beta + math.sqrt(n[f])) / alpha + l2)

    for _ in range(passes):
        for x, y in zip(examples, labels, strict=True):
            active = [f for f in sorted(set(x.tolist())) if seen[f] > 1] + ["bias"]
            w = {f: weight(f) for f in active}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for f in active:
                s = (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / alpha
                z[f] += g - s * w[f]
                n[f] += g * g
    want = {f: weight(f) for f in z if f != "bias" and weight(f)}
    got = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))
    assert set(got) == set(want) and all(math.isclose(got[f], want[f], rel_tol=1e-9) for f in want)
    assert math.isclose(model.bias, weight("bias"), rel_tol=1e-9)
    text = "some words of a text"
    known = toxicity.features(text)
    own = toxicity.Model(np.sort(known)[:3], np.array([0.5, -1.0, 2.0]), 0.25)
    assert math.isclose(own.score(text), 1 / (1 + math.exp(-1.75)), rel_tol=1e-12)


def test_graph_recall_over_several_shards(spark):
    """The production settings on supplied vectors, in shards of a quarter of them."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").where("embedding IS NOT NULL").collect()
    rows = [(r.vec_id, r.embedding) for r in rows]
    own, size = spark.createDataFrame(rows, "vec_id long, embedding array<float>"), graph_ann.SHARD
    try:
        graph_ann.SHARD = 512
        got = collections.defaultdict(list)
        for r in graph_ann.graph_search(own, own.where("vec_id % 20 = 0"), 20).collect():
            got[r.query_id].append(r.vec_id)
    finally:
        graph_ann.SHARD = size
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    hits = 0
    for q, found in got.items():
        s = np.where(ids == q, -np.inf, x @ x[ids == q][0])
        hits += len(set(ids[np.lexsort((ids, -s))[:20]].tolist()) & set(found))
    assert hits >= 0.9 * 20 * len(got) and len(got) == len(ids[ids % 20 == 0])


def test_graph_shards_grow_with_the_table(spark, monkeypatch):
    """A query meets a bounded number of shards, not one for every few thousand rows."""
    seen = []
    monkeypatch.setattr(graph_ann, "answered", lambda data, asked, k, sizes, *more: seen.append(sizes[0]))
    for name, value in (("SHARD", 50), ("MOST", 200), ("SHARDS", 4)):
        monkeypatch.setattr(graph_ann, name, value)
    df = spark.createDataFrame(vectors(2000, 3), "vec_id long, embedding array<float>")
    for n in (100, 400, 2000):
        graph_ann.graph_search(df.where(f"vec_id < {n}"), df.where("vec_id < 9"), 5)
    assert seen == [50, 100, 200]


def test_graph_reaches_every_node():
    """Clusters far apart, more than have entries: each is reached, and a beam finds the nearest of the right one."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(300, 12)) * 50
    x = np.repeat(centres, 30, axis=0) + rng.normal(size=(9000, 12)) / 2
    x = np.concatenate([x, rng.normal(size=(7, 12)) * 300])
    points, *frame = graph_ann._centred(x)
    edges, entries = graph_ann.build_graph(points)
    reached, new = np.zeros(len(x), bool), entries
    while len(new):
        reached[new] = True
        new = np.unique(edges[new])
        new = new[(new >= 0) & ~reached[new]]
    assert reached.all() and len(entries) < len(x) / 4
    ids = np.arange(len(x))
    found = graph_ann.search_shard(graph_ann.pack_shard(ids, x, 5), pickle.dumps((ids[::500], x[::500])), 5, 160)
    s = x[::500] @ x.T
    s[np.arange(len(s)), ids[::500]] = -np.inf
    want = {(int(q), int(v)) for q, row in zip(ids[::500], s, strict=True) for v in np.argsort(-row)[:5]}
    assert len(want & set(zip(found[0].tolist(), found[1].tolist(), strict=True))) >= 0.95 * len(want)


def test_packs_hold_every_query_once(spark, monkeypatch):
    """Queries travel in packs of a shard, and answers below a query's k-th score are left out of the shards' answers."""
    monkeypatch.setattr(vectors_, "HELD", 40)
    monkeypatch.setattr(vectors_, "TURN", 1)
    rows = [(i, [float(i), 1.0], p, None if i % 2 else float(i)) for i in range(90) for p in range(i % 4)]
    routes = spark.createDataFrame(rows, "vec_id long, embedding array<double>, part int, kth double").repartition(3)
    got = []
    for r in vectors_.query_packs(routes, 16, 3).collect():
        ids, vecs, kth, known = pickle.loads(r.data)
        assert len(ids) < 2 * 16 and r.turn in range(3)
        got += [(i, v, r.part, s if k else None) for i, v, s, k in zip(ids.tolist(), vecs.tolist(), kth.tolist(), known.tolist(), strict=True)]
    assert sorted(got, key=str) == sorted(rows, key=str)
    monkeypatch.setattr(cover_topk, "SHARD", 100)
    monkeypatch.setattr(cover_topk, "BLOCK", 7)
    rows = vectors(500, 4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = collections.defaultdict(list)
    for r in cover_topk.exact_topk(df, df.where("vec_id % 10 = 0"), 5).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    assert dict(found) == brute_top(whole, [w for w in whole if w[0] % 10 == 0], 5, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))


def test_scratch_of_dedups_goes_early(spark):
    """What led to labels and cuts is gone once they are written, and sets of shingles are made for candidates alone."""
    from pathlib import Path

    root = Path(spark.conf.get("spark.checkpoint.dir"))
    rows = variants(60, 7) + variants(2, 8, 90, 0, 1)
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    for make in (simhash.near_duplicates, line_dedup.dedup_lines):
        before = set(root.glob("*/*"))
        got = make(docs)
        assert len(set(root.glob("*/*")) - before) == 1
        assert got.count() == len(rows)
    assert "shingles" not in simhash._wide(docs, 5, 8, 80, 80, "doc_id", "text", sets=False).columns
