"""Line dedup by a suffix array over line-ID sequences. DataFrame operations only.

Documents are sequences of lines. A line goes if it lies in a run of consecutive lines, of MIN_WORDS words or more,
that also begins at an earlier place: in a document before it (by doc_id, null last), or further up in its own.

* Line ids: the rank of a line's 128-bit hash among all lines that occur twice or more. Lines that occur once end
  every repeated run; they are left behind here, and with them most of the corpus.
* Prefix doubling: from the ranks of all places by their next 2**k lines follow those by the next 2**(k+1), as the
  order of pairs (rank here, rank 2**k lines on). Distinct pairs are counted first and sorted by range partitioning,
  so a frequent pair is one row; pairs that occur once are dropped. Places of one rank are the longest-common-prefix
  interval of at least 2**k lines. Levels end with the longest run that has to be told apart: the shortest run of
  MIN_WORDS from a place has at most that many lines with words.
* Every repeated run of MIN_WORDS words is covered by the shortest such runs that begin or end at its lines. A run of
  n lines is named by its length and the ranks of its first and of its last 2**k lines, k = floor(log2 n); runs of one
  name are copies, the first stays, and the union of all later ones, the maximal repeated runs, is cut out.

Joins on line ids and names are plain equi-joins, whose hot keys adaptive execution splits; counts and first places
are pre-aggregated. Only runs of lines cross the network, and the texts once, to meet their cuts.

Defined results
* Null text stays null, empty text stays empty. A document that loses all its lines has an empty text.
* Rows equal in doc_id and text are one document: all of them keep or lose the same lines.
* Very long texts are long sequences; a line repeated on end within a document leaves its first run behind.
* An empty table gives no rows. Extra columns are kept by `dedup_lines`; its own columns replace those of their name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, free_name, table, word_count

#: Words that a repeated run has at least.
MIN_WORDS = 50


def _ranked(keys: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """Distinct keys with r, a number that rises in their order: rows are sorted by range partitioning, and the number
    joins a row's partition and its place there. Written at once, so that it never changes."""
    return scratch.keep(keys.orderBy(*order).withColumn("r", F.monotonically_increasing_id()))


def line_places(docs: DataFrame, doc_id: str, text: str, scratch: Scratch) -> DataFrame:
    """(d, doc_id, pos, words, r): the places of lines that occur twice or more; r: the line's id."""
    lines = docs.where(docs[text].isNotNull()).select(F.xxhash64(docs[doc_id], docs[text]).alias("d"), docs[doc_id].alias("doc_id"), F.posexplode(F.split(docs[text], "\n", -1)).alias("pos", "line"))
    lines = scratch.keep(lines.select("d", "doc_id", "pos", word_count(F.col("line")).alias("words"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")))
    ids = _ranked(lines.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2"), ["h1", "h2"], scratch)
    return scratch.keep(lines.join(ids, ["h1", "h2"]).select("d", "doc_id", "pos", "words", "r").distinct())


def shortest_runs(places: DataFrame, min_words: int) -> DataFrame:
    """(d, doc_id, a, b): the shortest runs of min_words that begin, or end, at each place, within unbroken places."""
    by_doc = Window.partitionBy("d").orderBy("pos")
    seg = places.withColumn("seg", F.col("pos") - F.row_number().over(by_doc))
    by_seg = Window.partitionBy("d", "seg")
    up = by_seg.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    seg = seg.withColumn("done", F.sum("words").over(up)).withColumn("before", F.col("done") - F.col("words"))
    seg = seg.withColumn("all", F.sum("words").over(by_seg)).where(F.col("all") >= min_words)
    seg = seg.withColumn("first", F.min("pos").over(by_seg)).withColumn("last", F.max("pos").over(by_seg))
    to = F.min("pos").over(by_seg.orderBy("before").rangeBetween(min_words, Window.unboundedFollowing)) - 1
    since = F.max("pos").over(by_seg.orderBy("done").rangeBetween(Window.unboundedPreceding, -min_words)) + 1
    seg = seg.withColumn("b", F.coalesce(to, F.when(F.col("all") - F.col("before") >= min_words, F.col("last"))))
    seg = seg.withColumn("a", F.coalesce(since, F.when(F.col("done") >= min_words, F.col("first"))))
    runs = seg.select("d", "doc_id", F.explode(F.array(F.struct(F.col("pos").alias("a"), F.col("b").alias("b")), F.struct(F.col("a").alias("a"), F.col("pos").alias("b")))).alias("x"))
    return runs.select("d", "doc_id", "x.a", "x.b").where("a IS NOT NULL AND b IS NOT NULL").distinct()


def double(level: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """From the ranks (d, pos, r) by 2**k lines those by 2**(k+1) lines, of places that share theirs with another."""
    on = level.select("d", (F.col("pos") - (1 << k)).alias("pos"), F.col("r").alias("r2"))
    pairs = scratch.keep(level.join(on, ["d", "pos"]).select("d", "pos", F.col("r").alias("r1"), "r2"))
    new = _ranked(pairs.groupBy("r1", "r2").agg(F.count("*").alias("c")).where("c > 1").select("r1", "r2"), ["r1", "r2"], scratch)
    return scratch.keep(pairs.join(new, ["r1", "r2"]).select("d", "pos", "r"))


def cut_runs(docs: DataFrame, doc_id: str, text: str, min_words: int, scratch: Scratch) -> DataFrame:
    """(d, cuts): for each document that loses lines the sorted, disjoint runs (a, b) that go."""
    places = line_places(docs, doc_id, text, scratch)
    runs = scratch.keep(shortest_runs(places, min_words).withColumn("k", F.floor(F.log2(F.col("b") - F.col("a") + 1)).cast("int")))
    most = runs.agg(F.max("k")).first()[0]
    level, levels = places.select("d", "pos", "r"), []
    for k in range((most if most is not None else -1) + 1):
        if k:
            level = double(level, k - 1, scratch)
        levels.append(level.withColumn("k", F.lit(k)))
    if not levels:
        return runs.select("d", F.array(F.struct("a", "b")).alias("cuts")).where("false")
    ranks = levels[0]
    for x in levels[1:]:
        ranks = ranks.unionByName(x)
    head = ranks.select("d", F.col("pos").alias("a"), "k", F.col("r").alias("r1"))
    tail = ranks.select("d", F.col("pos").alias("p"), "k", F.col("r").alias("r2"))
    named = runs.join(head, ["d", "a", "k"]).withColumn("p", F.col("b") + 1 - F.expr("shiftleft(1, k)")).join(tail, ["d", "p", "k"])
    named = scratch.keep(named.select((F.col("b") - F.col("a") + 1).alias("n"), "r1", "r2", F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"), F.col("d").alias("d"), F.col("a").alias("a")).alias("at"), "b"))
    # written first: so adaptive execution can split the runs of a hot name, which are shuffled for the join alone
    first = scratch.keep(named.groupBy("n", "r1", "r2").agg(F.min("at").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"))
    later = named.join(first, ["n", "r1", "r2"]).where("at > first").select("at.d", "at.a", "b").distinct()
    w = Window.partitionBy("d").orderBy("a", "b")
    later = later.withColumn("reach", F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    later = later.withColumn("island", F.sum(F.when(F.col("a") <= F.col("reach") + 1, 0).otherwise(1)).over(w))
    merged = later.groupBy("d", "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return scratch.keep(merged.groupBy("d").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("cuts")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with later copies of repeated line runs cut out of the text, and n_lines and n_removed added."""
    scratch = Scratch(docs.sparkSession)
    # only the cuts are read later; what led to them goes at once
    cuts = Scratch(docs.sparkSession).keep(cut_runs(docs, doc_id, text, min_words, scratch))
    scratch.close()
    base = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_removed") and c not in (doc_id, text)])
    d, c, x = free_name(base, "_d"), free_name(base, "_cuts"), free_name(base, "_x")
    # the same plan at every size: texts meet their cuts by a shuffle
    cuts = cuts.select(F.col("d").alias(d), F.col("cuts").alias(c)).hint("shuffle_hash")
    out = base.withColumn(d, F.xxhash64(base[doc_id], base[text])).join(cuts, d, "left")
    out = out.withColumn(x, F.split(F.col(text), "\n", -1))
    starts = F.concat(F.array(F.lit(0)), F.transform(c, lambda r: r["b"] + 1))
    ends = F.concat(F.transform(c, lambda r: r["a"]), F.array(F.size(x)))
    left = F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(F.col(x), s + 1, e - s)))
    gone = F.coalesce(F.aggregate(c, F.lit(0), lambda s, r: s + r["b"] - r["a"] + 1), F.lit(0)).cast("long")
    new = F.when(F.col(c).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    lines = F.coalesce(F.when(F.col(text).isNotNull(), F.size(x)), F.lit(0)).cast("long")
    return out.select(*[new.alias(text) if f == text else F.col(f) for f in base.columns], lines.alias("n_lines"), gone.alias("n_removed"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with runs of 50 words or more that stand earlier cut out."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP3_SQL = """
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
w AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words FROM l),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, text ORDER BY pos)::BIGINT AS done, sum(words) OVER (PARTITION BY doc_id, text)::BIGINT AS alls,
             max(pos) OVER (PARTITION BY doc_id, text) AS last FROM w),
e AS (
  SELECT *, min(pos) OVER (PARTITION BY doc_id, text ORDER BY done - words RANGE BETWEEN 50 FOLLOWING AND UNBOUNDED FOLLOWING) - 1 AS b0,
         max(pos) OVER (PARTITION BY doc_id, text ORDER BY done RANGE BETWEEN UNBOUNDED PRECEDING AND 50 PRECEDING) + 1 AS a0 FROM c),
r AS (
  SELECT doc_id, text, pos AS a, coalesce(b0, CASE WHEN alls - done + words >= 50 THEN last END) AS b FROM e
  UNION
  SELECT doc_id, text, coalesce(a0, CASE WHEN done >= 50 THEN 0 END), pos FROM e),
k AS (SELECT doc_id, text, a, b, array_to_string(string_split(text, chr(10))[a + 1 : b + 1], chr(10)) AS run FROM r WHERE a IS NOT NULL AND b IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY run, b - a ORDER BY doc_id NULLS LAST, a) AS n FROM k),
gone AS (SELECT DISTINCT doc_id, text, unnest(generate_series(a, b)) AS pos FROM f WHERE n > 1),
kept AS (
  SELECT l.doc_id, l.text, string_agg(l.line, chr(10) ORDER BY l.pos) AS left_ FROM l
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.text = l.text AND g.pos = l.pos) GROUP BY l.doc_id, l.text),
n AS (SELECT doc_id, text, count(*) AS n FROM gone GROUP BY doc_id, text)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.left_, '') END AS text,
       CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines, coalesce(n.n, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id AND kept.text = d.text LEFT JOIN n ON n.doc_id = d.doc_id AND n.text = d.text
"""
