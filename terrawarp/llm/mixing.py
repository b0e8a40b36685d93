"""Mixing sources to target weights, by hash-threshold histograms. DataFrame operations only.

Every document gets a 60-bit hash; a source takes its documents below a threshold of that hash. The threshold
comes from nested histograms: sizes are summed by source and the hash's first 12 bits (at most 4096 rows a
source, pre-aggregated before the shuffle), the bucket in which the running sum meets the budget is found, and
only that bucket's documents enter the histogram of the next 12 bits. No documents are sorted.

Defined results
* Null or empty text: size 0, takes nothing. Null source: a source of its own, last in the order.
* Rows equal in doc_id, source and text hash alike: they go in or out together. A null doc_id is a value.
* A source without words: target 0. An empty table: no rows.
* Very long texts: a document is never cut; the mix stops at the document boundary nearest to the target.
* Extra columns are kept by `mix`, whatever their names; its own columns are added after them, and an input
  column that has the name of an added one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, free_name, table, word_count

#: Hex digits of a histogram level (12 bits) and the number of levels (60 bits in all).
DIGITS, LEVELS = 3, 5
#: Sources up to this number are broadcast (one short row each); more are joined by shuffle.
BROADCAST_SOURCES = 10_000
#: Columns that `mix` adds.
ADDED = ("size", "source_size", "target", "taken", "copies")


def doc_hash(df: DataFrame, doc_id: str, source: str, text: str, seed: str = "") -> Column:
    """15 hex digits of an MD5 over id, source and the text's MD5; the seed gives other mixes."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), df[c].cast("string")), F.lit("-"))
    return F.substring(F.md5(F.concat_ws("|", F.lit(seed), part(doc_id), part(source), F.md5(F.coalesce(df[text], F.lit(""))))), 1, DIGITS * LEVELS)


def source_targets(totals: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Targets of sources, from rows (source, source_size): share x all sizes, split by weight (cycling in code point
    order, null last), none above cap x its size; what is cut off is dealt anew by weight until none is above.

    That end state is a water level: sources enter by cap over weight, and the level is right at the first one
    that stays below its cap. One row a source; ranks need all sources in one order.
    """
    t = totals.withColumn("_k", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1)
    t = t.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_k") % len(weights) + 1).cast("int")))
    t = t.withColumn("_cap", F.lit(float(cap)) * F.col("source_size"))
    up = Window.orderBy(F.col("_cap") / F.col("_w"), "_k").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("_left", F.least(F.sum("source_size").over(every) * F.lit(float(share)), F.sum("_cap").over(every)) - F.coalesce(F.sum("_cap").over(up), F.lit(0.0)))
    t = t.withColumn("_rest", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(up), F.lit(0.0)))
    level = F.col("_left") / F.col("_rest")
    t = t.withColumn("_at", F.when(level <= F.col("_cap") / F.col("_w"), F.struct(F.col("_cap") / F.col("_w"), F.col("_k"), level.alias("level"))))
    t = t.withColumn("_level", F.min("_at").over(every)["level"])
    return t.select("source", "source_size", F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap"))).alias("target"))


def thresholds(slim: DataFrame, budgets: DataFrame, scratch: Scratch) -> DataFrame:
    """For each source of `budgets` (source, budget): `cut`, the hash prefix at which it ends, and `with_cut`, whether
    documents that begin with `cut` still go in. Documents with a smaller hash go in, all others stay out.

    Each level reads only documents of the sources' boundary buckets; a bucket of one hash ends the search.
    """
    small = budgets.count() <= BROADCAST_SOURCES
    hint = F.broadcast if small else (lambda x: x)
    open_, done, path = budgets.select("source", F.col("budget").alias("need"), F.lit("").alias("cut")), None, None
    for level in range(LEVELS):
        digits = DIGITS * (level + 1)
        near = slim.join(hint(open_.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s"))).where(F.substring("h", 1, digits - DIGITS) == F.col("cut"))
        hist = near.groupBy("source", F.substring("h", 1, digits).alias("bucket")).agg(F.sum("size").alias("size"), F.min("need").alias("need"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("before", F.coalesce(F.sum("size").over(w), F.lit(0)))
        edge = hist.where("before <= need AND before + size > need")
        last = level == LEVELS - 1
        edge = edge.select("source", F.col("bucket").alias("cut"), (F.col("need") - F.col("before")).alias("need"), "size", (F.lit(last) | (F.col("lo") == F.col("hi"))).alias("single"))
        found, new = scratch.write(edge)
        ended = found.where("single").select("source", "cut", (F.col("need") * 2 >= F.col("size")).alias("with_cut"))
        done = ended if done is None else done.unionByName(ended)
        open_ = found.where("NOT single").select("source", "need", "cut")
        path = new
        if not found.where("NOT single").take(1):
            break
    return done


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: str = "") -> DataFrame:
    """docs with size, source_size, target, taken and copies added: each source's documents are taken whole, once or more,
    so that its words come within half a document of its target. The same rows and seed give the same mix.

    Whole passes: a source whose target is p times its size and a rest takes every document p times; the documents
    under the threshold of the rest are taken once more. No document is taken above ceil(cap) times.
    """
    scratch = Scratch(docs.sparkSession)
    own = docs.select(docs[source].alias("source"), word_count(docs[text]).alias("size"), doc_hash(docs, doc_id, source, text, seed).alias("h"), docs[doc_id].alias("doc_id"))
    slim = scratch.keep(own)
    totals = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = source_targets(totals, weights, share, cap).withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goal = scratch.keep(goal)
    cuts = thresholds(slim, goal.select("source", (F.col("target") - F.col("passes") * F.col("source_size")).alias("budget")).where("budget > 0"), scratch)
    plan = goal.join(cuts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    plan = scratch.keep(plan)
    small = plan.count() <= BROADCAST_SOURCES
    base = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])
    h, s = free_name(docs, "_h"), free_name(docs, "_src")
    base = base.withColumn(h, doc_hash(base, doc_id, source, text, seed)).withColumn("size", word_count(base[text]))
    plan = plan.withColumnRenamed("source", s)
    out = base.join(F.broadcast(plan) if small else plan, base[source].eqNullSafe(plan[s]), "left")
    under = F.coalesce((F.col(h) < F.col("cut")) & ~F.startswith(F.col(h), F.col("cut")) | (F.startswith(F.col(h), F.col("cut")) & F.col("with_cut")), F.lit(False))
    copies = (F.col("passes") + under.cast("long")).cast("long")
    return out.select(*[base[c] for c in base.columns if c not in (h, "size")], "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: str = "") -> DataFrame:
    """The mix itself: each document as often as `mix` takes it (at most ceil(cap) times), with its own columns."""
    m = mix(docs, weights, share, cap, doc_id, source, text, seed)
    own = free_name(m, "_copy")
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    return m.where("copies > 0").withColumn(own, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*kept)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 and a share of 150 %, over all documents."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         substr(md5('' || '|' || coalesce('=' || doc_id::VARCHAR, '-') || '|' || coalesce('=' || source, '-') || '|' || md5(coalesce(text, ''))), 1, 15) AS h
  FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS source_size FROM d GROUP BY source),
k AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM s),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w, 2.0 * source_size AS cap FROM k),
l AS (SELECT *, sum(source_size) OVER () * 1.5 - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
             sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM w),
o AS (SELECT *, row_number() OVER (ORDER BY cap / w, k) AS pos FROM l),
v AS (SELECT *, (SELECT lft / rest FROM o WHERE lft / rest <= cap / w ORDER BY pos LIMIT 1) AS lev FROM o),
t AS (SELECT source, source_size, least(cap, coalesce(lev * w, cap))::DOUBLE AS target FROM v),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM t),
u AS (SELECT source, h, sum(size) AS size FROM d GROUP BY source, h),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef FROM u),
b AS (SELECT c.source, c.h, (c.bef + c.size <= p.target - p.passes * p.source_size
                             OR (c.bef <= p.target - p.passes * p.source_size AND 2 * (p.target - p.passes * p.source_size - c.bef) >= c.size))
              AND p.target - p.passes * p.source_size > 0 AS inn
      FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source)
SELECT d.doc_id, d.size, p.source_size::BIGINT AS source_size, p.target, (d.size * (p.passes + CASE WHEN b.inn THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source JOIN b ON d.source IS NOT DISTINCT FROM b.source AND d.h = b.h
"""
