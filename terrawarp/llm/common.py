"""Shared pieces: table access, shared scratch tables, global prefix sums and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrawarp.sources.shared import folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A named table of the input folder, read by Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables in the shared folder. They cut lineage and survive the loss of any executor."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = folder(spark)
        self.made = 0

    def path(self) -> str:
        self.made += 1
        return f"{self.root}/{self.made}"

    def write(self, df: DataFrame) -> tuple[DataFrame, str]:
        to = self.path()
        df.write.option("compression", "zstd").parquet(to)
        return self.spark.read.schema(df.schema).parquet(to), to

    def keep(self, df: DataFrame) -> DataFrame:
        return self.write(df)[0]

    def close(self) -> None:
        """Removes all tables that it wrote: for callers that have written or collected what they read from them."""
        self.drop(self.root)

    def drop(self, path: str | None) -> None:
        """Removes a table that no later plan reads."""
        if path:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that does not clash with those of df (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def word_count(text: Column) -> Column:
    """The number of maximal runs without ASCII white space; null counts 0. JVM-side, one pass."""
    shrunk = F.regexp_replace(text, "[^\\x20\\x09-\\x0D]+", "w")
    return F.coalesce(F.length(shrunk) - F.length(F.translate(shrunk, "w", "")), F.lit(0)).cast("long")


def prefix_sum(df: DataFrame, order: list[Column], value: Column, name: str, scratch: Scratch) -> DataFrame:
    """Adds `name`: the sum of `value` over all rows before this one in the order, which must be total.

    A range partitioning sorts the rows; sums of partitions (one row each, their number is that of the
    shuffle partitions) give the offsets, a running sum inside each partition the rest. No task sees all rows.
    """
    part, at = free_name(df, "_part"), free_name(df, "_at")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn(part, F.spark_partition_id())
    kept = scratch.keep(ranged.withColumn(at, value))
    sums = kept.groupBy(part).agg(F.sum(at).alias("s"))
    offsets = sums.select(F.col(part), (F.sum("s").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)) - F.col("s")).alias("_off"))
    w = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = kept.withColumn(name, F.coalesce(F.sum(at).over(w), F.lit(0)))
    return inside.join(F.broadcast(offsets), part).withColumn(name, (F.col(name) + F.col("_off")).cast("long")).drop(part, at, "_off")


def components(edges: DataFrame, scratch: Scratch, most: int = 60) -> DataFrame:
    """Connected components of edges (a, b; both long or both string): rows (node, label), label the smallest node reachable.

    Alternating large-star and small-star rounds; each is two shuffles of the edge table, which never grows,
    and is written to the shared folder. Converges in O(log^2 n) rounds; raises if `most` rounds do not do.
    Nodes without an edge to another node are not returned. Null ends are ignored.
    """
    path = None
    now, path = scratch.write(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    sign = _sign(now)
    for _ in range(most):
        if sign[0] == 0:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # keys of aggregates are made anew, so that a join shuffles both its sides and adaptive execution can split the
        # rows of a hub
        text = dict(now.dtypes)["u"] == "string"
        again = lambda name: (F.concat(name, F.lit("")) if text else F.col(name).bitwiseXOR(F.lit(0))).alias(name)
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(again("u"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.select(again("u"), "v").join(low2.select(again("u"), "m"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        new, new_path = scratch.write(star.unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        scratch.drop(path)
        was, now, path, sign = sign, new, new_path, _sign(new)
        if sign == was:
            break
    else:
        raise RuntimeError("connected components did not converge")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _sign(edges: DataFrame) -> tuple:
    """Count and order-free hashes of the edges, which are distinct: equal from one round to the next once they are
    stars. Exclusive ors, as a sum of hashes overflows."""
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64(F.lit(1), "v", "u"))).first()
    return tuple(r)
