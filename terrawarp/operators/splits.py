"""Train and validation splits: spatial, random, by file name, none."""

from __future__ import annotations

import random
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawarp.sources.shared import folder

DIRECTIONS = ("ns", "sn", "we", "ew")


def _ratio(ratio: float) -> float:
    if not 0 < ratio < 1:
        raise ValueError("the ratio must lie between 0 and 1")
    return float(ratio)


def spatial_split(rasters: DataFrame, ratio: float, direction: Column | str, width: str = "width", height: str = "height") -> DataFrame:
    """Two rows a raster: split and col_off, row_off, win_w, win_h. The first-named side trains; its length is rounded
    half to even."""
    way = F.lit(direction) if isinstance(direction, str) else direction
    if isinstance(direction, str) and direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    ns, w, h = way.isin("ns", "sn"), rasters[width].cast("int"), rasters[height].cast("int")
    length = F.when(ns, h).otherwise(w)
    cut = F.rint(length * F.lit(_ratio(ratio))).cast("int")
    low = way.isin("ns", "we")  # training lies at the low coordinates

    def part(split: str) -> Column:
        first = low if split == "train" else ~low
        size = cut if split == "train" else length - cut
        off = F.when(first, 0).otherwise(length - size)
        return F.struct(F.lit(split).alias("split"), F.when(ns, 0).otherwise(off).cast("int").alias("col_off"), F.when(ns, off).otherwise(0).cast("int").alias("row_off"), F.when(ns, w).otherwise(size).cast("int").alias("win_w"), F.when(ns, size).otherwise(h).cast("int").alias("win_h"))

    return rasters.withColumn("_s", F.explode(F.array(part("train"), part("val")))).select(*rasters.columns, "_s.*")


def random_split(keys: DataFrame, key: str, ratio: float, seed: int) -> DataFrame:
    """keys with split: the first int(n x ratio) keys by the MD5 of seed and key train. Keys are counted by the first 16
    bits of the hash (65,536 rows at most), which finds the bucket the boundary lies in; only that bucket is ordered, and
    its last training row is where all others are cut. No row is sorted or shuffled but those of that bucket."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    rows = keys.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 4))
    hist = rows.groupBy("_b").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hist = hist.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).withColumn("_take", F.floor(F.sum("_n").over(every) * F.lit(_ratio(ratio))))
    edge = hist.where("_before <= _take AND _before + _n > _take")
    inside = rows.join(F.broadcast(edge.select("_b", "_before", "_take")), "_b")
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))
    ranked = inside.select("_h", F.col(key).alias("_k"), "_b", (F.col("_before") + rank <= F.col("_take")).alias("_in"))
    # one row: the boundary's bucket and the last row of it that trains, if any; without an edge all rows train
    cut = ranked.agg(F.max("_b").alias("_edge"), F.max(F.when(F.col("_in"), F.struct("_h", "_k"))).alias("_last"))
    placed = rows.crossJoin(F.broadcast(cut))
    own = F.struct("_h", F.col(key).alias("_k"))
    train = F.col("_edge").isNull() | (F.col("_b") < F.col("_edge")) | ((F.col("_b") == F.col("_edge")) & F.coalesce(own <= F.col("_last"), F.lit(False)))
    return placed.select(*keys.columns, F.when(train, "train").otherwise("val").alias("split"))


def random_split_seeded(keys: DataFrame, key: str, ratio: float, seed: int) -> DataFrame:
    """The same by a seeded Mersenne shuffle of the distinct keys in order, as a script with Python's random does; rows of
    one key go together. Keys are numbered where they lie. The shuffle has an order of its own that can't be split, so the
    driver shuffles the numbers, 4 bytes a key (8 above 2^31), and hands back a bit a key."""
    spark, to, share = keys.sparkSession, folder(keys.sparkSession), _ratio(ratio)
    # written, so that all that follows sees the same ranges
    ranged = keys.select(F.col(key).alias("_key")).distinct().repartitionByRange("_key").withColumn("_p", F.spark_partition_id())
    ranged.write.parquet(to)
    part = spark.read.schema(ranged.schema).parquet(to)
    sizes = sorted((r["_p"], r["n"]) for r in part.groupBy("_p").agg(F.count("*").alias("n")).collect())
    n, offsets = 0, []
    for p, size in sizes:
        offsets.append((p, n))
        n += size
    order = array("i" if n < 1 << 31 else "q", range(n))
    random.Random(seed).shuffle(order)
    train = np.zeros(-(-n // 64) * 64, dtype=bool)
    train[np.frombuffer(order, dtype=order.typecode)[: int(n * share)]] = True
    words = pa.array(np.packbits(train, bitorder="little").view("<i8"))
    bits = spark.createDataFrame(pa.table({"_w": pa.array(np.arange(len(words))), "_bits": words}))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy("_key")) - 1
    numbers = part.join(F.broadcast(spark.createDataFrame(offsets, "_p int, _off long")), "_p").select("_key", (F.col("_off") + rank).alias("_i"))
    bit = F.expr("(shiftright(_bits, cast(_i & 63 as int)) & 1) = 1")
    plan = numbers.withColumn("_w", F.shiftright("_i", 6)).join(bits.hint("shuffle_hash"), "_w").select("_key", F.when(bit, "train").otherwise("val").alias("split"))
    # estimates take lists of keys for smaller than they are: none is broadcast
    return keys.join(plan.hint("merge"), keys[key].eqNullSafe(plan["_key"])).drop("_key")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with a dense number 0, 1, 2, ... in an order; the last name is the number's, the first the leading key, which is
    dropped. Range partitions are counted, so no task sees all rows."""
    *by, name = order
    part = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_p", F.spark_partition_id())
    sizes = part.groupBy("_p").agg(F.count("*").alias("_n"))
    sizes = sizes.withColumn("_off", F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).drop("_n")
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(*by)) - 1
    return part.withColumn("_r", rank).join(F.broadcast(sizes), "_p").withColumn(name, (F.col("_off") + F.col("_r")).cast("long")).drop("_p", "_r", "_off", by[0])


def filename_split(pairs: DataFrame) -> DataFrame:
    """Pairs whose split follows from their names; raises, with the first five ids, if any has none."""
    missing = [r[0] for r in pairs.where("split IS NULL").orderBy("tile_id").select("tile_id").limit(5).collect()]
    if missing:
        raise ValueError(f"no split token in names of: {', '.join(missing)}")
    return pairs


def stride_of(split: Column, clip: int, stride: int) -> Column:
    """Training tiles step by the stride, all others by the clip size."""
    return F.when(split == "train", stride).otherwise(clip).cast("int")
