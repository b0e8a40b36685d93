"""Blending as a stream: windows arrive by grid row, finished pixel rows leave as a watermark passes them.

A pixel row is an event time, BASE + y seconds. A grid row holds pixels from its read_y down to read_y + window - 1, so
rows above the newest read_y are final: the watermark trails the newest pixel row by window - 1. State is what the
window overlaps, whatever the raster's height; append mode emits each pixel once.

Files hold one grid row each and must arrive in order. A stream has no end that flushes what is left: two files of
markers, far below the last row, push the watermark past it, and markers are filtered out of the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawarp.functions.pixels import argmax

#: Seconds before pixel row 0; rows at the epoch itself would count as late.
BASE = 1_000_000
#: Modification time of the first file, in milliseconds; the others follow a second apart, as streams read by age.
ORDER = 1_000_000_000_000
SCHEMA = "scene_id long, read_y int, y int, x int, p0 double, p1 double, p2 double"
_MARK = -1


def write_grid_rows(pixels: DataFrame, folder: str, scene_ids: str = "scene_id") -> None:
    """The stream's input for a bounded raster: one file a grid row, in order, then the two files of markers.

    All scenes must share one grid of rows (they are cut to it by read_y), as a stream has one watermark."""
    spark = pixels.sparkSession
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    bottom = pixels.agg(F.max("y")).first()[0]
    # one job sorts the rows by grid row into files of their own, numbered as they have to arrive
    rows = pixels.select(*cols).withColumn("grid_row", F.lpad(F.col("read_y").cast("string"), 12, "0"))
    staged = f"{folder}/.staged"
    rows.repartition("grid_row").sortWithinPartitions("grid_row").write.partitionBy("grid_row").parquet(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(s.getPath().toString() for s in fs.listStatus(path(staged)) if s.isDirectory())  # a name a grid row
    for k, part in enumerate(parts):
        for f in fs.listStatus(path(part)):
            to = path(f"{folder}/row-{k:09d}.parquet")
            if f.getPath().getName().endswith(".parquet"):
                fs.rename(f.getPath(), to)
                fs.setTimes(to, ORDER + 1000 * k, -1)
    fs.delete(path(staged), True)
    for k in (1, 2):
        far = int(bottom) + 1_000_000 * k
        spark.createDataFrame([(_MARK, far, far, 0, 0.0, 0.0, 0.0)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def blend_stream(spark: SparkSession, folder: str, window: int) -> DataFrame:
    """The streaming DataFrame: scene_id, y, x, n, means and cls of finished pixels."""
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    timed = rows.withColumn("t", F.timestamp_seconds(F.lit(BASE) + F.col("y"))).withWatermark("t", f"{window - 1} seconds")
    done = timed.groupBy("t", "scene_id", "y", "x").agg(F.count("*").alias("n"), *[F.avg(f"p{i}").alias(f"p{i}") for i in range(3)], F.max("scene_id").alias("_m"))
    # a filter on a key would be pushed below the watermark, which the markers have to pass; one on an aggregate is not
    return done.where(F.col("_m") != _MARK).drop("t", "_m").withColumn("cls", argmax(F.array("p0", "p1", "p2")))


def run_blend(spark: SparkSession, folder: str, out: str, window: int) -> DataFrame:
    """Runs the stream over what the folder holds, to Parquet with a checkpoint beside it, and reads the result."""
    q = blend_stream(spark, folder, window).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{out}/rows")
