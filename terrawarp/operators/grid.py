"""Tile and inference grids: one row a window, by closed form, from one row a raster. No shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tile_count(length: Column, clip: int, stride: Column | int) -> Column:
    step = F.lit(stride) if isinstance(stride, int) else stride
    return F.when(length > clip, F.ceil((length - clip) / step) + 1).otherwise(1).cast("int")


def tile_starts(length: Column, clip: int, stride: Column | int) -> Column:
    """Starts along an axis: steps of the stride, the last anchored at the end; each start once."""
    step = F.lit(stride) if isinstance(stride, int) else stride
    return F.transform(F.sequence(F.lit(0), tile_count(length, clip, stride) - 1), lambda i: F.least(i * step, F.greatest(length - clip, F.lit(0))).cast("int"))


def tile_grid(rasters: DataFrame, clip: int, stride: Column | int, width: str = "width", height: str = "height") -> DataFrame:
    """rasters with x0, y0, x1, y1 of each tile; a raster below the clip size gives one tile of its own size."""
    if clip < 1 or isinstance(stride, int) and stride < 1:
        raise ValueError("clip and stride must be positive")
    w, h = rasters[width].cast("int"), rasters[height].cast("int")
    rows = rasters.withColumn("y0", F.explode(tile_starts(h, clip, stride))).withColumn("x0", F.explode(tile_starts(w, clip, stride)))
    return rows.withColumn("x1", F.least(F.col("x0") + clip, F.col(width)).cast("int")).withColumn("y1", F.least(F.col("y0") + clip, F.col(height)).cast("int"))


def _axis(length: Column, window: int, stride: int) -> Column:
    """Windows along an axis: read, size, crop offset, size and place of what is kept."""
    n = F.when(length > window, F.ceil((length - window) / F.lit(stride)) + 1).otherwise(1).cast("int")
    half = (window - stride) // 2

    def one(i: Column) -> Column:
        last = i * stride + window >= length
        read = F.when(last, F.greatest(length - window, F.lit(0))).otherwise(i * stride).cast("int")
        crop = F.when(read == 0, 0).otherwise(half).cast("int")
        size = F.least(F.lit(window), length).cast("int")
        kept = F.when(last | (read == 0), size - crop).otherwise(F.lit(stride)).cast("int")
        return F.struct(read.alias("read"), size.alias("win"), crop.alias("crop"), kept.alias("keep"), (read + crop).alias("write"))

    return F.transform(F.sequence(F.lit(0), n - 1), one)


def inference_grid(rasters: DataFrame, window: int, stride: int, width: str = "width", height: str = "height") -> DataFrame:
    """rasters with read, crop and write rectangles of each window, in row-major order of (read_y, read_x).

    A raster smaller than the window gets one window of its own size. Strides above the window are refused: they
    leave pixels uncovered."""
    if not 0 < stride <= window:
        raise ValueError("the stride must be positive and not above the window")
    rows = rasters.withColumn("_y", F.explode(_axis(rasters[height].cast("int"), window, stride))).withColumn("_x", F.explode(_axis(rasters[width].cast("int"), window, stride)))
    names = {"read": "read", "win": "win", "crop": "crop", "keep": "crop", "write": "write"}
    cols = [F.col(f"_{a}.{k}").alias(f"{names[k]}_{a if k != 'win' and k != 'keep' else {'x': 'w', 'y': 'h'}[a]}") for k in names for a in ("x", "y")]
    return rows.select(*rasters.columns, *cols)


def coverage_runs(rasters: DataFrame, length: str, window: int, stride: int, key: str) -> DataFrame:
    """(key, cover, n): along one axis, how many pixels lie in how many windows. By run ends, not by pixels."""
    from pyspark.sql import Window

    x = rasters.select(key, F.explode(_axis(rasters[length].cast("int"), window, stride)).alias("w"))
    ends = x.select(key, F.explode(F.array(F.struct(F.col("w.read").alias("at"), F.lit(1).alias("d")), F.struct((F.col("w.read") + F.col("w.win")).alias("at"), F.lit(-1).alias("d")))).alias("e")).groupBy(key, F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy(key).orderBy("at")
    runs = ends.withColumn("cover", F.sum("d").over(w)).withColumn("n", F.lead("at").over(w) - F.col("at"))
    return runs.where("n IS NOT NULL AND n > 0").groupBy(key, "cover").agg(F.sum("n").alias("n"))
