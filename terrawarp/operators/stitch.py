"""From windows back to rasters: blending, crop ownership, nodata, and pixel geometry of training tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawarp.functions.pixels import argmax
from terrawarp.schema import IGNORE, NODATA


def window_pixels(windows: DataFrame) -> DataFrame:
    """windows with y, x of each pixel they read. One row a pixel and window: for small rasters and for checks; large
    ones stay in blocks (see `blocks`)."""
    end = lambda at, size: (F.col(at) + F.col(size) - 1).cast("int")
    rows = windows.withColumn("y", F.explode(F.sequence(F.col("read_y"), end("read_y", "win_h"))))
    return rows.withColumn("x", F.explode(F.sequence(F.col("read_x"), end("read_x", "win_w"))))


def blend(pixels: DataFrame, key: str, probs: list[str]) -> DataFrame:
    """(key, y, x, n, mean of each probability column, cls): overlapping windows averaged. One shuffle, pre-aggregated;
    counts are 64-bit and do not wrap."""
    means = pixels.groupBy(key, "y", "x").agg(F.count("*").alias("n"), *[F.avg(p).alias(p) for p in probs])
    return means.withColumn("cls", argmax(F.array(*probs)))


def crop(pixels: DataFrame, key: str, value: str) -> DataFrame:
    """(key, y, x, value) where the windows' kept rectangles own a pixel; the last window in row-major order wins."""
    kept = (F.col("x") >= F.col("write_x")) & (F.col("x") < F.col("write_x") + F.col("crop_w")) & (F.col("y") >= F.col("write_y")) & (F.col("y") < F.col("write_y") + F.col("crop_h"))
    return pixels.where(kept).groupBy(key, "y", "x").agg(F.max_by(value, F.struct("read_y", "read_x")).alias(value))


def _on_grid(grid: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The grid with what was found on its pixels. Rasters explode into pixels, which estimates of size leave out, so
    neither side may be taken for a small table and broadcast."""
    return grid.join(found.hint("merge"), [key, "y", "x"], "left")


def fill_nodata(grid: DataFrame, found: DataFrame, key: str, value: str, nodata: int = NODATA) -> DataFrame:
    """Every pixel of the grid, with nodata where no window wrote."""
    return _on_grid(grid, found, key).select(key, "y", "x", F.coalesce(value, F.lit(nodata)).cast("int").alias(value))


def flip(pixels: DataFrame, width: Column, height: Column, horizontal: Column, vertical: Column | None = None) -> DataFrame:
    """Pixels mirrored where the flags hold."""
    out = pixels.withColumn("x", F.when(horizontal, width - 1 - F.col("x")).otherwise(F.col("x")).cast("int"))
    return out if vertical is None else out.withColumn("y", F.when(vertical, height - 1 - F.col("y")).otherwise(F.col("y")).cast("int"))


def pad(grid: DataFrame, pixels: DataFrame, key: str, image: str, label: str) -> DataFrame:
    """Tiles filled up to the grid: image 0, label ignored."""
    return _on_grid(grid, pixels, key).select(key, "y", "x", F.coalesce(image, F.lit(0)).alias(image), F.coalesce(label, F.lit(IGNORE)).alias(label))


def dominant_share(pixels: DataFrame, keys: list[str], cls: str, most: float) -> DataFrame:
    """(keys..., max_share, keep): the largest class's share of the labelled pixels, and whether it is below `most`.
    A block without labelled pixels has a null share and is not kept."""
    counts = pixels.where(F.col(cls) != IGNORE).groupBy(*keys, cls).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg((F.max("n") / F.sum("n")).alias("max_share")).withColumn("keep", F.col("max_share") < most)


def bilinear(pixels: DataFrame, key: str, value: str, size: tuple[int, int], to: tuple[int, int]) -> DataFrame:
    """(key, y, x, value): resampled from (h, w) to (h, w), half-pixel centres, edges clamped. Every source pixel sends
    its share to the outputs that read it, so there is no self-join: one aggregation.

    The outputs of a source coordinate are few and contiguous; which they are follows from it in closed form."""

    def axis(at: Column, n: int, m: int) -> Column:
        """(j, w) of the outputs that read source coordinate `at`, and how much of it each takes."""
        i = at.cast("double")
        lo = F.when(at == 0, 0).otherwise(F.greatest(F.floor((i - 0.5) * m / n - 0.5), F.lit(0)))
        hi = F.when(at == n - 1, m - 1).otherwise(F.least(F.ceil((i + 1.5) * m / n - 0.5), F.lit(m - 1)))

        def weight(j: Column) -> Column:
            src = F.least(F.greatest((j + 0.5) * (n / m) - 0.5, F.lit(0.0)), F.lit(float(n - 1)))
            return F.greatest(F.lit(1.0) - F.abs(src - i), F.lit(0.0))

        outputs = F.transform(F.sequence(lo.cast("int"), hi.cast("int")), lambda j: F.struct(j.alias("j"), weight(j).alias("w")))
        return F.filter(outputs, lambda o: o["w"] > 0)

    rows = pixels.withColumn("_a", F.explode(axis(F.col("y"), size[0], to[0]))).withColumn("_b", F.explode(axis(F.col("x"), size[1], to[1])))
    return rows.groupBy(key, F.col("_a.j").alias("y"), F.col("_b.j").alias("x")).agg(F.sum(F.col(value) * F.col("_a.w") * F.col("_b.w")).alias(value))
