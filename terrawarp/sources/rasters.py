"""Rasters as block rows: one row a block and band, clustered so that a window reads few Parquet row groups.

A block is (scene_id, band, by, bx, h, w, data): its rows' bytes in order, unsigned 8-bit values. Windowed reads become
range predicates on by and bx, which reach the scan; only the blocks a window meets are unpacked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 512
BLOCKS = "scene_id long, band int, by int, bx int, h int, w int, data binary"


def to_blocks(pixels: DataFrame, bands: list[str], side: int = SIDE) -> DataFrame:
    """Blocks of pixel rows (scene_id, y, x, bands...); pixels that are missing are 0. A block is one group: side x side
    pixels at most."""
    named = pixels.select(F.col("scene_id").cast("long").alias("scene_id"), F.floor(F.col("y") / side).cast("int").alias("by"), F.floor(F.col("x") / side).cast("int").alias("bx"), F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), *bands)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        y, x = frame["y"].to_numpy() % side, frame["x"].to_numpy() % side
        h, w, out = int(y.max()) + 1, int(x.max()) + 1, []
        for i, band in enumerate(bands, 1):
            block = np.zeros((h, w), dtype=np.uint8)
            block[y, x] = (frame[band].fillna(0).to_numpy().astype(np.int64) % 256).astype(np.uint8)
            out.append((int(frame["scene_id"].iloc[0]), i, int(frame["by"].iloc[0]), int(frame["bx"].iloc[0]), h, w, block.tobytes()))
        return pd.DataFrame(out, columns=["scene_id", "band", "by", "bx", "h", "w", "data"])

    return named.groupBy("scene_id", "by", "bx").applyInPandas(run, BLOCKS)


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Sorted within files by scene and block, partitioned by band: bands and blocks that are not asked for are not
    read."""
    blocks.repartition("scene_id", "band").sortWithinPartitions("scene_id", "by", "bx").write.partitionBy("band").parquet(path)


def read_blocks(spark: SparkSession, path: str, bands: list[int] | None = None) -> DataFrame:
    rows = spark.read.schema(BLOCKS).parquet(path)
    return rows if bands is None else rows.where(F.col("band").isin(bands))


def window(blocks: DataFrame, row_off: int, col_off: int, height: int, width: int, side: int = SIDE) -> DataFrame:
    """(scene_id, band, y, x, v) of a pixel rectangle of every scene."""
    meets = F.col("by").between(row_off // side, (row_off + height - 1) // side) & F.col("bx").between(col_off // side, (col_off + width - 1) // side)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                block = np.frombuffer(r.data, dtype=np.uint8).reshape(r.h, r.w)
                y0, x0 = r.by * side, r.bx * side
                top, left = max(row_off - y0, 0), max(col_off - x0, 0)
                part = block[top : max(row_off + height - y0, 0), left : max(col_off + width - x0, 0)]
                if part.size:
                    y, x = np.mgrid[y0 + top : y0 + top + part.shape[0], x0 + left : x0 + left + part.shape[1]]
                    yield pd.DataFrame({"scene_id": r.scene_id, "band": r.band, "y": y.ravel().astype("int32"), "x": x.ravel().astype("int32"), "v": part.ravel().astype("int32")})

    return blocks.where(meets).mapInPandas(run, "scene_id long, band int, y int, x int, v int")


def unpack(blocks: DataFrame, side: int = SIDE) -> DataFrame:
    """(scene_id, band, y, x, v) of all pixels of blocks: for small rasters and for checks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                y, x = np.mgrid[r.by * side : r.by * side + r.h, r.bx * side : r.bx * side + r.w]
                v = np.frombuffer(r.data, dtype=np.uint8)
                yield pd.DataFrame({"scene_id": r.scene_id, "band": r.band, "y": y.ravel().astype("int32"), "x": x.ravel().astype("int32"), "v": v.astype("int32")})

    return blocks.mapInPandas(run, "scene_id long, band int, y int, x int, v int")


def unpack_means(blocks: DataFrame, classes: int, side: int = SIDE) -> DataFrame:
    """(scene_id, y, x, n, p0, p1, ...) of blended blocks with their counts and means: for checks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                y, x = np.mgrid[r.by * side : r.by * side + r.h, r.bx * side : r.bx * side + r.w]
                means = np.frombuffer(r.means, dtype="<f8").reshape(classes, -1)
                yield pd.DataFrame({"scene_id": r.scene_id, "y": y.ravel().astype("int32"), "x": x.ravel().astype("int32"), "n": np.frombuffer(r.n, dtype="<i4"), **{f"p{i}": m for i, m in enumerate(means)}})

    return blocks.mapInPandas(run, "scene_id long, y int, x int, n int, " + ", ".join(f"p{i} double" for i in range(classes)))


def tile_sums(tiles: DataFrame) -> DataFrame:
    """tiles (bands, h, w, data) with s0, the sum of the first band, and s2, that of the last by 64 x row + column."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                t = np.frombuffer(r.data, dtype=np.uint8).reshape(r.bands, r.h, r.w).astype(np.int64)
                y, x = np.mgrid[: r.h, : r.w]
                out.append((r.tile, r.w, r.h, int(t[0].sum()), int((t[-1] * (64 * y + x)).sum())))
            yield pd.DataFrame(out, columns=["tile", "w", "h", "s0", "s2"])

    return tiles.select("tile", "bands", "h", "w", "data").mapInPandas(run, "tile string, w int, h int, s0 long, s2 long")


def mosaic(scenes: list[tuple[DataFrame, int, int]]) -> DataFrame:
    """Pixel relations (scene_id, y, x, ...) put together with row and column offsets, as a virtual mosaic does."""
    moved = [df.withColumn("y", F.col("y") + dy).withColumn("x", F.col("x") + dx) for df, dy, dx in scenes]
    out = moved[0]
    for df in moved[1:]:
        out = out.unionByName(df)
    return out
