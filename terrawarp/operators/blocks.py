"""Inference, tiling and evaluation over raster blocks: a row is an array of pixels, never one pixel.

A window meets the few blocks that it reads (a join by block), is put together, scored as a whole and dealt out again as
pieces of the output's blocks; a block then averages or overwrites its pieces. Two shuffles of arrays, whatever the size
of the raster; a group is one window or one block with the windows that overlap it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawarp.operators import grid, score
from terrawarp.schema import IGNORE, NODATA
from terrawarp.sources.rasters import BLOCKS, SIDE

PIECES = "scene_id long, by int, bx int, y0 int, x0 int, h int, w int, read_y int, read_x int, data binary"


def meets(areas: DataFrame, y: str, x: str, h: str, w: str, side: int = SIDE) -> DataFrame:
    """areas with by, bx of each block that the rectangle of these columns meets."""
    span = lambda at, size: F.sequence(F.floor(F.col(at) / side).cast("int"), F.floor((F.col(at) + F.col(size) - 1) / side).cast("int"))
    return areas.withColumn("by", F.explode(span(y, h))).withColumn("bx", F.explode(span(x, w)))


def assembled(frame: pd.DataFrame, y0: int, x0: int, h: int, w: int, side: int) -> np.ndarray:
    """The rectangle (bands, h, w) of block rows (band, by, bx, h, w, data); what no block holds is 0."""
    bands = {b: i for i, b in enumerate(sorted(frame["band"].unique()))}
    out = np.zeros((len(bands), h, w), dtype=np.uint8)
    for r in frame.itertuples(index=False):
        block, top, left = np.frombuffer(r.data, dtype=np.uint8).reshape(r.h, r.w), r.by * side, r.bx * side
        a, b = max(top, y0), min(top + r.h, y0 + h)
        c, d = max(left, x0), min(left + r.w, x0 + w)
        if a < b and c < d:
            out[bands[r.band], a - y0 : b - y0, c - x0 : d - x0] = block[a - top : b - top, c - left : d - left]
    return out


def cut_tiles(blocks: DataFrame, tiles: DataFrame, key: str, side: int = SIDE) -> DataFrame:
    """tiles (scene_id, x0, y0, x1, y1, key...) with bands, h, w and data: their pixels, band after band in rows. `key`
    names a tile."""
    sized = tiles.withColumns({"_h": F.col("y1") - F.col("y0"), "_w": F.col("x1") - F.col("x0")})
    place = meets(sized, "y0", "x0", "_h", "_w", side).select("scene_id", key, "x0", "y0", "_h", "_w", "by", "bx")
    kind = tiles.schema[key].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        r = frame.iloc[0]
        tile = assembled(frame, int(r["y0"]), int(r["x0"]), int(r["_h"]), int(r["_w"]), side)
        return pd.DataFrame({key: [r[key]], "bands": [len(tile)], "h": [tile.shape[1]], "w": [tile.shape[2]], "data": [tile.tobytes()]})

    met = blocks.join(place, ["scene_id", "by", "bx"])
    return tiles.join(met.groupBy(key).applyInPandas(run, f"{key} {kind}, bands int, h int, w int, data binary"), key)


def window_pieces(blocks: DataFrame, rasters: DataFrame, config: dict, window: int, stride: int, side: int = SIDE, dtype: str = "float32", kept: bool = False) -> DataFrame:
    """The scored windows in pieces of blocks: class probabilities (classes, h, w), of the kept rectangle only if
    wanted. The first three bands come in reverse order."""
    windows = grid.inference_grid(rasters, window, stride)
    cols = ["scene_id", "read_y", "read_x", "win_h", "win_w", "write_y", "write_x", "crop_h", "crop_w"]
    place = meets(windows, "read_y", "read_x", "win_h", "win_w", side).select(*cols, "by", "bx")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        r = {c: int(frame[c].iloc[0]) for c in cols}
        bands = assembled(frame, r["read_y"], r["read_x"], r["win_h"], r["win_w"], side)
        logits = score.window_scorer(config)((bands[:3][::-1] if len(bands) >= 3 else bands).astype(float))
        e = np.exp(logits - logits.max(axis=0))
        probs = (e / e.sum(axis=0)).astype(dtype)
        y, x, h, w = (r[c] for c in (("write_y", "write_x", "crop_h", "crop_w") if kept else ("read_y", "read_x", "win_h", "win_w")))
        out = []
        for by in range(y // side, (y + h - 1) // side + 1):
            for bx in range(x // side, (x + w - 1) // side + 1):
                a, b = max(by * side, y), min(by * side + side, y + h)
                c, d = max(bx * side, x), min(bx * side + side, x + w)
                part = probs[:, a - r["read_y"] : b - r["read_y"], c - r["read_x"] : d - r["read_x"]]
                out.append((r["scene_id"], by, bx, a, c, b - a, d - c, r["read_y"], r["read_x"], part.tobytes()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])

    return blocks.join(place, ["scene_id", "by", "bx"]).groupBy("scene_id", "read_y", "read_x").applyInPandas(run, PIECES)


def _extent(frame: pd.DataFrame, side: int) -> tuple[int, int, int, int]:
    """Height and width of a block, from the size of its raster, and its origin."""
    r = frame.iloc[0]
    top, left = int(r["by"]) * side, int(r["bx"]) * side
    return min(side, int(r["height"]) - top), min(side, int(r["width"]) - left), top, left


def blend_blocks(pieces: DataFrame, rasters: DataFrame, classes: int, side: int = SIDE, dtype: str = "float32") -> DataFrame:
    """Blocks of classes: each pixel's probabilities averaged over its windows, the first of the greatest; nodata where
    no window was. n and means come along as arrays of rows of pixels: (BLOCKS..., n binary, means binary)."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        h, w, top, left = _extent(frame, side)
        total, n = np.zeros((classes, h, w)), np.zeros((h, w), dtype="<i4")
        for r in frame.sort_values(["read_y", "read_x"]).itertuples(index=False):
            at = np.s_[r.y0 - top : r.y0 - top + r.h, r.x0 - left : r.x0 - left + r.w]
            total[(slice(None), *at)] += np.frombuffer(r.data, dtype=dtype).reshape(classes, r.h, r.w)
            n[at] += 1
        means = total / np.maximum(n, 1)
        cls = np.where(n > 0, means.argmax(axis=0), NODATA).astype(np.uint8)
        r = frame.iloc[0]
        row = (r["scene_id"], 1, r["by"], r["bx"], h, w, cls.tobytes(), n.tobytes(), means.astype("<f8").tobytes())
        return pd.DataFrame([row], columns=[*(c.split()[0] for c in BLOCKS.split(", ")), "n", "means"])

    sized = pieces.join(rasters.select("scene_id", "width", "height"), "scene_id")
    return sized.groupBy("scene_id", "by", "bx").applyInPandas(run, f"{BLOCKS}, n binary, means binary")


def crop_blocks(pieces: DataFrame, rasters: DataFrame, classes: int, side: int = SIDE, dtype: str = "float32") -> DataFrame:
    """Blocks of classes: windows write their kept rectangles in row-major order, the last one stays."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        h, w, top, left = _extent(frame, side)
        cls = np.full((h, w), NODATA, dtype=np.uint8)
        for r in frame.sort_values(["read_y", "read_x"]).itertuples(index=False):
            own = np.frombuffer(r.data, dtype=dtype).reshape(classes, r.h, r.w).argmax(axis=0)
            cls[r.y0 - top : r.y0 - top + r.h, r.x0 - left : r.x0 - left + r.w] = own
        r = frame.iloc[0]
        return pd.DataFrame([(r["scene_id"], 1, r["by"], r["bx"], h, w, cls.tobytes())], columns=[c.split()[0] for c in BLOCKS.split(", ")])

    sized = pieces.join(rasters.select("scene_id", "width", "height"), "scene_id")
    return sized.groupBy("scene_id", "by", "bx").applyInPandas(run, BLOCKS)


def infer_blocks(blocks: DataFrame, rasters: DataFrame, config: dict, classes: int, window: int, stride: int, overlap: str = "blend", side: int = SIDE, dtype: str = "float32") -> DataFrame:
    """Class blocks of rasters (scene_id, width, height) from their band blocks."""
    pieces = window_pieces(blocks, rasters, config, window, stride, side, dtype, kept=overlap == "crop")
    made = (crop_blocks if overlap == "crop" else blend_blocks)(pieces, rasters, classes, side, dtype)
    return made.select(*(c.split()[0] for c in BLOCKS.split(", ")))


def block_confusion(truth: DataFrame, predicted: DataFrame, reduce_zero: bool = True) -> DataFrame:
    """(gt, pred, n) of pixels that both rasters hold, counted within each pair of blocks; only class pairs shuffle.
    Labels 0 and 255 are ignored if zero is reduced, else 255."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = np.zeros(65536, dtype=np.int64)
            for r in frame.itertuples(index=False):
                g, p = np.frombuffer(r.g, dtype=np.uint8).reshape(r.gh, r.gw), np.frombuffer(r.p, dtype=np.uint8).reshape(r.ph, r.pw)
                h, w = min(r.gh, r.ph), min(r.gw, r.pw)
                counts += np.bincount(g[:h, :w].ravel().astype(np.int64) * 256 + p[:h, :w].ravel(), minlength=65536)
            at = np.flatnonzero(counts)
            gt = at // 256
            if reduce_zero:
                gt = np.where((gt == 0) | (gt == 255), IGNORE, gt - 1)
            yield pd.DataFrame({"gt": gt.astype("int32"), "pred": (at % 256).astype("int32"), "n": counts[at]})

    a = truth.select("scene_id", "by", "bx", F.col("h").alias("gh"), F.col("w").alias("gw"), F.col("data").alias("g"))
    b = predicted.select("scene_id", "by", "bx", F.col("h").alias("ph"), F.col("w").alias("pw"), F.col("data").alias("p"))
    pairs = a.join(b, ["scene_id", "by", "bx"]).mapInPandas(run, "gt int, pred int, n long")
    return pairs.where(F.col("gt") != IGNORE).groupBy("gt", "pred").agg(F.sum("n").alias("n"))
