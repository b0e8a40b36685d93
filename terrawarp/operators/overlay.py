"""Label rasters from vector layers: cleaning, covered cells, priority overlay."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def valid_box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A box is a geometry if it has all corners, none is NaN, and it spans an area."""
    here = x0.isNotNull() & y0.isNotNull() & x1.isNotNull() & y1.isNotNull()
    nan = F.isnan(x0.cast("double")) | F.isnan(y0.cast("double")) | F.isnan(x1.cast("double")) | F.isnan(y1.cast("double"))
    return F.coalesce(here & ~nan & (x1 > x0) & (y1 > y0), F.lit(False))


def box_cells(boxes: DataFrame, width: Column | int, height: Column | int) -> DataFrame:
    """Cells that boxes (x0, y0, x1, y1) touch within the raster: one row a cell, from the box itself. No join."""
    w, h = (F.lit(v) if isinstance(v, int) else v for v in (width, height))
    lo = lambda c: F.greatest(F.floor(c), F.lit(0)).cast("int")
    hi = lambda c, most: F.least(F.ceil(c), most).cast("int") - 1
    inside = (hi(F.col("x1"), w) >= lo(F.col("x0"))) & (hi(F.col("y1"), h) >= lo(F.col("y0")))
    rows = boxes.where(valid_box(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])).where(inside)
    rows = rows.withColumn("y", F.explode(F.sequence(lo(F.col("y0")), hi(F.col("y1"), h))))
    return rows.withColumn("x", F.explode(F.sequence(lo(F.col("x0")), hi(F.col("x1"), w))))


def _edges(rings: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, a, b) of the edges of all polygons of a column of rings. Polygons that are no geometry have none: null rings,
    rings below three points, and rings with a missing or non-finite coordinate."""
    owner, ring = np.asarray(pc.list_parent_indices(rings)), pc.list_flatten(rings)
    sizes = np.asarray(pc.fill_null(pc.list_value_length(ring), 0)).astype(np.int64)
    points = pc.list_flatten(ring)
    xy = np.stack([np.asarray(pc.fill_null(pc.struct_field(points, [name]).cast(pa.float64()), np.nan)) for name in "xy"], axis=1) if len(points) else np.zeros((0, 2))
    of = np.repeat(np.arange(len(sizes)), sizes)
    bad = np.zeros(len(rings), dtype=bool)
    bad[owner[sizes < 3]] = True
    bad[owner[of[~np.isfinite(xy).all(axis=1)]]] = True
    ends = np.cumsum(sizes)
    after = np.arange(1, len(xy) + 1)
    after[ends[sizes > 0] - 1] = (ends - sizes)[sizes > 0]  # the last point of a ring meets its first
    good = ~bad[owner[of]]
    return owner[of][good], xy[good], xy[after][good]


def _touched(cell: np.ndarray, x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, cells: int) -> np.ndarray:
    """Of unit cells, which meet their polygon: its inside (an odd number of rings) holds the cell's centre or a corner,
    or an edge crosses the cell. A row for each cell and edge of its polygon: the cell's number and corner, the edge."""
    (ax, ay), (bx, by) = a.T, b.T
    dx, dy = bx - ax, by - ay
    hit = np.zeros(cells, dtype=bool)
    with np.errstate(divide="ignore", invalid="ignore"):
        for px, py in ((x + 0.5, y + 0.5), (x, y), (x + 1, y), (x, y + 1), (x + 1, y + 1)):
            crossed = ((ay > py) != (by > py)) & (px < ax + (py - ay) / dy * dx)
            hit |= np.bincount(cell[crossed], minlength=cells) % 2 == 1
        lo, hi = np.zeros(len(x)), np.ones(len(x))
        for p, d, c in ((ax, dx, x), (ay, dy, y)):  # an edge, cut to the cell by its parameter
            t0, t1, still = (c - p) / d, (c + 1 - p) / d, d == 0
            lo = np.where(still, np.where((p < c) | (p > c + 1), 2.0, lo), np.maximum(lo, np.minimum(t0, t1)))
            hi = np.where(still, hi, np.minimum(hi, np.maximum(t0, t1)))
    hit[cell[lo <= hi]] = True
    return hit


def _runs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, at): for runs of those sizes, the run and the place in it of each element."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


#: Pairs of a cell and an edge that are looked at together; a row of cells of one polygon is not cut.
PAIRS = 30_000


def polygon_cells(polygons: DataFrame, width: int, height: int, keep: list[str]) -> DataFrame:
    """(keep..., y, x): cells that polygons touch. Column rings, array<array<struct<x,y>>>, or ring, one of them, in
    pixel coordinates; a cell within a hole is not touched.

    Null rings, rings below three points and rings with NaN are no geometries. Candidate cells are those of the bounding
    box; many polygons are looked at together, a bounded number of their rows of cells at a time."""
    schema = T.StructType([*(polygons.schema[c] for c in keep), T.StructField("y", T.IntegerType()), T.StructField("x", T.IntegerType())])
    rings = F.col("rings") if "rings" in polygons.columns else F.array("ring")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, a, b = _edges(batch.column(len(keep)))
            if not len(own):
                continue
            row, start, edges = np.unique(own, return_index=True, return_counts=True)
            low, high = np.minimum.reduceat(a, start), np.maximum.reduceat(a, start)
            (x0, y0), (x1, y1) = np.clip(np.floor(low), 0, (width, height)).T.astype(int), np.clip(np.ceil(high), 0, (width, height)).T.astype(int)
            across = np.maximum(x1 - x0, 0)
            line, at = _runs(np.where(across > 0, np.maximum(y1 - y0, 0), 0))  # rows of cells: of which polygon, at which y
            work = np.cumsum(across[line] * edges[line])
            cut = np.unique(np.concatenate([[0], np.searchsorted(work, np.arange(PAIRS, (work[-1] if len(work) else 0) + PAIRS, PAIRS)), [len(line)]]))
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                of, dx = _runs(across[line[i:j]])
                of += i
                gx, gy, polygon = x0[line[of]] + dx, y0[line[of]] + at[of], line[of]
                cell, k = _runs(edges[polygon])
                edge = start[polygon[cell]] + k
                hit = _touched(cell, gx[cell].astype(float), gy[cell].astype(float), a[edge], b[edge], len(gx))
                kept = pa.array(row[polygon[hit]])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(kept) for c in range(len(keep))), pa.array(gy[hit].astype(np.int32)), pa.array(gx[hit].astype(np.int32))], schema.names)

    return polygons.select(*keep, rings.alias("rings")).mapInArrow(run, schema)


def pixel_grid(rasters: DataFrame, key: str, width: Column | int, height: Column | int) -> DataFrame:
    """(key, y, x) of every pixel."""
    w, h = (F.lit(v) if isinstance(v, int) else v for v in (width, height))
    rows = rasters.where((w > 0) & (h > 0)).select(key, w.alias("_w"), h.alias("_h"))
    rows = rows.select(key, "_w", F.explode(F.sequence(F.lit(0), (F.col("_h") - 1).cast("int"))).alias("y"))
    return rows.select(key, "y", F.explode(F.sequence(F.lit(0), (F.col("_w") - 1).cast("int"))).alias("x"))


def overlay(grid: DataFrame, cells: DataFrame, key: str, background: int) -> DataFrame:
    """(key, y, x, cls): on each pixel the class of the highest draw_order, of equal ones that of the last list_pos;
    class 0 is never drawn. Cells are aggregated before they meet the grid."""
    drawn = cells.where("class_value <> 0").groupBy(key, "y", "x").agg(F.max_by("class_value", F.struct("draw_order", "list_pos")).alias("_c"))
    return grid.join(drawn, [key, "y", "x"], "left").select(key, "y", "x", F.coalesce("_c", F.lit(background)).cast("int").alias("cls"))
