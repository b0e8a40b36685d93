"""Affine transforms and reference systems of tiles. Columns only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tile_origin(a: Column, c: Column, e: Column, f: Column, x0: Column, y0: Column) -> tuple[Column, Column]:
    """Origin of a written tile: scale terms only, rotation is not carried."""
    return c + a * x0, f + e * y0


def window_origin(a: Column, b: Column, c: Column, d: Column, e: Column, f: Column, x0: Column, y0: Column) -> tuple[Column, Column]:
    """Origin of a sub-window under the full affine."""
    return c + a * x0 + b * y0, f + d * x0 + e * y0


def tiling_epsg(epsg: Column, is_local: Column, fallback: int) -> Column:
    """Tiling keeps a reference system that is present and not local."""
    return F.when(epsg.isNotNull() & ~F.coalesce(is_local, F.lit(False)), epsg).otherwise(F.lit(fallback))


def inference_epsg(epsg: Column, fallback: int) -> Column:
    """Inference keeps any that is present."""
    return F.coalesce(epsg, F.lit(fallback))
