"""Vector layers: GeoPackage files, shapefiles and WKB polygons, as rings in pixel coordinates, and their validity.

A polygon is all its rings: a point lies inside if it lies inside an odd number of them, so holes stay empty."""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"


def wkb_rings(data: bytes | None) -> list[list[tuple[float, float]]]:
    """All rings of a WKB polygon or multipolygon; nothing for other or broken geometries."""
    out: list[list[tuple[float, float]]] = []

    def read(at: int) -> int:
        order = "<" if data[at] == 1 else ">"
        kind = struct.unpack_from(f"{order}I", data, at + 1)[0]
        dims = 2 + (1 if kind & 0x80000000 or 1000 <= kind % 4000 < 2000 or kind % 4000 >= 3000 else 0) + (1 if kind & 0x40000000 or kind % 4000 >= 2000 else 0)
        at += 5
        if kind & 0x20000000:
            at += 4
        kind = (kind & 0xFFFF) % 1000
        n = struct.unpack_from(f"{order}I", data, at)[0]
        at += 4
        for _ in range(n):
            if kind == 6:
                at = read(at)
            elif kind == 3:
                m = struct.unpack_from(f"{order}I", data, at)[0]
                values = struct.unpack_from(f"{order}{m * dims}d", data, at + 4)
                at += 4 + 8 * m * dims
                out.append([(values[k * dims], values[k * dims + 1]) for k in range(m)])
            else:
                raise ValueError("no polygon")
        return at

    try:
        if data:
            read(0)
    except (struct.error, ValueError, IndexError):
        return []
    return out


def rings_wkb(rings: list[list[tuple[float, float]]]) -> bytes:
    """Rings as a little-endian WKB polygon."""
    parts = [struct.pack("<BII", 1, 3, len(rings))]
    for ring in rings:
        parts.append(struct.pack("<I", len(ring)) + struct.pack(f"<{2 * len(ring)}d", *(v for p in ring for v in p)))
    return b"".join(parts)


def shp_rings(content: bytes) -> Iterator[list[list[tuple[float, float]]] | None]:
    """The rings of each polygon of a shapefile (.shp), with or without further dimensions; None for null shapes."""
    if len(content) < 100 or struct.unpack_from(">i", content, 0)[0] != 9994:
        raise ValueError("no shapefile")
    at = 100
    while at + 8 <= len(content):
        size = 2 * struct.unpack_from(">i", content, at + 4)[0]
        kind = struct.unpack_from("<i", content, at + 8)[0]
        if kind == 0:
            yield None
        elif kind not in (5, 15, 25):
            raise ValueError(f"shapes of kind {kind} are no polygons")
        else:
            parts, points = struct.unpack_from("<2i", content, at + 44)
            first = [*struct.unpack_from(f"<{parts}i", content, at + 52), points]
            xy = struct.unpack_from(f"<{2 * points}d", content, at + 52 + 4 * parts)
            yield [[(xy[2 * k], xy[2 * k + 1]) for k in range(i, j)] for i, j in zip(first, first[1:], strict=False)]
        at += 8 + size


def fault(rings: list[list[tuple[float, float]]]) -> str | None:
    """Why rings are no valid polygon, or None: too few points, not closed, not finite, without area, or with edges that
    cross each other, of one ring or of two."""
    if not rings:
        return "empty"
    edges = []
    for ring in rings:
        p = np.array(ring, dtype=float)
        if len(p) < 4:
            return "too few points"
        if not np.isfinite(p).all():
            return "not finite"
        if (p[0] != p[-1]).any():
            return "not closed"
        p = p[np.append(True, (p[1:] != p[:-1]).any(axis=1))]
        edges.append(np.concatenate([p[:-1], p[1:]], axis=1))
    e = np.concatenate(edges)
    turn = lambda a, b, c: np.sign((b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0]))
    for at in range(0, len(e), 256):  # a bounded slice of edges against all
        a, b = e[at : at + 256, None, :2], e[at : at + 256, None, 2:]
        c, d = e[None, :, :2], e[None, :, 2:]
        if ((turn(a, b, c) * turn(a, b, d) < 0) & (turn(c, d, a) * turn(c, d, b) < 0)).any():
            return "edges cross"
    flat = any(len(x) < 3 or (x[:, 0] * x[:, 3] - x[:, 2] * x[:, 1]).sum() == 0 for x in edges)
    return "no area" if flat else None


def gpkg_wkb(blob: bytes | None) -> bytes | None:
    """The WKB of a GeoPackage geometry: its header is 8 bytes and an envelope of 0 to 64."""
    if blob is None or blob[:2] != b"GP":
        return None
    return bytes(blob[8 + (0, 32, 48, 48, 64)[min(blob[3] >> 1 & 7, 4)] :])


def read_gpkg(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(layer, geom_wkb) of every feature table; null geometries are kept. A file is opened from its bytes, one task
    each."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                con = sqlite3.connect(":memory:")
                con.deserialize(bytes(content))
                for table, column in con.execute("SELECT table_name, column_name FROM gpkg_geometry_columns").fetchall():
                    rows = con.execute(f'SELECT "{column}" FROM "{table}"')
                    while some := rows.fetchmany(5000):
                        yield pd.DataFrame({"layer": f"{path}#{table}", "geom_wkb": [gpkg_wkb(r[0]) for r in some]})
                con.close()

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, "layer string, geom_wkb binary")


def read_shp(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(layer, geom_wkb) of shapefiles of polygons; null shapes are kept. Attributes are not read."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                shapes = [None if r is None else rings_wkb(r) for r in shp_rings(bytes(content))]
                for i in range(0, len(shapes), 5000):
                    yield pd.DataFrame({"layer": path, "geom_wkb": shapes[i : i + 5000]})

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, "layer string, geom_wkb binary")


def read_layers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Layers by their files' suffixes: .gpkg and .shp."""
    out = None
    for suffix, read in ((".gpkg", read_gpkg), (".shp", read_shp)):
        some = [p for p in paths if p.lower().endswith(suffix)]
        if some:
            out = read(spark, some) if out is None else out.unionByName(read(spark, some))
    if out is None or any(not p.lower().endswith((".gpkg", ".shp")) for p in paths):
        raise ValueError(f"layers must be .gpkg or .shp files: {paths}")
    return out


def with_faults(layers: DataFrame, wkb: str = "geom_wkb") -> DataFrame:
    """layers with `fault`: "null", why the geometry is not valid, or null where it is. Nothing is repaired."""
    names = layers.columns
    at = names.index(wkb)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            why = ["null" if v is None else fault(wkb_rings(v)) for v in frame.iloc[:, at]]
            yield frame.assign(fault=pd.Series(why, dtype=object, index=frame.index))

    return layers.mapInPandas(run, f"{layers.schema.simpleString()[len('struct<'):-1]}, fault:string")


def clean(layers: DataFrame, wkb: str = "geom_wkb") -> tuple[DataFrame, DataFrame]:
    """Layers with valid geometries only, and (fault, n) of those dropped."""
    judged = with_faults(layers, wkb)
    return judged.where("fault IS NULL").drop("fault"), judged.where("fault IS NOT NULL").groupBy("fault").agg(F.count("*").alias("n"))


def to_rings(layers: DataFrame, a: float, c: float, e: float, f: float, wkb: str = "geom_wkb") -> DataFrame:
    """layers with `rings`, those of each geometry, in pixels of a raster without rotation; layers without one go."""
    schema = layers.schema.simpleString()[len("struct<") : -1]
    names = layers.columns
    at = names.index(wkb)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = ((r, wkb_rings(r[at])) for r in frame.itertuples(index=False))
            rows = [(*r, [[{"x": (x - c) / a, "y": (y - f) / e} for x, y in ring] for ring in rings]) for r, rings in found if rings]
            yield pd.DataFrame(rows, columns=[*names, "rings"])

    return layers.mapInPandas(run, f"{schema}, rings:array<{RING}>").drop(wkb)


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])
