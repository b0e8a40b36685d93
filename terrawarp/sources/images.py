"""PNG and GeoTIFF bytes: headers, pixels and georeference, without an image library.

Read: PNG of 8 bits without interlacing; TIFF of 8 bits, in strips or tiles, pixel-interleaved or by band, stored plainly
or deflated. Others raise ValueError. Written: the same kinds, deflated; PNG drops the georeference."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "path string, width int, height int, bands int, dtype string, epsg int, is_local boolean, a double, b double, c double, d double, e double, f double"
_PNG = b"\x89PNG\r\n\x1a\n"
#: Fixed values of the PNG format: samples of each colour type.
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
#: Fixed values of the TIFF format: bytes and codes of its field types.
_FIELDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 11: "f", 12: "d", 16: "Q"}


def _png_chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    if data[:8] != _PNG:
        raise ValueError("no PNG")
    at = 8
    while at + 8 <= len(data):
        n = struct.unpack_from(">I", data, at)[0]
        yield data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        at += 12 + n


def decode_png(data: bytes) -> np.ndarray:
    """(bands, height, width) of unsigned bytes."""
    packed, head = [], None
    for kind, body in _png_chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
    if head is None or head[2] != 8 or head[6] or head[3] not in _SAMPLES:
        raise ValueError("a PNG of another kind than 8 bits without interlacing")
    w, h, n = head[0], head[1], _SAMPLES[head[3]]
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), dtype=np.uint8).reshape(h, 1 + w * n)
    out = np.zeros((h + 1, w * n), dtype=np.uint8)
    for y in range(h):
        kind, line, up = raw[y, 0], raw[y, 1:], out[y]
        if kind == 0:
            out[y + 1] = line
        elif kind == 1:
            out[y + 1] = np.cumsum(line.reshape(w, n), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            out[y + 1] = line + up
        else:  # these two need the byte before, so a pixel at a time
            row = out[y + 1]
            for x in range(w * n):
                left, above, corner = (int(row[x - n]) if x >= n else 0), int(up[x]), (int(up[x - n]) if x >= n else 0)
                if kind == 3:
                    guess = (left + above) // 2
                else:
                    p = left + above - corner
                    guess = min((abs(p - left), 0, left), (abs(p - above), 1, above), (abs(p - corner), 2, corner))[2]
                row[x] = (int(line[x]) + guess) & 255
    return out[1:].reshape(h, w, n).transpose(2, 0, 1)


def encode_png(image: np.ndarray) -> bytes:
    """A PNG of (bands, height, width) unsigned bytes, of 1 to 4 bands."""
    n, h, w = image.shape
    colour = {1: 0, 2: 4, 3: 2, 4: 6}[n]
    lines = np.concatenate([np.zeros((h, 1), dtype=np.uint8), image.transpose(1, 2, 0).reshape(h, w * n)], axis=1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return _PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def _tags(data: bytes) -> dict[int, tuple]:
    """The fields of a TIFF's first directory."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if order is None:
        raise ValueError("no TIFF")
    at = struct.unpack_from(order + "I", data, 4)[0]
    out = {0: (order,)}
    for i in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        code = _FIELDS.get(kind)
        if code is None:
            continue
        form = order + (f"{n}s" if code == "s" else code * n if len(code) > 1 else f"{n}{code}")
        where = at + 10 + 12 * i
        if struct.calcsize(form) > 4:
            where = struct.unpack_from(order + "I", data, where)[0]
        out[tag] = struct.unpack_from(form, data, where)
    return out


def header(data: bytes) -> dict:
    """The manifest's fields of a PNG or TIFF: size, bands, type, and of a TIFF its georeference if it has one."""
    none = dict.fromkeys(("epsg", "is_local", *"abcdef"))
    if data[:8] == _PNG:
        w, h, depth, colour = struct.unpack_from(">IIBB", data, 16)
        return none | {"width": w, "height": h, "bands": _SAMPLES[colour], "dtype": f"uint{depth}"}
    t = _tags(data)
    kind = {1: "uint", 2: "int", 3: "float"}[t.get(339, (1,))[0]]
    out = none | {"width": t[256][0], "height": t[257][0], "bands": t.get(277, (1,))[0], "dtype": f"{kind}{t.get(258, (1,))[0]}"}
    if 33550 in t and 33922 in t:
        (sx, sy), (i, j, _, x, y) = t[33550][:2], t[33922][:5]
        out |= {"a": sx, "b": 0.0, "c": x - i * sx, "d": 0.0, "e": -sy, "f": y + j * sy}
    elif 34264 in t:
        m = t[34264]
        out |= {"a": m[0], "b": m[1], "c": m[3], "d": m[4], "e": m[5], "f": m[7]}
    keys = t.get(34735, ())
    found = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4)}
    code = found.get(3072) or found.get(2048)  # projected, else geographic
    if found:
        out |= {"epsg": code if code and code != 32767 else None, "is_local": found.get(1024) not in (1, 2)}
    return out


def decode_tiff(data: bytes) -> np.ndarray:
    """(bands, height, width) of unsigned bytes."""
    t = _tags(data)
    w, h, n = t[256][0], t[257][0], t.get(277, (1,))[0]
    if any(d != 8 for d in t.get(258, (1,))) or t.get(339, (1,))[0] != 1 or t.get(259, (1,))[0] not in (1, 8, 32946) or t.get(317, (1,))[0] != 1:
        raise ValueError("a TIFF of another kind than 8 bits, stored plainly or deflated")
    planes, tiled = t.get(284, (1,))[0] == 2, 322 in t
    bw, bh = (t[322][0], t[323][0]) if tiled else (w, min(t.get(278, (h,))[0], h))
    offsets, counts, deep = t[324 if tiled else 273], t[325 if tiled else 279], 1 if planes else n
    across, down = -(-w // bw), -(-h // bh)
    out = np.zeros((n, h, w), dtype=np.uint8)
    for k, (at, size) in enumerate(zip(offsets, counts, strict=True)):
        body = data[at : at + size]
        raw = np.frombuffer(body if t.get(259, (1,))[0] == 1 else zlib.decompress(body), dtype=np.uint8)
        plane, place = divmod(k, across * down)
        y, x = place // across * bh, place % across * bw
        rows = bh if tiled else min(bh, h - y)
        block = raw[: rows * bw * deep].reshape(rows, bw, deep).transpose(2, 0, 1)[:, : h - y, : w - x]
        out[slice(plane, plane + 1) if planes else slice(None), y : y + block.shape[1], x : x + block.shape[2]] = block
    return out


def encode_tiff(image: np.ndarray, georef: dict | None = None, nodata: int | None = None) -> bytes:
    """A GeoTIFF of (bands, height, width) unsigned bytes, deflated in one strip a band's rows; georef: a, c, e, f, epsg of a
    raster without rotation."""
    n, h, w = image.shape
    body = zlib.compress(image.transpose(1, 2, 0).tobytes(), 6)
    fields: list[tuple[int, int, tuple]] = [(256, 4, (w,)), (257, 4, (h,)), (258, 3, (8,) * n), (259, 3, (8,)), (262, 3, (1,)), (273, 4, (0,)), (277, 3, (n,)), (278, 4, (h,)), (279, 4, (len(body),)), (284, 3, (1,)), (339, 3, (1,) * n)]
    if georef:
        fields += [(33550, 12, (float(georef["a"]), -float(georef["e"]), 0.0)), (33922, 12, (0.0, 0.0, 0.0, float(georef["c"]), float(georef["f"]), 0.0))]
        if georef.get("epsg"):
            fields.append((34735, 3, (1, 1, 0, 2, 1024, 0, 1, 1, 3072, 0, 1, int(georef["epsg"]))))
    if nodata is not None:
        fields.append((42113, 2, (str(nodata).encode() + b"\0",)))
    at, extra, entries = 8 + 2 + 12 * len(fields) + 4, [], []
    for tag, kind, values in fields:
        packed = values[0] if kind == 2 else struct.pack("<" + {3: "H", 4: "I", 12: "d"}[kind] * len(values), *values)
        count = len(packed) if kind == 2 else len(values)
        if len(packed) > 4:
            entries.append([tag, kind, count, struct.pack("<I", at)])
            extra.append(packed + b"\0" * (len(packed) % 2))
            at += len(extra[-1])
        else:
            entries.append([tag, kind, count, packed.ljust(4, b"\0")])
    for e in entries:
        if e[0] == 273:
            e[3] = struct.pack("<I", at)
    directory = struct.pack("<H", len(entries)) + b"".join(struct.pack("<HHI", *e[:3]) + e[3] for e in entries) + struct.pack("<I", 0)
    return b"II*\0" + struct.pack("<I", 8) + directory + b"".join(extra) + body


def decode(data: bytes) -> np.ndarray:
    return decode_png(data) if data[:8] == _PNG else decode_tiff(data)


def read_manifest(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row a file: the manifest's fields, from its header."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        for frame in frames:
            rows = [{"path": p} | header(bytes(c)) for p, c in zip(frame["path"], frame["content"], strict=True)]
            yield pd.DataFrame([[r[n] for n in names] for r in rows], columns=names, dtype=object)

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, MANIFEST)


def read_images(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, bands, h, w, data): whole images as unsigned bytes, band after band in rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                image = decode(bytes(content))
                yield pd.DataFrame([(path, *image.shape, image.tobytes())], columns=["path", "bands", "h", "w", "data"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, "path string, bands int, h int, w int, data binary")


def encoded(tiles: DataFrame, fmt: str = "tif", nodata: int | None = None) -> DataFrame:
    """tiles (bands, h, w, data, and for tif the origin c, f, sizes a, e and epsg) with `content`, the bytes of a file."""
    if fmt not in ("tif", "png"):
        raise ValueError("fmt must be tif or png")
    names = tiles.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                image = np.frombuffer(r["data"], dtype=np.uint8).reshape(r["bands"], r["h"], r["w"])
                there = fmt == "tif" and all(r.get(k) is not None for k in "acef")
                epsg = r.get("epsg")
                georef = {k: r[k] for k in "acef"} | {"epsg": None if epsg is None or epsg != epsg else int(epsg)} if there else None
                out.append(encode_png(image) if fmt == "png" else encode_tiff(image, georef, nodata))
            yield frame.assign(content=out)

    rows = tiles.mapInPandas(run, f"{tiles.schema.simpleString()[len('struct<'):-1]}, content:binary")
    return rows if fmt == "tif" else rows.select(*[F.lit(None).cast(tiles.schema[c].dataType).alias(c) if c in ("a", "b", "c", "d", "e", "f", "epsg") else F.col(c) for c in names], "content")
