"""Listings, vector layers, raster blocks and the drivers."""

import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from terrawarp.operators import grid, overlay, stitch
from terrawarp.plans import jobs
from terrawarp.sources import listing, rasters, vector


def polygon(points, order="<"):
    return struct.pack(f"{order}BII", 1 if order == "<" else 0, 3, 1) + struct.pack(f"{order}I", len(points)) + b"".join(struct.pack(f"{order}2d", *p) for p in points)


def test_wkb():
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]
    assert vector.wkb_rings(polygon(square)) == [square] == vector.wkb_rings(polygon(square, ">"))
    multi = struct.pack("<BII", 1, 6, 2) + polygon(square) + polygon(square)
    assert vector.wkb_rings(multi) == [square, square]
    assert vector.wkb_rings(None) == [] == vector.wkb_rings(b"\x01") == vector.wkb_rings(struct.pack("<BI2d", 1, 1, 0, 0))


def test_geopackage_to_cells(spark, tmp_path):
    path = str(tmp_path / "layer.gpkg")
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('roofs', 'geom')")
    con.execute("CREATE TABLE roofs (geom BLOB)")
    shape = polygon([(100.5, 199.5), (102.5, 199.5), (102.5, 197.5), (100.5, 197.5), (100.5, 199.5)])
    con.executemany("INSERT INTO roofs VALUES (?)", [(b"GP\x00\x01" + struct.pack("<i", 3007) + shape,), (None,)])
    con.commit()
    con.close()
    layers = vector.read_gpkg(spark, [path])
    assert layers.count() == 2
    rings = vector.to_rings(layers, 1.0, 100.0, -1.0, 200.0)
    got = {(r.y, r.x) for r in overlay.polygon_cells(rings, 10, 10, ["layer"]).collect()}
    assert got == {(y, x) for y in range(3) for x in range(3)}


def test_listing(spark, tmp_path):
    for d in ("image", "annotation"):
        (tmp_path / "a" / d).mkdir(parents=True)
    for n in ("image/1_2_train_image.tif", "image/_mosaic.tif", "image/.hidden.tif", "annotation/1_2_train_annotation.tif", "image/note.txt"):
        (tmp_path / "a" / n).write_bytes(b"")
    got = listing.list_pairs(spark, [str(tmp_path / "a"), str(tmp_path / "none")]).collect()
    assert [(r.root_idx, r.role_dir, r.name) for r in got] == [(0, "image", "1_2_train_image.tif"), (0, "image", "_mosaic.tif"), (0, "annotation", "1_2_train_annotation.tif")]
    assert len(listing.inference_inputs(spark, str(tmp_path / "a" / "image"))) == 2
    assert listing.inference_inputs(spark, "/none/x.vrt") == ["/none/x.vrt"]
    with pytest.raises(FileNotFoundError):
        listing.require_files(spark, [str(tmp_path), "/none"])
    with pytest.raises(ValueError):
        listing.inference_inputs(spark, str(tmp_path / "a" / "image" / "note.txt"))


def test_blocks_round_trip_and_prune(spark, tmp_path):
    px = overlay.pixel_grid(spark.createDataFrame([(1,), (2,)], "scene_id long"), "scene_id", 21, 13).withColumn("r", (F.col("y") * 7 + F.col("x") + F.col("scene_id")) % 251).withColumn("g", F.col("x"))
    path = str(tmp_path / "blocks")
    rasters.write_blocks(rasters.to_blocks(px, ["r", "g"], 8), path)
    got = rasters.window(rasters.read_blocks(spark, path, [1]), 5, 6, 7, 12, 8)
    want = px.where("y BETWEEN 5 AND 11 AND x BETWEEN 6 AND 17").select("scene_id", F.lit(1).alias("band"), "y", "x", F.col("r").cast("int").alias("v"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(band" in plan and "GreaterThanOrEqual(by,0)" in plan
    two = rasters.mosaic([(px.where("scene_id = 1"), 0, 0), (px.where("scene_id = 2"), 13, 0)])
    assert two.agg(F.max("y")).first()[0] == 25


def manifest_of(spark, rows):
    return spark.createDataFrame([(p, w, h, 3010, False, 0.5, 0.0, 10.0, 0.0, -0.5, 20.0) for p, w, h in rows], "path string, width int, height int, epsg int, is_local boolean, a double, b double, c double, d double, e double, f double")


def test_tiling_job(spark, tmp_path):
    rows = [(0, r, f"/x/{r}/{t}_{r}.tif", f"{t}_{r}.tif") for t in ("1_1_train", "2_2_val") for r in ("image", "annotation")]
    files = spark.createDataFrame(rows, "root_idx int, role_dir string, path string, name string")
    m = manifest_of(spark, [("/x/image/1_1_train_image.tif", 100, 60), ("/x/image/2_2_val_image.tif", 100, 60)])
    tiles = jobs.TilingJob([], clip=40, stride=20).tiles(files, m)
    assert {(r.kind, r.split): r.n for r in jobs.summary(tiles).collect()} == {("image", "train"): 8, ("annotation", "train"): 8, ("image", "val"): 6, ("annotation", "val"): 6, ("image", None): 14, ("annotation", None): 14, (None, None): 28}
    halves = jobs.TilingJob([], clip=40, stride=40, ratio=0.5, direction="we").tiles(files, m).where("kind = 'image'").collect()
    area = {s: {(r.tile_id, y, x) for r in halves if r.split == s for y in range(r.row, r.row + r.h) for x in range(r.col, r.col + r.w)} for s in ("train", "val")}
    assert not area["train"] & area["val"] and len(area["train"] | area["val"]) == 2 * 100 * 60
    assert all(r.c == 10 + 0.5 * r.col and r.f == 20 - 0.5 * r.row and r.epsg == 3010 for r in halves)
    assert jobs.TilingJob([], clip=40, ratio=0.5).tiles(files, m).select("tile_id", "split").distinct().count() == 2
    for bad in ({"direction": "ns"}, {"ratio": 2.0}, {"clip": 0}, {"ratio": 0.5, "direction": "up"}):
        with pytest.raises(ValueError):
            jobs.TilingJob([], **bad).validate(spark)


def test_inference_job(spark):
    s = spark.createDataFrame([(1, 19, 11)], "scene_id long, width int, height int")
    cells = stitch.window_pixels(grid.inference_grid(s, 19, 19)).select("scene_id", "y", "x", F.array(*[(F.hash("y", "x", F.lit(i)) % 9).cast("int") for i in range(3)]).alias("bands")).where("NOT (y = 0 AND x = 0)")
    scorer = {"type": "linear", "weights": [[1, 0, 0], [0, 1, 0], [0, 0, 1]], "bias": [0.01, 0.0, -0.01]}
    a, b = (jobs.InferenceJob(scorer, window=8, stride=6, overlap=o).classify(s, cells) for o in ("blend", "crop"))
    assert a.exceptAll(b).isEmpty() and a.count() == 19 * 11 and a.where("cls = 255").count() == 1
    with pytest.raises(ValueError):
        jobs.InferenceJob(scorer, overlap="mix").validate()


def test_options():
    base = {"data": {"train": {"root": "a", "n": 1}}, "opt": {"type": "x", "lr": 1}}
    got = jobs.merge_options(base, {"data.train.root": "b", "opt": {"_delete_": True, "type": "y"}, "new.deep": 3})
    assert got == {"data": {"train": {"root": "b", "n": 1}}, "opt": {"type": "y"}, "new": {"deep": 3}}
    assert base["data"]["train"]["root"] == "a"
