"""Blocks, geometry, image files, jobs and reports on small inputs of their own."""

import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrawarp.operators import augment, blocks, overlay, pairing, splits, stitch
from terrawarp.plans import jobs, reports
from terrawarp.schema import class_dim
from terrawarp.sources import images, rasters, vector

SQUARE = [(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0), (0.0, 0.0)]
HOLE = [(2.0, 2.0), (6.0, 2.0), (6.0, 6.0), (2.0, 6.0), (2.0, 2.0)]


def shapefile(shapes):
    body = b""
    for i, rings in enumerate(shapes, 1):
        if rings is None:
            record = struct.pack("<i", 0)
        else:
            first = np.cumsum([0, *map(len, rings)])
            record = struct.pack("<i4d2i", 5, 0, 0, 9, 9, len(rings), int(first[-1])) + struct.pack(f"<{len(rings)}i", *first[:-1].tolist())
            record += b"".join(struct.pack("<2d", *p) for r in rings for p in r)
        body += struct.pack(">2i", i, len(record) // 2) + record
    return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8) + body


def test_faults():
    assert vector.fault([SQUARE]) is None and vector.fault([SQUARE, HOLE]) is None
    assert vector.fault([]) == "empty" and vector.fault([SQUARE[:3]]) == "too few points"
    assert vector.fault([SQUARE[:-1] + [(1.0, 1.0)]]) == "not closed"
    assert vector.fault([[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]]) == "edges cross"
    assert vector.fault([SQUARE, [(x + 4, y + 3) for x, y in HOLE]]) == "edges cross"
    assert vector.fault([[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (0.0, 0.0)]]) == "no area"
    assert vector.fault([[(0.0, 0.0), (float("nan"), 1.0), (2.0, 2.0), (0.0, 0.0)]]) == "not finite"


def test_shapefile_holes_and_cleaning(spark, tmp_path):
    path = tmp_path / "layer.shp"
    path.write_bytes(shapefile([[SQUARE, HOLE], None, [[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]]]))
    layers = vector.read_layers(spark, [str(path)])
    valid, dropped = vector.clean(layers)
    assert sorted((r.fault, r.n) for r in dropped.collect()) == [("edges cross", 1), ("null", 1)]
    rings = vector.to_rings(valid, 1.0, 0.0, 1.0, 0.0)
    got = {(r.y, r.x) for r in overlay.polygon_cells(rings, 20, 20, ["layer"]).collect()}
    inner = {(y, x) for y in range(3, 5) for x in range(3, 5)}
    assert not got & inner and {(0, 0), (1, 1), (7, 7), (6, 6)} <= got and max(max(c) for c in got) <= 8
    with pytest.raises(ValueError):
        vector.read_layers(spark, ["x.txt"])
    with pytest.raises(ValueError):
        list(vector.shp_rings(b"no shapefile"))


def test_label_job(spark, tmp_path):
    path = tmp_path / "a.shp"
    path.write_bytes(shapefile([[SQUARE, HOLE]]))
    (tmp_path / "none.shp").write_bytes(shapefile([None]))
    raster = {"width": 12, "height": 10, "a": 1.0, "c": 0.0, "e": 1.0, "f": 0.0}
    job = jobs.LabelJob([{"file_path": str(path), "class_value": 3, "draw_order": 1}, {"file_path": str(tmp_path / "none.shp"), "class_value": 2, "draw_order": 2}])
    dropped = job.run(spark, raster, str(tmp_path / "out"), side=4)
    assert [(r.fault, r.n) for r in dropped.collect()] == [("null", 1)]
    cells = {(r.y, r.x): r.v for r in rasters.unpack(rasters.read_blocks(spark, str(tmp_path / "out")), 4).collect()}
    assert len(cells) == 120 and cells[0, 0] == 3 and cells[4, 4] == 1 and cells[9, 11] == 1
    with pytest.raises(FileNotFoundError):
        jobs.LabelJob([{"file_path": str(tmp_path / "gone.shp"), "class_value": 1, "draw_order": 1}]).validate(spark)


@pytest.mark.parametrize("bands", [1, 2, 3, 4])
def test_image_round_trips(bands):
    image = np.random.default_rng(bands).integers(0, 256, size=(bands, 13, 17), dtype=np.uint8)
    png, tif = images.encode_png(image), images.encode_tiff(image, {"a": 0.5, "c": 100.0, "e": -0.5, "f": 200.0, "epsg": 3007}, 255)
    assert (images.decode(png) == image).all() and (images.decode(tif) == image).all()
    head = images.header(tif)
    assert (head["width"], head["height"], head["bands"], head["dtype"]) == (17, 13, bands, "uint8")
    assert (head["a"], head["c"], head["e"], head["f"], head["epsg"], head["is_local"]) == (0.5, 100.0, -0.5, 200.0, 3007, False)
    assert images.header(png)["bands"] == bands and images.header(png)["epsg"] is None
    with pytest.raises(ValueError):
        images.decode(b"neither")


def test_png_filters():
    """Every filter of the format, against a plain writer of them."""
    import zlib

    image = np.random.default_rng(1).integers(0, 256, size=(6, 5, 3), dtype=np.uint8)
    raw, prior = b"", np.zeros((5, 3), dtype=int)
    for y, row in enumerate(image.astype(int)):
        left, corner = np.vstack([np.zeros((1, 3), int), row[:-1]]), np.vstack([np.zeros((1, 3), int), prior[:-1]])
        p = left + prior - corner
        near = np.stack([abs(p - left), abs(p - prior), abs(p - corner)]).argmin(axis=0)
        guess = [0 * row, left, prior, (left + prior) // 2, np.choose(near, [left, prior, corner])][y % 5]
        raw += bytes([y % 5]) + ((row - guess) % 256).astype(np.uint8).tobytes()
        prior = row
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 5, 6, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    assert (images.decode_png(png).transpose(1, 2, 0) == image).all()


def test_manifest_and_images(spark, tmp_path):
    image = np.arange(60, dtype=np.uint8).reshape(1, 6, 10)
    (tmp_path / "a.tif").write_bytes(images.encode_tiff(image, {"a": 1.0, "c": 5.0, "e": -1.0, "f": 9.0, "epsg": None}))
    (tmp_path / "b.png").write_bytes(images.encode_png(image))
    paths = [str(tmp_path / n) for n in ("a.tif", "b.png")]
    rows = {r.path[-5:]: r for r in images.read_manifest(spark, paths).collect()}
    assert rows["a.tif"].c == 5.0 and rows["a.tif"].epsg is None and rows["b.png"].a is None and rows["b.png"].width == 10
    assert {bytes(r.data) for r in images.read_images(spark, paths).collect()} == {image.tobytes()}


def test_tiles_with_pixels(spark, tmp_path):
    cells = spark.range(20 * 14).select(F.lit(1).cast("long").alias("scene_id"), (F.col("id") / 20).cast("int").alias("y"), (F.col("id") % 20).cast("int").alias("x"), (F.col("id") % 251).cast("int").alias("v"))
    own = rasters.to_blocks(cells, ["v"], 8)
    manifest = [(p, 20, 14, 3006, False, 1.0, 0.0, 100.0, 0.0, -1.0, 50.0) for p in ("/r/image/1_2_image.tif", "/r/annotation/1_2_annotation.tif")]
    manifest = spark.createDataFrame(manifest, "path string, width int, height int, epsg int, is_local boolean, a double, b double, c double, d double, e double, f double")
    listing = spark.createDataFrame([(0, r, f"/r/{r}/1_2_{r}.tif", f"1_2_{r}.tif") for r in ("image", "annotation")], "root_idx int, role_dir string, path string, name string")
    job = jobs.TilingJob(["/r"], clip=8, stride=6, ratio=0.5, direction="we")
    tiles = job.tiles(listing, manifest)
    bands = own.crossJoin(manifest.select("path"))
    for fmt in ("tif", "png"):
        job.write_pixels(tiles, bands, str(tmp_path / fmt), fmt, 8)
        rows = spark.read.parquet(str(tmp_path / fmt)).collect()
        assert len(rows) == tiles.count() > 4 and {(r.kind, r.split) for r in rows} == {(k, s) for k in ("image", "annotation") for s in ("train", "val")}
        for r in rows:
            y, x = np.mgrid[r.y0 : r.y1, r.x0 : r.x1]
            assert (images.decode(bytes(r.content))[0] == (y * 20 + x) % 251).all()
            if fmt == "tif":
                head = images.header(bytes(r.content))
                assert (head["c"], head["f"], head["epsg"]) == (100.0 + r.x0, 50.0 - r.y0, 3006)


def test_block_windows_see_their_place(spark):
    """A scorer that looks at the window gives other results at other strides; coverage is whole in both modes."""
    rng = np.random.default_rng(3)
    cells = [(1, y, x, *rng.integers(0, 9, 3).tolist()) for y in range(11) for x in range(19)]
    own = rasters.to_blocks(spark.createDataFrame(cells, "scene_id long, y int, x int, b0 int, b1 int, b2 int"), ["b0", "b1", "b2"], 8)
    size = spark.createDataFrame([(1, 19, 11)], "scene_id long, width int, height int")
    config = {"type": "linear_ramp", "weights": [[0.1, 0, 0], [0, 0.1, 0], [0, 0, 0.1]], "bias": [0, 0, 0], "ramp": [0.05, 0, -0.05]}
    for overlap in ("blend", "crop"):
        got = rasters.unpack(blocks.infer_blocks(own, size, config, 3, 8, 5, overlap, 8), 8)
        assert got.count() == 11 * 19 == got.select("y", "x").distinct().count() and got.where("v > 2").count() == 0


def test_evaluation_and_reports(spark, tmp_path):
    cells = [(1, y, x, (x + y) % 4, (x * y) % 3) for y in range(9) for x in range(7)]
    cells = spark.createDataFrame(cells, "scene_id long, y int, x int, raw int, pred int")
    truth, guess = rasters.to_blocks(cells, ["raw"], 4), rasters.to_blocks(cells, ["pred"], 4)
    per_class, mean = jobs.EvaluationJob().evaluate(truth, guess, class_dim(spark))
    pairs = [((x + y) % 4 - 1, (x * y) % 3) for y in range(9) for x in range(7) if (x + y) % 4]
    want = {k: (sum(g == p == k for g, p in pairs), sum(k in (g, p) for g, p in pairs)) for k in range(3)}
    assert {r.cls: (r.inter, r.union) for r in per_class.collect()} == want
    reports.write_evaluation(per_class, mean, "tiny", str(tmp_path / "eval"))
    line = json.loads(next((tmp_path / "eval").glob("*.json")).read_text())
    assert line["config"] == "tiny" and len(line["metric"]["iou"]) == 3 and abs(line["metric"]["miou"] - sum(a / b for a, b in want.values()) / 3) < 1e-12
    with pytest.raises(ValueError):
        reports.write_results(per_class, "out.pkl")
    reports.write_results(per_class, str(tmp_path / "results"))
    assert spark.read.parquet(str(tmp_path / "results")).count() == 3
    counts = reports.shares(spark.createDataFrame([("image", "train", 3), ("image", None, 1)], "kind string, split string, n long")).collect()
    text = reports.summary_text(counts, {"n_pairs": 2}, {"clip": 512})
    assert "image/train: 3 tiles (75.0%)" in text and "image/unassigned: 1 tiles (25.0%)" in text and text.endswith("total: 4")
    assert json.loads(reports.run_row(spark, "tiling", {"b": 1, "a": None}).first().parameters) == {"a": None, "b": 1}


def test_checkpoints_and_configurations(tmp_path):
    np.savez(tmp_path / "c.npz", **{"backbone.w": np.ones(2), "module.b": np.zeros(1), "head": np.ones(1)})
    assert set(reports.load_checkpoint(str(tmp_path / "c.npz"))) == {"w", "b", "head"}
    np.savez(tmp_path / "twice.npz", **{"backbone.w": np.ones(2), "w": np.zeros(1)})
    with pytest.raises(ValueError):
        reports.load_checkpoint(str(tmp_path / "twice.npz"))
    (tmp_path / "base.py").write_text("model = {'depth': 2, 'head': {'classes': 5, 'name': 'x'}}\nlr = 1.0\n_hidden = 1\n")
    (tmp_path / "more.json").write_text('{"data": {"batch": 8}}')
    (tmp_path / "own.py").write_text("_base_ = ['base.py', 'more.json']\nmodel = {'head': {'_delete_': True, 'classes': 3}}\n")
    assert reports.load_config(str(tmp_path / "own.py")) == {"model": {"depth": 2, "head": {"classes": 3}}, "lr": 1.0, "data": {"batch": 8}}
    (tmp_path / "loop.py").write_text("_base_ = 'loop.py'\n")
    with pytest.raises(ValueError):
        reports.load_config(str(tmp_path / "loop.py"))


def test_training_plan(spark, tmp_path):
    rows = [(k, s, f"/{k}/{i}", f"t{i}", None, f"t{i}_0_0_8_8.tif") for i in range(9) for k in ("image", "annotation") for s in ("train" if i % 3 else "val",) if (k, i) != ("annotation", 4)]
    spark.createDataFrame(rows, "kind string, split string, path string, tile_id string, token string, name string").write.partitionBy("kind", "split").parquet(str(tmp_path / "tiles"))
    plan = jobs.TrainingPlan(str(tmp_path / "tiles"), steps=10, batch=2, warmup=3)
    plan.validate(spark)
    assert {r.tile_id for r in plan.split(spark, "test").collect()} == {"t0", "t3", "t6"}
    first, again, other = (plan.epoch(spark, e).orderBy("batch", "slot").select("tile_id").collect() for e in (0, 0, 1))
    assert first == again != other and len(first) == 5 and all(r.label_path.replace("annotation", "image") == r.path for r in plan.split(spark, "train").collect())
    rates = [r.lr for r in plan.rates(spark).orderBy("step").collect()]
    assert len(rates) == 10 and rates[0] < rates[1] < rates[2] and rates[3] > rates[-1]
    for bad in ({"batch": 0}, {"warmup": 10}):
        with pytest.raises(ValueError):
            jobs.TrainingPlan(str(tmp_path / "tiles"), **({"steps": 10, "warmup": 3} | bad)).validate(spark)


def test_splits_of_repeated_keys(spark):
    keys = spark.createDataFrame([(i % 40, i) for i in range(120)], "k long, i long")
    seeded = splits.random_split_seeded(keys, "k", 0.5, 7)
    assert seeded.count() == 120 and seeded.groupBy("k").agg(F.count_distinct("split").alias("n")).where("n > 1").isEmpty()
    order = list(range(40))
    random.Random(7).shuffle(order)
    assert {r.k for r in seeded.where("split = 'train'").collect()} == set(order[:20])
    for ratio in (0.01, 0.5, 0.99):
        got = splits.random_split(spark.range(997).withColumnRenamed("id", "k"), "k", ratio, 1)
        assert got.where("split = 'train'").count() == int(997 * ratio) and got.count() == 997
    assert splits.random_split(keys.where("false"), "k", 0.5, 1).count() == 0


def test_numbered_is_dense(spark):
    rows = spark.range(1000).withColumn("o", (F.col("id") * 37 % 1000).cast("double"))
    got = splits.numbered(rows, "o", "id", "n").collect()
    assert sorted(r.n for r in got) == list(range(1000)) and all(r.n == r.id * 37 % 1000 for r in got)


def test_draws_are_even(spark):
    u = [r.u for r in spark.range(4000).select(augment.draw(1, "x", F.col("id")).alias("u")).collect()]
    assert 0 <= min(u) < 0.01 and 0.99 < max(u) < 1 and abs(sum(u) / 4000 - 0.5) < 0.02


@pytest.mark.parametrize(("size", "to"), [((3, 5), (7, 4)), ((8, 8), (8, 8)), ((6, 4), (2, 2)), ((1, 3), (4, 1)), ((2, 2), (9, 9))])
def test_bilinear(spark, size, to):
    image = np.random.default_rng(1).normal(size=size)
    rows = [(0, y, x, float(image[y, x])) for y in range(size[0]) for x in range(size[1])]
    got = {(r.y, r.x): r.v for r in stitch.bilinear(spark.createDataFrame(rows, "k int, y int, x int, v double"), "k", "v", size, to).collect()}

    def axis(n, m):
        src = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        lo = src.astype(int)
        return lo, np.minimum(lo + 1, n - 1), src - lo

    (ya, yb, fy), (xa, xb, fx) = axis(size[0], to[0]), axis(size[1], to[1])
    want = (1 - fy)[:, None] * ((1 - fx) * image[np.ix_(ya, xa)] + fx * image[np.ix_(ya, xb)]) + fy[:, None] * ((1 - fx) * image[np.ix_(yb, xa)] + fx * image[np.ix_(yb, xb)])
    assert len(got) == to[0] * to[1] and all(abs(want[k] - v) < 1e-9 for k, v in got.items())


def test_image_labels_takes_null_tokens(spark):
    rows = [("image", "a", None, "t", "/i"), ("annotation", "a", None, "t", "/l1"), ("annotation", "a", None, "t", "/l2"), ("image", "b", "x", "t", "/j")]
    got = pairing.image_labels(spark.createDataFrame(rows, "kind string, tile_id string, token string, name string, path string")).collect()
    assert [(r.path, r.label_path) for r in got] == [("/i", "/l2")]
