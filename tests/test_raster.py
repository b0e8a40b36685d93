"""Goldens worked out by hand, and properties, of the raster operators."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from terrawarp.functions import georef, names, pixels
from terrawarp.operators import evaluate, grid, overlay, pairing, score, splits, stitch


def one_axis(spark, length, clip, stride):
    rows = grid.tile_grid(spark.createDataFrame([(length, 1)], "width int, height int"), clip, stride).collect()
    return sorted((r.x0, r.x1) for r in rows)


@pytest.mark.parametrize(
    ("length", "clip", "stride", "want"),
    [
        (1000, 512, 256, [(0, 512), (256, 768), (488, 1000)]),
        (512, 512, 256, [(0, 512)]),
        (513, 512, 256, [(0, 512), (1, 513)]),
        (300, 512, 256, [(0, 300)]),
        (1024, 512, 512, [(0, 512), (512, 1024)]),
        (1100, 512, 512, [(0, 512), (512, 1024), (588, 1100)]),
        (2000, 512, 600, [(0, 512), (600, 1112), (1200, 1712), (1488, 2000)]),
    ],
)
def test_tile_axis(spark, length, clip, stride, want):
    assert one_axis(spark, length, clip, stride) == want


@pytest.mark.parametrize(
    ("length", "stride", "want"),
    [
        (1000, 384, [(0, 0, 512), (384, 64, 384), (488, 64, 448)]),
        (512, 384, [(0, 0, 512)]),
        (1280, 384, [(0, 0, 512), (384, 64, 384), (768, 64, 448)]),
        (1024, 512, [(0, 0, 512), (512, 0, 512)]),
        (300, 384, [(0, 0, 300)]),
    ],
)
def test_inference_axis(spark, length, stride, want):
    rows = grid.inference_grid(spark.createDataFrame([(length, 1)], "width int, height int"), 512, stride).collect()
    assert sorted((r.read_x, r.crop_x, r.crop_w) for r in rows) == want


def test_inference_grid_covers_everything_once_or_more(spark):
    sizes = [(n, ws, st) for n in (1, 7, 8, 9, 23, 40) for ws, st in ((8, 8), (8, 5), (8, 1))]
    for n, ws, st in sizes:
        rows = grid.inference_grid(spark.createDataFrame([(n, 1)], "width int, height int"), ws, st).collect()
        kept = set(itertools.chain.from_iterable(range(r.write_x, r.write_x + r.crop_w) for r in rows))
        assert kept == set(range(n)), (n, ws, st)
        assert all(0 <= r.read_x and r.read_x + r.win_w <= n for r in rows)
    with pytest.raises(ValueError):
        grid.inference_grid(spark.createDataFrame([(9, 9)], "width int, height int"), 4, 5)


def test_split_rounding_and_sides(spark):
    got = splits.spatial_split(spark.createDataFrame([(10, 10), (14, 14), (1001, 1001)], "width int, height int"), 0.25, "ns").where("split = 'train'")
    assert sorted(r.win_h for r in got.collect()) == [2, 4, 250]
    s = spark.createDataFrame([(20, 1001)], "width int, height int")
    for way, train, val in (("ns", (0, 755), (755, 246)), ("sn", (246, 755), (0, 246))):
        rows = {r.split: (r.row_off, r.win_h) for r in splits.spatial_split(s, 0.75424, way).collect()}
        assert rows == {"train": train, "val": val}
    for bad in (0, 1, 1.5):
        with pytest.raises(ValueError):
            splits.spatial_split(s, bad, "ns")


@pytest.mark.parametrize(("n", "ratio", "want"), [(7, 0.8, 5), (10, 0.75424, 7), (3, 0.5, 1), (5000, 0.3, 1500)])
def test_random_split_truncates(spark, n, ratio, want):
    keys = spark.range(n).withColumnRenamed("id", "k")
    assert splits.random_split(keys, "k", ratio, 42).where("split = 'train'").count() == want
    if n < 100:
        rows = {r.k: r.split for r in splits.random_split_seeded(keys, "k", ratio, 42).collect()}
        order = list(range(n))
        random.Random(42).shuffle(order)
        assert {k for k, s in rows.items() if s == "train"} == set(order[: int(n * ratio)])


def test_seeded_split_of_many_keys(spark):
    n = 1_000_100
    keys = spark.range(n, numPartitions=8).select((F.lit(n - 1) - F.col("id")).alias("k"))
    got = splits.random_split_seeded(keys, "k", 0.3, 42)
    order = list(range(n))
    random.Random(42).shuffle(order)
    train = {r.k for r in got.where("split = 'train'").select("k").collect()}
    assert train == set(order[: int(n * 0.3)]) and got.count() == n


def test_seeded_split_orders_nulls_first_and_takes_no_rows(spark):
    keys = spark.createDataFrame([("b",), (None,), ("a",), (None,)], "k string")
    order = [0, 1, 2]
    random.Random(5).shuffle(order)
    train = {(None, "a", "b")[i] for i in order[:1]}
    assert {r.k for r in splits.random_split_seeded(keys, "k", 0.5, 5).where("split = 'train'").collect()} == train
    assert splits.random_split_seeded(keys.where("false"), "k", 0.5, 5).count() == 0


def test_names(spark):
    cases = {"6398_149_train_image.tif": ("6398_149", "train"), "6398_149_image.tif": ("6398_149", None), "a_b_c_d_image.tif": ("a_b", None), "a_image.tif": None, "_b_image.tif": ("_b", None), "a__image.tif": ("a_", None), "a_b_Image.tif": None, "": None, None: None}
    rows = spark.createDataFrame([(k,) for k in cases], "name string").select("name", names.parse_name(F.col("name")).alias("p")).collect()
    assert {r.name: r.p and (r.p.tile_id, r.p.token) for r in rows} == cases


def test_pairs_take_the_last_root_and_null_tokens_meet(spark):
    rows = [(0, "image", "/0/i/a_b_image.tif", "a_b_image.tif"), (1, "image", "/1/i/a_b_image.tif", "a_b_image.tif"), (0, "annotation", "/0/a/a_b_annotation.tif", "a_b_annotation.tif"), (0, "image", "/0/i/c_d_val_image.tif", "c_d_val_image.tif"), (0, "image", "/0/i/x.tif", "x.tif")]
    listing = spark.createDataFrame(rows, "root_idx int, role_dir string, path string, name string")
    got = pairing.pair_files(listing).collect()
    assert [(r.tile_id, r.token, r.split, r.image_path) for r in got] == [("a_b", None, None, "/1/i/a_b_image.tif")]
    assert [(r.tile_id, r.missing_role) for r in pairing.unpaired(listing).collect()] == [("c_d", "annotation")]
    assert [r.name for r in pairing.rejected(listing).collect()] == ["x.tif"]
    with pytest.raises(ValueError, match="a_b"):
        splits.filename_split(pairing.pair_files(listing))
    with pytest.raises(ValueError):
        pairing.require_pairs(pairing.pair_files(listing.where("false")))


def test_pixel_functions(spark):
    r = spark.range(1).select(pixels.softmax(F.array(F.lit(2.0), F.lit(1.0), F.lit(0.0))).alias("p"), pixels.argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))).alias("a"), pixels.to_uint8(F.lit(-1)).alias("u"), pixels.channel_order(F.array(*map(F.lit, (1, 2, 3, 4)))).alias("c")).first()
    assert [round(x, 6) for x in r.p] == [0.665241, 0.244728, 0.090031]
    assert (r.a, r.u, r.c) == (1, 255, [3, 2, 1])
    got = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 255)], "v int").select("v", pixels.reduce_zero_label(F.col("v")).alias("w")).collect()
    assert {r.v: r.w for r in got} == {0: 255, 1: 0, 2: 1, 3: 2, 255: 255}
    assert pixels.parse_bands("all", 3) == [1, 2, 3] == pixels.parse_bands(None, 3)
    for bad in ("0", "1,4", "x"):
        with pytest.raises(ValueError):
            pixels.parse_bands(bad, 3)


def test_iou_golden(spark):
    from terrawarp.schema import class_dim

    raw, pred = [1, 1, 2, 2, 3, 3, 0, 3], [0, 1, 1, 1, 2, 0, 2, 2]
    p = spark.createDataFrame(list(zip(raw, pred, strict=True)), "raw int, pred int").select(pixels.reduce_zero_label(F.col("raw")).alias("gt"), "pred")
    per = evaluate.class_iou(evaluate.confusion(p), class_dim(spark))
    assert {r["class"]: round(r.iou, 6) for r in per.collect()} == {"bg": 0.333333, "water": 0.666667, "tree": 0.666667}
    assert round(evaluate.mean_iou(per).first().miou, 6) == 0.555556
    assert {r.iou for r in evaluate.class_iou(evaluate.confusion(p.where("false")), class_dim(spark)).collect()} == {None}


def test_overlay_priority(spark):
    boxes = spark.createDataFrame([(1, 0, 2, 1, 0.0, 0.0, 4.0, 4.0), (1, 1, 3, 0, 0.0, 0.0, 8.0, 8.0), (1, 2, 3, 1, 3.0, 3.0, 4.5, 4.0), (1, 3, 0, 9, 0.0, 0.0, 8.0, 8.0), (1, 4, 2, 9, None, 0.0, 8.0, 8.0)], "s int, list_pos int, class_value int, draw_order int, x0 double, y0 double, x1 double, y1 double")
    cells = overlay.box_cells(boxes, 8, 8)
    got = {(r.y, r.x): r.cls for r in overlay.overlay(overlay.pixel_grid(boxes.select("s").distinct(), "s", 9, 9), cells, "s", 1).collect()}
    assert got[0, 0] == 2 and got[3, 3] == 3 and got[3, 4] == 3 and got[5, 5] == 3 and got[8, 8] == 1 and len(got) == 81


def test_polygon_cells_equal_boxes_and_split_diagonals(spark):
    ring = lambda pts: [{"x": float(x), "y": float(y)} for x, y in pts]
    rows = [(1, ring([(1.2, 1.2), (3.5, 1.2), (3.5, 2.8), (1.2, 2.8)])), (2, ring([(0, 0), (4, 0), (0, 4)])), (3, None), (4, ring([(0, 0), (1, 1)]))]
    p = spark.createDataFrame(rows, "k int, ring array<struct<x:double,y:double>>")
    got = {}
    for r in overlay.polygon_cells(p, 6, 6, ["k"]).collect():
        got.setdefault(r.k, set()).add((r.y, r.x))
    assert got[1] == {(y, x) for y in (1, 2) for x in (1, 2, 3)}
    assert {(y, x) for y in range(4) for x in range(4) if x + y < 4} <= got[2] <= {(y, x) for y in range(5) for x in range(5) if x + y <= 4}
    assert set(got) == {1, 2}


def plainly_touched(rings, x, y):
    """Whether the cell at (x, y) holds a part of the polygon, one point and one edge at a time."""
    edges = [(r[i], r[(i + 1) % len(r)]) for r in rings for i in range(len(r))]
    for px, py in ((x + 0.5, y + 0.5), (x, y), (x + 1, y), (x, y + 1), (x + 1, y + 1)):
        if sum((a[1] > py) != (b[1] > py) and px < a[0] + (py - a[1]) / (b[1] - a[1]) * (b[0] - a[0]) for a, b in edges) % 2:
            return True
    for a, b in edges:
        lo, hi = 0.0, 1.0
        for p, d, c in ((a[0], b[0] - a[0], x), (a[1], b[1] - a[1], y)):
            if d == 0:
                lo = 2.0 if p < c or p > c + 1 else lo
            else:
                lo, hi = max(lo, min((c - p) / d, (c + 1 - p) / d)), min(hi, max((c - p) / d, (c + 1 - p) / d))
        if lo <= hi:
            return True
    return False


def test_cells_of_many_polygons(spark):
    """Polygons of several rings, beyond the raster too, and what is no geometry, against cell by cell."""
    rng, rows, want = random.Random(4), [], set()
    for k in range(3000):
        rings, q = [], rng.choice([1, 4, 1000])
        cx, cy = rng.uniform(-3, 16), rng.uniform(-3, 16)
        for _ in range(rng.choice([1, 1, 2, 3])):
            rings.append([(round((cx + rng.uniform(-3, 3)) * q) / q, round((cy + rng.uniform(-3, 3)) * q) / q) for _ in range(rng.choice([2, 3, 4, 4, 5, 5, 7]))])
        if k % 3 == 0:
            rings = [[*r, r[0]] for r in rings]
        if k % 50 == 0:
            rings[0][0] = (float("nan"), 1.0)
        rows.append((k, None if k % 100 == 7 else [] if k % 100 == 8 else [None, *rings] if k % 100 == 9 else rings))
        r = rows[-1][1]
        if r and all(x is not None and len(x) >= 3 and all(math.isfinite(v) for p in x for v in p) for x in r):
            xs, ys = [p[0] for x in r for p in x], [p[1] for x in r for p in x]
            want |= {(k, y, x) for y in range(max(0, math.floor(min(ys))), min(14, math.ceil(max(ys)))) for x in range(max(0, math.floor(min(xs))), min(11, math.ceil(max(xs)))) if plainly_touched(r, x, y)}
    p = spark.createDataFrame(rows, "k int, rings array<array<struct<x:double,y:double>>>")
    got = [(r.k, r.y, r.x) for r in overlay.polygon_cells(p, 11, 14, ["k"]).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_crop_equals_blend_without_overlap(spark):
    s = spark.createDataFrame([(1, 21, 17)], "scene_id int, width int, height int")
    px = stitch.window_pixels(grid.inference_grid(s, 8, 8)).withColumns({f"p{i}": (F.hash("y", "x", F.lit(i)) % 8 + 8) / 16 for i in range(3)})
    # the last, anchored windows overlap their neighbours, so values are made the same for a pixel in each window
    a = stitch.blend(px, "scene_id", ["p0", "p1", "p2"]).select("y", "x", "cls")
    b = stitch.crop(px.withColumn("cls", pixels.argmax(F.array("p0", "p1", "p2"))), "scene_id", "cls").select("y", "x", "cls")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == 21 * 17


def small_rasters(spark):
    """Rasters whose estimated size is small, and their pixels at even x."""
    s = spark.range(40).select(F.col("id").alias("scene_id"))
    return overlay.pixel_grid(s, "scene_id", 6, 5), overlay.pixel_grid(s, "scene_id", 6, 4).where("x % 2 = 0").withColumn("v", F.col("x") + 1)


def test_pad_broadcasts_no_pixels(spark):
    every, some = small_rasters(spark)
    got = stitch.pad(every, some.withColumn("gt", F.col("v")), "scene_id", "v", "gt")
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = lambda r: (r.x + 1, r.x + 1) if r.x % 2 == 0 and r.y < 4 else (0, 255)
    rows = got.collect()
    assert len(rows) == 1200 and all((r.v, r.gt) == want(r) for r in rows)


def test_fill_nodata_broadcasts_no_pixels(spark):
    every, some = small_rasters(spark)
    got = stitch.fill_nodata(every, some, "scene_id", "v")
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
    rows = got.collect()
    assert len(rows) == 1200 and all(r.v == (r.x + 1 if r.x % 2 == 0 and r.y < 4 else 255) for r in rows)


def test_bilinear_keeps_constants_and_sums_weights(spark):
    p = overlay.pixel_grid(spark.createDataFrame([(1,)], "k int"), "k", 5, 4).withColumn("v", F.lit(2.5))
    got = stitch.bilinear(p, "k", "v", (4, 5), (9, 3)).collect()
    assert len(got) == 27 and all(math.isclose(r.v, 2.5) for r in got)


def test_georef(spark):
    g = spark.createDataFrame([(3010, False), (3010, True), (None, None)], "epsg int, is_local boolean")
    assert [r.t for r in g.select(georef.tiling_epsg(F.col("epsg"), F.col("is_local"), 3007).alias("t")).collect()] == [3010, 3007, 3007]
    assert [r.t for r in g.select(georef.inference_epsg(F.col("epsg"), 3007).alias("t")).collect()] == [3010, 3010, 3007]


def test_scorer_registry(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "k int, bands array<double>")
    got = {r.k: r.logits for r in score.score(rows, "k", "bands", {"type": "linear", "weights": [[1, 0], [0, 1], [1, 1]], "bias": [0, 0, 1]}).collect()}
    assert got == {1: [1.0, 2.0, 4.0], 2: None}
    with pytest.raises(ValueError):
        score.build({"type": "none"})
