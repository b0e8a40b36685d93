"""Further queries of the catalogue: rasters as blocks, geometry, listings, training steps and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawarp.functions import names, pixels
from terrawarp.operators import augment, blocks, evaluate, grid, overlay, pairing, splits
from terrawarp.plans import catalogue as c
from terrawarp.plans import jobs, reports
from terrawarp.plans.catalogue import query
from terrawarp.plans.fixtures import fixture, sql
from terrawarp.schema import class_dim
from terrawarp.sources import rasters, vector

SIDE = 8
BAND = tuple(f"((x * {p} + y * {q} + scene_id * {r}) % 16)" for p, q, r in ((3, 5, 1), (7, 2, 3), (1, 11, 2)))
RAMP = {"type": "linear_ramp", "weights": [[0.125, 0.0625, 0.03125], [0.03125, 0.125, 0.0625], [0.0625, 0.03125, 0.125]], "bias": [0.0, 0.25, 0.5], "ramp": [0.0625, -0.03125, 0.015625]}
_GRID = f"(SELECT scene_id, width, height, y, unnest(range(width)) AS x FROM (SELECT *, unnest(range(height)) AS y FROM {c._SMALL}))"


def _bands(spark: SparkSession, d: str) -> DataFrame:
    """Band blocks of the small rasters."""
    cells = overlay.pixel_grid(fixture(spark, d, "small"), "scene_id", F.col("width"), F.col("height"))
    return rasters.to_blocks(cells.select("scene_id", "y", "x", *[F.expr(b).alias(f"b{i}") for i, b in enumerate(BAND)]), ["b0", "b1", "b2"], SIDE)


_Z = [" + ".join(f"{w} * {b}" for w, b in zip(row, BAND[::-1], strict=True)) + f" + {RAMP['bias'][i]} + {RAMP['ramp'][i]} * ((y - read_y) + 2 * (x - read_x))" for i, row in enumerate(RAMP["weights"])]
_SCORED = f"""(SELECT *, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2 FROM (
  SELECT *, exp((z0 - greatest(z0, z1, z2))::DOUBLE) AS e0, exp((z1 - greatest(z0, z1, z2))::DOUBLE) AS e1, exp((z2 - greatest(z0, z1, z2))::DOUBLE) AS e2 FROM (
    SELECT *, {', '.join(f'({z})::DOUBLE AS z{i}' for i, z in enumerate(_Z))} FROM (SELECT w.*, unnest(range(read_x, read_x + win_w)) AS x FROM (
      SELECT *, unnest(range(read_y, read_y + win_h)) AS y FROM {c._windows_sql(c._SMALL, c.SMALL_WINDOW, c.SMALL_STEP)}) w))))"""


@query("q43_block_blend", f"""SELECT scene_id, {c._INT('y x')}, CAST(count(*) AS INTEGER) AS n, round(avg(p0), 6) AS p0, round(avg(p1), 6) AS p1, round(avg(p2), 6) AS p2
  FROM {_SCORED} GROUP BY scene_id, y, x""")
def q43(spark: SparkSession, d: str) -> DataFrame:
    small = fixture(spark, d, "small")
    pieces = blocks.window_pieces(_bands(spark, d), small, RAMP, c.SMALL_WINDOW, c.SMALL_STEP, SIDE, "float64")
    made = blocks.blend_blocks(pieces, small, 3, SIDE, "float64")
    return rasters.unpack_means(made, 3, SIDE).select("scene_id", "y", "x", "n", *[F.round(f"p{i}", 6).alias(f"p{i}") for i in range(3)])


@query("q44_block_crop", f"""SELECT scene_id, {c._INT('y x')}, CAST(arg_max({c._ARG}, (read_y, read_x)) AS INTEGER) AS cls FROM {_SCORED}
  WHERE x >= write_x AND x < write_x + crop_w AND y >= write_y AND y < write_y + crop_h GROUP BY scene_id, y, x""")
def q44(spark: SparkSession, d: str) -> DataFrame:
    small = fixture(spark, d, "small")
    made = blocks.infer_blocks(_bands(spark, d), small, RAMP, 3, c.SMALL_WINDOW, c.SMALL_STEP, "crop", SIDE, "float64")
    return rasters.unpack(made, SIDE).select("scene_id", "y", "x", F.col("v").alias("cls"))


_TRUTH, _GUESS = "((x * 5 + y * 3 + scene_id) % 4)", "((x + y * 2 + scene_id) % 3)"


@query("q45_raster_iou", f"""WITH p AS (SELECT {c._REDUCED.replace('raw', _TRUTH)} AS gt, {_GUESS} AS pred FROM {_GRID}),
  k AS (SELECT k.cls, k.name, count(*) FILTER (gt = k.cls AND pred = k.cls) AS i, count(*) FILTER (gt = k.cls OR pred = k.cls) AS u
        FROM (VALUES {c._CLASS_VALUES}) k(cls, name, r, g, b) LEFT JOIN (SELECT * FROM p WHERE gt <> 255) p ON true GROUP BY k.cls, k.name)
  SELECT name AS class, i AS inter, u AS "union", i / nullif(u, 0) AS iou, round(avg(i / nullif(u, 0)) OVER (), 9) AS miou FROM k""")
def q45(spark: SparkSession, d: str) -> DataFrame:
    cells = overlay.pixel_grid(fixture(spark, d, "small"), "scene_id", F.col("width"), F.col("height"))
    truth, guess = (rasters.to_blocks(cells.withColumn("v", F.expr(e)), ["v"], SIDE) for e in (_TRUTH, _GUESS))
    per_class, mean = jobs.EvaluationJob().evaluate(truth, guess, class_dim(spark))
    return per_class.drop("cls").crossJoin(mean.select(F.round("miou", 9).alias("miou")))  # one row


@query("q46_tile_pixels", f"""SELECT name AS tile, CAST(x1 - x0 AS INTEGER) AS w, CAST(y1 - y0 AS INTEGER) AS h, CAST(sum({BAND[0]}) AS BIGINT) AS s0, CAST(sum({BAND[2]} * ((y - y0) * 64 + x - x0)) AS BIGINT) AS s2 FROM (
  SELECT *, unnest(range(x0, x1)) AS x FROM (SELECT *, concat_ws('_', scene_id, x0, y0, x1, y1) || '.tif' AS name, unnest(range(y0, y1)) AS y FROM {c._tiles_sql(c._SMALL, 7, '4')})) GROUP BY ALL""")
def q46(spark: SparkSession, d: str) -> DataFrame:
    t = grid.tile_grid(fixture(spark, d, "small"), 7, 4)
    t = t.withColumn("tile", names.tile_name(F.col("scene_id"), *[F.col(k) for k in ("x0", "y0", "x1", "y1")]))
    return rasters.tile_sums(blocks.cut_tiles(_bands(spark, d), t, "tile", SIDE)).select("tile", "w", "h", "s0", "s2")


@query("q47_window_read", f"SELECT scene_id, CAST(band AS INTEGER) AS band, {c._INT('y x')}, CAST(CASE band WHEN 1 THEN {BAND[0]} ELSE {BAND[2]} END AS INTEGER) AS v FROM {_GRID}, (VALUES (1), (3)) b(band) WHERE y BETWEEN 3 AND 9 AND x BETWEEN 5 AND 13")
def q47(spark: SparkSession, d: str) -> DataFrame:
    own = _bands(spark, d).where(F.col("band").isin(1, 3))
    return rasters.window(own, 3, 5, 7, 9, SIDE)


@query("q48_uint8_wrap", "SELECT l_orderkey, l_linenumber, CAST(((CAST(floor(l_extendedprice) AS BIGINT) - 20000) % 256 + 256) % 256 AS INTEGER) AS v FROM lineitem")
def q48(spark: SparkSession, d: str) -> DataFrame:
    price = F.floor("l_extendedprice") - 20000
    return c.fixture_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", pixels.to_uint8(price).alias("v"))


#: Boxes with a hole each, at quarter pixels, by order key.
_HOLED = "SELECT o_orderkey AS k, (o_orderkey * 7) % 40 + 0.25 AS ox, (o_custkey * 5) % 40 + 0.25 AS oy, 6 + o_orderkey % 5 AS size, 1 + o_orderkey % 2 AS inset FROM {orders}"


def _holed(spark: SparkSession, d: str) -> DataFrame:
    o = spark.sql(_HOLED, orders=c.fixture_table(spark, d, "orders"))
    x0, y0, far = F.col("ox"), F.col("oy"), F.col("size").cast("double")
    inset = F.col("inset") + 0.5
    outer = vector.box_ring(x0, y0, x0 + far, y0 + far)
    return o.select("k", F.array(outer, vector.box_ring(x0 + inset, y0 + inset, x0 + far - inset, y0 + far - inset)).alias("rings"))


@query("q49_holed_polygons", f"""SELECT k, {c._INT('y x')} FROM (SELECT *, unnest(range(CAST(floor(ox) AS BIGINT), least(CAST(ceil(ox + size) AS BIGINT), 44))) AS x FROM (
  SELECT *, unnest(range(CAST(floor(oy) AS BIGINT), least(CAST(ceil(oy + size) AS BIGINT), 44))) AS y FROM ({_HOLED.replace('{orders}', 'orders')})))
  WHERE NOT (x > ox + inset + 0.5 AND x + 1 < ox + size - inset - 0.5 AND y > oy + inset + 0.5 AND y + 1 < oy + size - inset - 0.5)""")
def q49(spark: SparkSession, d: str) -> DataFrame:
    return overlay.polygon_cells(_holed(spark, d), 44, 44, ["k"])


#: Layers of WKB polygons: sound squares, squares with a corner moved across, unclosed ones, lines, and nulls.
_FAULTS = {0: None, 1: "edges cross", 2: "not closed", 3: "no area", 4: "null"}


@query("q50_geometry_faults", f"SELECT CASE o_orderkey % 5 {' '.join(f'WHEN {k} THEN {v!r}' for k, v in _FAULTS.items() if v)} END AS fault, count(*) AS n FROM orders GROUP BY 1")
def q50(spark: SparkSession, d: str) -> DataFrame:
    o = c.fixture_table(spark, d, "orders")
    corners = {0: "0 0 4 0 4 4 0 4 0 0", 1: "0 0 4 4 4 0 0 4 0 0", 2: "0 0 4 0 4 4 0 4 1 1", 3: "0 0 4 0 8 0 2 0 0 0"}
    of = {k: vector.rings_wkb([list(zip(*[iter(map(float, v.split()))] * 2, strict=True))]) for k, v in corners.items()}
    kind = F.col("o_orderkey") % 5
    wkb = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in of.items()])
    return vector.with_faults(o.select("o_orderkey", wkb.alias("geom_wkb"))).groupBy("fault").agg(F.count("*").alias("n"))


_MANIFEST = "SELECT path, 300 + (length(path) * 211) % 900 AS width, 300 + (length(path) * 97) % 900 AS height FROM ({listing}) l"


def _listed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    listing = fixture(spark, d, "listing").where("root_idx = 0")
    return listing, spark.sql(_MANIFEST.replace("({listing}) l", "{listing}"), listing=listing)


_FLAT = f"(SELECT q.path, q.width, q.height, p.name, coalesce(p.tile_id, p.stem) AS prefix FROM ({_MANIFEST.format(listing=sql('listing'))} WHERE path LIKE '/data/root0/%') q JOIN ({c._PARSE % (c._STEM, sql('listing'))}) p ON p.path = q.path)"
_COUNT = f"(CASE WHEN height > {c.CLIP} THEN CAST(ceil((height - {c.CLIP}) / {c.CLIP}) AS BIGINT) + 1 ELSE 1 END) * (CASE WHEN width > {c.CLIP} THEN CAST(ceil((width - {c.CLIP}) / {c.CLIP}) AS BIGINT) + 1 ELSE 1 END)"


@query("q51_inference_tiles", f"SELECT path, prefix, {c._INT('x0 y0 x1 y1')}, concat_ws('_', prefix, x0, y0, x1, y1) || '.tif' AS tile FROM {c._tiles_sql(_FLAT, c.CLIP, str(c.CLIP))}")
def q51(spark: SparkSession, d: str) -> DataFrame:
    return jobs.tiles_of(*_listed(spark, d), c.CLIP)


@query("q52_inference_totals", f"SELECT prefix, CAST(sum({_COUNT}) AS BIGINT) AS n FROM {_FLAT} GROUP BY ROLLUP (prefix)")
def q52(spark: SparkSession, d: str) -> DataFrame:
    return jobs.inference_totals(*_listed(spark, d), c.CLIP)


@query("q53_first_unassigned", f"SELECT DISTINCT tile_id FROM {c._PAIRS} WHERE split IS NULL ORDER BY tile_id LIMIT 5")
def q53(spark: SparkSession, d: str) -> DataFrame:
    return pairing.pair_files(fixture(spark, d, "listing")).where("split IS NULL").select("tile_id").distinct().orderBy("tile_id").limit(5)


@query("q54_source_counts", f"SELECT count(*) AS n_pairs, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val, count(*) FILTER (split IS NULL) AS n_unassigned FROM {c._PAIRS}")
def q54(spark: SparkSession, d: str) -> DataFrame:
    return reports.source_counts(pairing.pair_files(fixture(spark, d, "listing")))


@query("q55_summary_lines", f"""SELECT kind, split, n, percent, kind || '/' || coalesce(split, 'unassigned') || ': ' || n || ' tiles (' || printf('%.1f', percent) || '%)' AS line FROM (
  SELECT kind, split, n, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY kind), 1) AS percent FROM (SELECT kind, split, count(*) AS n FROM {c._KIND_TILES} GROUP BY ALL))""")
def q55(spark: SparkSession, d: str) -> DataFrame:
    return reports.shares(c._pair_tiles(spark, d).groupBy("kind", "split").agg(F.sum("n").alias("n")))


_NAMED = "(SELECT o_orderkey AS k, o_orderkey % 3 = 0 AS bare, 't' || (o_orderkey % 97) || '_' || o_custkey AS tile_id, CASE WHEN o_orderkey % 2 = 0 THEN 'train' END AS token FROM orders)"


@query("q56_image_labels", f"""SELECT i.tile_id, i.token, '0_0_8_8.tif' AS tile, max(l.path) AS label_path, count(DISTINCT i.k) AS n FROM {_NAMED} i
  JOIN (SELECT tile_id, token, '/ann/' || k AS path FROM {_NAMED} WHERE NOT bare) l ON l.tile_id = i.tile_id AND l.token IS NOT DISTINCT FROM i.token GROUP BY i.tile_id, i.token""")
def q56(spark: SparkSession, d: str) -> DataFrame:
    o = c.fixture_table(spark, d, "orders")
    key = F.concat(F.lit("t"), (F.col("o_orderkey") % 97).cast("string"), F.lit("_"), F.col("o_custkey").cast("string"))
    named = o.select("o_orderkey", key.alias("tile_id"), F.when(F.col("o_orderkey") % 2 == 0, "train").alias("token"), F.lit("0_0_8_8.tif").alias("tile"))
    images = named.withColumns({"kind": F.lit("image"), "path": F.concat(F.lit("/img/"), F.col("o_orderkey").cast("string"))})
    labels = named.where("o_orderkey % 3 <> 0").withColumns({"kind": F.lit("annotation"), "path": F.concat(F.lit("/ann/"), F.col("o_orderkey").cast("string"))})
    met = pairing.image_labels(images.unionByName(labels), "tile")
    return met.groupBy("tile_id", "token", "tile", "label_path").agg(F.count_distinct("path").alias("n"))


_DRAW = lambda purpose, *keys: f"(('0x' || substr(md5('42:{purpose}:' || {' || chr(58) || '.join(f'({k})::VARCHAR' for k in keys)}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


@query("q57_resize_target", f"""SELECT scene_id, CAST(edge AS INTEGER) AS edge, CAST(floor(width * (edge / greatest(width, height)) + 0.5) AS INTEGER) AS width, CAST(floor(height * (edge / greatest(width, height)) + 0.5) AS INTEGER) AS height FROM (
  SELECT *, floor(512 * (0.5::DOUBLE + {_DRAW('resize', 'scene_id')} * 1.5::DOUBLE))::INTEGER AS edge FROM {c._SCENES})""")
def q57(spark: SparkSession, d: str) -> DataFrame:
    u = augment.draw(42, "resize", F.col("scene_id"))
    return fixture(spark, d, "scenes").select("scene_id", augment.resize_target(F.col("width"), F.col("height"), u).alias("t")).select("scene_id", "t.*")


CROP = 24


@query("q58_random_crop", f"""WITH t AS (SELECT scene_id, attempt, floor({_DRAW('y', 'scene_id', 'attempt')} * {c.SIDE - CROP + 1})::INTEGER AS y0, floor({_DRAW('x', 'scene_id', 'attempt')} * {c.SIDE - CROP + 1})::INTEGER AS x0
    FROM (SELECT DISTINCT scene_id FROM {c._LABELS}), (SELECT unnest(range(10)) AS attempt)),
  s AS (SELECT scene_id, attempt, max(n) / sum(n) < 0.6 AS keep FROM (SELECT t.scene_id, t.attempt, l.cls, count(*) AS n FROM t JOIN {c._LABELS} l ON l.scene_id = t.scene_id
    AND l.y >= t.y0 AND l.y < t.y0 + {CROP} AND l.x >= t.x0 AND l.x < t.x0 + {CROP} GROUP BY ALL) GROUP BY ALL)
  SELECT scene_id, CAST(attempt AS INTEGER) AS attempt, y0, x0, y0 + {CROP} AS y1, x0 + {CROP} AS x1 FROM (
    SELECT t.*, row_number() OVER (PARTITION BY t.scene_id ORDER BY CASE WHEN s.keep THEN t.attempt ELSE 20 - t.attempt END) AS k FROM t LEFT JOIN s USING (scene_id, attempt)) WHERE k = 1""")
def q58(spark: SparkSession, d: str) -> DataFrame:
    labels = c._labels(spark, d)
    tiles = labels.select("scene_id").distinct().withColumns({"width": F.lit(c.SIDE), "height": F.lit(c.SIDE)})
    return augment.random_crop(tiles, labels, "scene_id", CROP, 42, 0.6)


@query("q59_photometric", f"""SELECT vec_id, {', '.join(f"round(greatest(least(floor(abs(embedding[{i + 1}]::DOUBLE) * 256) * gain + shift, 255.0::DOUBLE), 0.0::DOUBLE), 6) AS b{i}" for i in range(3))} FROM (
  SELECT *, CASE WHEN {_DRAW('shift?', 'vec_id')} < 0.5 THEN ({_DRAW('shift', 'vec_id')} * 2 - 1) * 32.0::DOUBLE ELSE 0.0::DOUBLE END AS shift, CASE WHEN {_DRAW('gain?', 'vec_id')} < 0.5 THEN 0.5::DOUBLE + {_DRAW('gain', 'vec_id')} ELSE 1.0::DOUBLE END AS gain FROM embeddings)""")
def q59(spark: SparkSession, d: str) -> DataFrame:
    e = c.fixture_table(spark, d, "embeddings")
    bands = F.transform(F.slice("embedding", 1, 3), lambda v: F.floor(F.abs(v.cast("double")) * 256))
    out = e.select("vec_id", augment.photometric(bands, 42, F.col("vec_id")).alias("b"))
    return out.select("vec_id", *[F.round(F.get("b", i), 6).alias(f"b{i}") for i in range(3)])


@query("q60_epoch_batches", f"SELECT scene_id, CAST(n // 8 AS BIGINT) AS batch, CAST(n % 8 AS INTEGER) AS slot FROM (SELECT scene_id, row_number() OVER (ORDER BY {_DRAW('epoch 0', 'scene_id')}, scene_id) - 1 AS n FROM {c._SCENES})")
def q60(spark: SparkSession, d: str) -> DataFrame:
    rows = fixture(spark, d, "scenes").withColumn("_o", augment.draw(42, "epoch 0", F.col("scene_id")))
    return augment.batches(splits.numbered(rows, "_o", "scene_id", "n"), "n", 8).select("scene_id", "batch", "slot")


@query("q61_test_variants", f"SELECT scene_id, ratio, flipped, CAST(floor(512 * ratio) AS INTEGER) AS edge FROM {c._SCENES}, (SELECT unnest([0.5, 0.75, 1.0, 1.25, 1.5, 1.75])::DOUBLE AS ratio), (VALUES (false), (true)) f(flipped)")
def q61(spark: SparkSession, d: str) -> DataFrame:
    return augment.test_variants(fixture(spark, d, "scenes").select("scene_id")).select("scene_id", "ratio", "flipped", F.floor(F.lit(512) * F.col("ratio")).cast("int").alias("edge"))


@query("q62_output_profile", f"SELECT scene_id, CAST(width AS INTEGER) AS width, CAST(height AS INTEGER) AS height, CAST(coalesce(epsg, {c.EPSG}) AS INTEGER) AS epsg, 1::INTEGER AS bands, 'uint8' AS dtype, 512::INTEGER AS block, 255::INTEGER AS nodata FROM ({sql('georef')})")
def q62(spark: SparkSession, d: str) -> DataFrame:
    g = fixture(spark, d, "georef")
    g = g.withColumns({k: F.col(k).cast("int") for k in ("width", "height", "epsg")})
    return jobs.InferenceJob(RAMP).profile(g).drop("compress")


@query("q63_collected_bands", "SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber)::VARCHAR AS bands, CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem GROUP BY l_orderkey")
def q63(spark: SparkSession, d: str) -> DataFrame:
    rows = c.fixture_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("b"), F.sum("l_quantity").alias("total"))
    return rows.select("l_orderkey", F.concat(F.lit("["), F.array_join("b", ", "), F.lit("]")).alias("bands"), "total")


@query("q64_evaluation_json", "SELECT count(*) AS n_lines, true AS has_config")
def q64(spark: SparkSession, d: str) -> DataFrame:
    from terrawarp.sources.shared import folder

    per_class = evaluate.class_iou(c._matrix(spark, d), class_dim(spark))
    to = folder(spark)
    reports.write_evaluation(per_class, evaluate.mean_iou(per_class), "default", to)
    return spark.read.json(to).agg(F.count("*").alias("n_lines"), F.max(F.col("config") == "default").alias("has_config"))
