"""The query catalogue: each operator over whole tables, with the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawarp.functions import georef, names, pixels
from terrawarp.operators import evaluate, grid, overlay, pairing, score, splits, stitch
from terrawarp.plans.fixtures import PROBS, fixture, sql
from terrawarp.plans.fixtures import table as fixture_table  # noqa: F401
from terrawarp.schema import CLASSES, class_dim
from terrawarp.sources.shared import shared_dir
from terrawarp.streaming import blend

CLIP, STRIDE, WINDOW, STEP = 512, 256, 512, 384
EPSG = 3007
MEAN, STD = (123.675, 116.28, 103.53), (58.395, 57.12, 57.375)  # fixed values: channel means and deviations
LR = {"base": 6e-5, "total": 160_000, "power": 1.0, "least": 0.0, "warmup": 1500, "ratio": 1e-6}  # fixed values: rate schedule
SCORER = {"type": "linear", "weights": [[1.0, 0.5, 0.25], [0.25, 1.0, 0.5], [0.5, 0.25, 1.0]], "bias": [0.0, 0.125, 0.25]}
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLE[name] = oracle
        return f

    return add


def _tiles_sql(source: str, clip: int, stride: str) -> str:
    """Tile rows of a relation (width, height, ...), by the closed form."""
    return f"""(SELECT t.*, least(x0 + {clip}, width) AS x1, least(y0 + {clip}, height) AS y1 FROM (
      SELECT s.*, least(i * {stride}, greatest(height - {clip}, 0)) AS y0, least(j * {stride}, greatest(width - {clip}, 0)) AS x0 FROM (
        SELECT r.*, unnest(range(CASE WHEN width > {clip} THEN CAST(ceil((width - {clip}) / {stride}) AS BIGINT) + 1 ELSE 1 END)) AS j FROM (
          SELECT *, unnest(range(CASE WHEN height > {clip} THEN CAST(ceil((height - {clip}) / {stride}) AS BIGINT) + 1 ELSE 1 END)) AS i FROM {source}) r) s) t)"""


def _axis_sql(length: str, window: int, step: int, a: str, size: str) -> str:
    i = "j" if a == "x" else "i"
    half = (window - step) // 2
    last = f"({i} * {step} + {window} >= {length})"
    read = f"(CASE WHEN {last} THEN greatest({length} - {window}, 0) ELSE {i} * {step} END)"
    crop = f"(CASE WHEN {read} = 0 THEN 0 ELSE {half} END)"
    win = f"least({window}, {length})"
    return f"{read} AS read_{a}, {win} AS win_{size}, {crop} AS crop_{a}, CASE WHEN {last} OR {read} = 0 THEN {win} - {crop} ELSE {step} END AS crop_{size}, {read} + {crop} AS write_{a}"


def _windows_sql(source: str, window: int, step: int) -> str:
    n = lambda v: f"CASE WHEN {v} > {window} THEN CAST(ceil(({v} - {window}) / {step}) AS BIGINT) + 1 ELSE 1 END"
    return f"""(SELECT scene_id, width, height, {_axis_sql('width', window, step, 'x', 'w')}, {_axis_sql('height', window, step, 'y', 'h')} FROM (
      SELECT r.*, unnest(range({n('width')})) AS j FROM (SELECT *, unnest(range({n('height')})) AS i FROM {source}) r))"""


_INT = lambda cols: ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in cols.split())
_SCENES, _SMALL = f"({sql('scenes')})", f"({sql('small')})"
_WIN_COLS = "read_x read_y win_w win_h crop_x crop_y crop_w crop_h write_x write_y"


@query("q01_tile_counts", f"""SELECT scene_id, CAST(n_rows AS INTEGER) AS n_rows, CAST(n_cols AS INTEGER) AS n_cols, CAST(n_rows * n_cols AS BIGINT) AS n_tiles FROM (
  SELECT scene_id, CASE WHEN height > {CLIP} THEN ceil((height - {CLIP}) / {STRIDE}) + 1 ELSE 1 END AS n_rows,
         CASE WHEN width > {CLIP} THEN ceil((width - {CLIP}) / {STRIDE}) + 1 ELSE 1 END AS n_cols FROM {_SCENES})""")
def q01(spark: SparkSession, d: str) -> DataFrame:
    s = fixture(spark, d, "scenes").select("scene_id", grid.tile_count(F.col("height"), CLIP, STRIDE).alias("n_rows"), grid.tile_count(F.col("width"), CLIP, STRIDE).alias("n_cols"))
    return s.withColumn("n_tiles", F.col("n_rows").cast("long") * F.col("n_cols"))


@query("q02_tile_grid", f"""SELECT scene_id, {_INT('x0 y0 x1 y1')}, concat_ws('_', scene_id, x0, y0, x1, y1) || '.tif' AS name FROM {_tiles_sql(_SCENES, CLIP, str(STRIDE))}""")
def q02(spark: SparkSession, d: str) -> DataFrame:
    t = grid.tile_grid(fixture(spark, d, "scenes"), CLIP, STRIDE)
    return t.select("scene_id", "x0", "y0", "x1", "y1", names.tile_name(F.col("scene_id"), *[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("name"))


@query("q03_infer_grid", f"SELECT scene_id, {_INT(_WIN_COLS)} FROM {_windows_sql(_SCENES, WINDOW, STEP)}")
def q03(spark: SparkSession, d: str) -> DataFrame:
    return grid.inference_grid(fixture(spark, d, "scenes"), WINDOW, STEP).select("scene_id", *_WIN_COLS.split())


_STEM = "CASE WHEN strpos(substr(name, 2), '.') > 0 THEN regexp_replace(name, '\\.[^.]*$', '') ELSE name END"
_PARSE = """SELECT *, CASE WHEN len(p) >= 3 AND p[-1] IN ('image', 'annotation') THEN p[1] || '_' || p[2] END AS tile_id,
  CASE WHEN len(p) = 4 AND p[-1] IN ('image', 'annotation') THEN p[3] END AS token,
  CASE WHEN len(p) >= 3 AND p[-1] IN ('image', 'annotation') THEN p[-1] END AS role FROM (SELECT *, string_split(stem, '_') AS p FROM (SELECT *, %s AS stem FROM (%s)))"""


@query("q04_parse_filename", f"SELECT id, name, stem, CASE WHEN strpos(substr(name, 2), '.') > 0 THEN regexp_extract(name, '(\\.[^.]*)$', 1) ELSE '' END AS ext, tile_id, token, role, coalesce(tile_id, stem) AS prefix, stem || '_segmentation.tif' AS output FROM ({_PARSE % (_STEM, sql('names'))})")
def q04(spark: SparkSession, d: str) -> DataFrame:
    n, name = fixture(spark, d, "names"), F.col("name")
    p = names.parse_name(name)
    return n.select("id", "name", names.stem(name).alias("stem"), names.extension(name).alias("ext"), p["tile_id"].alias("tile_id"), p["token"].alias("token"), p["role"].alias("role"), names.prefix_of(name).alias("prefix"), names.output_name(name).alias("output"))


_KEYS = f"""(SELECT tile_id, token, arg_max(path, (root_idx, path)) FILTER (role_dir = 'image') AS image_path, arg_max(path, (root_idx, path)) FILTER (role_dir = 'annotation') AS annotation_path,
  count(*) FILTER (role_dir = 'image') AS n_images, count(*) FILTER (role_dir = 'annotation') AS n_annotations, count(*) FILTER (role_dir <> role) AS n_mismatched
  FROM ({_PARSE % (_STEM, sql('listing'))}) WHERE tile_id IS NOT NULL GROUP BY tile_id, token)"""
_SPLIT = "CASE WHEN token IS NULL THEN NULL WHEN lower(token) IN ('val', 'test') THEN 'val' ELSE 'train' END"
_PAIRS = f"(SELECT tile_id, token, {_SPLIT} AS split, image_path, annotation_path FROM {_KEYS} WHERE image_path IS NOT NULL AND annotation_path IS NOT NULL)"


@query("q05_pair_files", f"SELECT * FROM {_PAIRS}")
def q05(spark: SparkSession, d: str) -> DataFrame:
    return pairing.require_pairs(pairing.pair_files(fixture(spark, d, "listing")))


@query("q06_unpaired", f"SELECT tile_id, token, CASE WHEN image_path IS NULL THEN 'image' ELSE 'annotation' END AS missing_role FROM {_KEYS} WHERE image_path IS NULL OR annotation_path IS NULL")
def q06(spark: SparkSession, d: str) -> DataFrame:
    return pairing.unpaired(fixture(spark, d, "listing"))


@query("q06b_rejected_files", f"SELECT root_idx, role_dir, path, name FROM ({_PARSE % (_STEM, sql('listing'))}) WHERE tile_id IS NULL")
def q06b(spark: SparkSession, d: str) -> DataFrame:
    return pairing.rejected(fixture(spark, d, "listing"))


_CUT = lambda ratio: f"CAST(round_even((CASE WHEN dir IN ('ns', 'sn') THEN height ELSE width END) * {ratio}, 0) AS INTEGER)"
_SPATIAL = lambda src, ratio: f"""(SELECT *, CASE WHEN ns THEN 0 ELSE off END AS col_off, CASE WHEN ns THEN off ELSE 0 END AS row_off, CASE WHEN ns THEN width ELSE size END AS win_w, CASE WHEN ns THEN size ELSE height END AS win_h FROM (
  SELECT *, CASE WHEN (split = 'train') = (dir IN ('ns', 'we')) THEN 0 ELSE len - size END AS off FROM (
    SELECT *, CASE WHEN split = 'train' THEN cut ELSE len - cut END AS size FROM (
      SELECT *, dir IN ('ns', 'sn') AS ns, CASE WHEN dir IN ('ns', 'sn') THEN height ELSE width END AS len, {_CUT(ratio)} AS cut FROM (SELECT s.*, unnest(['train', 'val']) AS split FROM {src} s)))))"""  # noqa: E731
_DIRS = f"(SELECT *, unnest(['ns', 'sn', 'we', 'ew']) AS dir FROM {_SCENES})"


@query("q07_spatial_split", f"SELECT scene_id, dir, split, {_INT('col_off row_off win_w win_h')} FROM {_SPATIAL(_DIRS, 0.75424)}")
def q07(spark: SparkSession, d: str) -> DataFrame:
    s = fixture(spark, d, "scenes").withColumn("dir", F.explode(F.array(*map(F.lit, splits.DIRECTIONS))))
    return splits.spatial_split(s, 0.75424, F.col("dir")).select("scene_id", "dir", "split", "col_off", "row_off", "win_w", "win_h")


@query("q07b_spatial_tiles", f"""SELECT scene_id, split, CAST(row_off + y0 AS INTEGER) AS y, CAST(col_off + x0 AS INTEGER) AS x, concat_ws('_', scene_id, x0, y0, x1, y1) || '.tif' AS name
  FROM {_tiles_sql("(SELECT scene_id, split, col_off, row_off, win_w AS width, win_h AS height FROM " + _SPATIAL("(SELECT *, 'ns' AS dir FROM " + _SCENES + ")", 0.75424) + ")", CLIP, f"CASE WHEN split = 'train' THEN {STRIDE} ELSE {CLIP} END")}""")
def q07b(spark: SparkSession, d: str) -> DataFrame:
    s = splits.spatial_split(fixture(spark, d, "scenes"), 0.75424, "ns").select("scene_id", "split", "col_off", "row_off", F.col("win_w").alias("width"), F.col("win_h").alias("height"))
    t = grid.tile_grid(s, CLIP, splits.stride_of(F.col("split"), CLIP, STRIDE))
    return t.select("scene_id", "split", (F.col("row_off") + F.col("y0")).alias("y"), (F.col("col_off") + F.col("x0")).alias("x"), names.tile_name(F.col("scene_id"), *[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("name"))


@query("q08_random_split", f"SELECT scene_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || scene_id::VARCHAR), scene_id) <= floor(count(*) OVER () * 0.75424::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM {_SCENES}")
def q08(spark: SparkSession, d: str) -> DataFrame:
    return splits.random_split(fixture(spark, d, "scenes").select("scene_id"), "scene_id", 0.75424, 42)


@query("q09_random_split_seeded")
def q09(spark: SparkSession, d: str) -> DataFrame:
    return splits.random_split_seeded(fixture(spark, d, "scenes").select("scene_id"), "scene_id", 0.75424, 42)


@query("q10_filename_guard", f"SELECT count(*) AS n_pairs, count(*) FILTER (split IS NULL) AS n_unassigned, min(tile_id) FILTER (split IS NULL) AS first_id FROM {_PAIRS}")
def q10(spark: SparkSession, d: str) -> DataFrame:
    return pairing.pair_files(fixture(spark, d, "listing")).agg(F.count("*").alias("n_pairs"), F.count_if(F.col("split").isNull()).alias("n_unassigned"), F.min(F.when(F.col("split").isNull(), F.col("tile_id"))).alias("first_id"))


_PAIR_SCENES = f"(SELECT p.tile_id, p.token, p.split, s.width, s.height FROM {_PAIRS} p JOIN {_SCENES} s ON s.scene_id = CAST(split_part(p.tile_id, '_', 1) AS BIGINT))"
_KIND_TILES = _tiles_sql(f"(SELECT *, unnest(['image', 'annotation']) AS kind FROM {_PAIR_SCENES})", CLIP, f"CASE WHEN split = 'train' THEN {STRIDE} ELSE {CLIP} END")


def _pair_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Rasters of pairs by kind and split, with stride and n, their number of tiles in closed form."""
    p = pairing.pair_files(fixture(spark, d, "listing")).withColumn("scene_id", F.split("tile_id", "_")[0].cast("long"))
    s = p.join(fixture(spark, d, "scenes"), "scene_id").withColumn("kind", F.explode(F.array(F.lit("image"), F.lit("annotation"))))
    s = s.withColumn("stride", splits.stride_of(F.coalesce("split", F.lit("none")), CLIP, STRIDE))
    n = grid.tile_count(F.col("height").cast("int"), CLIP, F.col("stride")).cast("long") * grid.tile_count(F.col("width").cast("int"), CLIP, F.col("stride"))
    return s.select("kind", "split", "stride", n.alias("n"))


@query("q11_split_stride", f"SELECT kind, split, CAST(CASE WHEN split = 'train' THEN {STRIDE} ELSE {CLIP} END AS INTEGER) AS stride, count(*) AS n FROM {_KIND_TILES} GROUP BY ALL")
def q11(spark: SparkSession, d: str) -> DataFrame:
    return _pair_tiles(spark, d).groupBy("kind", "split", "stride").agg(F.sum("n").alias("n"))


@query("q12_tile_affine", f"SELECT scene_id, {_INT('x0 y0')}, c + a * x0 AS tc, f + e * y0 AS tf, b * y0 AS dc, d * x0 AS df FROM {_tiles_sql('(' + sql('georef') + ')', CLIP, str(STRIDE))}")
def q12(spark: SparkSession, d: str) -> DataFrame:
    t = grid.tile_grid(fixture(spark, d, "georef"), CLIP, STRIDE)
    g = {k: F.col(k).cast("double") for k in "abcdef"}
    tc, tf = georef.tile_origin(g["a"], g["c"], g["e"], g["f"], F.col("x0"), F.col("y0"))
    wc, wf = georef.window_origin(*[g[k] for k in "abcdef"], F.col("x0"), F.col("y0"))
    return t.select("scene_id", "x0", "y0", tc.alias("tc"), tf.alias("tf"), F.round(wc - tc, 6).alias("dc"), F.round(wf - tf, 6).alias("df"))


@query("q13_crs_fallback", f"SELECT scene_id, CAST(CASE WHEN epsg IS NOT NULL AND NOT is_local THEN epsg ELSE {EPSG} END AS INTEGER) AS epsg_tiling, CAST(coalesce(epsg, {EPSG}) AS INTEGER) AS epsg_infer FROM ({sql('georef')})")
def q13(spark: SparkSession, d: str) -> DataFrame:
    g = fixture(spark, d, "georef")
    return g.select("scene_id", georef.tiling_epsg(F.col("epsg"), F.col("is_local"), EPSG).cast("int").alias("epsg_tiling"), georef.inference_epsg(F.col("epsg"), EPSG).cast("int").alias("epsg_infer"))


@query("q14_georef_copy", f"SELECT p.tile_id, p.token, CAST(g.epsg AS INTEGER) AS epsg, CAST(g.a AS DOUBLE) AS a, CAST(g.c AS DOUBLE) AS c, CAST(g.e AS DOUBLE) AS e, CAST(g.f AS DOUBLE) AS f FROM {_PAIRS} p LEFT JOIN ({sql('georef')}) g ON g.scene_id = CAST(split_part(p.tile_id, '_', 1) AS BIGINT)")
def q14(spark: SparkSession, d: str) -> DataFrame:
    p = pairing.pair_files(fixture(spark, d, "listing")).withColumn("scene_id", F.split("tile_id", "_")[0].cast("long"))
    g = fixture(spark, d, "georef").select("scene_id", F.col("epsg").cast("int").alias("epsg"), *[F.col(k).cast("double").alias(k) for k in "acef"])
    return p.join(g, "scene_id", "left").select("tile_id", "token", "epsg", "a", "c", "e", "f")


SIDE = 64
_CELLS = f"""(SELECT scene_id, class_value, draw_order, list_pos, CAST(y AS INTEGER) AS y, unnest(range(CAST(greatest(floor(x0), 0) AS BIGINT), CAST(least(ceil(x1), {SIDE}) AS BIGINT))) AS x FROM (
  SELECT *, unnest(range(CAST(greatest(floor(y0), 0) AS BIGINT), CAST(least(ceil(y1), {SIDE}) AS BIGINT))) AS y FROM ({sql('boxes')}) WHERE x0 IS NOT NULL AND y0 IS NOT NULL AND x1 > x0 AND y1 > y0))"""
_GRID = f"(SELECT scene_id, y, unnest(range({SIDE})) AS x FROM (SELECT scene_id, unnest(range({SIDE})) AS y FROM (SELECT DISTINCT scene_id FROM ({sql('boxes')}))))"
_LABELS = f"""(SELECT g.scene_id, g.y, g.x, coalesce(c.cls, 1) AS cls FROM {_GRID} g LEFT JOIN (
  SELECT scene_id, y, x, arg_max(class_value, (draw_order, list_pos)) AS cls FROM {_CELLS} WHERE class_value <> 0 GROUP BY ALL) c USING (scene_id, y, x))"""


def _labels(spark: SparkSession, d: str) -> DataFrame:
    boxes = fixture(spark, d, "boxes")
    cells = overlay.box_cells(boxes, SIDE, SIDE)
    return overlay.overlay(overlay.pixel_grid(boxes.select("scene_id").distinct(), "scene_id", SIDE, SIDE), cells, "scene_id", 1)


@query("q15_label_overlay", f"SELECT scene_id, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, CAST(cls AS INTEGER) AS cls FROM {_LABELS}")
def q15(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d)


_CLASS_VALUES = ", ".join(f"({c}, '{n}', {r}, {g}, {b})" for c, n, r, g, b in CLASSES)


@query("q16_class_values", f"SELECT CAST(l.cls AS INTEGER) AS cls, c.name, c.r::INTEGER AS r, c.g::INTEGER AS g, c.b::INTEGER AS b, count(*) AS n_pixels FROM {_LABELS} l LEFT JOIN (VALUES {_CLASS_VALUES}) c(cls, name, r, g, b) ON c.cls = l.cls - 1 GROUP BY ALL")
def q16(spark: SparkSession, d: str) -> DataFrame:
    counts = _labels(spark, d).groupBy("cls").agg(F.count("*").alias("n_pixels"))
    dim = class_dim(spark).withColumn("cls", F.col("cls") + 1)
    return counts.join(F.broadcast(dim), "cls", "left").select("cls", "name", "r", "g", "b", "n_pixels")


@query("q17_geometry_clean", f"SELECT class_value, count(*) AS n_before, count(*) FILTER (x0 IS NOT NULL) AS n_not_null, count(*) FILTER (x0 IS NOT NULL AND y0 IS NOT NULL AND x1 > x0 AND y1 > y0) AS n_after FROM ({sql('boxes')}) GROUP BY class_value")
def q17(spark: SparkSession, d: str) -> DataFrame:
    b = fixture(spark, d, "boxes")
    ok = overlay.valid_box(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])
    return b.groupBy("class_value").agg(F.count("*").alias("n_before"), F.count("x0").alias("n_not_null"), F.count_if(ok).alias("n_after"))


_REDUCED = "CASE WHEN raw IN (0, 255) THEN 255 ELSE raw - 1 END"


@query("q18_reduce_zero_label", f"SELECT CAST(raw AS INTEGER) AS raw, CAST({_REDUCED} AS INTEGER) AS reduced, count(*) AS n FROM ({sql('pairs25')}) GROUP BY ALL")
def q18(spark: SparkSession, d: str) -> DataFrame:
    p = fixture(spark, d, "pairs25").select(F.col("raw").cast("int").alias("raw"))
    return p.groupBy("raw", pixels.reduce_zero_label(F.col("raw")).alias("reduced")).agg(F.count("*").alias("n"))


_SOFT = """(SELECT vec_id, label, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2 FROM (
  SELECT *, exp(z0 - m) AS e0, exp(z1 - m) AS e1, exp(z2 - m) AS e2 FROM (SELECT *, greatest(z0, z1, z2) AS m FROM (
    SELECT vec_id, label, embedding[1]::DOUBLE AS z0, embedding[2]::DOUBLE AS z1, embedding[3]::DOUBLE AS z2 FROM embeddings))))"""


def _soft(spark: SparkSession, d: str) -> DataFrame:
    e = fixture(spark, d, "logits")
    return e.select("vec_id", "label", pixels.softmax(F.slice("embedding", 1, 3)).alias("p"))


@query("q19_softmax_probs", f"SELECT vec_id, round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2 FROM {_SOFT}")
def q19(spark: SparkSession, d: str) -> DataFrame:
    return _soft(spark, d).select("vec_id", *[F.round(F.get("p", i), 6).alias(f"p{i}") for i in range(3)])


@query("q20_argmax_class", f"SELECT vec_id, CAST(CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS INTEGER) AS cls FROM {_SOFT}")
def q20(spark: SparkSession, d: str) -> DataFrame:
    return _soft(spark, d).select("vec_id", pixels.argmax(F.col("p")).alias("cls"))


SMALL_WINDOW, SMALL_STEP = 8, 5
_PIX = f"""(SELECT *, {', '.join(f'{p} AS p{i}' for i, p in enumerate(PROBS))} FROM (SELECT w.*, unnest(range(read_x, read_x + win_w)) AS x FROM (
  SELECT *, unnest(range(read_y, read_y + win_h)) AS y FROM {_windows_sql(_SMALL, SMALL_WINDOW, SMALL_STEP)}) w))"""
_ARG = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END"


def _window_probs(spark: SparkSession, d: str) -> DataFrame:
    w = grid.inference_grid(fixture(spark, d, "small"), SMALL_WINDOW, SMALL_STEP)
    return stitch.window_pixels(w).withColumns({f"p{i}": F.expr(p) for i, p in enumerate(PROBS)})


@query("q21_blend_overlap", f"SELECT scene_id, {_INT('y x')}, n, p0, p1, p2, CAST({_ARG} AS INTEGER) AS cls FROM (SELECT scene_id, y, x, count(*) AS n, avg(p0) AS p0, avg(p1) AS p1, avg(p2) AS p2 FROM {_PIX} GROUP BY scene_id, y, x)")
def q21(spark: SparkSession, d: str) -> DataFrame:
    return stitch.blend(_window_probs(spark, d), "scene_id", ["p0", "p1", "p2"])


_CROP = f"(SELECT scene_id, y, x, arg_max({_ARG}, (read_y, read_x)) AS cls FROM {_PIX} WHERE x >= write_x AND x < write_x + crop_w AND y >= write_y AND y < write_y + crop_h@ GROUP BY scene_id, y, x)"


@query("q22_crop_overlap", f"SELECT scene_id, {_INT('y x cls')} FROM {_CROP.replace('@', '')}")
def q22(spark: SparkSession, d: str) -> DataFrame:
    p = _window_probs(spark, d).withColumn("cls", pixels.argmax(F.array("p0", "p1", "p2")))
    return stitch.crop(p, "scene_id", "cls")


@query("q23_nodata_fill", f"""SELECT cls, count(*) AS n FROM (SELECT CAST(coalesce(c.cls, 255) AS INTEGER) AS cls FROM (
  SELECT scene_id, y, unnest(range(width)) AS x FROM (SELECT *, unnest(range(height)) AS y FROM {_SMALL})) g LEFT JOIN {_CROP.replace('@', ' AND (read_x + read_y + scene_id) % 4 <> 0')} c USING (scene_id, y, x)) GROUP BY cls""")
def q23(spark: SparkSession, d: str) -> DataFrame:
    p = _window_probs(spark, d).where((F.col("read_x") + F.col("read_y") + F.col("scene_id")) % 4 != 0).withColumn("cls", pixels.argmax(F.array("p0", "p1", "p2")))
    every = overlay.pixel_grid(fixture(spark, d, "small"), "scene_id", F.col("width"), F.col("height"))
    return stitch.fill_nodata(every, stitch.crop(p, "scene_id", "cls"), "scene_id", "cls").groupBy("cls").agg(F.count("*").alias("n"))


_COVER = lambda v: f"""(SELECT scene_id, cover, sum(n) AS n FROM (SELECT scene_id, sum(dd) OVER w AS cover, lead(pos) OVER w - pos AS n FROM (
  SELECT scene_id, pos, sum(dd) AS dd FROM (SELECT scene_id, unnest([s, least(s + {WINDOW}, {v})]) AS pos, unnest([1, -1]) AS dd FROM (
    SELECT scene_id, {v}, CASE WHEN i * {STEP} + {WINDOW} >= {v} THEN greatest({v} - {WINDOW}, 0) ELSE i * {STEP} END AS s FROM (
      SELECT *, unnest(range(CASE WHEN {v} > {WINDOW} THEN CAST(ceil(({v} - {WINDOW}) / {STEP}) AS BIGINT) + 1 ELSE 1 END)) AS i FROM {_SCENES}))) GROUP BY scene_id, pos) WINDOW w AS (PARTITION BY scene_id ORDER BY pos)) WHERE n > 0 GROUP BY scene_id, cover)"""  # noqa: E731


@query("q24_overlap_histogram", f"SELECT CAST(a.cover * b.cover AS BIGINT) AS cover, CAST(sum(a.n * b.n) AS BIGINT) AS n FROM {_COVER('width')} a JOIN {_COVER('height')} b USING (scene_id) GROUP BY 1")
def q24(spark: SparkSession, d: str) -> DataFrame:
    s = fixture(spark, d, "scenes")
    x, y = grid.coverage_runs(s, "width", WINDOW, STEP, "scene_id"), grid.coverage_runs(s, "height", WINDOW, STEP, "scene_id")
    both = x.select("scene_id", F.col("cover").alias("cx"), F.col("n").alias("nx")).join(y.select("scene_id", F.col("cover").alias("cy"), F.col("n").alias("ny")), "scene_id")
    return both.groupBy((F.col("cx") * F.col("cy")).cast("long").alias("cover")).agg(F.sum(F.col("nx") * F.col("ny")).cast("long").alias("n"))


_GT = f"(SELECT {_REDUCED} AS gt, pred FROM ({sql('pairs25')}))"
_IOU = f"""(SELECT c.cls, c.name AS class, count(*) FILTER (gt = c.cls AND pred = c.cls) AS inter, count(*) FILTER (gt = c.cls OR pred = c.cls) AS uni
  FROM (VALUES {_CLASS_VALUES}) c(cls, name, r, g, b) CROSS JOIN {_GT} x WHERE gt <> 255 GROUP BY c.cls, c.name)"""


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    p = fixture(spark, d, "pairs25")
    return evaluate.confusion(p.select(pixels.reduce_zero_label(F.col("raw")).alias("gt"), F.col("pred").cast("int").alias("pred")))


@query("q25_class_iou", f"SELECT class, inter, uni AS \"union\", inter / nullif(uni, 0) AS iou FROM {_IOU}")
def q25(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.class_iou(_matrix(spark, d), class_dim(spark)).select("class", "inter", "union", "iou")


@query("q26_mean_iou", f"SELECT round(avg(inter / nullif(uni, 0)), 9) AS miou FROM {_IOU}")
def q26(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.mean_iou(evaluate.class_iou(_matrix(spark, d), class_dim(spark))).select(F.round("miou", 9).alias("miou"))


@query("q27_confusion_matrix", f"SELECT CAST(gt AS INTEGER) AS gt, CAST(pred AS INTEGER) AS pred, count(*) AS n FROM {_GT} WHERE gt <> 255 GROUP BY ALL")
def q27(spark: SparkSession, d: str) -> DataFrame:
    return _matrix(spark, d)


@query("q28_summary_counts", f"SELECT kind, split, CAST(grouping(kind) + grouping(split) AS INTEGER) AS level, count(*) AS n FROM {_KIND_TILES} GROUP BY ROLLUP (kind, split)")
def q28(spark: SparkSession, d: str) -> DataFrame:
    t = _pair_tiles(spark, d)
    return t.rollup("kind", "split").agg((F.grouping("kind") + F.grouping("split")).cast("int").alias("level"), F.sum("n").alias("n"))


@query("q29_band_select", "SELECT vec_id, embedding[4]::DOUBLE AS b0, embedding[2]::DOUBLE AS b1, embedding[1]::DOUBLE AS b2 FROM embeddings")
def q29(spark: SparkSession, d: str) -> DataFrame:
    picked = pixels.channel_order(pixels.select_bands(F.col("embedding"), pixels.parse_bands("1,2,4", 64)))
    return fixture(spark, d, "logits").select("vec_id", *[F.get(picked, i).cast("double").alias(f"b{i}") for i in range(3)])


@query("q30_normalize_bands", "SELECT vec_id, " + ", ".join(f"round((floor(abs(embedding[{i + 1}]::DOUBLE) * 256) - {m}) / {s}, 6) AS n{i}" for i, (m, s) in enumerate(zip(MEAN, STD, strict=True))) + " FROM embeddings")
def q30(spark: SparkSession, d: str) -> DataFrame:
    bands = F.transform(F.slice("embedding", 1, 3), lambda v: F.floor(F.abs(v.cast("double")) * 256))
    n = pixels.normalize(bands, list(MEAN), list(STD))
    return fixture(spark, d, "logits").select("vec_id", *[F.round(F.get(n, i), 6).alias(f"n{i}") for i in range(3)])


_SMALL_PIX = f"(SELECT scene_id, width, height, y, unnest(range(width)) AS x FROM (SELECT *, unnest(range(height)) AS y FROM {_SMALL}))"


def _small_pixels(spark: SparkSession, d: str) -> DataFrame:
    s = fixture(spark, d, "small")
    return overlay.pixel_grid(s, "scene_id", F.col("width"), F.col("height")).join(s, "scene_id")


@query("q31_pad_tile", f"""SELECT g.scene_id, {_INT('y x')}, CAST(coalesce((p.x * 3 + p.y) % 200, 0) AS BIGINT) AS img, CAST(coalesce((p.x + p.y) % 4, 255) AS BIGINT) AS gt FROM (
  SELECT scene_id, y, unnest(range(24)) AS x FROM (SELECT scene_id, unnest(range(24)) AS y FROM {_SMALL})) g LEFT JOIN {_SMALL_PIX} p USING (scene_id, y, x)""")
def q31(spark: SparkSession, d: str) -> DataFrame:
    s = fixture(spark, d, "small")
    p = overlay.pixel_grid(s, "scene_id", F.col("width"), F.col("height")).withColumn("img", ((F.col("x") * 3 + F.col("y")) % 200).cast("long")).withColumn("gt", ((F.col("x") + F.col("y")) % 4).cast("long"))
    return stitch.pad(overlay.pixel_grid(s, "scene_id", 24, 24), p, "scene_id", "img", "gt")


@query("q32_flip", f"SELECT scene_id, CAST(y AS INTEGER) AS y, CAST(CASE WHEN scene_id % 2 = 0 THEN {SIDE} - 1 - x ELSE x END AS INTEGER) AS x, CAST(cls AS INTEGER) AS cls FROM {_LABELS}")
def q32(spark: SparkSession, d: str) -> DataFrame:
    return stitch.flip(_labels(spark, d), F.lit(SIDE), F.lit(SIDE), F.col("scene_id") % 2 == 0)


@query("q33_cat_max_ratio", f"""SELECT scene_id, CAST(floor(y / 16) AS BIGINT) AS by, CAST(floor(x / 16) AS BIGINT) AS bx, max(n) / sum(n) AS max_share, max(n) / sum(n) < 0.75 AS keep FROM (
  SELECT scene_id, floor(y / 16) * 16 AS y, floor(x / 16) * 16 AS x, cls, count(*) AS n FROM {_LABELS} GROUP BY ALL) GROUP BY scene_id, y, x""")
def q33(spark: SparkSession, d: str) -> DataFrame:
    p = _labels(spark, d).withColumn("by", F.floor(F.col("y") / 16)).withColumn("bx", F.floor(F.col("x") / 16))
    return stitch.dominant_share(p, ["scene_id", "by", "bx"], "cls", 0.75)


@query("q34_tta_mean", f"""SELECT scene_id, {_INT('y x')}, avg(v) AS mean FROM (SELECT scene_id, y, CASE WHEN fl THEN width - 1 - x ELSE x END AS x, ((x * 7 + y * 3 + scene_id) % 32 + k) / 64.0::DOUBLE AS v FROM (
  SELECT *, unnest([true, false]) AS fl FROM (SELECT *, unnest(range(6)) AS k FROM {_SMALL_PIX}))) GROUP BY scene_id, y, x""")
def q34(spark: SparkSession, d: str) -> DataFrame:
    p = _small_pixels(spark, d).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(5)))).withColumn("fl", F.explode(F.array(F.lit(True), F.lit(False))))
    p = p.withColumn("v", ((F.col("x") * 7 + F.col("y") * 3 + F.col("scene_id")) % 32 + F.col("k")) / 64.0)
    return stitch.flip(p, F.col("width"), F.col("height"), F.col("fl")).groupBy("scene_id", "y", "x").agg(F.avg("v").alias("mean"))


_LERP = lambda v: f"least(greatest(({v} + 0.5) * 0.5 - 0.5, 0), 7)"


@query("q35_bilinear_resize", f"""SELECT scene_id, CAST(oy AS INTEGER) AS y, CAST(ox AS INTEGER) AS x, round((1 - fy) * ((1 - fx) * v(ly, lx) + fx * v(ly, hx)) + fy * ((1 - fx) * v(hy, lx) + fx * v(hy, hx)), 6) AS v FROM (
  SELECT *, sy - ly AS fy, sx - lx AS fx, least(ly + 1, 7) AS hy, least(lx + 1, 7) AS hx FROM (SELECT *, floor(sy) AS ly, floor(sx) AS lx FROM (
    SELECT *, {_LERP('oy')} AS sy, {_LERP('ox')} AS sx FROM (SELECT scene_id, oy, unnest(range(16)) AS ox FROM (SELECT scene_id, unnest(range(16)) AS oy FROM {_SMALL})))))""".replace("v(ly, lx)", "((ly * 5 + lx * 3 + scene_id) % 17)").replace("v(ly, hx)", "((ly * 5 + hx * 3 + scene_id) % 17)").replace("v(hy, lx)", "((hy * 5 + lx * 3 + scene_id) % 17)").replace("v(hy, hx)", "((hy * 5 + hx * 3 + scene_id) % 17)"))
def q35(spark: SparkSession, d: str) -> DataFrame:
    p = overlay.pixel_grid(fixture(spark, d, "small"), "scene_id", 8, 8).withColumn("v", ((F.col("y") * 5 + F.col("x") * 3 + F.col("scene_id")) % 17).cast("double"))
    return stitch.bilinear(p, "scene_id", "v", (8, 8), (16, 16)).withColumn("v", F.round("v", 6))


@query("q36_best_checkpoint", f"SELECT run, step, metric FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY metric DESC, step) AS k FROM ({sql('log')}) WHERE metric IS NOT NULL) WHERE k = 1")
def q36(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.best_checkpoint(fixture(spark, d, "log"), "run", "step", "metric")


@query("q37_lr_schedule", f"""SELECT step, round((CASE WHEN step < {LR['warmup']} THEN rate * (1 - (1 - step / {LR['warmup']}) * (1 - {LR['ratio']})) ELSE rate END) * 1e6, 6) AS lr_e6 FROM (
  SELECT o_orderkey AS step, {LR['base']}::DOUBLE * (1 - o_orderkey / {LR['total']}) AS rate FROM orders)""")
def q37(spark: SparkSession, d: str) -> DataFrame:
    s = fixture(spark, d, "scenes").select(F.col("scene_id").alias("step"))
    return s.select("step", F.round(pixels.poly_lr(F.col("step"), **LR) * 1e6, 6).alias("lr_e6"))


@query("q38_cross_entropy", f"SELECT round(avg(-ln(CASE ((label % 3) + 3) % 3 WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END)), 6) AS loss FROM {_SOFT}")
def q38(spark: SparkSession, d: str) -> DataFrame:
    return _soft(spark, d).agg(F.round(F.avg(pixels.cross_entropy(F.col("p"), F.pmod(F.col("label"), F.lit(3)).cast("int"))), 6).alias("loss"))


@query("q39_buffer_memory", f"SELECT scene_id, CAST((3 * {WINDOW + 1} * 4 + {WINDOW + 1}) * width AS BIGINT) AS bytes, ({WINDOW} - {STEP}) / {WINDOW} * 100.0::DOUBLE AS overlap FROM {_SCENES}")
def q39(spark: SparkSession, d: str) -> DataFrame:
    s = fixture(spark, d, "scenes")
    return s.select("scene_id", pixels.buffer_bytes(F.col("width"), WINDOW, 3).alias("bytes"), pixels.overlap_percent(F.lit(WINDOW), F.lit(STEP)).alias("overlap"))


_STREAM = f"(SELECT scene_id, 16 AS width, 16 AS height FROM {_SMALL})"


@query("q40_stream_blend", f"SELECT scene_id, {_INT('y x')}, n, p0, p1, p2, CAST({_ARG} AS INTEGER) AS cls FROM (SELECT scene_id, y, x, count(*) AS n, avg(p0) AS p0, avg(p1) AS p1, avg(p2) AS p2 FROM {_PIX.replace(_windows_sql(_SMALL, SMALL_WINDOW, SMALL_STEP), _windows_sql(_STREAM, SMALL_WINDOW, SMALL_STEP))} GROUP BY scene_id, y, x)")
def q40(spark: SparkSession, d: str) -> DataFrame:
    s = fixture(spark, d, "small").select("scene_id", F.lit(16).alias("width"), F.lit(16).alias("height"))
    p = stitch.window_pixels(grid.inference_grid(s, SMALL_WINDOW, SMALL_STEP)).withColumns({f"p{i}": F.expr(e) for i, e in enumerate(PROBS)})
    at = f"{shared_dir(spark).rstrip('/')}/blend-{uuid.uuid4().hex}"
    blend.write_grid_rows(p, f"{at}/in")
    return blend.run_blend(spark, f"{at}/in", f"{at}/out", SMALL_WINDOW)


@query("q41_scorer", "SELECT vec_id, " + ", ".join(f"round({' + '.join(f'{w} * embedding[{k + 1}]::DOUBLE' for k, w in enumerate(row))} + {b}, 6) AS z{i}" for i, (row, b) in enumerate(zip(SCORER["weights"], SCORER["bias"], strict=True))) + " FROM embeddings")
def q41(spark: SparkSession, d: str) -> DataFrame:
    e = fixture(spark, d, "logits").select("vec_id", F.slice("embedding", 1, 3).cast("array<double>").alias("bands"))
    return score.score(e, "vec_id", "bands", SCORER).select("vec_id", *[F.round(F.get("logits", i), 6).alias(f"z{i}") for i in range(3)])


@query("q42_collision_report", f"SELECT tile_id, token, n_images, n_annotations, n_mismatched FROM {_KEYS} WHERE n_images > 1 OR n_annotations > 1 OR n_mismatched > 0")
def q42(spark: SparkSession, d: str) -> DataFrame:
    return pairing.collisions(fixture(spark, d, "listing"))
