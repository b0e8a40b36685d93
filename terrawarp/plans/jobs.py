"""The drivers: tiling a dataset, tiling for inference, and inference, each one lazy plan from validated options."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawarp.functions import georef, names, pixels
from terrawarp.operators import augment, blocks, evaluate, grid, overlay, pairing, splits, stitch
from terrawarp.schema import NODATA
from terrawarp.sources import images, vector
from terrawarp.sources.listing import exists, list_flat, list_pairs
from terrawarp.sources.rasters import SIDE, to_blocks, unpack, write_blocks


def merge_options(base: dict, changes: dict) -> dict:
    """Nested options with changes by dotted path, as {"data.train.root": ...}; "_delete_" drops what was there."""
    out = {k: merge_options(v, {}) if isinstance(v, dict) else v for k, v in base.items()}
    for path, value in changes.items():
        at, *rest = path.split(".", 1)
        if rest:
            out[at] = merge_options(out.get(at) if isinstance(out.get(at), dict) else {}, {rest[0]: value})
        elif isinstance(value, dict) and isinstance(out.get(at), dict) and not value.get("_delete_"):
            out[at] = merge_options(out[at], value)
        else:
            out[at] = {k: v for k, v in value.items() if k != "_delete_"} if isinstance(value, dict) else value
    return out


@dataclass
class TilingJob:
    """Tiles of image and annotation pairs; the split is spatial (ratio and direction), random (ratio) or by name."""

    roots: list[str]
    clip: int = 512
    stride: int = 256
    ratio: float | None = None
    direction: str | None = None
    seed: int = 42
    epsg: int = 3007
    val_tokens: tuple[str, ...] = field(default=names.VAL_TOKENS)

    def validate(self, spark: SparkSession) -> None:
        if self.direction is not None and self.ratio is None:
            raise ValueError("a direction needs a ratio")
        if self.direction is not None and self.direction not in splits.DIRECTIONS:
            raise ValueError(f"direction must be one of {splits.DIRECTIONS}")
        if self.ratio is not None and not 0 < self.ratio < 1:
            raise ValueError("the ratio must lie between 0 and 1")
        if self.clip < 1 or self.stride < 1:
            raise ValueError("clip and stride must be positive")
        for root in self.roots:
            if not exists(spark, root):
                raise FileNotFoundError(root)

    def tiles(self, listing: DataFrame, manifest: DataFrame) -> DataFrame:
        """One row a tile of each kind: key, split, place in the source raster, name, origin and reference system.
        manifest: (path, width, height, epsg, is_local, a..f) of each raster."""
        pairs = pairing.require_pairs(pairing.pair_files(listing)).withColumn("split", names.split_of(F.col("token"), self.val_tokens))
        if self.ratio is None:
            pairs = splits.filename_split(pairs)
        elif self.direction is None:
            keyed = pairs.drop("split").withColumn("_key", F.concat_ws("/", "tile_id", F.coalesce("token", F.lit(""))))
            pairs = splits.random_split(keyed, "_key", self.ratio, self.seed).drop("_key")
        image = manifest.select(F.col("path").alias("image_path"), "width", "height", "epsg", "is_local", *"abcdef")
        rows = pairs.join(image, "image_path")
        if self.direction is not None:
            rows = splits.spatial_split(rows.drop("split"), self.ratio, self.direction).drop("width", "height").withColumnsRenamed({"win_w": "width", "win_h": "height"})
        else:
            rows = rows.withColumns({"row_off": F.lit(0), "col_off": F.lit(0)})
        rows = rows.withColumn("kind", F.explode(F.array(F.lit("image"), F.lit("annotation"))))
        t = grid.tile_grid(rows, self.clip, splits.stride_of(F.col("split"), self.clip, self.stride))
        c, f = georef.window_origin(*[F.col(k) for k in "abcdef"], F.col("col_off"), F.col("row_off"))
        c, f = georef.tile_origin(F.col("a"), c, F.col("e"), f, F.col("x0"), F.col("y0"))
        path = F.when(F.col("kind") == "image", F.col("image_path")).otherwise(F.col("annotation_path"))
        return t.select("tile_id", "token", "kind", "split", path.alias("path"), (F.col("row_off") + F.col("y0")).alias("row"), (F.col("col_off") + F.col("x0")).alias("col"), (F.col("x1") - F.col("x0")).alias("w"), (F.col("y1") - F.col("y0")).alias("h"), names.tile_name(F.col("tile_id"), *[F.col(k) for k in ("x0", "y0", "x1", "y1")]).alias("name"), c.alias("c"), f.alias("f"), georef.tiling_epsg(F.col("epsg"), F.col("is_local"), self.epsg).alias("epsg"), "a", "e")

    def run(self, spark: SparkSession, manifest: DataFrame, out: str) -> DataFrame:
        """Writes the tile table by kind and split, and returns counts with totals."""
        self.validate(spark)
        self.tiles(list_pairs(spark, self.roots), manifest).write.partitionBy("kind", "split").parquet(out)
        return summary(spark.read.parquet(out))

    def write_pixels(self, tiles: DataFrame, rasters: DataFrame, out: str, fmt: str = "tif", side: int = SIDE) -> None:
        """The tiles with their pixels as image files' bytes, by kind and split. rasters: band blocks with the column
        path; png tiles carry no georeference."""
        scenes = tiles.select("path").distinct().withColumn("scene_id", F.xxhash64("path"))
        placed = tiles.join(scenes, "path").withColumn("_tile", F.concat_ws("/", "kind", "split", "path", "row", "col"))
        placed = placed.withColumns({"x0": F.col("col"), "y0": F.col("row"), "x1": F.col("col") + F.col("w"), "y1": F.col("row") + F.col("h")}).drop("w", "h")
        own = rasters.drop("scene_id").join(scenes, "path").drop("path")
        cut = blocks.cut_tiles(own, placed, "_tile", side)
        images.encoded(cut, fmt).drop("_tile", "scene_id", "data").write.partitionBy("kind", "split").parquet(out)


def summary(tiles: DataFrame) -> DataFrame:
    return tiles.rollup("kind", "split").agg(F.count("*").alias("n"))


def inference_tiles(spark: SparkSession, folder: str, manifest: DataFrame, clip: int) -> DataFrame:
    """Tiles of a flat folder, without splits: the stride is the clip size."""
    return tiles_of(list_flat(spark, folder), manifest, clip)


def tiles_of(listing: DataFrame, manifest: DataFrame, clip: int) -> DataFrame:
    rows = listing.join(manifest, "path").withColumn("prefix", names.prefix_of(F.col("name")))
    t = grid.tile_grid(rows, clip, clip)
    return t.select("path", "prefix", "x0", "y0", "x1", "y1", names.tile_name(F.col("prefix"), *[F.col(k) for k in ("x0", "y0", "x1", "y1")]).alias("tile"))


def inference_totals(listing: DataFrame, manifest: DataFrame, clip: int) -> DataFrame:
    """(prefix, n) of an inference tiling and its total in a row of null prefix, without making the tiles."""
    rows = listing.join(manifest, "path").select(names.prefix_of(F.col("name")).alias("prefix"), "width", "height")
    n = grid.tile_count(F.col("height").cast("int"), clip, clip).cast("long") * grid.tile_count(F.col("width").cast("int"), clip, clip)
    return rows.rollup("prefix").agg(F.sum(n).alias("n"))


@dataclass
class LabelJob:
    """Label rasters from vector layers: classes is a list of {file_path, class_value, draw_order}."""

    classes: list[dict]
    background: int = 1

    def validate(self, spark: SparkSession) -> None:
        for c in self.classes:
            if not exists(spark, c["file_path"]):
                raise FileNotFoundError(c["file_path"])
            if not 0 <= c["class_value"] <= 255:
                raise ValueError("class values are bytes")

    def labels(self, spark: SparkSession, raster: dict) -> tuple[DataFrame, DataFrame]:
        """(y, x, cls) of every pixel of a raster (width, height, a, c, e, f), and (layer, fault, n) of geometries that
        were dropped. Layers without a valid geometry draw nothing."""
        self.validate(spark)
        cells = dropped = None
        for pos, c in enumerate(self.classes):
            valid, faults = vector.clean(vector.read_layers(spark, [c["file_path"]]))
            rings = vector.to_rings(valid.select("geom_wkb"), raster["a"], raster["c"], raster["e"], raster["f"])
            drawn = overlay.polygon_cells(rings.withColumn("scene_id", F.lit(0).cast("long")), raster["width"], raster["height"], ["scene_id"])
            drawn = drawn.withColumns({"class_value": F.lit(c["class_value"]), "draw_order": F.lit(c["draw_order"]), "list_pos": F.lit(pos)})
            faults = faults.select(F.lit(c["file_path"]).alias("layer"), "fault", "n")
            cells, dropped = (drawn, faults) if cells is None else (cells.unionByName(drawn), dropped.unionByName(faults))
        one = spark.createDataFrame([(0, raster["width"], raster["height"])], "scene_id long, width int, height int")
        every = overlay.pixel_grid(one, "scene_id", F.col("width"), F.col("height"))
        if cells is None:
            return every.select("scene_id", "y", "x", F.lit(self.background).alias("cls")), spark.createDataFrame([], "layer string, fault string, n long")
        return overlay.overlay(every, cells, "scene_id", self.background), dropped

    def run(self, spark: SparkSession, raster: dict, out: str, side: int = SIDE) -> DataFrame:
        """Writes the label raster as blocks; returns what was dropped."""
        pixels_, dropped = self.labels(spark, raster)
        write_blocks(to_blocks(pixels_, ["cls"], side), out)
        return dropped


@dataclass
class EvaluationJob:
    """IoU of predicted class blocks against label blocks."""

    config: str = "default"

    def evaluate(self, truth: DataFrame, predicted: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Per class (cls, class, inter, union, iou) and the mean. Blocks meet by scene and place; pixels never shuffle."""
        per_class = evaluate.class_iou(blocks.block_confusion(truth, predicted), classes)
        return per_class, evaluate.mean_iou(per_class)


@dataclass
class TrainingPlan:
    """What a training run is made of: the tile tables of its splits, the order of its samples, and the rate of each
    step. Fitting the network itself is left to whoever brings one."""

    tiles: str
    steps: int = 150_000
    batch: int = 4
    seed: int = 42
    base_lr: float = 6e-5
    warmup: int = 1500
    warmup_ratio: float = 1e-6

    def validate(self, spark: SparkSession) -> None:
        if min(self.steps, self.batch) < 1 or not 0 <= self.warmup < self.steps:
            raise ValueError("steps and batch must be positive, and the warm-up below the steps")
        if not exists(spark, self.tiles):
            raise FileNotFoundError(self.tiles)

    def split(self, spark: SparkSession, split: str) -> DataFrame:
        """The image and label of each tile of a split, side by side; "test" means the validation tiles. The split is a
        partition filter."""
        rows = spark.read.parquet(self.tiles).where(F.col("split") == ("val" if split == "test" else split))
        return pairing.image_labels(rows)

    def epoch(self, spark: SparkSession, epoch: int) -> DataFrame:
        """The training tiles with batch and slot in the order of an epoch: a seeded shuffle, the same in each run."""
        rows = self.split(spark, "train").withColumn("_o", augment.draw(self.seed, f"epoch {epoch}", F.col("name"), F.col("path")))
        return augment.batches(splits.numbered(rows, "_o", "name", "path", "n"), "n", self.batch)

    def rates(self, spark: SparkSession) -> DataFrame:
        lr = pixels.poly_lr(F.col("id"), self.base_lr, self.steps, 1.0, 0.0, self.warmup, self.warmup_ratio)
        return spark.range(self.steps).select(F.col("id").alias("step"), lr.alias("lr"))


@dataclass
class InferenceJob:
    """Sliding-window inference with a registered scorer; overlaps are blended or cropped."""

    scorer: dict
    classes: int = 3
    window: int = 512
    stride: int = 384
    overlap: str = "blend"
    epsg: int = 3007

    def validate(self) -> None:
        if self.overlap not in ("blend", "crop"):
            raise ValueError("overlap must be blend or crop")
        if not 0 < self.stride <= self.window:
            raise ValueError("the stride must be positive and not above the window")

    def blocks(self, rasters: DataFrame, bands: DataFrame, side: int = SIDE) -> DataFrame:
        """Class blocks of rasters (scene_id, width, height) from their band blocks. The scorer sees whole windows."""
        self.validate()
        return blocks.infer_blocks(bands, rasters, self.scorer, self.classes, self.window, self.stride, self.overlap, side)

    def classify(self, rasters: DataFrame, cells: DataFrame, side: int = SIDE) -> DataFrame:
        """(scene_id, y, x, cls) of every pixel; 255 where the cells have none. cells: (scene_id, y, x, bands) pixel rows, of
        equally many bands; they are put into blocks, scored by window, and taken out again."""
        first = cells.select(F.size("bands").alias("n")).first()
        every = overlay.pixel_grid(rasters, "scene_id", F.col("width"), F.col("height"))
        if first is None:
            return every.withColumn("cls", F.lit(NODATA))
        names_ = [f"b{i}" for i in range(first.n)]
        own = to_blocks(cells.select("scene_id", "y", "x", *[F.get("bands", i).alias(n) for i, n in enumerate(names_)]), names_, side)
        found = unpack(self.blocks(rasters, own, side), side).withColumnRenamed("v", "cls")
        there = cells.select("scene_id", "y", "x")
        return stitch.fill_nodata(every, found.select("scene_id", "y", "x", "cls").join(there, ["scene_id", "y", "x"], "left_semi"), "scene_id", "cls")

    def profile(self, rasters: DataFrame) -> DataFrame:
        """The output's profile by raster (scene_id, width, height, epsg): one band of bytes in blocks, nodata 255."""
        self.validate()
        fixed = {"bands": F.lit(1), "dtype": F.lit("uint8"), "compress": F.lit("deflate"), "block": F.lit(SIDE), "nodata": F.lit(NODATA)}
        return rasters.select("scene_id", "width", "height", georef.inference_epsg(F.col("epsg"), self.epsg).alias("epsg")).withColumns(fixed)
