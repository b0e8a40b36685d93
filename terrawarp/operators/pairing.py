"""Pairs of image and annotation files from a listing. One aggregation; null tokens are a key of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawarp.functions.names import parse_name, split_of


def parsed(listing: DataFrame) -> DataFrame:
    """Listing rows with tile_id, token and the name's role; all null where the name does not parse. The directory
    says a file's role; the name's is kept to report where both differ."""
    return listing.withColumn("_p", parse_name(F.col("name"))).select("*", "_p.tile_id", "_p.token", F.col("_p.role").alias("name_role")).drop("_p")


def _keys(listing: DataFrame) -> DataFrame:
    last = lambda role: F.max_by(F.when(F.col("role_dir") == role, F.col("path")), F.when(F.col("role_dir") == role, F.struct("root_idx", "path")))
    files = parsed(listing).where("tile_id IS NOT NULL")
    return files.groupBy("tile_id", "token").agg(last("image").alias("image_path"), last("annotation").alias("annotation_path"), F.count("*").alias("n_files"), F.count_if(F.col("role_dir") == "image").alias("n_images"), F.count_if(F.col("role_dir") == "annotation").alias("n_annotations"), F.count_if(F.col("role_dir") != F.col("name_role")).alias("n_mismatched"))


def pair_files(listing: DataFrame) -> DataFrame:
    """(tile_id, token, split, image_path, annotation_path) of keys that have both; of several files the one of the
    last root, then of the last path."""
    return _keys(listing).where("image_path IS NOT NULL AND annotation_path IS NOT NULL").select("tile_id", "token", split_of(F.col("token")).alias("split"), "image_path", "annotation_path")


def unpaired(listing: DataFrame) -> DataFrame:
    """Keys that lack a role, and which."""
    return _keys(listing).where("image_path IS NULL OR annotation_path IS NULL").select("tile_id", "token", F.when(F.col("image_path").isNull(), "image").otherwise("annotation").alias("missing_role"))


def rejected(listing: DataFrame) -> DataFrame:
    """Files whose names do not parse."""
    return parsed(listing).where("tile_id IS NULL").select(*listing.columns)


def collisions(listing: DataFrame) -> DataFrame:
    """Keys with more than one file of a role, or with files whose name and directory disagree."""
    return _keys(listing).where("n_images > 1 OR n_annotations > 1 OR n_mismatched > 0").select("tile_id", "token", "n_images", "n_annotations", "n_mismatched")


def require_pairs(pairs: DataFrame) -> DataFrame:
    if pairs.isEmpty():
        raise ValueError("no image and annotation pairs")
    return pairs


def image_labels(tiles: DataFrame, name: str = "name") -> DataFrame:
    """Image tiles with the path of the annotation tile of the same name and raster; images without one go. tiles: (kind,
    name, tile_id, token, path, ...) of one split. A name that stands several times meets the last path."""
    key = ["tile_id", "token", name]
    labels = tiles.where("kind = 'annotation'").groupBy(*key).agg(F.max("path").alias("label_path"))
    labels = labels.select(*[F.col(k).alias(f"_{k}") for k in key], "label_path")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    return tiles.where("kind = 'image'").join(labels, same).drop(*[f"_{k}" for k in key])
