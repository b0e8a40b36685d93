"""File lists, by the store's own interface, so that any path Spark reads can be listed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrawarp.schema import FILE_LISTING

ROLE_DIRS = ("image", "annotation")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Paths of files in a folder, sorted; hidden are those that begin with a dot (Spark also hides underscores)."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    found = [s.getPath() for s in fs.listStatus(p) if s.isFile()]
    return sorted(str(x.toString()) for x in found if x.getName().lower().endswith(suffix) and not x.getName().startswith("."))


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def require_files(spark: SparkSession, paths: list[str]) -> None:
    """Raises FileNotFoundError for the first path that is not there."""
    for path in paths:
        if not exists(spark, path):
            raise FileNotFoundError(path)


def list_pairs(spark: SparkSession, roots: list[str], suffix: str = ".tif") -> DataFrame:
    """Listing of image and annotation folders below each root; folders that are missing are skipped."""
    rows = [(i, role, path, path.rsplit("/", 1)[-1]) for i, root in enumerate(roots) for role in ROLE_DIRS for path in _names(spark, f"{root.rstrip('/')}/{role}", suffix)]
    return spark.createDataFrame(rows, FILE_LISTING)


def list_flat(spark: SparkSession, folder: str, suffix: str = ".tif") -> DataFrame:
    """Listing of a folder without roles, for inference."""
    return spark.createDataFrame([(0, "image", path, path.rsplit("/", 1)[-1]) for path in _names(spark, folder, suffix)], FILE_LISTING)


def inference_inputs(spark: SparkSession, path: str) -> list[str]:
    """What an inference path stands for: a .vrt by its suffix, a .tif file, or the .tif files of a folder."""
    if path.lower().endswith(".vrt"):
        return [path]
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    if fs.getFileStatus(p).isFile():
        if not path.lower().endswith(".tif"):
            raise ValueError(f"neither a raster nor a folder: {path}")
        return [path]
    found = _names(spark, path, ".tif")
    if not found:
        raise ValueError(f"no rasters in {path}")
    return found
