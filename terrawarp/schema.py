"""Row types of the engine and its class table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Class index, name and colour, as trained and as written by inference.
CLASSES = ((0, "bg", 255, 255, 255), (1, "water", 0, 0, 255), (2, "tree", 0, 255, 0))
#: What stands for "no label" in masks and for "no data" in outputs.
IGNORE = NODATA = 255

FILE_LISTING = "root_idx int, role_dir string, path string, name string"
MANIFEST = "scene_id string, width int, height int, bands int, dtype string, epsg int, is_local boolean, a double, b double, c double, d double, e double, f double"
CHUNK = "scene_id string, x0 int, y0 int, w int, h int, band int, data binary"
LABEL_PIXEL = "scene_id string, y int, x int, raw_cls int"


def class_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CLASSES), "cls int, name string, r int, g int, b int")
