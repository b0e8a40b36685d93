"""The folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where that is unset, a folder beside the warehouse's tables, which driver and
    executors share too."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    return (found or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/terrawarp-scratch").rstrip("/")


def folder(spark: SparkSession) -> str:
    """The path of a new folder in the shared one."""
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"
