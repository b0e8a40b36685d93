"""Counts and scores of predictions against labels. Pixels are counted where they lie; only class pairs are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawarp.schema import IGNORE


def confusion(pairs: DataFrame, gt: str = "gt", pred: str = "pred") -> DataFrame:
    """(gt, pred, n) of labelled pixels."""
    return pairs.where(F.col(gt) != IGNORE).groupBy(F.col(gt).alias("gt"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def class_iou(matrix: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, class, inter, union, iou) from a confusion matrix, for every class of the table (cls, name); iou is null
    where neither labels nor predictions have the class."""
    both = matrix.select(F.explode(F.array(F.struct(F.col("gt").alias("cls"), F.lit(1).alias("g"), F.lit(0).alias("p")), F.struct(F.col("pred").alias("cls"), F.lit(0).alias("g"), F.lit(1).alias("p")))).alias("s"), "n", (F.col("gt") == F.col("pred")).alias("same"))
    sums = both.groupBy("s.cls").agg(F.sum(F.col("n") * F.col("s.g")).alias("gt"), F.sum(F.col("n") * F.col("s.p")).alias("pr"), F.sum(F.when(F.col("same"), F.col("n") * F.col("s.g")).otherwise(0)).alias("inter"))
    out = classes.join(sums, "cls", "left").select("cls", F.col("name").alias("class"), F.coalesce("inter", F.lit(0)).cast("long").alias("inter"), F.coalesce(F.col("gt") + F.col("pr") - F.col("inter"), F.lit(0)).cast("long").alias("union"))
    return out.withColumn("iou", F.col("inter") / F.nullif(F.col("union"), F.lit(0)))


def mean_iou(per_class: DataFrame) -> DataFrame:
    return per_class.agg(F.avg("iou").alias("miou"))


def best_checkpoint(log: DataFrame, run: str, step: str, metric: str) -> DataFrame:
    """(run, step, metric) of each run's highest metric; of equal ones the earliest step."""
    best = log.where(F.col(metric).isNotNull()).groupBy(run).agg(F.max(F.struct(F.col(metric).alias("m"), (-F.col(step)).alias("s"))).alias("b"))
    return best.select(run, (-F.col("b.s")).alias(step), F.col("b.m").alias(metric))
