"""The training data set's random steps, as columns: every draw is a hash of seed, key and purpose, so that a rerun, or
a lost task, draws the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawarp.operators.stitch import dominant_share


def draw(seed: int, purpose: str, *keys: Column) -> Column:
    """A number from [0, 1) of 32 bits."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(purpose), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


def resize_target(width: Column, height: Column, u: Column, scale: int = 512, ratios: tuple[float, float] = (0.5, 2.0)) -> Column:
    """struct(edge, width, height): the size after a resize to a random share of the scale that keeps the aspect: both
    sides fit the edge."""
    edge = F.floor(F.lit(scale) * (F.lit(ratios[0]) + u * (ratios[1] - ratios[0]))).cast("int")
    factor = edge / F.greatest(width, height)
    side = lambda v: F.floor(v * factor + 0.5).cast("int")
    return F.struct(edge.alias("edge"), side(width).alias("width"), side(height).alias("height"))


def crop_tries(tiles: DataFrame, key: str, size: int, seed: int, tries: int = 10) -> DataFrame:
    """(key, attempt, y0, x0, y1, x1): the places that a random crop tries in turn, within tiles (width, height)."""
    rows = tiles.select(key, "width", "height", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))).alias("attempt"))
    at = lambda length, purpose: F.floor(draw(seed, purpose, F.col(key), F.col("attempt")) * F.greatest(F.col(length) - size + 1, F.lit(1))).cast("int")
    rows = rows.withColumns({"y0": at("height", "y"), "x0": at("width", "x")})
    return rows.select(key, "attempt", "y0", "x0", F.least(F.col("y0") + size, F.col("height")).cast("int").alias("y1"), F.least(F.col("x0") + size, F.col("width")).cast("int").alias("x1"))


def random_crop(tiles: DataFrame, labels: DataFrame, key: str, size: int, seed: int, most: float = 0.75, tries: int = 10) -> DataFrame:
    """(key, attempt, y0, x0, y1, x1): of each tile the first try in which no class holds `most` of the labelled pixels, else
    the last. labels: (key, y, x, cls). A tile's tries meet its own pixels: tries x tile size rows."""
    places = crop_tries(tiles, key, size, seed, tries)
    inside = (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1")) & (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1"))
    met = places.join(labels, key).where(inside)
    share = dominant_share(met, [key, "attempt"], "cls", most).select(key, "attempt", "keep")
    ranked = places.join(share, [key, "attempt"], "left")
    # a kept try comes before all others, an earlier one before a later one; without any the last try stands
    order = F.when(F.coalesce("keep", F.lit(False)), F.col("attempt")).otherwise(F.lit(2 * tries) - F.col("attempt"))
    return ranked.groupBy(key).agg(F.min_by(F.struct("attempt", "y0", "x0", "y1", "x1"), order).alias("c")).select(key, "c.*")


def photometric(bands: Column, seed: int, key: Column, brightness: float = 32.0, contrast: tuple[float, float] = (0.5, 1.5)) -> Column:
    """Bands after a random shift and a random gain, each with a chance of one half for a key, clipped to bytes."""
    pick = lambda purpose: draw(seed, purpose, key)
    shift = F.when(pick("shift?") < 0.5, (pick("shift") * 2 - 1) * brightness).otherwise(0.0)
    gain = F.when(pick("gain?") < 0.5, contrast[0] + pick("gain") * (contrast[1] - contrast[0])).otherwise(1.0)
    return F.transform(bands, lambda v: F.greatest(F.least(v.cast("double") * gain + shift, F.lit(255.0)), F.lit(0.0)))


def test_variants(tiles: DataFrame, ratios: tuple[float, ...] = (0.5, 0.75, 1.0, 1.25, 1.5, 1.75), flips: tuple[bool, ...] = (False, True)) -> DataFrame:
    """A row a tile, size ratio and flip, as a multi-scale test looks at it."""
    rows = tiles.withColumn("ratio", F.explode(F.array(*map(F.lit, ratios))))
    return rows.withColumn("flipped", F.explode(F.array(*map(F.lit, flips))))


def batches(tiles: DataFrame, order: str, size: int) -> DataFrame:
    """tiles with batch and slot, in order of a dense number 0, 1, 2, ... of the tiles (a shuffle's or a listing's)."""
    return tiles.withColumn("batch", F.floor(F.col(order) / size).cast("long")).withColumn("slot", (F.col(order) % size).cast("int"))
