"""Band, label and probability functions. Columns only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_bands(text: str | None, count: int) -> list[int]:
    """1-based band numbers of "all", None or a comma list; raises ValueError for numbers that are not there."""
    if text is None or text.strip().lower() == "all":
        return list(range(1, count + 1))
    found = [int(x) for x in text.split(",")]
    if not found or any(b < 1 or b > count for b in found):
        raise ValueError(f"bands must lie in 1..{count}: {text}")
    return found


def select_bands(bands: Column, numbers: list[int]) -> Column:
    return F.array(*[F.get(bands, n - 1) for n in numbers])


def channel_order(bands: Column) -> Column:
    """The first three bands reversed; fewer bands as they are."""
    return F.when(F.size(bands) >= 3, F.reverse(F.slice(bands, 1, 3))).otherwise(bands)


def to_uint8(value: Column) -> Column:
    return F.pmod(value.cast("long"), F.lit(256)).cast("int")


def reduce_zero_label(value: Column) -> Column:
    """0 and 255 become 255, all else one less."""
    return F.when(value.isin(0, 255), 255).otherwise(value - 1).cast("int")


def normalize(bands: Column, mean: list[float], std: list[float]) -> Column:
    of = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    return F.zip_with(F.zip_with(bands, of(mean), lambda v, m: v.cast("double") - m), of(std), lambda v, s: v / s)


def softmax(logits: Column) -> Column:
    z = F.transform(logits, lambda v: F.exp(v.cast("double") - F.array_max(logits).cast("double")))
    return F.transform(z, lambda v: v / F.aggregate(z, F.lit(0.0), lambda s, x: s + x))


def argmax(values: Column) -> Column:
    """Index of the greatest value, the first of equal ones."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def cross_entropy(probs: Column, truth: Column) -> Column:
    return -F.log(F.get(probs, truth))


def overlap_percent(window: Column, stride: Column) -> Column:
    return F.when(window > 0, (window - stride) / window * 100.0).otherwise(F.lit(0.0))


def buffer_bytes(width: Column, window: int, classes: int) -> Column:
    """Bytes of the rolling blend buffer: float sums for window + 1 rows and one byte of counts each."""
    return (F.lit(classes * (window + 1) * 4) * width + F.lit(window + 1) * width).cast("long")


def poly_lr(step: Column, base: float, total: int, power: float, least: float, warmup: int, ratio: float) -> Column:
    """Polynomial decay by step, with linear warm-up from ratio x rate (the usual public formula)."""
    rate = (F.lit(base) - least) * F.pow(1.0 - step / F.lit(float(total)), F.lit(power)) + least
    return F.when(step < warmup, rate * (1.0 - (1.0 - step / F.lit(float(warmup))) * (1.0 - ratio))).otherwise(rate)
