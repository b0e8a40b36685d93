"""Scorers: named functions from a window's bands to class logits, for DataFrames of windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

SCORERS: dict[str, Callable[..., Callable[[np.ndarray], np.ndarray]]] = {}


def register(name: str):
    """Registers a factory: options -> (rows, bands) -> (rows, classes)."""

    def add(make):
        if name in SCORERS:
            raise ValueError(f"a scorer named {name} is registered")
        SCORERS[name] = make
        return make

    return add


def build(config: dict) -> Callable[[np.ndarray], np.ndarray]:
    """A scorer from {"type": name, **options}."""
    options = dict(config)
    name = options.pop("type")
    if name not in SCORERS:
        raise ValueError(f"no scorer named {name}; there are {sorted(SCORERS)}")
    return SCORERS[name](**options)


@register("linear")
def linear(weights: list[list[float]], bias: list[float]):
    w, b = np.asarray(weights, dtype=float), np.asarray(bias, dtype=float)
    return lambda bands: bands @ w.T + b


def score(windows: DataFrame, key: str, bands: str, config: dict) -> DataFrame:
    """(key, logits array<double>) by the configured scorer, over Arrow batches; null bands give null."""
    kind = windows.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = build(config)
        for frame in frames:
            some = frame[bands].notna().to_numpy()
            out: list = [None] * len(frame)
            if some.any():
                logits = f(np.stack(frame.loc[some, bands].to_list()).astype(float))
                for i, z in zip(np.flatnonzero(some).tolist(), logits, strict=True):
                    out[i] = z
            yield pd.DataFrame({key: frame[key], "logits": out})

    return windows.select(key, bands).mapInPandas(run, f"{key} {kind}, logits array<double>")


WINDOW_SCORERS: dict[str, Callable[..., Callable[[np.ndarray], np.ndarray]]] = {}


def register_window(name: str):
    """Registers a factory: options -> (bands, height, width) -> (classes, height, width)."""

    def add(make):
        if name in WINDOW_SCORERS:
            raise ValueError(f"a window scorer named {name} is registered")
        WINDOW_SCORERS[name] = make
        return make

    return add


def window_scorer(config: dict) -> Callable[[np.ndarray], np.ndarray]:
    """The scorer of whole windows from {"type": name, **options}; a scorer of pixels scores each pixel."""
    options = dict(config)
    name = options.pop("type")
    if name in WINDOW_SCORERS:
        return WINDOW_SCORERS[name](**options)
    of_pixels = build(config)

    def whole(bands: np.ndarray) -> np.ndarray:
        logits = of_pixels(bands.reshape(len(bands), -1).T)
        return logits.T.reshape(-1, *bands.shape[1:])

    return whole


@register_window("linear_ramp")
def linear_ramp(weights: list[list[float]], bias: list[float], ramp: list[float]):
    """Linear in the bands, with a slope over the window: a scorer whose answer depends on the place in its window."""
    w, b, r = (np.asarray(v, dtype=float) for v in (weights, bias, ramp))

    def whole(bands: np.ndarray) -> np.ndarray:
        y, x = np.mgrid[: bands.shape[1], : bands.shape[2]]
        return np.einsum("cb,bhw->chw", w, bands) + b[:, None, None] + r[:, None, None] * (y + 2 * x)

    return whole
