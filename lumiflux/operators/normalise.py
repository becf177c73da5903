"""Relative fluorescence, detrending."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

METHODS = ("mean", "divide", "roll_mean")


def with_map(pixels: DataFrame, image: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each pixel with the row of a map. Keyed by y and x a map is one image, whose size does not grow with the movie, and
    is broadcast; with more keys, as trials, it is left to Spark. The movie is never sorted for it."""
    return pixels.join(F.broadcast(image) if set(keys) <= {"y", "x"} else image, list(keys))


def in_baseline(baseline: tuple[int | None, int | None] | None, length: int | None = None, t: str = "t") -> Column:
    """Half-open frame range; None means all; negative bounds need the length."""
    if baseline is None:
        return F.lit(True)
    if length is not None:
        a, b, _ = slice(*baseline).indices(length)
    else:
        a, b = baseline
        if (a or 0) < 0 or (b or 0) < 0:
            raise ValueError("negative bounds need the length")
    low = F.col(t) >= (a or 0)
    return low if b is None else low & (F.col(t) < b)


def patched(f0: DataFrame, image: Sequence[str], value: str = "f0") -> DataFrame:
    """Zeros become the median of the positive values of their image, or 1 without any. A window holds one image."""
    fill = F.median(F.when(F.col(value) > 0, F.col(value))).over(W.partitionBy(*image))
    filled = f0.withColumn("__m", fill)
    return filled.withColumn(value, F.when(F.col(value) == 0, F.coalesce("__m", F.lit(1.0))).otherwise(F.col(value))).drop("__m")


def baseline_f0(pixels: DataFrame, baseline=None, keys: Sequence[str] = ("y", "x"), image: Sequence[str] = ()) -> DataFrame:
    """Mean of the baseline frames of each pixel, zeros patched."""
    f0 = pixels.groupBy(*image, *keys).agg(F.avg(F.when(in_baseline(baseline), F.col("v"))).alias("f0"))
    return patched(f0, image)


def dff(pixels: DataFrame, baseline=None, method: str = "mean", roll_window: int = 100, keys: Sequence[str] = ("y", "x"), image: Sequence[str] = ()) -> DataFrame:
    """pixels with f0 and dff. mean: (v - f0) / f0; divide: v / f0; roll_mean: f0 is the mean of the last roll_window frames."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    own = [*image, *keys]
    if method == "roll_mean":
        w = W.partitionBy(*own).orderBy("t").rowsBetween(1 - roll_window, 0)
        rolled = patched(pixels.withColumn("f0", F.avg("v").over(w)), [*image, "t"])
        return rolled.withColumn("dff", (F.col("v") - F.col("f0")) / F.col("f0"))
    joined = with_map(pixels, baseline_f0(pixels, baseline, keys, image), own)
    change = F.col("v") if method == "divide" else F.col("v") - F.col("f0")
    return joined.withColumn("dff", change / F.col("f0"))


def detrend_quadratic(traces: DataFrame, length: int, keys: Sequence[str] = ("y", "x")) -> DataFrame:
    """Subtracts each trace's least-squares parabola over t = -1 .. 1; three sums a trace, one constant 3 x 3 inverse."""
    import numpy as np

    t = np.linspace(-1, 1, length)
    inverse = np.linalg.inv(np.vander(t, 3, increasing=True).T @ np.vander(t, 3, increasing=True))
    u = (F.lit(-1.0) + F.lit(2.0) * F.col("t") / F.lit(float(length - 1))) if length > 1 else F.lit(-1.0)
    rows = traces.withColumn("__u", u)
    sums = [F.sum("v"), F.sum(F.col("__u") * F.col("v")), F.sum(F.col("__u") * F.col("__u") * F.col("v"))]
    beta = [sum((F.lit(float(inverse[i, j])) * sums[j] for j in range(1, 3)), F.lit(float(inverse[i, 0])) * sums[0]) for i in range(3)]
    fitted = with_map(rows, rows.groupBy(*keys).agg(*(b.alias(f"__b{i}") for i, b in enumerate(beta))), keys)
    fit = F.col("__b0") + F.col("__b1") * F.col("__u") + F.col("__b2") * F.col("__u") * F.col("__u")
    return fitted.withColumn("detrended", F.col("v") - fit).drop("__u", "__b0", "__b1", "__b2")
