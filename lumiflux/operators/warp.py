"""Warps: one weight table a session, joined with every frame."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lumiflux.functions import geometry, kernels
from lumiflux.operators import images
from lumiflux.operators.frames import NAN, grid, missing


def weights(spark, inverse: np.ndarray, out_shape: tuple[int, int], in_shape: tuple[int, int], order: int) -> DataFrame:
    """At most (order + 1) squared rows an output pixel: the size of some images, not of a movie."""
    return spark.createDataFrame(geometry.warp_table(inverse, out_shape, in_shape, order), "yo int, xo int, y int, x int, w double")


def warp(pixels: DataFrame, inverse: np.ndarray, out_shape: tuple[int, int], in_shape: tuple[int, int], order: int = 1, keys: Sequence[str] = ("t",)) -> DataFrame:
    """Pixels whose sources lie in the image; those beyond its view have no row (fill() gives them one). Orders 0, 1 and 3;
    cubic values keep to the range of their frame. Splines of other orders need whole frames: warp_frames()."""
    if order not in (0, 1, 3):
        raise ValueError(f"interpolation order {order} needs whole frames: see warp_frames")
    table = F.broadcast(weights(pixels.sparkSession, inverse, out_shape, in_shape, order))
    moved = pixels.join(table, ["y", "x"]).groupBy(*keys, "yo", "xo").agg(F.sum(F.col("w") * F.col("v")).alias("v"))
    moved = moved.withColumnsRenamed({"yo": "y", "xo": "x"})
    if order < 2:
        return moved
    ends = pixels.groupBy(*keys).agg(F.min(missing("v")).alias("__lo"), F.max(missing("v")).alias("__hi"))  # a row a frame
    clipped = (moved.join(ends, list(keys)) if keys else moved.crossJoin(F.broadcast(ends))).withColumn("v", F.when(F.isnan("v"), F.col("v")).otherwise(F.greatest("__lo", F.least("__hi", "v"))))
    return clipped.drop("__lo", "__hi")


def warp_frames(frames: DataFrame, inverse: np.ndarray, out_shape: tuple[int, int], in_shape: tuple[int, int], order: int = 1) -> DataFrame:
    """Whole frames (flat images in img) by interpolation of order 0 to 5, NaN beyond the view: one pass of Arrow batches
    without a shuffle. Above order 1, values keep to the range of their frame. A missing pixel is missing in all values
    that take it; splines (orders 2, 4 and 5) take every pixel of a frame."""
    if order not in kernels.ORDERS:
        raise ValueError(f"interpolation order {order} is not supported")
    size, held = out_shape[0] * out_shape[1], []

    def moved(image: np.ndarray) -> np.ndarray:
        if not held:  # once a task: the matrix travels, not the table
            held.append(geometry.warp_axes(inverse, out_shape, in_shape, order))
        at, ky, kx, wy, wx = held[0]
        flat = image
        if order in (2, 4, 5):
            flat = kernels.spline_filter(kernels.spline_filter(image.reshape(in_shape), order).T, order).T.ravel()
        out, mine = np.full(size, np.nan), np.zeros(len(at))
        for i in range(ky.shape[1]):
            for j in range(kx.shape[1]):
                mine += wy[:, i] * wx[:, j] * flat[ky[:, i] * in_shape[1] + kx[:, j]]
        out[at] = mine
        return np.clip(out, np.nanmin(image), np.nanmax(image)) if order > 1 and not np.isnan(image).all() else out

    return images.each_image(frames, moved)


def warp_labels(atlas: DataFrame, inverse: np.ndarray, out_shape: tuple[int, int], in_shape: tuple[int, int]) -> DataFrame:
    """Nearest label of every output pixel, 0 beyond the view."""
    table = F.broadcast(weights(atlas.sparkSession, inverse, out_shape, in_shape, 0))
    moved = atlas.join(table, ["y", "x"]).select(F.col("yo").alias("y"), F.col("xo").alias("x"), "label")
    return grid(atlas.sparkSession, *out_shape).join(moved, ["y", "x"], "left").select("y", "x", F.coalesce(F.col("label"), F.lit(0)).cast("int").alias("label"))


def warp_mask(mask: DataFrame, inverse: np.ndarray, out_shape: tuple[int, int], in_shape: tuple[int, int]) -> DataFrame:
    return warp_labels(mask.select("y", "x", F.lit(1).alias("label")), inverse, out_shape, in_shape).where("label > 0").select("y", "x")


def fill(pixels: DataFrame, shape: tuple[int, int], keys: Sequence[str] = ("t",)) -> DataFrame:
    """A row for every pixel of every frame, NaN where there was none."""
    frames = pixels.select(*keys).distinct()
    return frames.crossJoin(F.broadcast(grid(pixels.sparkSession, *shape))).join(pixels, [*keys, "y", "x"], "left").withColumn("v", F.coalesce("v", F.lit(NAN)))
