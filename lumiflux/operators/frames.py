"""Reshaping movies in the long layout (trial keys..., frame or t, y, x, v). All are projections or one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

NAN = float("nan")


def missing(v: str | Column) -> Column:
    """NaN and infinities become null, which aggregates skip."""
    c = F.col(v) if isinstance(v, str) else v
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def to_pixels(frames: DataFrame, width: int, image: str = "img") -> DataFrame:
    """One row a frame with a flat row-major image to one row a pixel."""
    others = [c for c in frames.columns if c != image]
    return frames.select(*others, F.posexplode(image).alias("i", "e")).select(*others, F.floor(F.col("i") / width).cast("int").alias("y"), (F.col("i") % width).cast("int").alias("x"), F.col("e").cast("double").alias("v"))


def to_frames(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a pixel to one row a frame, its image flat and row-major."""
    ordered = F.array_sort(F.collect_list(F.struct("y", "x", "v")))
    return pixels.groupBy(*keys).agg(F.transform(ordered, lambda s: s.v).alias("img"))


def separate_channels(pixels: DataFrame, n_frames: int, order: Sequence[str] = ("blue", "green", "red"), per_cycle: int = 3) -> DataFrame:
    """Frame f goes to channel order[f mod n] at t = f div n; frames of a cycle that is not whole are dropped."""
    if len(order) != per_cycle:
        raise ValueError(f"order names {len(order)} channels, a cycle has {per_cycle} frames")
    whole = per_cycle * (n_frames // per_cycle)
    name = F.element_at(F.array(*map(F.lit, order)), (F.col("frame") % per_cycle + 1).cast("int"))
    return pixels.where(F.col("frame") < whole).withColumn("channel", name).withColumn("t", F.floor(F.col("frame") / per_cycle).cast("long")).drop("frame")


def by_channel(pixels: DataFrame, channels: Sequence[str], keys: Sequence[str] = ("t", "y", "x")) -> DataFrame:
    """Channels side by side, by one aggregate instead of a self-join."""
    return pixels.groupBy(*keys).agg(*(F.max(F.when(F.col("channel") == c, F.col("v"))).alias(c) for c in channels))


def rotate(pixels: DataFrame, k: int, height: int, width: int) -> DataFrame:
    """k quarter turns counter-clockwise."""
    y, x = F.col("y"), F.col("x")
    ny, nx = {0: (y, x), 1: (F.lit(width - 1) - x, y), 2: (F.lit(height - 1) - y, F.lit(width - 1) - x), 3: (x, F.lit(height - 1) - y)}[k % 4]
    return pixels.withColumns({"y": ny.cast("int"), "x": nx.cast("int")})


def grid(spark, height: int, width: int) -> DataFrame:
    return spark.range(height * width).select(F.floor(F.col("id") / width).cast("int").alias("y"), (F.col("id") % width).cast("int").alias("x"))


def pad(image: DataFrame, height: int, width: int, to_height: int, to_width: int, value: float = 0.0) -> DataFrame:
    """Centred; an odd pixel goes to the bottom or right."""
    if to_height < height or to_width < width:
        raise ValueError("target is smaller than the image")
    top, left = (to_height - height) // 2, (to_width - width) // 2
    moved = image.select((F.col("y") + top).cast("int").alias("y"), (F.col("x") + left).cast("int").alias("x"), "v")
    return grid(image.sparkSession, to_height, to_width).join(moved, ["y", "x"], "left").select("y", "x", F.coalesce("v", F.lit(float(value))).alias("v"))


def block_nanmean(pixels: DataFrame, fy: int, fx: int, height: int, width: int, keys: Sequence[str] = ("t",)) -> DataFrame:
    """Mean of whole blocks that skips NaN; rows and columns beyond whole blocks are cropped; an all-NaN block is NaN."""
    inside = (F.col("y") < height // fy * fy) & (F.col("x") < width // fx * fx)
    blocks = pixels.where(inside).select(*keys, F.floor(F.col("y") / fy).cast("int").alias("y"), F.floor(F.col("x") / fx).cast("int").alias("x"), missing("v").alias("v"))
    return blocks.groupBy(*keys, "y", "x").agg(F.coalesce(F.avg("v"), F.lit(NAN)).alias("v"))


def resampled(pixels: DataFrame, rows: Sequence[tuple[int, int, float]], cols: Sequence[tuple[int, int, float]], keys: Sequence[str] = ("t",)) -> DataFrame:
    """Separable linear resampling: rows and cols are weights (out, in, weight), whose size is that of one image."""
    spark = pixels.sparkSession
    wy = spark.createDataFrame(list(rows), "yo int, y int, wy double")
    wx = spark.createDataFrame(list(cols), "xo int, x int, wx double")
    joined = pixels.join(F.broadcast(wy), "y").join(F.broadcast(wx), "x")
    return joined.groupBy(*keys, F.col("yo"), F.col("xo")).agg(F.sum(F.col("wy") * F.col("wx") * F.col("v")).alias("v")).withColumnsRenamed({"yo": "y", "xo": "x"})


def nan_weighted_resample(pixels: DataFrame, rows, cols, near_rows, near_cols, keys: Sequence[str] = ("t",)) -> DataFrame:
    """Resize with NaN filled by 0; a pixel whose nearest source is NaN is NaN."""
    filled = pixels.withColumn("v", F.coalesce(missing("v"), F.lit(0.0)))
    valid = pixels.withColumn("v", F.when(missing("v").isNotNull(), 1.0).otherwise(0.0))
    num = resampled(filled, rows, cols, keys)
    w = resampled(valid, near_rows, near_cols, keys).withColumnRenamed("v", "w")
    return num.join(w, [*keys, "y", "x"]).withColumn("v", F.when(F.col("w") != 0, F.try_divide("v", "w")).otherwise(F.lit(NAN))).drop("w")


def temporal(pixels: DataFrame, how: str, keys: Sequence[str] = ("y", "x")) -> DataFrame:
    """Mean, median or standard deviation of each pixel over time; any NaN makes it NaN. For the median each pixel's values
    are held by the task that has the pixel; selection.medians() gives the same for movies too long for that."""
    f = {"mean": F.avg, "median": F.median, "std": F.stddev_pop}[how]
    v = f("v")
    return pixels.groupBy(*keys).agg((v if how != "median" else F.when(F.max(F.isnan("v")), F.lit(NAN)).otherwise(v)).alias("v"))


def downsample_nanmean(pixels: DataFrame, height: int, width: int, scale: float | None = None, target: tuple[int, int] | None = None, order: int = 1, keys: Sequence[str] = ("t",)) -> DataFrame:
    """Shrinks movies with missing pixels: nearest for order 0, block means for whole factors, else weighted."""
    from lumiflux.functions.kernels import axis_weights, out_size

    if scale is None and target is None:
        raise ValueError("scale or target is needed")
    h, w = target or (out_size(height, scale), out_size(width, scale))
    factors = (1 / scale, 1 / scale) if target is None else (height / h, width / w)
    sparse = lambda m: [(o, i, float(m[o, i])) for o in range(len(m)) for i in range(len(m[0])) if m[o, i]]
    near = [sparse(axis_weights(a, b, 0)) for a, b in ((height, h), (width, w))]
    if order == 0:
        return resampled(pixels, *near, keys)
    if all(abs(f - round(f)) < 1e-9 for f in factors):
        return block_nanmean(pixels, round(factors[0]), round(factors[1]), height, width, keys)
    smooth = [sparse(axis_weights(a, b, order)) for a, b in ((height, h), (width, w))]
    return nan_weighted_resample(pixels, *smooth, *near, keys)
