"""Operators on whole frames and traces that run numpy kernels on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from lumiflux.functions import kernels

FRAME = "img"


def _as_images(s: pd.Series, h: int, w: int) -> Iterator[np.ndarray]:
    return (np.asarray(v, float).reshape(h, w) for v in s)


def downsample(frames: DataFrame, height: int, width: int, scale: float | None = None, target: tuple[int, int] | None = None, order: int = 1, integer: bool = False) -> DataFrame:
    """Every frame (flat images in img) to round(size * scale), or to target; integer movies lose their fractions."""
    if scale is None and target is None:
        raise ValueError("scale or target is needed")
    h, w = target or (kernels.out_size(height, scale), kernels.out_size(width, scale))
    rows, cols = (kernels.axis_weights(a, b, order, order > 0) for a, b in ((height, h), (width, w)))

    def small(flat: np.ndarray) -> np.ndarray:
        image = flat.reshape(height, width)
        out = np.clip(rows @ image @ cols.T, image.min(), image.max())
        return (np.trunc(out) if integer else out).ravel()

    return each_image(frames, small)


def each_image(frames: DataFrame, f: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """f, from one flat image to another, on every frame, in Arrow batches; missing pixels go in and come out as NaN."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(FRAME)
            out = [f(v.values.to_numpy(zero_copy_only=False).astype(float)) for v in batch.column(at)]
            ends = np.concatenate([[0], np.cumsum([len(o) for o in out])]).astype(np.int32)
            # Pixels as numpy has them: through pandas NaN would become null.
            values = pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())
            yield batch.set_column(at, FRAME, pa.ListArray.from_arrays(pa.array(ends), values))

    return frames.mapInArrow(put, with_doubles(frames))


def printed(frames: DataFrame, places: int = 4) -> DataFrame:
    """Every frame as text: its pixels, joined by commas, with the digits of C's printf (of the exact value, ties to even,
    where Java rounds them up). Null pixels are left out; a frame without others is null."""
    form = f"%.{places}f"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(FRAME)
            text = [",".join(form % p for p in v.as_py() or () if p is not None) or None for v in batch.column(at)]
            yield batch.set_column(at, FRAME, pa.array(text, pa.string()))

    return frames.mapInArrow(put, StructType([StructField(f.name, StringType()) if f.name == FRAME else f for f in frames.schema.fields]))


def with_doubles(frames: DataFrame, *more: StructField) -> StructType:
    return StructType([StructField(f.name, ArrayType(DoubleType())) if f.name == FRAME else f for f in frames.schema.fields] + list(more))


def motion_correct(frames: DataFrame, height: int, width: int, reference: np.ndarray, upsample: int = 10) -> DataFrame:
    """Every frame aligned to the reference (one image, sent with the task), and its shift dy, dx."""

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            shifts = [kernels.register(reference, i, upsample) for i in _as_images(pdf[FRAME], height, width)]
            images = [kernels.fourier_shift(i, *s).ravel() for i, s in zip(_as_images(pdf[FRAME], height, width), shifts)]
            yield pdf.assign(**{FRAME: images, "dy": [s[0] for s in shifts], "dx": [s[1] for s in shifts]})

    return frames.mapInPandas(put, with_doubles(frames, StructField("dy", DoubleType()), StructField("dx", DoubleType())))


def to_image(pixels: DataFrame, height: int, width: int, v: str = "v", missing: float = float("nan")) -> np.ndarray:
    """One image (y, x, v) to the driver: of bounded size, and checked to be one."""
    rows = pixels.select("y", "x", v).limit(height * width + 1).collect()
    if len(rows) > height * width:
        raise ValueError("more than one image")
    out = np.full((height, width), missing)
    for y, x, value in rows:
        out[y, x] = missing if value is None else value
    return out


def reference_image(pixels: DataFrame, height: int, width: int) -> np.ndarray:
    """Median over time of each pixel."""
    return to_image(pixels.groupBy("y", "x").agg(F.median("v").alias("v")), height, width)


def filtered(traces: DataFrame, fs: float, low: float | None = None, high: float | None = None, order: int = 3, keys: Sequence[str] = ("y", "x")) -> DataFrame:
    """traces (keys, t, v) with v filtered without phase shift along t; unchanged without cutoffs. One shuffle by trace;
    traces of equal length are filtered together, an Arrow batch at a time."""
    ba = kernels.butterworth(order, low, high, fs)
    if ba is None:
        return traces
    gathered = F.array_sort(F.collect_list(F.struct("t", "v")))
    whole = traces.groupBy(*keys).agg(F.transform(gathered, lambda s: s.t).alias("t"), F.transform(gathered, lambda s: s.v).alias("v"))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list = [None] * len(pdf)
            lengths = pdf["v"].map(len).to_numpy()
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                y = kernels.zero_phase(np.stack([np.asarray(pdf["v"].iloc[i], float) for i in at], axis=1), *ba)
                for k, i in enumerate(at):
                    out[i] = y[:, k]
            yield pdf.assign(v=out)

    done = whole.mapInPandas(put, whole.schema)
    return done.select(*keys, F.explode(F.arrays_zip("t", "v")).alias("p")).select(*keys, F.col("p.t").alias("t"), F.col("p.v").alias("v"))


def masked_by(images: DataFrame, height: int, width: int, kernel, keys: Sequence[str] = ("channel",)) -> DataFrame:
    """Pixels kept by a kernel that turns an image into a boolean one; a group is one image (keys, y, x, v)."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in images.schema if f.name in keys)

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        image = np.full((height, width), np.nan)
        image[pdf["y"], pdf["x"]] = pdf["v"]
        y, x = np.nonzero(kernel(image))
        return pd.DataFrame({**{k: [v] * len(y) for k, v in zip(keys, key)}, "y": y.astype(np.int32), "x": x.astype(np.int32)})

    return images.select(*keys, "y", "x", "v").groupBy(*keys).applyInPandas(one, f"{kinds}, y int, x int")


def brain_mask(image: DataFrame, height: int, width: int, method: str = "auto", deviation: DataFrame | None = None, atlas: DataFrame | None = None, add: DataFrame | None = None, subtract: DataFrame | None = None, **options) -> DataFrame:
    """The mask (y, x) of one image. auto: thresholds and morphology; hybrid: auto, then polygons added and subtracted;
    manual: the added polygons alone; simple: the footprint of the atlas, or the added polygons without one."""
    from lumiflux.operators import masks
    from lumiflux.operators.frames import grid

    spark = image.sparkSession
    drawn = lambda p: masks.polygon(grid(spark, height, width), p)
    if method == "simple" and atlas is not None:
        return masks.footprint(atlas)
    if method in ("manual", "simple"):
        if add is None:
            raise ValueError(f"method {method!r} needs polygons")
        return masks.difference(drawn(add), drawn(subtract)) if subtract is not None else drawn(add)
    if method not in ("auto", "hybrid"):
        raise ValueError(f"unknown method {method!r}")
    # One image: its size has a bound, which to_image() checks.
    filled = lambda p: [to_image(drawn(p).withColumn("v", F.lit(1.0)), height, width, missing=0.0) > 0] if p is not None and method == "hybrid" else []
    spread = None if deviation is None else to_image(deviation, height, width)
    found = kernels.brain_mask(to_image(image, height, width), spread, filled(add), filled(subtract), **options)
    y, x = np.nonzero(found)
    return spark.createDataFrame(list(zip(y.tolist(), x.tolist())), "y int, x int")
