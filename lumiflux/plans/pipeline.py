"""Whole sessions: from an interleaved movie to time series of pixels and regions, in either direction of registration.

Landmarks and polygons are tables (drawn elsewhere); everything else follows the configuration. The frames of a channel
are aligned in one pass of Arrow batches against a collected reference image (of the first trial, if there are several);
after that all is relational. Rotation is
a projection, masks are joined before aggregation, and all signals of a region share one aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from lumiflux.functions import geometry, kernels
from lumiflux.operators import frames as fr, hemodynamics as hemo, images, masks, normalise, trials, warp
from lumiflux.sources import mat, tables, tiff
from lumiflux.sources.files import stored

SIGNALS = ("hbr", "hbo", "hbt", "cbf", "cmro2")


@dataclass
class Session:
    """A movie ([trial,] frame, img), its size, an atlas (y, x, label), a footprint (y, x) of the same size, and landmarks
    in (x, y). With trials, data sets have the column trial wherever they have t."""

    movie: DataFrame
    shape: tuple[int, int]
    atlas: DataFrame
    footprint: DataFrame
    atlas_shape: tuple[int, int]
    mouse_points: np.ndarray
    atlas_points: np.ndarray
    extinction: dict[str, tuple[float, float]] | None = None


def aligned(s: Session, c: tables.Config, hemodynamics: bool) -> tuple[DataFrame, dict[str, DataFrame], DataFrame, tuple[int, int]]:
    """Aligned pixels (channel, [trial,] t, y, x, v) in the camera's orientation, references, shifts, size.

    The movie is decoded and shrunk once: the small frames, by channel, are a table in the shared folder. So are the
    aligned ones; references and all later steps read these."""
    spark, keys = s.movie.sparkSession, trials.time_keys(s.movie)
    h, w = (kernels.out_size(n, c.factor) for n in s.shape)
    frames = s.movie if trials.TRIAL in keys else s.movie.withColumn(trials.TRIAL, F.lit(0))
    small = images.downsample(frames.select(trials.TRIAL, "frame", "img"), *s.shape, target=(h, w), integer=_stored_as_integers(s.movie))
    small = trials.separate(small, c.order, c.per_cycle, trials.lengths(frames.select(trials.TRIAL, "frame")))
    small = stored(small if hemodynamics else small.where("channel <> 'red'"), "small-frames", "channel")
    parts = []
    for name in c.order:
        if name == "red" and not hemodynamics:
            continue
        own = small.where(F.col("channel") == name)
        parts.append(trials.motion_correct(own, h, w, upsample=c.upsample[name]))
    moved = parts[0]
    for p in parts[1:]:
        moved = moved.unionByName(p)
    moved = stored(moved, "aligned-frames", "channel")
    pixels = fr.to_pixels(moved.select("channel", *keys, "img"), w)
    references = {n: fr.temporal(pixels.where(F.col("channel") == n), "median") for n in c.order if n != "red" or hemodynamics}
    return pixels, references, moved.select("channel", *keys, "dy", "dx"), (h, w)


def _stored_as_integers(movie: DataFrame) -> bool:
    return (movie.schema["img"].metadata or {}).get("stored", "f")[0] in "ui"


def run(s: Session, c: tables.Config, hemodynamics: bool = True) -> dict[str, DataFrame]:
    """All data sets of the session by their configured names."""
    spark, time = s.movie.sparkSession, trials.time_keys(s.movie)
    trial, place_keys = time[:-1], (*time, "y", "x")
    pixels, references, shifts, (h, w) = aligned(s, c, hemodynamics)
    turned = (w, h) if c.rotate % 2 else (h, w)
    turn = lambda df: fr.rotate(df, c.rotate, h, w)
    out = {f"{n}_ref": turn(r) for n, r in references.items()} | {"shifts": shifts}

    # Baselines are each trial's own; the fit pools the trials.
    change = normalise.dff(pixels.where("channel <> 'red'"), c.baseline, c.method, image=("channel", *trial))
    both = turn(fr.by_channel(change.select("channel", *place_keys, F.col("dff").alias("v")), ("blue", "green"), place_keys))
    fixed = hemo.correct(both, c.correction).select(*place_keys, F.col("corrected").alias("blue"), "green")
    if c.experiment == "rest":
        clean = images.filtered(fixed.select(*place_keys, F.col("blue").alias("v")), c.fs, c.highpass, c.lowpass, keys=(*trial, "y", "x"))
        fixed = clean.withColumnRenamed("v", "blue").join(fixed.select(*place_keys, "green"), list(place_keys))
    signals = None
    if hemodynamics:
        raw = turn(fr.by_channel(pixels, ("green", "red"), place_keys))
        inverse = hemo.unmixing(s.extinction) if c.hemo_method == "dual_wavelength" else None
        signals = hemo.signals(raw, c.hemo_method, c.hemo_baseline, inverse, keys=(*trial, "y", "x"))
    names = SIGNALS if c.hemo_method == "dual_wavelength" else ("hbt",)

    m = geometry.fit(s.mouse_points, s.atlas_points, c.fit, c.direction)
    back = np.linalg.inv(m)
    if c.direction == "atlas_to_mouse":
        atlas = warp.warp_labels(s.atlas, back, turned, s.atlas_shape)
        mask = masks.footprint(atlas)
        place = lambda df, values: df
    else:
        mouse_mask = warp.warp_mask(s.footprint, m, turned, s.atlas_shape)
        atlas = masks.crop_to_view(s.atlas, s.footprint, c.min_overlap)
        mask = s.footprint
        table = F.broadcast(warp.weights(spark, back, s.atlas_shape, turned, 1))

        def place(df: DataFrame, values: tuple[str, ...]) -> DataFrame:
            """Masked in the camera's space, then moved; a corner outside the mask leaves nothing (NaN)."""
            kept = mouse_mask.withColumn("__in", F.lit(True))
            own = df.join(F.broadcast(kept), ["y", "x"], "left").select(*place_keys, *(F.when(F.col("__in"), F.col(v)).otherwise(F.lit(fr.NAN)).alias(v) for v in values))
            moved = own.join(table, ["y", "x"]).groupBy(*time, "yo", "xo").agg(*(F.sum(F.col("w") * F.col(v)).alias(v) for v in values))
            return moved.withColumnsRenamed({"yo": "y", "xo": "x"})

        for n in references:
            out[f"{n}_ref"] = warp.warp(out[f"{n}_ref"], back, s.atlas_shape, turned, 1, ())
        out["transform"] = spark.createDataFrame([([list(map(float, r)) for r in m], *s.atlas_shape)], "m array<array<double>>, out_h int, out_w int")

    calcium = place(fixed, ("blue", "green"))
    inside = calcium.join(F.broadcast(mask), ["y", "x"], "left_semi") if c.direction == "atlas_to_mouse" else calcium
    out |= {"pixel_ts": inside.select(*place_keys, F.col("blue").alias("v")), "green_pixel": inside.select(*place_keys, F.col("green").alias("v"))}
    roi = masks.timecourses(calcium, atlas, mask, c.min_overlap, ("blue", "green"), time)
    out |= {"roi_ts": roi.select("label", *time, F.col("blue").alias("v")), "green_ts": roi.select("label", *time, F.col("green").alias("v")), "roi_id": roi.select("label").distinct(), "atlas_mask": masks.restrict(atlas, mask).where("label > 0"), "brain_mask": mask}
    if signals is not None:
        moved = place(signals.select(*place_keys, *names), names)
        out["hemopixel_ts"] = moved.join(F.broadcast(mask), ["y", "x"], "left_semi") if c.direction == "atlas_to_mouse" else moved
        out["hemo_ts"] = masks.timecourses(moved, atlas, mask, c.hemo_min_overlap, names, time)
    return out


def run_config(spark: SparkSession, path: str, mouse_points: np.ndarray, atlas_points: np.ndarray, hemodynamics: bool = True) -> dict[str, DataFrame]:
    """Reads what a configuration file names, runs the session and writes its data sets. With trials, the movie is a
    folder of them, one a file."""
    c = tables.read_config(path)
    movie = tiff.read_stack(spark, c.movie, trials=c.trials)
    first = movie.select("h", "w").first()
    atlas, template = mat.load(c.atlas, "data"), mat.load(c.template, "data")
    if atlas.shape != template.shape:
        raise ValueError("atlas and template differ in size")
    footprint = mat.as_labels(spark, template > 0).where("label > 0").select("y", "x")
    species = tables.extinction(c.extinction, c.green_nm, c.red_nm) if hemodynamics and c.hemo_method == "dual_wavelength" else None
    session = Session(movie, (first.h, first.w), mat.as_labels(spark, atlas), footprint, atlas.shape, mouse_points, atlas_points, species)
    out = run(session, c, hemodynamics)
    tables.write(out, c.outputs)
    return out
