"""Sessions of several trials: movies with a column trial, each trial's frames numbered from 0.

Operators that take keys work on trials by naming them: baselines are per trial (keys or image with "trial"), the
regression against the reference channel pools all trials (keys without it), time courses have keys ("trial", "t").
What is special stands here: whole cycles are counted trial by trial, and one reference, the median image of the first
trial unless one is given, aligns the frames of all.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lumiflux.operators import images

TRIAL = "trial"


def time_keys(movie: DataFrame) -> tuple[str, ...]:
    """The columns that tell the moments of a movie apart."""
    return (TRIAL, "t") if TRIAL in movie.columns else ("t",)


def lengths(frames: DataFrame) -> DataFrame:
    """trial, n_frames: one row a trial."""
    return frames.groupBy(TRIAL).agg((F.max("frame") + 1).alias("n_frames"))


def separate(frames: DataFrame, order: Sequence[str] = ("blue", "green", "red"), per_cycle: int = 3, counted: DataFrame | None = None) -> DataFrame:
    """channel and t in place of frame; the frames of each trial's last cycle are dropped if it is not whole. frames has a
    row a frame or a pixel; counted, lengths() of the frames, spares counting pixels."""
    if len(order) != per_cycle:
        raise ValueError(f"order names {len(order)} channels, a cycle has {per_cycle} frames")
    name = F.element_at(F.array(*map(F.lit, order)), (F.col("frame") % per_cycle + 1).cast("int"))
    whole = (lengths(frames) if counted is None else counted).select(TRIAL, (F.floor(F.col("n_frames") / per_cycle) * per_cycle).alias("__whole"))
    # One row a trial; Spark broadcasts it where its size allows that.
    own = frames.join(whole, TRIAL).where(F.col("frame") < F.col("__whole")).drop("__whole")
    return own.withColumn("channel", name).withColumn("t", F.floor(F.col("frame") / per_cycle).cast("long")).drop("frame")


def first_trial(movie: DataFrame) -> DataFrame:
    """The rows of the trial with the least number."""
    least = movie.agg(F.min(TRIAL).alias(TRIAL))
    return movie.join(F.broadcast(least), TRIAL, "left_semi")  # a single row


def reference_image(pixels: DataFrame, height: int, width: int) -> np.ndarray:
    """Median over time of each pixel of the first trial."""
    return images.reference_image(first_trial(pixels) if TRIAL in pixels.columns else pixels, height, width)


def motion_correct(frames: DataFrame, height: int, width: int, reference: np.ndarray | None = None, upsample: int = 10) -> DataFrame:
    """Frames of all trials aligned to one reference, and their shifts dy, dx."""
    if reference is None:
        from lumiflux.operators.frames import to_pixels

        reference = reference_image(to_pixels(frames, width), height, width)
    return images.motion_correct(frames, height, width, reference, upsample)
