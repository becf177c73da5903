"""The causal operators on streams of frames (channel separation, relative change to a fixed baseline, rolling mean)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def separate(frames: DataFrame, order: Sequence[str]) -> DataFrame:
    """Stateless: a stream has no last cycle, so a frame goes on as it comes."""
    n = len(order)
    name = F.element_at(F.array(*map(F.lit, order)), (F.col("frame") % n + 1).cast("int"))
    return frames.withColumn("channel", name).withColumn("t", F.floor(F.col("frame") / n).cast("long"))


def relative(pixels: DataFrame, f0: DataFrame, divide: bool = True) -> DataFrame:
    """A stream of pixels joined with the static baseline map of a session."""
    joined = pixels.join(F.broadcast(f0), ["y", "x"])
    change = F.col("v") if divide else F.col("v") - F.col("f0")
    return joined.withColumn("dff", change / F.col("f0"))


def rolling(pixels: DataFrame, window: int = 100) -> DataFrame:
    """f0, the mean of a pixel's last window frames, and dff. State: the last window - 1 values of each pixel. Frames of
    a pixel are taken in the order of t within a micro-batch. A frame not newer than one already seen comes too late for its
    window: its row has late set, and no f0 and dff, so that none is lost unseen and a count of late is a filter away."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (-1, [])
        held = list(held)
        rows = pd.concat(list(batches)).sort_values("t")
        out = []
        for t, v in zip(rows["t"], rows["v"]):
            if t <= last:
                out.append((key[0], key[1], int(t), float(v), None, None, True))
                continue
            held = (held + [float(v)])[-window:]
            f0 = sum(held) / len(held)
            out.append((key[0], key[1], int(t), float(v), f0, (v - f0) / (f0 or 1.0), False))
            last = int(t)
        state.update((last, held[-(window - 1) :] if window > 1 else []))
        yield pd.DataFrame(out, columns=["y", "x", "t", "v", "f0", "dff", "late"])

    return pixels.groupBy("y", "x").applyInPandasWithState(step, "y int, x int, t long, v double, f0 double, dff double, late boolean", "last long, held array<double>", "append", GroupStateTimeout.NoTimeout)
