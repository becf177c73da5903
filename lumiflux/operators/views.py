"""The tables behind the usual pictures of a session: single frames, before and after, sampled points, merged signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from lumiflux.operators import masks, quality
from lumiflux.operators.frames import missing, temporal


def frame_at(pixels: DataFrame, index: int, n_frames: int) -> DataFrame:
    """One frame; indices wrap around. The filter reaches the scan."""
    return pixels.where(F.col("t") == index % n_frames)


def in_window(traces: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Half-open range of time."""
    low = F.lit(True) if start is None else F.col("t") >= start
    return traces.where(low if stop is None else low & (F.col("t") < stop))


def before_and_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Mean images of two movies and their absolute difference."""
    a, b = temporal(before, "mean").withColumnRenamed("v", "before"), temporal(after, "mean").withColumnRenamed("v", "after")
    return a.join(b, ["y", "x"]).withColumn("difference", F.abs(F.col("after") - F.col("before")))


def pixel_trace(pixels: DataFrame, y: int, x: int) -> DataFrame:
    return pixels.where((F.col("y") == y) & (F.col("x") == x))


def region_mean(pixels: DataFrame, mask: DataFrame, values: Sequence[str] = ("v",)) -> DataFrame:
    """Mean over a mask at each time; a missing value makes it missing."""
    own = pixels.join(mask.select("y", "x"), ["y", "x"], "left_semi")
    return own.groupBy("t").agg(*(F.avg(v).alias(v) for v in values))


def sample(pixels: DataFrame, columns: Sequence[str], n: int = 10_000, seed: int = 0) -> DataFrame:
    """At most n random rows with finite values, in the order of a seeded hash of the row: the same rows however dealt."""
    rows = pixels
    for c in columns:
        rows = rows.where(missing(c).isNotNull())
    return rows.orderBy(F.xxhash64(F.lit(seed), *(F.col(c) for c in rows.columns)), *rows.columns).limit(n).select(*columns)


def ordinals(atlas: DataFrame, labels: DataFrame) -> DataFrame:
    """Regions numbered from 1 in order of their labels, painted on the atlas; 0 elsewhere."""
    numbered = labels.select("label").distinct().withColumn("ordinal", F.row_number().over(W.orderBy("label")))  # one row a region
    return atlas.join(numbered, "label", "left").select("y", "x", "label", F.coalesce("ordinal", F.lit(0)).alias("ordinal"))


def merge(signals: dict[str, DataFrame]) -> DataFrame:
    """Traces of several signals as one table with the column signal."""
    parts = [df.select(F.lit(name).alias("signal"), "label", "t", "v") for name, df in signals.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_labels(labels: DataFrame, traces: DataFrame) -> DataFrame:
    """Labels that have no trace: a strict lookup needs this to be empty."""
    return labels.select("label").distinct().join(traces.select("label"), "label", "left_anti")


def required(labels: DataFrame, traces: DataFrame) -> DataFrame:
    """The traces of the labels. A label without a trace stops the query that runs this plan, wherever it is used; no job
    of its own looks for it."""
    has = traces.withColumn("__has", F.lit(True))
    met = labels.select("label").distinct().join(has, "label", "left")
    absent = F.raise_error(F.format_string("region %s has no time course", F.col("label").cast("string"))).cast(labels.schema["label"].dataType)
    return met.withColumn("label", F.when(F.col("__has"), F.col("label")).otherwise(absent)).drop("__has")


def full_report(signals: dict[str, DataFrame], atlas: DataFrame, fs: float | None = None) -> dict[str, DataFrame]:
    """Metrics of all signals in one pass, flags and summaries by each signal's criteria, and signal-to-noise maps."""
    rows = merge(signals)
    table = quality.metrics(rows, ("signal", "label"))
    if fs is not None:
        table = table.join(quality.spectra(rows, fs, ("signal", "label")), ["signal", "label"], "left")
    flags = {s: quality.issues(table.where(F.col("signal") == s), s) for s in signals}
    out = {"metrics": table, "comparison": quality.compare_table(table, list(signals))}
    for s, f in flags.items():
        out |= {f"{s}_issues": f.select("label", "issues"), f"{s}_common": quality.issue_counts(f), f"{s}_extremes": quality.extremes(f), f"{s}_snr_map": masks.paint(atlas, f, "snr")}
    return out
