"""Masks and atlases as tables of pixels (y, x[, label]); set operations, polygons, regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from lumiflux.operators.frames import NAN, missing

PIXEL = ("y", "x")


def footprint(atlas: DataFrame) -> DataFrame:
    """Pixels with a label above 0; NaN counts as 0."""
    label = F.col("label").cast("double")
    return atlas.where((label > 0) & ~F.isnan(label)).select(*PIXEL)


def restrict(atlas: DataFrame, mask: DataFrame) -> DataFrame:
    """Labels within the mask."""
    return atlas.join(mask.select(*PIXEL), list(PIXEL), "left_semi")


def apply_mask(pixels: DataFrame, mask: DataFrame) -> DataFrame:
    """Pixels outside the mask become NaN."""
    kept = mask.select(*PIXEL).distinct().withColumn("__in", F.lit(True))
    return pixels.join(kept, list(PIXEL), "left").withColumn("v", F.when(F.col("__in"), F.col("v")).otherwise(F.lit(NAN))).drop("__in")


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*PIXEL).union(b.select(*PIXEL)).distinct()


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*PIXEL).join(b.select(*PIXEL), list(PIXEL), "left_anti")


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*PIXEL).intersect(b.select(*PIXEL))


def complement(grid: DataFrame, mask: DataFrame) -> DataFrame:
    return difference(grid, mask)


def polygon(grid: DataFrame, vertices: DataFrame) -> DataFrame:
    """Pixels inside any polygon (polygon_id, vertex, x, y), by ray casting; polygons of under 3 vertices hold none.
    Edges are few (hand-drawn outlines): each pixel meets all of them without a shuffle of the grid."""
    w = W.partitionBy("polygon_id").orderBy("vertex")
    last = F.last("x").over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)), F.last("y").over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    edges = vertices.select("polygon_id", F.col("x").alias("x1"), F.col("y").alias("y1"), F.coalesce(F.lag("x").over(w), last[0]).alias("x0"), F.coalesce(F.lag("y").over(w), last[1]).alias("y0"), F.count("*").over(W.partitionBy("polygon_id")).alias("n")).where("n >= 3")
    rows = edges.agg(F.collect_list(F.struct("polygon_id", "x0", "y0", "x1", "y1")).alias("e"))
    # One row of edges, joined with the grid as a constant.
    px, py = F.col("x").cast("double"), F.col("y").cast("double")

    def crossed(e):
        spans = (e.y0 > py) != (e.y1 > py)
        return spans & F.coalesce(px < (e.x1 - e.x0) * F.try_divide(py - e.y0, e.y1 - e.y0) + e.x0, F.lit(False))

    ids = F.array_distinct(F.transform("e", lambda e: e.polygon_id))
    inside = F.exists(ids, lambda i: F.size(F.filter("e", lambda e: (e.polygon_id == i) & crossed(e))) % 2 == 1)
    return grid.crossJoin(F.broadcast(rows)).where(inside).select(*PIXEL)


def region_sizes(atlas: DataFrame) -> DataFrame:
    return atlas.where("label > 0").groupBy("label").agg(F.count("*").alias("n_pixels"))


def crop_to_view(atlas: DataFrame, mask: DataFrame, min_overlap: int = 10) -> DataFrame:
    """The atlas with labels outside the mask and labels of fewer than min_overlap pixels in it set to 0."""
    kept = mask.select(*PIXEL).distinct().withColumn("__in", F.lit(True))
    inside = atlas.join(kept, list(PIXEL), "left").withColumn("label", F.when(F.col("__in"), F.col("label")).otherwise(0)).drop("__in")
    n = F.count("*").over(W.partitionBy("label"))
    return inside.withColumn("__n", n).withColumn("label", F.when(F.col("__n") < min_overlap, 0).otherwise(F.col("label"))).drop("__n")


def valid_labels(atlas: DataFrame) -> DataFrame:
    return atlas.where("label > 0").select("label").distinct().orderBy("label")


def by_percentile(image: DataFrame, p: float, above: bool = True) -> DataFrame:
    """Pixels above (or below) a percentile of the image, linearly interpolated."""
    cut = image.agg(F.percentile(missing("v"), p / 100).alias("__p"))
    joined = image.crossJoin(F.broadcast(cut))  # a single row
    return joined.where(F.col("v") > F.col("__p") if above else F.col("v") < F.col("__p")).where(missing("v").isNotNull()).select(*PIXEL)


def by_sigma(image: DataFrame, z: float, above: bool = True) -> DataFrame:
    """Pixels beyond mean + z sigma (or below mean - z sigma), sigma with N in the denominator."""
    s = image.agg(F.avg(missing("v")).alias("__m"), F.stddev_pop(missing("v")).alias("__s"))
    joined = image.crossJoin(F.broadcast(s))
    edge = F.col("__m") + (z if above else -z) * F.col("__s")
    return joined.where(F.col("v") > edge if above else F.col("v") < edge).where(missing("v").isNotNull()).select(*PIXEL)


def rescale(image: DataFrame) -> DataFrame:
    """To [0, 1]; a constant image is 0."""
    s = image.agg(F.min("v").alias("__lo"), F.max("v").alias("__hi"))
    return image.crossJoin(F.broadcast(s)).withColumn("v", F.when(F.col("__hi") > F.col("__lo"), (F.col("v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))).otherwise(0.0)).drop("__lo", "__hi")


def timecourses(pixels: DataFrame, atlas: DataFrame, mask: DataFrame | None = None, min_overlap: int = 50, values: Sequence[str] = ("v",), keys: Sequence[str] = ("t",)) -> DataFrame:
    """Mean of each region at each time, skipping NaN (all NaN: NaN). Regions count by their pixels in the mask, finite
    or not. An atlas is one image, so its side of the join is small; partial sums come before the only shuffle."""
    own = atlas.where("label > 0")
    if mask is not None:
        own = restrict(own, mask)
    large = own.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") >= min_overlap).select("label")
    own = own.join(large, "label", "left_semi").select(*PIXEL, "label")
    means = [F.coalesce(F.avg(missing(v)), F.lit(NAN)).alias(v) for v in values]
    return pixels.join(own, list(PIXEL)).groupBy("label", *keys).agg(*means)


def paint(atlas: DataFrame, metrics: DataFrame, metric: str) -> DataFrame:
    """A metric of each region on its pixels; NaN elsewhere."""
    return atlas.join(metrics.select("label", F.col(metric).cast("double").alias("v")), "label", "left").select(*PIXEL, "label", F.coalesce("v", F.lit(NAN)).alias("v"))
