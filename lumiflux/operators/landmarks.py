"""Landmark fits as plans: pairs of points in a table, a transform and its residuals out of aggregated moments.

Pairs (idx, mouse_x, mouse_y, atlas_x, atlas_y), with any number of keys (a session, an animal) that tell fits apart.
The least-squares similarity has a closed form in the plane: with centred points s and d, a = sum(s . d) / sum |s|^2 and
b = sum(s x d) / sum |s|^2 are its scaled cosine and sine. The affine map solves the normal equations of the same moments.
Nothing is collected; a transform is one row a fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lumiflux.functions.geometry import MIN_POINTS

MODES, DIRECTIONS = ("similarity", "affine"), ("atlas_to_mouse", "mouse_to_atlas")
#: Residuals above so many pixels are worth a warning.
WORST = 20.0
MATRIX = ("m00", "m01", "m02", "m10", "m11", "m12")


def pairs(mouse: DataFrame, atlas: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Points (keys, idx, x, y) of both images, matched by their index; one without a partner stops the plan."""
    a = mouse.select(*keys, "idx", F.col("x").alias("mouse_x"), F.col("y").alias("mouse_y"))
    b = atlas.select(*keys, "idx", F.col("x").alias("atlas_x"), F.col("y").alias("atlas_y"))
    both = a.join(b, [*keys, "idx"], "full")
    alone = F.col("mouse_x").isNull() | F.col("atlas_x").isNull()
    return both.withColumn("mouse_x", F.when(alone, F.raise_error(F.format_string("landmark %s has no partner", F.col("idx").cast("string"))).cast("double")).otherwise(F.col("mouse_x")))


def _named(points: DataFrame, direction: str, keys: Sequence[str]) -> DataFrame:
    if direction not in DIRECTIONS:
        raise ValueError(f"unknown direction {direction!r}")
    s, d = ("atlas", "mouse") if direction == "atlas_to_mouse" else ("mouse", "atlas")
    return points.select(*keys, *(F.col(f"{p}_{c}").cast("double").alias(f"{q}{c}") for p, q in ((s, "s"), (d, "d")) for c in "xy"))


def fit(points: DataFrame, mode: str = "similarity", direction: str = "atlas_to_mouse", keys: Sequence[str] = ()) -> DataFrame:
    """keys, n and the rows m00 m01 m02, m10 m11 m12 of the matrix on (x, y). Fewer than MIN_POINTS pairs stop the plan;
    points in one place (or, for affine maps, on one line) have null coefficients."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    rows = _named(points, direction, keys)
    cov = lambda a, b: F.covar_pop(a, b)
    moments = rows.groupBy(*keys).agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in ("sx", "sy", "dx", "dy")), *(cov(a, b).alias(a + b) for a, b in (("sx", "sx"), ("sy", "sy"), ("sx", "sy"), ("sx", "dx"), ("sx", "dy"), ("sy", "dx"), ("sy", "dy"))))
    enough = moments.withColumn("n", F.when(F.col("n") < MIN_POINTS, F.raise_error(f"at least {MIN_POINTS} landmarks are needed").cast("long")).otherwise(F.col("n")))
    c = F.col
    if mode == "similarity":
        spread = c("sxsx") + c("sysy")
        cosine, sine = F.try_divide(c("sxdx") + c("sydy"), spread), F.try_divide(c("sxdy") - c("sydx"), spread)
        linear = [cosine, -sine, sine, cosine]
    else:
        det = c("sxsx") * c("sysy") - c("sxsy") * c("sxsy")
        row = lambda d: (F.try_divide(c(f"sx{d}") * c("sysy") - c(f"sy{d}") * c("sxsy"), det), F.try_divide(c(f"sy{d}") * c("sxsx") - c(f"sx{d}") * c("sxsy"), det))
        linear = [*row("dx"), *row("dy")]
    done = enough.select(*keys, "n", "sx", "sy", "dx", "dy", *(v.alias(n) for n, v in zip(("m00", "m01", "m10", "m11"), linear)))
    shift = lambda d, a, b: (c(d) - c(a) * c("sx") - c(b) * c("sy"))
    return done.withColumns({"m02": shift("dx", "m00", "m01"), "m12": shift("dy", "m10", "m11")}).select(*keys, "n", *MATRIX)


def _distance() -> Column:
    c = F.col
    return F.hypot(c("m00") * c("sx") + c("m01") * c("sy") + c("m02") - c("dx"), c("m10") * c("sx") + c("m11") * c("sy") + c("m12") - c("dy"))


def fitted(points: DataFrame, mode: str = "similarity", direction: str = "atlas_to_mouse", keys: Sequence[str] = (), seen: Observation | None = None) -> DataFrame:
    """fit() with mean, max and std of the residuals. seen, an Observation, gets n_poor, the number of fits whose largest
    residual is above WORST, and worst, when an action has run."""
    rows, m = _named(points, direction, keys), fit(points, mode, direction, keys)
    joined = rows.join(m, list(keys)) if keys else rows.crossJoin(F.broadcast(m))  # a single row
    first = [F.first(x).alias(x) for x in ("n", *MATRIX)]
    r = _distance()
    out = joined.groupBy(*keys).agg(*first, F.avg(r).alias("mean_residual"), F.max(r).alias("max_residual"), F.stddev_pop(r).alias("std_residual"))
    return out if seen is None else out.observe(seen, F.count_if(F.col("max_residual") > WORST).alias("n_poor"), F.max("max_residual").alias("worst"))
