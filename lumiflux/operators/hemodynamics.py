"""Haemodynamic correction of a signal by a reference channel, haemoglobin and oxygen metabolism."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lumiflux.operators.frames import missing
from lumiflux.operators.normalise import in_baseline, with_map
from lumiflux.operators.selection import quantiles

MIN_SAMPLES = 10
INF = float("inf")


def _pairs(blue: str, green: str) -> tuple[Column, Column]:
    """The two columns, null where either is not finite: regr_* skip such pairs."""
    b, g = missing(blue), missing(green)
    return F.when(g.isNotNull(), b), F.when(b.isNotNull(), g)


def regress(pixels: DataFrame, blue: str = "blue", green: str = "green", keys: Sequence[str] = ("y", "x"), fit_intercept: bool = True) -> DataFrame:
    """pixels with alpha, beta, r2 of fit_map() and corrected = blue - alpha green - beta. Rows of all trials that share
    keys are fitted together."""
    fitted = with_map(pixels, fit_map(pixels, blue, green, keys, fit_intercept), keys)
    return fitted.withColumn("corrected", F.col(blue) - F.col("alpha") * F.col(green) - F.col("beta"))


def fit_map(pixels: DataFrame, blue: str = "blue", green: str = "green", keys: Sequence[str] = ("y", "x"), fit_intercept: bool = True) -> DataFrame:
    """alpha, beta, r2 of each pixel's least squares over its finite pairs, by one aggregate with partial sums. Fewer than
    MIN_SAMPLES pairs, or a constant reference: nothing is corrected and all three are 0."""
    b, g = _pairs(blue, green)
    rows = pixels.select(*keys, b.alias("__b"), g.alias("__g"))
    ok = (F.count("__b") >= MIN_SAMPLES) & (F.min("__g") < F.max("__g"))
    bg, gg, bb = (F.sum(F.col(x) * F.col(y)) for x, y in (("__b", "__g"), ("__g", "__g"), ("__b", "__b")))
    if fit_intercept:
        alpha, beta = F.regr_slope("__b", "__g"), F.regr_intercept("__b", "__g")
        r2 = F.when(F.min("__b") < F.max("__b"), F.regr_r2("__b", "__g")).otherwise(0.0)
    else:
        alpha, beta = F.try_divide(bg, gg), F.lit(0.0)
        total = F.var_pop("__b") * F.count("__b")
        # Residuals without intercept: sum b^2 - alpha sum b g.
        r2 = F.when(total > 0, 1 - F.try_divide(bb - alpha * bg, total)).otherwise(0.0)
    return rows.groupBy(*keys).agg(*(F.when(ok, c).otherwise(0.0).alias(n) for n, c in (("alpha", alpha), ("beta", beta), ("r2", r2))))


def regress_global(pixels: DataFrame, blue: str = "blue", green: str = "green") -> DataFrame:
    """One fit for all pixels; without a fit (no pairs or a constant reference) blue stays."""
    b, g = _pairs(blue, green)
    one = pixels.select(b.alias("__b"), g.alias("__g")).agg(F.regr_slope("__b", "__g").alias("alpha"), F.regr_intercept("__b", "__g").alias("beta"))
    joined = pixels.crossJoin(F.broadcast(one))  # a single row
    return joined.withColumn("corrected", F.coalesce(F.col(blue) - F.col("alpha") * F.col(green) - F.col("beta"), F.col(blue)))


def subtract_scaled(pixels: DataFrame, blue: str = "blue", green: str = "green", alpha: float | None = None) -> DataFrame:
    """blue - alpha green; alpha, the correlation times the ratio of deviations over all finite pairs, is the slope of
    their fit; 0.1 without any pair."""
    if alpha is not None:
        return pixels.withColumn("alpha", F.lit(float(alpha))).withColumn("corrected", F.col(blue) - F.col("alpha") * F.col(green))
    b, g = _pairs(blue, green)
    one = pixels.select(b.alias("__b"), g.alias("__g")).agg(F.when(F.count("__b") == 0, 0.1).when(F.min("__g") < F.max("__g"), F.regr_slope("__b", "__g")).alias("alpha"))
    return pixels.crossJoin(F.broadcast(one)).withColumn("corrected", F.coalesce(F.col(blue) - F.col("alpha") * F.col(green), F.col(blue)))


def correct(pixels: DataFrame, method: str = "regression", fit_intercept: bool = True, alpha: float | None = None, **columns) -> DataFrame:
    if method == "regression":
        return regress(pixels, fit_intercept=fit_intercept, **columns)
    if method == "global_regression":
        return regress_global(pixels, **columns)
    if method == "simple_subtraction":
        return subtract_scaled(pixels, alpha=alpha, **columns)
    raise ValueError(f"unknown method {method!r}")


def hbt_single(pixels: DataFrame, baseline=(0, 100), keys: Sequence[str] = ("y", "x")) -> DataFrame:
    """Total haemoglobin by one wavelength: -100 (v - b) / b; a baseline not above 0 counts as 1e-6."""
    rows = with_map(pixels, pixels.groupBy(*keys).agg(F.avg(F.when(in_baseline(baseline), F.col("v"))).alias("b")), keys)
    safe = F.when(F.col("b") <= 0, 1e-6).otherwise(F.col("b"))
    return rows.withColumn("hbt", -100 * (F.col("v") - safe) / safe).drop("b")


def optical_density(ratio: Column) -> Column:
    return F.when((ratio > 0) & (ratio < INF), -F.ln(ratio)).otherwise(0.0)


def unmixing(extinction: dict[str, tuple[float, float]], path_green: float = 0.057, path_red: float = 0.25) -> tuple[float, float, float, float]:
    """Inverse of the 2 x 2 system. extinction: (HbO, HbR) of green and of red."""
    (go, gr), (ro, rr) = extinction["green"], extinction["red"]
    a, b, c, d = rr * path_red, ro * path_red, gr * path_green, go * path_green
    det = a * d - b * c
    if det == 0:
        raise ValueError("the two wavelengths do not tell the species apart")
    return d / det, -b / det, -c / det, a / det


#: A condition number of the two wavelengths' system beyond which concentrations say little.
WORST_CONDITION = 100.0


def condition(inverse: tuple[float, float, float, float]) -> float:
    """The condition number of an unmixing: that of the system it solves."""
    a, b, c, d = inverse
    squares, det = a * a + b * b + c * c + d * d, abs(a * d - b * c)
    # Largest and smallest singular value of a 2 x 2 matrix, from its squares and its determinant.
    root = max(squares * squares - 4 * det * det, 0.0) ** 0.5
    return float("inf") if det == 0 else (squares + root) / (2 * det)


def hb_dual(pixels: DataFrame, inverse: tuple[float, float, float, float], baseline=(0, 100), keys: Sequence[str] = ("y", "x"), clip_ratio: bool = False, seen: Observation | None = None) -> DataFrame:
    """hbr, hbo, hbt in micromoles a litre from raw red and green; one aggregate for both baselines, then projections.
    A system of a condition number over WORST_CONDITION is warned of. seen, an Observation, gets n and n_clipped (ratios of
    either channel that clipping changes, or would) once an action has run: no job of its own."""
    if condition(inverse) > WORST_CONDITION:
        warnings.warn(f"the two wavelengths hardly tell the species apart: condition number {condition(inverse):.0f}", stacklevel=2)
    base = pixels.groupBy(*keys).agg(*(F.avg(F.when(in_baseline(baseline), F.col(c))).alias(f"__{c}") for c in ("green", "red")))
    rows = with_map(pixels, base, keys)
    if seen is not None:
        out = lambda c: F.count_if(~F.try_divide(F.col(c), F.col(f"__{c}")).between(0.1, 10.0))
        rows = rows.observe(seen, F.count("*").alias("n"), (out("green") + out("red")).alias("n_clipped"))
    od = {}
    for c in ("green", "red"):
        ratio = F.try_divide(F.col(c), F.col(f"__{c}"))
        if clip_ratio:
            ratio = F.greatest(F.lit(0.1), F.least(F.lit(10.0), ratio))
        od[c] = F.coalesce(optical_density(ratio), F.lit(0.0))
    i11, i12, i21, i22 = (F.lit(float(x)) for x in inverse)
    rows = rows.withColumns({"hbr": (i11 * od["red"] + i12 * od["green"]) * 1e6, "hbo": (i21 * od["red"] + i22 * od["green"]) * 1e6})
    return rows.withColumn("hbt", F.col("hbr") + F.col("hbo")).drop("__green", "__red")


def clipped_share(pixels: DataFrame, baseline=(0, 100), keys: Sequence[str] = ("y", "x"), channel: str = "v", low: float = 0.1, high: float = 10.0) -> DataFrame:
    """How many ratios to the baseline clipping would change, and their percentage."""
    base = pixels.groupBy(*keys).agg(F.avg(F.when(in_baseline(baseline), F.col(channel))).alias("__base"))
    out = with_map(pixels, base, keys).select(F.try_divide(F.col(channel), F.col("__base")).alias("r"))
    n = F.count_if((F.col("r") < low) | (F.col("r") > high))
    return out.agg(n.alias("n_clipped"), F.when(F.count("*") > 0, 100.0 * n / F.count("*")).alias("pct_clipped"))


def value_range(pixels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """1st and 99th percentile of the finite values of each signal, exact however many there are (selection.py)."""
    parts = [pixels.select(F.lit(c).alias("signal"), missing(c).alias("v")) for c in columns]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    found = quantiles(rows, "v", (0.01, 0.99), ("signal",))
    return rows.select("signal").distinct().join(F.broadcast(found), "signal", "left").select("signal", F.col("quantiles")[0].alias("p01"), F.col("quantiles")[1].alias("p99"))


def cmro2(pixels: DataFrame, baseline_hbt: float = 100e-6, baseline_so2: float = 0.6, grubb: float = 0.38, weights: tuple[float, float] = (1.0, 1.0), scale: float = 1e-6) -> DataFrame:
    """cbf and cmro2 as changes from rest, from hbr and hbt (scale brings these to mol a litre)."""
    hbr0 = baseline_hbt * (1 - baseline_so2)
    floor = F.lit(-0.9)
    r = F.greatest(floor, F.col("hbr") * scale / hbr0)
    t = F.greatest(floor, F.col("hbt") * scale / baseline_hbt)
    flow = F.pow(1 + t, F.lit(1 / grubb))
    flow = F.when(~F.isnan(flow) & (flow < INF), flow).otherwise(1.0)
    rate = flow * (1 + weights[0] * r) / F.greatest(F.lit(0.1), 1 + weights[1] * t)
    rate = F.when(~F.isnan(rate) & (F.abs(rate) < INF), rate).otherwise(1.0)
    clip = lambda c: F.greatest(floor, F.least(F.lit(5.0), c - 1))
    return pixels.withColumns({"cbf": clip(flow), "cmro2": clip(rate)})


def signals(pixels: DataFrame, method: str = "dual_wavelength", baseline=(0, 100), inverse=None, keys: Sequence[str] = ("y", "x"), **metabolism) -> DataFrame:
    """hbr, hbo, hbt, cbf, cmro2 from red and green, or hbt alone from green."""
    if method == "single_wavelength":
        return hbt_single(pixels.withColumn("v", F.col("green")), baseline, keys).drop("v")
    if method != "dual_wavelength":
        raise ValueError(f"unknown method {method!r}")
    return cmro2(hb_dual(pixels, inverse, baseline, keys), **metabolism)
