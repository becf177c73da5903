"""Signal quality of traces (label, t, v): metrics, criteria, flags, summaries, and the data behind the usual plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from lumiflux.operators.frames import missing

METRICS = ("mean", "std", "snr", "range", "cv", "drift_slope", "drift_magnitude", "drift_r2", "max_jump", "mean_abs_diff", "outlier_fraction")
MIN_POINTS, SIGMAS = 10, 3.0

# Quality thresholds by class of signal.
CRITERIA = {
    "calcium": {"snr": (0.5, "min"), "cv": (5.0, "max"), "outlier_fraction": (0.1, "max"), "drift_r2": (0.3, "max"), "high_freq_fraction": (0.4, "max")},
    "haemoglobin": {"snr": (0.3, "min"), "cv": (10.0, "max"), "outlier_fraction": (0.15, "max"), "drift_r2": (0.4, "max"), "high_freq_fraction": (0.5, "max")},
    "metabolism": {"snr": (0.2, "min"), "cv": (15.0, "max"), "outlier_fraction": (0.2, "max"), "high_freq_fraction": (0.6, "max")},
    "other": {"snr": (0.3, "min"), "cv": (8.0, "max"), "outlier_fraction": (0.15, "max")},
}
CLASSES = {"calcium": "calcium", "hbo": "haemoglobin", "hbr": "haemoglobin", "hbt": "haemoglobin", "cmro2": "metabolism", "cbf": "metabolism"}


def criteria(signal: str) -> dict[str, tuple[float, str]]:
    return CRITERIA[CLASSES.get(signal.lower(), "other")]


def metrics(traces: DataFrame, keys: Sequence[str] = ("label",)) -> DataFrame:
    """One row a trace with METRICS and n. One shuffle by trace: windows first, then one aggregate over the same keys."""
    own = W.partitionBy(*keys)
    step = F.abs(F.col("v") - F.lag("v").over(own.orderBy("t")))
    place = F.row_number().over(own.orderBy("t")) - 1
    rows = traces.select(*keys, "t", "v", step.alias("jump"), place.alias("i"), F.avg("v").over(own).alias("m"), F.stddev_pop("v").over(own).alias("s"))
    mean, std, n = F.avg("v"), F.stddev_pop("v"), F.count("*")
    slope = F.regr_slope("v", F.col("i").cast("double"))
    r2 = F.when(F.min("v") < F.max("v"), F.regr_r2("v", F.col("i").cast("double")))
    columns = {
        "n": n,
        "mean": mean,
        "std": std,
        "snr": F.when(std > 0, F.try_divide(F.abs(mean), std)).otherwise(0.0),
        "range": F.max("v") - F.min("v"),
        "cv": F.when(mean != 0, F.try_divide(std, F.abs(mean))).otherwise(float("inf")),
        "drift_slope": slope,
        "drift_magnitude": F.abs(slope * n),
        "drift_r2": r2,
        "max_jump": F.max("jump"),
        "mean_abs_diff": F.avg("jump"),
        "outlier_fraction": F.avg((F.abs(F.col("v") - F.col("m")) > SIGMAS * F.col("s")).cast("double")),
    }
    return rows.groupBy(*keys).agg(*(c.alias(k) for k, c in columns.items()))


def tall(table: DataFrame, keys: Sequence[str] = ("label",), names: Sequence[str] = METRICS) -> DataFrame:
    return table.unpivot(list(keys), list(names), "metric", "value")


def across(table: DataFrame, keys: Sequence[str] = ("label",), names: Sequence[str] = METRICS) -> DataFrame:
    """Median, mean, deviation, least and largest of each metric over traces of MIN_POINTS or more, finite values only."""
    rows = tall(table.where(F.col("n") >= MIN_POINTS), keys, names).select("metric", missing("value").alias("value")).where("value is not null")
    return rows.groupBy("metric").agg(F.median("value").alias("median"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))


CRITERIA_COLUMNS = "class string, place int, metric string, threshold double, direction string"


def criteria_table(spark: SparkSession, given: dict[str, dict[str, tuple[float, str]]] = CRITERIA) -> DataFrame:
    """Criteria as rows: class, place (their order within it), metric, threshold and direction (min or max)."""
    rows = [(kind, i, m, float(t), d) for kind, own in given.items() for i, (m, (t, d)) in enumerate(own.items())]
    return spark.createDataFrame(rows, CRITERIA_COLUMNS)


def class_of(signal: Column) -> Column:
    """The class of criteria of a signal, in any case; other for those unknown."""
    named = F.create_map(*(F.lit(x) for pair in CLASSES.items() for x in pair))
    return F.coalesce(F.try_element_at(named, F.lower(signal)), F.lit("other"))


def with_issues(table: DataFrame, keys: Sequence[str] = ("label",), signal: str | Column = "signal", given: DataFrame | None = None) -> DataFrame:
    """Metrics of traces of MIN_POINTS or more with their issues, in the order of the criteria of each one's signal: the
    metrics as rows meet the criteria of their class, and those beyond a threshold are kept. NaN is never an issue; a
    metric without a column, or without a criterion, is not judged. One plan for all classes."""
    rows = table.where(F.col("n") >= MIN_POINTS)
    given = criteria_table(table.sparkSession) if given is None else given
    names = [c for c in table.columns if c not in (*keys, "n", "signal", "issues") and table.schema[c].dataType.simpleString() == "double"]
    kind = class_of(F.col(signal) if isinstance(signal, str) else signal)
    tall_rows = rows.select(*keys, kind.alias("class"), *names).unpivot([*keys, "class"], names, "metric", "value")
    met = tall_rows.join(F.broadcast(given), ["class", "metric"])  # the criteria: a few rows a class
    beyond = F.when(F.col("direction") == "max", F.col("value") > F.col("threshold")).otherwise(F.col("value") < F.col("threshold"))
    text = F.format_string("%s=%.3f %s %s", F.col("metric"), F.col("value"), F.when(F.col("direction") == "max", ">").otherwise("<"), F.col("threshold").cast("string"))
    # One entry a criterion of the class at most.
    found = met.where(~F.isnan("value") & beyond).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("place", text.alias("text")))).alias("__found"))
    listed = F.coalesce(F.transform("__found", lambda x: x.text), F.array().cast("array<string>"))
    found = found.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return rows.join(found, same, "left").withColumn("issues", listed).drop("__found", *(f"__{k}" for k in keys))


def issues(table: DataFrame, signal: str = "calcium") -> DataFrame:
    """The issues of each trace of MIN_POINTS or more of one signal."""
    keys = ("signal", "label") if "signal" in table.columns else ("label",)
    return with_issues(table, keys, F.lit(signal))


def summary(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    bad = F.count_if(F.size("issues") > 0)
    n = F.count("*")
    return flagged.groupBy(*by).agg(n.alias("total_rois"), (n - bad).alias("good_rois"), bad.alias("problematic_rois"), F.when(n > 0, (n - bad) / n).otherwise(0.0).alias("quality_fraction"))


def issue_counts(flagged: DataFrame, top: int = 5, order: str = "label") -> DataFrame:
    """The commonest issues; ties by where they are first seen."""
    rows = flagged.select(order, F.posexplode("issues").alias("k", "issue")).select(order, "k", F.split("issue", "=")[0].alias("issue"))
    counted = rows.groupBy("issue").agg(F.count("*").alias("n"), F.min(F.struct(order, "k")).alias("first"))
    return counted.orderBy(F.desc("n"), "first").limit(top).select("issue", "n")


def assess(traces: DataFrame, signal: str = "calcium") -> DataFrame:
    return issues(metrics(traces), signal)


def compare(traces: DataFrame, signals: Sequence[str]) -> DataFrame:
    """Summaries of several signals (column signal): one metrics pass for all, then each signal's criteria."""
    return compare_table(metrics(traces, ("signal", "label")), signals)


def compare_table(table: DataFrame, signals: Sequence[str]) -> DataFrame:
    """The same from a table of metrics, spectra included if it has them."""
    return summary(with_issues(table.where(F.col("signal").isin(*signals)), ("signal", "label")), ("signal",))


def extremes(flagged: DataFrame, n_good: int = 3, n_bad: int = 3) -> DataFrame:
    """The best good traces and the worst bad ones by signal-to-noise."""
    good = flagged.where(F.size("issues") == 0).orderBy(F.desc("snr"), "label").limit(n_good).select("label", "snr", F.lit("good").alias("kind"))
    bad = flagged.where(F.size("issues") > 0).orderBy("snr", "label").limit(n_bad).select("label", "snr", F.lit("bad").alias("kind"))
    return good.unionByName(bad)


def histogram(table: DataFrame, metric: str, bins: int = 20) -> DataFrame:
    """Counts of equal bins between the least and the largest value, the last one closed."""
    rows = table.select(missing(metric).alias("v")).where("v is not null")
    ends = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins))).otherwise(0)
    return rows.crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def spectra(traces: DataFrame, fs: float, keys: Sequence[str] = ("label",)) -> DataFrame:
    """Welch spectrum of each trace: dominant frequency and shares of power by band. A trace is one group."""
    import pandas as pd

    from lumiflux.functions.kernels import band_shares

    kinds = {f.name: f.dataType.simpleString() for f in traces.schema if f.name in keys}
    schema = ", ".join(f"{k} {t}" for k, t in kinds.items()) + ", dominant_frequency double, low_freq_fraction double, physio_freq_fraction double, high_freq_fraction double"

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf.sort_values("t")["v"].to_numpy(float)
        return pd.DataFrame([dict(zip(keys, key)) | band_shares(v, fs)]) if len(v) >= MIN_POINTS else pd.DataFrame()

    return traces.select(*keys, "t", "v").groupBy(*keys).applyInPandas(one, schema)
