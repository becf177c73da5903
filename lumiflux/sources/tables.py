"""Label texts, region metadata, extinction spectra, configuration, and parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession, functions as F

from lumiflux.functions.kernels import cubic, cubic_pieces
from lumiflux.sources import mat
from lumiflux.sources.files import read_bytes


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """idx, name: lines that begin with a whole number; the last line of a number wins. clean_name is the quoted part."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line"))
    parts = lines.select("line", "value", F.split(F.trim("value"), r"\s+").alias("p"))
    named = parts.select("line", "value", F.expr("try_cast(p[0] AS INT)").alias("idx"), F.array_join(F.slice("p", 2, 1_000_000), " ").alias("name")).where("idx IS NOT NULL")
    quoted = F.regexp_extract("value", '"([^"]*)"', 1)
    named = named.withColumn("clean_name", F.when(quoted != "", quoted).otherwise(F.col("name")))
    return named.groupBy("idx").agg(F.max_by("name", "line").alias("name"), F.max_by("clean_name", "line").alias("clean_name"))


ROI_META = "Idx INT, ROI_name STRING, Hemisphere STRING, Allen_ID INT, Allen_acronym STRING, Allen_name STRING"


def read_roi_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Keyed by Idx: the atlas's own number repeats between hemispheres."""
    return spark.read.option("header", True).option("encoding", "UTF-8").schema(ROI_META).csv(path)


def extinction(path: str, green: float = 530, red: float = 625) -> dict[str, tuple[float, float]]:
    """(HbO, HbR) at the two wavelengths, by cubic interpolation of the vectors lambda, eHbO2 and eHb."""
    a = {k: v.ravel().astype(float) for k, v in mat.load(path).items() if v.dtype.kind in "fiu"}
    return {n: (cubic(a["lambda"], a["eHbO2"], w), cubic(a["lambda"], a["eHb"], w)) for n, w in (("green", green), ("red", red))}


def extinction_at(path: str, wavelength: float, species: str = "hbo") -> float:
    keys = {"hbo": "eHbO2", "hbr": "eHb"}
    if species.lower() not in keys:
        raise ValueError(f"unknown species {species!r}")
    a = mat.load(path)
    return cubic(a["lambda"].ravel(), a[keys[species.lower()]].ravel(), wavelength)


PIECES = "species string, low double, high double, start double, c0 double, c1 double, c2 double, c3 double"


def spline_pieces(spark: SparkSession, curves: dict[str, tuple[Sequence[float], Sequence[float]]]) -> DataFrame:
    """Not-a-knot cubics through the points (x, y) of each curve as rows, one a piece with its range low <= x < high; the
    outer ones are open, which extends the curve. A curve is a measured spectrum: some hundred points."""
    rows = []
    for name, (x, y) in curves.items():
        pieces = cubic_pieces(x, y).tolist()
        ends = [float("-inf"), *(p[0] for p in pieces[1:]), float("inf")]
        rows += [(name, low, high, *piece) for low, high, piece in zip(ends, ends[1:], pieces)]
    return spark.createDataFrame(rows, PIECES)


def extinction_pieces(spark: SparkSession, path: str) -> DataFrame:
    """The spectra of a file, hbo and hbr, as spline pieces."""
    a = {k: v.ravel().astype(float) for k, v in mat.load(path).items() if v.dtype.kind in "fiu"}
    return spline_pieces(spark, {"hbo": (a["lambda"], a["eHbO2"]), "hbr": (a["lambda"], a["eHb"])})


def at_wavelengths(rows: DataFrame, pieces: DataFrame, wavelength: str = "wavelength") -> DataFrame:
    """rows, once for each curve, with species and extinction at their wavelength: an interval join with the pieces, which
    are few and broadcast. Null and NaN wavelengths meet no piece."""
    own = pieces.select(F.col("species").alias("__species"), *(F.col(c).alias(f"__{c}") for c in ("low", "high", "start", "c0", "c1", "c2", "c3")))
    w = F.col(wavelength).cast("double")
    met = rows.join(F.broadcast(own), (w >= F.col("__low")) & (w < F.col("__high")) & ~F.isnan(w))
    u = w - F.col("__start")
    value = F.col("__c0") + u * (F.col("__c1") + u * (F.col("__c2") + u * F.col("__c3")))
    return met.select(*(F.col(c) for c in rows.columns), F.col("__species").alias("species"), value.alias("extinction"))


@dataclass
class Config:
    """A session's settings, by the names of the configuration file's sections."""

    movie: str
    trials: bool = False
    experiment: str = "task"
    factor: float = 0.5
    per_cycle: int = 3
    order: tuple[str, ...] = ("green", "red", "blue")
    fs: float = 10.0
    upsample: dict[str, int] = field(default_factory=lambda: {"blue": 10, "green": 10, "red": 10})
    baseline: tuple[int, int] = (10, 100)
    method: str = "divide"
    rotate: int = 1
    highpass: float | None = 0.02
    lowpass: float | None = 2.0
    correction: str = "regression"
    template: str | None = None
    atlas: str | None = None
    labels: str | None = None
    fit: str = "similarity"
    direction: str = "atlas_to_mouse"
    min_overlap: int = 25
    hemo_method: str = "dual_wavelength"
    hemo_baseline: tuple[int, int] = (10, 100)
    hemo_min_overlap: int = 25
    extinction: str | None = None
    green_nm: float = 530
    red_nm: float = 625
    outputs: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.experiment not in ("task", "rest"):
            raise ValueError(f"unknown experiment type {self.experiment!r}")
        if len(self.order) != self.per_cycle:
            raise ValueError("the channel order and the frames of a cycle differ in number")


def resolve(path: str) -> Path:
    """Relative paths are looked for beside this library's folder, then in the working folder."""
    p = Path(path)
    if p.is_absolute():
        return p
    beside = Path(__file__).resolve().parents[2] / p
    return beside if beside.exists() else Path.cwd() / p


def read_config(path: str) -> Config:
    c = yaml.safe_load(read_bytes(path if "://" in path else str(resolve(path))))
    n, h, a, out = c["normalization"], c.get("hemodynamic_extraction", {}), c["atlas"], c["output"]
    known = {
        "movie": c["data"]["filepath"],
        "trials": bool(c["data"].get("trials", False)),
        "experiment": c["experiment"]["type"],
        "factor": c["downsampling"]["factor"],
        "per_cycle": c["channel_separation"]["frames_per_cycle"],
        "order": tuple(c["channel_separation"]["order"]),
        "fs": c["channel_separation"]["fs"],
        "upsample": c["upsample_factor"],
        "baseline": tuple(n["baseline_frames"]),
        "method": n["method"],
        "rotate": n["rotate"],
        "highpass": n.get("highpass"),
        "lowpass": n.get("lowpass"),
        "correction": c["hemodynamic_correction"]["method"],
        "template": c.get("template", {}).get("filepath"),
        "atlas": a["filepath"],
        "labels": a.get("labels"),
        "fit": a.get("method", "similarity"),
        "direction": a.get("registration_direction", "atlas_to_mouse"),
        "min_overlap": c["roi_extraction"]["min_overlap"],
        "outputs": {k: f"{out['dir'].rstrip('/')}/{v.removesuffix('.pkl')}" for k, v in out.items() if k != "dir"},
    }
    if h:
        w = c.get("wavelength", {})
        known |= {"hemo_method": h["method"], "hemo_baseline": tuple(h["baseline_frames"]), "hemo_min_overlap": h["min_overlap"], "extinction": h.get("extinction_filepath"), "green_nm": w.get("green", 530), "red_nm": w.get("red", 625)}
    return Config(**known)


def write(datasets: dict[str, DataFrame], outputs: dict[str, str]) -> None:
    """Each data set as parquet in the folder named for it; those without a name are left out."""
    for key, df in datasets.items():
        if key in outputs:
            df.write.mode("overwrite").parquet(outputs[key])
