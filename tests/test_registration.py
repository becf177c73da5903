import numpy as np
import pytest
from pyspark.sql import Observation, functions as F

from lumiflux.functions import geometry, kernels
from lumiflux.operators import hemodynamics as hemo, landmarks, quality, views
from lumiflux.sources import tables


def points(spark, rng, sessions=(1, 2), n=7):
    rows = [(s, i, *map(float, rng.uniform(0, 100, 4))) for s in sessions for i in range(n)]
    return rows, spark.createDataFrame(rows, "s int, idx int, mouse_x double, mouse_y double, atlas_x double, atlas_y double").repartition(3)


@pytest.mark.parametrize("mode", landmarks.MODES)
@pytest.mark.parametrize("direction", landmarks.DIRECTIONS)
def test_fits_of_a_table_are_those_of_numpy(spark, mode, direction):
    rows, df = points(spark, np.random.default_rng(3))
    got = {r.s: r for r in landmarks.fitted(df, mode, direction, ("s",)).collect()}
    for s in (1, 2):
        own = np.array([r[2:] for r in rows if r[0] == s])
        mouse, atlas = own[:, :2], own[:, 2:]
        m = geometry.fit(mouse, atlas, mode, direction)
        assert [got[s][c] for c in landmarks.MATRIX] == pytest.approx(m[:2].ravel().tolist())
        src, dst = (atlas, mouse) if direction == "atlas_to_mouse" else (mouse, atlas)
        r = geometry.residuals(m, src, dst)
        assert (got[s].mean_residual, got[s].max_residual, got[s].std_residual) == pytest.approx((r["mean"], r["max"], r["std"]))


def test_a_mirrored_image_is_turned_not_mirrored(spark):
    rows = [(i, float(x), float(y), float(-x), float(y)) for i, (x, y) in enumerate([(0, 0), (4, 0), (4, 3), (0, 3), (1, 2)])]
    df = spark.createDataFrame(rows, "idx int, mouse_x double, mouse_y double, atlas_x double, atlas_y double")
    r = landmarks.fit(df, direction="mouse_to_atlas").first()
    want = geometry.similarity(np.array([x[1:3] for x in rows]), np.array([x[3:] for x in rows]))
    assert [r[c] for c in landmarks.MATRIX] == pytest.approx(want[:2].ravel().tolist()) and r.m00 * r.m11 - r.m01 * r.m10 > 0


def test_poor_fits_are_seen_without_a_job_of_their_own(spark):
    _, df = points(spark, np.random.default_rng(3))
    seen = Observation("fits")
    assert landmarks.fitted(df, keys=("s",), seen=seen).count() == 2
    assert seen.get["n_poor"] == 2 and seen.get["worst"] > landmarks.WORST
    exact = df.withColumns({"atlas_x": F.col("mouse_x") + 1, "atlas_y": F.col("mouse_y")})
    seen = Observation("exact")
    assert landmarks.fitted(exact, keys=("s",), seen=seen).count() == 2 and seen.get["n_poor"] == 0 and seen.get["worst"] < 1e-9


def test_too_few_or_lonely_landmarks_stop_the_plan(spark):
    _, df = points(spark, np.random.default_rng(3), (1,), 3)
    with pytest.raises(Exception, match="at least 4"):
        landmarks.fit(df).collect()
    for bad in ({"mode": "rigid"}, {"direction": "up"}):
        with pytest.raises(ValueError):
            landmarks.fit(df, **bad)
    one = spark.createDataFrame([(i, 1.0 * i, 2.0) for i in range(5)], "idx int, x double, y double")
    assert landmarks.pairs(one, one).count() == 5
    for a, b in ((one, one.where("idx > 0")), (one.where("idx > 0"), one)):
        with pytest.raises(Exception, match="landmark 0 has no partner"):
            landmarks.pairs(a, b).collect()
    same = spark.createDataFrame([(i, 1.0, 1.0, 2.0, 3.0) for i in range(4)], "idx int, mouse_x double, mouse_y double, atlas_x double, atlas_y double")
    assert landmarks.fit(same).first().m00 is None and landmarks.fit(same, "affine").first().m11 is None


def test_spectra_as_pieces(spark):
    x = np.array([450.0, 470, 485, 500, 541, 560, 600])
    y = np.random.default_rng(0).uniform(1, 9, 7)
    at = [430.0, 450.0, 469.9, 470.0, 520.0, 600.0, 640.0]
    rows = spark.createDataFrame([(i, w, "clash") for i, w in enumerate([*at, None, float("nan")])], "i int, wavelength double, start string")
    got = tables.at_wavelengths(rows, tables.spline_pieces(spark, {"hbo": (x, y), "hbr": (x, -y)}))
    assert got.columns == ["i", "wavelength", "start", "species", "extinction"]
    values = {(r.i, r.species): r.extinction for r in got.collect()}
    assert len(values) == 2 * len(at)
    for i, w in enumerate(at):
        assert values[i, "hbo"] == pytest.approx(kernels.cubic(x, y, w)) and values[i, "hbr"] == pytest.approx(-kernels.cubic(x, y, w))
    assert [kernels.cubic(x, y, v) for v in x] == pytest.approx(y)
    for bad in ((x[:3], y[:3]), (x[::-1], y)):
        with pytest.raises(ValueError):
            kernels.cubic_pieces(*bad)


def test_spectra_of_a_file(spark, tmp_path):
    from lumiflux.sources import mat

    lam = np.arange(450.0, 700, 10)
    (tmp_path / "e.mat").write_bytes(mat.encode({"lambda": lam, "eHbO2": lam**2, "eHb": 1e6 - lam**3 / 1e3}))
    rows = spark.createDataFrame([(530.0,), (625.0,)], "wavelength double")
    got = {(r.wavelength, r.species): r.extinction for r in tables.at_wavelengths(rows, tables.extinction_pieces(spark, str(tmp_path / "e.mat"))).collect()}
    want = tables.extinction(str(tmp_path / "e.mat"))
    assert (got[530.0, "hbo"], got[530.0, "hbr"]) == pytest.approx(want["green"]) and (got[625.0, "hbo"], got[625.0, "hbr"]) == pytest.approx(want["red"])


def test_a_label_that_is_missing_stops_the_query(spark):
    traces = spark.createDataFrame([(1, 0, 0.5), (1, 1, None), (2, 0, 0.1), (3, 0, 0.2)], "label int, t int, v double")
    wanted = spark.createDataFrame([(1,), (2,), (1,)], "label int")
    assert sorted((r.label, r.t) for r in views.required(wanted, traces).collect()) == [(1, 0), (1, 1), (2, 0)]
    plan = views.required(wanted.union(spark.createDataFrame([(7,)], "label int")), traces)  # no error before an action
    with pytest.raises(Exception, match="region 7 has no time course"):
        plan.collect()


def test_clipping_is_counted_and_hard_unmixing_is_warned_of(spark, recwarn):
    rows = spark.createDataFrame([(t, 0, 0, g, 1.0) for t, g in enumerate([1.0, 1.0, 50.0, 0.01, 2.0])], "t long, y int, x int, green double, red double")
    good = hemo.unmixing({"green": (39956.8, 39036.4), "red": (739.2, 5148.8)}, 1.0, 1.0)
    seen = Observation("clipped")
    assert hemo.hb_dual(rows, good, (0, 2), seen=seen).count() == 5
    assert seen.get == {"n": 5, "n_clipped": 2}
    assert hemo.condition(good) == pytest.approx(np.linalg.cond(np.array(good).reshape(2, 2))) and not recwarn.list
    bad = hemo.unmixing({"green": (1000.0, 1001.0), "red": (1000.0, 1000.0)}, 1.0, 1.0)
    with pytest.warns(UserWarning, match="condition number"):
        hemo.hb_dual(rows, bad)


def test_criteria_as_rows(spark):
    metrics = "label int, signal string, n long, snr double, cv double, outlier_fraction double, drift_r2 double, high_freq_fraction double, other double"
    rows = [(1, "Calcium", 50, 0.1, 9.0, 0.0, 0.5, 0.9, 0.0), (1, "HbO", 50, 0.35, 9.0, 0.15, 0.5, 0.45, 0.0), (1, "cmro2", 50, 0.2, float("inf"), 0.0, 1.0, 0.0, 0.0), (1, "speckle", 50, 0.29, 9.0, 0.2, 1.0, 1.0, 0.0), (2, "calcium", 50, 0.5, 5.0, 0.1, 0.3, 0.4, 0.0), (3, "calcium", 9, 0.0, 9.0, 1.0, 1.0, 1.0, 1.0), (4, "calcium", 50, float("nan"), float("nan"), None, 0.31, None, 0.0), (5, None, 50, 9.0, 8.1, 0.0, 0.0, 0.0, 0.0)]
    got = {(r.label, r.signal): r.issues for r in quality.with_issues(spark.createDataFrame(rows, metrics), ("signal", "label")).collect()}
    assert got == {
        (1, "Calcium"): ["snr=0.100 < 0.5", "cv=9.000 > 5.0", "drift_r2=0.500 > 0.3", "high_freq_fraction=0.900 > 0.4"],
        (1, "HbO"): ["drift_r2=0.500 > 0.4"],
        (1, "cmro2"): ["cv=Infinity > 15.0"],
        (1, "speckle"): ["snr=0.290 < 0.3", "cv=9.000 > 8.0", "outlier_fraction=0.200 > 0.15"],
        (2, "calcium"): [],
        (4, "calcium"): ["drift_r2=0.310 > 0.3"],
        (5, None): ["cv=8.100 > 8.0"],
    }
    own = quality.criteria_table(spark, {"other": {"other": (-1.0, "max")}})
    assert [r.issues for r in quality.with_issues(spark.createDataFrame(rows[-1:], metrics), ("label",), F.lit("x"), own).collect()] == [["other=0.000 > -1.0"]]
