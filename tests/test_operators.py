import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumiflux.operators import frames as fr, hemodynamics as hemo, images, masks, normalise, quality, warp

NAN = float("nan")


def movie(spark, stack):
    t, y, x = np.mgrid[: stack.shape[0], : stack.shape[1], : stack.shape[2]]
    return spark.createDataFrame(list(zip(t.ravel().tolist(), y.ravel().tolist(), x.ravel().tolist(), stack.astype(float).ravel().tolist())), "t long, y int, x int, v double")


def stack_of(df, shape, v="v"):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r.t, r.y, r.x] = r[v]
    return out


@pytest.fixture(scope="module")
def noise():
    return np.random.default_rng(0).uniform(1, 2, (40, 3, 4))


def test_short_cycle_and_bad_order(spark):
    f = spark.range(10).select(F.col("id").alias("frame"), F.lit(0).alias("y"), F.lit(0).alias("x"), F.lit(1.0).alias("v"))
    got = fr.separate_channels(f, 10)
    assert got.count() == 9 and got.where("channel = 'blue'").agg(F.max("t")).first()[0] == 2
    with pytest.raises(ValueError):
        fr.separate_channels(f, 10, ("a", "b"))


@pytest.mark.parametrize("k", range(-1, 5))
def test_rotation(spark, k):
    image = np.arange(15.0).reshape(1, 3, 5)
    want = np.rot90(image, k, (1, 2))
    assert (stack_of(fr.rotate(movie(spark, image), k, 3, 5), want.shape) == want).all()


def test_blocks_pads_and_nan(spark):
    image = np.arange(49.0).reshape(1, 7, 7)
    image[0, 0, 0] = np.nan
    image[0, 2:4, 2:4] = np.nan
    got = stack_of(fr.block_nanmean(movie(spark, image), 2, 2, 7, 7), (1, 3, 3))[0]
    assert got[0, 0] == pytest.approx(np.mean([1, 7, 8])) and math.isnan(got[1, 1]) and got[2, 2] == pytest.approx(np.mean([32, 33, 39, 40]))
    padded = fr.pad(movie(spark, np.ones((1, 2, 2))).drop("t"), 2, 2, 5, 4)
    assert sorted((r.y, r.x) for r in padded.where("v = 1").collect()) == [(1, 1), (1, 2), (2, 1), (2, 2)] and padded.count() == 20
    with pytest.raises(ValueError):
        fr.pad(padded, 5, 4, 3, 3)


def test_nan_weighted_resample(spark):
    image = np.ones((1, 4, 4))
    image[0, 3, 3] = np.nan
    from lumiflux.functions.kernels import axis_weights

    as_rows = lambda m: [(int(o), int(i), float(m[o, i])) for o, i in zip(*np.nonzero(m))]
    lin, near = as_rows(axis_weights(4, 2, 1, False)), as_rows(axis_weights(4, 2, 0, False))
    got = stack_of(fr.nan_weighted_resample(movie(spark, image), lin, lin, near, near), (1, 2, 2))[0]
    assert got[0, 0] == 1 and math.isnan(got[1, 1])


def test_zero_baselines(spark, noise):
    s = noise.copy()
    s[:, 1, 1] = 0
    rows = normalise.dff(movie(spark, s), (10, 30), "divide")
    f0 = s[10:30].mean(axis=0)
    assert rows.where("y = 1 and x = 1").first().f0 == pytest.approx(np.median(f0[f0 > 0]))
    assert normalise.dff(movie(spark, np.zeros((5, 2, 2))), None, "divide").first().f0 == 1
    with pytest.raises(ValueError):
        normalise.dff(rows, None, "other")


def test_rolling_start(spark):
    ramp = np.arange(1.0, 6).reshape(5, 1, 1)
    got = [r.f0 for r in normalise.dff(movie(spark, ramp), method="roll_mean", roll_window=3).orderBy("t").collect()]
    assert got == [1, 1.5, 2, 3, 4]


def test_planted_fit_and_degenerate_ones(spark):
    rng = np.random.default_rng(1)
    green = rng.uniform(0.5, 1.5, (30, 1, 4))
    blue = 0.7 * green + 0.1
    green[:, 0, 1] = 1.0
    green[9:, 0, 2] = np.nan
    blue[:, 0, 3] = 2.0
    both = movie(spark, blue).withColumnRenamed("v", "blue").join(movie(spark, green).withColumnRenamed("v", "green"), ["t", "y", "x"])
    got = {r.x: r for r in hemo.fit_map(both).collect()}
    assert (got[0].alpha, got[0].beta, got[0].r2) == pytest.approx((0.7, 0.1, 1))
    for x in (1, 2):
        assert (got[x].alpha, got[x].beta, got[x].r2) == (0, 0, 0)
    assert got[3].r2 == 0
    corrected = hemo.correct(both)
    assert corrected.where("x = 0").agg(F.max(F.abs("corrected"))).first()[0] < 1e-9
    assert corrected.where("x = 1 and corrected <> blue").count() == 0
    with pytest.raises(ValueError):
        hemo.correct(both, "other")
    nothing = both.withColumn("green", F.lit(NAN))
    assert hemo.correct(nothing, "global_regression").where("corrected <> blue").count() == 0
    assert hemo.correct(nothing, "simple_subtraction").first().alpha == pytest.approx(0.1)


def test_haemoglobin(spark):
    rows = spark.createDataFrame([(t, 0, x, g, r) for t in range(4) for x, (g, r) in enumerate([(1.0, 1.0), (0.0, 1.0), (-1.0 if t else 3.0, 1.0), (1.0 + t, 2.0 - 0.1 * t)])], "t long, y int, x int, green double, red double")
    inverse = hemo.unmixing({"green": (39956.8, 39036.4), "red": (739.2, 5148.8)})
    out = hemo.cmro2(hemo.hb_dual(rows, inverse, (0, 1)))
    got = {(r.t, r.x): r for r in out.collect()}
    for x in (0, 1):
        assert got[3, x].hbr == got[3, x].hbo == 0 and got[3, x].cmro2 == 0
    assert got[1, 2].hbo == 0 or got[1, 2].green < 0
    r = got[3, 3]
    m = np.linalg.inv(np.array([[5148.8 * 0.25, 739.2 * 0.25], [39036.4 * 0.057, 39956.8 * 0.057]]))
    hbr, hbo = m @ [-np.log(1.7 / 2), -np.log(4.0)] * 1e6
    assert (r.hbr, r.hbo, r.hbt) == pytest.approx((hbr, hbo, hbr + hbo))
    low = spark.createDataFrame([(0, -1e9, -1e9)], "k int, hbr double, hbt double")
    assert hemo.cmro2(low).first().cbf == pytest.approx(-0.9)


def test_masks_and_regions(spark):
    grid = fr.grid(spark, 6, 8)
    atlas = grid.withColumn("label", F.when(F.col("x") < 4, 1).otherwise(2)).where("not (y = 5 and x = 7)")
    pixels = movie(spark, np.ones((2, 6, 8))).withColumn("v", F.when((F.col("x") == 0) & (F.col("t") == 0), F.lit(NAN)).otherwise(F.col("v")))
    got = masks.timecourses(pixels, atlas, min_overlap=24)
    assert {r.label for r in got.collect()} == {1} and all(r.v == 1 for r in got.collect())
    dead = pixels.withColumn("v", F.lit(NAN))
    assert all(math.isnan(r.v) for r in masks.timecourses(dead, atlas, min_overlap=1).collect())
    square = spark.createDataFrame([(1, 0, 0.5, 0.5), (1, 1, 3.5, 0.5), (1, 2, 3.5, 3.5), (1, 3, 0.5, 3.5), (2, 0, 5.0, 5.0), (2, 1, 6.0, 6.0)], "polygon_id int, vertex int, x double, y double")
    assert sorted((r.y, r.x) for r in masks.polygon(grid, square).collect()) == [(y, x) for y in (1, 2, 3) for x in (1, 2, 3)]
    assert masks.polygon(grid, square.limit(0)).count() == 0
    nan_atlas = spark.createDataFrame([(0, 0, NAN), (0, 1, 2.0), (0, 2, 0.0)], "y int, x int, label double")
    assert [(r.y, r.x) for r in masks.footprint(nan_atlas).collect()] == [(0, 1)]


def test_quality_flags_at_thresholds(spark):
    table = spark.createDataFrame([(1, 20, 0.5, 5.0, 0.1, 0.3), (2, 20, 0.49, 5.01, 0.11, 0.31), (3, 20, NAN, NAN, 0.0, 0.0), (4, 9, 0.0, 9.0, 1.0, 1.0)], "label int, n long, snr double, cv double, outlier_fraction double, drift_r2 double")
    got = {r.label: r.issues for r in quality.issues(table).collect()}
    assert got == {1: [], 2: ["snr=0.490 < 0.5", "cv=5.010 > 5.0", "outlier_fraction=0.110 > 0.1", "drift_r2=0.310 > 0.3"], 3: []}
    s = quality.summary(quality.issues(table)).first()
    assert (s.total_rois, s.problematic_rois) == (3, 1)
    assert [r.issue for r in quality.issue_counts(quality.issues(table)).collect()] == ["snr", "cv", "outlier_fraction", "drift_r2"]
    assert quality.criteria("HbO")["cv"] == (10.0, "max") and "drift_r2" not in quality.criteria("x")


def test_metrics_of_a_constant_and_comparison(spark):
    rows = [("calcium", 1, t, 2.0) for t in range(12)] + [("hbo", 1, t, float((-1) ** t * (1 + t))) for t in range(12)]
    df = spark.createDataFrame(rows, "signal string, label int, t long, v double")
    m = quality.metrics(df, ("signal", "label")).where("signal = 'calcium'").first()
    assert (m.snr, m.cv, m.outlier_fraction, m.max_jump) == (0, 0, 0, 0)
    assert {r.signal: r.problematic_rois for r in quality.compare(df, ("calcium", "hbo")).collect()} == {"calcium": 1, "hbo": 1}


def test_warp_identity_and_shift(spark, noise):
    pixels = movie(spark, noise)
    same = warp.warp(pixels, np.eye(3), (3, 4), (3, 4))
    assert np.allclose(stack_of(same, noise.shape), noise)
    moved = warp.fill(warp.warp(pixels, np.array([[1, 0, 1], [0, 1, 0], [0, 0, 1.0]]), (3, 4), (3, 4)), (3, 4))
    got = stack_of(moved, noise.shape)
    assert np.allclose(got[:, :, :3], noise[:, :, 1:]) and np.isnan(got[:, :, 3]).all()


def test_frames_through_kernels(spark, noise):
    from lumiflux.functions import kernels

    y, x = np.mgrid[:32, :32]
    base = np.exp(-((y - 14) ** 2 + (x - 17) ** 2) / 18)
    shifts = [(0.0, 0.0), (1.3, -2.7), (-3.0, 0.4)]
    frames = spark.createDataFrame([(i, kernels.fourier_shift(base, *s).ravel().tolist()) for i, s in enumerate(shifts)], "t long, img array<double>")
    got = {r.t: r for r in images.motion_correct(frames, 32, 32, base).collect()}
    for i, s in enumerate(shifts):
        assert (got[i].dy, got[i].dx) == pytest.approx((-s[0], -s[1]), abs=0.1)
    small = images.downsample(frames, 32, 32, scale=0.5).first()
    assert len(small.img) == 256
    traces = movie(spark, noise)
    out = stack_of(images.filtered(traces, 10.0, 0.5, 2.0), noise.shape)
    assert np.allclose(out, kernels.zero_phase(noise.reshape(40, -1), *kernels.butterworth(3, 0.5, 2.0, 10.0)).reshape(noise.shape))
    assert images.filtered(traces, 10.0) is traces
    whole = fr.to_pixels(fr.to_frames(traces, ("t",)), 4)
    assert np.allclose(stack_of(whole, noise.shape), noise)


def test_brain_masks(spark):
    y, x = np.mgrid[:40, :40]
    disc = ((y - 20) ** 2 + (x - 20) ** 2 < 150) * 9.0 + np.random.default_rng(0).uniform(0, 1, (40, 40))
    image = movie(spark, disc[None]).drop("t")
    options = {"top_hat": 30, "low_percentile": 70, "close": 2, "open_": 1, "least": 20}
    auto = {(r.y, r.x) for r in images.brain_mask(image, 40, 40, **options).collect()}
    assert (20, 20) in auto and (1, 1) not in auto
    corner = spark.createDataFrame([(1, 0, -0.5, -0.5), (1, 1, 39.5, -0.5), (1, 2, 39.5, 20.5), (1, 3, -0.5, 20.5)], "polygon_id int, vertex int, x double, y double")
    cut = {(r.y, r.x) for r in images.brain_mask(image, 40, 40, "hybrid", subtract=corner, **options).collect()}
    assert cut and max(auto) == max(cut) and min(cut)[0] > 17
    assert images.brain_mask(image, 40, 40, "manual", add=corner).count() == 40 * 21
    atlas = fr.grid(spark, 4, 4).withColumn("label", F.col("x"))
    assert images.brain_mask(image, 40, 40, "simple", atlas=atlas).count() == 12
    for bad in ("manual", "other"):
        with pytest.raises(ValueError):
            images.brain_mask(image, 40, 40, bad)


def test_downsampling_with_missing_pixels(spark):
    s = np.arange(36.0).reshape(1, 6, 6)
    s[0, 0, 0] = np.nan
    half = stack_of(fr.downsample_nanmean(movie(spark, s), 6, 6, 0.5), (1, 3, 3))[0]
    assert half[0, 0] == pytest.approx(np.mean([1, 6, 7]))
    near = stack_of(fr.downsample_nanmean(movie(spark, s), 6, 6, 0.5, order=0), (1, 3, 3))[0]
    assert near[1, 1] == s[0, 3, 3]
    odd = stack_of(fr.downsample_nanmean(movie(spark, s), 6, 6, target=(4, 4)), (1, 4, 4))[0]
    assert np.isnan(odd[0, 0]) and np.isfinite(odd[2, 2])
    with pytest.raises(ValueError):
        fr.downsample_nanmean(movie(spark, s), 6, 6)


def test_full_report(spark):
    from lumiflux.operators import views

    rng = np.random.default_rng(4)
    tr = spark.createDataFrame([(l, t, float(v)) for l in (1, 2) for t, v in enumerate(5 + rng.standard_normal(80))], "label int, t long, v double")
    atlas = fr.grid(spark, 3, 3).withColumn("label", F.col("x"))
    out = views.full_report({"calcium": tr, "hbo": tr.withColumn("v", F.col("v") - 5)}, atlas, fs=10.0)
    told = {r.signal: r.problematic_rois for r in out["comparison"].collect()}
    assert told == {k: out[f"{k}_issues"].where("size(issues) > 0").count() for k in ("calcium", "hbo")}
    assert out["metrics"].count() == 4 and "high_freq_fraction" in out["metrics"].columns
    assert {r.signal for r in out["comparison"].collect()} == {"calcium", "hbo"}
    assert out["calcium_snr_map"].count() == 9 and out["hbo_issues"].count() == 2


@pytest.mark.parametrize("order", range(6))
def test_frames_and_pixels_warp_alike(spark, order):
    import numpy as np

    from lumiflux.functions import geometry, kernels
    from lumiflux.operators import warp

    rng = np.random.default_rng(order)
    frames = rng.normal(size=(4, 9, 11))
    frames[2, 4, 5] = np.nan
    m = np.array([[0.95, -0.1, 0.8], [0.1, 0.95, -0.3], [0, 0, 1.0]])
    df = spark.createDataFrame([(i, [float(v) for v in f.ravel()]) for i, f in enumerate(frames)], "t long, img array<double>")
    at, place, w = geometry.warp_stencil(m, (8, 10), (9, 11), order)
    got = {r.t: np.array(r.img, float) for r in warp.warp_frames(df, m, (8, 10), (9, 11), order).collect()}
    for t, image in enumerate(frames):
        flat = kernels.spline_filter(kernels.spline_filter(image, order).T, order).T.ravel() if order in (2, 4, 5) else image.ravel()
        want = np.full(80, np.nan)
        want[at] = (w * flat[place]).sum(axis=1)
        want = np.clip(want, np.nanmin(image), np.nanmax(image)) if order > 1 else want
        assert np.allclose(got[t], want, equal_nan=True)
    if order in (0, 1, 3):
        pixels = fr.to_pixels(df, 11)
        rows = {(r.t, r.y, r.x): r.v for r in warp.fill(warp.warp(pixels, m, (8, 10), (9, 11), order), (8, 10)).collect()}
        assert all(np.isclose(rows[t, i // 10, i % 10], v, equal_nan=True) for t, image in got.items() for i, v in enumerate(image))
    else:
        with pytest.raises(ValueError):
            warp.warp(fr.to_pixels(df, 11), m, (8, 10), (9, 11), order)
