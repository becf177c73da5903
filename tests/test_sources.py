import numpy as np
import pytest

from lumiflux.functions import kernels
from lumiflux.plans import pipeline
from lumiflux.sources import mat, tables, tiff


@pytest.mark.parametrize("dtype", ["uint8", "uint16", "int16", "float32"])
@pytest.mark.parametrize("deflate,big", [(False, False), (True, True)])
def test_tiff_round_trip(spark, tmp_path, dtype, deflate, big):
    stack = np.random.default_rng(0).uniform(0, 100, (7, 5, 6)).astype(dtype)
    (tmp_path / "m.tif").write_bytes(tiff.encode(stack, deflate, big))
    df = tiff.read_stack(spark, str(tmp_path / "m.tif"), frames_per_partition=3)
    assert df.rdd.getNumPartitions() == 3
    rows = df.orderBy("frame").collect()
    assert [(r.h, r.w) for r in rows] == [(5, 6)] * 7
    assert np.allclose(np.array([r.img for r in rows]).reshape(stack.shape), stack)


@pytest.mark.parametrize("compress", [False, True])
def test_mat_round_trip(tmp_path, compress):
    arrays = {"data": np.arange(12.0).reshape(3, 4), "label": np.array([[1, 2], [3, 4]], "int16"), "m": np.eye(2, dtype=bool)}
    (tmp_path / "a.mat").write_bytes(mat.encode(arrays, compress))
    got = mat.load(str(tmp_path / "a.mat"))
    assert set(got) == set(arrays) and all((got[k] == arrays[k]).all() for k in arrays)
    assert mat.load(str(tmp_path / "a.mat"), "data").shape == (3, 4)
    mat.save(str(tmp_path / "b.mat"), {"v": np.arange(3)})
    assert mat.load(str(tmp_path / "b.mat"), "v").tolist() == [[0, 1, 2]]
    with pytest.raises(ValueError):
        mat.decode(b"\x89HDF\r\n\x1a\n" + b"0" * 200)


def test_labels_and_metadata(spark, tmp_path):
    (tmp_path / "l.txt").write_text('# comment\n  0  0 0 0 0 0 0 "Clear Label"\n 1 255 0 0 1 1 1 "MOp"\n\nx y\n 1 9 0 0 1 1 1 "MOs left"\n')
    got = {r.idx: (r.name, r.clean_name) for r in tables.read_labels(spark, str(tmp_path / "l.txt")).collect()}
    assert got == {0: ('0 0 0 0 0 0 "Clear Label"', "Clear Label"), 1: ('9 0 0 1 1 1 "MOs left"', "MOs left")}
    (tmp_path / "r.csv").write_bytes("﻿Idx,ROI_name,Hemisphere,Allen_ID,Allen_acronym,Allen_name\r\n1,a,L,7,A,area a\r\n32,a,R,7,A,area a\r\n".encode())
    rows = tables.read_roi_metadata(spark, str(tmp_path / "r.csv")).collect()
    assert [(r.Idx, r.Allen_ID) for r in rows] == [(1, 7), (32, 7)]


CONFIG = """
data: {{filepath: "{d}/{movie}", trials: {trials}}}
experiment: {{type: "{kind}"}}
downsampling: {{factor: 0.5}}
channel_separation: {{frames_per_cycle: 3, order: ["green", "red", "blue"], fs: 10}}
upsample_factor: {{blue: 10, green: 10, red: 10}}
normalization: {{baseline_frames: [2, 12], method: "divide", rotate: 1, highpass: 0.5, lowpass: 2.0}}
hemodynamic_correction: {{method: "regression"}}
template: {{filepath: "{d}/t.mat"}}
atlas: {{filepath: "{d}/a.mat", labels: "{d}/l.txt", method: "similarity", registration_direction: "{direction}"}}
roi_extraction: {{min_overlap: 4}}
hemodynamic_extraction: {{method: "dual_wavelength", baseline_frames: [2, 12], min_overlap: 4, extinction_filepath: "{d}/e.mat"}}
wavelength: {{green: 530, red: 625, blue: 450}}
output: {{dir: "{d}/out", pixel_ts: "pixel_ts.pkl", roi_ts: "roi_ts.pkl", green_ts: "green_ts.pkl", hemo_ts: "hemo_ts.pkl", transform: "transform.pkl"}}
"""


@pytest.fixture
def session(tmp_path):
    rng = np.random.default_rng(3)
    y, x = np.mgrid[:16, :24]
    base = 200 + 100 * np.exp(-((y - 8) ** 2 + (x - 11) ** 2) / 30)
    stack = np.array([base * (1 + 0.02 * rng.standard_normal()) + rng.standard_normal(base.shape) for _ in range(94)]).astype("uint16")
    (tmp_path / "m.tif").write_bytes(tiff.encode(stack))
    atlas = np.zeros((14, 10))
    atlas[2:12, 2:5], atlas[2:12, 5:8] = 1, 2
    (tmp_path / "a.mat").write_bytes(mat.encode({"data": atlas}))
    (tmp_path / "t.mat").write_bytes(mat.encode({"data": atlas * 10}))
    lam = np.arange(450.0, 700, 10)
    (tmp_path / "e.mat").write_bytes(mat.encode({"lambda": lam, "eHbO2": 4e4 - 60 * (lam - 530), "eHb": 3.9e4 - 350 * (lam - 530)}))
    (tmp_path / "out").mkdir()
    points = np.array([[0, 0], [7, 0], [7, 11], [0, 11]], float)

    def at(direction, kind="task", movie="m.tif", trials="false"):
        (tmp_path / "c.yaml").write_text(CONFIG.format(d=tmp_path, direction=direction, kind=kind, movie=movie, trials=trials))
        return str(tmp_path / "c.yaml"), points, points + 1.0, stack

    return at


@pytest.mark.parametrize("direction,kind,hemodynamics", [("atlas_to_mouse", "task", True), ("mouse_to_atlas", "task", True), ("atlas_to_mouse", "rest", False)])
def test_whole_session(spark, session, tmp_path, direction, kind, hemodynamics):
    path, mouse, atlas, stack = session(direction, kind)
    out = pipeline.run_config(spark, path, mouse, atlas, hemodynamics)
    roi = spark.read.parquet(f"{tmp_path}/out/roi_ts")
    assert {r.label for r in roi.select("label").distinct().collect()} == {1, 2}
    assert roi.count() == 2 * 31 and ("hemo_ts" in out) == hemodynamics and ("transform" in out) == (direction == "mouse_to_atlas")
    if hemodynamics:
        r = spark.read.parquet(f"{tmp_path}/out/hemo_ts").where("t = 20").first()
        assert r.hbt == pytest.approx(r.hbr + r.hbo)
    if direction == "atlas_to_mouse" and kind == "task":
        # The pixel path by numpy: shrink (integers stay integers, fractions cut off), align, divide by the baseline, rotate, regress.
        small = [np.stack([kernels.resize(f, 8, 12) for f in stack[c:93:3]]).astype(float) for c in (0, 2)]
        flat = []
        for s in small:
            ref = np.median(s, axis=0)
            s = np.stack([kernels.fourier_shift(f, *kernels.register(ref, f, 10)) for f in s])
            flat.append(np.rot90(s / s[2:12].mean(axis=0), 1, (1, 2)))
        green, blue = flat
        g, b = green - green.mean(axis=0), blue - blue.mean(axis=0)
        alpha = (g * b).sum(axis=0) / (g * g).sum(axis=0)
        want = blue - alpha * green - (blue.mean(axis=0) - alpha * green.mean(axis=0))
        for r in spark.read.parquet(f"{tmp_path}/out/pixel_ts").where("t in (0, 17)").collect():
            assert r.v == pytest.approx(want[r.t, r.y, r.x], abs=1e-9)


@pytest.mark.parametrize("kind", ["task", "rest"])
def test_a_session_of_trials(spark, session, tmp_path, kind):
    """Baselines per trial, one reference from the first trial, a fit over both, whole cycles counted in each."""
    path, mouse, atlas, stack = session("atlas_to_mouse", kind, "trials", "true")
    (tmp_path / "trials").mkdir()
    rng = np.random.default_rng(8)
    other = (np.roll(stack[:71], 1, axis=1) * rng.uniform(0.8, 1.2, (71, 1, 1))).astype("uint16")
    for name, s in (("1.tif", stack), ("2.tif", other)):
        (tmp_path / "trials" / name).write_bytes(tiff.encode(s))
    out = pipeline.run_config(spark, path, mouse, atlas, kind == "task")
    shifts = {(r.channel, r.trial, r.t): (r.dy, r.dx) for r in out["shifts"].collect()}
    flat, reference = {}, {}
    for c, name in ((0, "green"), (2, "blue")):
        small = [np.stack([kernels.resize(f, 8, 12) for f in s[c : len(s) // 3 * 3 : 3]]).astype(float) for s in (stack, other)]
        ref = np.median(small[0], axis=0)
        both = []
        for trial, s in enumerate(small):
            moves = [kernels.register(ref, f, 10) for f in s]
            assert np.allclose([shifts[name, trial, t] for t in range(len(s))], moves)
            s = np.stack([kernels.fourier_shift(f, *m) for f, m in zip(s, moves)])
            both.append(s)
            flat.setdefault(trial, {})[name] = np.rot90(s / s[2:12].mean(axis=0), 1, (1, 2))
        reference[name] = np.rot90(np.median(np.concatenate(both), axis=0))
    got = {(r.y, r.x): r.v for r in out["green_ref"].collect()}
    assert all(v == pytest.approx(reference["green"][k]) for k, v in got.items())
    green, blue = (np.concatenate([flat[k][n] for k in (0, 1)]) for n in ("green", "blue"))
    g, b = green - green.mean(axis=0), blue - blue.mean(axis=0)
    alpha = (g * b).sum(axis=0) / (g * g).sum(axis=0)
    want = blue - alpha * green - (blue.mean(axis=0) - alpha * green.mean(axis=0))
    want = {0: want[:31], 1: want[31:]}
    assert {k: len(v) for k, v in want.items()} == {0: 31, 1: 23}
    if kind == "rest":
        ba = kernels.butterworth(3, 0.5, 2.0, 10.0)
        want = {k: kernels.zero_phase(v.reshape(len(v), -1), *ba).reshape(v.shape) for k, v in want.items()}
    rows = spark.read.parquet(f"{tmp_path}/out/pixel_ts").where("t in (0, 17)").collect()
    assert {(r.trial, r.t) for r in rows} == {(0, 0), (0, 17), (1, 0), (1, 17)}
    for r in rows:
        assert r.v == pytest.approx(want[r.trial][r.t, r.y, r.x], abs=1e-9)
    roi = spark.read.parquet(f"{tmp_path}/out/roi_ts")
    assert roi.count() == 2 * (31 + 23) and set(roi.columns) == {"label", "trial", "t", "v"}


def test_bad_settings():
    with pytest.raises(ValueError):
        tables.Config("m", experiment="other")
    with pytest.raises(ValueError):
        tables.Config("m", order=("a", "b"))


def test_tiff_horizontal_differences():
    import zlib

    from lumiflux.sources import tiff

    class Bytes:
        def __init__(self, data):
            self.data = data

        def read_at(self, n, at):
            return self.data[at : at + n]

    for order in "<>":
        want = np.array([[0, 1, 4, 9, 16], [65535, 3, 2, 1, 0]], f"{order}u2")
        steps = np.diff(want.astype("u2"), axis=1, prepend=np.zeros((2, 1), "u2")).astype(want.dtype)
        data = zlib.compress(steps.tobytes())
        frame = tiff.Frame(2, 5, f"{order}u2", 8, [(0, len(data))], tiff.DIFFERENCES)
        assert tiff.pixels(Bytes(data), frame).tolist() == want.ravel().tolist()
