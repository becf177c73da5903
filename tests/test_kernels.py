import numpy as np
import pytest

from lumiflux.functions import geometry, kernels as k


def blob(n=32):
    y, x = np.mgrid[:n, :n]
    return np.exp(-((y - 14) ** 2 + (x - 17) ** 2) / 18) + 0.5 * np.exp(-((y - 22) ** 2 + (x - 8) ** 2) / 8)


@pytest.mark.parametrize("dy,dx", [(0, 0), (1.3, -2.7), (-4.5, 3.1), (7, 0.2)])
def test_shifts_are_recovered(dy, dx):
    moved = k.fourier_shift(blob(), dy, dx)
    got = k.register(blob(), moved, 10)
    assert np.allclose(got, (-dy, -dx), atol=0.1)
    assert np.abs(k.fourier_shift(moved, *got) - blob()).max() < 0.02


def test_whole_shift_is_a_roll():
    assert np.allclose(k.fourier_shift(blob(), 3, -2), np.roll(blob(), (3, -2), (0, 1)))


def test_butterworth_response():
    for low, high, n in ((0.02, 2.0, 7), (0.5, None, 4), (None, 2.0, 4)):
        b, a = k.butterworth(3, low, high, 10.0)
        assert len(b) == len(a) == n
        gain = lambda f: abs(np.polyval(b, np.exp(2j * np.pi * f / 10)) / np.polyval(a, np.exp(2j * np.pi * f / 10)))
        for f in filter(None, (low, high)):
            assert gain(f) == pytest.approx(2**-0.5, abs=1e-5)
        assert gain(1e-9) == pytest.approx(1 if not low else 0, abs=1e-6)
    assert k.butterworth(3, None, None, 10) is None


def test_zero_phase():
    t = np.arange(3000) / 10
    keep, drop = np.sin(2 * np.pi * 0.5 * t), np.sin(2 * np.pi * 4 * t)
    ba = k.butterworth(3, 0.02, 2.0, 10.0)
    got = k.zero_phase(np.stack([keep + drop + 5, keep], axis=1), *ba)
    assert np.abs(got[1000:2000] - keep[1000:2000, None]).max() < 0.005
    assert np.allclose(k.zero_phase(np.full(100, 3.0), *k.butterworth(3, None, 2.0, 10)), 3)
    bad = keep.copy()
    bad[5] = np.nan
    assert np.isnan(k.zero_phase(bad, *ba)).all()
    with pytest.raises(ValueError):
        k.zero_phase(keep[:21], *ba)


def test_welch():
    rng = np.random.default_rng(0)
    f, p = k.welch(rng.standard_normal(20_000), 10.0)
    assert p.sum() * (f[1] - f[0]) == pytest.approx(1, abs=0.05)
    got = k.band_shares(np.sin(2 * np.pi * 0.5 * np.arange(2000) / 10), 10.0)
    assert got["dominant_frequency"] == pytest.approx(0.5, abs=0.03) and got["physio_freq_fraction"] > 0.99
    assert k.band_shares(np.zeros(100), 10.0)["high_freq_fraction"] == 0


def test_resize():
    image = np.arange(64.0).reshape(8, 8)
    same = k.resize(image, 8, 8)
    assert np.allclose(same, image)
    assert k.resize(np.full((9, 7), 4.0), 4, 3) == pytest.approx(4)
    assert k.resize(image.astype(np.uint8), 4, 4).dtype == np.uint8
    assert k.out_size(7, 0.5) == 4 and k.out_size(5, 0.5) == 2
    assert set(np.unique(k.resize(np.eye(8, dtype=int), 4, 4, order=0))) <= {0, 1}


@pytest.mark.parametrize("order", [2, 3, 4, 5])
def test_splines_go_through_samples_and_keep_polynomials(order):
    assert np.allclose(k.axis_weights(9, 9, order), np.eye(9))
    # A B-spline's samples add up to 1, and the filter undoes them: coefficients solved the plain way.
    n, reach = 12, order // 2
    b = np.zeros((n, n))
    for i in range(n):
        for d in range(-reach, reach + 1):
            b[i, int(k.mirrored(np.array(i + d), n))] += float(k.bspline(order, np.array(float(d))))
    assert np.allclose(b.sum(axis=1), 1) and np.allclose(k.spline_filter(np.eye(n), order), np.linalg.inv(b))
    x = np.linspace(-1, 1, 120)
    f = np.poly1d(np.arange(1.0, order + 2))
    w = k.axis_weights(120, 90, order, antialias=False)
    place = ((np.arange(90) + 0.5) * 120 / 90 - 0.5) * 2 / 119 - 1
    assert np.allclose((w @ f(x))[35:55], f(place)[35:55], atol=1e-9)
    # Mirrored samples: the cosine's spline is mirrored too.
    assert np.allclose(k.spline_filter(np.cos(np.pi * np.arange(11) / 10), order), -k.spline_filter(np.cos(np.pi * np.arange(11) / 10), order)[::-1])
    assert np.allclose(k.axis_weights(1, 1, order), 1)
    with pytest.raises(ValueError):
        k.axis_weights(8, 4, 6)


def test_known_poles_and_b_splines():
    assert k.spline_poles(3) == pytest.approx([np.sqrt(3) - 2]) and k.spline_poles(2) == pytest.approx([np.sqrt(8) - 3])
    assert k.bspline(3, np.array([-1.0, 0, 1, 2])) == pytest.approx([1 / 6, 4 / 6, 1 / 6, 0])
    assert k.bspline(5, np.array([0.0, 1, 2])) == pytest.approx([66 / 120, 26 / 120, 1 / 120])


def test_integers_that_shrink_by_splines_keep_range_and_type():
    image = np.zeros((12, 12), np.uint16)
    image[:, 6:] = 1000
    out = k.resize(image, 6, 6, order=3, antialias=False)
    assert out.dtype == np.uint16 and out.min() == 0 and out.max() == 1000


def test_cubic_is_exact_for_cubics():
    x = np.array([500.0, 512, 520, 541, 560, 600, 650])
    f = lambda v: 1e-5 * v**3 - 2e-2 * v**2 + v - 3
    for at in (490, 500, 530, 625, 700):
        assert k.cubic(x, f(x), at) == pytest.approx(f(at), rel=1e-9)


def test_components_holes_and_largest():
    m = np.array([[1, 1, 0, 0, 1], [0, 0, 1, 0, 1], [1, 0, 0, 0, 0], [1, 1, 0, 1, 1]], bool)
    assert k.components(m).max() == 4 and k.components(m, diagonal=False).max() == 5
    ring = np.zeros((7, 7), bool)
    ring[1:6, 1:6] = True
    ring[3, 3] = False
    assert k.fill_holes(ring).sum() == 25
    assert k.largest(m | False).sum() == 3
    assert not k.drop_small(m, 4).any()
    assert k.largest(np.zeros((3, 3), bool)).sum() == 0


def test_morphology():
    m = np.zeros((15, 15), bool)
    m[7, 7] = True
    assert (k.dilate(m, k.disk(3)) == np.pad(k.disk(3), 4)).all()
    assert k.opening(m, k.disk(1)).sum() == 0 and (k.closing(m, k.disk(2)) == m).all()
    assert k.median_filter(np.arange(25.0).reshape(5, 5), 3)[2, 2] == 12
    assert k.gaussian(np.full((9, 9), 2.0), 2) == pytest.approx(2)


def test_masks_of_images():
    rng = np.random.default_rng(1)
    image = 100 + rng.standard_normal((60, 60))
    image[:, 30:32] = 60
    vessel = ~k.vessels(image, 15, 2.5, 1)
    assert vessel[1:-1, 30:32].all() and vessel[:, :20].mean() < 0.05
    assert (~k.vessels_by_percentile(image, 11, 3, 1))[:, 30:32].mean() > 0.5
    y, x = np.mgrid[:80, :80]
    brain = ((y - 40) ** 2 + (x - 40) ** 2 < 900) * 50.0 + rng.standard_normal((80, 80))
    got = k.brain_mask(brain, deviation=brain, top_hat=60, low_percentile=50)
    assert got[40, 40] and not got[2, 2] and 0.5 < got.sum() / (np.pi * 900) < 1.4
    extra = np.zeros_like(got)
    extra[:12, :12] = True
    assert k.brain_mask(brain, deviation=brain, top_hat=60, low_percentile=50, subtract=[extra | (x > 40)])[:, 42:].sum() == 0


def test_landmark_fits():
    rng = np.random.default_rng(2)
    m = np.array([[0.9, -0.4, 12], [0.4, 0.9, -7], [0, 0, 1.0]])
    src = rng.uniform(0, 100, (6, 2))
    assert np.allclose(geometry.similarity(src, geometry.apply(m, src)), m)
    a = np.array([[1.1, 0.2, 3], [-0.3, 0.8, 5], [0, 0, 1.0]])
    assert np.allclose(geometry.affine(src, geometry.apply(a, src)), a)
    assert geometry.residuals(m, src, geometry.apply(m, src))["max"] < 1e-9
    assert np.allclose(geometry.fit(src, geometry.apply(m, src), direction="mouse_to_atlas"), m)
    for bad in ((src[:3], src[:3]), (src, src[:5])):
        with pytest.raises(ValueError):
            geometry.fit(*bad)


def warped(image, inverse, out_shape, order):
    at, place, w = geometry.warp_stencil(inverse, out_shape, image.shape, order)
    flat = k.spline_filter(k.spline_filter(image, order).T, order).T.ravel() if order in (2, 4, 5) else image.ravel()
    out = np.full(out_shape, np.nan).ravel()
    out[at] = (w * flat[place]).sum(axis=1)
    return out.reshape(out_shape)


@pytest.mark.parametrize("order, degree", [(1, 1), (2, 2), (3, 2), (4, 4), (5, 5)])
def test_warps_keep_polynomials(order, degree):
    m = np.array([[0.9, -0.1, 14.3], [0.1, 0.9, 9.2], [0, 0, 1]])
    y, x = np.mgrid[:90, :100] / 50
    f = lambda y, x: (x - 0.7 * y) ** degree + y - 2 * x
    out = warped(f(y, x), m, (60, 70), order)
    ys, xs = (c.reshape(60, 70) / 50 for c in geometry.sources(m, (60, 70)))
    inner = (slice(20, 50), slice(20, 50))
    assert np.allclose(out[inner], f(ys, xs)[inner], atol=1e-7)
    assert np.allclose(warped(f(y, x), np.eye(3), (90, 100), order)[2:-3, 2:-3], f(y, x)[2:-3, 2:-3])


def test_where_warps_end():
    shift = np.array([[1, 0, 0.25], [0, 1, 0.25], [0, 0, 1.0]])
    image = np.arange(56.0).reshape(7, 8)
    seen = {order: np.isfinite(warped(image, shift, (7, 8), order)).sum() for order in range(6)}
    assert seen == {0: 56, 1: 6 * 7, 2: 6 * 7, 3: 4 * 5, 4: 6 * 7, 5: 6 * 7}
    with pytest.raises(ValueError):
        geometry.warp_stencil(shift, (2, 2), (2, 2), 6)


def test_warp_table():
    same = geometry.warp_table(np.eye(3), (3, 4), (3, 4), 1)
    assert len({r[:2] for r in same}) == 12 and all(r[:2] == r[2:4] for r in same if r[4])
    moved = geometry.warp_table(np.array([[1, 0, 1], [0, 1, 0], [0, 0, 1.0]]), (3, 4), (3, 4), 0)
    assert {r[:2] for r in moved} == {(y, x) for y in range(3) for x in range(3)}
