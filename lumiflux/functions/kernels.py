"""Numerical kernels in numpy for what no built-in expression covers: filters, spectra, alignment, resampling, morphology."""

from __future__ import annotations

import numpy as np

# --- recursive filters


def butterworth(order: int, low: float | None, high: float | None, fs: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Numerator and denominator of a band-pass, high-pass (low alone) or low-pass (high alone) filter; None without cutoffs."""
    if not low and not high:
        return None
    warp = lambda f: 4 * np.tan(np.pi * f / fs)  # noqa: E731  prewarped for a sampling rate of 2
    poles = np.exp(1j * np.pi * (2 * np.arange(order) + order + 1) / (2 * order))
    if low and high:
        w1, w2 = warp(low), warp(high)
        width, centre = w2 - w1, w1 * w2
        half = poles * width / 2
        root = np.sqrt(half**2 - centre)
        p, z, gain = np.concatenate([half + root, half - root]), np.zeros(order), width**order
    elif low:
        w = warp(low)
        p, z, gain = w / poles, np.zeros(order), 1.0
    else:
        w = warp(high)
        p, z, gain = poles * w, np.zeros(0), w**order
    digital = lambda s: (4 + s) / (4 - s)
    gain *= np.real(np.prod(4 - z) / np.prod(4 - p))
    zeros = np.concatenate([digital(z), -np.ones(len(p) - len(z))])
    return np.real(gain * np.poly(zeros)), np.real(np.poly(digital(p)))


def _run(b: np.ndarray, a: np.ndarray, x: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Transposed direct form II along axis 0, all columns at once."""
    y = np.empty_like(x)
    for i in range(len(x)):
        y[i] = b[0] * x[i] + state[0]
        state[:-1] = state[1:] + b[1:-1, None] * x[i] - a[1:-1, None] * y[i]
        state[-1] = b[-1] * x[i] - a[-1] * y[i]
    return y


def zero_phase(x: np.ndarray, b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Forward and backward along axis 0, with odd extension and steady initial states. A trace with NaN becomes NaN."""
    one = x.ndim == 1
    x = np.asarray(x, float).reshape(len(x), -1)
    pad = 3 * max(len(a), len(b))
    if len(x) <= pad:
        raise ValueError(f"a trace needs more than {pad} points, it has {len(x)}")
    n = max(len(a), len(b))
    b, a = np.pad(b, (0, n - len(b))) / a[0], np.pad(a, (0, n - len(a))) / a[0]
    companion = np.zeros((n - 1, n - 1))
    companion[0] = -a[1:]
    companion[np.arange(1, n - 1), np.arange(n - 2)] = 1
    steady = np.linalg.solve(np.eye(n - 1) - companion.T, b[1:] - a[1:] * b[0])[:, None]
    e = np.concatenate([2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]])
    y = _run(b, a, e, steady * e[0])
    y = _run(b, a, y[::-1], steady * y[-1])[::-1][pad:-pad]
    y[:, np.isnan(x).any(axis=0)] = np.nan
    return y[:, 0] if one else y


# --- spectra


def welch(v: np.ndarray, fs: float) -> tuple[np.ndarray, np.ndarray]:
    """Periodic Hann, segments of min(T // 4, 256) with half overlap, means removed, one-sided density."""
    n = min(len(v) // 4, 256)
    hop = n - n // 2
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
    parts = np.lib.stride_tricks.sliding_window_view(np.asarray(v, float), n)[::hop]
    p = np.abs(np.fft.rfft((parts - parts.mean(axis=1, keepdims=True)) * w)) ** 2 / (fs * (w**2).sum())
    p[:, 1 : len(p[0]) - (n % 2 == 0)] *= 2
    return np.fft.rfftfreq(n, 1 / fs), p.mean(axis=0)


def band_shares(v: np.ndarray, fs: float) -> dict[str, float]:
    f, p = welch(v, fs)
    total = p[1:].sum()
    share = lambda m: float(p[m].sum() / total) if total > 0 else 0.0
    return {"dominant_frequency": float(f[1:][np.argmax(p[1:])]), "low_freq_fraction": share((f >= 0.01) & (f < 0.1)), "physio_freq_fraction": share((f >= 0.1) & (f < 2)), "high_freq_fraction": share(f >= 2)}


# --- alignment


def register(reference: np.ndarray, moving: np.ndarray, upsample: int = 10) -> tuple[float, float]:
    """(dy, dx) to apply to moving, by normalised phase correlation to 1 / upsample of a pixel."""
    product = np.fft.fft2(reference) * np.conj(np.fft.fft2(moving))
    product /= np.maximum(np.abs(product), 100 * np.finfo(float).eps)
    peak = np.unravel_index(np.argmax(np.abs(np.fft.ifft2(product))), product.shape)
    shift = np.array([p - n if p > n // 2 else p for p, n in zip(peak, product.shape)], float)
    if upsample > 1:
        shift = np.round(shift * upsample) / upsample
        size = int(np.ceil(1.5 * upsample))
        centre = np.fix(size / 2)
        offset = centre - shift * upsample
        fine = np.conj(product)
        for axis, n in enumerate(product.shape):
            kernel = np.exp(-2j * np.pi * (np.arange(size) - offset[axis])[:, None] * np.fft.fftfreq(n, upsample))
            fine = np.moveaxis(np.tensordot(kernel, fine, axes=(1, axis)), 0, axis)
        best = np.unravel_index(np.argmax(np.abs(np.conj(fine))), fine.shape)
        shift += (np.array(best, float) - centre) / upsample
    return float(shift[0]), float(shift[1])


def fourier_shift(image: np.ndarray, dy: float, dx: float) -> np.ndarray:
    """Moves an image by fractions of a pixel; what leaves on one side comes in on the other."""
    fy, fx = np.fft.fftfreq(image.shape[0])[:, None], np.fft.fftfreq(image.shape[1])
    return np.real(np.fft.ifft2(np.fft.fft2(image) * np.exp(-2j * np.pi * (fy * dy + fx * dx))))


# --- resampling


ORDERS = range(6)


def bspline(order: int, x: np.ndarray) -> np.ndarray:
    """The B-spline of an order, centred at 0, by the recursion over orders."""
    if order == 0:
        return ((x >= -0.5) & (x < 0.5)).astype(float)
    half = (order + 1) / 2
    return ((half + x) * bspline(order - 1, x + 0.5) + (half - x) * bspline(order - 1, x - 0.5)) / order


def spline_poles(order: int) -> np.ndarray:
    """The poles within the unit circle of the filter that turns samples into coefficients: roots of the B-spline's samples."""
    reach = order // 2
    roots = np.roots(bspline(order, np.arange(-reach, reach + 1.0)))
    return np.sort(np.real(roots[np.abs(roots) < 1]))


def spline_filter(samples: np.ndarray, order: int) -> np.ndarray:
    """Coefficients along axis 0 of the spline through samples that are mirrored at their ends: a recursive filter forth
    and back for each pole, begun with the exact sum over the mirrored samples."""
    c = np.array(samples, float)
    n = len(c)
    if order < 2 or n == 1:
        return c
    for z in spline_poles(order):
        c *= (1 - z) * (1 - 1 / z)
        w = z ** np.arange(n)
        w[1:-1] += z ** (2 * n - 2 - np.arange(1, n - 1))
        c[0] = np.tensordot(w, c, 1) / (1 - z ** (2 * n - 2))
        for i in range(1, n):
            c[i] += z * c[i - 1]
        c[-1] = z / (z * z - 1) * (c[-1] + z * c[-2])
        for i in range(n - 2, -1, -1):
            c[i] = z * (c[i + 1] - c[i])
    return c


def spline_stencil(place: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The order + 1 coefficients around each place, and their weights: (places, order + 1) each."""
    first = np.floor(place - (order - 1) / 2).astype(int)
    k = first[:, None] + np.arange(order + 1)
    return k, bspline(order, place[:, None] - k)


def axis_weights(n_in: int, n_out: int, order: int = 1, antialias: bool = True) -> np.ndarray:
    """n_out x n_in matrix of resizing along one axis: Gaussian smoothing when shrinking, then centre-aligned sampling of
    the nearest pixel (order 0), between two (1), or of the spline through all (2 to 5), whose filter is part of it."""
    if order not in ORDERS:
        raise ValueError(f"interpolation order {order} is not supported")
    factor = n_in / n_out
    sample = np.zeros((n_out, n_in))
    place = (np.arange(n_out) + 0.5) * factor - 0.5
    if order == 0:
        sample[np.arange(n_out), np.clip(np.floor(place + 0.5).astype(int), 0, n_in - 1)] = 1
        return sample
    k, w = spline_stencil(place, order)
    np.add.at(sample, (np.arange(n_out)[:, None], mirrored(k, n_in)), w)
    sample = sample @ spline_filter(np.eye(n_in), order) if order > 1 else sample
    sigma = max(0.0, (factor - 1) / 2)
    if not antialias or sigma == 0:
        return sample
    reach = int(4 * sigma + 0.5)
    g = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    blur = np.zeros((n_in, n_in))
    for d, w in zip(range(-reach, reach + 1), g / g.sum()):
        np.add.at(blur, (np.arange(n_in), mirrored(np.arange(n_in) + d, n_in)), w)
    return sample @ blur


def mirrored(i: np.ndarray, n: int) -> np.ndarray:
    """Indices reflected at the edge pixels' centres."""
    if n == 1:
        return np.zeros_like(i)
    j = np.mod(i, 2 * n - 2)
    return np.where(j >= n, 2 * n - 2 - j, j)


def resize(image: np.ndarray, height: int, width: int, order: int = 1, antialias: bool = True) -> np.ndarray:
    """Keeps the input's range and, for integers, its type (fractions are cut off)."""
    out = axis_weights(image.shape[0], height, order, antialias) @ image @ axis_weights(image.shape[1], width, order, antialias).T
    out = np.clip(out, image.min(), image.max())
    return out.astype(image.dtype) if np.issubdtype(image.dtype, np.integer) else out


def out_size(n: int, scale: float) -> int:
    return round(n * scale)


def cubic_pieces(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The not-a-knot cubic spline through the points (sorted by x): (start, c0, c1, c2, c3) of each piece, whose value is
    c0 + c1 u + c2 u^2 + c3 u^3 at u beyond its start. The first and the last piece go on beyond the points."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    n, h = len(x), np.diff(x)
    if n < 4:
        raise ValueError("a cubic spline needs four points")
    if not (h > 0).all():
        raise ValueError("the points of a spline must be different and in order")
    slope = np.diff(y) / h
    m, r = np.zeros((n, n)), np.zeros(n)  # second derivatives
    for i in range(1, n - 1):
        m[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        r[i] = 6 * (slope[i] - slope[i - 1])
    m[0, :3] = h[1], -(h[0] + h[1]), h[0]
    m[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
    s = np.linalg.solve(m, r)
    return np.column_stack([x[:-1], y[:-1], slope - h * (2 * s[:-1] + s[1:]) / 6, s[:-1] / 2, np.diff(s) / (6 * h)])


def cubic(x: np.ndarray, y: np.ndarray, at: float) -> float:
    """One value of that spline."""
    pieces = cubic_pieces(x, y)
    start, *c = pieces[int(np.clip(np.searchsorted(pieces[:, 0], at, "right") - 1, 0, len(pieces) - 1))]
    return float(np.polynomial.polynomial.polyval(at - start, c))


# --- morphology and smoothing of one image


def disk(radius: int) -> np.ndarray:
    a = np.arange(-radius, radius + 1)
    return a[:, None] ** 2 + a**2 <= radius**2


def _fold(image: np.ndarray, shape: np.ndarray, outside, f) -> np.ndarray:
    """f (np.maximum or np.minimum) over the element, without holding all shifted images at once."""
    ry, rx = shape.shape[0] // 2, shape.shape[1] // 2
    padded = np.pad(image, ((ry, ry), (rx, rx)), constant_values=outside)
    out = None
    for a, b in zip(*np.nonzero(shape)):
        part = padded[a : a + image.shape[0], b : b + image.shape[1]]
        out = part.copy() if out is None else f(out, part, out=out)
    return out


def dilate(image: np.ndarray, shape: np.ndarray) -> np.ndarray:
    low = False if image.dtype == bool else -np.inf
    return _fold(image, shape, low, np.maximum)


def erode(image: np.ndarray, shape: np.ndarray, border: bool = True) -> np.ndarray:
    """border: whether what lies outside a binary image counts as set."""
    high = border if image.dtype == bool else np.inf
    return _fold(image, shape, high, np.minimum)


def closing(image: np.ndarray, shape: np.ndarray, border: bool = True) -> np.ndarray:
    return erode(dilate(image, shape), shape, border)


def opening(image: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return dilate(erode(image, shape), shape)


def white_top_hat(image: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return image - opening(image, shape)


def median_filter(image: np.ndarray, size: int) -> np.ndarray:
    """Square median, edges mirrored (edge pixels twice); a row of windows at a time, to bound memory."""
    r = size // 2
    padded = np.pad(image, ((r, size - 1 - r), (r, size - 1 - r)), mode="symmetric")
    views = np.lib.stride_tricks.sliding_window_view(padded, (size, size))
    return np.stack([np.median(row.reshape(len(row), -1), axis=1) for row in views])


def gaussian(image: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(4 * sigma + 0.5)
    g = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    g /= g.sum()
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (reach, reach)
        p = np.pad(image, pad, mode="symmetric")
        image = sum(w * np.take(p, np.arange(k, k + image.shape[axis]), axis) for k, w in enumerate(g))
    return image


def components(mask: np.ndarray, diagonal: bool = True) -> np.ndarray:
    """Labels 1, 2, ... of connected sets in scan order of their first pixels; 0 elsewhere. Row runs and a union-find."""
    runs, parent, before = [], [], []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for y, row in enumerate(mask):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], row.astype(np.int8), [0]])))
        now = []
        for a, b in zip(edges[::2], edges[1::2]):
            k = len(parent)
            parent.append(k)
            runs.append((y, a, b))
            now.append((a, b, k))
            for c, d, j in before:
                if a < d + diagonal and c < b + diagonal:
                    r, s = sorted((root(k), root(j)))
                    parent[s] = r
        before = now
    out, number = np.zeros(mask.shape, int), {}
    for k, (y, a, b) in enumerate(runs):
        out[y, a:b] = number.setdefault(root(k), len(number) + 1)
    return out


def drop_small(mask: np.ndarray, least: int) -> np.ndarray:
    labels = components(mask, diagonal=False)
    return mask & (np.bincount(labels.ravel())[labels] >= least)


def fill_holes(mask: np.ndarray) -> np.ndarray:
    outside = components(~np.pad(mask, 1), diagonal=False)
    return ~(outside == outside[0, 0])[1:-1, 1:-1]


def largest(mask: np.ndarray) -> np.ndarray:
    """The largest connected set, the first of equals."""
    labels = components(mask)
    sizes = np.bincount(labels.ravel())[1:]
    return labels == 1 + np.argmax(sizes) if len(sizes) else mask.copy()


def vessels(image: np.ndarray, size: int = 125, z: float = 2.5, radius: int = 2) -> np.ndarray:
    """True away from vessels: dark against the local median by more than z deviations, closed."""
    d = image - median_filter(image, size)
    return ~closing(d < d.mean() - z * d.std(), disk(radius), border=False)


def vessels_by_percentile(image: np.ndarray, size: int = 11, percentile: float = 3, radius: int = 1) -> np.ndarray:
    d = image - median_filter(image, size)
    return ~closing(d < np.percentile(d, percentile), disk(radius), border=False)


def brain_mask(image: np.ndarray, deviation: np.ndarray | None = None, add=(), subtract=(), top_hat: int = 30, low_percentile: float = 10, std_percentile: float = 40, glue_sigma: float = 5, glue_area: int = 500, glue_std: float = 30, close: int = 5, open_: int = 3, least: int = 200) -> np.ndarray:
    """Automatic mask of one image: even background, thresholds, bright spots removed, morphology, largest set; then
    polygons (boolean images) are added and subtracted."""
    try:
        flat = white_top_hat(image.astype(float), disk(top_hat))
    except MemoryError:
        flat = image - gaussian(image, 10)
        flat -= flat.min()
    spread = flat.max() - flat.min()
    flat = (flat - flat.min()) / spread if spread > 0 else np.zeros_like(flat)
    mask = flat > np.percentile(flat, low_percentile)
    if deviation is not None:
        smooth = gaussian(deviation, 2)
        mask &= smooth > np.percentile(smooth, std_percentile)
    bright = components(flat > flat.mean() + glue_sigma * flat.std())
    glue = (bright > 0) & (np.bincount(bright.ravel())[bright] < glue_area)
    if deviation is not None:
        glue &= deviation < np.percentile(deviation, glue_std)
    mask &= ~glue
    mask = fill_holes(drop_small(opening(closing(mask, disk(close)), disk(open_)), least))
    mask = largest(mask)
    if len(add) or len(subtract):
        for p in add:
            mask = mask | p
        for p in subtract:
            mask = mask & ~p
        mask = drop_small(fill_holes(closing(mask, disk(open_))), 100)
    return mask
