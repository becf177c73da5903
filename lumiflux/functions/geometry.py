"""Landmark fits and the weight tables of warps. Matrices act on (x, y); images are indexed (y, x)."""

from __future__ import annotations

import numpy as np

from lumiflux.functions import kernels

MIN_POINTS = 4


def similarity(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """3 x 3 matrix of the least-squares rotation, uniform scale and shift from src to dst."""
    src, dst = np.asarray(src, float), np.asarray(dst, float)
    ms, md = src.mean(axis=0), dst.mean(axis=0)
    a = (dst - md).T @ (src - ms) / len(src)
    u, s, vt = np.linalg.svd(a)
    d = np.array([1.0, 1.0 if np.linalg.det(a) >= 0 else -1.0])
    r = u @ np.diag(d) @ vt
    scale = (s * d).sum() / src.var(axis=0).sum()
    out = np.eye(3)
    out[:2, :2], out[:2, 2] = scale * r, md - scale * r @ ms
    return out


def affine(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    src, dst = np.asarray(src, float), np.asarray(dst, float)
    fit = np.linalg.lstsq(np.column_stack([src, np.ones(len(src))]), dst, rcond=None)[0]
    return np.vstack([fit.T, [0, 0, 1]])


def fit(mouse: np.ndarray, atlas: np.ndarray, mode: str = "similarity", direction: str = "atlas_to_mouse") -> np.ndarray:
    """The transform from the landmarks of one image to those of the other."""
    if len(mouse) != len(atlas):
        raise ValueError("the images have different numbers of landmarks")
    if len(mouse) < MIN_POINTS:
        raise ValueError(f"at least {MIN_POINTS} landmarks are needed")
    if mode not in ("similarity", "affine") or direction not in ("atlas_to_mouse", "mouse_to_atlas"):
        raise ValueError(f"unknown mode {mode!r} or direction {direction!r}")
    src, dst = (atlas, mouse) if direction == "atlas_to_mouse" else (mouse, atlas)
    return (similarity if mode == "similarity" else affine)(src, dst)


def apply(m: np.ndarray, points: np.ndarray) -> np.ndarray:
    p = np.column_stack([np.asarray(points, float), np.ones(len(points))]) @ m.T
    return p[:, :2] / p[:, 2:]


def residuals(m: np.ndarray, src: np.ndarray, dst: np.ndarray) -> dict[str, float]:
    r = np.sqrt(((apply(m, src) - np.asarray(dst, float)) ** 2).sum(axis=1))
    return {"mean": float(r.mean()), "max": float(r.max()), "std": float(r.std())}


def sources(inverse: np.ndarray, out_shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Where each output pixel, row by row, comes from: y and x in the input."""
    yo, xo = (a.ravel() for a in np.mgrid[: out_shape[0], : out_shape[1]])
    x, y = apply(inverse, np.column_stack([xo, yo])).T
    return y, x


def cubic_weights(f: np.ndarray) -> list[np.ndarray]:
    """Weights of the four pixels around a place, at its fraction f beyond the second: a cubic through the middle two with
    the slopes between their neighbours."""
    return [(-f + 2 * f**2 - f**3) / 2, 1 + (-5 * f**2 + 3 * f**3) / 2, (f + 4 * f**2 - 3 * f**3) / 2, (-(f**2) + f**3) / 2]


def warp_axes(inverse: np.ndarray, out_shape: tuple[int, int], in_shape: tuple[int, int], order: int) -> tuple[np.ndarray, ...]:
    """Flat output pixels that have sources, the rows and the columns of these and the weights of both, (pixels, sources
    along an axis) each: every row goes with every column.

    Order 0 takes the nearest pixel, halves away from zero; order 1 the corners at floor and ceiling; order 3 four by four
    pixels; an output pixel with one of these beyond the image has no sources. Orders 2, 4 and 5 take coefficients of
    splines (kernels.spline_filter along both axes), mirrored at the edges; places beyond the image have no sources."""
    if order not in kernels.ORDERS:
        raise ValueError(f"interpolation order {order} is not supported")
    (h, w), (y, x) = in_shape, sources(inverse, out_shape)
    if order in (2, 4, 5):
        at = np.flatnonzero((y >= 0) & (y <= h - 1) & (x >= 0) & (x <= w - 1))
        (ky, wy), (kx, wx) = (kernels.spline_stencil(c[at], order) for c in (y, x))
        ky, kx = kernels.mirrored(ky, h), kernels.mirrored(kx, w)
    else:
        if order == 0:
            ky, kx = (np.copysign(np.floor(np.abs(c) + 0.5), c).astype(int)[:, None] for c in (y, x))
            wy = wx = np.ones_like(ky, float)
        elif order == 1:
            ky, kx = (np.stack([np.floor(c), np.ceil(c)], 1).astype(int) for c in (y, x))
            wy, wx = (np.stack([1 - (c - k[:, 0]), c - k[:, 0]], 1) for c, k in ((y, ky), (x, kx)))
        else:
            ky, kx = (np.floor(c).astype(int)[:, None] + np.arange(-1, 3) for c in (y, x))
            wy, wx = (np.stack(cubic_weights(c - k[:, 1]), 1) for c, k in ((y, ky), (x, kx)))
        inside = ((ky >= 0) & (ky < h)).all(axis=1) & ((kx >= 0) & (kx < w)).all(axis=1)
        at = np.flatnonzero(inside)
        ky, kx, wy, wx = ky[at], kx[at], wy[at], wx[at]
    return at, ky, kx, wy, wx


def warp_stencil(inverse: np.ndarray, out_shape: tuple[int, int], in_shape: tuple[int, int], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat output pixels that have sources, their flat input pixels and the weights of these, (pixels, sources) each."""
    at, ky, kx, wy, wx = warp_axes(inverse, out_shape, in_shape, order)
    place = ky[:, :, None] * in_shape[1] + kx[:, None, :]
    return at, place.reshape(len(at), -1), (wy[:, :, None] * wx[:, None, :]).reshape(len(at), -1)


def warp_table(inverse: np.ndarray, out_shape: tuple[int, int], in_shape: tuple[int, int], order: int = 1) -> list[tuple[int, int, int, int, float]]:
    """(yo, xo, y, x, weight) for each output pixel whose sources all lie in the input; inverse maps output to input."""
    at, place, w = warp_stencil(inverse, out_shape, in_shape, order)
    yo, xo = np.divmod(np.repeat(at, place.shape[1]), out_shape[1])
    y, x = np.divmod(place.ravel(), in_shape[1])
    return list(zip(yo.tolist(), xo.tolist(), y.tolist(), x.tolist(), w.ravel().tolist()))
