"""Kernels between two grey frames: their shift by phase correlation, warping by a matrix; and edges by hysteresis."""

from __future__ import annotations

import numpy as np

#: Pixels around the peak of the correlation, to either side, whose centroid is the shift.
REACH = 2
#: The thresholds of weak and strong edges, and the tangent of 22.5 degrees.
WEAK, STRONG, TAN = 50, 150, 0.4142135623730951


def phase_shift(now: np.ndarray, before: np.ndarray) -> tuple[float, float]:
    """(dx, dy) by which the frame before lies off this one: the centroid of the peak of the inverse cross-power spectrum. Frames of one colour have no shift."""
    cross = np.fft.fft2(before.astype(float)) * np.conj(np.fft.fft2(now.astype(float)))
    size = np.abs(cross)
    flat = size <= 1e-9 * max(size.max(), 1e-300)
    if flat.sum() >= flat.size - 1:
        return 0.0, 0.0
    peak = np.fft.ifft2(np.where(flat, 0, cross / np.where(flat, 1, size))).real
    y, x = np.unravel_index(np.argmax(peak), peak.shape)
    h, w = peak.shape
    dy, dx = (np.arange(-min(REACH, (n - 1) // 2), min(REACH, (n - 1) // 2) + 1) for n in (h, w))
    around = np.maximum(peak[np.ix_((y + dy) % h, (x + dx) % w)], 0)
    around[around < 0.1 * around.max()] = 0  # noise of the plane
    off = lambda at, n, d, axis: ((at + n // 2) % n - n // 2) + float((around.sum(axis) * d).sum() / around.sum())
    return off(x, w, dx, 0), off(y, h, dy, 1)


def warp(gray: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The frame moved by a 2 x 3 matrix (pixel x, y goes to matrix @ (x, y, 1)), sampled bilinearly, black where nothing comes from; whole numbers."""
    back = np.linalg.inv(np.vstack([matrix, [0, 0, 1]]))[:2]
    h, w = gray.shape
    ys, xs = np.mgrid[0:h, 0:w]
    x, y = (r[0] * xs + r[1] * ys + r[2] for r in back)
    x0, y0 = np.floor(x + 1e-9).astype(int), np.floor(y + 1e-9).astype(int)
    fx, fy = np.clip(x - x0, 0, 1), np.clip(y - y0, 0, 1)
    framed = np.pad(gray.astype(float), 1)

    def at(i, j):
        return framed[np.clip(i + 1, 0, h + 1), np.clip(j + 1, 0, w + 1)]

    out = (1 - fy) * ((1 - fx) * at(y0, x0) + fx * at(y0, x0 + 1)) + fy * ((1 - fx) * at(y0 + 1, x0) + fx * at(y0 + 1, x0 + 1))
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def stabilized(gray: np.ndarray, shift: tuple[float, float]) -> np.ndarray:
    """The frame moved onto the one before, by `phase_shift`."""
    return warp(gray, np.array([[1, 0, shift[0]], [0, 1, shift[1]]]))


def hysteresis_edges(gray: np.ndarray, weak: float = WEAK, strong: float = STRONG) -> np.ndarray:
    """Edge pixels: those whose gradient (Sobel, sum of both magnitudes, frames continued by their edge) is over `weak` and the greatest across the edge, if they touch, over others of the kind, one over `strong`.

    Of a plateau the first pixel counts where the gradient is level or upright, none on a diagonal.
    """
    if min(gray.shape) < 1:
        return np.zeros(gray.shape, bool)
    g = np.pad(gray.astype(np.int32), 1, mode="edge")
    tall, broad = g[:-2] + 2 * g[1:-1] + g[2:], g[:, :-2] + 2 * g[:, 1:-1] + g[:, 2:]
    dx, dy = tall[:, 2:] - tall[:, :-2], broad[2:] - broad[:-2]
    mag = np.abs(dx) + np.abs(dy)
    m = np.pad(mag, 1)
    near = lambda i, j: m[1 + i : 1 + i + mag.shape[0], 1 + j : 1 + j + mag.shape[1]]
    level, upright = np.abs(dy) < TAN * np.abs(dx), np.abs(dx) <= TAN * np.abs(dy)
    falling = (dx < 0) == (dy < 0)
    across = np.where(level, (mag > near(0, -1)) & (mag >= near(0, 1)), np.where(upright, (mag > near(-1, 0)) & (mag >= near(1, 0)), np.where(falling, (mag > near(-1, -1)) & (mag > near(1, 1)), (mag > near(-1, 1)) & (mag > near(1, -1)))))
    # Grown from the strong pixels; each step looks at the newest ones alone.
    open_ = np.pad(across & (mag > weak), 1).ravel()
    wide = mag.shape[1] + 2
    out, edge = np.zeros(len(open_), bool), np.flatnonzero(np.pad(across & (mag > strong), 1))
    steps = np.array([i * wide + j for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j])
    while len(edge):
        out[edge] = True
        edge = np.unique(edge[:, None] + steps)
        edge = edge[open_[edge] & ~out[edge]]
    return out.reshape(-1, wide)[1:-1, 1:-1]


def hysteresis_density(gray: np.ndarray) -> float:
    """Share of edge pixels."""
    return float(hysteresis_edges(gray).mean()) if gray.size else 0.0
