"""Eigenvectors of a symmetric matrix: a float32 solution, corrected in higher precision.

The correction is the one of Ogita and Aishima (2018, 2019): each step takes a few matrix products
and doubles the number of right digits; eigenvalues that lie too close together for it are told
apart by solving their own small, shifted problem. Products are split into slices whose partial
products are exact in double precision (Ozaki and others, 2012), so that the library's fast
products give more than 60 right bits.
"""

from __future__ import annotations

import numpy as np

WIDE = np.longdouble
STEPS = 12
#: Below this share of the largest entry, what is left of a shifted problem is rounding.
NOISE = WIDE(2) ** -59


def _slices(a: np.ndarray, bits: int, axis: int) -> list[np.ndarray]:
    """``a`` as a sum of three double matrices of ``bits`` bits relative to the largest entry of each row or column."""
    out = []
    for _ in range(3):
        _, exponent = np.frexp(np.abs(a).max(axis=axis, keepdims=True).astype(WIDE))
        unit = np.ldexp(WIDE(1), exponent - bits)
        part = np.rint(a / unit) * unit
        out.append(part.astype(np.float64))
        a = a - part
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` with about 60 right bits relative to the sizes of rows and columns."""
    bits = (52 - int(np.ceil(np.log2(max(2, a.shape[1]))))) // 2
    left, right = _slices(a.astype(WIDE), bits, 1), _slices(b.astype(WIDE), bits, 0)
    return sum((left[i] @ right[j]).astype(WIDE) for i, j in ((2, 0), (1, 1), (0, 2), (1, 0), (0, 1), (0, 0)))


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(vectors, values, distance below which values count as one, size of the correction) of one correction."""
    r = np.eye(len(a), dtype=WIDE) - product(x.T, x)
    s = product(x.T, product(a, x))
    values = np.diag(s) / (1 - np.diag(r))
    norm = lambda m: float(np.linalg.norm(m.astype(np.float64), 2))
    near = 2 * (norm(s - np.diag(values)) + float(np.abs(values).max()) * norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + product(x, e), values, near, float(np.abs(e).max())


def _clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Indices of ``values``, which rise, in runs whose neighbours are at most ``near`` apart."""
    return np.split(np.arange(len(values)), np.flatnonzero(np.diff(values) > near) + 1)


def eigenpairs(a: np.ndarray, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(values rising, unit vectors as columns) of the symmetric ``a``, in extended precision.

    Equal values have any orthonormal basis of their space. ``scale`` is the size of the whole
    problem that ``a`` is a part of.
    """
    a = a.astype(WIDE)
    k = len(a)
    shift = np.trace(a) / k if k else WIDE(0)
    a = a - shift * np.eye(k, dtype=WIDE)
    largest = np.abs(a).max(initial=0)
    scale = max(largest, abs(shift)) if scale is None else scale
    if k < 2 or largest <= scale * NOISE:
        return np.diag(a) + shift, np.eye(k, dtype=WIDE)
    a = a / largest
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    last = np.inf
    for _ in range(STEPS):
        x, values, near, size = _step(a, x)
        if size < float(NOISE) or size >= last:
            break
        last = size if size < 0.01 else np.inf
    _, values, near, _ = _step(a, x)
    order = np.argsort(values, kind="stable")
    x, values = x[:, order], values[order]
    for run in _clusters(values, near):
        if 1 < len(run) < k:
            own = x[:, run]
            part = product(own.T, product(a, own))
            values[run], turn = eigenpairs((part + part.T) / 2, scale / largest)
            x[:, run] = product(own, turn)
    r = np.eye(k, dtype=WIDE) - product(x.T, x)
    return values * largest + shift, x + product(x, r / 2)
