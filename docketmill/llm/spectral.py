"""Eigenvectors of symmetric matrices by QDWH spectral divide and conquer.

The polar factor U of A - s*I is its sign: (I + U) / 2 projects on the eigenvectors
above the shift s.  A basis of that space and one of its complement split the
matrix into two smaller ones, which are split again until single components or
multiples of the identity are left.  Polar factors come from the dynamically
weighted Halley iteration in its QR form, which needs no inverse and at most some
six steps whatever the condition.
"""

from __future__ import annotations

import numpy as np

_EPS = float(np.finfo(np.float64).eps)
_STEPS = 32
#: Shifts tried besides the median and the mean of the diagonal, as parts of the spread.
_OFFSETS = (0.05, -0.05, 0.2, -0.2, 0.4, -0.4)
SEED = 42


def polar(a: np.ndarray) -> np.ndarray:
    """The symmetric orthogonal factor of a symmetric matrix.

    Where the matrix has an eigenvalue of zero there is no such factor, and the
    result is not orthogonal.
    """
    n = len(a)
    scale = np.linalg.norm(a)
    if scale == 0:
        return np.zeros_like(a)
    x, low, eye = a / scale, _EPS / n, np.eye(n)
    for _ in range(_STEPS):
        squared = low * low
        d = np.cbrt(4 * (1 - squared) / (squared * squared))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - squared) / (squared * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * squared) / (1 + wc * squared))
        if moved <= np.cbrt(4 * _EPS) and 1 - low <= 4 * _EPS:
            break
    return x


def _split(a: np.ndarray, shift: float, random: np.random.Generator) -> tuple[float, np.ndarray, int] | None:
    """Residual, orthonormal columns and how many of them lie above the shift; None if all or none do."""
    n = len(a)
    projector = (np.eye(n) + polar(a - shift * np.eye(n))) / 2
    k = round(float(np.trace(projector)))
    if not 0 < k < n:
        return None
    above = np.linalg.qr(projector @ random.normal(size=(n, k)))[0]
    columns = np.linalg.qr(projector @ above, mode="complete")[0]
    return float(np.linalg.norm(columns[:, k:].T @ a @ columns[:, :k])), columns, k


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and the unit eigenvectors as columns of a symmetric matrix."""
    n = len(a)
    a = (a + a.T) / 2
    scale = float(np.linalg.norm(a))
    exact = 8 * _EPS * scale
    random = np.random.default_rng(SEED)
    todo = [(a, np.eye(n))] if n else []
    done = []
    while todo:
        part, basis = todo.pop()
        size = len(part)
        mean = float(np.trace(part)) / size
        spread = float(np.linalg.norm(part - mean * np.eye(size)))
        if size == 1 or spread <= exact:
            done.append(basis)
            continue
        shifts = [float(np.median(np.diag(part))), mean, *(mean + o * spread / np.sqrt(size) for o in _OFFSETS)]
        best = None
        for shift in shifts:
            found = _split(part, shift, random)
            if found and (best is None or found[0] < best[0]):
                best = found
            if best and best[0] <= exact:
                break
        if best is None:  # all eigenvalues but rounding are equal
            done.append(basis)
            continue
        _, columns, k = best
        for some in (columns[:, :k], columns[:, k:]):
            inner = some.T @ part @ some
            todo.append(((inner + inner.T) / 2, basis @ some))
    vectors = np.hstack(done) if done else np.empty((n, 0))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]
