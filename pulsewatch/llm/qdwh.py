"""Eigenvectors of a symmetric matrix by spectral divide and conquer.

The polar decomposition of a shifted block A - sI = U H has a factor U with eigenvalue 1 where A's is above the shift and -1 where it
is below, so (I + U) / 2 projects on the invariant subspace of the larger ones. Both subspaces are split again until single
components are left. U comes from the QR-based, dynamically weighted Halley iteration, six rounds at most for any conditioning.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix."""
    size = len(a)
    x = a / np.linalg.norm(a)
    low, unit = EPS / 4, np.eye(size)
    for _ in range(30):
        low2 = low * low
        d = np.cbrt(4 * (1 - low2) / low2 ** 2) if low < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(8 - 4 * d + 8 * (2 - low2) / (low2 * root), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, unit]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:size] @ q[size:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * low2) / (1 + wc * low2))
        if low > 1 - 10 * EPS and moved <= EPS ** (1 / 3):
            break
    return x


def _range(projector: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """An orthonormal basis of what a projector of this rank keeps."""
    basis = np.random.default_rng(seed).standard_normal((len(projector), rank))
    for _ in range(3):
        basis, _ = np.linalg.qr(projector @ basis)
    return basis


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the subspaces of the larger and the smaller eigenvalues; None if all are equal to working accuracy."""
    size, mean = len(a), np.trace(a) / len(a)
    if size == 1 or np.linalg.norm(a - mean * np.eye(size)) <= 4 * EPS * scale:
        return None
    best = None
    for shift in (np.median(np.diag(a)), mean, (np.diag(a).max() + mean) / 2, (np.diag(a).min() + mean) / 2):
        above = (np.eye(size) + polar(a - shift * np.eye(size))) / 2
        rank = int(round(np.trace(above)))
        if 0 < rank < size:
            high, low = _range(above, rank, size), _range(np.eye(size) - above, size - rank, size + 1)
            left = np.linalg.norm(high.T @ a @ low)
            if best is None or left < best[0]:
                best = left, high, low
            if left <= 50 * EPS * scale:
                break
    return best and best[1:]


def components(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns. Subspaces below them are not split."""
    a = (a + a.T) / 2
    scale = np.linalg.norm(a)
    todo, found = [np.eye(len(a))] if len(a) else [], []
    while todo and len(found) < count:
        basis = todo.pop()
        block = basis.T @ a @ basis
        parts = _split((block + block.T) / 2, scale)
        if parts is None:
            found += list(basis.T)
        else:
            high, low = parts
            todo += [basis @ low, basis @ high]
    vectors = np.array(found).reshape(len(found), len(a)).T
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:count]
    return values[order], vectors[:, order]
