"""Eigenvectors of a symmetric matrix by spectral divide and conquer.

The polar factor of ``A - shift`` has the eigenvalues +1 and -1, on the eigenvectors
of ``A`` above and below the shift: it gives the spectral projector of either side.
Bases of the two invariant subspaces cut ``A`` into two smaller symmetric matrices,
and so on until one eigenvalue is left. Polar factors come from QDWH, the
dynamically weighted Halley iteration, by QR while the matrix is far from
orthogonal and by Cholesky after that (Nakatsukasa and Higham, SIAM J. Sci. Comput.
35, 2013). It needs at most six or seven steps however close the shift comes to an
eigenvalue.

For matrices whose side is a number of dimensions, never of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_EPS = float(np.finfo(float).eps)
#: QDWH works with Cholesky as soon as its weight is below this.
_CHOLESKY_BELOW = 100.0
#: A shift is taken at once if no eigenvalue is nearer to it than this (relative).
_CLEAR = 1e-10
_MOST_STEPS = 30


def polar(a: np.ndarray, least: float) -> np.ndarray:
    """The orthogonal polar factor of a square matrix of norm 1 at most.

    ``least`` is a lower bound of the smallest singular value.
    """
    x, low = a, min(1.0, max(least, _EPS**2))
    one = np.eye(len(a))
    for _ in range(_MOST_STEPS):
        # The weights that bring the interval [low, 1] nearest to 1.
        gamma = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + gamma)
        wa = root + 0.5 * np.sqrt(8 - 4 * gamma + 8 * (2 - low**2) / (low**2 * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc >= _CHOLESKY_BELOW:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, one]))
            step = q[: len(a)] @ q[len(a) :].T / np.sqrt(wc)
        else:
            lower = np.linalg.cholesky(one + wc * (x.T @ x))
            step = np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        after = wb / wc * x + (wa - wb / wc) * step
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        moved = np.linalg.norm(after - x)
        x = after
        if moved <= np.cbrt(5 * _EPS) and 1 - low <= 10 * _EPS:
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Points between the least and the largest eigenvalue."""
    diagonal = np.sort(np.diag(a))
    mean = float(diagonal.mean())  # strictly between, unless all are equal
    yield float(np.median(diagonal))
    yield mean
    for share in (0.5, 0.25, 0.75, 0.125, 0.875):
        spread = float(np.linalg.norm(a - mean * np.eye(len(a))) / np.sqrt(len(a)))
        yield mean + (share - 0.5) * spread


def _positive_projector(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """The projector on the eigenvectors above a shift that cuts the spectrum."""
    best: tuple[float, np.ndarray] | None = None
    one = np.eye(len(a))
    for shift in _shifts(a):
        moved = a - shift * one
        moved /= np.linalg.norm(moved)
        r = np.linalg.qr(moved, mode="r")
        if np.abs(np.diag(r)).min() == 0:
            continue
        least = 1 / float(np.linalg.norm(np.linalg.solve(r, one)))
        if best is not None and least <= best[0]:
            continue
        projector = (polar(moved, least) + one) / 2
        if 0 < round(float(np.trace(projector))) < len(a):
            best = (least, projector)
            if least >= _CLEAR:
                break
    return None if best is None else (best[1], round(float(np.trace(best[1]))))


def _bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector and of what it leaves out."""
    start = np.random.default_rng(0).standard_normal((len(projector), rank))
    for _ in range(2):
        q, _ = np.linalg.qr(projector @ start, mode="complete")
        start = q[:, :rank]
    return q[:, :rank], q[:, rank:]


def components(a: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and their unit eigenvectors as columns: the ``most`` first.

    Of each eigenvector the entry with the largest magnitude is positive. Parts of
    the spectrum below the ``most`` first are not split up.
    """
    a = (a + a.T) / 2
    scale = float(np.linalg.norm(a))
    most = len(a) if most is None else min(most, len(a))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    # The upper part of the spectrum lies on top.
    parts = [(a, np.eye(len(a)))] if len(a) else []
    while parts and len(values) < most:
        part, basis = parts.pop()
        mean = float(np.trace(part)) / len(part)
        apart = np.linalg.norm(part - mean * np.eye(len(part)))
        cut = None
        if apart > 4 * _EPS * scale:
            cut = _positive_projector(part)
        if cut is None:  # one eigenvalue, once or several times
            values += [mean] * len(part)
            vectors.append(basis)
            continue
        upper, lower = _bases(*cut)
        for own in (lower, upper):
            below = own.T @ part @ own
            parts.append(((below + below.T) / 2, basis @ own))
    if not values:
        return np.zeros(0), np.zeros((len(a), 0))
    columns = np.hstack(vectors)
    # One Rayleigh quotient each: the error is that of the vector, squared.
    found = np.einsum("ij,ij->j", columns, a @ columns)
    order = np.argsort(-found, kind="stable")[:most]
    columns = columns[:, order]
    largest = columns[np.abs(columns).argmax(axis=0), np.arange(len(order))]
    return found[order], columns * np.where(largest < 0, -1.0, 1.0)
