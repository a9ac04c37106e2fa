"""The bivariate normal behind phi_k (Baak et al., 2018), for blocks of a contingency table."""

from __future__ import annotations

from math import erf, exp, pi, sqrt
from statistics import NormalDist

import numpy as np

_EDGE = 8.0
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(64)
_STEP = 2.0**-11
_GRID = np.arange(-_EDGE - 1, _EDGE + 1 + _STEP, _STEP)
_BELOW = np.array([0.5 * (1 + erf(z / sqrt(2))) for z in _GRID.tolist()])
_SLOPE = np.array([exp(-z * z / 2) / sqrt(2 * pi) for z in _GRID.tolist()]) * _STEP


def normal_cdf(z: np.ndarray) -> np.ndarray:
    """Standard normal distribution function: cubic interpolation of a fine table (error < 1e-14)."""
    at = (np.clip(z, _GRID[0], _GRID[-2]) - _GRID[0]) / _STEP
    i = np.minimum(at.astype(np.int64), len(_GRID) - 2)
    u = at - i
    a, b, s, t = _BELOW[i], _BELOW[i + 1], _SLOPE[i], _SLOPE[i + 1]
    return a + u * (s + u * (3 * (b - a) - 2 * s - t + u * (2 * (a - b) + s + t)))


def cut_points(shares: np.ndarray) -> np.ndarray:
    """Standard normal points below which these shares lie; the ends are far out."""
    normal = NormalDist()
    return np.array(
        [-_EDGE if p <= 0 else _EDGE if p >= 1 else min(max(normal.inv_cdf(p), -_EDGE), _EDGE) for p in shares]
    )


def block_sums(x: np.ndarray, y: np.ndarray, rhos: np.ndarray) -> np.ndarray:
    """For each correlation the sum over cells of P^2 / expected, P being a cell's share under a
    bivariate normal and expected the product of its marginal shares.

    ``x`` and ``y`` are tables of two columns: where each level's share begins and ends.
    """
    width, height = x[:, 1] - x[:, 0], y[:, 1] - y[:, 0]
    expected = width[:, None] * height[None, :]
    low, high = cut_points(x[:, 0]), cut_points(x[:, 1])
    half = (high - low) / 2
    nodes = (low + half)[:, None] + half[:, None] * _NODES[None, :]
    density = np.exp(-nodes * nodes / 2) / np.sqrt(2 * np.pi) * half[:, None] * _WEIGHTS[None, :]
    # levels of one block follow each other: edges are the first beginning and all ends
    shares = np.append(y[:1, 0], y[:, 1])
    edges = cut_points(shares)
    sums = []
    for rho in rhos:
        if rho >= 1:
            cell = np.minimum(x[:, 1:], y[None, :, 1]) - np.maximum(x[:, :1], y[None, :, 0])
            cell = np.maximum(cell, 0)
        else:
            below = normal_cdf((edges[None, None, :] - rho * nodes[:, :, None]) / np.sqrt(1 - rho * rho))
            below[:, :, shares <= 0], below[:, :, shares >= 1] = 0.0, 1.0
            cell = np.einsum("in,inj->ij", density, np.diff(below, axis=2))
        sums.append(float((cell * cell / expected).sum()))
    return np.array(sums)


#: Terms of the expansion of a bivariate normal in Hermite functions. What is left out of the sum
#: of P^2 / expected is below rho^(2 TERMS) / (1 - rho^2).
TERMS = 96
#: Correlations up to which the expansion is used.
HIGHEST = 0.97


def coefficients(spans: np.ndarray, terms: int = TERMS) -> np.ndarray:
    """For each level, with its share's beginning and end, the integrals of the normalised Hermite
    functions 0 to ``terms``: a cell's share under correlation rho is ``sum_k rho^k a_k b_k``."""

    def edges(shares: np.ndarray) -> np.ndarray:
        z = cut_points(shares)
        inside = (shares > 0) & (shares < 1)
        density = np.where(inside, np.exp(-z * z / 2) / sqrt(2 * pi), 0.0)
        out = np.zeros((len(z), terms + 1))
        before, now = np.zeros_like(z), np.ones_like(z)
        for k in range(1, terms + 1):
            out[:, k] = now * density / sqrt(k)
            before, now = now, (z * now - sqrt(k - 1) * before) / sqrt(k)
        return out

    found = edges(spans[:, 0]) - edges(spans[:, 1])
    found[:, 0] = spans[:, 1] - spans[:, 0]
    return found


def level_sums(spans: np.ndarray, terms: int = TERMS) -> np.ndarray:
    """What levels of one column add to its pair: ``sum a_k a_l / p`` for all k, l, then ``sum a_k / p``."""
    a = coefficients(spans, terms)
    share = (spans[:, 1] - spans[:, 0])[:, None]
    return np.append(((a / share).T @ a).ravel(), (a / share).sum(0))


def expected_sums(x: np.ndarray, y: np.ndarray, rhos: np.ndarray, terms: int = TERMS) -> tuple[np.ndarray, np.ndarray]:
    """Per correlation the sums over all cells of P^2 / expected and of P / expected, from both
    columns' :func:`level_sums`."""
    k = terms + 1
    squares = (x[: k * k] * y[: k * k]).reshape(k, k)
    powers = np.asarray(rhos)[:, None] ** np.arange(k)
    return np.einsum("rk,kl,rl->r", powers, squares, powers), powers @ (x[k * k :] * y[k * k :])
