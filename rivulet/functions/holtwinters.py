"""Additive Holt-Winters smoothing of one series: fit and forecast (NumPy kernel)."""

from __future__ import annotations

from itertools import product

import numpy as np

#: Weights (level, trend, season) that are all tried before the search is refined.
GRID = np.array(list(product((0.1, 0.3, 0.5, 0.7, 0.9), (0.01, 0.1, 0.3), (0.01, 0.1, 0.3, 0.5))))
STARTS, STEPS = 3, 160


def smooth(x: np.ndarray, weights: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """One-step errors and end states for every row of ``weights``, as functions of the start values.

    The recursion is linear in level, trend and season at the start, so every quantity is a row of their
    factors with the known part last: errors are runs x times x (period + 3), end states runs x
    (2 + period) x (period + 3), level and trend first, then the seasons to come.
    """
    a, b, g = (weights[:, i, None] for i in range(3))
    state = np.broadcast_to(np.eye(period + 2, period + 3), (len(weights), period + 2, period + 3)).copy()
    level, trend, season = state[:, 0], state[:, 1], [state[:, 2 + i] for i in range(period)]
    known = np.zeros(period + 3)
    known[-1] = 1
    errors = np.empty((len(weights), len(x), period + 3))
    for t, value in enumerate(x):
        old = season.pop(0)
        errors[:, t] = value * known - (level + trend + old)
        new = a * (value * known - old) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        level = new
        season.append(g * (value * known - level) + (1 - g) * old)
    return errors, np.stack([level, trend, *season], axis=1)


def costs(x: np.ndarray, weights: np.ndarray, period: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Least sum of squared one-step errors for every row of ``weights``, and the start values that reach it."""
    errors, _ = smooth(x, weights, period)
    cost, starts = np.empty(len(weights)), []
    for i, e in enumerate(errors):
        start = np.linalg.lstsq(e[:, :-1], -e[:, -1], rcond=None)[0]
        cost[i] = ((e[:, :-1] @ start + e[:, -1]) ** 2).sum()
        starts.append(start)
    return cost, starts


def _descend(cost, best: np.ndarray, size: float = 0.1) -> tuple[float, np.ndarray]:
    """Simplex search inside the unit cube from ``best``."""
    inside = lambda w: np.clip(w, 0, 1)
    points = [best, *(inside(best + size * np.eye(3)[i] * (1 if best[i] < 0.5 else -1)) for i in range(3))]
    found = sorted(((cost(p), tuple(p)) for p in points))
    for _ in range(STEPS):
        centre, worst = np.mean([p for _, p in found[:3]], axis=0), np.array(found[3][1])
        tried = [inside(centre + f * (centre - worst)) for f in (1, 2, -0.5)]
        values = [cost(tried[0])]
        if values[0] < found[0][0]:
            values.append(cost(tried[1]))
            new = min(zip(values, map(tuple, tried)))
        elif values[0] < found[2][0]:
            new = values[0], tuple(tried[0])
        else:
            new = cost(tried[2]), tuple(tried[2])
        if new[0] < found[3][0]:
            found[3] = new
        else:
            lead = np.array(found[0][1])
            found[1:] = [(cost(p), tuple(p)) for p in ((np.array(q) + lead) / 2 for _, q in found[1:])]
        found.sort()
        if found[3][0] - found[0][0] <= 1e-12 * (1 + found[0][0]) and np.ptp([p for _, p in found], axis=0).max() < 1e-4:
            break
    return found[0][0], np.array(found[0][1])


def fit(x: np.ndarray, period: int, grid: np.ndarray = GRID) -> tuple[np.ndarray, np.ndarray, float]:
    """(weights in [0, 1], start values, squared error) of the fit with the least squared error found; never worse than a grid point."""
    cost, _ = costs(x, grid, period)
    one = lambda w: float(costs(x, np.asarray(w, float)[None], period)[0][0])
    order = np.argsort(cost, kind="stable")[:STARTS]
    found = [(float(cost[order[0]]), grid[order[0]])] + [_descend(one, grid[i]) for i in order]
    error, weights = min(found, key=lambda f: (f[0], tuple(f[1])))
    return weights, costs(x, weights[None], period)[1][0], error


def forecast(x: np.ndarray, weights: np.ndarray, start: np.ndarray, period: int, ahead: int) -> np.ndarray:
    _, end = smooth(x, weights[None], period)
    level, trend, *season = end[0][:, :-1] @ start + end[0][:, -1]
    return np.array([level + h * trend + season[(h - 1) % period] for h in range(1, ahead + 1)])
