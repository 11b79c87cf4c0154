"""db4 filter bank on one series (NumPy), with the circular phase of the usual periodised transform."""

from __future__ import annotations

import numpy as np

# db4 low-pass decomposition taps (Daubechies, 1992).
DB4_LOW = np.array([
    -0.010597401784997278, 0.032883011666982945, 0.030841381835986965, -0.18703481171888114,
    -0.02798376941698385, 0.6308807679295904, 0.7148465705525415, 0.23037781330885523,
])
DB4_HIGH = DB4_LOW[::-1] * np.array([-1.0, 1.0] * 4)
LEVELS = 5


def _taps(n: int, every: int, spread: int) -> np.ndarray:
    """Input position of each tap for each output, wrapped around the end."""
    half = len(DB4_LOW) * spread // 2
    return (half + np.arange(0, n, every)[:, None] - spread * np.arange(len(DB4_LOW))) % n


def decompose(x: np.ndarray, levels: int = LEVELS) -> list[np.ndarray]:
    """[approximation, detail of the last level, ..., detail of level 1]; an odd length repeats its last value."""
    details = []
    for _ in range(levels):
        x = np.append(x, x[-1]) if len(x) % 2 else x
        window = x[_taps(len(x), 2, 1)]
        x, detail = window @ DB4_LOW, window @ DB4_HIGH
        details.insert(0, detail)
    return [x, *details]


def compose(parts: list[np.ndarray], length: int) -> np.ndarray:
    """Inverse of ``decompose`` for a series of ``length`` values."""
    sizes = [length]
    for _ in parts[2:]:
        sizes.append((sizes[-1] + 1) // 2)
    x = parts[0]
    for detail, size in zip(parts[1:], reversed(sizes)):
        n = 2 * len(detail)
        spots = _taps(n, 2, 1)
        out = np.zeros(n)
        np.add.at(out, spots, x[:, None] * DB4_LOW + detail[:, None] * DB4_HIGH)
        x = out[:size]
    return x


def stationary(x: np.ndarray, levels: int = LEVELS) -> list[np.ndarray]:
    """Undecimated transform with filters over sqrt 2 (keeps the energy): [approximation, details last to first].

    A length that is no multiple of 2**levels is filled up with its last value; the fill is cut off again.
    """
    n = len(x)
    x = np.pad(x, (0, -n % 2**levels), mode="edge")
    details = []
    for level in range(levels):
        window = x[_taps(len(x), 1, 2**level)] / np.sqrt(2.0)
        x, detail = window @ DB4_LOW, window @ DB4_HIGH
        details.insert(0, detail)
    return [part[:n] for part in (x, *details)]
