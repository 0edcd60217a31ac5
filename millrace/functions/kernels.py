"""Kernels for smoothing: plain functions of the offset of a neighbour, negative for earlier rows, positive for later ones."""

from __future__ import annotations

import math
from collections.abc import Callable

Kernel = Callable[[int], float]


def inverse_distance(offset: int) -> float:
    return 1.0 / (abs(offset) + 1)


def gaussian(width: float) -> Kernel:
    """``exp(-d**2 / width)``."""

    def kernel(offset: int) -> float:
        return math.exp(-(offset * offset) / width)

    return kernel
