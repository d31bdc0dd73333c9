"""Tail probabilities of test statistics, for single numbers already reduced by Spark."""

from __future__ import annotations

import math


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_tail(x: float, df: int) -> float:
    """P(X > x) for a chi-square variable: recurrence over the degrees of freedom."""
    if x <= 0:
        return 1.0
    half = x / 2.0
    # Q(k + 2) = Q(k) + (x/2)^(k/2) e^(-x/2) / Gamma(k/2 + 1)
    if df % 2:
        tail, k, add = math.erfc(math.sqrt(half)), 1, math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    else:
        tail, k, add = math.exp(-half), 2, math.exp(-half) * half
    while k < df:
        tail += add
        k += 2
        add *= half / (k / 2.0)
    return min(1.0, tail)
