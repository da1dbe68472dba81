"""F distribution: regularised incomplete beta by continued fraction, quantile by bisection."""

from __future__ import annotations

from math import exp, lgamma, log


def incomplete_beta(a: float, b: float, x: float) -> float:
    """I_x(a, b)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x)) / a
    tiny = 1e-300
    f = c = 1.0
    d = 0.0
    for i in range(400):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + term * d or tiny)
        c = 1 + term / c or tiny
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    return front * (f - 1)


def f_cdf(x: float, d1: float, d2: float) -> float:
    return incomplete_beta(d1 / 2, d2 / 2, d1 * x / (d1 * x + d2)) if x > 0 else 0.0


def f_quantile(p: float, d1: float, d2: float) -> float:
    """The x with P(F <= x) = p."""
    if not 0 < p < 1:
        raise ValueError("p must lie between 0 and 1")
    low, high = 0.0, 1.0
    while f_cdf(high, d1, d2) < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if f_cdf(mid, d1, d2) < p else (low, mid)
    return (low + high) / 2
