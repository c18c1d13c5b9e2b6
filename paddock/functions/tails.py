"""Tail probabilities for the few statistics a run reports.

These work on single numbers; the statistics themselves are aggregated by Spark beforehand.
"""

from __future__ import annotations

import math

TINY = 1e-300


def normal_upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def student_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) as the regularised incomplete beta function at df/(df+t^2)."""
    return _beta_regularised(df / 2, 0.5, df / (df + t * t))


def chi_squared_upper(x: float, df: float) -> float:
    return _gamma_upper(df / 2, x / 2)


def rank_sum_upper(u: int, n1: int, n2: int) -> float:
    """P(U >= u) of the rank sum statistic of samples of n1 and n2 values without ties; exact, in whole numbers.

    With m values in the smaller sample and n in the other, the orders with U = k are counted by the Gaussian binomial, the
    product of (1 - q^(n+i)) / (1 - q^i) for i = 1 to m, and those with U <= k by that divided by 1 - q. All divisors
    divide 1 - q^s, s the least common multiple of 1 to m, so that a coefficient is a sum of a few binomials, however
    large n is. The work grows with s: the smaller sample must have few values.
    """
    m, n = sorted((n1, n2))
    at_most = n1 * n2 - max(u, 0)  # U and n1*n2 - U are distributed alike
    step = math.lcm(*range(1, m + 1))
    part = [0] * ((m + 1) * step + 1)  # (1 - q^step)^(m + 1) divided by all divisors
    for j in range(m + 2):
        part[j * step] = (-1) ** j * math.comb(m + 1, j)
    for i in (1, *range(1, m + 1)):
        for k in range(i, len(part)):
            part[k] += part[k - i]
    above = {0: 1}  # the product of the (1 - q^(n+i)), by exponent
    for i in range(1, m + 1):
        for k, c in list(above.items()):
            above[k + n + i] = above.get(k + n + i, 0) - c
    count = 0
    for k, c in above.items():
        left = at_most - k
        for r in range(left % step, min(left, len(part) - 1) + 1, step) if left >= 0 else ():
            count += c * part[r] * math.comb((left - r) // step + m, m)
    return count / math.comb(m + n, m)


def _lentz(b0: float, terms) -> float:
    """Value of the continued fraction b0 + a1/(b1 + a2/(b2 + ...)) by the modified Lentz method."""
    f = b0 or TINY
    c, d = f, 0.0
    for a, b in terms:
        d = 1 / ((b + a * d) or TINY)
        c = (b + a / c) or TINY
        f *= c * d
        if abs(c * d - 1) < 1e-16:
            break
    return f


def _beta_regularised(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_regularised(b, a, 1 - x)
    front = a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)

    def terms():
        for k in range(1, 10_000):
            m = k // 2
            if k % 2:
                top = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            else:
                top = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            yield top, 1.0

    return math.exp(front) / a / _lentz(1.0, terms())


def _gamma_upper(s: float, x: float) -> float:
    if x <= 0:
        return 1.0
    front = s * math.log(x) - x - math.lgamma(s)
    if x < s + 1:
        term = total = 1 / s
        k = s
        while term > total * 1e-17:
            k += 1
            term *= x / k
            total += term
        return 1 - total * math.exp(front)
    terms = ((-k * (k - s), x + 2 * k + 1 - s) for k in range(1, 10_000))
    return math.exp(front) / _lentz(x + 1 - s, terms)


def p_value(test: str, statistic: float | None, df: float | None) -> float | None:
    """p of a statistic: `t` two-sided, `chi2` upper, `z_upper` and `z_lower` one-sided normal."""
    if statistic is None or math.isnan(statistic):
        return None
    if test == "t":
        return student_two_sided(statistic, df)
    if test == "chi2":
        return chi_squared_upper(statistic, df)
    return normal_upper(statistic if test == "z_upper" else -statistic)
