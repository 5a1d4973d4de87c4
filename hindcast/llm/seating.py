"""Sampling of the number of tables in Pitman-Yor restaurants.

Given the tables of all other dishes, the tables t of a dish with c customers have a probability in proportion to
``S(c, t) * p ** t * product of (strength + d * k) for k from 0 to t - 1``, where p is the parent's probability of the
dish, ``strength`` holds the tables of the others (theta + d * others) and S are generalised Stirling numbers, which
count the ways to seat c customers at t tables. ``sample_tables`` draws from exactly this up to ``EXACT`` customers.
Beyond it, ratios of Stirling numbers come from their alternating sum or a saddle point of their generating function; a
test compares the draws.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from math import lgamma

import numpy as np

EXACT = 1024
_CELLS = 1 << 17


def gammaln(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function, but for small arguments by its asymptotic series."""
    x = np.asarray(x, float)
    y = np.maximum(x, 10.0)
    out = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    few = np.flatnonzero(x < 10)
    out[few] = [lgamma(v) for v in x[few].tolist()]
    return out


@lru_cache(maxsize=4)
def stirling_logs(d: float, n: int = EXACT) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: row c, column t - 1."""
    out = np.full((n + 1, n), -np.inf)
    out[1, 0] = 0.0
    with np.errstate(divide="ignore"):
        for c in range(1, n):
            k = np.arange(1, c + 2)
            stay = np.log(np.maximum(c - d * k, 0.0)) + out[c, : c + 1]
            opened = np.concatenate([[-np.inf], out[c, :c]])
            out[c + 1, : c + 1] = np.logaddexp(stay, opened)
    return out


def sample_tables(c: np.ndarray, strength: np.ndarray, d: float, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish; ``c`` is 1 or more, and a dish with one customer has one table."""
    out = np.ones(len(c), np.int64)
    two = np.flatnonzero(c == 2)
    odds = (strength[two] + d) * p[two] / (1 - d)
    out[two] += rng.random(len(two)) * (1 + odds) < odds
    low = 2
    while low < min(EXACT, int(c.max()) if len(c) else 0):
        high = min(2 * low, EXACT)
        some = np.flatnonzero((c > low) & (c <= high))
        for a in range(0, len(some), max(1, _CELLS // high)):
            x = some[a : a + max(1, _CELLS // high)]
            grow = np.log((strength[x, None] + d * np.arange(high)) * p[x, None])
            np.cumsum(grow, axis=1, out=grow)
            grow += stirling_logs(d)[c[x], :high]
            grow -= np.log(rng.standard_exponential(grow.shape))  # the largest sum with Gumbel noise is a draw
            out[x] = grow.argmax(axis=1) + 1
        low = high
    many = np.flatnonzero(c > EXACT)
    if len(many):
        out[many] = sample_large(c[many], strength[many], d, p[many], rng)
    return out


def _saddle(u: np.ndarray, c: float, d: float) -> tuple[np.ndarray, np.ndarray]:
    """Tables whose saddle point is 1 - u, and the logarithm of (1 - u ** d) / d there."""
    rest = -np.expm1(d * np.log(u))
    return c * u ** (1 - d) * rest / (d * (1 - u)), np.log(rest / d)


def _solve(below: Callable[[np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """Where a condition on u that holds from 0 upwards ends, for n problems, by bisection of log u."""
    low, high = np.full(n, -700.0), np.full(n, -1e-12)
    for _ in range(70):
        middle = (low + high) / 2
        holds = below(np.exp(middle))
        low, high = np.where(holds, middle, low), np.where(holds, high, middle)
    return np.exp((low + high) / 2)


def saddle_logs(c: float, t: np.ndarray, d: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers of c and some ascending t, by a saddle point 1 - u of their generating
    function ((1 - (1 - z) ** d) / d) ** t / t!, but for what is the same for all t."""
    first = _solve(lambda x: _saddle(x, c, d)[0] < (t[0] + t[-1]) / 2, 1)
    y, aim = np.full(len(t), np.log(first[0])), np.log(t / c)
    for _ in range(12):  # Newton steps on log u
        rest, gap = -np.expm1(d * y), -np.expm1(y)
        slope = (1 - d) - d * np.exp(d * y) / rest + np.exp(y) / gap
        y = np.clip(y - ((1 - d) * y + np.log(rest / (d * gap)) - aim) / slope, -700, -1e-12)
    u, rest = np.exp(y), -np.expm1(d * y)
    second = c * (1 - u) * (1 / (1 - u) + (1 - d) / u - d * u ** (d - 1) / rest)
    return -gammaln(t + 1) + t * np.log(rest / d) - c * np.log1p(-u) - np.log(second) / 2


def series_logs(c: float, t: np.ndarray, d: float, terms: int = 150) -> np.ndarray:
    """The same logarithms (but for what is the same for all t) from the alternating sum over j of Gamma(c - j d), good where t is few times c ** d."""
    j = np.arange(1, terms + 1)
    with np.errstate(divide="ignore"):
        logs = np.cumsum(np.log(np.maximum(t[:, None] - j + 1, 0) / j), axis=1)
    term = np.exp(logs + gammaln(c - j * d) - gammaln(np.array([c])) + gammaln(1 + j * d)) * np.sin(np.pi * j * d) * np.where(j % 2 == 1, 1, -1)
    return -t * np.log(d) - gammaln(t + 1) + np.log(np.maximum(term.sum(axis=1), 1e-300))


def large_logs(c: float, t: np.ndarray, d: float) -> np.ndarray:
    """Logarithms for consecutive t: steps from the sum while t is small beside c ** d, and from the saddle point beyond."""
    near = int(np.searchsorted(t, (5 if d < 0.4 else 3 if d < 0.6 else 1) * c**d))
    step = np.diff(saddle_logs(c, t, d))
    if near > 1:
        step[: near - 1] = np.diff(series_logs(c, t[:near], d))
    if len(t) > 2 and t[-1] == c:  # one or two customers share a table with others
        one = np.log(c * (c - 1) / 2 * (1 - d))
        two = np.log(c * (c - 1) * (c - 2) / 6 * (1 - d) * (2 - d) + c * (c - 1) * (c - 2) * (c - 3) / 8 * (1 - d) ** 2)
        step[-2:] = one - two, -one
    return np.concatenate([[0.0], np.cumsum(step)])


def sample_large(c: np.ndarray, strength: np.ndarray, d: float, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with many customers: a draw from the conditional near its mode, twelve deviations to each side."""
    out = np.empty(len(c), np.int64)

    def opens(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t, f = _saddle(u, c, d)
        return t, np.log((strength + d * t) * p) + f - np.log(np.maximum(t, 1e-300))

    u = _solve(lambda x: opens(x)[1] > 0, len(c))
    (t0, r0), (t1, r1) = opens(u * 0.999), opens(np.minimum(u * 1.001, 1 - 1e-12))
    width = 12 * np.sqrt(np.maximum((t1 - t0) / np.maximum(r0 - r1, 1e-12), 1.0)) + 40
    least, most = np.maximum(1, t0 - width).astype(np.int64), np.minimum(c, t1 + width).astype(np.int64)
    for k, (n, s, q) in enumerate(zip(c.astype(float).tolist(), strength.tolist(), p.tolist(), strict=True)):
        t = np.arange(least[k], most[k] + 1)
        logs = large_logs(n, t, d) + gammaln(s / d + t) + t * np.log(d * q)  # strength + d * k, one after another
        out[k] = t[(logs - np.log(rng.standard_exponential(len(t)))).argmax()]
    return out


def sweep(of: np.ndarray, c: np.ndarray, t: np.ndarray, tables: np.ndarray, theta: float, d: float, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One Gibbs sweep over dishes sorted by restaurant (``of``): new tables; ``tables`` (of each restaurant) is kept up.

    Restaurants go side by side, and the dishes of one restaurant one after another for the first eight, then in blocks
    that grow by a fourth, each with the tables that all blocks before it left.
    """
    n = np.bincount(of, minlength=len(tables))
    rank = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    block = np.where(rank < 8, rank, 8 + np.log(np.maximum(rank, 8) / 8) / np.log(1.25)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    edge = np.searchsorted(block[order], np.arange(int(block.max()) + 2 if len(block) else 1))
    t = t.copy()
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        x = order[a:b]
        new = sample_tables(c[x], theta + d * (tables[of[x]] - t[x]), d, p[x], rng)
        np.add.at(tables, of[x], new - t[x])
        t[x] = new
    return t
