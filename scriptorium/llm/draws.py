"""Exact hypergeometric draws of any size, and splits of several colours at once.

numpy's own sampler ends at 10^9. Larger populations are reduced to smaller ones: give every item a uniform number;
the m-th smallest number among the good ones has a Beta law, and the bad ones below it are binomial. Where good and bad
below it are no more than the sample, they are taken and the rest of the sample comes from above; otherwise the sample
comes from those below. Either way what is left is of the order of a square root, so a few steps suffice.
"""

from __future__ import annotations

import numpy as np

SMALL = 1 << 29  # populations below this go to numpy


def hypergeometric(draw: np.random.Generator, good: np.ndarray, bad: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """How many of `sample` items drawn from good + bad ones without replacement are good; arrays of one shape."""
    g, b, n = (np.array(x, np.int64).ravel() for x in (good, bad, sample))
    out, sign = np.zeros(len(g), np.int64), np.ones(len(g), np.int64)
    todo = np.flatnonzero(g + b >= SMALL)
    while len(todo):
        big = todo[2 * n[todo] > g[todo] + b[todo]]  # rather draw those that stay behind
        out[big] += sign[big] * g[big]
        sign[big] *= -1
        n[big] = g[big] + b[big] - n[big]
        few = todo[g[todo] < b[todo]]  # rather count the more frequent kind
        out[few] += sign[few] * n[few]
        sign[few] *= -1
        g[few], b[few] = b[few], g[few]
        todo = todo[(n[todo] > 0) & (b[todo] > 0)]
        m = np.maximum(1, (n[todo] * (g[todo] / (g[todo] + b[todo]))).astype(np.int64))
        below = draw.binomial(b[todo], draw.beta(m, g[todo] - m + 1))
        fits = m + below <= n[todo]
        taken, over = todo[fits], todo[~fits]
        out[taken] += sign[taken] * m[fits]
        g[taken] -= m[fits]
        b[taken] -= below[fits]
        n[taken] -= m[fits] + below[fits]
        g[over], b[over] = m[~fits] - 1, below[~fits]
        todo = todo[g[todo] + b[todo] >= SMALL]
    rest = g + b < SMALL
    out[rest] += sign[rest] * draw.hypergeometric(g[rest], b[rest], n[rest])
    out[~rest] += sign[~rest] * np.where(b[~rest] == 0, n[~rest], 0)  # one kind alone, or an empty sample
    return out


def split(draw: np.random.Generator, counts: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """Multivariate hypergeometric: for each row of counts (rows x colours), how the row's sample falls on its colours."""
    out, left, rest = np.zeros_like(counts), np.array(sample, np.int64), counts.sum(1)
    for c in range(counts.shape[1]):
        rest = rest - counts[:, c]
        out[:, c] = hypergeometric(draw, counts[:, c], rest, left)
        left = left - out[:, c]
    return out
