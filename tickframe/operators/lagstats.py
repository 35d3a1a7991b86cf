"""Normal equations of windowed regressions from lagged products.

A sample that starts at row ``s`` has as features the channels' rows
``s .. s+n_in-1`` (each channel at every step), further channels on its last
row (the anchor), and a 1; its labels are the first channel's rows
``s+n_in .. s+n_in+n_out-1``. Over a contiguous range of samples, the product
sum of channel a at step i and channel b at step i+k is

    sum_s a[s+i] b[s+i+k]
      = sum_s a[s] b[s+k]  +  (rows that enter at the end)  -  (rows that leave at the start),

so X'X and X'Y follow from one number per pair of channels and lag, and the
first and last rows of the range. These numbers add up over ranges: a task
emits them for its rows, and Spark sums them per entity. They take
``lags`` numbers where X'X and X'Y would take ``lags`` squared.
"""

from __future__ import annotations

import numpy as np


class LagLayout:
    """Which numbers are kept, and where, for ``n_window`` channels with all
    their steps and ``n_anchor`` channels of which only the anchor counts."""

    def __init__(self, n_in: int, n_out: int, n_window: int, n_anchor: int):
        self.n_in, self.n_out, self.n_window, self.n_anchor = n_in, n_out, n_window, n_anchor
        self.span = n_in + n_out
        self.extra = n_anchor + 1  # and the constant 1
        self.width = n_window * n_in + self.extra
        #: channel 0 is also the label and has lags into the labels
        self.reach = [self.span if b == 0 else n_in for b in range(n_window)]
        self.upper = np.triu_indices(self.extra)
        self.size = (n_window + self.extra) * sum(self.reach) + len(self.upper[0])

    def sums(self, rows: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Lag sums of the samples that start at rows ``start .. stop-1`` of
        the matrix ``rows`` (window channels first, then anchor channels),
        packed in one vector."""
        window = [np.ascontiguousarray(rows[start:stop + self.span - 1, b]) for b in range(self.n_window)]
        m, anchor = stop - start, slice(start + self.n_in - 1, stop + self.n_in - 1)
        ends = np.column_stack([rows[anchor, self.n_window:], np.ones(m)])
        left = [w[:m] for w in window] + [np.ascontiguousarray(e) for e in ends.T]
        out = [np.correlate(window[b][:m + self.reach[b] - 1], a, "valid") for a in left for b in range(self.n_window)]
        out.append((ends.T @ ends)[self.upper])
        return np.concatenate(out)

    def equations(self, sums: np.ndarray, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(X'X, X'Y) of the samples behind ``sums``, which start at rows
        0..m-1: ``head`` holds the window channels' rows from 0 on, ``tail``
        those from row m on (``span - 1`` rows each)."""
        cuts = np.cumsum([r for _ in range(self.n_window + self.extra) for r in self.reach])
        lags = np.split(sums, cuts)
        gram, cross = np.zeros((self.width, self.width)), np.zeros((self.width, self.n_out))
        n_in, first_extra = self.n_in, self.n_window * self.n_in
        for a in range(self.n_window):
            for b in range(self.n_window):
                reach = self.reach[b]
                both = np.zeros((n_in, reach))  # [step i, lag k]
                both[0] = lags[a * self.n_window + b]
                for i in range(1, n_in):
                    k = reach - i  # lags that stay inside the sample
                    both[i, :k] = both[i - 1, :k] + tail[i - 1, a] * tail[i - 1:i - 1 + k, b] - head[i - 1, a] * head[i - 1:i - 1 + k, b]
                for i in range(n_in):
                    gram[a * n_in + i, b * n_in + i:(b + 1) * n_in] = both[i, :n_in - i]
                    gram[b * n_in + i:(b + 1) * n_in, a * n_in + i] = both[i, :n_in - i]
                    if b == 0:
                        cross[a * n_in + i] = both[i, n_in - i:self.span - i]
        for e in range(self.extra):
            for b in range(self.n_window):
                own = lags[(self.n_window + e) * self.n_window + b]
                gram[first_extra + e, b * n_in:(b + 1) * n_in] = gram[b * n_in:(b + 1) * n_in, first_extra + e] = own[:n_in]
                if b == 0:
                    cross[first_extra + e] = own[n_in:]
        square = np.zeros((self.extra, self.extra))
        square[self.upper] = lags[-1]
        gram[first_extra:, first_extra:] = square + np.triu(square, 1).T
        return gram, cross

    def samples(self, end: int) -> int:
        """How many samples lie in the first ``end`` rows."""
        return max(end - self.span + 1, 0)

    def fit(self, sums: np.ndarray, head: np.ndarray, tail: np.ndarray, ridge: float) -> np.ndarray:
        """The ridge coefficients (features x labels) of these samples; the
        penalty is ``ridge`` times the mean of the diagonal of X'X."""
        return self._ridge(lambda: self.equations(sums, head, tail), ridge)

    def fit_rows(self, rows: np.ndarray, counts, ridge: float) -> list:
        """The same coefficients for the first ``m`` samples of ``rows``, for
        each ``m`` of the rising ``counts`` (none for 0), by (XX' + l)^-1 Y:
        the smaller system where samples are fewer than features. All share
        one XX', as sample s+1 by t+1 differs from s by t in one row each."""
        most, n_in = counts[-1], self.n_in
        out = [None] * len(counts)
        if not most:
            return out
        window, ends = rows[:most + n_in - 1, :self.n_window], np.column_stack([rows[n_in - 1:most + n_in - 1, self.n_window:], np.ones(most)])
        along = window @ window.T
        for s in range(1, len(along)):  # running sums down the diagonals
            along[s, 1:] += along[s - 1, :-1]
        both = along[n_in - 1:, n_in - 1:].copy()
        both[1:, 1:] -= along[:most - 1, :most - 1]
        del along
        both += ends @ ends.T
        steps = np.lib.stride_tricks.sliding_window_view
        labels = steps(rows[n_in:most + self.span - 1, 0], self.n_out)
        for k, m in enumerate(counts):
            if m:
                dual = self._ridge(lambda m=m: (both[:m, :m].copy(), labels[:m]), ridge)
                inputs = [np.ascontiguousarray(steps(window[:m + n_in - 1, b], n_in)).T @ dual for b in range(self.n_window)]
                out[k] = np.concatenate([*inputs, ends[:m].T @ dual])
        return out

    def _ridge(self, made, ridge: float) -> np.ndarray:
        """Solve what ``made`` makes, X'X or XX' and a right side, penalised.
        X'X and XX' have the same trace."""
        def penalised():
            a, y = made()
            a.ravel()[::len(a) + 1] += ridge * max(np.trace(a) / self.width, 1e-12)
            return a, y

        try:
            return solve_in_place(*penalised())
        except np.linalg.LinAlgError:  # not positive, to rounding: a penalty of about nothing
            return np.linalg.solve(*penalised())

    def features(self, rows: np.ndarray, anchor: int) -> np.ndarray:
        """The feature vector of the sample whose last input row is ``anchor``."""
        inputs = rows[anchor - self.n_in + 1:anchor + 1, :self.n_window].T.ravel()
        return np.concatenate([inputs, rows[anchor, self.n_window:], [1.0]])


def solve_in_place(a: np.ndarray, y: np.ndarray, block: int = 256) -> np.ndarray:
    """``x`` of ``a x = y`` for a positive definite ``a``, by a Cholesky
    factor that is written over ``a``'s lower half, block by block: half the
    work of a general solve, and no second matrix of ``a``'s size."""
    cuts = [(k, min(k + block, len(a))) for k in range(0, len(a), block)]
    for lo, hi in cuts:
        a[lo:hi, lo:hi] = np.linalg.cholesky(a[lo:hi, lo:hi])
        below = a[hi:, lo:hi] = np.linalg.solve(a[lo:hi, lo:hi], a[hi:, lo:hi].T).T
        for k in range(0, len(below), block):
            a[hi + k:, hi + k:hi + k + block] -= below[k:] @ below[k:k + block].T
    x = y.copy()
    for lo, hi in cuts:
        x[lo:hi] = np.linalg.solve(a[lo:hi, lo:hi], x[lo:hi] - a[lo:hi, :lo] @ x[:lo])
    for lo, hi in reversed(cuts):
        x[lo:hi] = np.linalg.solve(a[lo:hi, lo:hi].T, x[lo:hi] - a[hi:, lo:hi].T @ x[hi:])
    return x
