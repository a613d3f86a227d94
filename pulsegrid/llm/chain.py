"""A linear chain of two states over many sequences at once: forward-backward with numpy.

Sequences are laid end to end; at the first token of each the chain starts afresh. The long row is
cut into equal columns: products of the columns' transition matrices give what enters and leaves
each, then all columns are walked side by side. The result is that of the plain recursion.
"""

from __future__ import annotations

import numpy as np


class Chain:
    """Log weights of starts (2) and of moves (2 by 2); state 1 also has a weight per token."""

    def __init__(self, start: np.ndarray, move: np.ndarray):
        self.start, self.move = np.asarray(start, float), np.asarray(move, float)

    def marginals(self, weight: np.ndarray, first: np.ndarray, pairs: bool = False):
        """The probability of state 1 per token; with ``pairs`` also the expected counts of starts
        and moves and the log of the total weight of all tag sequences."""
        n = len(weight)
        if not n:
            return (np.zeros(0), np.zeros(2), np.zeros((2, 2)), 0.0) if pairs else np.zeros(0)
        columns = max(1, min(4096, int(np.sqrt(n))))
        length = -(-n // columns)
        e = np.zeros(columns * length)
        fresh = np.ones(columns * length, dtype=bool)
        e[:n], fresh[:n] = np.exp(np.clip(weight, -30, 30)), first
        e[n:] = 1.0
        fresh[0] = True
        e, fresh = e.reshape(columns, length).T, fresh.reshape(columns, length).T
        s, m = np.exp(self.start), np.exp(self.move)
        # m[i][j] at each token: the weight of coming from state i into state j
        m00, m10 = np.where(fresh, s[0], m[0, 0]), np.where(fresh, s[0], m[1, 0])
        m01, m11 = np.where(fresh, s[1], m[0, 1]) * e, np.where(fresh, s[1], m[1, 1]) * e

        p00, p01, p10, p11 = np.ones(columns), np.zeros(columns), np.zeros(columns), np.ones(columns)
        for t in range(length):
            p00, p01 = p00 * m00[t] + p01 * m10[t], p00 * m01[t] + p01 * m11[t]
            p10, p11 = p10 * m00[t] + p11 * m10[t], p10 * m01[t] + p11 * m11[t]
            total = p00 + p01 + p10 + p11
            p00, p01, p10, p11 = p00 / total, p01 / total, p10 / total, p11 / total
        enter, leave = np.full((2, columns), 0.5), np.full((2, columns), 0.5)
        for c in range(1, columns):
            a0, a1 = enter[:, c - 1]
            a = np.array([a0 * p00[c - 1] + a1 * p10[c - 1], a0 * p01[c - 1] + a1 * p11[c - 1]])
            enter[:, c] = a / a.sum()
            d = columns - c
            b0, b1 = leave[:, d]
            b = np.array([p00[d] * b0 + p01[d] * b1, p10[d] * b0 + p11[d] * b1])
            leave[:, d - 1] = b / b.sum()

        forward = np.empty((length + 1, 2, columns))
        forward[0] = enter
        scale = np.empty((length, columns))
        for t in range(length):
            a0, a1 = forward[t]
            b0, b1 = a0 * m00[t] + a1 * m10[t], a0 * m01[t] + a1 * m11[t]
            scale[t] = b0 + b1
            forward[t + 1, 0], forward[t + 1, 1] = b0 / scale[t], b1 / scale[t]
        out = np.empty((length, columns))
        moves = np.zeros((2, 2))
        b0, b1 = leave
        for t in range(length - 1, -1, -1):
            a0, a1 = forward[t + 1]
            out[t] = a1 * b1 / (a0 * b0 + a1 * b1)
            if pairs:
                a0, a1 = forward[t]
                x = np.array([[a0 * m00[t] * b0, a0 * m01[t] * b1], [a1 * m10[t] * b0, a1 * m11[t] * b1]])
                moves += np.where(fresh[t], 0.0, x / x.sum(axis=(0, 1))).sum(axis=2)
            b0, b1 = m00[t] * b0 + m01[t] * b1, m10[t] * b0 + m11[t] * b1
            total = b0 + b1
            b0, b1 = b0 / total, b1 / total
        tags = out.T.ravel()[:n]
        if not pairs:
            return tags
        starts = tags[fresh.T.ravel()[:n]]
        # padding starts a sequence of its own at each place; its weight does not count
        log_total = np.log(scale).T.ravel()[:n].sum()
        return tags, np.array([len(starts) - starts.sum(), starts.sum()]), moves, log_total
