"""Linear-chain conditional random fields with two states, over many sequences at once."""

from __future__ import annotations

import numpy as np


class Chains:
    """Sequences of different lengths side by side: step t of the longest ``live[t]`` of them."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        sizes = lengths[self.order]
        steps = int(sizes[0]) if len(sizes) else 0
        self.live = len(sizes) - np.searchsorted(sizes[::-1], np.arange(steps), side="right")
        starts = (np.cumsum(lengths) - lengths)[self.order]
        self.at = np.concatenate(([0], np.cumsum(self.live))).astype(np.int64)
        #: the token at each place of the step-by-step layout
        self.token = np.concatenate([starts[:n] + t for t, n in enumerate(self.live)]) if steps else np.zeros(0, np.int64)

    def ratios(self, emit: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Toxic to plain ratios of the forward and backward weights, and of the emissions, step by step."""
        (oo, ot), (to, tt) = np.exp(trans)
        e = np.exp(np.clip(emit, -30, 30))[self.token]
        fwd, bwd = np.empty_like(e), np.empty_like(e)
        at, live = self.at.tolist(), self.live.tolist()
        if live:
            fwd[: live[0]] = e[: live[0]] * (ot / oo)
        for t in range(1, len(live)):
            r = fwd[at[t - 1] : at[t - 1] + live[t]]
            fwd[at[t] : at[t + 1]] = e[at[t] : at[t + 1]] * (r * tt + ot) / (r * to + oo)
        for t in range(len(live) - 1, -1, -1):
            n = live[t + 1] if t + 1 < len(live) else 0
            bwd[at[t] + n : at[t + 1]] = 1.0
            if n:
                x = e[at[t + 1] : at[t + 2]] * bwd[at[t + 1] : at[t + 2]]
                bwd[at[t] : at[t] + n] = (x * tt + to) / (x * ot + oo)
        return fwd, bwd, e

    def marginals(self, emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
        fwd, bwd, _ = self.ratios(emit, trans)
        out = np.empty_like(fwd)
        x = fwd * bwd
        out[self.token] = x / (1 + x)
        return out

    def pairs(self, fwd, bwd, e, trans) -> np.ndarray:
        """Expected transition counts; a chain starts as if after a plain token."""
        (oo, ot), (to, tt) = np.exp(trans)
        total = np.zeros((2, 2))
        for t in range(len(self.live)):
            n, a = self.live[t], self.at[t]
            x = e[a : a + n] * bwd[a : a + n]
            if t:
                r = fwd[self.at[t - 1] : self.at[t - 1] + n]
                z = oo + ot * x + r * (to + tt * x)
                total += [[(oo / z).sum(), (ot * x / z).sum()], [(r * to / z).sum(), (r * tt * x / z).sum()]]
            else:
                z = oo + ot * x
                total += [[(oo / z).sum(), (ot * x / z).sum()], [0, 0]]
        return total

    def viterbi(self, emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
        """The likeliest state of every token, 0 or 1."""
        (oo, ot), (to, tt) = trans
        e = emit[self.token]
        at, live = self.at.tolist(), self.live.tolist()
        back = np.zeros((2, len(e)), bool)
        plain, other = np.zeros(live[0] if live else 0), np.zeros(live[0] if live else 0)
        final = np.zeros(len(plain), bool)
        for t, n in enumerate(live):
            own = e[at[t] : at[t + 1]]
            if t:
                p, q = plain[:n], other[:n]
                back[0, at[t] : at[t + 1]], back[1, at[t] : at[t + 1]] = q + to > p + oo, q + tt > p + ot
                plain[:n], other[:n] = np.maximum(p + oo, q + to), np.maximum(p + ot, q + tt) + own
            else:
                plain[:], other[:] = oo, ot + own
            last = live[t + 1] if t + 1 < len(live) else 0
            final[last:n] = other[last:n] > plain[last:n]
        state = np.zeros(len(e), bool)
        ahead = np.zeros(0, bool)
        for t in range(len(live) - 1, -1, -1):
            now = final[: live[t]].copy()
            if len(ahead):
                n = len(ahead)
                now[:n] = np.where(ahead, back[1, at[t + 1] : at[t + 1] + n], back[0, at[t + 1] : at[t + 1] + n])
            state[at[t] : at[t + 1]] = now
            ahead = now
        out = np.zeros(len(e), np.int8)
        out[self.token] = state
        return out


def fit_chain(feats: np.ndarray, ids: np.ndarray, y: np.ndarray, lengths: np.ndarray, slots: int, steps: int, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights of state 1 and the transitions, by gradient steps on the likelihood.

    ``feats``: feature slots of each distinct token; ``ids``: the distinct token at each place; slot 0 is
    the bias. Each coordinate's step is scaled by what it has seen so far.
    """
    chains = Chains(lengths)
    before = np.concatenate(([0.0], y[:-1]))
    before[np.cumsum(lengths) - lengths] = 0.0
    seen = np.array([[((1 - before) * (1 - y)).sum(), ((1 - before) * y).sum()], [(before * (1 - y)).sum(), (before * y).sum()]])
    w, trans = np.zeros(slots), np.zeros((2, 2))
    w[0] = -1.0
    gw, gt, step = np.zeros(slots), np.zeros((2, 2)), 0.5
    for _ in range(steps):
        fwd, bwd, e = chains.ratios(sum(w[column] for column in feats.T)[ids], trans)
        x = fwd * bwd
        m = np.empty_like(x)
        m[chains.token] = x / (1 + x)
        by_token = np.bincount(ids, m - y, len(feats))
        g = sum(np.bincount(column, by_token, slots) for column in feats.T) / len(y) + ridge * w
        t = (chains.pairs(fwd, bwd, e, trans) - seen) / len(y)
        gw += g * g
        gt += t * t
        w -= step * g / (np.sqrt(gw) + 1e-12)
        trans -= step * t / (np.sqrt(gt) + 1e-12)
    return w, trans
