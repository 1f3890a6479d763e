"""Linear-chain CRF over a handful of labels, for many sequences at once; label 0 is "outside"."""

from __future__ import annotations

import numpy as np

F4 = np.float32


def loss_grads(emit: np.ndarray, trans: np.ndarray, gold: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood and its gradients; ``emit (steps, labels, n)``, ``gold (steps, n)``."""
    steps, k, n = emit.shape
    alpha, beta = np.empty_like(emit), np.zeros_like(emit)
    alpha[0] = emit[0]
    for t in range(1, steps):
        s = alpha[t - 1][:, None, :] + trans[:, :, None]
        m = s.max(axis=0)
        alpha[t] = emit[t] + m + np.log(np.exp(s - m).sum(axis=0))
    for t in range(steps - 2, -1, -1):
        s = trans[:, :, None] + (emit[t + 1] + beta[t + 1])[None]
        m = s.max(axis=1)
        beta[t] = m + np.log(np.exp(s - m[:, None]).sum(axis=1))
    m = alpha[-1].max(axis=0)
    log_z = m + np.log(np.exp(alpha[-1] - m).sum(axis=0))
    d_emit = np.exp(alpha + beta - log_z)
    d_trans = np.zeros_like(trans)
    cols = np.arange(n)
    score = emit[0, gold[0], cols].astype(np.float64)
    for t in range(1, steps):
        d_trans += np.exp(alpha[t - 1][:, None, :] + trans[:, :, None] + (emit[t] + beta[t])[None] - log_z).sum(axis=2)
        score += emit[t, gold[t], cols] + trans[gold[t - 1], gold[t]]
    np.add.at(d_trans, (gold[:-1].ravel(), gold[1:].ravel()), F4(-1))
    for t in range(steps):
        d_emit[t, gold[t], cols] -= 1
    return float((log_z - score).mean()), d_emit / n, d_trans / n


def _viterbi(emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
    steps, k, n = emit.shape
    back = np.empty((steps, k, n), np.uint8)
    best = emit[0].copy()
    for t in range(1, steps):
        new = np.empty_like(best)
        for j in range(k):
            top = best[0] + trans[0, j]
            arg = np.zeros(n, np.uint8)
            for i in range(1, k):
                s = best[i] + trans[i, j]
                arg[s > top] = i
                np.maximum(top, s, out=top)
            new[j], back[t, j] = top, arg
        best = new + emit[t]
    path = np.empty((steps, n), np.uint8)
    path[-1] = best.argmax(axis=0)
    cols = np.arange(n)
    for t in range(steps - 1, 0, -1):
        path[t - 1] = back[t, path[t], cols]
    return path


def decode(emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best label paths ``(steps, n)``.

    A path leaves "outside" at a gain per position of at most the emission's
    lead plus two transitions' leads; where that is negative all along, the
    best path is known to be all outside.
    """
    lead = max(0.0, float((trans - trans[0, 0]).max()))
    gain = (emit[:, 1:].max(axis=1) - emit[:, 0]).max(axis=0) + 2 * lead
    path = np.zeros((emit.shape[0], emit.shape[2]), np.uint8)
    open_ = np.flatnonzero(gain >= 0)
    if len(open_):
        path[:, open_] = _viterbi(np.ascontiguousarray(emit[:, :, open_]), trans)
    return path
