"""Small bidirectional recurrent networks in numpy, with backpropagation through time.

States are laid out ``(units, windows)`` so that every elementwise step runs
over contiguous rows. Gates use the softsign ``x / (1 + |x|)``, which keeps
the gating of a logistic function at a fraction of its cost.
"""

from __future__ import annotations

import numpy as np

F4 = np.float32


def _softsign(x: np.ndarray) -> np.ndarray:
    """In place."""
    d = np.abs(x)
    d += F4(1)
    x /= d
    return x


class Adam:
    """Parameters are a dict of arrays, updated in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray], scale: float = 1.0) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        clip = F4(min(1.0, 5.0 / (norm + 1e-8)))
        for k, g in grads.items():
            g = g * clip
            self.m[k] += F4(0.1) * (g - self.m[k])
            self.v[k] += F4(0.01) * (g * g - self.v[k])
            m = self.m[k] / F4(1 - 0.9**self.t)
            v = self.v[k] / F4(1 - 0.99**self.t)
            self.params[k] -= F4(self.rate * scale) * m / (np.sqrt(v) + F4(1e-6))


def onehot_grad(symbols: np.ndarray, dx: np.ndarray, n: int) -> np.ndarray:
    """Gradient of an input table ``(gates, n)`` from ``dx`` of shape ``(steps, gates, windows)``."""
    flat = symbols.reshape(-1)
    hot = np.zeros((n, len(flat)), F4)
    hot[flat, np.arange(len(flat))] = 1
    return (hot @ dx.transpose(0, 2, 1).reshape(len(flat), -1)).T


class GRU:
    """One direction. ``E``: input table ``(3H, symbols)``; ``U``: recurrent weights ``(3H, H)``."""

    def __init__(self, e: np.ndarray, u: np.ndarray):
        self.E, self.U, self.h = np.ascontiguousarray(e), np.ascontiguousarray(u), u.shape[1]

    def run(self, x: np.ndarray, out: np.ndarray, backward: bool, tape: list | None = None) -> None:
        """States of all steps into ``out (steps, H, windows)``."""
        n, hid = x.shape[1], self.h
        h = np.zeros((hid, n), F4)
        a = np.empty((3 * hid, n), F4)
        for t in range(len(x) - 1, -1, -1) if backward else range(len(x)):
            np.take(self.E, x[t], axis=1, out=a, mode="clip")
            u = self.U @ h
            a[: 2 * hid] += u[: 2 * hid]
            zr = _softsign(a[: 2 * hid])
            zr += F4(1)
            zr *= F4(0.5)
            z, r = zr[:hid], zr[hid:]
            c = a[2 * hid :]
            c += r * u[2 * hid :]
            _softsign(c)
            new = h - c
            new *= z
            new += c
            if tape is not None:
                tape.append((t, h, zr.copy(), c.copy(), u[2 * hid :].copy()))
            h = new
            out[t] = h

    def grads(self, x: np.ndarray, dout: np.ndarray, tape: list) -> tuple[np.ndarray, np.ndarray]:
        hid = self.h
        du_all = np.zeros_like(self.U)
        dx = np.empty((len(x), 3 * hid, x.shape[1]), F4)
        dh = np.zeros((hid, x.shape[1]), F4)
        for t, hp, zr, c, uc in reversed(tape):
            dh = dh + dout[t]
            z, r = zr[:hid], zr[hid:]
            dac = dh * (1 - z) * np.square(1 - np.abs(c))
            dzr = np.concatenate([dh * (hp - c), dac * uc]) * F4(0.5) * np.square(1 - np.abs(2 * zr - 1))
            dx[t, : 2 * hid], dx[t, 2 * hid :] = dzr, dac
            du = np.concatenate([dzr, dac * r])
            du_all += du @ hp.T
            dh = dh * z + self.U.T @ du
        return onehot_grad(x, dx, self.E.shape[1]), du_all


class LSTM:
    """One direction. ``E``: input table ``(4H, symbols)``; ``U``: recurrent weights ``(4H, H)``; gates input, forget, output, cell."""

    def __init__(self, e: np.ndarray, u: np.ndarray):
        self.E, self.U, self.h = np.ascontiguousarray(e), np.ascontiguousarray(u), u.shape[1]

    def run(self, x: np.ndarray, out: np.ndarray, backward: bool, tape: list | None = None) -> None:
        """States of all steps into ``out (steps, H, windows)``."""
        n, hid = x.shape[1], self.h
        h, c = np.zeros((hid, n), F4), np.zeros((hid, n), F4)
        a = np.empty((4 * hid, n), F4)
        for t in range(len(x) - 1, -1, -1) if backward else range(len(x)):
            np.take(self.E, x[t], axis=1, out=a, mode="clip")
            a += self.U @ h
            _softsign(a)
            gates = a[: 3 * hid]
            gates += F4(1)
            gates *= F4(0.5)
            new = gates[hid : 2 * hid] * c
            new += gates[:hid] * a[3 * hid :]
            squashed = _softsign(new.copy())
            if tape is not None:
                tape.append((t, h, c, a.copy(), squashed))
            c = new
            h = gates[2 * hid :] * squashed
            out[t] = h

    def grads(self, x: np.ndarray, dout: np.ndarray, tape: list) -> tuple[np.ndarray, np.ndarray]:
        hid = self.h
        du = np.zeros_like(self.U)
        dx = np.empty((len(x), 4 * hid, x.shape[1]), F4)
        dh, dc = np.zeros((hid, x.shape[1]), F4), np.zeros((hid, x.shape[1]), F4)
        for t, hp, cp, a, squashed in reversed(tape):
            dh = dh + dout[t]
            i, f, o, g = a[:hid], a[hid : 2 * hid], a[2 * hid : 3 * hid], a[3 * hid :]
            dc = dc + dh * o * np.square(1 - np.abs(squashed))
            d = np.concatenate([dc * g, dc * cp, dh * squashed, dc * i])
            d[: 3 * hid] *= F4(0.5) * np.square(1 - np.abs(2 * a[: 3 * hid] - 1))
            d[3 * hid :] *= np.square(1 - np.abs(g))
            dx[t] = d
            du += d @ hp.T
            dh = self.U.T @ d
            dc = dc * f
        return onehot_grad(x, dx, self.E.shape[1]), du


def init(rng: np.random.Generator, hidden: int, gates: int, symbols: int, classes: int) -> dict[str, np.ndarray]:
    """Weights of two directions and of the output layer over both states."""
    p = {}
    for d in "fb":
        p[f"E{d}"] = (rng.standard_normal((gates * hidden, symbols)) * 0.5).astype(F4)
        p[f"U{d}"] = (rng.standard_normal((gates * hidden, hidden)) / np.sqrt(hidden)).astype(F4)
    p["O"] = (rng.standard_normal((classes, 2 * hidden)) / np.sqrt(hidden)).astype(F4)
    p["b"] = np.zeros((classes, 1), F4)
    return p
