"""Bidirectional gated recurrent layers with attention pooling, in numpy.

Arrays are time-major: ``(steps, rows, values)``.  Every forward function
returns what its backward function needs.
"""

from __future__ import annotations

import numpy as np


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def init_layer(rng: np.random.Generator, inputs: int, hidden: int, attention: int) -> dict[str, np.ndarray]:
    def draw(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"A": draw(2 * hidden, attention), "a": np.zeros(attention, np.float32), "v": draw(attention)}
    for way in "fb":
        p |= {f"W{way}": draw(inputs, 3 * hidden), f"U{way}": draw(hidden, 3 * hidden),
              f"c{way}": np.zeros(3 * hidden, np.float32)}
    return p


def project(p: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inputs' part of the gates, forward and backward; once per distinct input."""
    return x @ p["Wf"] + p["cf"], x @ p["Wb"] + p["cb"]


def _run(gates, U, mask, order, keep):
    """One direction; ``gates(t)`` gives the input part of step t."""
    hidden = U.shape[0]
    h = np.zeros((mask.shape[1], hidden), np.float32)
    states, cache = [None] * len(mask), []
    for t in order:
        g, m = gates(t), mask[t][:, None]
        inner = h @ U
        zr = _sigmoid(g[:, :2 * hidden] + inner[:, :2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        n = np.tanh(g[:, 2 * hidden:] + r * inner[:, 2 * hidden:])
        new = n + z * (h - n)
        if keep:
            cache.append((t, h, z, r, n, inner[:, 2 * hidden:], m))
        h = h + m * (new - h)
        states[t] = h
    return states, cache


def _run_back(grads, cache, U):
    """Gradients of the input parts and of ``U``."""
    hidden = U.shape[0]
    out, dU, dh = [None] * len(cache), np.zeros_like(U), 0.0
    for t, h, z, r, n, un, m in reversed(cache):
        dh = dh + grads[t]
        dnew = dh * m
        dz = dnew * (h - n) * z * (1 - z)
        dn = dnew * (1 - z) * (1 - n * n)
        dr = dn * un * r * (1 - r)
        inner = np.concatenate((dz, dr, dn * r), axis=1)
        out[t] = np.concatenate((dz, dr, dn), axis=1)
        dU += h.T @ inner
        dh = dh * (1 - m) + dnew * z + inner @ U.T
    return out, dU


def pool(p: dict, gates_f, gates_b, mask: np.ndarray, keep: bool = False):
    """Both directions and attention pooling: ``(rows, 2 * hidden)``; rows without steps give 0."""
    steps = len(mask)
    forward, cf = _run(gates_f, p["Uf"], mask, range(steps), keep)
    backward, cb = _run(gates_b, p["Ub"], mask, range(steps - 1, -1, -1), keep)
    states = np.concatenate((np.stack(forward), np.stack(backward)), axis=2)
    u = np.tanh(states @ p["A"] + p["a"])
    s = np.where(mask > 0, u @ p["v"], -1e9)
    e = np.exp(s - s.max(axis=0)) * mask
    alpha = e / np.maximum(e.sum(axis=0), 1e-9)
    pooled = (alpha[:, :, None] * states).sum(axis=0)
    return pooled, (states, u, alpha, cf, cb)


def pool_back(p: dict, cache, grad: np.ndarray):
    """``(parameter gradients, forward gates' gradients, backward gates' gradients)`` by step."""
    states, u, alpha, cf, cb = cache
    hidden = p["Uf"].shape[0]
    dalpha = (states * grad[None]).sum(axis=2)
    ds = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
    du = ds[:, :, None] * p["v"] * (1 - u * u)
    dstates = alpha[:, :, None] * grad[None] + du @ p["A"].T
    flat_s, flat_du = states.reshape(-1, 2 * hidden), du.reshape(-1, du.shape[2])
    g = {"v": (u * ds[:, :, None]).sum(axis=(0, 1)), "A": flat_s.T @ flat_du, "a": flat_du.sum(axis=0)}
    df, g["Uf"] = _run_back(dstates[:, :, :hidden], cf, p["Uf"])
    db, g["Ub"] = _run_back(dstates[:, :, hidden:], cb, p["Ub"])
    return g, df, db


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            g = np.clip(g, -5, 5)
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(np.float32)
