"""A small bidirectional LSTM in numpy: forward over padded batches, and training by backpropagation with Adam.

Sequences of a batch are padded at their end and masked.  The backward direction
reads each sequence from its own last element, so padding never reaches a state.
"""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def initial(n_in: int, hidden: int, n_out: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Weights of both directions (``f`` and ``b``) and of the output layer."""
    weights = {}
    for d in "fb":
        weights[f"{d}x"] = rng.normal(0, 1 / np.sqrt(n_in), (n_in, 4 * hidden)).astype(np.float32)
        weights[f"{d}h"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
        bias = np.zeros(4 * hidden, dtype=np.float32)
        bias[hidden : 2 * hidden] = 1.0  # remember at first
        weights[f"{d}c"] = bias
    weights["o"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, n_out)).astype(np.float32)
    weights["oc"] = np.zeros(n_out, dtype=np.float32)
    return weights


def reverse(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each sequence (rows of ``batch, time, ...``) from its last element to its first, padding in place."""
    at = lengths[:, None] - 1 - np.arange(x.shape[1])[None, :]
    at = np.where(at >= 0, at, np.arange(x.shape[1])[None, :])
    return np.take_along_axis(x, at.reshape(at.shape + (1,) * (x.ndim - 2)), axis=1)


def _run(x: np.ndarray, w: dict[str, np.ndarray], d: str, keep: bool):
    """One direction: hidden states ``batch, time, hidden``, and what training needs."""
    batch, steps, _ = x.shape
    n = w[f"{d}h"].shape[0]
    gates_in = x @ w[f"{d}x"] + w[f"{d}c"]
    h, c = np.zeros((batch, n), dtype=np.float32), np.zeros((batch, n), dtype=np.float32)
    out, kept = np.empty((batch, steps, n), dtype=np.float32), []
    for t in range(steps):
        z = gates_in[:, t] + h @ w[f"{d}h"]
        s = sigmoid(z[:, : 3 * n])
        i, f, o, g = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :], np.tanh(z[:, 3 * n :])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        if keep:
            kept.append((i, f, o, g, before, squashed, h))
        h = o * squashed
        out[:, t] = h
    return out, kept


def forward(x: np.ndarray, lengths: np.ndarray, w: dict[str, np.ndarray], keep: bool = False):
    """Output scores ``batch, time, n_out``."""
    ahead, kept_f = _run(x, w, "f", keep)
    back, kept_b = _run(reverse(x, lengths), w, "b", keep)
    both = np.concatenate([ahead, reverse(back, lengths)], axis=2)
    scores = both @ w["o"] + w["oc"]
    return (scores, (both, kept_f, kept_b)) if keep else scores


def _back(x: np.ndarray, d_out: np.ndarray, kept: list, w: dict[str, np.ndarray], d: str) -> dict[str, np.ndarray]:
    n = w[f"{d}h"].shape[0]
    grad = {f"{d}{k}": np.zeros_like(w[f"{d}{k}"]) for k in "xhc"}
    dh, dc = np.zeros_like(d_out[:, 0]), np.zeros_like(d_out[:, 0])
    for t in range(x.shape[1] - 1, -1, -1):
        i, f, o, g, before, squashed, h_before = kept[t]
        dh = dh + d_out[:, t]
        dc = dc + dh * o * (1 - squashed**2)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        grad[f"{d}x"] += x[:, t].T @ dz
        grad[f"{d}h"] += h_before.T @ dz
        grad[f"{d}c"] += dz.sum(axis=0)
        dh, dc = dz @ w[f"{d}h"].T, dc * f
    return grad


def gradients(x: np.ndarray, lengths: np.ndarray, d_scores: np.ndarray, kept, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Gradients of all weights, given those of the scores (zero at padding)."""
    both, kept_f, kept_b = kept
    n = w["fh"].shape[0]
    flat = d_scores.reshape(-1, d_scores.shape[2])
    grad = {"o": both.reshape(-1, 2 * n).T @ flat, "oc": flat.sum(axis=0)}
    d_both = d_scores @ w["o"].T
    grad |= _back(x, d_both[:, :, :n], kept_f, w, "f")
    return grad | _back(reverse(x, lengths), reverse(d_both[:, :, n:], lengths), kept_b, w, "b")


class Adam:
    def __init__(self, w: dict[str, np.ndarray], rate: float = 0.01):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in w.items()}
        self.v = {k: np.zeros_like(v) for k, v in w.items()}

    def step(self, w: dict[str, np.ndarray], grad: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
        scale = min(1.0, 5.0 / (norm + 1e-9))
        for k, g in grad.items():
            g = g * scale
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g**2
            w[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)
