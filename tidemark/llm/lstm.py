"""A small bidirectional LSTM that labels sequences, in numpy: forward, backward, Adam."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def init(n_in: int, embed: int, hidden: int, seed: int) -> Params:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    params = {"E": draw(n_in, embed) * 2, "e": np.zeros(embed, np.float32), "V": draw(2 * hidden, 1), "v": np.zeros(1, np.float32)}
    for way in "fb":
        bias = np.zeros(4 * hidden, np.float32)
        bias[hidden:2 * hidden] = 1.0  # remember at first
        params |= {f"W{way}": draw(embed, 4 * hidden), f"U{way}": draw(hidden, 4 * hidden), f"c{way}": bias}
    return params


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each sequence of (time, batch, ...) reversed within its length."""
    at = np.arange(len(x))[:, None]
    index = np.where(at < lengths, lengths - 1 - at, at)
    return x[index, np.arange(x.shape[1])]


def _run(x: np.ndarray, U: np.ndarray, keep: bool):
    """States of one direction; x has the gates' inputs, (time, batch, 4 * hidden)."""
    hidden = U.shape[0]
    h = c = np.zeros((x.shape[1], hidden), np.float32)
    out, cache = np.empty((*x.shape[:2], hidden), np.float32), []
    for t in range(len(x)):
        gates = x[t] + h @ U
        i, f, o = (_sigmoid(gates[:, k * hidden:(k + 1) * hidden]) for k in range(3))
        g = np.tanh(gates[:, 3 * hidden:])
        before, h0 = c, h
        c = f * c + i * g
        h = o * np.tanh(c)
        out[t] = h
        if keep:
            cache.append((i, f, o, g, c, before, h0))
    return out, cache


def _run_back(d_out: np.ndarray, U: np.ndarray, cache: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates' inputs and of U."""
    d_h = d_c = 0.0
    d_x, d_U = np.empty((*d_out.shape[:2], 4 * U.shape[0]), np.float32), np.zeros_like(U)
    for t in range(len(d_out) - 1, -1, -1):
        i, f, o, g, c, before, h0 = cache[t]
        d_h = d_h + d_out[t]
        th = np.tanh(c)
        d_c = d_c + d_h * o * (1 - th * th)
        d_gates = np.hstack([d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_h * th * o * (1 - o), d_c * i * (1 - g * g)])
        d_x[t] = d_gates
        d_U += h0.T @ d_gates
        d_h, d_c = d_gates @ U.T, d_c * f
    return d_x, d_U


def forward(params: Params, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
    """Scores (time, batch) of sequences x (time, batch, features)."""
    embedded = np.tanh(x @ params["E"] + params["e"])
    states, caches = [], []
    for way in "fb":
        seen = embedded if way == "f" else _turned(embedded, lengths)
        out, cache = _run(seen @ params[f"W{way}"] + params[f"c{way}"], params[f"U{way}"], keep)
        states.append(out if way == "f" else _turned(out, lengths))
        caches.append((seen, cache))
    both = np.concatenate(states, axis=2)
    return (both @ params["V"] + params["v"])[:, :, 0], (embedded, both, caches)


def gradients(params: Params, x: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> tuple[float, Params]:
    """Mean log loss over all labels and its gradients."""
    score, (embedded, both, caches) = forward(params, x, lengths, keep=True)
    inside = (np.arange(len(x))[:, None] < lengths).astype(np.float32)
    p = _sigmoid(score)
    total = inside.sum()
    loss = -(inside * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / total
    d = (inside * (p - y) / total)[:, :, None].astype(np.float32)
    flat = lambda a: a.reshape(-1, a.shape[-1])
    grads: Params = {"V": flat(both).T @ flat(d), "v": flat(d).sum(axis=0)}
    d_both, hidden = d @ params["V"].T, params["Uf"].shape[0]
    d_embedded = np.zeros_like(embedded)
    for k, way in enumerate("fb"):
        d_out = d_both[:, :, k * hidden:(k + 1) * hidden]
        seen, cache = caches[k]
        d_x, grads[f"U{way}"] = _run_back(d_out if way == "f" else _turned(d_out, lengths), params[f"U{way}"], cache)
        grads[f"W{way}"], grads[f"c{way}"] = flat(seen).T @ flat(d_x), flat(d_x).sum(axis=0)
        d_seen = d_x @ params[f"W{way}"].T
        d_embedded += d_seen if way == "f" else _turned(d_seen, lengths)
    d_in = d_embedded * (1 - embedded ** 2)
    grads["E"], grads["e"] = flat(x).T @ flat(d_in), flat(d_in).sum(axis=0)
    return float(loss), grads


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, batch, ...) with zeros after the end of the shorter ones, and the lengths."""
    lengths = np.array([len(s) for s in sequences])
    out = np.zeros((int(lengths.max(initial=0)), len(sequences), *sequences[0].shape[1:]), np.float32)
    for i, s in enumerate(sequences):
        out[:len(s), i] = s
    return out, lengths


def train(xs: list[np.ndarray], ys: list[np.ndarray], embed: int = 16, hidden: int = 16, epochs: int = 12, batch: int = 32,
          rate: float = 0.01, seed: int = 3) -> Params:
    params = init(xs[0].shape[1], embed, hidden, seed)
    first, second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    rng, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = rng.permutation(len(xs))
        for low in range(0, len(order), batch):
            some = order[low:low + batch]
            x, lengths = padded([xs[i] for i in some])
            y, _ = padded([ys[i][:, None] for i in some])
            _, grads = gradients(params, x, y[:, :, 0], lengths)
            step += 1
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                params[k] = params[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)
    return {k: v.astype(np.float32) for k, v in params.items()}
