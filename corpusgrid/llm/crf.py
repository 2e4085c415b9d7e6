"""A bidirectional LSTM over characters with a CRF on top, in numpy."""

from __future__ import annotations

import numpy as np

HIDDEN, EMBED = 16, 12


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def initial(symbols: int, tags: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    p = {"embed": rng.normal(0, 0.5, (symbols, EMBED)), "out": draw(2 * HIDDEN, tags), "bias": np.zeros(tags),
         "step": np.zeros((tags, tags)), "begin": np.zeros(tags)}
    for way in "fb":
        p["x" + way], p["h" + way] = draw(EMBED, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)
        p["c" + way] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return p


def lstm(p: dict, way: str, x: np.ndarray):
    """Hidden states (time, batch, hidden) and what the backward pass needs."""
    steps, batch, _ = x.shape
    pre = x @ p["x" + way] + p["c" + way]
    h, c = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
    hs, kept = np.zeros((steps, batch, HIDDEN)), []
    for t in range(steps):
        z = pre[t] + h @ p["h" + way]
        gate, new = sigmoid(z[:, :3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
        i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN:2 * HIDDEN], gate[:, 2 * HIDDEN:]
        before, last = c, h
        c = f * c + i * new
        squashed = np.tanh(c)
        h = o * squashed
        hs[t] = h
        kept.append((i, f, o, new, before, last, squashed))
    return hs, kept


def lstm_back(p: dict, way: str, x: np.ndarray, kept: list, dhs: np.ndarray, g: dict) -> np.ndarray:
    dh, dc = np.zeros_like(dhs[0]), np.zeros_like(dhs[0])
    dz_all = np.zeros((len(kept), dhs.shape[1], 4 * HIDDEN))
    for t in range(len(kept) - 1, -1, -1):
        i, f, o, new, before, last, squashed = kept[t]
        dh = dh + dhs[t]
        dc = dc + dh * o * (1 - squashed ** 2)
        dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o),
                             dc * i * (1 - new ** 2)], axis=1)
        dz_all[t] = dz
        g["h" + way] += last.T @ dz
        dh, dc = dz @ p["h" + way].T, dc * f
    g["x" + way] += np.einsum("tbe,tbz->ez", x, dz_all)
    g["c" + way] += dz_all.sum((0, 1))
    return dz_all @ p["x" + way].T


def emissions(p: dict, codes: np.ndarray):
    """Tag scores (time, batch, tags) of windows (batch, time)."""
    x = p["embed"][codes.T]
    forward, kept_f = lstm(p, "f", x)
    backward, kept_b = lstm(p, "b", x[::-1])
    both = np.concatenate([forward, backward[::-1]], axis=2)
    return both @ p["out"] + p["bias"], (x, both, kept_f, kept_b)


def passes(p: dict, e: np.ndarray):
    """Forward and backward sums of the CRF, and log Z."""
    a, b = np.zeros_like(e), np.zeros_like(e)
    a[0] = p["begin"] + e[0]
    for t in range(1, len(e)):
        a[t] = logsumexp(a[t - 1][:, :, None] + p["step"], 1) + e[t]
    for t in range(len(e) - 2, -1, -1):
        b[t] = logsumexp(p["step"] + (e[t + 1] + b[t + 1])[:, None, :], 2)
    return a, b, logsumexp(a[-1], 1)


def gradient(p: dict, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    e, (x, both, kept_f, kept_b) = emissions(p, codes)
    a, b, z = passes(p, e)
    n, steps = codes.shape
    t = tags.T
    ones = np.eye(e.shape[2])[t]
    gold = (e * ones).sum((0, 2)) + p["begin"][t[0]] + p["step"][t[:-1], t[1:]].sum(0)
    de = (np.exp(a + b - z[:, None]) - ones) / n
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["begin"] = de[0].sum(0)
    for k in range(1, steps):
        pair = a[k - 1][:, :, None] + p["step"] + (e[k] + b[k])[:, None, :] - z[:, None, None]
        g["step"] += (np.exp(pair).sum(0) - ones[k - 1].T @ ones[k]) / n
    g["out"], g["bias"] = np.einsum("tbh,tbk->hk", both, de), de.sum((0, 1))
    dboth = de @ p["out"].T
    dx = lstm_back(p, "f", x, kept_f, dboth[:, :, :HIDDEN], g)
    dx += lstm_back(p, "b", x[::-1], kept_b, dboth[::-1, :, HIDDEN:], g)[::-1]
    np.add.at(g["embed"], codes.T, dx)
    return float((z - gold).mean()), g


def train(codes: np.ndarray, tags: np.ndarray, symbols: int, n_tags: int, steps: int = 240, batch: int = 48,
          rate: float = 0.02, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on random batches; all draws are seeded."""
    p, rng = initial(symbols, n_tags, seed), np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        chosen = rng.integers(0, len(codes), min(batch, len(codes)))
        _, g = gradient(p, codes[chosen], tags[chosen])
        norm = np.sqrt(sum(float((x ** 2).sum()) for x in g.values()))
        scale = min(1.0, 5.0 / (norm + 1e-9))
        lr = rate * (1 - 0.9 * step / steps)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k] * scale
            v[k] = 0.99 * v[k] + 0.01 * (g[k] * scale) ** 2
            p[k] -= lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return p


def decode(p: dict, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tags (batch, time) and the posterior of each."""
    e, _ = emissions(p, codes)
    a, b, z = passes(p, e)
    score, back = p["begin"] + e[0], np.zeros(e.shape, np.int8)
    for t in range(1, len(e)):
        ways = score[:, :, None] + p["step"]
        back[t] = ways.argmax(1)
        score = ways.max(1) + e[t]
    tags = np.zeros(e.shape[:2], np.int64)
    tags[-1] = score.argmax(1)
    rows = np.arange(e.shape[1])
    for t in range(len(e) - 1, 0, -1):
        tags[t - 1] = back[t, rows, tags[t]]
    sure = np.take_along_axis(np.exp(a + b - z[:, None]), tags[:, :, None], 2)[:, :, 0]
    return tags.T, sure.T
