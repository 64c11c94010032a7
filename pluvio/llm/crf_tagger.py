"""A character tagger in numpy: a bidirectional LSTM gives a score to every
label of every character, a linear-chain CRF ties neighbouring labels.

Labels are O, and B- and I- of every kind; an I- can follow only its own B- or
I-. The padding behind a text is a character of its own and labelled O.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

OTHER = 1  # code of a character that is neither ASCII nor a letter
LETTER = 2  # code of a letter beyond ASCII
CODES = 3 + 128  # 0 pads


def codes_of(text: str, width: int) -> np.ndarray:
    """One code for each character, padded with 0 to ``width``."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.zeros(width, dtype=np.int64)
    out[:len(cp)] = np.where(cp < 128, 3 + cp, OTHER)
    wide = np.flatnonzero(cp >= 128)
    out[wide[[text[i].isalpha() for i in wide]]] = LETTER
    return out


@dataclass(frozen=True)
class TaggerConfig:
    kinds: int = 4
    hidden: int = 16
    epochs: int = 10
    batch: int = 64
    rate: float = 0.02
    seed: int = 11


@dataclass
class Tagger:
    """Weights by name: ``x_*`` (code, 4 hidden) input rows, ``h_*`` recurrent,
    ``out`` and ``bias`` of the emissions, ``step`` and ``start`` of the CRF."""
    cfg: TaggerConfig
    w: dict[str, np.ndarray]

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """(time, text, label) scores."""
        f = run_lstm(codes, self.w["x_f"], self.w["h_f"], False, keep=False)
        b = run_lstm(codes, self.w["x_b"], self.w["h_b"], True, keep=False)
        return np.concatenate([f, b], axis=2) @ self.w["out"] + self.w["bias"]

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best label path of each text, and the marginal of each of its labels."""
        em = self.emissions(codes)
        paths = viterbi(em, self.w["step"] + forbidden(self.cfg.kinds), self.w["start"] + forbidden_start(self.cfg.kinds))
        marg = marginals(em, *potentials(self))[0]
        return paths.T, np.take_along_axis(marg, paths[:, :, None], axis=2)[:, :, 0].T


def forbidden(kinds: int) -> np.ndarray:
    k = 1 + 2 * kinds
    out = np.zeros((k, k), dtype=np.float32)
    for i in range(2, k, 2):
        out[:, i] = -1e4
        out[i - 1, i] = out[i, i] = 0
    return out


def forbidden_start(kinds: int) -> np.ndarray:
    out = np.zeros(1 + 2 * kinds, dtype=np.float32)
    out[2::2] = -1e4
    return out


def potentials(t: Tagger) -> tuple[np.ndarray, np.ndarray]:
    return np.exp(t.w["step"] + forbidden(t.cfg.kinds)), np.exp(t.w["start"] + forbidden_start(t.cfg.kinds))


def run_lstm(codes: np.ndarray, x: np.ndarray, h_w: np.ndarray, back: bool, keep: bool):
    """Outputs (time, text, hidden); with ``keep`` also what backpropagation
    needs. Gates stand as input, forget, output, candidate."""
    n, steps = codes.shape
    hid = h_w.shape[0]
    h, c = np.zeros((n, hid), dtype=np.float32), np.zeros((n, hid), dtype=np.float32)
    out, kept = np.empty((steps, n, hid), dtype=np.float32), []
    for t in (range(steps - 1, -1, -1) if back else range(steps)):
        z = x[codes[:, t]]
        z += h @ h_w
        z[:, :3 * hid] *= 0.5
        np.tanh(z, out=z)
        z[:, :3 * hid] += 1  # a sigmoid is half of 1 + tanh of the half
        z[:, :3 * hid] *= 0.5
        i, f, o, g = z[:, :hid], z[:, hid:2 * hid], z[:, 2 * hid:3 * hid], z[:, 3 * hid:]
        before = (h, c)
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        if keep:
            kept.append((t, z, tc, *before))
    return (out, kept) if keep else out


def back_lstm(codes: np.ndarray, kept: list, h_w: np.ndarray, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input rows and of the recurrent weights."""
    n, steps = codes.shape
    hid = h_w.shape[0]
    d_h, d_c = np.zeros((n, hid), dtype=np.float32), np.zeros((n, hid), dtype=np.float32)
    d_w, every = np.zeros_like(h_w), np.empty((steps, n, 4 * hid), dtype=np.float32)
    for t, z, tc, h_before, c_before in reversed(kept):
        i, f, o, g = z[:, :hid], z[:, hid:2 * hid], z[:, 2 * hid:3 * hid], z[:, 3 * hid:]
        dh = d_out[t] + d_h
        dc = dh * o * (1 - tc * tc) + d_c
        dz = np.concatenate([dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        d_w += h_before.T @ dz
        d_h, d_c = dz @ h_w.T, dc * f
        every[t] = dz
    hot = np.zeros((CODES, steps * n), dtype=np.float32)
    hot[codes.T.ravel(), np.arange(steps * n)] = 1
    return hot @ every.reshape(steps * n, -1), d_w


def marginals(em: np.ndarray, step: np.ndarray, start: np.ndarray):
    """(label marginals (time, text, label), expected transitions, log of the
    normaliser per text) by scaled forward and backward passes."""
    steps, n, k = em.shape
    top = em.max(axis=2, keepdims=True)
    e = np.exp(em - top)
    alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.empty((steps, n, 1), dtype=em.dtype)
    for t in range(steps):
        a = (start if t == 0 else alpha[t - 1] @ step) * e[t]
        scale[t] = a.sum(axis=1, keepdims=True)
        alpha[t] = a / scale[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = (e[t + 1] * beta[t + 1] / scale[t + 1]) @ step.T
    ahead = (e[1:] * beta[1:] / scale[1:]).reshape(-1, k)
    moves = step * (alpha[:-1].reshape(-1, k).T @ ahead)
    marg = alpha * beta
    return marg / marg.sum(axis=2, keepdims=True), moves, (np.log(scale) + top).sum(axis=(0, 2))


def viterbi(em: np.ndarray, step: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best path (time, text)."""
    steps, n, k = em.shape
    best, came = em[0] + start, np.empty((steps, n, k), dtype=np.int8)
    for t in range(1, steps):
        score = best[:, :, None] + step[None]
        came[t] = score.argmax(axis=1)
        best = np.take_along_axis(score, came[t][:, None, :].astype(np.int64), axis=1)[:, 0] + em[t]
    out, rows = np.empty((steps, n), dtype=np.int64), np.arange(n)
    out[-1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = came[t, rows, out[t]]
    return out


def gradients(t: Tagger, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood of the label paths and its gradients."""
    n, steps = codes.shape
    w, hid = t.w, t.cfg.hidden
    f, kept_f = run_lstm(codes, w["x_f"], w["h_f"], False, keep=True)
    b, kept_b = run_lstm(codes, w["x_b"], w["h_b"], True, keep=True)
    both = np.concatenate([f, b], axis=2)
    em = both @ w["out"] + w["bias"]
    marg, moves, log_z = marginals(em, *potentials(t))
    gold, rows = labels.T, np.arange(n)
    path = em[np.arange(steps)[:, None], rows, gold].sum(axis=0) + w["start"][gold[0]] + w["step"][gold[:-1], gold[1:]].sum(axis=0)
    d_em = marg
    d_start = marg[0].sum(axis=0)
    np.add.at(d_start, gold[0], -1)
    d_em[np.arange(steps)[:, None], rows, gold] -= 1
    np.add.at(moves, (gold[:-1], gold[1:]), -1)
    d_both = d_em @ w["out"].T
    x_f, h_f = back_lstm(codes, kept_f, w["h_f"], d_both[:, :, :hid])
    x_b, h_b = back_lstm(codes, kept_b, w["h_b"], d_both[:, :, hid:])
    k = em.shape[2]
    grads = {"x_f": x_f, "h_f": h_f, "x_b": x_b, "h_b": h_b, "out": both.reshape(-1, 2 * hid).T @ d_em.reshape(-1, k),
             "bias": d_em.sum(axis=(0, 1)), "step": moves, "start": d_start}
    return float((log_z - path).mean()), {name: g / n for name, g in grads.items()}


def fresh(cfg: TaggerConfig) -> Tagger:
    rnd = np.random.default_rng(cfg.seed)
    k, hid = 1 + 2 * cfg.kinds, cfg.hidden
    draw = lambda *shape, s: (rnd.standard_normal(shape) * s).astype(np.float32)
    w = {"x_f": draw(CODES, 4 * hid, s=0.3), "h_f": draw(hid, 4 * hid, s=0.2), "x_b": draw(CODES, 4 * hid, s=0.3), "h_b": draw(hid, 4 * hid, s=0.2),
         "out": draw(2 * hid, k, s=0.2), "bias": np.zeros(k, np.float32), "step": np.zeros((k, k), np.float32), "start": np.zeros(k, np.float32)}
    for name in ("x_f", "x_b"):
        w[name][:, hid:2 * hid] += 1  # forget gates begin open
    return Tagger(cfg, w)


def train_tagger(codes: np.ndarray, labels: np.ndarray, cfg: TaggerConfig) -> Tagger:
    """Adam on mini-batches in a fixed order, with a falling rate."""
    t, rnd = fresh(cfg), np.random.default_rng(cfg.seed + 1)
    first = {k: np.zeros_like(v) for k, v in t.w.items()}
    second = {k: np.zeros_like(v) for k, v in t.w.items()}
    at, steps = 0, cfg.epochs * -(-len(codes) // cfg.batch)
    for _ in range(cfg.epochs):
        order = rnd.permutation(len(codes))
        for lo in range(0, len(order), cfg.batch):
            some = order[lo:lo + cfg.batch]
            _, grads = gradients(t, codes[some], labels[some])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            at += 1
            rate = cfg.rate * (1 - 0.95 * at / steps)
            for k, g in grads.items():
                g = g * np.float32(min(1.0, 5.0 / (norm + 1e-9)))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                t.w[k] = (t.w[k] - rate * (first[k] / (1 - 0.9 ** at)) / (np.sqrt(second[k] / (1 - 0.99 ** at)) + 1e-6)).astype(np.float32)
    return t
