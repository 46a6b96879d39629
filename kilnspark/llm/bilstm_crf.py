"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Tags: 0 outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
_SPECIAL = "@.-_+()%:/,= \n"
CLASSES = 6 + len(_SPECIAL)


def char_classes(text: str) -> np.ndarray:
    """Class of each character: digit, lower, upper, other letter, other, special signs."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return _CLASS_OF[np.minimum(codes, 256)]


_CLASS_OF = np.full(257, 4, dtype=np.int64)
_CLASS_OF[48:58], _CLASS_OF[97:123], _CLASS_OF[65:91] = 0, 1, 2
_CLASS_OF[192:256], _CLASS_OF[256] = 3, 3
for _i, _c in enumerate(_SPECIAL):
    _CLASS_OF[ord(_c)] = 6 + _i


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Model:
    """Parameters ``w``: input tables and recurrent weights of both directions, output layer, transitions."""

    def __init__(self, hidden: int = 12, seed: int = 5):
        rng = np.random.default_rng(seed)
        h = hidden
        self.h = h
        self.w = {"T": rng.normal(0, 0.1, (TAGS, TAGS)), "S": np.zeros(TAGS), "O": rng.normal(0, 0.3, (2 * h, TAGS)), "b": np.zeros(TAGS)}
        for d in "fr":
            self.w["X" + d] = rng.normal(0, 0.3, (CLASSES, 4 * h))
            self.w["U" + d] = rng.normal(0, 0.3, (h, 4 * h))
            self.w["X" + d][:, h : 2 * h] += 1.0  # forget gates start open

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """States over time for classes ``x`` of shape (windows, steps)."""
        n, steps = x.shape
        h = self.h
        hs = np.zeros((steps, n, h))
        saved = []
        state, cell = np.zeros((n, h)), np.zeros((n, h))
        table, u = self.w["X" + d], self.w["U" + d]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = table[x[:, t]] + state @ u
            gates = _sigmoid(z[:, : 3 * h])
            g = np.tanh(z[:, 3 * h :])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            past, was = cell, state
            cell = f * cell + i * g
            tc = np.tanh(cell)
            state = o * tc
            hs[t] = state
            if keep:
                saved.append((t, i, f, o, g, past, tc, was))
        return hs, saved

    def emissions(self, x: np.ndarray, keep: bool = False):
        hf, sf = self._run(x, "f", keep)
        hr, sr = self._run(x, "r", keep)
        both = np.concatenate([hf, hr], axis=2)
        return both @ self.w["O"] + self.w["b"], both, sf, sr

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tag sequence of each window."""
        return self.viterbi(self.emissions(x)[0])

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best tag sequences for emissions of shape (steps, rows, tags)."""
        steps, n, _ = e.shape
        score = e[0] + self.w["S"]
        back = np.zeros((steps, n, TAGS), dtype=np.int8)
        for t in range(1, steps):
            all_ = score[:, :, None] + self.w["T"][None]
            back[t] = all_.argmax(axis=1)
            score = all_.max(axis=1) + e[t]
        out = np.empty((steps, n), dtype=np.int64)
        out[-1] = score.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            out[t - 1] = back[t][np.arange(n), out[t]]
        return out.T

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags and its gradients."""
        e, both, sf, sr = self.emissions(x, keep=True)
        steps, n, _ = e.shape
        trans, first = self.w["T"], self.w["S"]
        rows = np.arange(n)

        def lse(a, axis):
            top = a.max(axis=axis, keepdims=True)
            return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)

        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + first
        for t in range(1, steps):
            alpha[t] = lse(alpha[t - 1][:, :, None] + trans[None], 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = lse(trans[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        log_z = lse(alpha[-1], 1)
        de = np.exp(alpha + beta - log_z[None, :, None])
        d_first = de[0].copy()
        d_trans = np.zeros_like(trans)
        for t in range(1, steps):
            d_trans += np.exp(alpha[t - 1][:, :, None] + trans[None] + (e[t] + beta[t])[:, None, :] - log_z[:, None, None]).sum(axis=0)
        gold = first[y[:, 0]] + sum(e[t][rows, y[:, t]] for t in range(steps)) + sum(trans[y[:, t - 1], y[:, t]] for t in range(1, steps))
        for t in range(steps):
            de[t][rows, y[:, t]] -= 1.0
        d_first[rows, y[:, 0]] -= 1.0
        np.subtract.at(d_trans, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
        grads = {"T": d_trans / n, "S": d_first.sum(axis=0) / n, "O": np.einsum("tnh,tnk->hk", both, de) / n, "b": de.sum(axis=(0, 1)) / n}
        d_both = de @ self.w["O"].T
        for d, saved, part in (("f", sf, d_both[:, :, : self.h]), ("r", sr, d_both[:, :, self.h :])):
            gx, gu = np.zeros_like(self.w["X" + d]), np.zeros_like(self.w["U" + d])
            dh, dc = np.zeros((n, self.h)), np.zeros((n, self.h))
            for t, i, f, o, g, past, tc, was in reversed(saved):
                dh = dh + part[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * g * i * (1 - i), dc * past * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                np.add.at(gx, x[:, t], dz)
                gu += was.T @ dz
                dh, dc = dz @ self.w["U" + d].T, dc * f
            grads["X" + d], grads["U" + d] = gx / n, gu / n
        return float((log_z - gold).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int, batch: int = 64, rate: float = 0.02, seed: int = 6) -> list[float]:
        """Adam over random batches; the losses."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(w) for k, w in self.w.items()}
        losses = []
        for s in range(1, steps + 1):
            rows = rng.integers(0, len(x), batch)
            loss, grads = self.gradients(x[rows], y[rows])
            losses.append(loss)
            for k, g in grads.items():
                g = np.clip(g, -5, 5)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9**s)) / (np.sqrt(v[k] / (1 - 0.99**s)) + 1e-8)
        return losses
