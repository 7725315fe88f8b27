"""Character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)            # O, then B and I of each kind
EMBED, HIDDEN = 8, 14
_FIRST, _CHARS = 32, 98              # printable ASCII, line feed, everything else


def char_ids(text: str, width: int) -> np.ndarray:
    """Character ids of one window, padded with spaces to ``width``."""
    a = np.full(width, 32, np.uint32)
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)[:width]
    a[:len(raw)] = raw
    return np.where((a >= _FIRST) & (a < 127), a - _FIRST, np.where(a == 10, 96, 97)).astype(np.int16)


def tags_of(spans: list[tuple[int, int, int]], width: int) -> np.ndarray:
    """BIO tags of (start, end, kind index) spans."""
    out = np.zeros(width, np.int64)
    for start, end, kind in spans:
        out[start] = 1 + 2 * kind
        out[start + 1:end] = 2 + 2 * kind
    return out


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, kind index) spans of one tag sequence."""
    out: list[tuple[int, int, int]] = []
    begin = kind = -1
    for at, tag in enumerate([*tags.tolist(), 0]):
        k = (tag - 1) // 2 if tag else -1
        if kind >= 0 and (k != kind or tag % 2 == 1):
            out.append((begin, at, kind))
            kind = -1
        if k >= 0 and kind < 0:
            begin, kind = at, k
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lse(x, axis):
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Parameters are plain arrays in ``p``, so a tagger travels in a task's closure."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        p = {"E": r.normal(0, 0.3, (_CHARS, EMBED)), "Wo": r.normal(0, 0.2, (2 * HIDDEN, TAGS)),
             "bo": np.zeros(TAGS), "A": np.zeros((TAGS, TAGS)), "s": np.zeros(TAGS)}
        for d in "fb":
            p["Wx" + d] = r.normal(0, EMBED ** -0.5, (EMBED, 4 * HIDDEN))
            p["Wh" + d] = r.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN))
            p["b" + d] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        self.p = p

    # ---- forward
    def _lstm(self, emb, d, keep=None):
        p, (n, width, _) = self.p, emb.shape
        zx = emb @ p["Wx" + d] + p["b" + d]
        h = np.zeros((n, HIDDEN), emb.dtype)
        c = np.zeros((n, HIDDEN), emb.dtype)
        out = np.empty((n, width, HIDDEN), emb.dtype)
        for t in range(width):
            z = zx[:, t] + h @ p["Wh" + d]
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, hb = c, h
            c = f * before + i * g
            tc = np.tanh(c)
            h = o * tc
            out[:, t] = h
            if keep is not None:
                keep.append((i, f, o, g, before, tc, hb))
        return out

    def _emissions(self, x, keep=None):
        emb = self.p["E"][x]
        fwd = self._lstm(emb, "f", None if keep is None else keep[0])
        bwd = self._lstm(emb[:, ::-1], "b", None if keep is None else keep[1])[:, ::-1]
        both = np.concatenate([fwd, bwd], 2)
        return emb, both, both @ self.p["Wo"] + self.p["bo"]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Most likely tag sequence (Viterbi) of each row of character ids."""
        e = self._emissions(x)[2]
        n, width, _ = e.shape
        score = e[:, 0] + self.p["s"]
        back = np.empty((n, width, TAGS), np.int8)
        for t in range(1, width):
            step = score[:, :, None] + self.p["A"]
            back[:, t] = step.argmax(1)
            score = step.max(1) + e[:, t]
        tags = np.empty((n, width), np.int8)
        tags[:, -1] = score.argmax(1)
        for t in range(width - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
        return tags

    # ---- training
    def _gradients(self, x, y):
        p, keep = self.p, ([], [])
        emb, both, e = self._emissions(x, keep)
        n, width, _ = e.shape
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + p["s"]
        for t in range(1, width):
            alpha[:, t] = e[:, t] + _lse(alpha[:, t - 1][:, :, None] + p["A"], 1)
        for t in range(width - 2, -1, -1):
            beta[:, t] = _lse(p["A"] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        log_z = _lse(alpha[:, -1], 1)
        de = np.exp(alpha + beta - log_z[:, None, None])
        g = {"A": np.zeros_like(p["A"])}
        for t in range(1, width):
            g["A"] += np.exp(alpha[:, t - 1][:, :, None] + p["A"] + (e[:, t] + beta[:, t])[:, None, :]
                             - log_z[:, None, None]).sum(0)
        np.subtract.at(g["A"], (y[:, :-1], y[:, 1:]), 1.0)
        rows = np.arange(n)[:, None]
        de[rows, np.arange(width)[None], y] -= 1.0
        g["s"] = de[:, 0].sum(0)
        g["Wo"] = np.einsum("nth,ntk->hk", both, de)
        g["bo"] = de.sum((0, 1))
        dh_all = de @ p["Wo"].T
        demb = np.zeros_like(emb)
        for d, k, flip in (("f", 0, False), ("b", 1, True)):
            dh_in = dh_all[:, :, k * HIDDEN:(k + 1) * HIDDEN]
            inp = emb
            if flip:
                dh_in, inp = dh_in[:, ::-1], emb[:, ::-1]
            dz_all = np.empty((n, width, 4 * HIDDEN))
            gh = np.zeros_like(p["Wh" + d])
            dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            for t in range(width - 1, -1, -1):
                i, f, o, gg, before, tc, hb = keep[k][t]
                dh = dh + dh_in[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o),
                                     dc * i * (1 - gg * gg)], 1)
                dz_all[:, t] = dz
                gh += hb.T @ dz
                dh, dc = dz @ p["Wh" + d].T, dc * f
            g["Wh" + d] = gh
            g["Wx" + d] = np.einsum("nte,ntz->ez", inp, dz_all)
            g["b" + d] = dz_all.sum((0, 1))
            back = dz_all @ p["Wx" + d].T
            demb += back[:, ::-1] if flip else back
        g["E"] = np.zeros_like(p["E"])
        np.add.at(g["E"], x, demb)
        return g

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.02, seed: int = 11) -> Tagger:
        """Adam on the CRF log-likelihood of tag rows ``y`` for character rows ``x``:
        whole passes over the rows, ``steps`` updates of 64 rows at least."""
        epochs = -(-steps // -(-len(x) // 64))
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(x), 64):
                pick = order[at:at + 64]
                g = self._gradients(x[pick], y[pick])
                step += 1
                lr = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
                for k, grad in g.items():
                    grad = np.clip(grad / len(pick), -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v2[k] = 0.99 * v2[k] + 0.01 * grad * grad
                    self.p[k] -= lr * m[k] / (np.sqrt(v2[k]) + 1e-8)
        return self

    def single(self) -> Tagger:
        """The same tagger in single precision, for scanning."""
        out = Tagger()
        out.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return out
