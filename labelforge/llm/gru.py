"""A gated recurrent language model with a class-factored softmax, in numpy.

Token ids: 0 ends a document, 1..n-1 are words by falling count, n stands for
every other word.  Ids 0..n-1 are cut into classes of about equal square-root
mass; n is a class by itself.  P(token | h) = P(class | h) P(token | class, h).
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN = 16
CLASSES = 32
ROWS = 512           # documents or stretches that advance together
WINDOW = 32          # steps of one truncated backpropagation


def class_borders(counts: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Borders of contiguous classes of ids with about equal sums of sqrt(count)."""
    if not len(counts):
        return np.zeros(1, np.int64)
    mass = np.cumsum(np.sqrt(counts + 1.0))
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, classes) / classes) + 1
    return np.unique(np.concatenate([[0], np.minimum(cuts, len(counts)), [len(counts)]]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def _order(ids: np.ndarray, most: int) -> np.ndarray:
    """Stable order of ids 0..``most``; narrow ones are sorted by radix."""
    return np.argsort(ids.astype(np.uint16) if most < 1 << 16 else ids, kind="stable")


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def _softmax(z: np.ndarray) -> np.ndarray:
    """Row softmax; the shift by the row's maximum only where it is needed."""
    with np.errstate(over="ignore"):
        e = np.exp(z)
    total = _row_sums(e)[:, None]
    if not (np.isfinite(total).all() and total.min() > 1e-30):
        e = np.exp(z - z.max(1, keepdims=True))
        total = e.sum(1, keepdims=True)
    e /= total
    return e


def _log_sums(z: np.ndarray) -> np.ndarray:
    """log of the row sums of exp(z); shifted only where it is needed."""
    with np.errstate(over="ignore"):
        total = _row_sums(np.exp(z))
    if np.isfinite(total).all() and total.min() > 1e-30:
        return np.log(total)
    top = z.max(1)
    return top + np.log(np.exp(z - top[:, None]).sum(1))


class Model:
    """``p`` holds all parameters; ``borders`` the classes of ids 0..n-1."""

    def __init__(self, counts: np.ndarray, other: float, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 5):
        """Starts as the unigram model of ``counts`` and the count of all other words."""
        r = np.random.default_rng(seed)
        n, h = len(counts), hidden
        self.borders = class_borders(counts, classes)
        k = len(self.borders) - 1
        self.class_of = np.append(np.repeat(np.arange(k), np.diff(self.borders)), k)
        per_class = np.append(np.add.reduceat(counts, self.borders[:-1]) if n else [], other) + 1.0
        inside = np.log((counts + 1.0) / (per_class[self.class_of[:-1]] if n else 1.0))
        self.p = {
            "x": r.normal(0, 0.3, (n + 1, 3 * h)), "u": r.normal(0, h ** -0.5, (h, 3 * h)), "c": np.zeros(h),
            "wc": r.normal(0, 0.05, (h, k + 1)), "bc": np.log(per_class / per_class.sum()),
            "ww": r.normal(0, 0.05, (n, h)), "bw": inside,
        }
        self.p = {a: v.astype(np.float32) for a, v in self.p.items()}

    @property
    def other(self) -> int:
        return len(self.p["bw"])

    # ---- parameters as one vector
    def vector(self) -> np.ndarray:
        return np.concatenate([self.p[a].ravel() for a in sorted(self.p)])

    def load(self, v: np.ndarray) -> Model:
        at = 0
        for a in sorted(self.p):
            size = self.p[a].size
            self.p[a] = v[at:at + size].reshape(self.p[a].shape).astype(np.float32)
            at += size
        return self

    # ---- one window
    def steps(self, inputs: np.ndarray, state: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hidden states (rows, steps, hidden) before each token is predicted, and the
        last state.  Reading an end token starts from the zero state again."""
        out, state = self._steps(np.ascontiguousarray(inputs.T), state, keep)
        return out.transpose(1, 0, 2), state

    def _steps(self, inputs: np.ndarray, state: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``steps`` of inputs (steps, rows), so that a step reads and writes one block."""
        p, h = self.p, self.p["u"].shape[0]
        xs = p["x"].take(inputs, axis=0)
        going = (inputs != 0)[:, :, None]
        out = np.empty((*inputs.shape, h), p["u"].dtype)
        for t in range(len(inputs)):
            state = state * going[t]
            hu = state @ p["u"]
            gates = _sigmoid(xs[t, :, :2 * h] + hu[:, :2 * h])
            reset, update = gates[:, :h], gates[:, h:]
            inner = hu[:, 2 * h:]
            inner += p["c"]
            new = reset * inner
            new += xs[t, :, 2 * h:]
            np.tanh(new, out=new)
            after = np.subtract(state, new, out=out[t])
            after *= update
            after += new
            if keep is not None:
                keep.append((state, reset, update, inner, new))
            state = after
        return out, state

    def log_probs(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None):
        """Natural log-probabilities of ``targets`` given ``states`` (rows, hidden);
        with ``grads``, adds the gradients of their negative sum and returns the
        gradient of the states as well."""
        p = self.p
        rows = np.arange(len(targets))
        cls = self.class_of[targets]
        z = states @ p["wc"] + p["bc"]
        if grads is None:
            out = np.minimum(z[rows, cls] - _log_sums(z), 0)
        else:
            d = _softmax(z)
            out = np.log(d[rows, cls])
            d[rows, cls] -= 1
            grads["wc"] += states.T @ d
            grads["bc"] += d.sum(0)
            ds = d @ p["wc"].T
        order = _order(cls, len(self.borders))
        at = np.concatenate([[0], np.cumsum(np.bincount(cls, minlength=len(self.borders)))])
        for k in range(len(self.borders) - 1):
            own = order[at[k]:at[k + 1]]
            a, b = self.borders[k], self.borders[k + 1]
            if not len(own) or b - a == 1:
                continue
            w = p["ww"][a:b]
            inside = states.take(own, axis=0)
            z = inside @ w.T + p["bw"][a:b]
            pick = (np.arange(len(own)), targets[own] - a)
            if grads is None:
                out[own] += np.minimum(z[pick] - _log_sums(z), 0)
                continue
            e = _softmax(z)
            out[own] += np.log(e[pick])
            e[pick] -= 1
            grads["ww"][a:b] += e.T @ inside
            grads["bw"][a:b] += e.sum(0)
            ds[own] += e @ w
        return out if grads is None else (out, ds)

    # ---- scoring
    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of each whole document (ids ending with 0).

        Whole documents are dealt to rows of about equal length, longest first.
        All rows advance window by window with their states carried on; an end
        token resets the state, so neighbours in a row do not meet."""
        if not docs:
            return np.zeros(0)
        lengths = np.array([len(d) for d in docs])
        n_rows = min(ROWS, len(docs))
        load = [(0, r) for r in range(n_rows)]
        rows: list[list[int]] = [[] for _ in range(n_rows)]
        for k in np.argsort(-lengths, kind="stable").tolist():
            words, r = heapq.heappop(load)
            rows[r].append(k)
            heapq.heappush(load, (words + int(lengths[k]), r))
        rows.sort(key=lambda own: -sum(int(lengths[k]) for k in own))      # longest rows first
        sizes = np.array([sum(int(lengths[k]) for k in own) for own in rows])
        targets = np.zeros((n_rows, int(sizes[0])), np.int32)
        for r, own in enumerate(rows):
            targets[r, :sizes[r]] = np.concatenate([docs[k] for k in own])
        inputs = np.concatenate([np.zeros((n_rows, 1), np.int32), targets[:, :-1]], 1)
        got = np.zeros(targets.shape, np.float32)
        state = np.zeros((n_rows, self.p["u"].shape[0]), np.float32)
        for begin in range(0, targets.shape[1], WINDOW):
            alive = int(np.searchsorted(-sizes, -begin, side="left"))
            at = (slice(0, alive), slice(begin, begin + WINDOW))
            now = targets[at].T
            states, state = self._steps(np.ascontiguousarray(inputs[at].T), state[:alive])
            got[at] = self.log_probs(states.reshape(-1, states.shape[2]), now.ravel()).reshape(now.shape).T
        out = np.zeros(len(docs))
        for r, own in enumerate(rows):
            starts = np.concatenate([[0], np.cumsum(lengths[own])[:-1]])
            out[own] = np.add.reduceat(got[r, :sizes[r]].astype(np.float64), starts)
        return out

    # ---- training
    def train(self, stream: np.ndarray, rows: int = ROWS, rate: float = 0.01, adam: dict | None = None) -> dict:
        """One pass of truncated backpropagation over a stream of documents laid
        out in ``rows`` parallel rows; ``adam`` carries the optimiser on."""
        adam = adam if adam is not None else {"t": 0, "m": {}, "v": {}}
        rows = max(1, min(rows, len(stream) // WINDOW))
        width = -(-len(stream) // rows)
        padded = np.zeros(rows * width, np.int64)
        padded[:len(stream)] = stream
        counts = np.zeros(rows * width, bool)
        counts[:len(stream)] = True
        targets, counts = padded.reshape(rows, width), counts.reshape(rows, width)
        inputs = np.concatenate([np.zeros((rows, 1), np.int64), targets[:, :-1]], 1)
        state = np.zeros((rows, self.p["u"].shape[0]), np.float32)
        for begin in range(0, width, WINDOW):
            at = slice(begin, begin + WINDOW)
            state = self._learn(inputs[:, at], targets[:, at], counts[:, at], state, rate, adam)
        return adam

    def _learn(self, inputs, targets, counts, state, rate, adam):
        p, h = self.p, self.p["u"].shape[0]
        keep: list = []
        inputs, targets, counts = (np.ascontiguousarray(a.T) for a in (inputs, targets, counts))
        states, last = self._steps(inputs, state, keep)
        g = {a: np.zeros_like(v) for a, v in p.items()}
        _, ds = self.log_probs(states[counts], targets[counts], g)
        d_all = np.zeros_like(states)
        d_all[counts] = ds
        dx = np.empty((*inputs.shape, 3 * h), states.dtype)
        dh = np.zeros_like(last)
        going = (inputs != 0)[:, :, None]
        back = np.empty((inputs.shape[1], 3 * h), states.dtype)
        for t in range(len(inputs) - 1, -1, -1):
            before, reset, update, inner, new = keep[t]
            dh += d_all[t]
            rest = 1 - update
            d_new = dh * rest
            d_new *= 1 - new * new
            d_up = np.subtract(before, new, out=back[:, h:2 * h])
            d_up *= dh
            d_up *= update
            d_up *= rest
            d_inner = np.multiply(d_new, reset, out=back[:, 2 * h:])
            d_reset = np.multiply(d_inner, inner, out=back[:, :h])
            d_reset *= 1 - reset
            g["u"] += before.T @ back
            g["c"] += d_inner.sum(0)
            dx[t, :, :2 * h] = back[:, :2 * h]
            dx[t, :, 2 * h:] = d_new
            dh *= update
            dh += back @ p["u"].T
            dh *= going[t]
        flat, ids = dx.reshape(-1, 3 * h), inputs.ravel()
        order = _order(ids, self.other)
        n_seen = np.bincount(ids, minlength=self.other + 1)
        seen = np.flatnonzero(n_seen)
        g["x"][seen] = np.add.reduceat(flat.take(order, axis=0), np.cumsum(n_seen[seen]) - n_seen[seen])
        n = max(1, int(counts.sum()))
        adam["t"] += 1
        size = float(rate * (1 - 0.99 ** adam["t"]) ** 0.5 / (1 - 0.9 ** adam["t"]))
        for a, grad in g.items():
            grad /= n
            m = adam["m"].setdefault(a, np.zeros_like(grad))
            v = adam["v"].setdefault(a, np.zeros_like(grad))
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            p[a] -= size * m / (np.sqrt(v) + 1e-8)
        return last
