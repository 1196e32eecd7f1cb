"""A character-level bidirectional LSTM with a linear-chain CRF, in numpy.

Works on batches of equally long windows of character classes. Training is
exact: forward-backward over the chain and back-propagation through time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

FORBIDDEN = -1e4


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Tagger:
    """Parameters; ``allowed[i, j]`` says whether tag j may follow tag i, ``first[j]``
    whether a window may begin with it."""

    classes: int
    tags: int
    allowed: np.ndarray
    first: np.ndarray
    dim: int = 12
    hidden: int = 20
    seed: int = 0
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        if self.p:
            return
        rng, h = np.random.default_rng(self.seed), self.hidden

        def draw(*shape):
            return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"chars": draw(self.classes, self.dim), "out": draw(2 * h, self.tags), "out_b": np.zeros(self.tags, np.float32),
                  "step": np.zeros((self.tags, self.tags), np.float32), "begin": np.zeros(self.tags, np.float32)}
        for way in "fb":
            self.p |= {f"x{way}": draw(self.dim, 4 * h), f"h{way}": draw(h, 4 * h),
                       f"b{way}": np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(np.float32)}

    # ------------------------------------------------------------------ LSTM

    def _run(self, x, way, training=True):
        """Hidden states [L, N, H] of one direction and what its gradient needs: cells and
        gates, kept of one step only without ``training`` (they are most of the memory)."""
        length, n, _ = x.shape
        h = self.hidden
        out = np.zeros((length, n, h), np.float32)
        cells = np.zeros((length if training else 1, n, h), np.float32)
        gates = np.zeros((length if training else 1, n, 4 * h), np.float32)
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for t in range(length) if way == "f" else range(length - 1, -1, -1):
            z = x[t] @ self.p[f"x{way}"] + self.p[f"b{way}"] + state @ self.p[f"h{way}"]
            g = gates[t if training else 0]
            g[:, :3 * h] = _sigmoid(z[:, :3 * h])          # input, forget, output
            g[:, 3 * h:] = np.tanh(z[:, 3 * h:])
            cell = g[:, h:2 * h] * cell + g[:, :h] * g[:, 3 * h:]
            cells[t if training else 0] = cell
            state = g[:, 2 * h:3 * h] * np.tanh(cell)
            out[t] = state
        return out, cells, gates

    def _back(self, x, way, out, cells, gates, d_out, grads):
        length, n, _ = x.shape
        h = self.hidden
        dz = np.zeros_like(gates)
        d_state, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        order = list(range(length)) if way == "f" else list(range(length - 1, -1, -1))
        for k in range(length - 1, -1, -1):
            t = order[k]
            before = cells[order[k - 1]] if k else np.zeros((n, h), np.float32)
            i, f, o, g = (gates[t][:, j * h:(j + 1) * h] for j in range(4))
            d_state = d_state + d_out[t]
            squashed = np.tanh(cells[t])
            d_cell = d_cell + d_state * o * (1 - squashed ** 2)
            own = dz[t]
            own[:, :h] = d_cell * g * i * (1 - i)
            own[:, h:2 * h] = d_cell * before * f * (1 - f)
            own[:, 2 * h:3 * h] = d_state * squashed * o * (1 - o)
            own[:, 3 * h:] = d_cell * i * (1 - g ** 2)
            d_cell = d_cell * f
            d_state = own @ self.p[f"h{way}"].T
        previous = np.zeros_like(out)
        if way == "f":
            previous[1:] = out[:-1]
        else:
            previous[:-1] = out[1:]
        flat = dz.reshape(-1, 4 * h)
        grads[f"h{way}"] = previous.reshape(-1, h).T @ flat
        grads[f"x{way}"] = x.reshape(-1, self.dim).T @ flat
        grads[f"b{way}"] = flat.sum(axis=0)
        return dz @ self.p[f"x{way}"].T

    def emissions(self, windows, training=True):
        """Tag scores [L, N, tags] of windows [N, L] and the intermediate values."""
        x = self.p["chars"][windows.T]
        forward, backward = self._run(x, "f", training), self._run(x, "b", training)
        both = np.concatenate([forward[0], backward[0]], axis=2)
        return both @ self.p["out"] + self.p["out_b"], (x, forward, backward, both)

    # ------------------------------------------------------------------- CRF

    def _chain(self):
        return np.where(self.allowed, self.p["step"], FORBIDDEN), np.where(self.first, self.p["begin"], FORBIDDEN)

    def _alpha_beta(self, scores):
        step, begin = self._chain()
        length = len(scores)
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[0] = begin + scores[0]
        for t in range(1, length):
            alpha[t] = _logsum(alpha[t - 1][:, :, None] + step, 1) + scores[t]
        for t in range(length - 2, -1, -1):
            beta[t] = _logsum(step + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        return alpha, beta, _logsum(alpha[-1], 1)

    def loss(self, windows, tags):
        """Mean negative log-likelihood of tags [N, L] and its gradients."""
        scores, (x, forward, backward, both) = self.emissions(windows)
        step, begin = self._chain()
        alpha, beta, total = self._alpha_beta(scores)
        length, n, _ = scores.shape
        gold = tags.T
        cols = np.arange(n)
        path = begin[gold[0]] + scores[0, cols, gold[0]]
        for t in range(1, length):
            path = path + step[gold[t - 1], gold[t]] + scores[t, cols, gold[t]]
        d_scores = np.exp(alpha + beta - total[:, None])
        grads = {"begin": d_scores[0].sum(axis=0) - np.bincount(gold[0], minlength=self.tags)}
        d_step = np.zeros_like(step)
        for t in range(1, length):
            pair = alpha[t - 1][:, :, None] + step + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
            d_step += np.exp(pair).sum(axis=0)
        np.add.at(d_step, (gold[:-1].ravel(), gold[1:].ravel()), -1)
        grads["step"] = np.where(self.allowed, d_step, 0)
        grads["begin"] = np.where(self.first, grads["begin"], 0)
        d_scores[np.arange(length)[:, None], cols, gold] -= 1
        d_scores = (d_scores / n).astype(np.float32)
        grads["step"], grads["begin"] = grads["step"] / n, grads["begin"] / n
        flat = d_scores.reshape(-1, self.tags)
        grads["out"] = both.reshape(-1, 2 * self.hidden).T @ flat
        grads["out_b"] = flat.sum(axis=0)
        d_both = d_scores @ self.p["out"].T
        d_x = (self._back(x, "f", *forward, d_both[:, :, :self.hidden], grads)
               + self._back(x, "b", *backward, d_both[:, :, self.hidden:], grads))
        d_chars = np.zeros_like(self.p["chars"])
        np.add.at(d_chars, windows.T.ravel(), d_x.reshape(-1, self.dim))
        grads["chars"] = d_chars
        return float((total - path).mean()), grads

    def decode(self, windows):
        """Best tag path [N, L] of every window and the marginal probability of each tag on it."""
        scores = self.emissions(windows, training=False)[0]
        step, begin = self._chain()
        length, n, _ = scores.shape
        best = begin + scores[0]
        back = np.zeros((length, n, self.tags), np.int8)
        for t in range(1, length):
            options = best[:, :, None] + step
            back[t] = options.argmax(axis=1)
            best = options.max(axis=1) + scores[t]
        path = np.zeros((length, n), np.int64)
        path[-1] = best.argmax(axis=1)
        cols = np.arange(n)
        for t in range(length - 1, 0, -1):
            path[t - 1] = back[t, cols, path[t]]
        alpha, beta, total = self._alpha_beta(scores)
        sure = np.exp(alpha + beta - total[:, None])[np.arange(length)[:, None], cols, path]
        return path.T, sure.T


def train(tagger: Tagger, windows, tags, epochs: int, batch: int, rate: float, seed: int = 0) -> list[float]:
    """Adam with gradient clipping; returns the mean loss of each epoch."""
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    square = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    steps, step, history = epochs * -(-len(windows) // batch), 0, []
    for _ in range(epochs):
        order, losses = rng.permutation(len(windows)), []
        for at in range(0, len(order), batch):
            own = order[at:at + batch]
            loss, grads = tagger.loss(windows[own], tags[own])
            losses.append(loss)
            step += 1
            norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
            scale = min(1.0, 5.0 / (norm + 1e-9))
            lr = rate * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                g = (g * scale).astype(np.float32)
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                tagger.p[k] -= lr * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-7)
        history.append(float(np.mean(losses)))
    return history
