"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the embedding of its hash plus the mean embedding of its letter trigrams. Two
recurrent passes read a stretch of words; attention weighs the states of a window of it, and a linear
unit gives the window's logit. As attention is a quotient of two sums over the window, running sums
give the logits of all windows of a stretch, one at every word, from one reading.
Gradients are written out; Adam trains all parameters.
"""

from __future__ import annotations

import numpy as np

WORDS, GRAMS, SIZE, HIDDEN, ATTENTION = 1 << 13, 1 << 13, 12, 12, 8
_F = np.float32


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Vocabulary:
    """The distinct words of some texts: hash row, and trigram rows with their word."""

    def __init__(self, word: np.ndarray, gram: np.ndarray, gram_word: np.ndarray):
        self.word, self.gram, self.gram_word = word, gram, gram_word
        self.grams = np.maximum(np.bincount(gram_word, minlength=len(word)), 1).astype(_F)[:, None]


class Network:
    def __init__(self, seed: int = 3):
        rng = np.random.Generator(np.random.PCG64(seed))

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(_F)

        self.p = {"words": normal(WORDS, SIZE, scale=0.1), "grams": normal(GRAMS, SIZE, scale=0.1)}
        for side in "fb":
            self.p[f"x{side}"] = normal(SIZE, 3 * HIDDEN, scale=SIZE**-0.5)
            self.p[f"h{side}"] = normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5)
            self.p[f"c{side}"] = np.zeros(3 * HIDDEN, _F)
        self.p["a"] = normal(2 * HIDDEN, ATTENTION, scale=0.3)
        self.p["v"] = normal(ATTENTION, scale=0.3)
        self.p["o"] = normal(2 * HIDDEN, scale=0.3)
        self.p["bias"] = np.zeros(1, _F)
        self.moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        self.turn, self.start = 0, {}

    def begin(self):
        """Training holds embeddings near what they are now."""
        self.start = {k: self.p[k].copy() for k in ("words", "grams")}

    def inputs(self, vocabulary: Vocabulary) -> np.ndarray:
        """One input vector for each distinct word."""
        total = np.zeros((len(vocabulary.word), SIZE), _F)
        if len(vocabulary.gram):
            first = np.flatnonzero(np.diff(vocabulary.gram_word, prepend=-1))
            sums = np.add.reduceat(self.p["grams"][vocabulary.gram], first, axis=0)
            total[vocabulary.gram_word[first]] = sums
        return self.p["words"][vocabulary.word] + total / vocabulary.grams

    def _pass(self, side: str, gates: np.ndarray, words: np.ndarray, size: np.ndarray, keep: bool):
        n, length = words.shape
        recurrent = self.p[f"h{side}"]
        full = int(size.min())
        h, states, saved = np.zeros((n, HIDDEN), _F), np.zeros((length, n, HIDDEN), _F), []
        for t in range(length) if side == "f" else range(length - 1, -1, -1):
            g, u = gates[words[:, t]], h @ recurrent
            rz = _sigmoid(g[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            new = np.tanh(g[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            if keep:
                saved.append((t, h, u[:, 2 * HIDDEN :], r, z, new))
            h = new + z * (h - new)
            if t >= full:
                h[size <= t] = 0
            states[t] = h
        return states, saved

    def _read(self, x: np.ndarray, words: np.ndarray, size: np.ndarray, keep: bool = False):
        """States at each place of the stretches, and what attention sees in them."""
        sides = [self._pass(s, x @ self.p[f"x{s}"] + self.p[f"c{s}"], words, size, keep) for s in "fb"]
        states = np.concatenate([s[0] for s in sides], axis=2)
        squeezed = np.tanh(states @ self.p["a"])
        return sides, states, squeezed, squeezed @ self.p["v"]

    def over(self, x: np.ndarray, words: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
        """Logits of all windows of ``width`` words: a row for each first place, a column for each stretch.

        A shorter stretch has one window; windows that don't exist are minus infinity.
        """
        _, states, _, weight = self._read(x, words, size)
        length = len(states)
        weight = np.where(np.arange(length)[:, None] < size, weight.astype(np.float64), -np.inf)
        weight = np.exp(weight - weight.max(axis=0))
        low = np.arange(max(1, length - width + 1))
        high = np.minimum(low + width, length)

        def within(value):
            sums = np.concatenate((np.zeros((1, len(size))), np.cumsum(value, axis=0)))
            return sums[high] - sums[low]

        exists = low[:, None] + width <= np.maximum(size, width)
        total = np.where(exists, within(weight), 1)
        return np.where(exists, within(weight * (states @ self.p["o"])) / total + self.p["bias"], -np.inf)

    def logits(self, x: np.ndarray, words: np.ndarray, size: np.ndarray, low: np.ndarray,
               high: np.ndarray, keep: bool = False):
        """Logit of one window of each stretch, from place ``low`` until ``high``.

        ``words`` holds word numbers, ``size`` how many of them count.
        """
        sides, states, squeezed, weight = self._read(x, words, size, keep)
        place = np.arange(len(weight))[:, None]
        weight[(place < low) | (place >= high)] = -1e9
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnd->nd", weight, states)
        out = pooled @ self.p["o"] + self.p["bias"]
        return (out, (sides, states, squeezed, weight, pooled)) if keep else out

    def train(self, vocabulary: Vocabulary, words, size, low, high, label, weight, rate: float):
        """One step of Adam on the weighted log loss."""
        x = self.inputs(vocabulary)
        out, (sides, states, squeezed, share, pooled) = self.logits(x, words, size, low, high, True)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_out = ((_sigmoid(out) - label) * weight / weight.sum()).astype(_F)
        g["o"], g["bias"] = pooled.T @ d_out, d_out.sum(keepdims=True)
        d_pooled = d_out[:, None] * self.p["o"][None, :]
        d_share = np.einsum("tnd,nd->tn", states, d_pooled)
        d_logit = share * (d_share - (share * d_share).sum(axis=0))
        g["v"] = np.einsum("tn,tna->a", d_logit, squeezed)
        d_squeezed = d_logit[:, :, None] * self.p["v"] * (1 - squeezed**2)
        g["a"] = np.einsum("tnd,tna->da", states, d_squeezed)
        d_states = share[:, :, None] * d_pooled[None] + d_squeezed @ self.p["a"].T
        d_x = np.zeros_like(x)
        for i, side in enumerate("fb"):
            d_gates = np.zeros((len(x), 3 * HIDDEN), _F)
            d_h = np.zeros((len(words), HIDDEN), _F)
            recurrent = self.p[f"h{side}"]
            for t, before, u, r, z, new in reversed(sides[i][1]):
                d_h = (d_h + d_states[t, :, i * HIDDEN : (i + 1) * HIDDEN]) * (t < size)[:, None]
                d_z = d_h * (before - new) * z * (1 - z)
                d_new = d_h * (1 - z) * (1 - new**2)
                d_r = d_new * u * r * (1 - r)
                np.add.at(d_gates, words[:, t], np.concatenate((d_r, d_z, d_new), axis=1))
                d_u = np.concatenate((d_r, d_z, d_new * r), axis=1)
                g[f"h{side}"] += before.T @ d_u
                d_h = d_h * z + d_u @ recurrent.T
            g[f"x{side}"], g[f"c{side}"] = x.T @ d_gates, d_gates.sum(axis=0)
            d_x += d_gates @ self.p[f"x{side}"].T
        np.add.at(g["words"], vocabulary.word, d_x)
        np.add.at(g["grams"], vocabulary.gram, (d_x / vocabulary.grams)[vocabulary.gram_word])
        self.turn += 1
        for k, grad in g.items():
            m, s = self.moments[k]
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            step = rate * np.sqrt(1 - 0.999**self.turn) / (1 - 0.9**self.turn)
            if k in self.start:
                self.p[k] -= _F(0.1 * rate) * (self.p[k] - self.start[k])
            self.p[k] -= (step * m / (np.sqrt(s) + 1e-8)).astype(_F)
