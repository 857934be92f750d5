"""Gated recurrent language model with a class-factored softmax, in numpy.

A symbol is a known word, the end of a text, or a bucket of rare words. The
output first picks a class, then a symbol in it: known words lie in classes of
WIDTH, a rare bucket is a class of its own. Training is by truncated
backpropagation: gradients stop at the window, the state is carried on. Longer
texts are cut into pieces for training, so that the texts side by side have
similar lengths; scoring carries the state through the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STATE = 32
WIDTH = 32
STEPS = 24
#: texts side by side in training and in scoring; symbols of a piece in training
STREAMS, SCORED, PIECE = 64, 512, 20 * STEPS
#: rows whose class scores are held at a time, so that they stay in the cache
ROWS = 4096
#: scores within this bound need no shift before exp in single precision
SAFE = 80.0
#: numbers that a step of Adam takes at a time; rows of a symbol from which they are summed for themselves
CACHED, OFTEN = 1 << 15, 16
ONE = np.float32(1)
END = 0


def _log_at(x: np.ndarray, at: np.ndarray, safe: bool) -> np.ndarray:
    """Log of the softmax of each row at one place; works in place on x."""
    if not safe:
        x -= x.max(-1, keepdims=True)
    own = x[np.arange(len(x)), at]
    np.exp(x, out=x)
    return own - np.log(x @ np.ones(x.shape[1], np.float32))


def _is_safe(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no state, all in [-1, 1], leads to a score beyond SAFE."""
    most = np.abs(weights).sum(-2)
    return bool((most + bias).max() < SAFE and (most - bias)[bias > -SAFE].max() < SAFE)


def _excess(x: np.ndarray, at: np.ndarray, n: int, safe: bool) -> np.ndarray:
    """Softmax of each row less 1 at one place, over n; works in place on x."""
    if not safe:
        x -= x.max(-1, keepdims=True)
    np.exp(x, out=x)
    x *= (np.float32(1 / n) / (x @ np.ones(x.shape[1], np.float32)))[:, None]
    x[np.arange(len(x)), at] -= np.float32(1 / n)
    return x


def _sums(keys: np.ndarray, parts: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, and the sum of its rows; a key's row is at ``place`` of all parts, side by side.

    The k-th rows of all keys are added at once, up to OFTEN; the few keys with more are summed one by one.
    """
    order = np.argsort(keys, kind="stable")
    line, at = keys[order], place[order]
    rows = np.concatenate([p.take(at, 0) for p in parts], 1)
    starts = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
    counts = np.diff(np.append(starts, len(line)))
    most_first = np.argsort(-counts, kind="stable")
    starts, counts = starts[most_first], counts[most_first]
    more = np.searchsorted(-counts, -np.arange(OFTEN + 1)).tolist()  # keys with more rows than k
    out, often = rows.take(starts, 0), more[OFTEN]
    for k in range(1, OFTEN):
        out[often:more[k]] += rows.take(starts[often:more[k]] + k, 0)
    for i in range(often):
        rows[starts[i]:starts[i] + counts[i]].sum(0, out=out[i])
    return line[starts], out


def _adam(p: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, rate: float, step: int) -> None:
    """One step in place, in parts that stay in the cache; m and v are kept without the factors 0.1 and 0.01."""
    first, second = 0.1 / (1 - 0.9**step), (0.01 / (1 - 0.99**step))**0.5
    rate, least = np.float32(rate * first / second), np.float32(1e-6 / second)
    for at in range(0, len(p), CACHED):
        part = slice(at, at + CACHED)
        grad, mean, square = g[part], m[part], v[part]
        mean *= np.float32(0.9)
        mean += grad
        change = grad * grad
        square *= np.float32(0.99)
        square += change
        np.sqrt(square, out=change)
        change += least
        np.divide(mean, change, out=change)
        change *= rate
        p[part] -= change


def streams(texts: list[np.ndarray], size: int = STREAMS):
    """Groups of texts of similar length as (indices, inputs, targets, inside), time first.

    Every text starts from END and has END as last target.
    """
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    for at in range(0, len(order), size):
        own = order[at:at + size]
        length = max(len(texts[i]) for i in own) + 1
        x = np.zeros((length, len(own)), np.int32)
        y = np.zeros((length, len(own)), np.int32)
        inside = np.zeros((length, len(own)), np.float32)
        for k, i in enumerate(own):
            n = len(texts[i])
            x[1:n + 1, k] = texts[i]
            y[:n, k] = texts[i]
            y[n, k] = END
            inside[:n + 1, k] = 1
        yield own, x, y, inside


def pieces(texts: list[np.ndarray], size: int = PIECE):
    """(inputs, targets) of at most ``size`` steps, which together hold each whole text once."""
    for t in texts:
        line = np.concatenate(([END], t, [END]))
        for at in range(0, len(line) - 1, size):
            part = line[at:at + size + 1]
            yield part[:-1], part[1:]


def piece_groups(texts: list[np.ndarray], size: int = STREAMS):
    """Groups of pieces of similar length as (inputs, targets, inside), time first."""
    cut = sorted(pieces(texts), key=lambda p: len(p[0]))
    for at in range(0, len(cut), size):
        own = cut[at:at + size]
        x = np.zeros((len(own[-1][0]), len(own)), np.int32)
        y, inside = x.copy(), x.astype(np.float32)
        for k, (a, b) in enumerate(own):
            x[:len(a), k], y[:len(a), k], inside[:len(a), k] = a, b, 1
        yield x, y, inside


@dataclass
class Gru:
    known: int  # END and known words
    buckets: int
    inputs: np.ndarray  # symbol -> parts of the three gates, biases included
    inner: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_word: np.ndarray
    word_bias: np.ndarray

    @classmethod
    def start(cls, known_counts: np.ndarray, bucket_counts: np.ndarray, seed: int = 3) -> Gru:
        """Biases hold the symbols' shares, so an untrained model knows how often they occur."""
        r = np.random.default_rng(seed)
        known, buckets = len(known_counts), len(bucket_counts)
        classes = -(-known // WIDTH)
        padded = np.zeros(classes * WIDTH)
        padded[:known] = known_counts + 0.1
        padded = padded.reshape(classes, WIDTH)
        mass = np.concatenate((padded.sum(1), bucket_counts + 0.1))
        with np.errstate(divide="ignore"):
            word_bias = np.maximum(np.log(padded / padded.sum(1, keepdims=True)), -1e4)
        f = np.float32
        return cls(
            known, buckets,
            r.normal(0, 0.3, (known + buckets, 3 * STATE)).astype(f),
            r.normal(0, STATE**-0.5, (STATE, 3 * STATE)).astype(f),
            r.normal(0, 0.05, (STATE, classes + buckets)).astype(f), np.log(mass / mass.sum()).astype(f),
            r.normal(0, 0.05, (classes, STATE, WIDTH)).astype(f), word_bias.astype(f))

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.inner, self.to_class, self.class_bias, self.to_word, self.word_bias]

    def packed(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def unpack(self, data: np.ndarray) -> Gru:
        at = 0
        for p in self.parameters():
            p[...] = data[at:at + p.size].reshape(p.shape)
            at += p.size
        return self

    def _class_of(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < self.known, symbols // WIDTH, symbols - self.known + len(self.to_word))

    def _gate_tables(self) -> list[np.ndarray]:
        """Inputs and weights of the two gates, negated as a gate is 1 / (1 + exp(-a)), and of the candidate."""
        s = STATE
        return [-self.inputs[:, :2 * s], -self.inner[:, :2 * s],
                np.ascontiguousarray(self.inputs[:, 2 * s:]), np.ascontiguousarray(self.inner[:, 2 * s:])]

    @staticmethod
    def _advance(x: np.ndarray, h: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """States after each step, as `_forward` has them, with nothing kept for the gradients."""
        gate_in, gate, new_in, new = tables
        out = np.empty((len(x), *h.shape), np.float32)
        with np.errstate(over="ignore"):
            for t, symbols in enumerate(x):
                both = h @ gate
                both += gate_in.take(symbols, 0)
                np.exp(both, out=both)
                both += ONE
                np.reciprocal(both, out=both)
                n = h @ new
                n *= both[:, STATE:]
                n += new_in.take(symbols, 0)
                np.tanh(n, out=n)
                state = out[t]
                np.subtract(h, n, out=state)
                state *= both[:, :STATE]
                state += n
                h = state
        return out

    def _emit(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log-probability of each target, the share inside rare buckets left out."""
        own = self._class_of(y)
        safe = _is_safe(self.to_class, self.class_bias)
        safe_words = _is_safe(self.to_word, self.word_bias)
        total = np.empty(len(y), np.float32)
        for at in range(0, len(y), ROWS):
            rows = slice(at, at + ROWS)
            total[rows] = _log_at(h[rows] @ self.to_class + self.class_bias, own[rows], safe)
        order = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[order], np.arange(len(self.to_word) + 1))
        for c in range(len(self.to_word)):
            rows = order[cuts[c]:cuts[c + 1]]
            if len(rows):
                x = h.take(rows, 0) @ self.to_word[c] + self.word_bias[c]
                total[rows] += _log_at(x, y[rows] - c * WIDTH, safe_words)
        return total

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log-likelihood of each whole text, the state carried from window to window."""
        out, tables = np.zeros(len(texts)), self._gate_tables()
        waiting, held = [], 0

        def flush():
            nonlocal waiting, held
            if waiting:
                h, y, owner = (np.concatenate(part) for part in zip(*waiting))
                out[:] += np.bincount(owner, self._emit(h, y), len(out))
            waiting, held = [], 0

        for own, x, y, inside in streams(texts, SCORED):
            h = np.zeros((len(own), STATE), np.float32)
            own, lengths = np.array(own), inside.sum(0).astype(int)
            for at in range(0, len(x), STEPS):
                first = int(np.searchsorted(lengths, at, side="right"))  # sorted: the finished ones come first
                part = slice(at, at + STEPS)
                states = self._advance(x[part, first:], h[first:], tables)
                h[first:] = states[-1]
                real = inside[part, first:] > 0
                waiting.append((states[real], y[part, first:][real], own[first:][real.nonzero()[1]]))
                held += len(waiting[-1][1])
                if held >= 2 * ROWS:  # few long texts fill many windows
                    flush()
        flush()
        return out

    def train(self, texts: list[np.ndarray], rate: float = 6e-3, seed: int = 1) -> int:
        """One pass with Adam; returns the tokens seen."""
        r = np.random.default_rng(seed)
        groups = list(piece_groups(texts))
        params = self.parameters()
        grads = [np.zeros_like(p) for p in params]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        steps = sum(-(-len(g[0]) // STEPS) for g in groups)
        step, tokens = 0, 0
        for k in r.permutation(len(groups)):
            x, y, inside = groups[k]
            h = np.zeros((x.shape[1], STATE), np.float32)
            for at in range(0, len(x), STEPS):
                part = slice(at, at + STEPS)
                live = inside[part].any(0)
                _, state, n = self._gradients(x[part, live], y[part, live], inside[part, live], h[live], grads)
                h[live] = state
                tokens, step = tokens + n, step + 1
                now = rate * (1 - 0.9 * step / steps)
                for p, g, (m, v) in zip(params, grads, moments):
                    _adam(p.reshape(-1), g.reshape(-1), m.reshape(-1), v.reshape(-1), now, step)
        return tokens

    def _gradients(self, x, y, inside, h0, out: list[np.ndarray] | None = None):
        """Gradients of the mean loss, in ``out`` if given, the last states and the number of targets."""
        out = out or [np.empty_like(p) for p in self.parameters()]
        d_inputs, d_inner, d_class, d_class_bias, d_word, d_word_bias = out
        keep: list[np.ndarray] = []
        self._forward(x, h0, keep)
        gates, inner, states = keep
        real = np.flatnonzero(inside.ravel())
        own = self._class_of(y.ravel()[real]).astype(np.min_scalar_type(self.to_class.shape[1]))
        order = np.argsort(own, kind="stable")  # rows of one class lie together
        own, place = own[order], real[order]
        h, target, n = states[1:].reshape(-1, STATE).take(place, 0), y.ravel()[place], len(real)
        p = _excess(h @ self.to_class + self.class_bias, own, n, _is_safe(self.to_class, self.class_bias))
        d_h = p @ self.to_class.T
        np.matmul(h.T, p, out=d_class)
        ones = np.ones(n, np.float32)
        np.dot(ones, p, out=d_class_bias)
        cuts = np.searchsorted(own, np.arange(len(self.to_word) + 1)).tolist()
        spans = [(c, slice(*cuts[c:c + 2])) for c in range(len(self.to_word)) if cuts[c] < cuts[c + 1]]
        words, own = cuts[-1], own[:cuts[-1]]
        q, d_q = np.empty((words, WIDTH), np.float32), np.empty((words, STATE), np.float32)
        for c, rows in spans:
            np.dot(h[rows], self.to_word[c], out=q[rows])
        q += self.word_bias.take(own, 0)
        q = _excess(q, target[:words] % WIDTH, n, _is_safe(self.to_word, self.word_bias))
        d_word.fill(0)
        d_word_bias.fill(0)
        for c, rows in spans:
            np.dot(h[rows].T, q[rows], out=d_word[c])
            np.dot(q[rows], self.to_word[c].T, out=d_q[rows])
            np.dot(ones[rows], q[rows], out=d_word_bias[c])
        d_h[:words] += d_q
        back = np.zeros((x.size, STATE), np.float32)
        back[place] = d_h
        d_gates = self._back(gates, inner, states, back.reshape(states[1:].shape))
        d_inner.reshape(STATE, 3, STATE)[:] = np.matmul(
            states[:-1].reshape(-1, STATE).T, d_gates[:3].reshape(3, -1, STATE)).swapaxes(0, 1)
        d_inputs.fill(0)
        symbols = x.ravel()[real].astype(np.min_scalar_type(len(self.inputs)))  # 16 bits sort fastest
        symbols, sums = _sums(symbols, [d_gates[k].reshape(-1, STATE) for k in (0, 1, 3)], real)
        d_inputs[symbols] = sums
        return out, states[-1], n

    def _forward(self, x: np.ndarray, h: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each step.

        ``keep`` gets the two gates and the candidate, the candidate's inner part, and the states from the
        first on. Gates come first in memory, then steps, so that every operation runs over whole blocks.
        """
        size = (*x.shape, STATE)
        gates, inner = np.empty((3, *size), np.float32), np.empty((len(x), 3, *size[1:]), np.float32)
        sign = np.array([-1, -1, 1], np.float32)[:, None, None]  # a gate is 1 / (1 + exp(-a))
        np.multiply(self.inputs.take(x.ravel(), 0).reshape(-1, 3, STATE).swapaxes(0, 1), sign, out=gates.reshape(3, -1, STATE))
        weights = self.inner.reshape(STATE, 3, STATE).swapaxes(0, 1) * sign
        states, more = np.empty((len(x) + 1, *size[1:]), np.float32), np.empty(size[1:], np.float32)
        states[0] = h
        with np.errstate(over="ignore"):
            for t in range(len(x)):
                h, part = states[t], inner[t]
                np.matmul(h, weights, out=part)
                both, n = gates[:2, t], gates[2, t]
                both += part[:2]
                np.exp(both, out=both)
                both += ONE
                np.reciprocal(both, out=both)
                np.multiply(both[1], part[2], out=more)
                n += more
                np.tanh(n, out=n)
                np.subtract(h, n, out=more)
                more *= both[0]
                np.add(n, more, out=states[t + 1])
        if keep is not None:
            keep += [gates, inner[:, 2], states]
        return states[1:]

    def _back(self, gates: np.ndarray, inner: np.ndarray, states: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Gradients of the two gates, of the candidate's inner part and of the candidate, before their functions.

        Each is the gradient of a state times a factor that is known beforehand.
        """
        z, r, n = gates
        out, rest = np.empty((4, *z.shape), np.float32), ONE - z
        np.multiply(n, n, out=out[3])
        np.subtract(ONE, out[3], out=out[3])
        out[3] *= rest
        np.multiply(out[3], r, out=out[2])
        np.subtract(ONE, r, out=out[1])
        out[1] *= out[2]
        out[1] *= inner
        np.subtract(states[:-1], n, out=out[0])
        out[0] *= z
        out[0] *= rest
        weights = np.ascontiguousarray(self.inner.reshape(STATE, 3, STATE).transpose(1, 2, 0))
        d, parts = np.zeros(z.shape[1:], np.float32), np.empty((3, *z.shape[1:]), np.float32)
        for t in range(len(z) - 1, -1, -1):
            d += back[t]
            own = out[:, t]
            own *= d
            np.matmul(own[:3], weights, out=parts)
            d *= z[t]
            for part in parts:
                d += part
        return out
