"""Byte-level convolutional network in numpy.

A text is read as bytes in windows of fixed length that overlap by OVERLAP, so
together they cover it whole. Filters of several widths slide over a window,
each keeps its largest response, and a linear layer turns these into scores per
class. The scores of a text are the mean over its windows, weighted by the bytes
in each.

For prediction the embedding and the filters are folded into one table with a
row for each pair of bytes: a filter of width four is the sum of two entries.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LENGTH = 256
OVERLAP = 8
WIDTHS = (2, 4, 6)
FILTERS = 24
EMBEDDING = 8
#: windows that are scored at a time; bounds the memory of a task
BLOCK = 16


def windows(data: bytes, length: int = LENGTH, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text (zero-padded, one at least) and the bytes in each."""
    step = length - overlap
    n = 1 if len(data) <= length else 1 + -(-(len(data) - length) // step)
    padded = np.zeros((n - 1) * step + length, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    view = np.lib.stride_tricks.as_strided(padded, (n, length), (step, 1))
    sizes = np.full(n, length, np.float32)
    sizes[-1] = max(1, len(data) - (n - 1) * step)
    return view, sizes


@dataclass
class ByteConv:
    classes: int
    embedding: np.ndarray = None
    filters: dict = field(default_factory=dict)
    biases: dict = field(default_factory=dict)
    output: np.ndarray = None
    offset: np.ndarray = None
    _table: np.ndarray = None

    @classmethod
    def start(cls, classes: int, seed: int = 7) -> ByteConv:
        r = np.random.default_rng(seed)
        net = cls(classes)
        net.embedding = r.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        for w in WIDTHS:
            net.filters[w] = r.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)).astype(np.float32)
            net.biases[w] = np.zeros(FILTERS, np.float32)
        net.output = np.zeros((len(WIDTHS) * FILTERS, classes), np.float32)
        net.offset = np.zeros(classes, np.float32)
        return net

    def _parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters.values(), *self.biases.values(), self.output, self.offset]

    def _pool(self, x: np.ndarray):
        """Largest response of each filter per window, and where it was."""
        e = self.embedding[x]
        n, length, size = e.shape
        pooled, places = [], []
        for w in WIDTHS:
            patches = np.lib.stride_tricks.as_strided(
                e, (n, length - w + 1, w * size), (e.strides[0], e.strides[1], e.strides[2]))
            out = np.ascontiguousarray(patches).reshape(-1, w * size) @ self.filters[w]
            out = out.reshape(n, length - w + 1, FILTERS)
            at = out.argmax(1)
            places.append(at)
            pooled.append(np.take_along_axis(out, at[:, None], 1)[:, 0] + self.biases[w])
        return np.concatenate(pooled, 1), places

    def fit(self, texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, updates: int = 500,
            batch: int = 48, rate: float = 4e-3, seed: int = 11) -> ByteConv:
        """Cross-entropy with Adam; a text is (windows, bytes in each).

        The number of updates is fixed, so a small sample is passed more often.
        """
        r = np.random.default_rng(seed)
        params = self._parameters()
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        order = np.empty(0, np.int64)
        for step in range(1, updates + 1):
            while len(order) < batch:
                order = np.concatenate((order, r.permutation(len(texts))))
            rows, order = order[:batch], order[batch:]
            grads = self._gradients([texts[i] for i in rows], labels[rows])
            now = rate * (1 - step / (updates + 1))
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.005 * (g * g - v)
                p -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-7)
        self._table = None
        return self

    def _gradients(self, texts, labels):
        x = np.concatenate([t[0] for t in texts])
        size = np.concatenate([t[1] / t[1].sum() for t in texts]).astype(np.float32)
        owner = np.repeat(np.arange(len(texts)), [len(t[0]) for t in texts])
        pooled, places = self._pool(x)
        hidden = np.maximum(pooled, 0)
        scores = np.zeros((len(texts), self.classes), np.float32)
        np.add.at(scores, owner, (hidden @ self.output) * size[:, None])
        scores += self.offset
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(texts)), labels] -= 1
        p /= len(texts)
        back = p[owner] * size[:, None]
        d_hidden = (back @ self.output.T) * (pooled > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters, d_biases = [], []
        rows = np.arange(len(x))[:, None]
        for k, w in enumerate(WIDTHS):
            d = d_hidden[:, k * FILTERS:(k + 1) * FILTERS]
            letters = x[rows[:, :, None], places[k][:, :, None] + np.arange(w)]  # window, filter, tap
            e = self.embedding[letters].reshape(len(x), FILTERS, -1)
            d_filters.append(np.einsum("nfe,nf->ef", e, d))
            d_biases.append(d.sum(0))
            d_e = (d[:, :, None] * self.filters[w].T[None]).reshape(-1, EMBEDDING)
            np.add.at(d_embedding, letters.reshape(-1), d_e)
        return [d_embedding, *d_filters, *d_biases, hidden.T @ back, p.sum(0)]

    def _pairs(self) -> np.ndarray:
        """For each pair of bytes, its share in every pair of taps of every filter."""
        if self._table is None:
            columns = []
            for w in WIDTHS:
                taps = self.filters[w].reshape(w, EMBEDDING, FILTERS)
                one = np.einsum("be,wef->wbf", self.embedding, taps)
                columns += [(one[k][:, None] + one[k + 1][None]).reshape(65536, FILTERS) for k in range(0, w, 2)]
            self._table = np.concatenate(columns, 1).astype(np.float32)
        return self._table

    def window_scores(self, x: np.ndarray) -> np.ndarray:
        """Scores per class of each window."""
        table, out = self._pairs(), np.empty((len(x), self.classes), np.float32)
        length = x.shape[1]
        for at in range(0, len(x), BLOCK):
            block = x[at:at + BLOCK].astype(np.int32)
            pair = (block[:, :-1] << 8) | block[:, 1:]
            rows = table.take(pair.ravel(), axis=0).reshape(len(block), length - 1, -1)
            pooled, column = [], 0
            for w in WIDTHS:
                n = length - w + 1
                total = rows[:, :n, column:column + FILTERS]
                for k in range(2, w, 2):
                    shift = column + (k // 2) * FILTERS
                    total = total + rows[:, k:k + n, shift:shift + FILTERS]
                pooled.append(total.max(1) + self.biases[w])
                column += (w // 2) * FILTERS
            out[at:at + BLOCK] = np.maximum(np.concatenate(pooled, 1), 0) @ self.output
        return out

    def text_scores(self, texts: list[bytes]) -> np.ndarray:
        """Scores per class of each text, over all its windows."""
        out = np.empty((len(texts), self.classes), np.float64)
        waiting, held = [], 0

        def flush():
            nonlocal waiting, held
            if waiting:
                scores = self.window_scores(np.concatenate([v for _, v, _ in waiting]))
                at = 0
                for i, v, sizes in waiting:
                    own = scores[at:at + len(v)]
                    at += len(v)
                    out[i] = (own * sizes[:, None]).sum(0) / sizes.sum() + self.offset
            waiting, held = [], 0

        for i, data in enumerate(texts):
            v, sizes = windows(data)
            waiting.append((i, v, sizes))
            held += len(v)
            if held >= 40 * BLOCK:
                flush()
        flush()
        return out


def softmax(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)
