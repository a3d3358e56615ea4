"""A byte-level convolutional network in numpy.

Learned filters of ``width`` bytes slide over overlapping chunks that cover
the whole text; each is max-pooled per chunk (after a ReLU), and the mean
and the maximum over all chunks of these values go through one logistic unit
to one probability.  A filter is a table of one weight per place and byte, so
a convolution is a sum of table rows; at scoring, the tables of two
neighbouring places are joined into one over byte pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class NetParams:
    filters: int = 32
    width: int = 8
    stride: int = 2
    chunk: int = 512              # bytes
    overlap: int = 64
    epochs: int = 8
    batch: int = 32               # texts
    chunks_per_text: int = 8      # drawn anew from the whole text in every epoch
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 5


def chunks(text: bytes, p: NetParams) -> np.ndarray:
    """Overlapping chunks that cover ``text``, padded with zero bytes."""
    step = p.chunk - p.overlap
    n = max(1, -(-(len(text) - p.overlap) // step))
    padded = np.zeros(step * (n - 1) + p.chunk, np.uint8)
    padded[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, p.chunk)[::step]


class Net:
    def __init__(self, p: NetParams):
        rng = np.random.Generator(np.random.PCG64(p.seed))
        self.p = p
        self.w = {"tables": rng.normal(0, 0.3, (p.width, 256, p.filters)).astype(np.float32),
                  "bias": np.zeros(p.filters, np.float32),
                  "mean": rng.normal(0, 0.1, p.filters).astype(np.float32),
                  "max": rng.normal(0, 0.1, p.filters).astype(np.float32),
                  "out": np.zeros(1, np.float32)}
        self.pairs: np.ndarray | None = None

    @property
    def places(self) -> int:
        return (self.p.chunk - self.p.width) // self.p.stride + 1

    def _convolve(self, x: np.ndarray) -> np.ndarray:
        """(chunks, places, filters) before bias, from byte pairs."""
        end = self.places * self.p.stride
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        z = self.pairs[0][pair[:, 0:end:self.p.stride]]
        for k in range(1, len(self.pairs)):
            z += self.pairs[k][pair[:, 2 * k:2 * k + end:self.p.stride]]
        return z

    def join_pairs(self) -> None:
        t = self.w["tables"]
        self.pairs = np.stack([(t[k][:, None] + t[k + 1][None]).reshape(65536, -1)
                               for k in range(0, self.p.width, 2)])

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Max-pooled, rectified filters of each chunk."""
        top = np.concatenate([self._convolve(x[i:i + 16]).max(axis=1) for i in range(0, len(x), 16)])
        return np.maximum(top + self.w["bias"], 0)

    def _combine(self, pools: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts = np.diff(np.append(starts, len(pools)))
        mean = np.add.reduceat(pools, starts, axis=0) / counts[:, None]
        most = np.maximum.reduceat(pools, starts, axis=0)
        z = mean @ self.w["mean"] + most @ self.w["max"] + self.w["out"]
        return mean, most, 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of each whole text."""
        if not texts:
            return np.empty(0)
        if self.pairs is None:
            self.join_pairs()
        parts = [chunks(t, self.p) for t in texts]
        starts = np.concatenate([[0], np.cumsum([len(c) for c in parts])[:-1]])
        pools = np.concatenate([self.pooled(c) for c in parts]) if len(parts) == 1 else \
            self.pooled(np.concatenate(parts))
        return self._combine(pools, starts)[2].astype(float)

    def train(self, parts: list[np.ndarray], labels: np.ndarray) -> "Net":
        """Adam on the log loss of texts given as chunks; classes are weighted
        evenly up to a factor of 4."""
        p = self.p
        rng = np.random.Generator(np.random.PCG64(p.seed + 1))
        share = min(max(float(labels.mean()), 0.2), 0.8)
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step, steps = 0, p.epochs * -(-len(parts) // p.batch)
        for _ in range(p.epochs):
            order = rng.permutation(len(parts))
            for at in range(0, len(order), p.batch):
                rows = order[at:at + p.batch]
                drawn = [c if len(c) <= p.chunks_per_text
                         else c[np.sort(rng.choice(len(c), p.chunks_per_text, replace=False))]
                         for c in (parts[r] for r in rows)]
                grads = self._gradients(drawn, labels[rows], weight[rows])
                step += 1
                rate = p.rate * (1 - (step - 1) / steps)
                for k, g in grads.items():
                    g += p.decay * self.w[k]
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    self.w[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        self.join_pairs()
        return self

    def _gradients(self, drawn: list[np.ndarray], labels: np.ndarray, weight: np.ndarray):
        p = self.p
        x = np.concatenate(drawn)
        counts = np.array([len(c) for c in drawn])
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        end = self.places * p.stride
        z = self.w["tables"][0][x[:, 0:end:p.stride]]
        for j in range(1, p.width):
            z += self.w["tables"][j][x[:, j:j + end:p.stride]]
        best = z.argmax(axis=1)                                     # (chunks, filters)
        top = np.take_along_axis(z, best[:, None], axis=1)[:, 0] + self.w["bias"]
        pools = np.maximum(top, 0)
        mean, most, prob = self._combine(pools, starts)
        d = ((prob - labels) * weight / len(labels)).astype(np.float32)
        grads = {"mean": mean.T @ d, "max": most.T @ d, "out": np.array([d.sum()], np.float32)}
        text = np.repeat(np.arange(len(counts)), counts)
        share = (d / counts)[text][:, None] * self.w["mean"]
        is_most = pools == most[text]
        ties = np.maximum(np.add.reduceat(is_most, starts, axis=0, dtype=np.float32), 1)
        g = (share + is_most / ties[text] * d[text][:, None] * self.w["max"]) * (top > 0)
        grads["bias"] = g.sum(axis=0)
        tables = np.zeros_like(self.w["tables"])
        filters = np.broadcast_to(np.arange(p.filters), best.shape)
        chunk = np.arange(len(x))[:, None]
        for j in range(p.width):
            np.add.at(tables[j], (x[chunk, best * p.stride + j], filters), g)
        grads["tables"] = tables
        return grads
