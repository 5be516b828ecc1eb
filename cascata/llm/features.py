"""Hashed character n-gram features of whole texts, and the follow-the-regularised-leader learner on them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from cascata.llm.arrays import byte_lengths, byte_texts, slices

_STEP = np.uint32(0x9E3779B1)
PART_CHARS = 1 << 20


@dataclass(frozen=True)
class Ngrams:
    """Counts of character n-grams hashed to ``1 << bits`` features."""

    orders: tuple[int, ...]
    bits: int = 18
    fold_case: bool = True

    @property
    def size(self) -> int:
        return 1 << self.bits

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature, count) of every feature that occurs, by text and feature.

        A text is taken as standing between line ends, so that its first and last characters
        take part in as many n-grams as the others.
        """
        if self.fold_case:
            texts = [t.lower() for t in texts]
        gap = max(self.orders)
        points = np.frombuffer(("\n" * gap + ("\n" * gap).join(texts) + "\n" * gap).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(t) + gap for t in texts], np.int64)
        owner = np.repeat(np.arange(len(texts), dtype=np.uint64), lengths) << np.uint64(self.bits)
        keys = []
        rolled = np.full(len(points), 0x51ED270B, np.uint32)
        for n in range(1, gap + 1):
            rolled = (rolled[: len(points) - n + 1] ^ points[n - 1 :]) * _STEP
            if n in self.orders:
                # windows that begin in the n-1 characters before a text or in the text itself
                begin = gap - n + 1
                keys.append((rolled >> np.uint32(32 - self.bits))[begin : begin + len(owner)] | owner[: len(rolled) - begin])
        keys = np.concatenate(keys)
        if len(texts) << self.bits < 1 << 32:
            keys = keys.astype(np.uint32)
        keys.sort()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
        kept = keys[first].astype(np.int64)
        return kept >> self.bits, kept & (self.size - 1), np.diff(np.r_[first, len(keys)])


def text_parts(block: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[str]]]:
    """Row ranges of a block and their texts, about a million characters at a time; null counts as empty."""
    texts = block.column(column)
    for a, b in slices(byte_lengths(texts), PART_CHARS, 4096):
        yield a, b, [t.decode("utf-8", "replace") for t in byte_texts(texts.slice(a, b - a))]


def scaled(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Values divided by the length of their text's vector."""
    length = np.sqrt(np.bincount(owner, weights=values * values, minlength=n))
    return values / np.maximum(length, 1e-12)[owner]


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def log_loss(logits: np.ndarray, targets: np.ndarray) -> float:
    return float(-(targets * np.log(np.maximum(softmax(logits), 1e-12))).sum(axis=1).mean())


def train_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    targets: np.ndarray,
    size: int,
    rate: float = 0.5,
    smooth: float = 1.0,
    lasso: float = 0.02,
    ridge: float = 0.02,
    passes: int = 2,
) -> np.ndarray:
    """Multinomial weights (feature, class) learnt row by row from (features, values) with targets that are distributions.

    Per coordinate, the leader under the elastic net is found in closed form from the summed
    gradients; coordinates whose sum stays within ``lasso`` are exactly zero.
    """
    z, n = np.zeros((size, targets.shape[1])), np.zeros((size, targets.shape[1]))

    def leader(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * lasso - zs
        return np.where(np.abs(zs) <= lasso, 0.0, shrunk / ((smooth + np.sqrt(ns)) / rate + ridge))

    rng = np.random.default_rng(3)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            features, values = rows[i]
            zs, ns = z[features], n[features]
            weights = leader(zs, ns)
            gradient = values[:, None] * (softmax(values @ weights) - targets[i])
            grown = ns + gradient * gradient
            z[features] = zs + gradient - (np.sqrt(grown) - np.sqrt(ns)) / rate * weights
            n[features] = grown
    return leader(z, n)


def fit_temperature(logits: np.ndarray, targets: np.ndarray) -> float:
    """The divisor of the logits that gives the least loss on rows the weights were not learnt from."""
    if not len(logits):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(10), 200))
    return float(grid[int(np.argmin([log_loss(logits / t, targets) for t in grid]))])
