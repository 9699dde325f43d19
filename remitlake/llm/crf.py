"""Linear-chain conditional random fields over many sequences at a time.

Sequences lie one after the other in flat arrays; ``offsets`` (n + 1 numbers) says where each begins. The steps of
the forward and backward passes run over all sequences that are still long enough, so a step is one small product.

Training takes sequences in blocks. Spark adds up the slopes of all blocks for each step, so of the training rows
nothing but these sums, whose size is that of the weights, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A block has about so many places; so many tasks add up the slopes of their blocks in each step.
BLOCK_PLACES = 100_000
TASKS = 4


class Chain(NamedTuple):
    """Weights of the features (features x labels), of label pairs (labels x labels) and of the first label."""

    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray


class Pass(NamedTuple):
    marginals: np.ndarray
    log_z: np.ndarray
    pairs: np.ndarray


def forward_backward(scores: np.ndarray, offsets: np.ndarray, transitions: np.ndarray, start: np.ndarray, *, pairs: bool = False) -> Pass:
    """Marginal of each label at each place, log of the partition sum of each sequence, expected label pairs in all.

    Every step is scaled to sum to one, so no length under- or overflows.
    """
    offsets = np.asarray(offsets, np.int64)
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = offsets[:-1][order], lengths[order]
    live = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")  # sequences that have a place t
    top = scores.max(axis=1, keepdims=True) if len(scores) else scores
    local = np.exp(scores - top)
    step = np.exp(transitions).astype(local.dtype)
    alpha, beta = np.empty_like(local), np.ones_like(local)
    scale = np.ones(len(local), np.float64)
    now = None
    for t, n in enumerate(live.tolist()):
        at = begins[:n] + t
        now = local[at] * (np.exp(start).astype(local.dtype) if t == 0 else now[:n] @ step)
        total = now.sum(axis=1, keepdims=True)
        now = now / total
        alpha[at] = now
        scale[at] = total[:, 0]
    expected = np.zeros_like(step, np.float64)
    now = None
    for t in range(len(live) - 2, -1, -1):
        n = int(live[t + 1])
        at = begins[:n] + t
        ahead = local[at + 1] * beta[at + 1]
        if pairs:
            weight = ahead / scale[at + 1][:, None]
            expected += (alpha[at].T @ weight) * step
        now = ahead @ step.T
        beta[at] = now / now.sum(axis=1, keepdims=True) if not pairs else now / scale[at + 1][:, None]
    marginals = alpha * beta
    marginals /= marginals.sum(axis=1, keepdims=True) if len(marginals) else 1
    logs = np.log(scale) + (top[:, 0] if len(top) else 0)
    sums = np.concatenate([[0.0], np.cumsum(logs, dtype=np.float64)])
    return Pass(marginals, sums[offsets[1:]] - sums[offsets[:-1]], expected)


def summed_rows(weights: np.ndarray, features: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each place the sum of the weights of its features; place i has features[places[i]:places[i + 1]], one at least."""
    return np.add.reduceat(weights[features], places[:-1], axis=0) if len(places) > 1 else np.zeros((0, weights.shape[1]))


class Block(NamedTuple):
    """Sequences with their labels: place i is word words[i], word w has the features features[places[w]:places[w + 1]]."""

    features: np.ndarray
    places: np.ndarray
    words: np.ndarray
    offsets: np.ndarray
    labels: np.ndarray


#: Columns of blocks as rows: the arrays' bytes, as 32-bit whole numbers.
BLOCK = ", ".join(f"{name} binary" for name in Block._fields)


def block_row(block: Block) -> pa.RecordBatch:
    return pa.record_batch({n: pa.array([np.asarray(x, np.int32).tobytes()], pa.binary()) for n, x in zip(Block._fields, block, strict=True)})


def slopes(block: Block, chain: Chain) -> list[np.ndarray]:
    """How the log likelihood of the labels grows with each weight."""
    features, places, words, offsets, labels = block
    n_features, n_labels = chain.weights.shape
    n_words, first = len(places) - 1, offsets[:-1][np.diff(offsets) > 0]
    owner = np.repeat(np.arange(n_words), np.diff(places))
    gold = np.zeros((len(labels), n_labels))
    gold[np.arange(len(labels)), labels] = 1
    inside = np.ones(len(labels), bool)
    inside[first] = False
    follow = np.flatnonzero(inside)
    gold_pairs = np.zeros((n_labels, n_labels))
    np.add.at(gold_pairs, (labels[follow - 1], labels[follow]), 1)
    found = forward_backward(summed_rows(chain.weights, features, places)[words], offsets, chain.transitions, chain.start, pairs=True)
    off = gold - found.marginals
    by_word = np.stack([np.bincount(words, off[:, j], n_words) for j in range(n_labels)], axis=1)
    by_feature = np.stack([np.bincount(features, by_word[owner, j], n_features) for j in range(n_labels)], axis=1)
    return [by_feature, gold_pairs - found.pairs, off[first].sum(axis=0)]


def _climbed(all_slopes: Callable[[Chain], list[np.ndarray]], n_features: int, n_labels: int, l2: float, steps: int, rate: float) -> Chain:
    """Weights of greatest penalised likelihood, by Adam over all sequences at once."""
    chain = Chain(np.zeros((n_features, n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in chain]
    for step in range(1, steps + 1):
        for p, slope, (m, v) in zip(chain, all_slopes(chain), moments, strict=True):
            g = slope - l2 * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return chain


def train(
    features: np.ndarray,
    places: np.ndarray,
    words: np.ndarray,
    offsets: np.ndarray,
    labels: np.ndarray,
    n_features: int,
    n_labels: int,
    *,
    l2: float = 1.0,
    steps: int = 60,
    rate: float = 0.25,
) -> Chain:
    """A chain from the sequences of one block."""
    block = Block(features, places, words, offsets, labels)
    return _climbed(lambda chain: slopes(block, chain), n_features, n_labels, l2, steps, rate)


def _added(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                part = slopes(Block(*(np.frombuffer(x, np.int32) for x in row)), chain)
                total = part if total is None else [a + b for a, b in zip(total, part, strict=True)]
        if total is not None:
            flat = np.concatenate([x.ravel() for x in total]).astype(np.float32)
            yield pa.record_batch({"slopes": pa.array([flat.tobytes()], pa.binary())})

    return run


def train_on(blocks: DataFrame, n_features: int, n_labels: int, *, l2: float = 1.0, steps: int = 60, rate: float = 0.25) -> Chain:
    """A chain from all rows of blocks, which should be stored: each step reads them. A step is a sum over TASKS tasks."""
    blocks = blocks.select(*Block._fields).coalesce(TASKS)

    def all_slopes(chain: Chain) -> list[np.ndarray]:
        small = Chain(*(x.astype(np.float32) for x in chain))
        rows = blocks.mapInArrow(_added(small), "slopes binary").collect()  # TASKS rows of the size of the weights
        total = np.sum([np.frombuffer(r.slopes, np.float32).astype(np.float64) for r in rows], axis=0)
        ends = np.cumsum([x.size for x in chain])[:-1]
        return [part.reshape(x.shape) for part, x in zip(np.split(total, ends), chain, strict=True)]

    return _climbed(all_slopes, n_features, n_labels, l2, steps, rate)
