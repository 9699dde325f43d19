"""Document quality by a linear-chain conditional random field over lines.

Every line is described by shares of characters and words that are counted in it; values are cut into bins at the
quantiles of the training lines, and a line has the bins of its own values, of the line before and of the line after.
The field labels lines good or bad. In training a line has the label of its document, so what it learns of neighbours
is that lines of a document go together. A document's score is the mean of its lines' forward-backward marginals for
good, weighted by length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.llm import crf
from remitlake.llm.labelled import fold, labelled_sample
from remitlake.llm.text import Piece, at_rest, lowered, mixed, pieces, word_hashes, words
from remitlake.sources.shared import dropped, stored

FOLDS, HELD_OUT = 3, 1
#: Labelled documents to train on, at most (about). All their lines are read, in sequences of so many.
FIT_DOCUMENTS = 8_000
SEQUENCE_LINES = 256
THRESHOLD = 0.5
#: Where the training lines' values are cut into bins.
QUANTILES = (0.01, 0.03, 0.08, 0.2, 0.4, 0.6, 0.8, 0.9, 0.94, 0.97, 0.99)
BINS = len(QUANTILES) + 1

MEASURES = (
    "log_bytes", "mean_word", "capitals", "digits", "stops", "marks", "repeated_marks", "capitalised", "distinct", "adjacent", "again", "shouted",
)

_KIND = np.zeros(256, np.uint8)  # 0: anything else
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[44, 46]] = 3
_KIND[[*range(33, 44), 45, 47, *range(58, 65), *range(91, 97), *range(123, 127)]] = 4


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between bounds[i] and bounds[i + 1]."""
    running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return running[bounds[1:]] - running[bounds[:-1]]


def line_measures(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(measures: lines x len(MEASURES), bytes of each line, offsets of the texts' lines). An empty text has one empty line."""
    data, offsets = piece.data, piece.offsets
    breaks = np.flatnonzero(data == 10)
    text_of_break = np.searchsorted(offsets, breaks, side="right") - 1
    begins = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    # A text's lines: one more than its breaks. A break at the very end leaves an empty line there.
    per_text = np.bincount(text_of_break, minlength=len(offsets) - 1) + 1
    lines = np.concatenate([[0], np.cumsum(per_text)])
    bounds = np.append(begins, len(data))
    size = np.diff(bounds)
    kind = _KIND[data]
    n_bytes = np.maximum(size, 1)
    capitals, digits, stops, marks = (_sums(kind == k, bounds) for k in (1, 2, 3, 4))
    twice = np.zeros(len(data), bool)
    twice[1:] = (kind[1:] == 4) & (kind[:-1] == 4)

    small = piece._replace(data=lowered(data))
    found = words(small)
    hashes = word_hashes(small, found)
    of_line = np.searchsorted(bounds, found.starts, side="right") - 1
    # Lines end in white space, so no word spans two of them; empty lines share a bound and own no word.
    n_words = np.bincount(of_line, minlength=len(size))
    some = np.maximum(n_words, 1)
    capitalised = np.bincount(of_line[kind[found.starts] == 1], minlength=len(size)) if len(of_line) else n_words * 0
    letters = found.ends - found.starts
    shout = (kind[found.starts] == 1) & (kind[np.minimum(found.starts + 1, len(data) - 1)] == 1) if len(of_line) else np.zeros(0, bool)
    if len(hashes):
        order = np.argsort((of_line.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
        line, word = of_line[order], hashes[order]
        fresh = np.insert((np.diff(line) != 0) | (np.diff(word) != 0), 0, True)
        distinct = np.bincount(line[fresh], minlength=len(size))
        next_same = np.zeros(len(hashes), bool)
        next_same[1:] = (hashes[1:] == hashes[:-1]) & (of_line[1:] == of_line[:-1])
        adjacent = np.bincount(of_line[next_same], minlength=len(size))
    else:
        distinct = adjacent = np.zeros(len(size), np.int64)
    # The same words in the same order as another line of the text (lines without words apart).
    place = np.arange(len(hashes), dtype=np.uint64)
    first_word = np.searchsorted(found.starts, bounds[:-1])
    by_place = mixed(hashes + (place - first_word[of_line].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)) if len(hashes) else hashes
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(by_place, dtype=np.uint64)])
    last_word = np.searchsorted(found.starts, bounds[1:])
    print_of = total[last_word] - total[first_word]
    text_of_line = np.repeat(np.arange(len(per_text)), per_text)
    pair = mixed(print_of + text_of_line.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, which, times = np.unique(pair, return_inverse=True, return_counts=True)
    again = (times[which] > 1) & (n_words > 0)
    measures = np.column_stack([
        np.log1p(size), _sums_of(letters, of_line, len(size)) / some, capitals / n_bytes, digits / n_bytes, stops / n_bytes, marks / n_bytes,
        _sums(twice, bounds) / n_bytes, capitalised / some, distinct / some, adjacent / some, again.astype(float),
        np.bincount(of_line[shout], minlength=len(size)) / some if len(of_line) else n_words * 0.0,
    ]).astype(np.float32)
    return measures, size, lines


def _sums_of(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(groups, values, n) if len(groups) else np.zeros(n)


class Model(NamedTuple):
    """Where each measure is cut into bins, and the field over them."""

    edges: tuple[np.ndarray, ...]
    chain: crf.Chain


def _bins(measures: np.ndarray, edges: tuple[np.ndarray, ...]) -> np.ndarray:
    """Numbers of the features of each line by its own measures."""
    return np.column_stack([np.searchsorted(e, measures[:, j], side="right") + j * BINS for j, e in enumerate(edges)])


def _with_neighbours(own: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Own bins, those of the line before and after; at the ends of a text a feature that says so."""
    width = own.shape[1] * BINS
    before, after = np.empty_like(own), np.empty_like(own)
    before[1:], after[:-1] = own[:-1] + width, own[1:] + 2 * width
    full = lines[:-1][np.diff(lines) > 0]
    before[full] = 3 * width
    after[lines[1:][np.diff(lines) > 0] - 1] = 3 * width + 1
    return np.hstack([own, before, after])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Measures of all lines of each text, SEQUENCE_LINES in a row with the line before and after where there is one."""
    for batch in batches:
        labels = batch.column("label").to_pylist()
        for piece in pieces(batch.column("text")):
            measures, _, lines = line_measures(piece)
            out = []
            for i, (a, b) in enumerate(zip(lines[:-1].tolist(), lines[1:].tolist(), strict=True)):
                for at in range(a, b, SEQUENCE_LINES):
                    end = min(b, at + SEQUENCE_LINES)
                    before, after = int(at > a), int(end < b)
                    out.append((int(labels[piece.first + i] != 0), before, after, measures[at - before : end + after].tobytes()))
            columns = zip(("label", "before", "after"), list(zip(*out, strict=True))[:3], strict=True)
            yield pa.record_batch({n: pa.array(x, pa.int32()) for n, x in columns} | {"lines": pa.array([x[3] for x in out], pa.binary())})


def _parts(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.float32).reshape(-1, len(MEASURES)) for x in batch.column("lines").to_pylist()]


def _inside(batch: pa.RecordBatch, parts: list[np.ndarray]) -> np.ndarray:
    """Of all lines of the batch those that belong to their sequence, not to its neighbours."""
    ends = np.cumsum([0, *map(len, parts)])
    out = np.ones(ends[-1], bool)
    out[ends[:-1][batch.column("before").to_numpy() > 0]] = False
    out[ends[1:][batch.column("after").to_numpy() > 0] - 1] = False
    return out


def _valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many lines have each value, rounded to 16 bits: (measure, value, n)."""
    counts = np.zeros((len(MEASURES), 1 << 16), np.int64)
    for batch in batches:
        parts = _parts(batch)
        if parts:
            values = np.minimum(np.concatenate(parts)[_inside(batch, parts)], 60_000).astype(np.float16).view(np.uint16)
            for j, row in enumerate(counts):
                row += np.bincount(values[:, j], minlength=1 << 16)
    measure, bits = np.nonzero(counts)
    value = bits.astype(np.uint16).view(np.float16).astype(np.float32)
    yield pa.record_batch({"measure": pa.array(measure, pa.int32()), "value": pa.array(value, pa.float32()), "n": pa.array(counts[measure, bits], pa.int64())})


def _edges(chunks: DataFrame) -> tuple[np.ndarray, ...]:
    """Where each measure is cut: its values at the quantiles. Of each measure 65,536 values at most come to the driver."""
    found = chunks.mapInArrow(_valued, "measure int, value float, n long").groupBy("measure", "value").agg(F.sum("n").alias("n")).toPandas()
    out = []
    for j in range(len(MEASURES)):
        own = found[found["measure"] == j].sort_values("value")
        up_to = own["n"].cumsum().to_numpy()
        out.append(np.unique(own["value"].to_numpy(np.float32)[np.searchsorted(up_to, np.array(QUANTILES) * up_to[-1])]))
    return tuple(out)


def _blocks(edges: tuple[np.ndarray, ...]):
    def block(batch: pa.RecordBatch) -> crf.Block:
        parts = _parts(batch)
        ends = np.cumsum([0, *map(len, parts)])
        inside = _inside(batch, parts)
        features = _with_neighbours(_bins(np.concatenate(parts), edges), ends)[inside]
        offsets = np.concatenate([[0], np.cumsum(inside)])[ends]
        n, width = features.shape
        labels = np.repeat(batch.column("label").to_numpy(), np.diff(offsets))
        return crf.Block(features.ravel(), np.arange(n + 1) * width, np.arange(n), offsets, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = crf.BLOCK_PLACES // SEQUENCE_LINES
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield crf.block_row(block(batch.slice(at, rows)))
        at_rest()

    return run


def fit(known: DataFrame) -> Model | None:
    """A field from known(text, label), label 1 for good; none where only one label occurs.

    Known rows are read whole. What comes to the driver are counts of rounded values and sums of slopes.
    """
    if len(known.select("label").distinct().limit(2).collect()) < 2:
        return None
    chunks = stored(known.mapInArrow(_measured, "label int, before int, after int, lines binary"), "lines")
    edges = _edges(chunks)
    blocks = stored(chunks.mapInArrow(_blocks(edges), crf.BLOCK), "blocks")
    chain = crf.train_on(blocks, 3 * len(MEASURES) * BINS + 2, 2, l2=1.0, steps=60)
    dropped(chunks, blocks)
    return Model(edges, chain)


def line_marginals(piece: Piece, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marginal of good for each line, bytes of each line, offsets of the texts' lines)."""
    measures, size, lines = line_measures(piece)
    features = _with_neighbours(_bins(measures, model.edges), lines)
    scores = model.chain.weights[features].sum(axis=1)
    found = crf.forward_backward(scores, lines, model.chain.transitions, model.chain.start)
    return found.marginals[:, 1], size, lines


def scorer(model: Model | None):
    """A column function: the quality of each text, 0 to 1. Without a model every text has 0.5."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = np.full(len(texts), 0.5)
            if model is not None:
                for piece in pieces(pa.array(texts, pa.large_string(), from_pandas=True)):
                    good, size, lines = line_marginals(piece, model)
                    weight = size + 1.0
                    sums, weights = (np.add.reduceat(v, lines[:-1]) for v in (good * weight, weight))
                    out[piece.first : piece.first + len(sums)] = sums / weights
            yield pd.Series(np.clip(out, 0.0, 1.0))
        at_rest()

    return score


def learned(docs: DataFrame, labels: DataFrame) -> Model | None:
    known = labelled_sample(docs, labels, "quality", folds=FOLDS, held_out=HELD_OUT, most=FIT_DOCUMENTS)
    known = stored(known.select("text", "label").repartition(crf.TASKS, "text").sortWithinPartitions("text", "label"), "sample")
    model = fit(known)
    dropped(known)
    return model


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs(doc_id, text).

    Null and empty texts are one empty line. Repeated rows get the same score. Whole texts are read, however long; a
    line may be as long as its text. Without documents there are no rows; without labels of both kinds every score is
    0.5. Columns beside doc_id and text are not looked at.
    """
    score = scorer(learned(docs, labels))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text").cast("string")).alias("score"))
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
