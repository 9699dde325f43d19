"""Document fingerprints from improbable features, in chained Bloom filters.

Every window of 64 bytes has an entropy; how seldom that entropy occurs over all documents ranks the window. A window
that has the lowest rank around it often enough is a feature; a text without any has its best window instead. A
feature's hash sets five bits of a Bloom filter; a filter that holds 160 features is closed and the next one is opened. Two fingerprints are compared filter by filter:
the bits they share, beyond what chance gives, in relation to the most they could share.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.llm.text import Piece, mixed, pieces, prefix_hashes, span_hashes

WINDOW = 64
#: A window is a feature if it has the lowest rank in so many of the runs of 64 windows that it is in.
POPULAR = 16
LEVELS = 1000
#: Windows below this level are nearly constant and never a feature.
LEAST_LEVEL = 100
BITS = 2048
HASHES = 5
FEATURES_PER_FILTER = 160
#: Documents that are next to each other by id are brought together in ranges of about so many bytes.
RANGE_BYTES = 8 << 20
_PIECE = 1 << 18

_counts = np.arange(WINDOW + 1, dtype=np.float64)
_TERM = np.round(_counts * np.log2(np.maximum(_counts, 1)) * (1 << 16)).astype(np.int64)
_RISE = np.concatenate([[0], np.diff(_TERM)])
_FULL = int(_TERM[WINDOW])


def levels(data: np.ndarray) -> np.ndarray:
    """Entropy of each window data[i:i + 64], from 0 (one byte only) to 1000 (64 different ones)."""
    n = len(data) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int64)
    before, after = np.ones(len(data), np.uint8), np.ones(len(data), np.uint8)
    for lag in range(1, WINDOW):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    sums = np.empty(n, np.int64)
    sums[0] = _TERM[np.bincount(data[:WINDOW], minlength=256)].sum()
    # The byte that leaves a window occurs after[i] times in it, the one that enters before[i + 64] times in the next.
    np.cumsum(_RISE[before[WINDOW:]] - _RISE[after[: n - 1]], out=sums[1:])
    sums[1:] += sums[0]
    return (_FULL - sums) * LEVELS // _FULL


def _inside(piece: Piece, length: int) -> np.ndarray:
    """Whether the span of this length from a place on stays inside its text, for each place where it stays inside the piece."""
    ok = np.ones(max(0, len(piece.data) - length + 1), bool)
    for end in piece.offsets[1:-1].tolist():
        ok[max(0, end - length + 1) : end] = False
    return ok


def level_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(LEVELS + 1, np.int64)
    for batch in batches:
        for piece in pieces(batch.column("text"), _PIECE):
            if len(piece.data) >= WINDOW:
                counts += np.bincount(levels(piece.data)[_inside(piece, WINDOW)], minlength=LEVELS + 1)
    some = np.flatnonzero(counts)
    yield pa.record_batch({"level": pa.array(some, pa.int32()), "n": pa.array(counts[some], pa.int64())})


def ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each level by how seldom it is over all windows of all documents; the seldomest has 0. Equals by level."""
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(level_counts, "level int, n long")
    counts = np.zeros(LEVELS + 1, np.int64)
    for row in rows.groupBy("level").agg(F.sum("n").alias("n")).collect():  # a row for each level at most
        counts[row.level] = row.n
    out = np.empty(LEVELS + 1, np.int64)
    out[np.lexsort((np.arange(LEVELS + 1), counts))] = np.arange(LEVELS + 1)
    return out


def _features(piece: Piece, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the features of a piece in order, each hash once for a text."""
    data, offsets = piece.data, piece.offsets
    n = len(data) - WINDOW + 1
    prefix = prefix_hashes(data)
    lengths = np.diff(offsets)
    chosen = []
    if n > 0:
        level = levels(data)
        place = rank[level]
        place[level < LEAST_LEVEL] = LEVELS + 1
        key = (place << 32) | np.arange(n)
        best = key
        for step in (1, 2, 4, 8, 16, 32):
            if len(best) > step:
                best = np.minimum(best[:-step], best[step:])
            else:
                best = best[:0]
        run = 2 * WINDOW - 1
        best = best[_inside(piece, run)] if len(data) >= run else best[:0]
        best = best[(best >> 32) <= LEVELS]
        wins = np.bincount(best & 0xFFFFFFFF, minlength=1)
        popular = np.flatnonzero(wins >= POPULAR)
        chosen.append(popular)
        # A text without a feature has its best window, one of less than a window itself. In less than POPULAR runs no
        # window can win often enough, nor where a unit of less than POPULAR bytes is repeated: of equals the first wins.
        without = np.diff(np.searchsorted(popular, offsets)) == 0
        for i in np.flatnonzero((lengths >= WINDOW) & without).tolist():
            a, b = int(offsets[i]), int(offsets[i + 1]) - WINDOW + 1
            top = int(key[a:b].min())
            if top >> 32 > LEVELS and lengths[i] >= run:  # nearly constant throughout
                top = int(((rank[level[a:b]] << 32) | np.arange(a, b)).min())
            chosen.append(np.array([top & 0xFFFFFFFF]))
    starts = np.sort(np.concatenate(chosen)) if chosen else np.zeros(0, np.int64)
    ends = starts + WINDOW
    tiny = np.flatnonzero((lengths > 0) & (lengths < WINDOW))
    starts = np.concatenate([starts, offsets[:-1][tiny]])
    ends = np.concatenate([ends, offsets[1:][tiny]])
    text = np.searchsorted(offsets, starts, side="right") - 1
    hashes = span_hashes(prefix, starts, ends)
    _, first = np.unique(mixed(hashes + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    first = first[np.lexsort((starts[first], text[first]))]
    return text[first], hashes[first]


def filters(texts: pa.Array, rank: np.ndarray) -> list[np.ndarray]:
    """For each text its chain of filters: an array of 32 words of 64 bits for each filter."""
    out = []
    for piece in pieces(texts, _PIECE):
        text, hashes = _features(piece, rank)
        n_texts = len(piece.offsets) - 1
        counts = np.bincount(text, minlength=n_texts)
        chain = -(-counts // FEATURES_PER_FILTER)
        base = np.concatenate([[0], np.cumsum(chain)])
        nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = base[text] + nth // FEATURES_PER_FILTER
        bits = np.zeros((int(base[-1]), BITS), bool)
        for k in range(HASHES):
            bits[at, ((hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits, axis=1).view(np.uint64) if len(bits) else np.zeros((0, BITS // 64), np.uint64)
        out += [packed[a:b] for a, b in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]
    return out


def written(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint64).reshape(-1, BITS // 64)


def _best(a: np.ndarray, b: np.ndarray) -> float:
    """Mean over the filters of a, by their bits, of how well each is matched by the best of b."""
    ones_a, ones_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    total = 0.0
    for words, ones in zip(a, ones_a.tolist(), strict=True):
        shared = np.bitwise_count(b & words).sum(axis=1, dtype=np.int64)
        chance, most = ones * ones_b / BITS, np.minimum(ones, ones_b)
        total += ones * float(np.max(np.where(shared == most, 1.0, (shared - chance) / np.maximum(most - chance, 1e-9))))
    return min(1.0, max(0.0, total / float(ones_a.sum())))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1, the same either way round. Two fingerprints without features are alike, one such is unlike any other."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b):
        return (_best(a, b) + _best(b, a)) / 2
    return _best(a, b) if len(a) < len(b) else _best(b, a)


def fingerprints(docs: DataFrame, rank: np.ndarray | None = None) -> DataFrame:
    """The rows of docs with their ``fingerprint``; rank is that of ``ranks`` over these or other documents."""
    rank = ranks(docs) if rank is None else rank

    @F.pandas_udf("string")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([written(c) for c in filters(pa.array(texts, pa.large_string(), from_pandas=True), rank)], dtype=str)

    return docs.withColumn("fingerprint", fingerprint(F.col("text").cast("string")))


def edited(text: str, following: str) -> str:
    """The last half of the characters (rounded down) replaced by as many of the following text's first, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(rank: np.ndarray):
    """Rows in order of (range, guest, doc_id falling): each own row against the row that follows it in its range."""

    def rows(ids: list, texts: list[str], nexts: list[str], own: list[np.ndarray], following: list[np.ndarray]) -> pa.RecordBatch:
        changed = [edited(a, b) for a, b in zip(texts, nexts, strict=True)]
        chains = filters(pa.array(changed, pa.large_string()), rank)
        columns = [
            ids,
            [len(t) for t in texts],
            [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            [written(c) for c in own],
            [written(c) for c in chains],
            [likeness(a, b) for a, b in zip(own, chains, strict=True)],
            [likeness(a, b) for a, b in zip(own, following, strict=True)],
        ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (range, guest, id, text, chain) of the row before this batch
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                batch = whole.slice(at, 2_000)
                chains = filters(batch.column("text"), rank)
                seen = list(zip(*(batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text")), chains, strict=True))
                if last is not None:
                    seen.insert(0, last)
                pairs = [(a, b) for a, b in zip(seen, seen[1:], strict=False) if not a[1] and a[0] == b[0]]
                if pairs:
                    yield rows([a[2] for a, _ in pairs], [a[3] or "" for a, _ in pairs], [b[3] or "" for _, b in pairs], [a[4] for a, _ in pairs], [b[4] for _, b in pairs])
                last = seen[-1]

    return run


def beside_edited(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document, in falling order of doc_id.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row of
    docs(doc_id, text). After the last document comes the first; a single one follows itself. Rows of one id stand in
    order of the text's hash, a null id comes last. A null text is empty; an empty fingerprint is an empty string. An
    empty table gives no rows. Other columns are not looked at.

    Ids are cut into ranges at quantiles. The first document of each range goes to the range before as a guest, so that
    every range can be worked through alone, row by row: a text is shuffled once.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(min(20_000, max(1, total // RANGE_BYTES)))
    cuts = texts.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10 * parts + 1000)).first()[0] or []
    cuts = np.unique(np.array(cuts if parts > 1 else [], np.int64))

    least = F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long"))  # null stands behind all ids

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series((len(cuts) - np.searchsorted(cuts, ids.to_numpy(), side="left")).astype(np.int32))

    placed = texts.withColumn("range", range_of(least))
    heads = {r["range"]: r["head"] for r in placed.groupBy("range").agg(F.max(least).alias("head")).collect()}  # one for each range
    order = sorted(heads)
    hosts = {heads[r]: order[i - 1] for i, r in enumerate(order)}

    @F.pandas_udf("int")
    def host_of(ids: pd.Series) -> pd.Series:
        return pd.Series([hosts.get(i, -1) for i in ids.tolist()], dtype="int32")

    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("host").alias("range"), F.lit(True).alias("guest"))
    dealt = (
        placed.withColumn("host", host_of(least))
        .select("doc_id", "text", F.explode(F.when(F.col("host") >= 0, F.array(own, guest)).otherwise(F.array(own))).alias("at"))
        .select("doc_id", "text", "at.range", "at.guest")
    )
    return (
        dealt.repartition("range")
        .sortWithinPartitions("range", "guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
        .select("range", "guest", "doc_id", "text")
        .mapInArrow(_compared(ranks(texts)), _COMPARED)
    )
