"""Removal of byte strings that occur more than once, by suffixes sorted a bucket at a time.

A string of ``length`` bytes that starts at two places is removed at both. The suffixes that could be such places are
sorted, and equal beginnings stand together. No task holds more than a block of buckets:

* *Buckets.* The least hash of the 100-byte strings inside a window of ``length`` bytes, the first one if several are
  least, is the window's *anchor*. It depends on the window's bytes alone, so equal windows have equal anchors at
  equal places. Windows in a row with one anchor make a *span*. Spans whose anchor occurs once are done with.
* *Spans that are copies.* Of spans with the same bytes one is sorted for all, and every window in them is repeated:
  a passage that many documents share is one row.
* *Suffixes.* The other spans are dealt out by the bytes that their windows must share (326 of 400), and buckets of one
  span are dropped. A task fills a block with whole buckets and ranks the suffixes at the places of a difference cover
  by doubling. Then it sorts the suffixes of the windows by their first bytes; where those tie, by the place modulo the
  cover's period, then by the ranks at the next cover place. Neighbours in that order are compared byte by byte.
* A bucket of more spans than a task should hold is cut further: each of its windows counts by a 128-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlake.llm.members import marked
from remitlake.llm.text import at_rest, flat, mixed, prefix_hashes, span_hashes
from remitlake.sources.shared import dropped, stored

LENGTH = 400
ANCHOR = 100
#: Classes of windows by where their anchor stands in them; those of one class share LENGTH - CLASS + 1 bytes.
CLASS = 75
#: A perfect difference set: every distance modulo 57 is the difference of two of these.
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
BLOCK_BYTES = 4 << 20
SPANS_PER_BUCKET = 20_000
_CHUNK = 1 << 19
_PLACE_BITS = 20


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of key[i:i + width] for each i, by doubling."""
    best, size = key, 1
    while 2 * size <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    rest = width - size
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best


def anchors(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, place of the anchor, hash of the anchor) of the spans of windows of data."""
    n = len(data) - length + 1
    out = []
    for at in range(0, max(n, 0), _CHUNK):
        part = data[at : min(at + _CHUNK, n) + length - 1]
        prefix = prefix_hashes(part)
        places = np.arange(len(part) - anchor + 1)
        hashes = span_hashes(prefix, places, places + anchor) >> np.uint64(_PLACE_BITS)
        best = _least((hashes << np.uint64(_PLACE_BITS)) | places.astype(np.uint64), length - anchor + 1)
        first = np.flatnonzero(np.insert(np.diff(best) != 0, 0, True))
        last = np.append(first[1:], len(best)) - 1
        best = best[first]
        place = (best & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        out.append((first + at, last + at, place + at, (best >> np.uint64(_PLACE_BITS)).astype(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


_SPANS = pa.schema([(c, pa.int64()) for c in ("row_id", "text_key", "first", "last", "place", "anchor", "d1", "d2", "weight")])


def _spans(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            raw = data.tobytes()
            ids, keys = (batch.column(c).to_numpy() for c in ("row_id", "text_key"))
            held: list[tuple] = []
            rows = 0
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                if b - a < length:
                    continue
                first, last, place, anchor_hash = anchors(data[a:b], length, anchor)
                digests = np.frombuffer(
                    b"".join([hashlib.blake2b(raw[a + x : a + y + length], digest_size=16).digest() for x, y in zip(first.tolist(), last.tolist(), strict=True)]),
                    np.int64,
                ).reshape(-1, 2)
                held.append((i, first, last, place, anchor_hash, digests))
                rows += len(first)
                if rows > 200_000:
                    yield _as_rows(ids, keys, held)
                    held, rows = [], 0
            if held:
                yield _as_rows(ids, keys, held)
            del held, raw, data
            at_rest()

    return run


def _as_rows(ids: np.ndarray, keys: np.ndarray, held: list[tuple]) -> pa.RecordBatch:
    """The spans as rows. Of spans with the same bytes one stands for them all with weight 2, so that no task gets every copy;
    the others go by a number of their own, below 0, as known copies."""
    which = np.repeat([h[0] for h in held], [len(h[1]) for h in held])
    first, last, place, anchor = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3, 4))
    d1, d2 = np.concatenate([h[5] for h in held]).T.copy()
    order = np.lexsort((d2, d1))
    repeat = np.zeros(len(order), bool)
    repeat[order[1:]] = (d1[order][1:] == d1[order][:-1]) & (d2[order][1:] == d2[order][:-1])
    leads = np.zeros(len(order), bool)
    leads[order[:-1]] = repeat[order[1:]]
    alone = mixed(d1.view(np.uint64) ^ mixed(ids[which].view(np.uint64) + np.uint64(1)) ^ mixed(first.astype(np.uint64))).view(np.int64) | np.int64(-(1 << 63))
    anchor, d1 = np.where(repeat, alone, anchor), np.where(repeat, alone, d1)
    columns = [ids[which], keys[which], first, last, place, anchor, d1, d2, 1 + (repeat | leads).astype(np.int64)]
    return pa.record_batch([pa.array(c) for c in columns], schema=_SPANS)


def _block_words(data: np.ndarray, beyond: int) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(beyond + 8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data) + beyond, np.uint64)
    for j in range(8):
        out |= padded[j : j + len(out)] << np.uint64(56 - 8 * j)
    return out


def _by_first_bytes(words: np.ndarray, at: np.ndarray, last: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at these places by PERIOD bytes and then by ``last``, and whether each ties with the one before."""
    keys = [words[at + 8 * j] for j in range(PERIOD // 8)]
    keys.append(words[at + PERIOD // 8 * 8] >> np.uint64(64 - 8 * (PERIOD % 8)))
    keys += last
    order = np.lexsort(keys[::-1])
    tied = np.ones(max(0, len(order) - 1), bool)
    for key in keys:
        tied &= key[order][1:] == key[order][:-1]
    return order, np.insert(tied, 0, False) if len(order) else np.zeros(0, bool)


def _cover_ranks(words: np.ndarray, n: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the cover, for every place its suffix's rank if it is of the cover), by ``depth`` bytes at least."""
    places = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    order, tied = _by_first_bytes(words, places, [])
    rank = np.empty(len(places), np.int64)
    rank[order] = np.cumsum(~tied)
    at = np.zeros(n + 2 * depth, np.int64)  # 0: behind the end
    reach = PERIOD
    while True:
        at[places] = rank
        if reach >= depth:
            return places, at
        pair = rank * (len(places) + 1) + at[places + reach]  # the place further on is of the cover too
        _, rank = np.unique(pair, return_inverse=True)
        rank = rank + 1
        reach *= 2


def repeated_windows(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether the window at each start equals the one at another start.

    Windows that may be equal must start at places that agree modulo PERIOD, so that one cover place decides a tie.
    """
    if len(starts) < 2:
        return np.zeros(len(starts), bool)
    words = _block_words(data, 2 * length)
    _, ranks = _cover_ranks(words, len(data), length)
    residue = np.arange(PERIOD)
    ahead = np.array([min(d for d in range(PERIOD) if (r + d) % PERIOD in COVER) for r in residue])
    # Windows of other places modulo PERIOD may begin alike, as inside a run of one byte, but their ranks are of another
    # place: they must not come between two that are equal.
    place = starts % PERIOD
    order, _ = _by_first_bytes(words, starts, [place.astype(np.uint64), ranks[starts + ahead[place]]])
    a, b = starts[order][:-1], starts[order][1:]
    same = np.ones(len(a), bool)
    for k in [*range(0, length - 7, 8), max(0, length - 8)]:
        same &= words[a + k] == words[b + k]
    out = np.zeros(len(starts), bool)
    out[order[:-1]] |= same
    out[order[1:]] |= same
    return out


_CUTS = "bucket long, row_id long, text_key long, start long, windows long, lead long, settled boolean, bytes binary"
_CUT_NAMES = [c.split()[0] for c in _CUTS.split(", ")]


def _cut(length: int):
    """The windows of each span, by class, as (bucket, ..., bytes); ``lead`` is where the anchor stands in the bytes.

    Of a crowded anchor each window goes alone, its digest in place of its bytes, ``lead`` -1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 6 + [pa.bool_(), pa.binary()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=_CUT_NAMES)

        for batch in batches:
            held, size = [], 0
            for row_id, key, text, spans in zip(*(batch.column(c).to_pylist() for c in ("row_id", "text_key", "text", "spans")), strict=True):
                raw = text.encode()
                for s in spans:
                    place, settled = s["place"], s["copies"] > 1
                    if s["crowded"]:
                        for at in range(s["first"], s["last"] + 1):
                            digest = hashlib.blake2b(raw[at : at + length], digest_size=16).digest()
                            held.append((int.from_bytes(digest[:8], "little", signed=True), row_id, key, at, 1, -1, settled, digest))
                            size += 100
                    else:
                        for j in range((place - s["last"]) // CLASS, (place - s["first"]) // CLASS + 1):
                            nearest = place - CLASS * j
                            a, b = max(s["first"], nearest - CLASS + 1), min(s["last"], nearest)
                            shared = raw[nearest : nearest - CLASS + 1 + length]
                            bucket = int.from_bytes(hashlib.blake2b(shared, digest_size=8, salt=bytes([j])).digest(), "little", signed=True)
                            held.append((bucket, row_id, key, a, b - a + 1, place - a, settled, raw[a : b + length]))
                            size += b - a + length
                    if size > 1 << 24:
                        yield rows(held)
                        held, size = [], 0
            if held:
                yield rows(held)

    return run


def _block_ranges(rows: list[tuple], length: int) -> Iterator[tuple[int, int, int, int]]:
    """(row_id, text_key, first, last) of the repeated windows among the cuts of some buckets."""
    parts, begins, at = [], [], 0
    for row in rows:
        pad = -(at + row[5]) % PERIOD  # anchors stand at multiples of PERIOD
        parts.append(bytes(pad) + row[7])
        begins.append(at + pad)
        at += pad + len(row[7])
    data = np.frombuffer(b"".join(parts), np.uint8)
    counts = np.array([r[4] for r in rows])
    ends = np.cumsum(counts)
    starts = np.repeat(np.array(begins), counts) + np.arange(ends[-1]) - np.repeat(ends - counts, counts)
    found = repeated_windows(data, starts, length)
    for row, end in zip(rows, ends.tolist(), strict=True):
        if not row[6]:
            hits = np.flatnonzero(np.diff(np.concatenate([[0], found[end - row[4] : end].view(np.int8), [0]])))
            for a, b in zip(hits[::2].tolist(), hits[1::2].tolist(), strict=True):
                yield row[1], row[2], row[3] + a, row[3] + b - 1


def _sorted_buckets(length: int):
    """Rows in order of (bucket, bytes): the ranges of windows that are repeated in their bucket."""

    def answer(found: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["row_id", "text_key", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        size, bucket, single = 0, [], None
        for batch in batches:
            found: list[tuple] = []
            for row in zip(*(batch.column(c).to_pylist() for c in _CUT_NAMES), strict=True):
                if row[5] < 0:  # a digest stands beside its equals
                    if single and single[0][7] == row[7]:
                        found += [(r[1], r[2], r[3], r[3]) for r in (row, *([] if single[1] else [single[0]])) if not r[6]]
                        single = (row, True)
                    else:
                        single = (row, False)
                    continue
                if bucket and bucket[0][0] != row[0]:
                    if len(bucket) > 1:
                        block += bucket
                        size += sum(len(r[7]) + PERIOD for r in bucket)
                    bucket = []
                    if size > BLOCK_BYTES:
                        found += _block_ranges(block, length)
                        block, size = [], 0
                bucket.append(row)
            if found:
                yield answer(found)
        if len(bucket) > 1:
            block += bucket
        if block and (found := list(_block_ranges(block, length))):
            yield answer(found)

    return run


_KEPT = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"


def _removed(length: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                batch = whole.slice(at, 1_000)
                sizes, removed, kept = [], [], []
                for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                    raw, merged = text.encode(), []
                    for a, b in sorted((r["first"], r["last"] + length) for r in ranges or ()):
                        if merged and a <= merged[-1]["end"]:
                            merged[-1]["end"] = max(merged[-1]["end"], b)
                        else:
                            merged.append({"start": a, "end": b})
                    bounds = [0, *(x for m in merged for x in (m["start"], m["end"])), len(raw)]
                    sizes.append(len(raw))
                    removed.append(merged)
                    kept.append(b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
                yield pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "removed", "kept"])

    return run


def without_repeats(docs: DataFrame, *, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) for every row of docs(doc_id, text).

    ``removed`` are the maximal runs of bytes (start, end) covered by strings of ``length`` bytes that also start
    elsewhere in any row, the same one included; overlaps count. ``kept`` are the other bytes, which may cut a
    character. A null text is empty; texts shorter than ``length`` keep everything. A repeated row is a copy like any
    other: of rows that are long enough nothing is kept. Null ids are ids. No rows give no rows; columns beside doc_id
    and text are not looked at.
    """
    if length < anchor + 2 * CLASS or length < PERIOD:
        raise ValueError("length must leave room for an anchor and two classes")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumns(
        {"row_id": F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")), "text_key": F.xxhash64("text")}
    )
    spans = texts.select("row_id", "text_key", "text").mapInArrow(_spans(length, anchor), ", ".join(f"{c} long" for c in _SPANS.names))
    alike, around = Window.partitionBy("anchor", "d1", "d2"), Window.partitionBy("anchor")
    met = (
        spans.repartition("anchor")
        .withColumn("copies", F.sum("weight").over(alike))
        .withColumn("owner", F.row_number().over(alike.orderBy("row_id", "first")) == 1)
        .withColumn("variants", F.count_if("owner").over(around))
        .where("copies > 1 or variants > 1")
        .select("row_id", "text_key", "first", "last", "place", "copies", "owner", "variants")
    )
    met = stored(met, "spans")
    open_spans = met.where("owner and variants > 1").select(
        "row_id", "text_key", F.struct("first", "last", "place", "copies", (F.col("variants") > SPANS_PER_BUCKET).alias("crowded")).alias("span")
    )
    open_spans = open_spans.groupBy("row_id", "text_key").agg(F.collect_list("span").alias("spans"))
    found = (
        marked(texts, "text_key", open_spans, "wanted")
        .where("wanted")
        .join(open_spans, ["row_id", "text_key"])
        .select("row_id", "text_key", "text", "spans")
        .mapInArrow(_cut(length), _CUTS)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "bytes")
        .mapInArrow(_sorted_buckets(length), "row_id long, text_key long, first long, last long")
    )
    # Repeated rows of one id and text have the same ranges: they are listed once.
    ranges = met.where("copies > 1").select("row_id", "text_key", "first", "last").unionByName(found).distinct()
    ranges = stored(ranges.groupBy("row_id", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "ranges")
    dropped(met)
    touched = marked(texts, "text_key", ranges, "touched")
    whole = touched.where("not touched").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.array().cast("array<struct<start:long,end:long>>").alias("removed"), F.col("text").cast("binary").alias("kept")
    )
    cut = touched.where("touched").join(ranges, ["row_id", "text_key"], "left").select("doc_id", "text", "ranges").mapInArrow(_removed(length), _KEPT)
    return whole.unionByName(cut)


def summary(kept: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of what ``without_repeats`` gives."""
    return kept.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
