"""Benchmark decontamination by greedy string tiling.

Words are runs of letters, their marks, and digits in lower case; a letter of a script without spaces is a word by
itself. A running hash over five words (Karp-Rabin) of every document is
looked up among those of the test items: shared seeds bring a document and an item together. Then tiles are laid:
the longest run of words that both have and neither has used is marked in both, until no run of five words is left.
Tiles may lie in any order, so a passage whose parts were moved is found as well. The share of an item's words that
tiles cover is its coverage. An item of fewer than five words is found where all of its words stand in a row.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.llm.text import Piece, Words, at_rest, pieces, prefix_hashes, span_hashes, mixed
from remitlake.sources.shared import dropped, stored

SEED_WORDS = 5
COVERAGE = 0.75
#: Bits of the map of the items' seeds, for each seed and at most (32 MB); places of a seed in it, all of which must be set.
#: Other seeds pass about once in 65,000, so few documents do without reason. A full map lets more pass, and loses none.
BITS_PER_SEED = 64
PROBES = 4
MOST_BITS = 1 << 28
_ROW_BITS = 1 << 15  # bits in a row of Spark's bitmaps

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: Scripts without spaces between words: Thai, Lao, Myanmar, Khmer, kana, Han, half-width kana, Han beyond 16 bits.
_UNSPACED = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3031, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
    (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
]


#: Filled where it is first needed: a function travels to the tasks by value, its cache must be a plain one.
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """Of each character: 0 for what parts words, 1 for letters, marks and digits, 2 for those that are words alone."""
    if _KINDS:
        return _KINDS[0]
    out = np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)]).astype(np.uint8)
    for first, last in _UNSPACED:
        out[first : last + 1] *= 2
    _KINDS.append(out)
    return out


def _beyond_ascii(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, number of bytes and kind of each character beyond ASCII."""
    at = np.flatnonzero(data >= 0xC0)
    b = np.append(data, np.zeros(3, np.uint8)).astype(np.int32)
    lead, tail = b[at], [b[at + k] & 0x3F for k in (1, 2, 3)]
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    code = np.where(
        size == 2,
        (lead & 0x1F) << 6 | tail[0],
        np.where(size == 3, (lead & 0x0F) << 12 | tail[0] << 6 | tail[1], (lead & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]),
    )
    return at, size, _kinds()[np.minimum(code, 0x10FFFF)]


def _words(piece: Piece) -> Words:
    """Runs of letters, marks and digits; each letter of a script without spaces by itself."""
    n, offsets = len(piece.data), piece.offsets
    ink = np.append(_LETTER[piece.data], False)
    cut = np.zeros(n + 2, bool)  # a word that goes on to this byte ends before it
    at, size, kind = _beyond_ascii(piece.data)
    for k in range(4):
        ink[at[(size > k) & (kind > 0)] + k] = True
    cut[at[kind == 2]] = cut[(at + size)[kind == 2]] = True
    before = np.insert(ink[:-1], 0, False)
    before[offsets] = False
    after = np.append(ink[1:], False)
    after[offsets[offsets > 0] - 1] = False
    starts, ends = np.flatnonzero(ink & ~(before & ~cut[:-1])), np.flatnonzero(ink & ~(after & ~cut[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def _running(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of k words, by its first word."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[j : j + n]
    return mixed(out)


class Tokens(NamedTuple):
    """Hashes of a text's words, and the bytes where each begins and ends in the lower-cased text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def tokens(texts: pa.Array) -> Iterator[Tokens]:
    for piece in pieces(pc.utf8_lower(texts)):
        found = _words(piece)
        hashes = span_hashes(prefix_hashes(piece.data), found.starts, found.ends)
        for i, (a, b) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True)):
            yield Tokens(hashes[a:b], found.starts[a:b] - piece.offsets[i], found.ends[a:b] - piece.offsets[i])


def _free(used: np.ndarray, least: int, n: int) -> np.ndarray:
    """For each of the first n places whether the ``least`` words from there on are unused."""
    sums = np.concatenate([[0], np.cumsum(used)])
    return sums[least : least + n] == sums[:n]


def _longest_runs(at: np.ndarray, places: np.ndarray, seeds: np.ndarray, free: np.ndarray, free_item: np.ndarray) -> tuple[int, list[tuple[int, int]]]:
    """The most seeds in a row that are equal and free in both, and where such rows begin: (place in item, place in doc).

    ``places`` of the document, whose seeds are ``at``, are worked through for one place of the item after the other, from
    its end: a row is one longer than that of the next place of both. Time and memory follow the document, also where
    words repeat in both.
    """
    follows = np.append(np.diff(places) == 1, False)
    most, starts = 0, []
    runs = np.zeros(len(places) + 1, np.int32)
    for j in range(len(seeds) - 1, -1, -1):
        if not free_item[j]:
            runs[:] = 0
            continue
        more = np.where(follows, runs[1:], 0) + 1
        runs[:-1] = np.where((at == seeds[j]) & free, more, 0)
        top = int(runs.max())
        if top > most:
            most, starts = top, []
        if top and top == most:
            starts.append((j, places[np.flatnonzero(runs[:-1] == top)]))
    return most, [(j, int(i)) for j, found in reversed(starts) for i in found]


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: (place in doc, place in item, words), longest first.

    Runs of equal length go by their place in the item, then in the document.
    """
    if len(item) < least or len(doc) < least:
        return []
    seeds, at = _running(item, least), _running(doc, least)
    places = np.flatnonzero(np.isin(at, seeds))
    at = at[places]
    used_doc, used_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    out: list[tuple[int, int, int]] = []
    while len(places):
        free = _free(used_doc, least, len(doc) - least + 1)[places]
        places, at, free = places[free], at[free], free[free]
        most, starts = _longest_runs(at, places, seeds, free, _free(used_item, least, len(seeds)))
        if not most:
            break
        n = most + least - 1
        for j, i in starts:
            if not used_item[j : j + n].any() and not used_doc[i : i + n].any():
                used_doc[i : i + n] = used_item[j : j + n] = True
                out.append((i, j, n))
    return out


def _with_seeds(least: int):
    """Of each item its distinct seeds: (item_key, seed, times in the item, words of the item and of a seed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("item_key").to_pylist()
            for row, item in enumerate(tokens(batch.column("text"))):
                n = len(item.hashes)
                k = min(least, n)
                if n:
                    seeds, times = np.unique(_running(item.hashes, k), return_counts=True)
                    columns = [np.full(len(seeds), keys[row]), seeds.view(np.int64), times, np.full(len(seeds), n), np.full(len(seeds), k)]
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["item_key", "seed", "times", "words", "seed_words"])
        at_rest()

    return run


def _slots(seed: Column, bits: int) -> Column:
    first, step = seed.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(seed, 32).bitwiseAND(F.lit(bits - 1)).bitwiseOR(F.lit(1))
    return F.array(*((first + n * step).bitwiseAND(F.lit(bits - 1)) + 1 for n in range(PROBES)))  # bitmaps of Spark count from 1


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """PROBES bits for each seed, in bytes. The size follows the seeds up to MOST_BITS."""
    bits = _ROW_BITS
    wanted = min(MOST_BITS, BITS_PER_SEED * seeds.count())
    while bits < wanted:
        bits *= 2
    slots = seeds.select(F.explode(_slots(F.col("seed"), bits)).alias("slot"))
    rows = slots.groupBy(F.bitmap_bucket_number("slot").alias("number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for number, row in rows.collect():  # at most MOST_BITS in all
        at = (number - 1) * (_ROW_BITS // 8)
        out[at : at + len(row)] = np.frombuffer(bytes(row), np.uint8)
    return out


def _candidates(bitmap: np.ndarray, lengths: list[int]):
    """The documents with seeds that may be those of items, and these seeds."""
    mask = np.uint64(8 * len(bitmap) - 1)

    def possible(hashes: np.ndarray) -> np.ndarray:
        kept = []
        for k in lengths:
            seeds = _running(hashes, k)
            first, step = seeds & mask, (seeds >> np.uint64(32)) & mask | np.uint64(1)
            for n in range(PROBES):
                slots = ((first + np.uint64(n) * step) & mask).astype(np.int64)
                there = bitmap[slots >> 3] >> (slots & 7).astype(np.uint8) & 1 == 1
                seeds, first, step = seeds[there], first[there], step[there]
            kept.append(seeds)
        return np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [possible(doc.hashes) for doc in tokens(batch.column("text"))]
            rows = [i for i, seeds in enumerate(found) if len(seeds)]
            if rows:
                part = batch.take(pa.array(rows, pa.int64()))
                ends = np.cumsum([0, *(len(found[i]) for i in rows)])
                seeds = pa.array(np.concatenate([found[i] for i in rows]).view(np.int64), pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), seeds)
                yield pa.record_batch([*part.columns, lists], names=[*part.schema.names, "seeds"])
        at_rest()

    return run


_FOUND = "doc_id long, item_id long, item_words int, covered_words int, coverage double, tiles array<struct<start:long,end:long,words:int>>, text_key long"


def _tiled(least: int, coverage: float):
    tile = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int32())]))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), tile, pa.int64()]
    names = ["doc_id", "item_id", "item_words", "covered_words", "coverage", "tiles", "text_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, doc = None, None
        for batch in batches:
            out = []
            ids, items, keys = (batch.column(c).to_pylist() for c in ("doc_id", "item_id", "text_key"))
            for row, item in enumerate(tokens(batch.column("item_text"))):
                if (ids[row], keys[row]) != last:  # rows of one document follow each other after the join
                    last, (doc,) = (ids[row], keys[row]), tokens(batch.column("text").slice(row, 1))
                laid = tiles(doc.hashes, item.hashes, min(least, len(item.hashes)))
                covered = sum(n for _, _, n in laid)
                if covered >= coverage * len(item.hashes):
                    spans = [{"start": int(doc.starts[i]), "end": int(doc.ends[i + n - 1]), "words": n} for i, _, n in sorted(laid)]
                    out.append((ids[row], items[row], len(item.hashes), covered, covered / len(item.hashes), spans, keys[row]))
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
        at_rest()

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, *, least: int = SEED_WORDS, coverage: float = COVERAGE, keyed: bool = False) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, coverage, tiles) for each document and item it covers well enough.

    ``tiles`` are the bytes of the lower-cased text that a tile begins and ends at, in order. Null and empty texts and
    items without words meet nothing; an item of fewer than ``least`` words has to stand in the document whole. Repeated
    rows of docs give repeated rows; repeated items count once. Either table may be empty. Other columns are not looked
    at. With ``keyed`` a column ``text_key``, xxhash64 of the text, tells texts of one id apart.

    Both tables may be of any size. Documents are read once; those that have a seed that a bitmap of the items' seeds
    lets pass are stored, and their seeds meet the items' in a join. A tile of n words has n - least + 1 seeds, a share of
    1 / least of its words or more, so a document that has fewer of an item's seeds than that cannot cover it.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    items = items.withColumn("item_key", F.xxhash64("item_id", "text"))
    seeds = stored(items.mapInArrow(_with_seeds(least), "item_key long, seed long, times long, words long, seed_words long"), "seeds")
    lengths = sorted(r.seed_words for r in seeds.select("seed_words").distinct().collect())  # ``least`` numbers at most
    near = texts.mapInArrow(_candidates(_bitmap(seeds), lengths), "doc_id long, text string, text_key long, seeds array<long>")
    near = stored(near, "candidates")
    met = (
        near.select("doc_id", "text_key", F.explode("seeds").alias("seed"))
        .distinct()  # of repeated rows
        .join(seeds, "seed")
        .groupBy("doc_id", "text_key", "item_key")
        .agg(F.sum("times").alias("times"), F.first("words").alias("words"), F.first("seed_words").alias("seed_words"))
        .where(F.col("times") * F.col("seed_words") >= F.lit(coverage) * F.col("words"))
    )
    pairs = met.join(items.select("item_key", "item_id", F.col("text").alias("item_text")), "item_key").select(
        F.col("doc_id").alias("met_id"), F.col("text_key").alias("met_key"), "item_id", "item_text"
    )
    same = (F.col("text_key") == F.col("met_key")) & F.col("doc_id").eqNullSafe(F.col("met_id"))
    found = near.drop("seeds").join(pairs, same).select("doc_id", "text_key", "text", "item_id", "item_text").mapInArrow(_tiled(least, coverage), _FOUND)
    found = stored(found, "tiles")
    dropped(seeds, near)
    return found if keyed else found.drop("text_key")
