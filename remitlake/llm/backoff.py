"""Language-model scores of documents by a weighted backoff automaton.

Counts of n-grams over the training documents, smoothed with a prior of ``PRIOR`` words drawn from the next shorter
history: p(w | h) = (c(h w) + PRIOR * p(w | h')) / (c(h) + PRIOR), and (c(w) + 1) / (N + V + 1) without history. As an
automaton: a state for each history that occurs, an arc for each n-gram that occurs, and from each state a failure arc
of weight PRIOR / (c(h) + PRIOR) to its next shorter history. A text is read once from left to right: the state is
carried, failure arcs are followed until the word has an arc, and the weights add up.

No task holds the model. Documents are packed into blocks; a block sends each of its different n-grams once, as a
64-bit hash with its own count, to the range of hashes that adds up all blocks, and gets back the total. Those are all
arcs and states that its texts can meet, so its part of the automaton gives the very weights of the whole one.
Weights are whole billionths of a decimal logarithm, so that sums do not depend on any order.

Memory: a block is a few megabytes of text (or one longer text), a range of hashes the n-grams of as many.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.llm.labelled import fold
from remitlake.llm.text import at_rest, lowered, mixed, pieces, word_hashes, words
from remitlake.sources.shared import stored

FOLDS, HELD_OUT = 7, 2
#: Words of the longest n-gram.
ORDER = 2
#: Words of the prior from the shorter history.
PRIOR = 200.0
#: Text of a block, and of a range of hashes.
BLOCK_BYTES = 8 << 20
#: Tokens that a lane of the traversal reads.
LANE = 256

UNIT = 1e9
_END = np.uint64(0x1F0E3DAD99908345)
_STEP = np.uint64(0x9FB21C651E98DF25)

_BLOCKS = "block long, doc_ids binary, firsts binary, tokens binary, vocabulary binary"
_SENT = "range long, block long, length int, hashes binary, counts binary"
_TOTALS = "range long, block long, length int, totals binary, distinct long, seen long"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base long, score long"


def _packed(array: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed: planes of high bytes are nearly empty."""
    raw = np.ascontiguousarray(array)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T
    return len(raw).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = pa.decompress(data[8:], decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).reshape(n)


def _steps(rising: np.ndarray) -> np.ndarray:
    return np.diff(rising, prepend=rising.dtype.type(0))


# --- blocks ------------------------------------------------------------------------------------------------------


def _tokens(piece) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a piece, an end after each text, and the place of each text's first token (and the end)."""
    piece = piece._replace(data=lowered(piece.data))
    found = words(piece)
    texts = len(piece.offsets) - 1
    firsts = found.first + np.arange(texts + 1)
    tokens = np.full(int(firsts[-1]), _END, np.uint64)
    inside = np.ones(len(tokens), bool)
    inside[firsts[1:] - 1] = False
    tokens[inside] = word_hashes(piece, found)
    return tokens, firsts


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        schema = pa.schema([("block", pa.int64()), *[(n, pa.binary()) for n in ("doc_ids", "firsts", "tokens", "vocabulary")]])

        def block(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            tokens = np.concatenate([h[1] for h in held])
            lengths = np.concatenate([np.diff(h[2]) for h in held])
            vocabulary, ids = np.unique(tokens, return_inverse=True)
            columns = [
                _packed(np.concatenate([h[0] for h in held])), _packed(lengths.astype(np.uint32)), _packed(ids.astype(np.uint32)), _packed(_steps(vocabulary))
            ]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array([c], pa.binary()) for c in columns]], schema=schema)

        held, bytes_held = [], 0
        for batch in batches:
            ids = np.stack([batch.column("doc_id").fill_null(0).to_numpy(), batch.column("kind").to_numpy(zero_copy_only=False).astype(np.int64)], 1)
            for piece in pieces(batch.column("text")):
                held.append((ids[piece.first : piece.first + len(piece.offsets) - 1].ravel(), *_tokens(piece)))
                bytes_held += len(piece.data) + 64 * (len(piece.offsets) - 1)
                if bytes_held >= size:
                    yield block(held)
                    held, bytes_held, number = [], 0, number + 1
        if held:
            yield block(held)
        at_rest()

    return run


class Block(NamedTuple):
    """The texts of a block: ``tokens`` are places in the sorted ``vocabulary``, text i is tokens[firsts[i]:firsts[i + 1]].

    ``kind`` of a text is 0 in training, 1 held out; 2 more where its id is null.
    """

    doc_ids: np.ndarray
    kind: np.ndarray
    firsts: np.ndarray
    tokens: np.ndarray
    vocabulary: np.ndarray


def _block(row: dict) -> Block:
    ids = _unpacked(row["doc_ids"], np.int64).reshape(-1, 2)
    firsts = np.concatenate([[0], np.cumsum(_unpacked(row["firsts"], np.uint32).astype(np.int64))])
    vocabulary = np.cumsum(_unpacked(row["vocabulary"], np.uint64), dtype=np.uint64)
    return Block(ids[:, 0], ids[:, 1], firsts, _unpacked(row["tokens"], np.uint32).astype(np.int64), vocabulary)


class Grams(NamedTuple):
    """The different n-grams of one length: their hashes, one place where each ends, and by place the n-gram that ends there."""

    hashes: np.ndarray
    place: np.ndarray
    at: np.ndarray


def _grams(block: Block, order: int) -> list[Grams]:
    """For each length up to ``order`` the n-grams within the block's texts; -1 where a text has too few tokens so far."""
    n, width = len(block.tokens), len(block.vocabulary)
    lead = np.arange(n) - np.repeat(block.firsts[:-1], np.diff(block.firsts))  # tokens before this one in its text
    first = np.full(width, -1, np.int64)
    first[block.tokens[::-1]] = np.arange(n)[::-1]
    out = [Grams(block.vocabulary, first, block.tokens)]
    for length in range(2, order + 1):
        ends = np.flatnonzero(lead >= length - 1)
        keys = out[-1].at[ends - 1] * width + block.tokens[ends]
        different, where, which = np.unique(keys, return_index=True, return_inverse=True)
        at = np.full(n, -1, np.int64)
        at[ends] = which
        hashes = mixed(out[-1].hashes[different // width] * _STEP + block.vocabulary[different % width] + np.uint64(length))
        out.append(Grams(hashes, ends[where], at))
    return out


def _training_counts(block: Block, grams: Grams) -> np.ndarray:
    """How often each n-gram ends in a training text."""
    taught = np.repeat(block.kind % 2 == 0, np.diff(block.firsts)) & (grams.at >= 0)
    return np.bincount(grams.at[taught], minlength=len(grams.hashes))


# --- counts over all blocks --------------------------------------------------------------------------------------


def _cuts(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of sorted hashes begins, and the end."""
    starts = [-(-(r << 64) // ranges) for r in range(ranges)]
    return np.append(np.searchsorted(hashes, np.array(starts, np.uint64)), len(hashes))


def _sent(order: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["range", "block", "length", "hashes", "counts"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        for batch in batches:
            for row in batch.to_pylist():
                block = _block(row)
                for length, grams in enumerate(_grams(block, order), 1):
                    sort = np.argsort(grams.hashes)
                    hashes, counts = grams.hashes[sort], _training_counts(block, grams)[sort]
                    cuts = _cuts(hashes, ranges)
                    rows = [
                        (r, row["block"], length, _packed(_steps(hashes[a:b])), _packed(counts[a:b].astype(np.uint32)))
                        for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                        if b > a
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        at_rest()

    return run


def _totals(sent: pa.Table) -> pa.Table:
    """Add up one range of hashes: for each block the totals of what it sent, less its own, and one row of statistics."""
    rows = sorted(sent.to_pylist(), key=lambda r: (r["length"], r["block"]))
    out = []
    for length in sorted({r["length"] for r in rows}):
        own = [r for r in rows if r["length"] == length]
        hashes = [np.cumsum(_unpacked(r["hashes"], np.uint64), dtype=np.uint64) for r in own]
        counts = [_unpacked(r["counts"], np.uint32).astype(np.int64) for r in own]
        different, which = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.zeros(len(different), np.int64)
        np.add.at(totals, which, np.concatenate(counts))
        begin = 0
        for r, count in zip(own, counts, strict=True):
            others = totals[which[begin : begin + len(count)]] - count
            out.append((r["range"], r["block"], length, _packed(others.astype(np.uint64)), None, None))
            begin += len(count)
        out.append((own[0]["range"], None, length, None, int((totals > 0).sum()), int(totals.sum())))
    at_rest()
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    names = ["range", "block", "length", "totals", "distinct", "seen"]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


# --- the automaton -----------------------------------------------------------------------------------------------


def _weight(p: np.ndarray) -> np.ndarray:
    return np.rint(np.log10(p) * UNIT).astype(np.int64)


class Automaton(NamedTuple):
    """State 0 is that of no words. Arcs are sorted by ``key``, state * width + word."""

    width: int
    key: np.ndarray
    weight: np.ndarray
    target: np.ndarray
    failure: np.ndarray
    failure_weight: np.ndarray

    def read(self, tokens: np.ndarray, begins: np.ndarray, order: int, lane: int) -> np.ndarray:
        """The weight of each token, read from left to right; ``begins`` marks where a text begins, in the state of no words.

        Lanes of tokens are read side by side. The state depends on the last order - 1 tokens alone, so a lane that
        begins inside a text reads these first and has the very state that the text brings.
        """
        n = len(tokens)
        out = np.zeros(n, np.int64)
        starts = np.arange(0, n, lane)
        state = np.zeros(len(starts), np.int64)
        for step in range(1 - order, lane):
            at = starts + step
            live = np.flatnonzero((at >= 0) & (at < n))
            at = at[live]
            now = np.where(begins[at], 0, state[live])
            word, weight = tokens[at], np.zeros(len(at), np.int64)
            todo = np.arange(len(at))
            while len(todo):
                key = now[todo] * self.width + word[todo]
                arc = np.searchsorted(self.key, key)
                there = self.key[np.minimum(arc, len(self.key) - 1)] == key
                took, arc = todo[there], arc[there]
                weight[took] += self.weight[arc]
                now[took] = self.target[arc]
                todo = todo[~there]
                weight[todo] += self.failure_weight[now[todo]]
                now[todo] = self.failure[now[todo]]
            state[live] = now
            if step >= 0:
                out[at] = weight
        return out


def _automaton(block: Block, grams: list[Grams], counts: list[np.ndarray], seen: int, distinct: int, prior: float) -> Automaton:
    """The arcs and states of the model that the block's texts can meet, from the total counts of its n-grams."""
    width, order = len(block.vocabulary), len(grams)
    end = np.searchsorted(block.vocabulary, _END)
    base = 1 + np.concatenate([[0], np.cumsum([len(g.hashes) for g in grams[:-1]])])  # state of the first n-gram of a length
    failure = np.zeros(int(base[-1]) if order > 1 else 1, np.int64)
    failure_weight = np.zeros(len(failure), np.int64)
    keys, weights, targets, shorter_p = [], [], [], None
    for level, (found, count) in enumerate(zip(grams, counts, strict=True)):
        last = block.tokens[found.place]
        if level:
            history, suffix = grams[level - 1].at[found.place - 1], grams[level - 1].at[found.place]
            p = (count + prior * shorter_p[suffix]) / (counts[level - 1][history] + prior)
            begin = base[level - 1] + history
        else:
            suffix, begin = None, np.zeros(len(count), np.int64)
            p = (count + 1.0) / (seen + distinct + 1.0)
        # A history that ends a text or never occurs in training is not a state; its arcs lead to the next shorter one.
        back = np.zeros(len(count), np.int64)
        if level:
            back = np.where((last != end) & (counts[level - 1][suffix] > 0), base[level - 1] + suffix, 0)
        is_state = (count > 0) & (last != end)
        if level < order - 1:
            target = np.where(is_state, base[level] + np.arange(len(count)), back)
            failure[base[level] : base[level] + len(count)] = back
            failure_weight[base[level] : base[level] + len(count)] = _weight(prior / (count + prior))
        else:
            target = back
        arcs = count > 0 if level else np.ones(len(count), bool)  # every word has an arc from the state of no words
        keys.append((begin * width + last)[arcs])
        weights.append(_weight(p[arcs]))
        targets.append(target[arcs])
        shorter_p = p
    key = np.concatenate(keys)
    sort = np.argsort(key)
    return Automaton(width, key[sort], np.concatenate(weights)[sort], np.concatenate(targets)[sort], failure, failure_weight)


def _scored(order: int, prior: float, seen: int, distinct: int, lane: int):
    def run(own: pa.Table, replies: pa.Table) -> pa.Table:
        block = _block(own.to_pylist()[0])
        grams = _grams(block, order)
        counts = []
        rows = sorted(replies.to_pylist(), key=lambda r: (r["length"], r["range"]))
        for length, found in enumerate(grams, 1):
            count = _training_counts(block, found)
            others = [_unpacked(r["totals"], np.uint64).astype(np.int64) for r in rows if r["length"] == length]
            if others:
                count[np.argsort(found.hashes)] += np.concatenate(others)
            counts.append(count)
        automaton = _automaton(block, grams, counts, seen, distinct, prior)
        begins = np.zeros(len(block.tokens), bool)
        begins[block.firsts[:-1]] = True
        at = block.firsts[:-1]
        base = _weight((counts[0] + 1.0) / (seen + distinct + 1.0))
        sums = [
            np.diff(block.firsts),
            np.add.reduceat((counts[0] > 0)[block.tokens].astype(np.int64), at),
            np.add.reduceat(base[block.tokens], at),
            np.add.reduceat(automaton.read(block.tokens, begins, order, lane), at),
        ]
        at_rest()
        ids = pa.array(block.doc_ids, pa.int64(), mask=block.kind >= 2)
        columns = [ids, pa.array(block.kind % 2 == 1), *[pa.array(s, pa.int64()) for s in sums]]
        return pa.Table.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score"])

    return run


def scores(docs: DataFrame, *, order: int = ORDER, prior: float = PRIOR, block_bytes: int = BLOCK_BYTES, lane: int = LANE) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs(doc_id, text).

    Learned from the rows whose crc32(doc_id as text) mod 7 is not 2 (a null id counts as an empty text, which is in
    training). A null text is an empty one and has only its end; equal rows are rows of their own. Without any training
    rows every token is unknown. An empty table gives no rows; other columns are not looked at.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    held = (fold(doc_id, FOLDS) == HELD_OUT).cast("int")
    rows = docs.select(doc_id.alias("doc_id"), (held + F.when(doc_id.isNull(), 2).otherwise(0)).alias("kind"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = stored(rows.mapInArrow(_blocks(block_bytes), _BLOCKS), "blocks")
    sent = blocks.mapInArrow(_sent(order, max(1, -(-size // block_bytes))), _SENT)
    totals = stored(sent.groupBy("range").applyInArrow(_totals, _TOTALS), "totals")
    known = totals.where("length = 1").agg(F.sum("seen").alias("seen"), F.sum("distinct").alias("distinct")).first()
    seen, distinct = known["seen"] or 0, known["distinct"] or 0
    replies = totals.where("block is not null").select("block", "range", "length", "totals")
    out = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_scored(order, prior, seen, distinct, lane), _SCORES)
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(seen).cast("long").alias("train_tokens"),
        (F.col("base") / UNIT).alias("base_score"), (F.col("score") / UNIT).alias("score"),
    )


SQL = f"""
with recursive digits as (
  select distinct doc_id, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint) as codes from documents where doc_id is not null
),
crcs as (
  select doc_id, xor(list_reduce(list_prepend(4294967295::bigint, codes), lambda crc, code:
    list_reduce(list_prepend(xor(crc, code), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384::bigint))), 4294967295::bigint) as crc
  from digits
),
texts as (
  select row_number() over () as r, d.doc_id, coalesce(crc % {FOLDS} = {HELD_OUT}, false) as held_out,
    list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+'), ' ') as words
  from documents d left join crcs c on d.doc_id = c.doc_id
),
tokens as (select r, held_out, unnest(words) as w, unnest(list_prepend(null, words[:-2])) as h from texts),
ones as (select w, count_if(not held_out) as c from tokens group by w),
pairs as (select h, w, count_if(not held_out) as c from tokens where h is not null group by h, w),
model as (select sum(c)::bigint as seen, count_if(c > 0) as known from ones),
p as (select w, c, (c + 1.0::double) / (seen + known + 1.0::double) as p from ones cross join model),
read as (
  select t.r, a.c > 0 as known, round(log10(a.p) * 1e9)::bigint as base,
    case when coalesce(b.c, 0) = 0 then round(log10(a.p) * 1e9)::bigint else 0 end as plain,
    case when t.h is not null and b.c = 0 and i.c > 0 then round(log10({PRIOR}::double / (i.c + {PRIOR}::double)) * 1e9)::bigint else 0 end as back,
    case when b.c > 0 then round(log10((b.c + {PRIOR}::double * a.p) / (i.c + {PRIOR}::double)) * 1e9)::bigint else 0 end as arc
  from tokens t join p a on t.w = a.w left join p i on t.h = i.w left join pairs b on t.h = b.h and t.w = b.w
),
sums as (
  select r, count(*) as n_tokens, count_if(known) as n_known, sum(base)::bigint as base, sum(plain + back + arc)::bigint as score from read group by r
)
select doc_id, held_out, n_tokens::bigint as n_tokens, n_known::bigint as n_known, seen as train_tokens,
  base / 1e9::double as base_score, score / 1e9::double as score
from texts join sums on texts.r = sums.r cross join model
"""
