"""N-gram Jaccard join: which documents share most of their word shingles.

Documents are the rows and shingles the columns of a 0/1 matrix M; overlaps are entries of M times its transpose. The
product is taken in blocks of columns, and only over the columns and pairs that size bounds leave:

* Documents with one and the same set are one row (a *node*).
* Only part of a set enters the product: its first 40 percent in a fixed order, shingles that very many documents share
  last (the table of those is only an order: its size bound changes no result). Blocks of columns count how many nodes
  have each shingle. Sizes give how many of these shingles two similar sets share at least, so that each node may do
  without its most frequent ones but for one less than that. What a passage brings into many documents goes, and a
  node that has too little left has no partner.
* Rounds of stars find most links: in each column the nodes of other classes are tied to one of them, each node to the
  one that it has most columns with. A group of copies so gives as many pairs as it has members. Pairs are settled by
  the whole sets, and what is linked is one class.
* Columns on which several classes still meet are multiplied out in blocks of nodes that meet on them: overlaps are
  summed for each pair of nodes of different classes, pairs below the bound that follows from their sizes are
  discarded, and what is left is multiplied by the whole sets. A block gives links that join classes, never its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlake.llm.components import components
from remitlake.llm.members import marked
from remitlake.llm.text import at_rest, mixed, shingle_sets
from remitlake.sources.shared import dropped, stored

WORDS = 5
PERCENT = 75
#: Common shingles that come last in the order: at most so many, each in so many documents. 8 bytes each to every task.
COMMON = 1 << 18
COMMON_FROM = 16
#: Share of a set, beyond what the similarity asks for, that enters the product, in percent.
MORE = 15
#: Rounds of stars go on, so many at most, while they find links and the product has more than so many pairs an entry.
ROUNDS = 2
PAIRS_PER_ENTRY = 4
#: Entries of the matrix in a block of columns, and pairs settled by one task around one node.
BLOCK_ENTRIES = 500_000
#: Blocks that are shuffled together, one after the other through a task, at most: a node is named once for all of them.
BAND = 8
LEAST_BANDS = 24
PAIRS_PER_TASK = 512
#: Nodes that a task multiplies with each other, about: a hub of more is cut into blocks of half as many.
HUB_NODES = 10_000
#: Within its block a column is named by five bytes of a shingle's hash: two shingles of one name only bring up more
#: pairs to settle. A name and its block (under 2 ** 24) make up a number.
_NAME_BYTES = 5
_MOST_BLOCKS = 1 << 24
_FLUSH = 1_000_000
_TILE = 1024


def _node(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def _names(grams: np.ndarray) -> np.ndarray:
    return grams >> np.uint64(64 - 8 * _NAME_BYTES)


def _packed(names: np.ndarray) -> bytes:
    return names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_NAME_BYTES].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // _NAME_BYTES, 8), np.uint8)
    out[:, :_NAME_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, _NAME_BYTES)
    return out.view("<u8").reshape(-1)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, all lowest bytes first: the high ones, zero as a rule, then lie together and compress."""
    return numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").reshape(-1)


def _profile(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("gram", pa.int64()), ("docs", pa.int64())])

    def common(held: list[np.ndarray]) -> pa.RecordBatch:
        grams, docs = np.unique(np.concatenate(held), return_counts=True)
        grams, docs = grams[docs >= 3].view(np.int64), docs[docs >= 3]
        nulls = pa.nulls(len(grams), pa.int64())
        return pa.record_batch([nulls, nulls, nulls, nulls, nulls, pa.array(grams), pa.array(docs)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries = [], 0
        for batch in batches:
            sizes, nodes = [], []
            for grams in shingle_sets(batch.column("text"), words):
                sizes.append(len(grams))
                nodes.append(_node(grams) if len(grams) else None)
                held.append(grams)
                entries += len(grams)
                if entries >= _FLUSH:
                    yield common(held)
                    held, entries = [], 0
                    at_rest()
            nulls = pa.nulls(len(sizes), pa.int64())
            yield pa.record_batch(
                [*(batch.column(c) for c in ("doc_id", "key", "text_key")), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), nulls, nulls], schema=schema
            )
        if held:
            yield common(held)
        del held
        at_rest()

    return run


def _bands(entries: int) -> tuple[int, int]:
    """(bands, blocks in each) for a matrix of so many entries."""
    blocks = min(_MOST_BLOCKS, max(LEAST_BANDS, entries // BLOCK_ENTRIES))
    bands = max(LEAST_BANDS, -(-blocks // BAND))
    return bands, -(-blocks // bands)


def _prefixes(words: int, percent: int, common: np.ndarray, bands: int, width: int):
    """Each document's prefix, cut into bands of ``width`` blocks of columns.

    (band, node numbers, sizes, entries of each node in each block, shingles by block and node).
    """
    schema = pa.schema([("band", pa.int32()), ("nodes", pa.binary()), ("sizes", pa.binary()), ("counts", pa.binary()), ("grams", pa.binary())])

    def flush(nodes: list[int], sizes: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
        grams = np.concatenate(held)
        doc = np.repeat(np.arange(len(held)), [len(x) for x in held])
        names = _names(grams)
        block = (mixed(grams) % np.uint64(bands * width)).astype(np.int64)
        order = np.lexsort((doc, block))
        block, doc, names = block[order], doc[order], names[order]
        nodes, sizes = np.array(nodes, np.int64), np.array(sizes, np.int64)
        out = []
        ends = np.flatnonzero(np.diff(block // width)) + 1
        for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(block)], strict=True):
            docs, place = np.unique(doc[a:b], return_inverse=True)
            n = np.bincount(block[a:b] % width * len(docs) + place, minlength=width * len(docs))
            out.append((int(block[a]) // width, nodes[docs].tobytes(), _planes(sizes[docs]), _planes(n), _packed(names[a:b])))
        return pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sizes, held, entries, seen = [], [], [], 0, set()
        for batch in batches:
            for grams in shingle_sets(batch.column("text"), words):
                if not len(grams) or (node := _node(grams)) in seen:
                    continue
                seen.add(node)
                late = common[np.minimum(np.searchsorted(common, grams), len(common) - 1)] == grams if len(common) else np.zeros(len(grams), bool)
                keep = int(_kept(len(grams), percent))
                nodes.append(node)
                sizes.append(len(grams))
                held.append(np.concatenate([grams[~late], grams[late]])[:keep])
                entries += keep
                if entries >= _FLUSH:
                    yield flush(nodes, sizes, held)
                    nodes, sizes, held, entries, seen = [], [], [], 0, set()
        if held:
            yield flush(nodes, sizes, held)
        del held
        at_rest()

    return run


def _kept(n, percent: int):
    """How many shingles of a set of n enter the product: n - ceil(percent n / 100) + 1, and MORE percent."""
    return np.minimum(n, n - -(-percent * n // 100) + 1 + -(-MORE * n // 100))


def _least_shared(a, b, percent: int):
    """How many of the shingles that enter the product two similar sets of sizes a and b share at least.

    They share ceil(percent (a + b) / (100 + percent)). Of the set whose part ends first in the order, all that is
    shared beyond the parts lies beyond its own.
    """
    return -(-percent * (a + b) // (100 + percent)) - np.maximum(a - _kept(a, percent), b - _kept(b, percent))


def _least_of_any(n, percent: int):
    """The least ``_least_shared`` over all sizes that can be similar to n: it is that of the smallest or of the largest."""
    ends = np.minimum(_least_shared(n, -(-percent * n // 100), percent), _least_shared(n, 100 * n // percent, percent))
    return np.maximum(1, ends)


def _columns(percent: int, width: int):
    """The columns of one band that several nodes have, a block at a time: (gram, node, size, needed, nodes of the column)."""
    schema = pa.schema([("gram", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("needed", pa.int32()), ("nodes", pa.int32())])

    def one_block(grams: np.ndarray, node: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(grams)
        same = np.diff(grams[order]) == 0
        order = order[np.append(same, False) | np.insert(same, 0, False)] if len(order) else order
        order = order[np.lexsort((node[order], grams[order]))]
        grams, node, size = grams[order], node[order], size[order]
        if len(grams):  # equal sets are equal nodes, and a column of one node only is alone
            fresh = np.insert((np.diff(grams) != 0) | (np.diff(node) != 0), 0, True)
            grams, node, size = grams[fresh], node[fresh], size[fresh]
            starts = np.flatnonzero(np.insert(np.diff(grams) != 0, 0, True))
            members = np.diff(np.append(starts, len(grams)))
            members = np.repeat(members, members)
            many = members > 1
            grams, node, size, members = grams[many], node[many], size[many], members[many]
        else:
            members = np.zeros(0, np.int64)
        needed = _least_of_any(size.astype(np.int64), percent)
        columns = (grams.view(np.int64), node, size, needed.astype(np.int32), members.astype(np.int32))
        return pa.record_batch([pa.array(c) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, band = [], 0
        for batch in batches:
            for band, nodes, sizes, counts, grams in zip(*(batch.column(c).to_pylist() for c in ("band", "nodes", "sizes", "counts", "grams")), strict=True):
                counts = _from_planes(counts)
                counts = counts.astype(np.min_scalar_type(counts.max())).reshape(width, -1)
                ends = np.insert(np.cumsum(counts.sum(axis=1, dtype=np.int64)), 0, 0) * _NAME_BYTES
                rows.append((np.frombuffer(nodes, np.int64), _from_planes(sizes), counts, ends.tolist(), grams))
        for k in range(width):
            block = np.uint64(band * width + k) << np.uint64(8 * _NAME_BYTES)
            grams = _unpacked(b"".join([grams[ends[k] : ends[k + 1]] for _, _, _, ends, grams in rows])) | block
            node, size = (np.concatenate([np.repeat(row[c], row[2][k]) for row in rows]) for c in (0, 1))
            yield one_block(grams, node, size)
            at_rest()

    return run


_SETS = "y long, part int, x long, node long, grams binary"


def _whole_sets(words: int):
    """The set of each text to every place where it is compared: x is null where it is the hub."""

    def rows(held: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=["y", "part", "x", "node", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, places = (batch.column(c).to_pylist() for c in ("node", "places"))
            held, size = [], 0
            for node, wanted, grams in zip(nodes, places, shingle_sets(batch.column("text"), words), strict=True):
                if _node(grams) != node:  # another text under the same id
                    continue
                blob = grams.tobytes()
                for place in wanted:
                    held.append((place["y"], place["part"], place["x"], node, blob))
                    size += len(blob)
                    if size > 1 << 22:
                        yield rows(held)
                        held, size = [], 0
            if held:
                yield rows(held)
            del held
            at_rest()

    return run


def _settle(percent: int):
    """Rows in order of (hub, part, hub's own set first): the pairs that are similar."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for batch in batches:
            found = []
            ys, xs = batch.column("y").to_pylist(), batch.column("x").to_pylist()
            for y, x, blob in zip(ys, xs, batch.column("grams"), strict=True):
                grams = np.frombuffer(blob.as_buffer(), np.uint64)
                if x is None:
                    at, own = y, grams.copy()
                elif at == y:
                    place = np.searchsorted(own, grams)
                    place[place == len(own)] = 0
                    both = int(np.count_nonzero(own[place] == grams))
                    if 100 * both >= percent * (len(own) + len(grams) - both):
                        found.append((x, y))
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)

    return run


def _sets_at(places: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(y, part, x, node, grams): the whole set of each node at each of its places (key, node, places). Only documents
    that are needed are shuffled."""
    return marked(texts, "key", places, "wanted").where("wanted").join(places, "key").select("text", "node", "places").mapInArrow(_whole_sets(words), _SETS)


def _linked(pairs: DataFrame, texts: DataFrame, owners: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs (x, y) whose whole sets are similar, stored. A node y of many pairs is shared out over tasks."""
    pairs = stored(pairs, "pairs")
    parts = pairs.groupBy("y").agg((F.count(F.lit(1)) / PAIRS_PER_TASK + 1).cast("int").alias("parts"))
    none = F.lit(None).cast("long")
    hubs = parts.select(F.col("y").alias("node"), "y", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), none.alias("x"))
    leaves = pairs.join(parts, "y").select(F.col("x").alias("node"), "y", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int").alias("part"), "x")
    places = hubs.unionAll(leaves).groupBy("node").agg(F.collect_list(F.struct("y", "part", "x")).alias("places"))
    places = stored(places.join(owners, "node").select("key", "node", "places"), "places")
    found = (
        _sets_at(places, texts, words)
        .repartition("y", "part")
        .sortWithinPartitions("y", "part", F.asc_nulls_first("x"))
        .select("y", "x", "grams")
        .mapInArrow(_settle(percent), "x long, y long")
    )
    found = stored(found, "links")
    dropped(pairs, places)
    return found


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("long")


def _kept_column(n: Column, percent: int) -> Column:
    return F.least(n, n - _ceil_div(percent * n, 100) + 1 + _ceil_div(MORE * n, 100))


def _shared_bound(a: Column, b: Column, needed_a: Column, needed_b: Column, percent: int) -> Column:
    """How many of the columns that are left two similar sets share at least.

    ``_least_shared`` less what either may have done without: one less than it needs.
    """
    a, b = a.cast("long"), b.cast("long")
    shared = _ceil_div(percent * (a + b), 100 + percent) - F.greatest(a - _kept_column(a, percent), b - _kept_column(b, percent))
    return F.greatest(F.lit(1), shared - F.greatest(needed_a, needed_b) + 1)


def _placed(columns: DataFrame, classes: DataFrame | None, turn: int) -> DataFrame:
    """The columns on which several classes meet, with the class of each node and the column's hub (node2, ...).

    The hub is drawn by the node and the turn, so columns of much the same nodes have one hub.
    """
    columns = columns.select("gram", "node", "size", "needed")
    own = F.col("node").alias("class")
    if classes is not None:
        columns = columns.join(classes, "node", "left")
        own = F.coalesce("root", "node").alias("class")
    placed = columns.select("gram", "node", "size", "needed", own)
    drawn = F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), *[F.col(c).alias(f"{c}2") for c in ("node", "size", "needed", "class")])
    met = placed.groupBy("gram").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.min(drawn).alias("hub")).where("a <> b")
    return stored(placed.join(met.select("gram", "hub.*").drop("draw"), "gram"), "placed")


def _meetings(placed: DataFrame) -> tuple[int, int]:
    """(entries, pairs of nodes of different classes summed over the columns)."""
    own = placed.groupBy("gram", "class").agg(F.count(F.lit(1)).cast("double").alias("n"))
    each = own.groupBy("gram").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    row = each.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2)).first()
    return int(row[0] or 0), int(row[1] or 0)


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b).cast("long") >= percent * F.greatest(a, b).cast("long")


def _stars(placed: DataFrame, percent: int) -> DataFrame:
    """(x, y): each node with the hub of another class that it has most columns with, if these are many enough."""
    ties = (
        placed.where((F.col("class") != F.col("class2")) & _similar_sizes("size", "size2", percent))
        .groupBy("node", "size", "needed", "node2", "size2", "needed2")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    bound = _shared_bound(F.col("size"), F.col("size2"), F.col("needed"), F.col("needed2"), percent)
    ties = ties.where(2 * F.col("shared") >= bound)
    return ties.groupBy(F.col("node").alias("x")).agg(F.max(F.struct("shared", "node2"))["node2"].alias("y"))


def _overlaps(lists: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Tiles of the product of the matrix of some sets with its transpose: (first row, first column, overlaps)."""
    lengths = np.array([len(x) for x in lists])
    row = np.repeat(np.arange(len(lists)), lengths)
    _, column, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], place[column[keep]]
    width = int(shared.sum())
    ends = np.searchsorted(row, np.arange(len(lists) + 1))

    def dense(low: int, high: int, edge: int) -> np.ndarray:
        part = slice(ends[low], ends[high])
        inside = (column[part] >= edge) & (column[part] < edge + _TILE)
        out = np.zeros((high - low, min(_TILE, width - edge)), np.float32)
        out[row[part][inside] - low, column[part][inside] - edge] = 1
        return out

    for low in range(0, len(lists), _TILE):
        high = min(low + _TILE, len(lists))
        for start in range(low, len(lists), _TILE):
            stop = min(start + _TILE, len(lists))
            counts = np.zeros((high - low, stop - start), np.float32)
            for edge in range(0, width, _TILE):
                counts += dense(low, high, edge) @ dense(start, stop, edge).T
            yield low, start, counts


def _hubs(table: pa.Table) -> Iterator[tuple[int, dict[str, np.ndarray], list[np.ndarray]]]:
    """The rows of each hub of a table: (hub, columns, sets)."""
    rows = {c: table.column(c).to_numpy() for c in table.column_names if c != "grams"}
    blobs = table.column("grams").to_pylist()
    order = np.argsort(rows["hub"], kind="stable")
    edges = np.append(np.flatnonzero(np.insert(np.diff(rows["hub"][order]) != 0, 0, True)), len(order))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        at = order[a:b]
        yield int(rows["hub"][at[0]]), {c: v[at] for c, v in rows.items()}, [np.asarray(blobs[i], np.int64) for i in at.tolist()]


def _promising(percent: int):
    """The nodes at a hub that share enough columns with one of another class: (hub, node, class)."""
    schema = pa.schema([("hub", pa.int64()), ("node", pa.int64()), ("class", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        out = [[], [], []]
        for hub, rows, lists in _hubs(table):
            kind, size, needed = rows["class"], rows["size"].astype(np.int64), rows["needed"].astype(np.int64)
            good = np.zeros(len(lists), bool)
            for low, start, counts in _overlaps(lists) if len(lists) > 1 else ():
                i, j = np.nonzero(counts)
                shared, i, j = counts[i, j], i + low, j + start
                bound = _least_shared(size[i], size[j], percent) - np.maximum(needed[i], needed[j]) + 1
                enough = (kind[i] != kind[j]) & (shared >= bound) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
                good[i[enough]] = good[j[enough]] = True
            out[0] += [hub] * int(good.sum())
            out[1] += rows["node"][good].tolist()
            out[2] += kind[good].tolist()
        at_rest()
        return pa.table([pa.array(c, pa.int64()) for c in out], schema=schema)

    return run


def _hub_links(percent: int):
    """Rows in order of hub, with whole sets: links that join the classes at each hub, as few as do."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def at_hub(held: list[tuple]) -> Iterator[tuple[int, int]]:
        nodes, kinds, lists = zip(*held, strict=True)
        root = {k: k for k in kinds}

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = k = root[root[k]]
            return k

        size = np.array([len(x) for x in lists], np.int64)
        for low, start, counts in _overlaps(list(lists)):
            i, j = np.nonzero(100 * counts >= percent * (size[low : low + len(counts), None] + size[None, start : start + counts.shape[1]] - counts))
            for a, b in zip((i + low).tolist(), (j + start).tolist(), strict=True):
                if (p := find(kinds[a])) != (q := find(kinds[b])):
                    root[max(p, q)] = min(p, q)
                    yield nodes[a], nodes[b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, found = [], None, []
        for batch in batches:
            for hub, node, kind, blob in zip(*(batch.column(c).to_pylist() for c in ("hub", "node", "class", "grams")), strict=True):
                if hub != at:
                    found += at_hub(held) if len(held) > 1 else ()
                    held, at = [], hub
                held.append((node, kind, np.frombuffer(blob, np.uint64)))
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)
                found = []
        if len(held) > 1 and (found := list(at_hub(held))):
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)
        at_rest()

    return run


def _in_cells(members: DataFrame) -> DataFrame:
    """(hub, node) with each hub of more than HUB_NODES nodes replaced by a cell for each pair of its blocks of nodes."""
    blocks = F.ceil(2 * F.col("n") / max(2, HUB_NODES)).cast("int")
    # At most one row for HUB_NODES members.
    crowd = members.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HUB_NODES).select("hub", blocks.alias("blocks"))
    cut = members.join(F.broadcast(crowd), "hub", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    paired = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Two blocks or more: a block meets itself wherever it meets another one.
    paired = paired.where((F.col("blocks") == 1) | (F.col("own") != F.col("other")))
    cell = F.when(F.col("blocks") == 1, F.col("hub")).otherwise(F.xxhash64("hub", F.least("own", "other"), F.greatest("own", "other")))
    return paired.select(cell.alias("hub"), "node")


def _product(placed: DataFrame, entries: int, texts: DataFrame, owners: DataFrame, words: int, percent: int) -> list[DataFrame]:
    """Links between nodes of different classes that join all classes which the columns left can join.

    Columns of much the same nodes have the same hub. A hub's nodes are multiplied with each other in one task, first by
    the columns that are left, and those that share enough with any again by their whole sets. Where a hub has more nodes
    than a task should hold, they are cut into blocks, and every two blocks are multiplied with each other in a task.
    """
    rows = placed.withColumnRenamed("node2", "hub")
    lists = rows.groupBy("node", "size", "needed", "class").agg(F.collect_list("gram").alias("grams"))
    met = _in_cells(rows.select("hub", "node").distinct()).join(lists, "node")
    blocks = max(24, entries // BLOCK_ENTRIES)
    promising = (
        met.select("hub", "node", "size", "needed", "class", "grams", F.pmod(F.xxhash64("hub"), F.lit(blocks)).alias("block"))
        .groupBy("block")
        .applyInArrow(_promising(percent), "hub long, node long, class long")
    )
    places = promising.groupBy("node").agg(F.collect_list(F.struct(F.col("hub").alias("y"), F.lit(0).alias("part"), F.col("class").alias("x"))).alias("places"))
    places = stored(places.join(owners, "node").select("key", "node", "places"), "places")
    found = (
        _sets_at(places, texts, words)
        .repartition("y")
        .sortWithinPartitions("y")
        .select(F.col("y").alias("hub"), "node", F.col("x").alias("class"), "grams")
        .mapInArrow(_hub_links(percent), "x long, y long")
    )
    links = [stored(found, "links")]
    dropped(places)
    return links


def jaccard_classes(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT, keyed: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs(doc_id, text).

    With ``keyed`` also text_key, the xxhash64 of the text, and class, a number of the component that does not depend on
    ids, null for a row without shingles.

    Two documents are linked when 100 * intersection >= percent * union of their shingle sets; component_id is the
    least doc_id that links reach. Words are lower-cased in A-Z only. A null, empty or white text has no shingles, is
    linked with nothing and is its own component; a text of fewer words than a shingle is one shingle. Repeated rows
    each come out, with the same component. Rows without doc_id are linked like others; a component of which no row has
    an id is null. An empty table gives no rows; other columns are not looked at.
    """
    # Texts are found again by their id, or by a hash where there is none; a set is taken only from a text that has it.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text")).withColumn("key", F.coalesce("doc_id", "text_key"))
    seen = stored(texts.mapInArrow(_profile(words), "doc_id long, key long, text_key long, n long, node long, gram long, docs long"), "profile")
    nameless = texts.where("doc_id is null").groupBy("key").agg(F.first("text").alias("text"))
    texts = texts.where("doc_id is not null").select("key", "text").unionByName(nameless)
    profile = seen.where("n is not null")
    # Bounded by COMMON: an order of shingles, not a choice of them.
    common = (
        seen.where("n is null").groupBy("gram").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= COMMON_FROM)
        .orderBy(F.desc("docs"), "gram").limit(COMMON).select("gram").toPandas()["gram"].to_numpy(np.int64)
    )
    entries = profile.agg(F.sum("n")).first()[0] or 0
    bands, width = _bands(entries * (100 - percent + MORE) // 100)
    columns = all_columns = stored(
        texts.mapInArrow(
            _prefixes(words, percent, np.sort(common.view(np.uint64)), bands, width),
            "band int, nodes binary, sizes binary, counts binary, grams binary",
        )
        .groupBy("band")
        .applyInArrow(_columns(percent, width), "gram long, node long, size int, needed int, nodes int"),
        "columns",
    )
    # A node that has fewer columns than it needs has no partner. Else it does without its most frequent columns, but for
    # one less than it needs.
    able = columns.groupBy("node").agg(F.max("needed").alias("needed"), F.count(F.lit(1)).alias("columns")).where("columns >= needed")
    columns = marked(columns, "node", able, "able").where("able").drop("able")
    falling = Window.partitionBy("node").orderBy(F.desc("nodes"), F.desc("gram"))
    columns = columns.withColumn("place", F.row_number().over(falling)).where("place >= needed").drop("place", "nodes")
    # Stored, so that the window is not made once for each side of the join that follows.
    columns = stored(columns, "fewer")
    dropped(all_columns)
    owners = profile.where("n > 0").groupBy("node").agg(F.min("key").alias("key"))

    links, classes = [], None
    placed, old, met, pairs = _placed(columns, None, 0), columns, 0, 1
    for turn in range(ROUNDS):
        found = _linked(_stars(placed, percent), texts, owners, words, percent)
        if found.isEmpty():
            met, pairs = _meetings(placed)
            break
        links.append(found)
        classes = components(reduce(DataFrame.unionAll, links), "x", "y")
        dropped(old)
        placed, old = _placed(placed, classes, turn + 1), placed
        met, pairs = _meetings(placed)
        if pairs <= PAIRS_PER_ENTRY * met:
            break
    if pairs:
        links += _product(placed, met, texts, owners, words, percent)
        classes = components(reduce(DataFrame.unionAll, links), "x", "y")
    dropped(old, placed, *links)
    if classes is None:
        classes = owners.select("node", F.col("node").alias("root")).limit(0)

    rows = profile.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "node").join(classes, "node", "left")
    rows = rows.select("doc_id", "text_key", "n_shingles", F.coalesce("root", "node").alias("class"))
    firsts = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return rows.join(firsts, "class", "left").select("doc_id", "n_shingles", component, *(["text_key", "class"] if keyed else []))
