"""Structure repair of conversations: the cheapest edits after which roles read ``(s?(ua)+)?``.

A row may be kept (0), given the role user or assistant (1) or deleted (2); an empty row of either role may be inserted
anywhere (5). Blank rows and later copies must go; a truncated row that stays costs 5 more. Of equally cheap repairs
the one whose audit (the edits' initials in order) comes first in ASCII is taken.

The cost of the rest of a conversation, by the role that came last, is a vector of four numbers that runs from its end
to its start (Viterbi, backwards). It is computed in chunks side by side: each chunk begins from a speculative vector at
its end; where the next chunk's result turns out to be another one, by more than a constant, a fix-up pass reruns the
chunk from that until its vectors are parallel to the old ones. Passes end when no chunk's end changes any more. Then the
constants add up along the chunks, and one trace per chunk and incoming state, from the start, follows cheapest edits.

Rows are cut into chunks by ranges of (conversation, turn, ...), so a conversation of any length is spread over tasks, and
what is shuffled for it is a digest and a symbol a row. Only the digest of the repaired text, which SHA-256 defines from
left to right, is taken in one task for a conversation, row by row from a sorted stream that spills.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlake.sources.shared import dropped, stored

#: Rows of a chunk.
CHUNK = 1 << 16

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"
FAULTS = 20

# States: nothing yet, system came last, user, assistant. A user follows all but a user; after a user an assistant must come.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}

# A symbol for each row: its role's initial, upper case where it is truncated; o for any other role; d where it must go.
Vector = tuple[int, int, int, int]


def _closed(costs: list[int]) -> Vector:
    """With any insertions before."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[_NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


#: After the last row: a conversation may end before anything or after an assistant.
END: Vector = _closed([0, 99, 99, 0])
SPECULATIVE: Vector = _closed([0, 0, 0, 0])


def _edits(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, state after) of each edit of a row, by initial."""
    yield "D", DELETE, state
    if symbol == "d":
        return
    more = TRUNCATED if symbol.isupper() else 0
    kept = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}.get(symbol.lower())
    if kept == _NEXT[state] or (kept == _SYSTEM and state == _START):
        yield "K", KEEP + more, kept
    yield "R", REROLE + more, _NEXT[state]


# Functions travel to the tasks by value, so their results are kept in plain dictionaries. Vectors are few: their numbers
# differ by no more than two insertions.
_BEFORE: dict[tuple[str, Vector], tuple[Vector, int]] = {}
_CHOSEN: dict[tuple[str, Vector, int], tuple[str, int]] = {}


def _before(symbol: str, after: Vector) -> tuple[Vector, int]:
    """The vector before a row, less its least number, and that number."""
    known = _BEFORE.get((symbol, after))
    if known is not None:
        return known
    costs = _closed([min(cost + after[to] for _, cost, to in _edits(symbol, state)) for state in range(4)])
    least = min(costs)
    _BEFORE[symbol, after] = out = (tuple(c - least for c in costs), least)
    return out


def _chosen(symbol: str, after: Vector, state: int) -> tuple[str, int]:
    """The initials of the insertions before a row and of its own edit, and the state after it."""
    known = _CHOSEN.get((symbol, after, state))
    if known is None:
        known = _CHOSEN[symbol, after, state] = _cheapest(symbol, after, state)
    return known


def _cheapest(symbol: str, after: Vector, state: int) -> tuple[str, int]:
    vector, least = _before(symbol, after)
    audit = ""
    while True:
        rest = vector[state] + least
        edits = {initial: to for initial, cost, to in _edits(symbol, state) if cost + after[to] == rest}
        if "D" in edits:
            return audit + "D", edits["D"]
        if INSERT + vector[_NEXT[state]] + least == rest:
            audit, state = audit + "I", _NEXT[state]
            continue
        initial = min(edits)
        return audit + initial, edits[initial]


def backward(symbols: str, end: Vector) -> tuple[Vector, int]:
    """The vector at the start of a chunk and the constant that it is less by."""
    total = 0
    for symbol in reversed(symbols):
        end, least = _before(symbol, end)
        total += least
    return end, total


def fixed_up(symbols: str, old: Vector, new: Vector, start: Vector, total: int) -> tuple[Vector, int]:
    """The result of ``backward`` from ``new``, given that from ``old``: rerun until the two are parallel."""
    for symbol in reversed(symbols):
        if old == new:
            break
        old, less = _before(symbol, old)
        new, least = _before(symbol, new)
        total += least - less
    else:
        return new, total
    return start, total


def trace(symbols: str, end: Vector, state: int, last: bool) -> tuple[str, int]:
    """The edits of a chunk from a state at its start, and the state at its end; the last chunk's with insertions after it."""
    vectors = [end]
    for symbol in reversed(symbols):
        vectors.append(_before(symbol, vectors[-1])[0])
    audit = []
    for i, symbol in enumerate(symbols):
        edits, state = _chosen(symbol, vectors[len(symbols) - 1 - i], state)
        audit.append(edits)
    while last and end[state]:
        audit.append("I")
        state = _NEXT[state]
    return "".join(audit), state


# --- rows --------------------------------------------------------------------------------------------------------


def _name(conv_id: Column) -> Column:
    """A text for each conversation, null included."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def plain(rows: DataFrame) -> DataFrame:
    """(conv, conv_id, turn, role, text), a null role or text as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return rows.select(_name(F.col("conv_id")).alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, drawn by crc32 of ``conv_id:turn`` (a null as one space) modulo FAULTS.

    0 drops the row, 1 empties its text, 2 removes . ! ? from it, 3 repeats it, 4 makes it a user's; 5 to 19 leave it.
    """
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % FAULTS
    drawn = plain(rows).withColumn("fault", fault).where("fault <> 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _judged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, n, blank, later, truncated) for the different rows; ``n`` are alike.

    ``later`` where an earlier turn of the conversation has the same role and text. Of the n alike only the first is not
    a copy.
    """
    ink = F.rtrim(F.col("text"), F.lit(SPACES))
    alike = (
        rows.select(
            "conv", "turn", "role",
            F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
            (ink == "").alias("blank"),
            (~F.substring(ink, -1, 1).isin(".", "!", "?")).alias("truncated"),
        )
        .groupBy("conv", "turn", "role", "digest", "blank", "truncated")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("at", F.struct(F.col("turn").isNotNull(), F.col("turn")))
    )
    # Only what stands in several turns is joined back: one row for each such text, whatever the number of its turns.
    several = alike.groupBy("conv", "role", "digest").agg(F.count(F.lit(1)).alias("turns"), F.min("at").alias("first")).where("turns > 1")
    joined = alike.join(several.drop("turns"), ["conv", "role", "digest"], "left")
    return joined.withColumn("later", F.coalesce(F.col("at") > F.col("first"), F.lit(False))).drop("at", "first")


def _faults(judged: DataFrame) -> DataFrame:
    first = ~F.col("blank") & ~F.col("later")
    copies = F.when(~F.col("blank"), F.when(F.col("later"), F.col("n")).otherwise(F.col("n") - 1)).otherwise(0)
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return judged.groupBy("conv").agg(
        F.coalesce(turns, F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(copies).alias("duplicate"),
        F.count_if(first & F.col("truncated")).alias("truncated"),
    )


_ORDER = ("conv", "turn", "role", "digest")  # ascending, nulls first
_CHUNKS = "conv string, part long, symbols string, head string, tail string, illegal long"
_LEGAL = ("su", "ua", "au")


def _chunks(size: int):
    """Cut the sorted rows of a task into chunks of one conversation each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        schema = pa.schema([(n, {"part": pa.int64(), "illegal": pa.int64()}.get(n, pa.string())) for n in ("conv", "part", "symbols", "head", "tail", "illegal")])
        conv, symbols, head, tail, illegal, done = None, [], "", "", 0, []

        def close() -> None:
            nonlocal part, symbols, illegal
            if symbols:
                done.append((conv, part, "".join(symbols), head, tail, illegal))
                part, symbols, illegal = part + 1, [], 0

        def taken() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
            done.clear()
            return out

        for batch in batches:
            for name, initial, symbol, n in zip(*[batch.column(c).to_pylist() for c in ("conv", "initial", "symbol", "n")], strict=True):
                if name != conv:
                    close()
                    conv = name
                while n:
                    if not symbols:
                        head = tail = initial
                        symbols.append(symbol)
                        n -= 1
                    else:
                        room = min(n, size - len(symbols))
                        illegal += (tail + initial not in _LEGAL) + (room - 1) * (initial + initial not in _LEGAL)
                        symbols.append(symbol)
                        symbols.extend("d" * (room - 1))
                        tail, n = initial, n - room
                    symbol = "d"
                    if len(symbols) >= size:
                        close()
            if done:
                yield taken()
        close()
        if done:
            yield taken()

    return run


def _cut(judged: DataFrame, size: int) -> DataFrame:
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    whole = F.when(F.col("truncated"), F.upper(letter)).otherwise(letter)
    symbol = F.when(F.col("blank") | F.col("later"), F.lit("d")).otherwise(whole)
    rows = judged.select("conv", "turn", "role", "digest", initial.alias("initial"), symbol.alias("symbol"), "n")
    return rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).select("conv", "initial", "symbol", "n").mapInArrow(_chunks(size), _CHUNKS)


# --- chunks ------------------------------------------------------------------------------------------------------

_VECTOR = "array<int>"

def _in_order():
    return Window.partitionBy("conv").orderBy("part")


def _vector(costs: Vector) -> Column:
    return F.array(*[F.lit(c) for c in costs])


def _run_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(.., wanted, old, start, total) -> (.., end, start, total): from scratch where there is no old end, else by a fix-up."""
    for batch in batches:
        starts, totals = [], []
        rows = zip(*[batch.column(c).to_pylist() for c in ("symbols", "wanted", "end", "start", "total")], strict=True)
        for symbols, wanted, end, start, total in rows:
            if end is None:
                start, total = backward(symbols, tuple(wanted))
            elif wanted != end:
                start, total = fixed_up(symbols, tuple(end), tuple(wanted), tuple(start), total)
            starts.append(start)
            totals.append(total)
        vectors = pa.list_(pa.int32())
        columns = [batch.column(c) for c in ("conv", "part", "symbols", "last", "wanted")] + [pa.array(starts, vectors), pa.array(totals, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["conv", "part", "symbols", "last", "end", "start", "total"])


_RUN = f"conv string, part long, symbols string, last boolean, end {_VECTOR}, start {_VECTOR}, total long"


def converged(chunks: DataFrame) -> DataFrame:
    """chunks(conv, part, symbols) with the vectors at both ends of each and the constant between them, after all fix-ups.

    A pass settles at least the last chunk that is not yet settled; as vectors become parallel after a few rows, nearly
    all are settled by the first two.
    """
    none = F.lit(None)
    last = F.lead("part").over(_in_order()).isNull()
    first = chunks.select("conv", "part", "symbols", last.alias("last")).withColumns(
        {
            "wanted": F.when(F.col("last"), _vector(END)).otherwise(_vector(SPECULATIVE)),
            "end": none.cast(_VECTOR),
            "start": none.cast(_VECTOR),
            "total": none.cast("long"),
        }
    )
    run = stored(first.mapInArrow(_run_chunks, _RUN), "chunks")
    while True:
        wanted = F.when(F.col("last"), F.col("end")).otherwise(F.lead("start").over(_in_order()))
        asked = run.withColumn("wanted", wanted)
        if not asked.where(F.col("wanted") != F.col("end")).count():
            return run
        before, run = run, stored(asked.mapInArrow(_run_chunks, _RUN), "chunks")
        dropped(before)


def _trace_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("audit", pa.string()), ("state", pa.int32())]))
    for batch in batches:
        paths = []
        for symbols, end, last, first in zip(*[batch.column(c).to_pylist() for c in ("symbols", "end", "last", "first")], strict=True):
            ways = [trace(symbols, tuple(end), state, last) for state in ((_START,) if first else range(4))]
            paths.append([{"audit": a, "state": s} for a, s in ways])
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("part"), pa.array(paths, kind)], names=["conv", "part", "paths"])


def _audits(run: DataFrame) -> DataFrame:
    """(conv, cost, audit): constants added up, traces put together by the state that each hands to the next."""
    costs = run.groupBy("conv").agg((F.sum("total") + F.min_by("start", "part")[_START]).alias("cost"))
    traced = run.withColumn("first", F.lag("part").over(_in_order()).isNull()).select("conv", "part", "symbols", "end", "last", "first")
    traced = traced.mapInArrow(_trace_chunks, "conv string, part long, paths array<struct<audit: string, state: int>>")
    whole = traced.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "paths"))).alias("chunks"))
    start = F.struct(F.lit("").alias("audit"), F.lit(_START).alias("state"))

    def put(so_far: Column, chunk: Column) -> Column:
        way = chunk["paths"][so_far["state"]]
        return F.struct(F.concat(so_far["audit"], way["audit"]).alias("audit"), way["state"].alias("state"))

    audits = whole.select("conv", F.aggregate("chunks", start, put)["audit"].alias("audit"))
    return audits.join(costs, "conv")


# --- repaired rows -----------------------------------------------------------------------------------------------


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str] | tuple[str, None, None]]:
    """(conv, role, text) of the repaired rows, in order; (conv, None, None) where a conversation begins.

    A conversation's audit comes first, then its rows.
    """
    conv, audit, at, state = None, "", 0, _START

    def insertions() -> Iterator[tuple[str, str, str]]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = _NEXT[state], at + 1
            yield conv, _NAMES[state], ""

    for batch in batches:
        for name, letters, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text")], strict=True):
            if letters is not None:
                yield from insertions()
                conv, audit, at, state = name, letters, 0, _START
                yield conv, None, None
                continue
            yield from insertions()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]
                yield conv, role, text
            elif edit == "R":
                state = _NEXT[state]
                yield conv, _NAMES[state], text
    yield from insertions()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done, conv, digest, empty = [], None, None, True
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["conv", "repaired_sha256"])
    for name, role, text in _walk(batches):
        if role is None:
            if digest is not None:
                done.append((conv, digest.hexdigest()))
            conv, digest, empty = name, sha256(), True
            if len(done) >= 4096:
                yield batch_of(done)
                done = []
        else:
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
    if digest is not None:
        yield batch_of([*done, (conv, digest.hexdigest())])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, place = [], 0
    names, types = ["conv", "place", "role", "text"], [pa.string(), pa.int64(), pa.string(), pa.string()]
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    for conv, role, text in _walk(batches):
        if role is None:
            place = 0
            continue
        rows.append((conv, place, role, text))
        place += 1
        if len(rows) >= 1024:
            yield batch_of(rows)
            rows = []
    if rows:
        yield batch_of(rows)


def _read_in_order(rows: DataFrame, audits: DataFrame) -> DataFrame:
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    none = lambda kind: F.lit(None).cast(kind)
    texts = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", digest.alias("digest"), "text", none("string").alias("audit"))
    heads = audits.select(
        "conv", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"), none("binary").alias("digest"), none("string").alias("text"), "audit"
    )
    both = heads.unionByName(texts).repartition("conv")
    return both.sortWithinPartitions("conv", "kind", *_ORDER[1:]).select("conv", "audit", "role", "text")


def audits(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation of plain rows."""
    judged = stored(_judged(rows), "judged")
    cut = stored(_cut(judged, chunk), "chunks")
    edge = F.coalesce(F.concat(F.lag("tail").over(_in_order()), F.col("head")).isin(*_LEGAL) == F.lit(False), F.lit(False))
    illegal = cut.withColumn("edge", edge).groupBy("conv").agg(F.sum(F.col("illegal") + F.col("edge").cast("long")).alias("illegal"))
    return _faults(judged).join(illegal, "conv").join(_audits(converged(cut)), "conv")


def repaired_rows(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id as text, place, role, text) of the repaired conversations of rows(conv_id, turn, role, text)."""
    rows = plain(rows)
    out = _read_in_order(rows, audits(rows, chunk)).mapInArrow(_listed, "conv string, place long, role string, text string")
    return out.select(F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).alias("conv_id"), "place", "role", "text")


def repaired(rows: DataFrame, conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each conv_id of ``conversations``: faults, cost, audit and digest of its repaired rows(conv_id, turn, role, text).

    Rows stand by turn, nulls first; rows of one turn by role and digest of their text, so repeats stand together. A null
    role or text is one space, a null conv_id a conversation. A conversation without rows has zeros, an empty audit and the
    digest of an empty text. An empty table gives no rows; other columns are not looked at.
    """
    rows = plain(rows)
    made = stored(audits(rows, chunk), "audits")
    digests = _read_in_order(rows, made).mapInArrow(_hashed, "conv string, repaired_sha256 string")
    names = conversations.select(_name(F.col("conv_id")).alias("conv"), "conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return names.join(made, "conv", "left").join(digests, "conv", "left").select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"),
    )
