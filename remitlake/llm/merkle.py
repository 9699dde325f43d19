"""A Merkle manifest of a dataset: one root over all rows, and for each row the witness that ties it to the root.

Rows are leaves; the leaves of a group are appended in order, and every two nodes that follow each other become their
hash, level by level (one that is left over becomes the hash of itself alone) until one node remains. An append opens
a subtree of one leaf; two open subtrees of equal height are completed by their parent, and each one's digest extends
the witnesses of the other's leaves. Blocks of an aligned power of two leaves are appended in tasks of their own; the
roots of the blocks are then leaves of the next round, and their witnesses extend those of the rows below them. So no
task holds more than a block, and rounds are few: the logarithm of the rows to the base of the block.

A row goes along with its leaf, so its witness is made where the row is and is not shuffled: what is joined to it later
are tables of a few rows (ranges, blocks, units), stored so that their sizes are known when a join is planned.

Digests are lowercase hex SHA-256 and are hashed as hex text; between the steps they are kept as 32 bytes. A witness is
an array of (side, digest) from the leaf up: side 0 a sibling to the left, 1 one to the right, 2 none (the node is
hashed alone).
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlake.sources.shared import stored

#: Leaves of a block; a power of two, so that blocks are whole subtrees.
BLOCK = 4096
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

LEFT, RIGHT, ALONE = 0, 1, 2
_WITNESS = "array<struct<side: int, digest: binary>>"
_ARROW_WITNESS = pa.list_(pa.struct([("side", pa.int32()), ("digest", pa.binary())]))


def digest_of(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Forest:
    """Appends digests to open subtrees; ``witnesses`` grow as siblings are completed."""

    def __init__(self) -> None:
        self.witnesses: list[list[tuple[int, str]]] = []
        self._open: list[tuple[int, str, list[list[tuple[int, str]]]]] = []  # height, digest, witnesses of its leaves

    def append(self, digest: str) -> None:
        witness: list[tuple[int, str]] = []
        self.witnesses.append(witness)
        self._open.append((0, digest, [witness]))
        self._complete()

    def _complete(self) -> None:
        while len(self._open) > 1 and self._open[-1][0] == self._open[-2][0]:
            _, right, after = self._open.pop()
            height, left, before = self._open.pop()
            for witness in before:
                witness.append((RIGHT, right))
            for witness in after:
                witness.append((LEFT, left))
            self._open.append((height + 1, digest_of(left, right), before + after))

    def close(self, height: int = 0) -> str:
        """The root, once no more is appended; nodes without a sibling are hashed alone, at least up to ``height``."""
        while len(self._open) > 1 or self._open[0][0] < height:
            at, digest, below = self._open.pop()
            for witness in below:
                witness.append((ALONE, ""))
            self._open.append((at + 1, digest_of(digest), below))
            self._complete()
        return self._open[0][1]


def encoded(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256)


def proof_of(witness: Column) -> Column:
    """The hash of the siblings, from the leaf's up to the root's."""
    siblings = F.transform(F.filter(witness, lambda w: w["side"] != ALONE), lambda w: w["digest"])
    return F.sha2(F.concat_ws("", siblings).cast("binary"), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""

    def up(node: Column, w: Column) -> Column:
        both = F.when(w["side"] == LEFT, F.concat(w["digest"], node)).otherwise(F.concat(node, w["digest"]))
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(witness, leaf, up)


def _raw(digest: Column) -> Column:
    return F.unhex(digest)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _as_arrays(witnesses: list[list[tuple[int, str]]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, witnesses)]).astype(np.int32)
    raw = {d: bytes.fromhex(d) for w in witnesses for _, d in w}
    sides = pa.array([s for w in witnesses for s, _ in w], pa.int32())
    digests = pa.array([raw[d] for w in witnesses for _, d in w], pa.binary())
    pairs = pa.StructArray.from_arrays([sides, digests], fields=list(_ARROW_WITNESS.value_type))
    return pa.ListArray.from_arrays(pa.array(ends), pairs, type=_ARROW_WITNESS)


def _appended(block: int):
    height = block.bit_length() - 1

    def one_block(nodes: pa.Table) -> pa.Table:
        nodes = nodes.drop_columns(["block"]).sort_by("place")
        forest = Forest()
        for digest in nodes.column("digest").to_pylist():
            forest.append(digest.hex())
        top = forest.close(height if nodes.column("count")[0].as_py() > block else 0)
        tops = pa.array([bytes.fromhex(top)] * len(nodes), pa.binary())
        return nodes.append_column("top", tops).append_column("witness", _as_arrays(forest.witnesses))

    return one_block


def witnesses(nodes: DataFrame, most: int, block: int = BLOCK) -> DataFrame:
    """nodes(unit, place, digest, count, ...) with (top, witness): the way of each node to its unit's last node.

    ``place`` counts the nodes of a unit from 0, ``count`` is how many there are, ``most`` the greatest count. Other
    columns go along with their node.
    """
    number = F.floor(F.col("place") / block).cast("long")
    made = ", ".join([*(f"{c} {kind}" for c, kind in nodes.dtypes), "top binary", f"witness {_WITNESS}"])
    below = nodes.withColumn("block", number).groupBy("unit", "block").applyInArrow(_appended(block), made)
    if most <= block:
        return below
    below = stored(below, "witnesses")
    roots = below.where(F.col("place") % block == 0).select(
        "unit", number.alias("place"), F.col("top").alias("digest"), F.ceil(F.col("count") / block).cast("long").alias("count")
    )
    above = witnesses(roots, -(-most // block), block)
    above = stored(above.select("unit", F.col("place").alias("_block"), F.col("top").alias("_top"), F.col("witness").alias("_above")), "above")
    same = [below["unit"] == above["unit"], number == above["_block"]]
    return below.join(above, same).select(*[below[c] for c in nodes.columns], F.col("_top").alias("top"), F.concat("witness", "_above").alias("witness"))


def _placed(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Rows with their ``place`` within their unit, in this order, and the ``count`` of the unit; the greatest count.

    Rows are cut into ranges of the order, and each range is sorted and numbered as it is written. How many rows of a
    unit lie in the ranges before gives the place.
    """
    ranges = leaves.repartitionByRange("unit", *order).sortWithinPartitions("unit", *order)
    cut = stored(ranges.withColumns({"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "ranges")
    unit = Window.partitionBy("unit")
    before = F.sum("_rows").over(unit.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    parts = cut.groupBy("unit", "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    parts = stored(
        parts.select("unit", "_range", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(unit).alias("count")), "parts"
    )
    placed = cut.join(parts, ["unit", "_range"]).withColumn("place", F.col("_row") + F.col("_shift")).select(*leaves.columns, "place", "count")
    return placed, parts.agg(F.max("count")).first()[0] or 0


def manifest(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, unit, leaf, tampered_leaf, subroot, root, witness) for each row of docs(doc_id, source, lang, n_chars, text).

    A unit is a language, its rows stand by doc_id; the languages' subroots, null first, are the leaves of the root.
    Rows of one id stand by their leaves, a null id comes first. A null anywhere is a value of its own. An empty table
    gives no rows; other columns are not looked at. ``tampered_leaf`` is the leaf of the row with 1 added to n_chars.
    """
    doc_id, source, lang, n_chars, text = (F.col(c) for c in COLUMNS)
    leaves = docs.select(
        doc_id.cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit("")).alias("unit"),  # sorts as the language does, null first
        _raw(leaf_of(doc_id, source, lang, n_chars, text)).alias("digest"),
        _raw(leaf_of(doc_id, source, lang, n_chars.cast("long") + 1, text)).alias("tampered"),
    )
    placed, most = _placed(leaves, ["doc_id", "digest"])
    ways = witnesses(placed, most, block)
    if most <= block:
        ways = stored(ways, "witnesses")

    subroots = ways.where("place = 0").select(F.lit("").alias("unit"), F.col("unit").alias("name"), F.col("top").alias("digest"))
    subroots, units = _placed(subroots, ["name"])
    tops = witnesses(subroots, units, block)
    tops = stored(tops.select(F.col("name").alias("unit"), F.col("top").alias("root"), F.col("witness").alias("_above")), "roots")
    witness = F.transform(F.concat("witness", "_above"), lambda w: F.struct(w["side"].alias("side"), _hex(w["digest"]).alias("digest")))
    return ways.join(tops, "unit").select(
        "doc_id", "unit", _hex(F.col("digest")).alias("leaf"), _hex(F.col("tampered")).alias("tampered_leaf"),
        _hex(F.col("top")).alias("subroot"), _hex(F.col("root")).alias("root"), witness.alias("witness"),
    )


def verified(made: DataFrame) -> DataFrame:
    """Fold every row's witness from its leaf, where 7 divides the crc32 of the id from the leaf that was tampered with."""
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    begin = F.when(struck, F.col("tampered_leaf")).otherwise(F.col("leaf"))
    # A row without n_chars cannot be tampered with: null + 1 is null, its two leaves are one.
    out = made.select("doc_id", "leaf", "subroot", "root", proof_of(F.col("witness")).alias("proof_sha256"), folded(begin, F.col("witness")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


SQL = """
with recursive digits as (
  select doc_id, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint) as codes
  from (select distinct doc_id from documents where doc_id is not null)
),
crcs as (
  select doc_id, xor(list_reduce(list_prepend(4294967295::bigint, codes), lambda crc, code:
    list_reduce(list_prepend(xor(crc, code), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384::bigint))), 4294967295::bigint) as crc
  from digits
),
fields as (
  select doc_id, lang, n_chars,
    coalesce(strlen(doc_id::varchar)::varchar || ':' || doc_id::varchar, '-') || coalesce(strlen(source)::varchar || ':' || source, '-')
      || coalesce(strlen(lang)::varchar || ':' || lang, '-') as head,
    coalesce(strlen(text)::varchar || ':' || text, '-') as tail
  from documents
),
leaves as (
  select f.doc_id, lang, sha256(head || coalesce(strlen(n_chars::varchar)::varchar || ':' || n_chars::varchar, '-') || tail) as leaf,
    sha256(head || coalesce(strlen((n_chars + coalesce((crc % 7 = 0)::int, 0))::varchar)::varchar || ':'
      || (n_chars + coalesce((crc % 7 = 0)::int, 0))::varchar, '-') || tail) as kept
  from fields f left join crcs c on f.doc_id = c.doc_id
),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by lang) as n from leaves
),
nodes(lang, height, place, digest, n) as (
  select lang, 0, place, leaf, n from placed
  union all
  select lang, height + 1, place // 2, sha256(string_agg(digest, '' order by place)), (any_value(n) + 1) // 2
  from nodes where n > 1 group by lang, height, place // 2
),
tops as (select lang, max(height) as height, arg_max(digest, height) as subroot from nodes group by lang),
upper_nodes(height, place, digest, n) as (
  select 0, row_number() over (order by lang nulls first) - 1, subroot, count(*) over () from tops
  union all
  select height + 1, place // 2, sha256(string_agg(digest, '' order by place)), (any_value(n) + 1) // 2 from upper_nodes where n > 1 group by height, place // 2
),
root as (select arg_max(digest, height) as root from upper_nodes),
ranked as (select lang, row_number() over (order by lang nulls first) - 1 as place, height, subroot from tops),
steps as (
  select p.lang, p.place, s.height, s.place as sibling, s.digest
  from placed p join nodes s on p.lang is not distinct from s.lang and s.place = xor(p.place >> s.height, 1)
  join ranked t on p.lang is not distinct from t.lang and s.height < t.height
  union all
  select p.lang, p.place, t.height + s.height, s.place, s.digest
  from placed p join ranked t on p.lang is not distinct from t.lang
  join upper_nodes s on s.place = xor(t.place >> s.height, 1) and s.height < (select max(height) from upper_nodes)
),
proofs as (select lang, place, sha256(string_agg(digest, '' order by height)) as proof from steps group by lang, place),
climb(lang, place, height, spot, node) as (
  select lang, place, 0::bigint, place, kept from placed
  union all
  select c.lang, c.place, c.height + 1, case when c.height + 1 = t.height then t.place else c.spot // 2 end,
    sha256(case when s.digest is null then c.node when s.sibling < c.spot then s.digest || c.node else c.node || s.digest end)
  from climb c join ranked t on c.lang is not distinct from t.lang
  left join steps s on c.lang is not distinct from s.lang and c.place = s.place and c.height = s.height
  where c.height < t.height + (select max(height) from upper_nodes)
),
ends as (select lang, place, arg_max(node, height) as folded_root from climb group by lang, place)
select p.doc_id, p.leaf, t.subroot, r.root, coalesce(f.proof, sha256('')) as proof_sha256, e.folded_root, e.folded_root = r.root as verified
from placed p join ranked t on p.lang is not distinct from t.lang cross join root r
join ends e on p.lang is not distinct from e.lang and p.place = e.place
left join proofs f on p.lang is not distinct from f.lang and p.place = f.place
"""
