"""Contiguous shards of equal bytes, cut out of the running sum of all sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlake.llm.running import with_running

SHARDS = 16
#: A group of equal texts stays whole up to the size of the longest document, or this share of a shard if that is more.
#: No cut can be nearer to its target than half a document, so whole groups of that size leave the sizes as equal.
WHOLE_GROUP = 0.04


def size_of(text: Column) -> Column:
    """Bytes of the text as UTF-8 plus one; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_plan(docs: DataFrame, *, shards: int = SHARDS, whole_group: float = WHOLE_GROUP) -> DataFrame:
    """(doc_id, size, text_crc32, text_key, shard, slot) for every row of docs(doc_id, text).

    Documents stand in order of the least doc_id that has their text, then of their own doc_id (null first), so
    equal texts stand together. A document belongs to the shard in whose share of all bytes its middle falls; all
    documents of a group of equal texts go with the middle of the group, unless the group is larger than both the
    longest document and ``whole_group`` of a shard: then it is cut between documents. Shards differ from equal sizes by
    at most half of one document or whole group at either end. Slots count the rows of a shard from 0 in that order.

    Null and empty texts have size 1 and are one text. Repeated rows have a slot each. No rows give no rows; a shard
    may stay empty where a document is larger than a share. Other columns are not looked at. Texts are read once and
    never moved: only sizes and keys are shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size_of(text).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("text_key"),
    )
    groups = rows.groupBy("text_key").agg(F.min("doc_id").alias("first"), F.sum("size").alias("group_bytes"))
    placed = with_running(
        rows.join(groups, "text_key").withColumn("one", F.lit(1).cast("long")),
        [F.asc("first"), F.asc("text_key"), F.asc("doc_id")],
        {"start": "size", "index": "one"},
    )
    sums = placed.agg(F.sum("size").alias("total"), F.max("size").alias("longest")).first()
    total, longest = sums.total or 1, sums.longest or 0
    starts = placed.groupBy("text_key").agg(F.min("start").alias("group_start"))
    whole = F.col("group_bytes") <= max(longest, total * whole_group / shards)
    twice_middle = F.when(whole, 2 * F.col("group_start") + F.col("group_bytes")).otherwise(2 * F.col("start") + F.col("size"))
    shares = (twice_middle.cast("decimal(28,0)") * F.lit(shards).cast("decimal(10,0)")).cast("decimal(38,0)")
    shard = F.call_function("div", shares, F.lit(2 * total).cast("decimal(38,0)")).cast("int")
    placed = placed.join(starts, "text_key").withColumn("shard", shard)
    firsts = placed.groupBy("shard").agg(F.min("index").alias("first_index"))
    return placed.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", "text_key", "shard", (F.col("index") - F.col("first_index")).alias("slot")
    )


def in_shards(docs: DataFrame, *, shards: int = SHARDS) -> DataFrame:
    """The rows of docs with ``shard`` and ``slot``, to be written shard by shard: repeated rows get one slot each.

    Columns of these names that docs has are replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    longer = "_" * (1 + max(map(len, docs.columns)))  # than any name of docs
    number, key, copy = f"{longer}id", f"{longer}key", f"{longer}copy"
    alike = Window.partitionBy(number, key).orderBy(F.lit(1))
    rows = docs.withColumns({number: F.col("doc_id").cast("long"), key: F.unhex(F.sha2(text, 256))}).withColumn(copy, F.row_number().over(alike))
    again = Window.partitionBy("doc_id", "text_key").orderBy("shard", "slot")
    plan = shard_plan(docs, shards=shards).withColumn("copy", F.row_number().over(again))
    same = rows[number].eqNullSafe(plan["doc_id"]) & (rows[key] == plan["text_key"]) & (rows[copy] == plan["copy"])
    own = [rows[c] for c in docs.columns if c.lower() not in ("shard", "slot")]
    return rows.join(plan, same).select(*own, plan["shard"], plan["slot"])


def write_shards(docs: DataFrame, path: str, *, shards: int = SHARDS) -> None:
    """Parquet files under ``path/shard=N``, the rows of each file in order of their slots."""
    (
        in_shards(docs, shards=shards)
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
