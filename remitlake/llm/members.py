"""Leave out rows that have no partner before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the map: one megabyte in all, in 256 rows of 4 KB, however many keys there are.
BITS = 1 << 23
_MARKS = ("_member_row", "_member_bits", "_member_slot")


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("member")), F.lit(BITS)) + 1  # bitmaps of Spark count from 1


def marked(df: DataFrame, key: str, keys: DataFrame, flag: str) -> DataFrame:
    """The rows with a column ``flag``, false only where the row's key is not among ``keys[key]``.

    A bitmap of hashed keys, of fixed size and so safe to broadcast, decides. With far more keys than bits it lets every
    row pass, which costs time and changes no result.
    """
    number, bits, slot = _MARKS
    bitmap = (
        keys.select(_slot(F.col(key)).alias(slot))
        .groupBy(F.bitmap_bucket_number(slot).alias(number))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias(bits))
    )
    place = F.bitmap_bit_position(_slot(F.col(key)))
    byte = F.conv(F.hex(F.substring(F.col(bits), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    joined = df.withColumn("_member_number", F.bitmap_bucket_number(_slot(F.col(key))))
    joined = joined.join(F.broadcast(bitmap), F.col("_member_number") == F.col(number), "left")
    return joined.select(*df.columns, there.alias(flag))
