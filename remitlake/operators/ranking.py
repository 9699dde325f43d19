"""rank() within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Slices of one power of two, and a number beyond every slice of a double (its exponents reach from -1074 to 1024).
_PER_OCTAVE = 256
_BEYOND = 1_000_000


def value_slice(value: str) -> Column:
    """A whole number that never falls as the value rises, the same on every recomputation; null and NaN have their own.

    It follows the logarithm, so values of any magnitude spread over many slices.
    """
    v = F.col(value).cast("double")
    octaves = F.floor(F.log2(F.abs(v)) * _PER_OCTAVE)
    return (
        F.when(v.isNull(), F.lit(-4 * _BEYOND))
        .when(F.isnan(v), F.lit(4 * _BEYOND))
        .when(F.abs(v) == float("inf"), F.signum(v).cast("int") * (3 * _BEYOND))
        .when(v > 0, octaves + _BEYOND)
        .when(v < 0, -octaves - _BEYOND)
        .otherwise(F.lit(0))
        .cast("int")
    )


def with_rank_desc(df: DataFrame, group: str, value: str, alias: str) -> DataFrame:
    """Add ``rank()`` over (partition by group order by value desc): ties share a rank, gaps follow.

    rank = 1 + rows of the group in higher slices + rows ahead in the own slice. Slices come from the value itself,
    so a big group spans many tasks and a slice that is computed again is the same. Ties are collapsed before that:
    equal values are one row with a count, however many there are. No job runs while the plan is built.
    """
    ties = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_ties")).withColumn("_slice", value_slice(value))

    before = (Window.unboundedPreceding, -1)
    in_slice = Window.partitionBy(group, "_slice").orderBy(F.desc(value))
    ahead = ties.withColumn("_ahead", F.coalesce(F.sum("_ties").over(in_slice.rowsBetween(*before)), F.lit(0)))

    # One row per group and slice; there are at most 256 slices in each power of two that occurs.
    across = Window.partitionBy(group).orderBy(F.desc("_slice"))
    offsets = (
        ties.groupBy(group, "_slice")
        .agg(F.sum("_ties").alias("_size"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(across.rowsBetween(*before)), F.lit(0)))
        .select(F.col(group).alias("_g"), F.col("_slice").alias("_s"), "_offset")
    )
    ranks = ahead.join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_slice") == F.col("_s"))).select(
        F.col(group).alias("_group"),
        F.col(value).alias("_value"),
        (F.col("_offset") + F.col("_ahead") + 1).cast("int").alias(alias),
    )
    same = df[group].eqNullSafe(F.col("_group")) & df[value].eqNullSafe(F.col("_value"))
    return df.join(ranks, same).select(*[df[c] for c in df.columns], alias)

