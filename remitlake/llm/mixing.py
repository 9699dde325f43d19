"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1. Each source has a weight that changes linearly over that time; the integral of the
schedule up to t, scaled to the source's target, is the number of words the source has to have given by then. A
document that stands behind c words of its source is read when that demand reaches c: the inverse of the integral at
c is its position. All in SQL functions: sizes and keys are shuffled, texts only where they are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlake.llm.running import with_running

#: Dealt out to the sources by code point, over and over.
WEIGHTS = (3.0, 1.0, 2.0)
#: How a source's weight runs over training time: from (1 - tilt) to (1 + tilt) times its mean. Dealt out likewise.
TILTS = (0.0, 0.5, -0.5)
#: All targets together, and each target at most, as multiples of the words there are.
BUDGET = 1.5
MOST = 2.0


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _dealt(values: tuple[float, ...], rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def source_targets(
    sized: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS, budget: float = BUDGET, most: float = MOST
) -> DataFrame:
    """(source, source_size, source_rank, before, tilt, target) for each source of sized(source, size).

    A target is the source's share by weight of ``budget`` times all words, but at most ``most`` times its own words;
    what is cut off goes to the others by weight, until none is above. With sources in order of (limit / weight) the
    level of the water is the greatest that any number of full sources leaves: no iteration is needed. Windows here
    run over one row for each source.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.select(
        "source",
        "source_size",
        (F.row_number().over(by_name) - 1).alias("source_rank"),
        F.coalesce(F.sum("source_size").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("before"),
    ).withColumns({"weight": _dealt(weights, F.col("source_rank")), "tilt": _dealt(tilts, F.col("source_rank")), "limit": F.col("source_size") * float(most)})
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "source_rank")
    everything = Window.partitionBy()
    full = F.coalesce(F.sum("source_size").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * float(most)
    open_weight = F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    sources = sources.withColumn("level", (F.sum("source_size").over(everything) * float(budget) - full) / open_weight)
    level = F.max("level").over(everything)
    return sources.withColumn("target", F.least(F.col("limit"), level * F.col("weight"))).select(
        "source", "source_size", "source_rank", "before", "tilt", "target"
    )


def position(words_before: Column, target: Column, tilt: Column) -> Column:
    """The training time at which a source's demand, target * (t + tilt * (t * t - t)), reaches so many words."""
    share = F.when(target > 0, words_before / target).otherwise(F.lit(0.0))
    rise = 1 - tilt
    # At tilt 1 demand starts from nothing: 0 words are reached at 0 / 0, which is time 0.
    tilted = F.try_divide(2 * share, rise + F.sqrt(F.greatest(rise * rise + 4 * tilt * share, F.lit(0.0))))
    return F.when(tilt == 0, share).otherwise(F.coalesce(tilted, F.lit(0.0)))


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, source, text_key, rows, size, source_size, target, tilt, taken, positions) for the distinct rows of docs.

    ``docs`` has doc_id, text, source. The documents of a source stand in an order drawn from doc_id (md5), and are
    read from its start, again from its start when all are used up. A reading counts if its middle lies before the
    source's target, so the words taken differ from the target by at most half a document. ``positions`` are the
    training times of the readings, ``taken`` the words of all of them for one row.

    ``rows`` counts rows that are alike in id, source and text; they share one decision. A null text has size 0, a null
    source is a source of its own, a null id is an id. A document of size 0 is read like others and takes no words.
    An empty table gives no rows. Other columns are not looked at.
    """
    units = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            words_in(F.col("text").cast("string")).alias("size"),
            F.xxhash64(F.col("text").cast("string")).alias("text_key"),
        )
        .groupBy("doc_id", "source", "size", "text_key")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumns({"words": F.col("size") * F.col("rows"), "draw": F.md5(F.col("doc_id").cast("string").cast("binary"))})
    )
    order = [F.asc_nulls_last("source"), F.asc("draw"), F.asc("doc_id"), F.asc("text_key"), F.asc("size")]
    placed = with_running(units, order, {"start": "words"})
    targets = source_targets(placed.select("source", F.col("words").alias("size")), **settings).withColumnRenamed("source", "_source")
    placed = placed.join(targets, F.col("source").eqNullSafe(F.col("_source"))).withColumn("offset", F.col("start") - F.col("before"))
    times = []
    for reading in range(int(-(-settings.get("most", MOST) // 1))):
        at = F.col("offset") + reading * F.col("source_size")
        counts = 2 * at + F.col("words") < 2 * F.col("target")
        times.append(F.when(counts, position(at.cast("double"), F.col("target"), F.col("tilt"))))
    return placed.withColumn("positions", F.filter(F.array(*times), lambda t: t.isNotNull())).select(
        "doc_id", "source", "text_key", "rows", "size", "source_size", "target", "tilt",
        (F.col("size") * F.size("positions")).cast("long").alias("taken"), "positions",
    )


def per_document(mixed: DataFrame) -> DataFrame:
    """One row for each row of the documents: doc_id, size, source_size, target, taken, first and last position."""
    return mixed.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select(
        "doc_id", "size", "source_size", "target", "taken",
        F.get("positions", F.lit(0)).alias("first_position"),
        F.get(F.reverse("positions"), F.lit(0)).alias("last_position"),
    )


def in_training_order(docs: DataFrame, *, name: str = "position", **settings) -> DataFrame:
    """The rows of docs, each as often as it is read and with its position in a column ``name``, range-sorted by that.

    A reading that comes at the same time as another follows the lower doc_id. A column of that name that docs has is
    replaced.
    """
    mixed = mixture(docs, **settings).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_key").alias("_key"), F.explode("positions").alias("_position")
    )
    same = (
        docs["doc_id"].cast("long").eqNullSafe(mixed["_id"])
        & docs["source"].cast("string").eqNullSafe(mixed["_source"])
        & (F.xxhash64(docs["text"].cast("string")) == mixed["_key"])
    )
    read = docs.join(mixed, same).select(*[docs[c] for c in docs.columns if c != name], mixed["_position"].alias(name))
    return read.repartitionByRange(name, "doc_id").sortWithinPartitions(name, "doc_id")
