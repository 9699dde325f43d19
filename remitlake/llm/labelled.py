"""Bounded samples of labelled documents to fit a model on, and the fold that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; of a null id as of an empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def _draw(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.pmod(F.xxhash64(doc_id, F.lit("sample")), F.lit(1_000_003)) / F.lit(1_000_003.0)


def sample(rows: DataFrame, most: int) -> DataFrame:
    """At most so many of the rows(doc_id, ...), drawn by id: the same ones whenever the table is the same."""
    total = rows.count()
    if total > most:
        rows = rows.where(_draw(F.col("doc_id")) < 0.98 * most / total)
    return rows


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, folds: int, held_out: int, most: int) -> DataFrame:
    """(doc_id, text, label) of about ``most`` labelled documents outside the held-out fold.

    The ids are drawn from the labels first, so only the texts of the sample are shuffled. A document with several
    labels counts with the least of them; null ids and labels are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold(F.col("doc_id"), folds) != held_out)
    )
    total = known.count()
    share = 1.0 if total <= most else most / total
    drawn = _draw(F.col("doc_id")) < share
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out) & drawn)
    return texts.join(known.where(drawn).groupBy("doc_id").agg(F.min("label").alias("label")), "doc_id")
