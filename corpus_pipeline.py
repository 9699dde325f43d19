"""From raw documents to shards: five stages, each of which works on what the one before has kept.

A stage takes (spark, docs, sf_dir) and returns documents; each is stored in the shared folder before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from remitlake.sources.shared import dropped, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """These names, longer where docs has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity reaches the threshold go. The lexicon is learned from ``labels``."""
    score = toxicity.scorer(toxicity.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    (name,) = _unused(docs, "_toxicity")
    return docs.withColumn(name, score(F.col("text").cast("string"))).where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of shared word shingles bring together one stays: that with the least id, then text key.

    A document is an id and a text: unrelated texts under one id, or without one, all stay, repeated rows stay once (the
    least by their other columns). A null id comes after all others. Texts without words are linked with nothing.
    """
    missing, number, key = _unused(docs, "_missing", "_number", "_key")
    place = F.struct(F.col("doc_id").isNull().alias(missing), F.coalesce("doc_id", F.lit(0)).alias(number), F.col("text_key").alias(key))
    classes = ngram_join.jaccard_classes(docs, keyed=True).select("class", place.alias("place"))
    firsts = classes.where("class is not null").groupBy("class").agg(F.min("place").alias("place")).select("place.*")
    alone = classes.where("class is null").select("place.*").distinct()
    marked = docs.withColumns(
        {
            missing: F.col("doc_id").isNull(),
            number: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            key: F.xxhash64(F.col("text").cast("string")),
        }
    )
    same = [missing, number, key]
    kept = marked.join(firsts.unionAll(alone), same, "left_semi").groupBy(*same).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return kept.select("row.*")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go, those without an id as well; a clean text stays whatever other text has its id."""
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keyed=True)
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"].cast("string")) == found["_key"])
    return docs.join(found, same, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the curriculum, each as often as its source's target takes it."""
    (name,) = _unused(docs, "_position")
    return mixing.in_training_order(docs, name=name).select(*docs.columns)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row: (doc_id, size, text_crc32, shard, slot)."""
    return sharding.shard_plan(docs).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]

#: Learned scores and greedy tiling are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        if n:
            dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
