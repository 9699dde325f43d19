"""The operations on documents as queries over the given tables, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from remitlake.llm import backoff, conversations, decontaminate, fingerprints, language, licenses, merkle, mixing, ngram_join, quality, sharding, suffix_dedup, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _of_documents(operator: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def _with(name: str, operator: Callable[[DataFrame, DataFrame], DataFrame]):
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"), table(spark, sf_dir, name))


def _sharded(docs: DataFrame) -> DataFrame:
    return sharding.shard_plan(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repaired(conversations.damaged(rows), rows)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": _of_documents(fingerprints.beside_edited),
        "op2_suffix_dedup": _of_documents(lambda docs: suffix_dedup.summary(suffix_dedup.without_repeats(docs))),
        "op3_license_scan": _of_documents(licenses.scan),
        "op4_quality": _with("labels", quality.quality),
        "op5_decontamination": _with("benchmark", decontaminate.contaminated),
        "op6_ngram_jaccard": _of_documents(ngram_join.jaccard_classes),
        "op7_language": _of_documents(language.language),
        "op8_sharding": _of_documents(_sharded),
        "op9_mixing": _of_documents(lambda docs: mixing.per_document(mixing.mixture(docs))),
        "op10_toxicity": _with("labels", toxicity.toxicity),
        "op11_conversations": _repaired,
        "op12_backoff": _of_documents(backoff.scores),
        "op13_merkle": _of_documents(lambda docs: merkle.verified(merkle.manifest(docs))),
        "pipeline": corpus_pipeline.run,
    }


_MIXING = """
with sized as (
  select doc_id, source, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as n, md5(doc_id::varchar) as draw from documents
),
units as (select doc_id, source, coalesce(n, 0)::bigint as size, draw from sized),
sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as source_rank from units group by source
),
weighed as (
  select *, 2.0::double * source_size as most, [3.0, 1.0, 2.0][(source_rank % 3 + 1)::int]::double as weight,
    [0.0, 0.5, -0.5][(source_rank % 3 + 1)::int]::double as tilt from sources
),
levels as (
  select *, (sum(source_size) over () * 1.5::double - coalesce(sum(source_size) over (
      order by most / weight, source_rank rows between unbounded preceding and 1 preceding), 0) * 2.0::double)
    / sum(weight) over (order by most / weight, source_rank rows between current row and unbounded following) as level
  from weighed
),
targets as (select *, least(most, max(level) over () * weight) as target from levels),
placed as (
  select u.*, coalesce(sum(size) over (partition by source order by draw, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from units u
),
readings as (
  select p.doc_id, p.size, t.source_size, t.target, t.tilt, p.start + reading * t.source_size as words_before
  from placed p join targets t on p.source is not distinct from t.source cross join (values (0), (1)) r(reading)
),
timed as (
  select *, case when target > 0 then words_before::double / target else 0 end as share, 2 * words_before + size < 2 * target as counts from readings
),
positions as (
  select *, case when not counts then null when tilt = 0 then share else
    2 * share / ((1 - tilt) + sqrt(greatest((1 - tilt) * (1 - tilt) + 4 * tilt * share, 0))) end as position from timed
)
select doc_id, size, source_size, target, (size * count_if(counts))::bigint as taken,
  min(position) as first_position, max(position) as last_position
from positions group by doc_id, size, source_size, target
"""


_JACCARD = """
with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
),
sets as (
  select doc_id, case
    when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    when len(w) > 0 then [array_to_string(w, ' ')]
    else [] end as shingles
  from words
),
grams as (select doc_id, len(shingles) as n, unnest(shingles) as gram from sets),
shared as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as common
  from grams a join grams b on a.gram = b.gram and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
),
links as (select a, b from shared where 100 * common >= 75 * (n + m - common)),
reach as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, l.b from reach r join links l on r.other = l.a
),
firsts as (select doc_id, min(other) as component_id from reach group by doc_id)
select s.doc_id, coalesce(len(s.shingles), 0)::bigint as n_shingles, f.component_id
from sets s join firsts f on s.doc_id = f.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_license_scan": licenses.scan_sql(),
        "op6_ngram_jaccard": _JACCARD,
        "op9_mixing": _MIXING,
        "op12_backoff": backoff.SQL,
        "op13_merkle": merkle.SQL,
    }
