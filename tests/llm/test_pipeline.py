"""The five stages, each against plain Python over its own input."""

from collections import Counter

import pytest

import corpus_pipeline as cp
from remitlake.llm import decontaminate, mixing, ngram_join, queries, toxicity
from test_ngram_join import brute


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """(name, rows before, rows after) of each stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = []
    for name, stage in cp.STAGES:
        after = stage(spark, docs, sf_dir).cache()
        out.append((name, docs, after))
        docs = after
    yield out
    for _, _, after in out:
        after.unpersist()


def rows(df):
    return Counter(tuple(r[c] for c in cp.COLUMNS) for r in df.collect())


def test_columns(stages):
    assert [name for name, *_ in stages] == ["toxicity", "near copies", "benchmark decontamination", "mixing", "sharding"]
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_toxic_documents_go(spark, sf_dir, stages):
    _, before, after = stages[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.toxicity(before, labels).collect() if r.predicted}
    assert rows(after) == Counter({r: n for r, n in rows(before).items() if r[0] not in toxic})


def test_one_of_near_copies_stays(stages):
    _, before, after = stages[1]
    components = brute([(r.doc_id, r.text) for r in before.collect()])
    assert rows(after) == Counter({r: n for r, n in rows(before).items() if components[r[0]][1] == r[0]})


def test_documents_with_test_items_go(spark, sf_dir, stages):
    _, before, after = stages[2]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in before.collect() if any(i in r.text for i in items)}
    gone = rows(before) - rows(after)
    assert holds <= {r[0] for r in gone} and rows(after) + gone == rows(before)
    found = {r.doc_id for r in decontaminate.contaminated(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert {r[0] for r in gone} == found


def test_documents_with_test_items_go_by_their_text(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("text is not null").orderBy("item_id").first().text
    rows = [(None, f"x {item}"), (None, "clean without an id"), (7, f"{item} y"), (7, f"{item} y"), (7, "clean under the same id"), (8, None), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    after = Counter((r.doc_id, r.text) for r in cp.drop_benchmark(spark, docs, sf_dir).collect())
    assert after == Counter([rows[1], rows[4], rows[5], rows[6]])


def test_documents_are_read_as_often_as_the_mix_takes_them(stages):
    _, before, after = stages[3]
    expected = Counter({r.doc_id: len(r.positions) for r in mixing.mixture(before).collect()})
    assert Counter(r.doc_id for r in after.collect()) == +expected
    assert set(rows(after)) <= set(rows(before))


def test_every_row_gets_a_slot(stages):
    _, before, after = stages[4]
    assert Counter(r.doc_id for r in after.collect()) == Counter(r.doc_id for r in before.collect())
    assert len({(r.shard, r.slot) for r in after.collect()}) == before.count()


def test_run_is_all_stages(spark, sf_dir, stages):
    assert sorted(map(tuple, cp.run(spark, sf_dir).collect())) == sorted(map(tuple, stages[-1][2].collect()))


def test_repeated_rows_and_rows_without_id_or_text(spark, sf_dir):
    docs = spark.createDataFrame(
        [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (None, None, None, None, None), (2, "", "en", "s", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        if name == "near copies":
            assert docs.count() == 3
    assert set(docs.columns) == {"doc_id", "size", "text_crc32", "shard", "slot"}
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, sf_dir)
        assert empty.count() == 0


def test_near_copies_go_by_id_and_text(spark, sf_dir):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [
        (7, text), (7, "an unrelated text of some words"), (7, "another text that is like no other"), (7, text), (9, text + " more"),
        (None, text + " more"), (None, "a text of its own without an id"), (None, "a text of its own without an id"), (None, None), (3, ""), (3, " "),
    ]
    docs = spark.createDataFrame([(*r, "en", "s", i) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    after = Counter((r.doc_id, r.text) for r in cp.keep_one_of_near_copies(spark, docs, sf_dir).collect())
    assert after == Counter([rows[0], rows[1], rows[2], rows[6], rows[8], rows[9], rows[10]])


def test_columns_of_clashing_names_are_handed_on(spark, sf_dir):
    clashing = {"_toxicity": "mine", "_position": "mine", "_missing": "mine", "_number": "mine", "_key": "mine", "_id": "mine", "text_key": "mine", "class": "mine"}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.selectExpr("*", *(f"'{v}' as `{k}`" for k, v in clashing.items()))
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.select(*clashing).distinct().collect() == [tuple(clashing.values())]
        docs = docs.cache()


def test_queries_are_registered():
    names = set(queries.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n != "pipeline"} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.oracle_sql()) <= names
    assert ngram_join.PERCENT == 75 and ngram_join.WORDS == 5
