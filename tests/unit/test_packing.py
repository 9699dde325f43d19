import random

from pyspark.sql import functions as F

from remitlake.operators import cleaning
from remitlake.operators.packing import packed
from remitlake.sources.layers import gathered_by_month


def odd_rows(spark):
    draw = random.Random(3)
    texts = [None, "", "\x00", "\x01", "\x02", "\x01\x02", "\x01\x01\x00", "a", "a\x00", "a\x01b", "a b", "ä", "名", '"', ",", "\\", "\n"]
    rows = [(n, *(draw.choice(texts) for _ in range(3)), draw.choice([None, 1.5, float("nan")]), *(draw.choice(texts) for _ in range(2))) for n in range(3000)]
    return spark.createDataFrame(rows, "n int, a string, b string, c string, x double, d string, `e.f` string")


def test_packed_rows_come_back_and_sort_as_their_columns(spark):
    df = odd_rows(spark)
    order = ["a", "b", "c", "x", "d", "e.f"]
    rows, now, unpacked = packed(df, order)
    assert now == ["_packed0", "x", "_packed1"] and set(rows.columns) == {"n", *now}
    key = lambda columns: [F.asc_nulls_first(f"`{c}`") for c in [*columns, "n"]]
    assert list(map(str, unpacked(rows.orderBy(*key(now))).collect())) == list(map(str, df.orderBy(*key(order)).collect()))
    assert unpacked(rows).schema == df.schema


def test_copies_and_months_are_dealt_out_packed(spark):
    """One text column a run in both exchanges, and the same rows as without."""
    df = odd_rows(spark).drop("e.f").withColumn("transaction_month", F.concat(F.lit("2024-0"), (F.col("n") % 3).cast("string")))
    for step, same in ((gathered_by_month, df), (lambda d: cleaning.one_copy_each(d, "n", ["b"], pack=True), df)):
        out = step(df)
        assert sorted(map(str, out.collect())) == sorted(map(str, same.collect()))
        tree = out._jdf.queryExecution().optimizedPlan().toString()
        shuffled = tree[tree.index("RebalancePartitions" if "RebalancePartitions" in tree else "row_number"):]
        assert "_packed0" in shuffled and out.columns == df.columns
