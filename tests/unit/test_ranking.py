import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from remitlake.operators.ranking import value_slice, with_rank_desc


def ranks(df):
    return sorted((r.g or "", r.v is None, r.v or 0.0, r.id, r.place) for r in df.collect())


def by_window(df):
    return df.withColumn("place", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))


@pytest.fixture(scope="module")
def merchants(spark):
    """One group holds most rows, one value holds most rows of that group; null groups and values occur."""
    rng = random.Random(2)
    rows = []
    for i in range(6000):
        group = rng.choices(["hot", "b", "c", None], [7, 2, 1, 1])[0]
        value = 1.5 if rng.random() < 0.4 else rng.choice([round(rng.uniform(0, 500), 2), None, float(rng.randrange(9))])
        rows.append((i, group, value))
    return spark.createDataFrame(rows, "id int, g string, v double").repartition(5)


def test_slices_and_window_agree(merchants):
    got = with_rank_desc(merchants, "g", "v", "place")
    assert got.schema["place"].dataType.simpleString() == "int"
    assert ranks(got) == ranks(by_window(merchants))


@pytest.mark.parametrize("partitions", ["1", "3", "29"])
def test_any_number_of_slices(spark, merchants, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert ranks(with_rank_desc(merchants, "g", "v", "place")) == ranks(by_window(merchants))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ties_share_a_rank_and_leave_a_gap(spark):
    df = spark.createDataFrame([(1, "g", 9.0), (2, "g", 9.0), (3, "g", 5.0), (4, "h", 1.0)], "id int, g string, v double")
    got = with_rank_desc(df, "g", "v", "place")
    assert {r.id: r.place for r in got.collect()} == {1: 1, 2: 1, 3: 3, 4: 1}


def test_nothing_to_rank(merchants):
    assert with_rank_desc(merchants.limit(0), "g", "v", "place").count() == 0


def test_slices_rise_with_the_value(spark):
    values = [None, float("-inf"), -1e300, -5.0, -0.5, -1e-300, 0.0, 5e-324, 0.5, 0.6, 5.0, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, "g", v) for i, v in enumerate(values)], "id int, g string, v double")
    slices = [r.s for r in df.select("id", value_slice("v").alias("s")).orderBy("id").collect()]
    assert slices == sorted(slices) and len(set(slices)) == len(slices)
    assert ranks(with_rank_desc(df, "g", "v", "place"))[:3] == ranks(by_window(df))[:3]


def test_one_value_for_all_rows_and_no_job_while_planning(spark):
    df = spark.range(5000).selectExpr("id", "'g' g", "1.5D v")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rank plan", "rank plan")
    got = with_rank_desc(df, "g", "v", "place")
    assert not tracker.getJobIdsForGroup("rank plan")
    assert got.select("place").distinct().collect()[0].place == 1
    assert "ExistingRDD" not in got._jdf.queryExecution().toString()
