"""Deliveries one after the other: results, published state, loads that break off."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from remitlake import contract as C
from remitlake.operators import cleaning, gold_state
from remitlake.operators.ingest import with_ingestion_metadata
from remitlake.plans import layers
from remitlake.plans.lake import COPIES, Lake
from remitlake.sources import landing
from remitlake.sources.landing import write_transactions_csv
from remitlake.sources.releases import Conflict, Release, Releases
from rows import raw

TIMES = ("ingestion_timestamp", "silver_processed_timestamp", "source_file")


def delivery(spark, path, *changes):
    write_transactions_csv(raw(spark, *changes), str(path))
    return str(path)


def rows(df):
    return sorted((tuple(str(r[c]) for c in sorted(df.columns) if c not in TIMES) for r in df.collect()))


def write_folders(lake, table):
    return lake.releases._names(f"data/{table}")


def t(number, **change):
    return {"transaction_id": f"T{number}", **change}


DELIVERIES = (
    [t(1), t(2, amount=None), t(3, transaction_date="2024-03-01", merchant_id="m2", merchant_name="Two"), t(4, customer_id="bob", transaction_time="n/a"), t(9)],
    [
        t(1, transaction_date="2024-01-15"),  # an earlier date wins and leaves February
        t(2, transaction_date="2024-03-02"),  # a later, good copy of a bad one: the transaction stays rejected
        t(3, transaction_date="2024-04-01"),  # loses
        t(4, customer_id="bob", transaction_time=None),  # wins, and cannot be read either
        t(5, customer_id="cat", merchant_category="Travel", amount=70000.0, currency="??"),
    ],
    [t(6, customer_id="dan", transaction_date="2024-05-05"), t(5, customer_id="cat", transaction_date="2023-12-31", amount=-1.0), t(9)],
)


def test_deliveries_leave_what_one_run_over_all_leaves(spark, tmp_path):
    lake, seen = Lake(spark, str(tmp_path / "lake")), []
    for n, changes in enumerate(DELIVERIES):
        release = lake.load(delivery(spark, tmp_path / f"in{n}", *changes))
        seen += changes
        assert release.number == n + 1
        silver = cleaning.to_silver(with_ingestion_metadata(raw(spark, *seen), "x"))
        assert rows(lake.read("silver/transactions")) == rows(silver)
        for name, build in layers.GOLD.items():
            assert rows(lake.read(f"gold/{name}")) == rows(build(silver)), name
        assert lake.read("bronze/transactions").count() == len(seen)
    assert rows(lake.read(COPIES).drop("fate", "transaction_month")) == rows(with_ingestion_metadata(raw(spark, *seen), "x").transform(cleaning.one_copy_each))
    # The last delivery touched May, and December and February, where its copy of T5 came from and T9 and T5 stood.
    earlier = lake.releases.release(2).tables["silver/transactions"].parts
    later = lake.releases.current().tables["silver/transactions"].parts
    assert {m for m in earlier if later.get(m) == earlier[m]} == {"2024-01", "2024-03"}
    # Earlier releases stay readable until they are forgotten.
    assert lake.read("gold/monthly_trends", lake.releases.release(1)).count() == 2
    before = {name: rows(lake.read(name)) for name in lake.releases.current().tables}
    assert lake.releases.forget(1)
    assert lake.releases.numbers() == [3]
    assert {name: rows(lake.read(name)) for name in lake.releases.current().tables} == before
    assert lake.releases.forget(1) == []


def test_a_load_that_breaks_off_changes_nothing_and_goes_on_after_its_last_step(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"), gold=["monthly_trends"])
    lake.load(delivery(spark, tmp_path / "in0", t(1)))
    before = rows(lake.read("gold/monthly_trends"))

    def broken(state):
        raise RuntimeError("planted")

    second = delivery(spark, tmp_path / "in1", t(2, transaction_date="2024-04-04"))
    with monkeypatch.context() as m:
        m.setitem(gold_state.GOLD, "monthly_trends", broken)
        with pytest.raises(RuntimeError, match="planted"):
            lake.load(second)
    assert lake.releases.current().number == 1
    assert rows(lake.read("gold/monthly_trends")) == before
    steps = {table: len(write_folders(lake, table)) for table in ("bronze/transactions", COPIES, "silver/transactions", "state/month_figures")}

    lake = Lake(spark, str(tmp_path / "lake"), gold=["monthly_trends"])  # as another process would
    assert lake.load(second).number == 2
    assert {table: len(write_folders(lake, table)) for table in steps} == steps  # finished steps were not done again
    assert [r["transaction_month"] for r in lake.read("gold/monthly_trends").orderBy("transaction_month").collect()] == ["2024-02", "2024-04"]
    assert lake.load(second).number == 2  # nor is a delivery taken in twice
    assert lake.read("bronze/transactions").count() == 2


def test_a_write_that_is_killed_leaves_the_last_release(spark, tmp_path):
    releases = Releases(spark, str(tmp_path / "lake"))
    first = releases.publish(Release(), {"a": releases.written("a", spark.range(3))})
    die = F.when(F.col("id") == 7, F.raise_error(F.lit("planted"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="planted"):
        releases.written("a", spark.range(10).select(die.cast("long").alias("id")))
    assert releases.read("a").count() == 3
    reading = releases.read("a")
    releases.publish(first, {"a": releases.written("a", spark.range(5))})
    assert (reading.count(), releases.read("a").count()) == (3, 5)


def test_of_two_writers_one_is_told(spark, tmp_path):
    releases = Releases(spark, str(tmp_path / "lake"))
    start = releases.current()
    releases.publish(start, {"a": releases.written("a", spark.range(1))})
    with pytest.raises(Conflict):
        releases.publish(start, {"a": releases.written("a", spark.range(2))})
    assert releases.read("a").count() == 1
    with pytest.raises(KeyError):
        releases.read("b")


def test_parts_of_a_table(spark, tmp_path):
    releases = Releases(spark, str(tmp_path / "lake"))
    df = spark.createDataFrame([(1, "2024-01"), (2, None), (3, "a/b=c")], "id int, transaction_month string")
    table = releases.written("deep/table", df, by="transaction_month")
    assert sorted(map(str, releases.rows(table).collect())) == sorted(map(str, df.collect()))
    assert [r["id"] for r in releases.rows(table, ["a/b=c", "2030-01"]).collect()] == [3]
    less = table.with_parts(releases.written("deep/table", df.where("id = 1").selectExpr("9 as id", "transaction_month"), by="transaction_month"), ["a/b=c"])
    assert sorted(r["id"] for r in releases.rows(less).collect()) == [2, 9]
    none = releases.written("deep/table", df.limit(0), by="transaction_month")
    assert releases.rows(none).collect() == [] and releases.rows(none).columns == df.columns


def test_records_that_cannot_be_read_are_kept_aside(spark, tmp_path):
    header = ",".join(C.RAW_COLUMNS)
    good = 'T1,ann,m1,"Kiosk, Harbour",Dining,8.4,EUR,mobile,completed,2024-02-29,23:59:58,Ghent,false'
    bad = {
        "T2,ann": landing.TOO_FEW,
        good.replace("T1", "T3") + ",more": landing.TOO_MANY,
        good.replace("8.4", "eight"): landing.BAD_AMOUNT,
        good.replace("false", "no!"): landing.BAD_FLAG,
    }
    empty_fields = "T9,,,,,,,,,,,,"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([header, good, empty_fields]) + "\n")
    (tmp_path / "in" / "b.csv").write_text("\n".join([header, *bad]) + "\n")
    lake = Lake(spark, str(tmp_path / "lake"), gold=[])
    lake.load(str(tmp_path / "in"))
    rejects = lake.read("bronze/rejects").collect()
    assert {r["text"]: r["reason"] for r in rejects} == bad
    assert {r["file"].rpartition("/")[2] for r in rejects} == {"b.csv"}
    assert sorted(r["transaction_id"] for r in lake.read("bronze/transactions").collect()) == ["T1", "T9"]
    assert [r["merchant_name"] for r in lake.read("silver/transactions").collect()] == ["Kiosk, Harbour"]


def test_a_merchants_customers_take_no_more_room_than_a_word_each(spark):
    """Of a merchant with few customers, whose numbers lie far apart, no empty stretch is kept; crowded words are shared."""
    numbers = [*range(1, 100), 64_000, 9_000_000_000]
    silver = spark.createDataFrame([("2024-01", "m", "M", "Retail", f"c{n}") for n in numbers * 2], "transaction_month string, merchant_id string, merchant_name string, merchant_category string, customer_id string")
    known = spark.createDataFrame([(f"c{n}", n) for n in numbers], "customer_id string, number long")
    state = gold_state.merchant_customers(silver, known)
    assert state.count() == 4
    assert dict(state.dtypes)["bits"] == "bigint"
    assert state.agg(F.sum(F.bit_count(F.col("bits")))).first()[0] == len(numbers)


def test_a_delivery_is_dealt_out_once_and_silver_not_again(spark, tmp_path, monkeypatch):
    """Copies within a delivery and stored ones are resolved together; silver is written from files that are by month."""
    from remitlake.plans import lake as steps

    resolved, gathered = [], []
    once, by_month = cleaning.one_copy_each, steps.gathered_by_month
    monkeypatch.setattr(cleaning, "one_copy_each", lambda df, **how: resolved.append(df) or once(df, **how))
    monkeypatch.setattr(steps, "gathered_by_month", lambda df: gathered.append(df) or by_month(df))
    lake = Lake(spark, str(tmp_path / "lake"), gold=[])
    deliveries = ([t(1), t(1, transaction_date="2024-05-01"), t(2)], [t(2, transaction_date="2023-01-01"), t(2, transaction_date="2023-02-01"), t(3, transaction_date=None)])
    for n, changes in enumerate(deliveries):
        lake.load(delivery(spark, tmp_path / f"in{n}", *changes))
    assert (len(resolved), len(gathered)) == (2, 2)
    assert write_folders(lake, "incoming") == []
    found = {(r["transaction_id"], r["transaction_date"]) for r in lake.read(COPIES).collect()}
    assert found == {("T1", "2024-02-29"), ("T2", "2023-01-01"), ("T3", None)}
    assert lake.read("silver/transactions").count() == 2
    for month in lake.releases.current().tables["silver/transactions"].parts.values():
        assert len(month) == 1


def test_landing_files_are_compressed_and_dealt_out_by_a_column(spark, tmp_path):
    df = raw(spark, {"transaction_id": "T1"}, {"transaction_id": "T2"})
    write_transactions_csv(df.withColumn("delivery", F.substring("transaction_id", 2, 1)), str(tmp_path / "in"), by="delivery")
    files = [p for p in (tmp_path / "in").rglob("part-*")]
    assert files and all(p.name.endswith(".csv.gz") for p in files)
    assert landing.read_transactions_csv(spark, str(tmp_path / "in" / "delivery=2")).collect() == df.where("transaction_id = 'T2'").collect()


def test_loads_leave_no_shuffle_files_and_deliveries_go_when_taken_in(spark, sf_dir, monkeypatch):
    from remitlake.plans import registry
    from test_shared import _released, _shuffle_files

    removed, before = [], _shuffle_files(spark)
    remove = registry.remove
    monkeypatch.setattr(registry, "remove", lambda spark, path: removed.append(path) or remove(spark, path))
    merged = registry.queries()["merged_silver"](spark, sf_dir)
    assert _released(spark, before)
    assert [path.rpartition("/")[2] for path in removed] == ["delivery=0", "delivery=1"]
    assert not any(Path(path).exists() for path in removed)
    assert merged.count() == 4389


def test_months_are_looked_for_only_where_something_is_stored(spark, tmp_path, monkeypatch):
    from remitlake.plans import lake as steps

    looked = []
    months_of = steps.months_of
    monkeypatch.setattr(steps, "months_of", lambda received: looked.append(months_of(received)) or {*looked[-1]})
    lake = Lake(spark, str(tmp_path / "lake"), gold=[])
    lake.load(delivery(spark, tmp_path / "in0", t(1), t(2, transaction_date=None)))
    assert looked == []
    lake.load(delivery(spark, tmp_path / "in1", t(1, transaction_date="2024-01-15")))
    assert looked == [{"2024-01"}]
    assert {(r["transaction_id"], r["transaction_date"]) for r in lake.read(COPIES).collect()} == {("T1", "2024-01-15"), ("T2", None)}
