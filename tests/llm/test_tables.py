"""License scans, sharding, mixing and running sums."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from corpus import documents, mixed_texts, prose
from remitlake.llm import licenses, mixing, queries, sharding
from remitlake.llm.running import with_running

# --- licenses ------------------------------------------------------------------------------------------------------


def brute_scan(rows):
    known = licenses.template_pairs(licenses.TEMPLATES)
    out = defaultdict(list)
    for doc_id, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            words = licenses.normalised(line).split(" ")
            pairs = {f"{a} {b}" for a, b in zip(words, words[1:])}
            if pairs:
                dice, name = min((-2 * len(pairs & set(p)) / (len(pairs) + len(p)), n) for n, p in known.items())
                if -dice >= licenses.LEAST:
                    out[(doc_id, name)].append((-dice, number))
    return {k: (max(d for d, _ in v), len(v), min(n for _, n in v)) for k, v in out.items()}


def test_licenses_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        lines = [prose(rng, rng.randrange(0, 20)) for _ in range(rng.randrange(0, 6))]
        for name in rng.sample(sorted(licenses.TEMPLATES), rng.randrange(0, 3)):
            words = licenses.TEMPLATES[name].split(" ")
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(["", "some", words[0].upper(), "the the"])
            lines.insert(rng.randrange(len(lines) + 1), "  " + "  ".join(words) + rng.choice(["", " ...", "\r"]))
        rows.append((i, "\n".join(lines)))
    rows += [(1000 + i, t) for i, t in enumerate(mixed_texts(n=5))]
    df = documents(spark, rows, license="'x'", pairs="1", line="2")
    got = {(r.doc_id, r.license): (r.dice, r.lines, r.first_line) for r in licenses.scan(df).collect()}
    assert got == brute_scan(rows) and len(got) > 60


def test_licenses_without_rows_templates_or_ids(spark):
    text = "All rights reserved."
    df = documents(spark, [(None, text), (1, text), (1, text), (2, None)])
    got = {r.doc_id: r.lines for r in licenses.scan(df).collect()}
    assert got == {None: 1, 1: 2}
    assert licenses.scan(df.limit(0)).count() == 0 and licenses.scan(df, templates={}).count() == 0
    assert licenses.scan(df, templates={"Z": text, "A": text}).first().license == "A"


def test_licenses_wrapped_over_lines_and_inside_longer_lines(spark):
    rng = random.Random(6)
    rows, expected = [], {}
    for i, (name, notice) in enumerate(sorted(licenses.TEMPLATES.items())):
        if name == "All-rights-reserved":  # of three words; on two lines below
            continue
        words = notice.split(" ")
        cut = [" ".join(words[k : k + 4]) for k in range(0, len(words), 4)]
        before, after = prose(rng, 30), prose(rng, 40)
        wrapped = f"{before}\n * " + "\n * ".join(cut) + f"\n{after}"
        inside = f"{prose(rng, 8)}\n{before}. {notice} {after}\n{prose(rng, 9)}"
        rows += [(10 * i, wrapped), (10 * i + 1, inside)]
        expected |= {(10 * i, name): (1.0, 1, 1), (10 * i + 1, name): (1.0, 1, 1)}
    mit, bsd = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["BSD"].replace("source and", "sources or")
    rows += [
        (1000, f"Copyright 2020 Some One. {mit} More prose follows here. {mit} All rights reserved. And so on, and so on."),
        (1001, f"All rights\nreserved.\n{mit}\n{mit}"),
        (1002, f"{prose(rng, 12)} {bsd[:50]}\n{bsd[50:]} {prose(rng, 12)}"),
        (1003, "Released under\n" + prose(rng, 50) + " the MIT License"),
    ]
    expected |= {(1000, "MIT"): (1.0, 2, 0), (1000, "All-rights-reserved"): (1.0, 1, 0), (1001, "All-rights-reserved"): (1.0, 1, 0), (1001, "MIT"): (1.0, 2, 2)}
    got = {(r.doc_id, r.license): (r.dice, r.lines, r.first_line) for r in licenses.scan(documents(spark, rows)).collect()}
    dice, *places = got.pop((1002, "BSD"))
    assert 0.75 <= dice < 1 and places == [1, 0]
    assert got == expected


# --- running sums ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_running_sums(spark, partitions):
    rng = random.Random(1)
    rows = [(rng.randrange(10**6), rng.randrange(-5, 50)) for _ in range(3000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "k long, v long")
        got = with_running(df, [F.asc("k"), F.asc("v")], {"r": "v"}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total, expected = 0, []
    for k, v in sorted(rows):
        expected.append((k, v, total))
        total += v
    assert sorted(map(tuple, got)) == sorted(expected)


# --- sharding --------------------------------------------------------------------------------------------------------


def brute_shards(rows, shards):
    size = lambda t: len((t or "").encode()) + 1
    first = {}
    for i, t in sorted(rows):
        first.setdefault(t or "", i)
    group = Counter()
    for _, t in rows:
        group[t or ""] += size(t)
    total = sum(group.values())
    start, group_start, out, slots = 0, {}, {}, Counter()
    for i, t in sorted(rows, key=lambda r: (first[r[1] or ""], r[0])):
        key = t or ""
        group_start.setdefault(key, start)
        small = group[key] <= max(max(size(x) for _, x in rows), total * sharding.WHOLE_GROUP / shards)
        middle = 2 * group_start[key] + group[key] if small else 2 * start + size(t)
        shard = middle * shards // (2 * total)
        out[i] = (size(t), zlib.crc32((t or "").encode()), shard, slots[shard])
        slots[shard] += 1
        start += size(t)
    return out


def test_shards_against_brute_force(spark):
    rng = random.Random(2)
    texts = mixed_texts(n=60) + ["hot copy " * 30] * 90
    ids = rng.sample(range(-500, 5000), len(texts))
    rows = list(zip(ids, texts))
    df = documents(spark, rows, shard="1", start="2", first="3").repartition(7)
    got = {r.doc_id: (r.size, r.text_crc32, r.shard, r.slot) for r in sharding.shard_plan(df, shards=4).collect()}
    assert got == brute_shards(rows, 4)


def test_shards_are_balanced_and_gapless(spark, sf_dir):
    rows = queries.queries()["op8_sharding"](spark, sf_dir).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    target = sum(sizes.values()) / 16
    largest = max(r.size for r in rows)
    assert all(abs(s - target) <= largest + 0.04 * target for s in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_written_shards_and_repeated_rows(spark, tmp_path):
    df = documents(spark, [(1, "same"), (1, "same"), (None, None), (None, ""), (2, "other")])
    assert sharding.in_shards(df.selectExpr("*", "'x' shard", "doc_id slot")).columns == [*df.columns, "shard", "slot"]
    placed = sharding.in_shards(df, shards=2).collect()
    assert len(placed) == 5 and len({(r.shard, r.slot) for r in placed}) == 5
    sharding.write_shards(df, str(tmp_path / "out"), shards=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    assert sharding.shard_plan(df.limit(0)).count() == 0


def test_groups_of_equal_texts_stay_whole(spark, sf_dir):
    rows = queries.queries()["op8_sharding"](spark, sf_dir).collect()
    share, longest = sum(r.size for r in rows) / 16, max(r.size for r in rows)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    group, shards = Counter(), defaultdict(set)
    for r in rows:
        group[texts[r.doc_id]] += r.size
        shards[texts[r.doc_id]].add(r.shard)
    assert all(len(shards[t]) == 1 for t, n in group.items() if n <= max(longest, sharding.WHOLE_GROUP * share))


def test_names_that_a_table_of_shards_needs_itself(spark):
    df = documents(spark, [(1, "a"), (2, "b")], _id="'mine'", _key="'mine'", _copy="'mine'", SHARD="'mine'", text_key="'mine'")
    rows = sharding.in_shards(df, shards=2).collect()
    assert [(r._id, r._key, r._copy, r.text_key) for r in rows] == [("mine",) * 4] * 2 and {r.shard for r in rows} == {0, 1}


# --- mixing ----------------------------------------------------------------------------------------------------------


def filled(sizes, weights, budget, most):
    """Water filling round by round."""
    target, open_ = {}, set(sizes)
    left = budget * sum(sizes.values())
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= most * sizes[s]}
        if not full:
            return target | {s: level * weights[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_against_water_filling(spark, seed):
    rng = random.Random(seed)
    names = [f"s{i:02d}" for i in range(rng.randrange(1, 12))] + [None]
    sizes = {s: rng.choice([0, 1, 10, 300, 5000]) for s in names}
    weights = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(filled(sizes, weights, 1.5, 2.0))


def test_each_source_comes_near_its_target(spark, sf_dir):
    rows = mixing.mixture(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size) and len(r.positions) == (r.taken // r.size if r.size else len(r.positions))
        assert all(0 <= p <= 1 for p in r.positions) and sorted(r.positions) == list(r.positions)
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)


def test_positions_invert_the_integral_of_the_schedule(spark):
    for tilt in (-0.9, -0.5, 0.0, 0.3, 1.0):
        df = spark.range(0, 101).select(F.col("id").cast("double").alias("c")).withColumn("t", mixing.position(F.col("c"), F.lit(100.0), F.lit(tilt)))
        for r in df.collect():
            assert math.isclose(100 * (r.t + tilt * (r.t * r.t - r.t)), r.c, abs_tol=1e-6) and 0 <= r.t <= 1 + 1e-9


def test_training_order(spark):
    rng = random.Random(5)
    texts = [(i, prose(rng, rng.randrange(1, 40))) for i in range(200)] + [(7, "again and again"), (7, "again and again"), (None, "no id"), (900, None)]
    df = documents(spark, texts, position="'p'", target="1", rows="2").withColumn("source", F.when(F.col("doc_id") % 5 != 0, F.col("source")))
    mixed = mixing.mixture(df)
    read = Counter()
    for r in mixed.collect():
        read[(r.doc_id, r.source)] += len(r.positions) * r.rows
    out = mixing.in_training_order(df)
    rows = out.collect()
    assert Counter((r.doc_id, r.source) for r in rows) == +read
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert mixing.per_document(mixed).count() == df.count()
    assert mixing.mixture(df.limit(0)).count() == 0 and mixing.in_training_order(df.limit(0)).count() == 0


def test_words(spark):
    texts = mixed_texts(n=3) + ["a\x0bb\x0cc d e", "\x1c x"]
    import re

    got = {r.doc_id: r.n for r in documents(spark, texts).select("doc_id", mixing.words_in(F.col("text")).alias("n")).collect()}
    assert [got[i] for i in range(len(texts))] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


# --- against SQL -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_agrees(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    found = con.sql(queries.oracle_sql()[name])
    ours = queries.queries()[name](spark, sf_dir)
    assert set(ours.columns) == set(found.columns)
    order = sorted(ours.columns)
    place = [found.columns.index(c) for c in order]
    theirs = Counter(tuple(row[i] for i in place) for row in found.fetchall())
    assert Counter(tuple(r[c] for c in order) for r in ours.collect()) == theirs
