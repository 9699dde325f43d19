import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from corpus import documents, edited, mixed_texts, prose
from remitlake.llm import components as components_module
from remitlake.llm import ngram_join
from remitlake.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute(texts):
    """{doc_id: (shingles, component)} by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def classes(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df).collect()}


def test_what_is_packed_comes_out_again():
    numbers = np.array([0, 1, 255, 256, 70_000, 2**31 - 1], np.int64)
    assert ngram_join._from_planes(ngram_join._planes(numbers)).tolist() == numbers.tolist()
    names = np.array([0, 1, 2**40 - 1, 12345678901], np.uint64)
    assert ngram_join._unpacked(ngram_join._packed(names)).tolist() == names.tolist()


def test_all_pairs_agree(spark):
    texts = list(enumerate(mixed_texts()))
    assert classes(documents(spark, texts).repartition(5)) == brute(texts)


@pytest.mark.parametrize("settings", [{"ROUNDS": 0}, {"HUB_NODES": 0}, {"HUB_NODES": 3, "ROUNDS": 0}, {"_TILE": 3}, {"COMMON_FROM": 1}])
def test_a_group_of_near_copies_whose_links_form_chains(spark, monkeypatch, settings):
    """Most pairs are just above or below the threshold; whatever way a link is found, it is found."""
    for name, value in settings.items():
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(7)
    first = prose(rng, 120)
    texts = [first]
    for _ in range(40):
        texts.append(edited(rng, rng.choice(texts), 0.03))
    texts += [edited(rng, first, 0.05) for _ in range(25)] + [prose(rng, 90) for _ in range(10)]
    texts = [(100 + 7 * i, t) for i, t in enumerate(texts)]
    assert classes(documents(spark, texts)) == brute(texts)


def test_many_documents_of_one_passage_are_not_linked(spark):
    rng = random.Random(9)
    passage = prose(rng, 40)
    texts = [(i, f"{prose(rng, 60)} {passage} {prose(rng, 60)}") for i in range(120)]
    assert {c for _, c in classes(documents(spark, texts)).values()} == set(range(120))


def test_repeated_rows_null_ids_other_columns_and_nothing(spark):
    text = "a b c d e f g h"
    df = documents(spark, [(5, text), (5, text), (None, text), (9, "other words"), (None, "alone")], node="1", gram="'x'", size="2")
    got = sorted(map(tuple, ngram_join.jaccard_classes(df).collect()), key=str)
    assert got == sorted([(5, 4, 5), (5, 4, 5), (None, 4, 5), (9, 1, 9), (None, 1, None)], key=str)
    assert ngram_join.jaccard_classes(df.limit(0)).count() == 0


def test_rows_without_id_link_like_others(spark):
    rng = random.Random(2)
    first = prose(rng, 100)
    chain = [first]
    for _ in range(6):  # each like the one before, the last ones unlike the first
        chain.append(edited(rng, chain[-1], 0.02))
    others = [prose(rng, 50) for _ in range(3)]
    ids = [5, None, None, None, 9, None, 4]
    rows = [*zip(ids, chain, strict=True), (None, others[0]), (None, others[0]), (None, edited(rng, others[1], 0.0)), (77, others[1])]
    got = ngram_join.jaccard_classes(documents(spark, rows)).collect()
    named = [(i if d is None else d, t) for i, (d, t) in enumerate(rows, 1000)]
    groups = defaultdict(list)
    for (i, _), (d, _) in zip(named, rows, strict=True):
        groups[brute(named)[i][1]].append(d)
    least = [min((d for d in g if d is not None), default=None) for g in groups.values() for _ in g]
    assert sorted(map(str, (r.component_id for r in got))) == sorted(map(str, least))


def test_blocks_of_a_large_hub_meet_each_other_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HUB_NODES", 8)
    members = spark.createDataFrame([(1, n) for n in range(100)] + [(2, n) for n in range(8)], "hub long, node long")
    cells = defaultdict(set)
    for r in ngram_join._in_cells(members).collect():
        cells[r.hub].add(r.node)
    assert cells.pop(2) == set(range(8))
    assert len(cells) <= 25 * 24 // 2 and sum(map(len, cells.values())) <= 100 * 24
    together = {(a, b) for c in cells.values() for a in c for b in c if a < b}
    assert together == {(a, b) for a in range(100) for b in range(a + 1, 100)}


def test_bounds_hold_for_all_sizes():
    """Sets as similar as the threshold share no less than the bounds say, for every pair of sizes."""
    for a in [*range(1, 1500), *range(1500, 20_000, 77)]:
        b = np.arange(-(-75 * a // 100), 100 * a // 75 + 1)
        shared = -(-75 * (a + b) // 175)
        least = ngram_join._least_shared(np.int64(a), b, 75)
        assert (least <= np.minimum(ngram_join._kept(np.int64(a), 75), shared)).all()
        assert (ngram_join._least_of_any(np.int64(a), 75) <= np.maximum(1, least)).all()


def test_components_of_a_path_a_star_and_a_ring(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(200, 260)] + [(500, i) for i in range(501, 560)]
    links += [(700 + i, 700 + (i + 1) % 30) for i in range(30)] + [(3, 3)]
    rng.shuffle(links)
    df = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in links], "a long, b long")
    got = defaultdict(set)
    for r in components(df, "a", "b").collect():
        got[r.root].add(r.node)
    assert got == {200: set(range(200, 261)), 500: set(range(500, 560)), 700: set(range(700, 730))}
    assert components(df.limit(0), "a", "b").count() == 0


def columns_of(texts, bands, width):
    """(what is sent, sorted nodes of the columns that several have)."""
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    outs = list(ngram_join._prefixes(5, 75, np.zeros(0, np.uint64), bands, width)([batch]))
    sent = [r for out in outs for r in out.to_pylist()]
    found = []
    for band in {r["band"] for r in sent}:
        rows = pa.RecordBatch.from_pylist([r for r in sent if r["band"] == band], schema=outs[0].schema)
        found += [n for out in ngram_join._columns(75, width)([rows]) for n in out.column("node").to_pylist()]
    return sent, sorted(found)


def test_a_node_is_named_once_for_all_blocks_of_a_band():
    """Not once for each block: with more blocks than shingles a node would be sent with every single one of them."""
    texts = mixed_texts()
    bands, width = ngram_join._bands(200 * ngram_join.BLOCK_ENTRIES)
    assert bands < 200 <= bands * width
    sent, found = columns_of(texts, bands, width)
    nodes = {frozenset(s) for s in map(shingle_set, texts) if s}
    assert sum(len(r["nodes"]) for r in sent) <= 8 * bands * len(nodes)
    assert found and found == columns_of(texts, 1, 1)[1]


@pytest.mark.parametrize("entries", [7, 100])
def test_links_do_not_depend_on_blocks(spark, monkeypatch, entries):
    monkeypatch.setattr(ngram_join, "BLOCK_ENTRIES", entries)
    texts = list(enumerate(mixed_texts()))
    assert classes(documents(spark, texts).repartition(5)) == brute(texts)


@pytest.mark.parametrize("few", [0, 1 << 16])
def test_components_do_not_depend_on_how_links_travel(spark, monkeypatch, few):
    monkeypatch.setattr(components_module, "FEW", few)
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(900 - i, 901 - i) for i in range(50)] + [(None, 5)]
    root = {x: x for pair in links if None not in pair and pair[0] != pair[1] for x in pair}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in links:
        if a is not None and a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = components(spark.createDataFrame(links * 2, "a long, b long"), "a", "b").collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in root)


def test_components_of_stars_take_one_round(spark):
    """Stages are what a run over many partitions pays for."""
    links = spark.createDataFrame([(100 * i, 100 * i + j) for i in range(20) for j in range(1, 30)], "a long, b long")
    sc = spark.sparkContext
    sc.setJobGroup("stars", "components")
    try:
        found = components(links, "a", "b")
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("stars")]
    finally:
        sc._jsc.clearJobGroup()
    assert found.count() == 600 and found.select("root").distinct().count() == 20
    assert sum(len(j.stageIds) for j in jobs) <= 20
