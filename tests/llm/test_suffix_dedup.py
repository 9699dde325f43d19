import hashlib
import random

import numpy as np
import pytest

from corpus import documents, mixed_texts, prose
from remitlake.llm import suffix_dedup


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for raw in raws:
        for s in range(len(raw) - length + 1):
            seen[raw[s : s + length]] = seen.get(raw[s : s + length], 0) + 1
    out = []
    for raw in raws:
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            if seen[raw[s : s + length]] > 1:
                gone[s : s + length] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1))
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def found(df, **settings):
    rows = suffix_dedup.summary(suffix_dedup.without_repeats(df, **settings)).collect()
    return {r.doc_id: tuple(r)[1:] for r in rows}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    texts = mixed_texts(n=25)
    base = prose(rng, 200)
    # Parts of one text cut at any byte, so that matches begin and end anywhere, and edits every few hundred bytes.
    texts += [base[a : a + n] for a, n in ((0, 399), (0, 400), (1, 401), (300, 800), (17, 999))]
    for _ in range(12):
        letters = list(base)
        for _ in range(rng.randrange(1, 5)):
            letters[rng.randrange(len(letters))] = rng.choice("xyzä")
        texts.append("".join(letters) + prose(rng, 10))
    texts += ["abcdefg" * 200, "ABCDEFGabcdefg" + "abcdefg" * 70, "x" * 401]
    return texts


@pytest.mark.parametrize("crowd", [20_000, 0])
def test_every_byte_agrees(spark, texts, monkeypatch, crowd):
    """With crowd 0 each window of the spans that differ goes by its digest."""
    monkeypatch.setattr(suffix_dedup, "SPANS_PER_BUCKET", crowd)
    got = found(documents(spark, texts).repartition(4))
    assert [got[i] for i in range(len(texts))] == brute(texts, 400)


def test_passages_that_begin_inside_a_run_of_one_byte(spark):
    """Windows that start inside the run begin alike; each equals one of the other text, not its neighbour."""
    rng = random.Random(6)
    ends = ["".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(8)]
    passage = "".join(rng.choice("abcdefgh ") for _ in range(330))
    texts = [a + run * 120 + passage + b for run in "=- " for a, b in zip(ends[:4], ends[4:], strict=True)]
    got = found(documents(spark, texts))
    assert [got[i] for i in range(len(texts))] == brute(texts, 400)


def test_other_lengths_and_small_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 1000)
    got = found(documents(spark, texts), length=260, anchor=60)
    assert [got[i] for i in range(len(texts))] == brute(texts, 260)
    with pytest.raises(ValueError):
        suffix_dedup.without_repeats(documents(spark, texts), length=200)


def test_kept_bytes_and_spans(spark):
    rng = random.Random(8)
    shared, a, b = prose(rng, 100), prose(rng, 20), prose(rng, 20)
    rows = {r.doc_id: r for r in suffix_dedup.without_repeats(documents(spark, [a + "|" + shared + "|" + b, "#" + shared + "#"])).collect()}
    (span,) = rows[0].removed
    assert (a + "|" + shared).encode()[span.start : span.end] == shared.encode()
    assert bytes(rows[0].kept) == f"{a}||{b}".encode() and bytes(rows[1].kept) == b"##"


def test_repeated_rows_null_ids_other_columns_and_nothing(spark):
    long = "".join(random.Random(2).choice("abcdefgh") for _ in range(900))
    df = documents(spark, [(1, long), (1, long), (None, long[:450]), (None, None), (2, "")], anchor="1", first="2", text_key="3")
    rows = sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.summary(suffix_dedup.without_repeats(df)).collect())
    assert rows == [(-1, 0, 0, 0), (-1, 450, 450, 1), (1, 900, 900, 1), (1, 900, 900, 1), (2, 0, 0, 0)]
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0


def test_the_cover_holds_every_distance():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


def test_cover_ranks_sort_like_the_suffixes():
    data = np.frombuffer(b"banana bandana " * 40 + b"band", np.uint8)
    places, rank = suffix_dedup._cover_ranks(suffix_dedup._block_words(data, 400), len(data), 200)
    text = data.tobytes() + bytes(800)
    order = sorted(places.tolist(), key=lambda p: text[p : p + 228])
    assert (np.diff(rank[order]) >= 0).all()


def test_many_rows_of_one_text_are_listed_once(spark):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(900))
    docs = spark.range(5_000).selectExpr("cast(null as long) as doc_id", f"'{text}' as text").unionByName(spark.createDataFrame([(1, "x" * 10 + text[100:600])], "doc_id long, text string"))
    rows = suffix_dedup.summary(suffix_dedup.without_repeats(docs)).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(["(None, 900, 900, 1, 5000)", "(1, 510, 500, 1, 1)"])
