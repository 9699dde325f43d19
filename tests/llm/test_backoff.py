import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpus import documents, mixed_texts
from remitlake.llm import backoff, queries

END = "\n"


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [END]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(rows, order, prior):
    counts = Counter()
    for doc_id, text in rows:
        if not held_out(doc_id):
            words = tokens(text)
            counts.update(tuple(words[i - n + 1 : i + 1]) for i in range(len(words)) for n in range(1, order + 1) if n <= i + 1)
    seen = sum(c for g, c in counts.items() if len(g) == 1)
    known = sum(1 for g in counts if len(g) == 1)

    def p(history, word):
        if not history:
            return (counts[(word,)] + 1) / (seen + known + 1)
        shorter = p(history[1:], word)
        return (counts[(*history, word)] + prior * shorter) / (counts[history] + prior) if counts[history] else shorter

    out = []
    for doc_id, text in rows:
        words = tokens(text)
        base = sum(math.log10(p((), w)) for w in words)
        score = sum(math.log10(p(tuple(words[max(0, i - order + 1) : i]), w)) for i, w in enumerate(words))
        out.append((doc_id, held_out(doc_id), len(words), sum(counts[(w,)] > 0 for w in words), seen, base, score))
    return out


def same(found, expected):
    key = lambda r: (str(r[0]), r[2], r[5])
    found, expected = sorted(found, key=key), sorted(expected, key=key)
    assert len(found) == len(expected)
    for a, b in zip(found, expected, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=1e-5)


@pytest.mark.parametrize(("order", "size", "lane"), [(1, 1 << 20, 256), (2, 3000, 7), (3, 3000, 5), (4, 1 << 20, 64)])
def test_scores_against_brute_force(spark, order, size, lane):
    texts = mixed_texts(order, 10)
    docs = documents(spark, [*texts, (3, "again"), (3, "again"), (None, "no id, river"), (None, None)], tokens="1", kind="'x'", block="2", score="9")
    rows = backoff.scores(docs, order=order, block_bytes=size, lane=lane).collect()
    same([tuple(r) for r in rows], brute([(r["doc_id"], r["text"]) for r in docs.collect()], order, backoff.PRIOR))


def test_no_rows_and_no_training_rows(spark):
    docs = documents(spark, ["a b a"])
    assert backoff.scores(docs.limit(0)).collect() == []
    only_held = documents(spark, [(next(i for i in range(99) if held_out(i)), "a b a")])
    row = backoff.scores(only_held).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (True, 4, 0, 0, 0.0, 0.0)


def model(texts, order, prior=5.0):
    piece = next(backoff.pieces(pa.array(texts)))
    hashes, firsts = backoff._tokens(piece)
    vocabulary, ids = np.unique(hashes, return_inverse=True)
    block = backoff.Block(np.arange(len(texts)), np.zeros(len(texts), int), firsts, ids, vocabulary)
    grams = backoff._grams(block, order)
    counts = [backoff._training_counts(block, g) for g in grams]
    return block, backoff._automaton(block, grams, counts, len(ids), len(vocabulary), prior)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_of_the_next_token_add_up_to_one(order):
    block, automaton = model(["a b a c", "b a b", "c c a", "a"], order)
    known = len(block.vocabulary)
    for history in [(), (0,), (1,), (2, 1), (1, 2), (3, 3)]:
        begins = np.arange(len(history) + 1) == 0
        read = [automaton.read(np.array([*history, w]), begins, order, 99)[-1] for w in range(known)]
        state, unknown = 0, 1 / (len(block.tokens) + known + 1)
        for w in history:  # follow the arcs to the state, then all failures from there: the weight of an unseen token
            while (at := state * automaton.width + w) not in automaton.key:
                state = automaton.failure[state]
            state = automaton.target[np.searchsorted(automaton.key, at)]
        while state:
            unknown *= 10 ** (automaton.failure_weight[state] / backoff.UNIT)
            state = automaton.failure[state]
        assert sum(10 ** (r / backoff.UNIT) for r in read) + unknown == pytest.approx(1, abs=1e-6)


def test_lanes_carry_the_state():
    rng = random.Random(1)
    for order in (1, 2, 3):
        block, automaton = model([" ".join(rng.choice("abcd") for _ in range(400)), "a b", ""], order)
        begins = np.isin(np.arange(len(block.tokens)), block.firsts[:-1])
        whole = automaton.read(block.tokens, begins, order, len(block.tokens))
        assert all((automaton.read(block.tokens, begins, order, lane) == whole).all() for lane in (1, 2, 3, 17, 1000))


def test_held_out_texts_are_likelier_than_by_single_words(spark, sf_dir):
    held = [r for r in queries.queries()["op12_backoff"](spark, sf_dir).collect() if r["held_out"]]
    assert held
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
