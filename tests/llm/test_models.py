"""The learned operations: quality, language, toxicity."""

import random
import time
import zlib

import numpy as np
import pytest

from corpus import documents, prose
from remitlake.llm import crf, language, quality, toxicity
from remitlake.llm.text import pieces

EMPTY_LABELS = "doc_id long, quality int, toxic int"


def brute_chain(scores, transitions, start):
    """Marginals and log partition sum by going through all label sequences."""
    import itertools

    n, k = scores.shape
    weights = {}
    for path in itertools.product(range(k), repeat=n):
        w = start[path[0]] + sum(scores[t, y] for t, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:]))
        weights[path] = np.exp(w)
    total = sum(weights.values())
    marginals = np.array([[sum(w for p, w in weights.items() if p[t] == y) / total for y in range(k)] for t in range(n)])
    pairs = np.zeros((k, k))
    for p, w in weights.items():
        for a, b in zip(p, p[1:]):
            pairs[a, b] += w / total
    return marginals, np.log(total), pairs


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    transitions, start = rng.normal(size=(3, 3)), rng.normal(size=3)
    lengths = [4, 1, 0, 6, 2, 5]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    scores = rng.normal(size=(offsets[-1], 3)) * 3
    for pairs in (False, True):
        got = crf.forward_backward(scores, offsets, transitions, start, pairs=pairs)
        expected = np.zeros((3, 3))
        for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
            if b > a:
                marginals, log_z, both = brute_chain(scores[a:b], transitions, start)
                assert np.allclose(got.marginals[a:b], marginals) and np.isclose(got.log_z[i], log_z)
                expected += both
        assert not pairs or np.allclose(got.pairs, expected)
    long = crf.forward_backward(np.full((50_000, 2), 300.0, np.float32), np.array([0, 50_000]), np.zeros((2, 2)), np.zeros(2))
    assert np.allclose(long.marginals, 0.5)


def test_training_follows_the_likelihood():
    """Words decide most places, their neighbours the ambiguous ones."""
    rng = np.random.default_rng(2)
    labels = np.repeat(rng.integers(0, 2, 300), 4)
    words = np.where(rng.random(len(labels)) < 0.6, labels, 2)
    chain = crf.train(np.array([0, 1, 2]), np.arange(4), words, np.arange(0, 1201, 4), labels, 3, 2)
    scores = chain.weights[words]
    guess = crf.forward_backward(scores, np.arange(0, 1201, 4), chain.transitions, chain.start).marginals.argmax(axis=1)
    assert (guess == labels).mean() > 0.97 and (scores.argmax(axis=1) == labels).mean() < 0.9


def labelled(spark, rows):
    return spark.createDataFrame(rows, EMPTY_LABELS)


@pytest.fixture(scope="module")
def judged(spark):
    """Good prose; junk marks, shouting and stuck words are bad. A third of the texts have a toxic word, some in disguise."""
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(360):
        lines = [prose(rng, rng.randrange(8, 30)) for _ in range(rng.randrange(2, 7))]
        bad = i % 4 == 0
        if bad:
            spoil = (lambda x: x.replace(" ", "$$$ "), str.upper, lambda x: (x.split(" ")[0] + " ") * 20)[i // 4 % 3]
            lines = [spoil(x) if rng.random() < 0.9 else x for x in lines]
        toxic = i % 3 == 0
        if toxic:
            word = rng.choice(["grobnak", "grobnik", "zurlfit"])
            word = rng.choice([str, str.upper, lambda w: w.replace("o", "0").replace("i", "1"), lambda w: w.replace("o", "о")])(word)
            lines[0] = f"{lines[0][:20]} {word} {lines[0][20:]}"
        texts.append("\n".join(lines))
        labels.append((i, int(not bad), int(toxic)))
    texts += [None, "", "zurlfitting rooms are fine " * 3]
    return documents(spark, texts), labelled(spark, labels), labels


def scored(df, held, folds):
    rows = {r.doc_id: r for r in df.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % folds == held) and 0 <= r.score <= 1 for i, r in rows.items())
    return rows


def test_quality_on_held_out_documents(judged):
    docs, labels, truth = judged
    rows = scored(quality.quality(docs, labels), 1, 3)
    held = [(rows[i].predicted, q) for i, q, _ in truth if rows[i].held_out]
    assert len(rows) == 363 and len(held) > 80 and np.mean([a == b for a, b in held]) > 0.97


def test_toxicity_on_held_out_documents(judged):
    docs, labels, truth = judged
    rows = scored(toxicity.toxicity(docs, labels), 2, 4)
    held = [(rows[i].predicted, t) for i, _, t in truth if rows[i].held_out]
    assert len(held) > 60 and np.mean([a == b for a, b in held]) == 1
    assert (rows[360].predicted, rows[361].predicted) == (0, 0) and rows[360].score == rows[361].score


def test_scores_do_not_depend_on_held_out_labels_or_other_columns(spark, judged):
    docs, labels, truth = judged
    other = labelled(spark, [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in truth])
    changed = docs.selectExpr("doc_id", "text", "'xx' lang", "'t' source", "doc_id score", "1 label", "2 predicted", "0 quality", "1 toxic")
    for operator in (quality.quality, toxicity.toxicity):
        before = {r.doc_id: r.score for r in operator(docs, labels).collect()}
        assert {r.doc_id: r.score for r in operator(changed.repartition(5), other).collect()} == pytest.approx(before, abs=1e-9)


@pytest.mark.parametrize("operator", [quality.quality, toxicity.toxicity])
def test_without_labels_documents_or_ids(spark, operator):
    docs = documents(spark, [(1, "some text"), (1, "some text"), (None, None), (2, "")])
    nothing = labelled(spark, [])
    rows = operator(docs, nothing).collect()
    assert len(rows) == 4 and len({r.score for r in rows}) == 1
    assert operator(docs.limit(0), nothing).count() == 0
    one_kind = labelled(spark, [(1, 1, 0), (None, 0, 1), (2, None, None)])
    assert operator(docs, one_kind).count() == 4


@pytest.mark.parametrize("operator, label, least", [(quality.quality, "quality", 0.97), (toxicity.toxicity, "toxic", 0.95)])
def test_held_out_documents_of_the_given_tables(spark, operator, label, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r[label] for r in labels.collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in operator(docs, labels).collect() if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) >= least


def test_languages_of_the_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [(r.lang_pred, truth[r.doc_id]) for r in language.language(docs).collect() if r.held_out]
    assert len(held) > 200 and np.mean([a == b for a, b in held]) >= 0.97


def test_line_measures_of_any_texts():
    import pyarrow as pa

    texts = ["a b\nA B\n\nCC!!! DD", "", "\n", "x", "é ö\n" * 3, "y" * 10 + " " + "y" * 10]
    (piece,) = pieces(pa.array(texts, pa.large_string()))
    measures, size, lines = quality.line_measures(piece)
    assert np.diff(lines).tolist() == [t.count("\n") + 1 for t in texts]
    assert size.tolist() == [n for t in texts for n in [len(x.encode()) for x in t.splitlines(keepends=True)] + ([0] if not t or t.endswith("\n") else [])]
    named = dict(zip(quality.MEASURES, measures.T, strict=True))
    assert named["again"][:4].tolist() == [1, 1, 0, 0] and named["capitals"][3] == pytest.approx(4 / 8)
    assert named["distinct"][-1] == 0.5 and named["adjacent"][-1] == 0.5 and named["repeated_marks"][3] == pytest.approx(2 / 8)


def test_folding():
    words = toxicity.folded_words("1D1OT idіot ｉｄｉｏｔ i​diot 2024 a$$ café don't")
    assert words == ["idiot", "idiot", "idiot", "idiot", "2024", "a", "café", "don", "t"]


def test_matching_and_exceptions():
    lexicon = toxicity.Lexicon({" grob": 3.0, " grobnak ": 4.0, " foul mouth ": 2.0}, (" grobber ", " the foul mouth of "), ())
    machine = toxicity.automaton(lexicon)
    weights = lambda text: [w for _, _, w in toxicity.matches(text.split(), machine)]
    assert weights("grobnak x grobs foul mouth") == [4.0, 3.0, 2.0]
    assert weights("grobber agrob the foul mouth of rivers") == []
    assert weights("grobber grobbers") == [3.0]
    assert toxicity.matches([], machine) == []


def speech(rng, syllables, words):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(words))


TONGUES = {"aa": ["ka", "ro", "mi", "ten"], "bb": ["sch", "ün", "ger", "mi"], "cc": ["ço", "lle", "ro", "eau"]}


def test_language_on_held_out_and_code_switched_documents(spark):
    rng = random.Random(3)
    texts = [(lang, speech(rng, TONGUES[lang], rng.randrange(3, 120))) for _ in range(120) for lang in TONGUES]
    mixed = speech(rng, TONGUES["aa"], 30) + " " + speech(rng, TONGUES["bb"], 60)
    rows = [(i, t, lang, "s", 0) for i, (lang, t) in enumerate(texts)]
    rows += [(1000, None, "aa", "s", 0), (1001, "", "bb", "s", 0), (1002, "12 34 !?", "cc", "s", 0), (1003, mixed, None, "s", 0), (1004, texts[0][1] * 200, None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in language.language(docs.selectExpr("*", "1 score", "'x' lang_pred", "2 found")).collect()}
    held = [(got[i].lang_pred, lang) for i, (lang, _) in enumerate(texts) if got[i].held_out]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert {(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)} == {("und", 0.0)}
    assert got[1003].lang_pred == "bb" and 0.5 < got[1003].score < 0.9
    assert got[1004].lang_pred == "aa"


def test_words_of_a_switched_text_are_labelled_one_by_one():
    rng = random.Random(5)
    lexicon, words, gold, features, places, known = {}, [], [], [], [0], {}
    for _ in range(150):
        for label, syllables in enumerate(TONGUES.values()):
            for word in speech(rng, syllables, 12).split():
                if word not in known:
                    known[word] = len(known)
                    features += language.word_features(word, lexicon)
                    places.append(len(features))
                words.append(known[word])
                gold.append(label)
    chain = crf.train(np.array(features), np.array(places), np.array(words), np.arange(0, len(words) + 1, 36), np.array(gold), language.BUCKETS, 3, steps=30)
    text = [(speech(rng, s, 8), i) for i, s in enumerate(TONGUES.values())]
    scores = np.stack([chain.weights[language.word_features(w, lexicon)].sum(axis=0) for t, _ in text for w in t.split()])
    guess = crf.forward_backward(scores, np.array([0, len(scores)]), chain.transitions, chain.start).marginals.argmax(axis=1)
    assert (guess == np.repeat([0, 1, 2], 8)).mean() > 0.85


def test_the_inside_of_a_long_run_of_letters_is_read(spark):
    """Texts without spaces whose first and last letters say nothing."""
    rng = random.Random(6)
    tongues = list(TONGUES.items())
    texts = [(i, speech(rng, tongues[i % 3][1], 40)) for i in range(300)]
    runs = [(1000 + i, "zzzz" + "".join(speech(rng, tongues[i % 3][1], 60).split()) + "zzzz") for i in range(30)]
    docs = documents(spark, texts + runs, lang=None).selectExpr("doc_id", "text", f"CASE WHEN doc_id < 1000 THEN element_at(array({', '.join(repr(k) for k, _ in tongues)}), CAST(doc_id % 3 + 1 AS INT)) END lang")
    got = {r.doc_id: r.lang_pred for r in language.language(docs).collect()}
    assert sum(got[i] == tongues[(i - 1000) % 3][0] for i, _ in runs) >= 28
    assert [len(w) for w in language.words_of("a" * 100 + " b")] == [39, 39, 22, 1]


def test_nothing_to_learn(spark):
    docs = documents(spark, ["text", None], lang=None)
    assert {r.lang_pred for r in language.language(docs).collect()} == {"und"}
    assert language.language(docs.limit(0)).count() == 0
    one = documents(spark, ["text of one", "language only", None, "more"] * 3, lang="zz")
    assert {r.lang_pred for r in language.language(one).collect()} == {"zz", "und"}


def test_matches_of_a_very_long_text_and_of_nested_exceptions():
    lexicon = toxicity.Lexicon({" bad ": 2.0, " aw": 1.0}, (" not bad ", " so not bad at all ", " at all awful "), (1.0, 1.0, 1.0, 0.0))
    machine = toxicity.automaton(lexicon)
    found = lambda text: sorted(toxicity.matches(text.split(), machine))
    assert found("bad so not bad at all awful bad") == [(0, 5, 2.0), (28, 33, 2.0)]
    assert found("not bad bad") == [(8, 13, 2.0)]
    began = time.perf_counter()
    assert len(toxicity.matches(["not", "bad", "awful", "bad"] * 250_000, machine)) == 500_000
    assert time.perf_counter() - began < 30
