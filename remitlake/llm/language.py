"""Language of documents by a linear-chain conditional random field over words.

A word's features are its affixes, its n-grams of letters (both hashed into buckets), and whether it is in a language's
lexicon: the words that training documents of that language use often and others seldom. Transitions between the
labels of neighbouring words are learned as well, from training sequences in which snippets of several documents
follow each other as in code-switched text. Forward-backward gives each word a marginal for each language; a
document's language has the greatest sum of marginals over letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.llm import crf
from remitlake.llm.labelled import fold, sample
from remitlake.llm.text import at_rest
from remitlake.sources.shared import dropped, stored

FOLDS, HELD_OUT = 4, 2
#: Documents to train on, at most (about). Their whole texts are read, in snippets of so many words in a row.
FIT_DOCUMENTS = 1_500
SNIPPET_WORDS = 64
#: Words in the lexicons of all languages together, and buckets for hashed features.
LEXICON = 20_000
BUCKETS = 1 << 15
#: A training sequence joins so many snippets.
SNIPPETS = 2
UNKNOWN = "und"
_WORDS_AT_ONCE = 600_000
_REMEMBERED = 400_000

#: A longer run of letters, as in scripts without spaces, is read in pieces of so many, each a word.
LONGEST_WORD = 39

_WORD = re.compile(r"[^\W\d_]{1,%d}" % LONGEST_WORD).findall


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case; those of more than LONGEST_WORD letters in pieces."""
    return _WORD(text.lower())


class _Buckets(dict):
    """Bucket of each affix or n-gram; they recur, so each is hashed once."""

    def __missing__(self, part: str) -> int:
        self[part] = bucket = zlib.crc32(part.encode()) % BUCKETS
        return bucket


def word_features(word: str, lexicon: dict[str, int], buckets: dict[str, int] | None = None) -> list[int]:
    """Numbers of a word's features: hashed affixes and n-grams, then the word's place in a lexicon if it has one."""
    buckets = _Buckets() if buckets is None else buckets
    ends = f"<{word}>"
    parts = [f"p{ends[:n]}" for n in (2, 3, 4)] + [f"s{ends[-n:]}" for n in (2, 3, 4)]
    parts += word
    parts += [ends[i : i + 2] for i in range(len(ends) - 1)]
    parts += [ends[i : i + 3] for i in range(len(ends) - 2)]
    numbers = [buckets[p] for p in parts]
    if word in lexicon:
        numbers.append(BUCKETS + lexicon[word])
    return numbers


class Model(NamedTuple):
    languages: tuple[str, ...]
    lexicon: dict[str, int]
    chain: crf.Chain


class _Scores(dict):
    """Row of each word in a table of its scores."""

    def __init__(self, model: Model):
        self.model, self.table, self.buckets = model, np.zeros((0, len(model.languages)), np.float32), _Buckets()

    def learn(self, words: list[str]) -> None:
        """Give rows to the words that have none."""
        new = [w for w in dict.fromkeys(words) if w not in self]
        if len(self) + len(new) > _REMEMBERED:
            self.clear()
            self.buckets.clear()
            self.table, new = self.table[:0], list(dict.fromkeys(words))
        numbers, places = [], [0]
        for word in new:
            numbers += word_features(word, self.model.lexicon, self.buckets)
            places.append(len(numbers))
        self.update(zip(new, range(len(self), len(self) + len(new)), strict=True))
        if new:
            rows = crf.summed_rows(self.model.chain.weights, np.array(numbers), np.array(places))
            self.table = np.concatenate([self.table, rows])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word occurs in each language."""
    counts: Counter = Counter()

    def rows() -> Iterator[pa.RecordBatch]:
        held = list(counts.items())
        for at in range(0, len(held), 50_000):
            part = held[at : at + 50_000]
            columns = {"lang": [k[0] for k, _ in part], "word": [k[1] for k, _ in part], "n": [n for _, n in part]}
            yield pa.record_batch({c: pa.array(x, pa.int64() if c == "n" else pa.string()) for c, x in columns.items()})
        counts.clear()

    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            counts.update((lang, word) for word in words_of(text or ""))
            if len(counts) > 500_000:
                yield from rows()
    yield from rows()


def _lexicon(counts: DataFrame) -> dict[str, int]:
    """The most frequent words three quarters of whose uses are in one language: their places, most frequent first."""
    own = counts.groupBy("word").agg(F.sum("n").alias("n"), F.max("n").alias("most")).where("n >= 3 and most >= 0.75 * n")
    return {r.word: i for i, r in enumerate(own.orderBy(F.desc("n"), "word").limit(LEXICON).select("word").collect())}


def _block(snippets: list[tuple[int, list[str]]], lexicon: dict[str, int], buckets: _Buckets) -> crf.Block:
    known_words: dict[str, int] = {}
    features, places = [], [0]
    words, gold, ends = [], [], [0]
    order = np.random.default_rng(0).permutation(len(snippets))
    for nth, i in enumerate(order.tolist(), 1):
        label, found = snippets[i]
        for word in found:
            if word not in known_words:
                known_words[word] = len(known_words)
                features += word_features(word, lexicon, buckets)
                places.append(len(features))
            words.append(known_words[word])
        gold += [label] * len(found)
        if nth % SNIPPETS == 0 or nth == len(order):
            ends.append(len(words))
    return crf.Block(*(np.array(x) for x in (features, places, words, ends, gold)))


def _blocks(languages: tuple[str, ...], lexicon: dict[str, int]):
    """All words of each text in snippets, those of several texts mixed into the sequences of a block."""
    labels = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, snippets, size = _Buckets(), [], 0
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                found = words_of(text or "")
                for at in range(0, len(found), SNIPPET_WORDS):
                    snippets.append((labels[lang], found[at : at + SNIPPET_WORDS]))
                    size += len(snippets[-1][1])
                    if size >= crf.BLOCK_PLACES:
                        yield crf.block_row(_block(snippets, lexicon, buckets))
                        snippets, size = [], 0
        if snippets:
            yield crf.block_row(_block(snippets, lexicon, buckets))
        at_rest()

    return run


def fit(known: DataFrame) -> Model | None:
    """A model from known(text, lang). None without any word; with one language, everything is that language.

    Known rows are read whole and several times, so they should be stored. The driver gets the lexicon and sums of slopes.
    """
    counts = stored(known.mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    languages = tuple(sorted(r.lang for r in counts.select("lang").distinct().collect()))
    if not languages:
        return None
    lexicon = _lexicon(counts)
    blocks = stored(known.mapInArrow(_blocks(languages, lexicon), crf.BLOCK), "blocks")
    chain = crf.train_on(blocks, BUCKETS + len(lexicon), len(languages), l2=1.0, steps=30)
    dropped(counts, blocks)
    return Model(languages, lexicon, chain._replace(weights=chain.weights.astype(np.float32)))


def predict(texts: list[str | None], model: Model, scores: _Scores) -> list[tuple[str, float]]:
    """Language and share of the marginals of each text; ``und`` and 0 where there is no letter."""
    out: list[tuple[str, float]] = []
    at = 0
    while at < len(texts):
        words, ends, begin = [], [0], at
        while at < len(texts) and len(words) < _WORDS_AT_ONCE:
            words += words_of(texts[at]) if texts[at] else []
            ends.append(len(words))
            at += 1
        scores.learn(words)
        offsets = np.array(ends)
        some = np.diff(offsets) > 0
        totals = np.zeros((at - begin, len(model.languages)))
        if words:
            emitted = scores.table[np.fromiter(map(scores.__getitem__, words), np.int64, len(words))]
            letters = np.fromiter(map(len, words), np.float32, len(words))
            marginals = crf.forward_backward(emitted, offsets, model.chain.transitions, model.chain.start).marginals
            totals[some] = np.add.reduceat(marginals * letters[:, None], offsets[:-1][some], axis=0)
        best = totals.argmax(axis=1)
        share = totals.max(axis=1) / np.maximum(totals.sum(axis=1), 1e-9)
        out += [
            (model.languages[b], min(1.0, float(s))) if any_word else (UNKNOWN, 0.0)
            for b, s, any_word in zip(best.tolist(), share.tolist(), some.tolist(), strict=True)
        ]
    return out


def predictor(model: Model | None):
    """A column function: struct of lang_pred and score for each text."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores = _Scores(model) if model else None
        for texts in batches:
            held = [t if isinstance(t, str) else None for t in texts]
            rows = predict(held, model, scores) if model else [(UNKNOWN, 0.0)] * len(held)
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])
        at_rest()

    return predicted


def learned(docs: DataFrame) -> Model | None:
    """The model that the documents with a language outside the held-out fold give."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    known = sample(known, FIT_DOCUMENTS).select("text", "lang").repartition(crf.TASKS, "text")
    known = stored(known.sortWithinPartitions(F.xxhash64("text"), "lang"), "sample")  # texts of all languages beside each other
    model = fit(known)
    dropped(known)
    return model


def language(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of docs(doc_id, text, lang).

    Null, empty and letterless texts are ``und`` with score 0. Repeated rows get the same answer; ties go to the first
    language by name. Whole texts are read. Without documents there are no rows; without any language to learn, all
    are ``und``. Columns beside doc_id, text and lang are not looked at.
    """
    predicted = predictor(learned(docs))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), predicted(F.col("text").cast("string")).alias("found"))
    return found.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "found.lang_pred", "found.score")
