"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding undoes disguises: compatibility forms, letters of other scripts that look Latin, digits and signs that stand for
letters, invisible characters. The lexicon is learned: word beginnings and whole words that toxic documents have far
more often than others, each with its log odds as weight. Exception phrases are matched by the same automaton and
cancel the matches inside them: words that begin like an entry but are harmless are learned, phrases can be given.
The weights found, alone and in relation to the length, are put into a logistic curve.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.llm.labelled import fold, labelled_sample
from remitlake.llm.text import at_rest
from remitlake.sources.shared import dropped, stored

FOLDS, HELD_OUT = 4, 2
#: Labelled documents that the lexicon and the curve are learned from, at most (about); entries of either kind, at most.
FIT_DOCUMENTS = 20_000
ENTRIES = 5_000
THRESHOLD = 0.3
_PREFIX = (3, 12)
_LEAST_DOCUMENTS = 3
#: How many times the log of the number of words an entry has to be from chance: words of one stem in one text are not independent.
_CLEARLY = 1.0
_LEAST_WEIGHT = 2.0
#: Level of the curve where nothing is known: about one document in twenty.
_RARE = -3.0

# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
_LOOKALIKES = dict(zip("аеорсухіјѕԁһӏқԛԝвкмнтгпбзαβεικνορτυχγηωѵɑɡɩʏıøđłħŧ", "aeopcyxijsdhlkqwbkmhtrnb3abeikvoptuxynwvagiyiodlht", strict=True))
_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "l", "€": "e", "!": "i", "+": "t"}
_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x0300, 0x0370)])

_LETTERS_TABLE = {ord(a): b for a, b in _LOOKALIKES.items()} | _INVISIBLE
_SIGNS_TABLE = {ord(a): b for a, b in _SIGNS.items()}
_TOKEN = re.compile(r"[^\W_]+(?:[@$|€!+]+[^\W_]+)*|[@$€+|]+[^\W_]+")


def folded_words(text: str) -> list[str]:
    """The words of a text in lower case without disguise. Digits and signs count as letters beside letters only."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        text = text.translate(_LETTERS_TABLE)
    return [w if w.isalpha() else w if w.isdigit() else w.translate(_SIGNS_TABLE) for w in _TOKEN.findall(text)]


class Lexicon(NamedTuple):
    """Entries with weights: " word " is a whole word, " beg" a beginning. Exceptions likewise. The curve: slope for each feature, and level."""

    entries: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, ...]


def automaton(lexicon: Lexicon) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for phrase in lexicon.exceptions:
        machine.add_word(phrase, (len(phrase), None))
    for entry, weight in lexicon.entries.items():
        if entry not in machine:
            machine.add_word(entry, (len(entry), weight))
    if len(machine):
        machine.make_automaton()
    return machine


def matches(words: list[str], machine: ahocorasick.Automaton) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the entries in " word word ... ", the longest for each start, none inside an exception."""
    if not words or not len(machine):
        return []
    found: dict[int, tuple[int, float]] = {}
    excepted = []
    for end, (length, weight) in machine.iter(f" {' '.join(words)} "):
        start = end - length + 1
        if weight is None:
            excepted.append((start, end + 1))
        elif start not in found or found[start][0] < end + 1:
            found[start] = (end + 1, weight)
    # Of the exceptions that begin no later than an entry, the one that reaches farthest decides.
    excepted.sort()
    begins = [x for x, _ in excepted]
    reach = list(accumulate((y for _, y in excepted), max))
    free = []
    for a, (b, weight) in found.items():
        before = bisect_right(begins, a)
        if not before or reach[before - 1] < b:
            free.append((a, b, weight))
    return free


def features(words: list[str], machine: ahocorasick.Automaton) -> tuple[float, float, float]:
    """Any match at all; the sum of the weights; the sum in relation to the length."""
    weight = sum(w for _, _, w in matches(words, machine))
    return float(weight > 0), float(np.log1p(max(weight, 0.0))), float(max(weight, 0.0) / np.sqrt(len(words) + 1.0))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            (toxic if label else clean).update(set(folded_words(text or "")))
        if len(toxic) + len(clean) > 1_000_000:
            yield from _counted(toxic, clean)
            toxic, clean = Counter(), Counter()
    yield from _counted(toxic, clean)
    del toxic, clean
    at_rest()


def _counted(toxic: Counter, clean: Counter) -> Iterator[pa.RecordBatch]:
    both = list(toxic.keys() | clean.keys())
    for at in range(0, len(both), 50_000):
        part = both[at : at + 50_000]
        yield pa.record_batch({"word": pa.array(part, pa.string()), "toxic": pa.array([toxic[w] for w in part], pa.int64()), "clean": pa.array([clean[w] for w in part], pa.int64())})


def _log_odds(n_toxic: int, n_clean: int) -> Column:
    return F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))


def _chosen(rows: Iterable[tuple[str, int, int]], n_toxic: int, n_clean: int, clear: float) -> dict[str, float]:
    """Entries that are this far from chance, the clearest first, none that begins or is the
    beginning of a clearer one; of equally clear ones the longest. Weights are log odds."""
    share = n_toxic / (n_toxic + n_clean)
    ranked = []
    for entry, toxic, clean in rows:
        weight = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
        seen = toxic + clean
        ratio = toxic * np.log(toxic / (seen * share)) + (clean * np.log(clean / (seen * (1 - share))) if clean else 0.0) if toxic else 0.0
        if weight >= _LEAST_WEIGHT and ratio >= clear:
            ranked.append((-ratio, -len(entry), entry, float(weight)))
    kept: dict[str, float] = {}
    begun: set[str] = set()
    for _, _, entry, weight in sorted(ranked):
        if entry not in begun and not any(entry[:n] in kept for n in range(2, len(entry))):
            kept[entry] = weight
            begun.update(entry[:n] for n in range(2, len(entry)))
    return kept


def _curve(x: np.ndarray, y: np.ndarray, l2: float = 1e-2) -> tuple[float, ...]:
    """Logistic regression by Newton's steps, pulled towards no slopes and the level of a rare thing."""
    x = np.column_stack([x, np.ones(len(x))])
    centre = np.array([0.0] * (x.shape[1] - 1) + [_RARE])
    w = centre.copy()
    pull = np.full(x.shape[1], l2 * len(y) / 100 + 1.0)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * (w - centre))
        w += np.clip(step, -4, 4)
    return tuple(w.tolist())


def fit(known: DataFrame, *, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from known(text, label), label 1 for toxic. ``exceptions`` are phrases in which nothing counts.

    Without any toxic row the lexicon is empty and every document gets the same low score.
    """
    counts = known.groupBy("label").count().collect()
    n_toxic = sum(r["count"] for r in counts if r["label"])
    n_clean = sum(r["count"] for r in counts if not r["label"])
    if not n_toxic or not n_clean:
        return Lexicon({}, (), _curve(np.zeros((n_toxic + n_clean, 3)), np.repeat([1.0, 0.0], [n_toxic, n_clean])))
    words = stored(
        known.mapInArrow(_word_counts, "word string, toxic long, clean long")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "words",
    )
    low, high = _PREFIX
    pieces = F.concat(
        F.array(F.concat(F.lit(" "), "word", F.lit(" "))),
        F.transform(
            F.when(F.length("word") >= low, F.sequence(F.lit(low), F.least(F.length("word"), F.lit(high)))).otherwise(F.array().cast("array<int>")),
            lambda n: F.concat(F.lit(" "), F.substr("word", F.lit(1), n)),
        ),
    )
    # Sums over words: a document counts once for each of its words that begin so, and toxic ones have several.
    weighed = (
        words.select(F.explode(pieces).alias("entry"), "toxic", "clean")
        .groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= _LEAST_DOCUMENTS)
        .withColumn("weight", _log_odds(n_toxic, n_clean))
    )
    likely = weighed.where(F.col("weight") >= _LEAST_WEIGHT).orderBy(F.desc(F.col("weight") * F.log(F.col("toxic"))), "entry").limit(ENTRIES)
    clear = _CLEARLY * np.log(max(2, words.count()))
    entries = _chosen(((r.entry, r.toxic, r.clean) for r in likely.select("entry", "toxic", "clean").collect()), n_toxic, n_clean, clear)
    beginnings = [(e,) for e in entries if not e.endswith(" ")]
    harmless: list[str] = []
    if beginnings:
        common = words.where((F.col("clean") >= _LEAST_DOCUMENTS) & (_log_odds(n_toxic, n_clean) < 0))
        begun = common.select("word", "clean", F.explode(pieces).alias("entry")).join(known.sparkSession.createDataFrame(beginnings, "entry string"), "entry")
        best = begun.select("word", "clean").distinct().orderBy(F.desc("clean"), "word").limit(ENTRIES)
        harmless = [f" {r.word} " for r in best.collect()]
    dropped(words)
    given = [f" {' '.join(folded_words(p))} " for p in exceptions]
    lexicon = Lexicon(entries, tuple(dict.fromkeys([*given, *harmless])), ())
    rows = known.mapInArrow(_feature_rows(lexicon), "a double, b double, c double, label int").toPandas()  # one short row for each of the sample
    return lexicon._replace(curve=_curve(rows[["a", "b", "c"]].to_numpy(float), rows["label"].to_numpy(float)))


def _feature_rows(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(lexicon)
        for batch in batches:
            found = [features(folded_words(t or ""), machine) for t in batch.column("text").to_pylist()]
            a, b, c = (pa.array([f[i] for f in found], pa.float64()) for i in range(3))
            yield pa.record_batch({"a": a, "b": b, "c": c, "label": batch.column("label")})

    return run


def scorer(lexicon: Lexicon):
    """A column function: the toxicity of each text, 0 to 1. Null counts as empty; an empty text gets the level of no match."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine, slopes = automaton(lexicon), np.array(lexicon.curve)
        for texts in batches:
            x = np.array([(*features(folded_words(t), machine), 1.0) if isinstance(t, str) else (0.0, 0.0, 0.0, 1.0) for t in texts]).reshape(-1, 4)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ slopes, -30, 30))))
        at_rest()

    return score


def learned(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """The lexicon that the labelled documents outside the held-out fold give."""
    known = labelled_sample(docs, labels, "toxic", folds=FOLDS, held_out=HELD_OUT, most=FIT_DOCUMENTS)
    known = stored(known.select("text", "label"), "sample")
    lexicon = fit(known)
    dropped(known)
    return lexicon


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs(doc_id, text).

    Null and empty texts have no match and get the score of that. Repeated rows get the same score. A null id is held
    out or not like an empty one. Long texts are matched whole. Without documents there are no rows, without labels
    one low score for all. Columns beside doc_id and text are not looked at.
    """
    score = scorer(learned(docs, labels))
    scored = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text").cast("string")).alias("score")
    )
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
