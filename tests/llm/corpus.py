"""Small documents for tests, with what each operation has to stand."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "river stone cloud amber field lantern copper willow harbour meadow thunder velvet orchid marble cinder falcon ember quartz juniper saffron".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "er"]) + str(rng.randrange(30)) for _ in range(words))


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join("changed" + str(rng.randrange(999)) if rng.random() < share else w for w in text.split(" "))


def documents(spark, texts, lang="en", **more):
    """doc_id from 0 on; a text may be a tuple (doc_id, text)."""
    rows = [(*t, lang, f"s{i % 3}", 0) if isinstance(t, tuple) else (i, t, lang, f"s{i % 3}", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", *(f"{v} as {k}" for k, v in more.items())) if more else df


def mixed_texts(seed: int = 3, n: int = 40) -> list[str | None]:
    """Prose with copies, near copies, shared passages, repeats inside a text, short, empty, null and very long ones."""
    rng = random.Random(seed)
    texts: list[str | None] = [prose(rng, rng.randrange(30, 200)) for _ in range(n)]
    passage = prose(rng, 70)
    texts += [texts[0], texts[0], texts[1].upper(), "  " + texts[2].replace(" ", "\n")]
    texts += [edited(rng, t, share) for t in texts[3:9] for share in (0.01, 0.03, 0.2)]
    texts += [f"{prose(rng, 40)} {passage} {prose(rng, 40)}" for _ in range(8)]
    texts += [f"{prose(rng, 10)} {passage} {prose(rng, 5)} {passage}"]
    texts += [None, "", " \t\n ", "one", "two words", "two words", "ONE", "a b c d e", "é" * 700, "=" * 1500, "tick tock " * 300]
    texts += [prose(rng, 6000), "line\n" * 500, "\U0001f600" * 150]
    return texts
