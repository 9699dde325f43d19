"""License scans: lines and runs of words of documents compared with license templates by Dice's coefficient over pairs of words.

Texts are brought to lower case and everything but letters and digits becomes a space. Two sets of word pairs of sizes
a and b have a coefficient of t or more only if t / (2 - t) <= a / b <= (2 - t) / t, so a line is compared with the few
templates of fitting size. What that leaves out, a notice wrapped over lines or inside a longer line, is looked for in
runs of words regardless of lines, in the documents that have words enough of a template. All of it is SQL functions on
lines and documents; nothing is shuffled but what was found.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.75

# Wording of license notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "This project is licensed under the terms of the MIT license.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-header": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All-rights-reserved": "All rights reserved.",
}


def normalised(text: str) -> str:
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def template_pairs(templates: dict[str, str]) -> dict[str, list[str]]:
    """The distinct word pairs of each template; a template of one word has none and is left out."""
    out = {}
    for name, text in templates.items():
        words = normalised(text).split(" ")
        pairs = list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))
        if pairs:
            out[name] = pairs
    return out


def _spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _of(value: Column, function: Callable[[Column], Column]) -> Column:
    """function(value), with the value made once for all that is asked of it."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def _pairs(words: Column) -> Column:
    both = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))  # null behind the last
    return F.array_distinct(F.slice(both, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))))


def pairs_of(text: Column) -> Column:
    """The distinct pairs of neighbouring words of a text; of less than two words, none."""
    return _of(F.split(_spaced(text), " "), _pairs)


def _wide_runs(text: Column, table: Column, best_of: Callable[[Column], Column], low: float, high: float, least: float) -> Column:
    """Runs of words, over lines or inside a line too long for the template, that are like a template: (license, dice, line, more).

    A run begins and ends with a pair of the template: without its other ends it is more like it. Of runs that overlap
    the one with most pairs of its template counts, and only if it has more than the lines that it touches and that
    count by themselves. Lines of its own license that it touches are part of it: ``more`` is 1 less their number.
    """
    # Each line's words, number of pairs, and how many pairs it shares with its template if it counts by itself.
    def of_line(words: Column) -> Column:
        def judged(pairs: Column) -> Column:
            best = best_of(pairs)
            return F.struct(words.alias("words"), F.size(pairs).alias("n"), F.when(best["dice"] >= least, best["shared"]).otherwise(0).alias("shared"),
                            F.when(best["dice"] >= least, best["license"]).alias("license"))

        return _of(_pairs(words), judged)

    lines = F.transform(F.split(text, "\n"), lambda line: _of(F.filter(F.split(_spaced(line), " "), lambda w: w != ""), of_line))

    def words_in(lines: Column) -> Column:
        return F.flatten(F.transform(lines, lambda line, i: F.transform(line["words"], lambda w: F.struct(w.alias("word"), i.alias("line")))))

    def pairs_in(words: Column) -> Column:
        both = F.zip_with(
            words,
            F.slice(words, F.lit(2), F.size(words)),
            lambda a, b: F.struct(F.concat(a["word"], F.lit(" "), b["word"]).alias("pair"), a["line"].alias("line"), b["line"].alias("last")),
        )
        placed = F.transform(both, lambda p, i: F.struct(i.alias("at"), p["pair"].alias("pair"), p["line"].alias("line"), p["last"].alias("last")))
        return F.slice(placed, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))

    def runs_like(t: Column, lines: Column, pairs: Column) -> Column:
        def run(first: Column, last: Column) -> Column:
            inside = F.array_distinct(F.transform(F.slice(pairs, first["at"] + 1, last["at"] - first["at"] + 1), lambda p: p["pair"]))

            def scored(inside: Column) -> Column:
                shared = F.size(F.array_intersect(inside, t["pairs"]))
                return F.struct(
                    (2 * shared / (F.size(inside) + t["n"])).alias("dice"),
                    (-last["at"]).alias("end"),
                    shared.alias("shared"),
                    last["last"].alias("last"),
                )

            return _of(inside, scored)

        def touched(first: Column, r: Column) -> Column:
            return F.slice(lines, first["line"] + 1, r["last"] - first["line"] + 1)

        def counts(first: Column, r: Column) -> Column:
            alone = F.aggregate(touched(first, r), F.lit(0), lambda n, line: n + line["shared"])
            over = (first["line"] < r["last"]) | (F.get(lines, first["line"])["n"] > t["n"] * high)
            return (r["dice"] >= least) & over & (r["shared"] > alone)

        def best_from(hits: Column, first: Column, k: Column) -> Column:
            near = F.filter(F.slice(hits, k + 1, t["reach"]), lambda h: h["at"] < first["at"] + t["reach"])
            ends = lambda near: F.when(F.size(near) >= t["need"], near).otherwise(F.slice(near, F.lit(1), F.lit(0)))
            # The last of a run has behind the first at least as many pairs as are needed.
            ends_of = F.slice(_of(near, ends), t["need"], t["reach"])
            best = F.array_max(F.filter(F.transform(ends_of, lambda last: run(first, last)), lambda r: counts(first, r)))
            return _of(
                best,
                lambda r: F.struct(
                    (-r["shared"]).alias("fewer"), (-r["dice"]).alias("less"), (-t["place"]).alias("place"), first["at"].alias("at"),
                    (-r["end"]).alias("end"), t["name"].alias("license"), r["dice"].alias("dice"), first["line"].alias("line"),
                    (1 - F.size(F.filter(touched(first, r), lambda line: line["license"] == t["name"]))).alias("more"),
                ),
            )

        hits = F.filter(pairs, lambda p: F.array_contains(t["pairs"], p["pair"]))
        found = _of(hits, lambda hits: F.transform(hits, lambda first, k: best_from(hits, first, k)))
        return F.filter(found, lambda r: r["dice"].isNotNull())

    def apart(runs: Column) -> Column:
        def add(kept: Column, r: Column) -> Column:
            met = F.exists(kept, lambda k: (k["at"] <= r["end"] + 1) & (r["at"] <= k["end"] + 1))
            return F.when(met, kept).otherwise(F.concat(kept, F.array(r)))

        return F.aggregate(runs, F.slice(runs, F.lit(1), F.lit(0)), add)

    def all_runs(lines: Column) -> Column:
        of_pairs = lambda pairs: F.array_sort(F.flatten(F.transform(table, lambda t: runs_like(t, lines, pairs))))
        return _of(_of(_of(words_in(lines), pairs_in), of_pairs), apart)

    return F.transform(_of(lines, all_runs), lambda r: F.struct(*(r[name].alias(name) for name in ("license", "dice", "line", "more"))))


def scan(docs: DataFrame, *, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """(doc_id, license, dice, lines, first_line) for each license that a line or a run of words of a document is like.

    ``dice`` is the best of the document's places, ``lines`` how many reach ``least``, ``first_line`` the number of the
    line in which the first of them begins, from 0. A place is a line of a size that fits the template, or a run of
    words over lines or inside a line too long to fit. A line counts for its best template only, the first by name
    where several are equal; so does each run, and runs do not overlap. Null and empty texts, lines of one word and templates of one word have no pairs and are like nothing. Repeated ids are
    one document, null is an id. No rows give no rows; columns beside doc_id and text are not looked at.
    """
    known = template_pairs(TEMPLATES if templates is None else templates)
    if not known:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id")).limit(0).selectExpr(
            "doc_id", "'' license", "0D dice", "0L lines", "0 first_line"
        )
    low, high = least / (2 - least), (2 - least) / least
    fewest = min(map(len, known.values()))
    longest = {name: normalised(text).count(" ") for name, text in (TEMPLATES if templates is None else templates).items()}
    # Of n pairs of a template a text must have so many to be like it.
    needed = lambda n: max(1, math.ceil(low * n - 1e-9))
    # Templates in falling order of their names' places, so that the greatest of equal structs is the first by name.
    table = F.array(*[
        F.struct(F.lit(-place).alias("place"), F.lit(name).alias("name"), F.lit(len(pairs)).alias("n"), F.array(*map(F.lit, pairs)).alias("pairs"),
                 F.lit(needed(len(pairs))).alias("need"), F.lit(math.ceil(high * longest[name])).alias("reach"))
        for place, (name, pairs) in enumerate(sorted(known.items()))
    ])

    def best_of(pairs: Column) -> Column:
        n = F.size(pairs)
        fitting = F.filter(table, lambda t: (n >= t["n"] * low) & (n <= t["n"] * high))

        def scored(t: Column) -> Column:
            shared = F.size(F.array_intersect(pairs, t["pairs"]))
            return _of(shared, lambda c: F.struct((2 * c / (n + t["n"])).alias("dice"), t["place"].alias("place"), t["name"].alias("license"), c.alias("shared")))

        return F.array_max(F.transform(fitting, scored))

    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line", "text"))
    # A line of n bytes has at most (n + 1) / 2 words.
    lines = lines.where(F.octet_length("text") >= 2 * max(1, int(fewest * low)) + 1)
    best = _of(pairs_of(F.col("text")), best_of)
    found = lines.select("doc_id", "line", best.alias("best")).where(F.col("best.dice") >= least)

    # Runs are looked for in documents that have both words of as many pairs of a template as it needs.
    vocabulary = F.array(*map(F.lit, sorted({w for pairs in known.values() for p in pairs for w in p.split(" ")})))
    halves = F.array(*[
        F.struct(F.lit(needed(len(pairs))).alias("need"), F.array(*(F.array(*map(F.lit, p.split(" "))) for p in pairs)).alias("pairs"))
        for pairs in known.values()
    ])
    enough = _of(
        F.array_intersect(F.split(_spaced(F.col("text")), " "), vocabulary),
        lambda own: F.exists(halves, lambda t: F.size(F.filter(t["pairs"], lambda p: F.size(F.array_except(p, own)) == 0)) >= t["need"]),
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(enough)
    runs = texts.select("doc_id", F.explode(_wide_runs(F.col("text"), table, best_of, low, high, least)).alias("run"))
    places = found.select("doc_id", "best.license", "best.dice", "line", F.lit(1).alias("more"))
    places = places.unionAll(runs.select("doc_id", "run.license", "run.dice", "run.line", "run.more"))
    return (
        places.groupBy("doc_id", "license")
        .agg(F.max("dice").alias("dice"), F.sum("more").alias("lines"), F.min("line").alias("first_line"))
        .select("doc_id", "license", "dice", "lines", "first_line")
    )


def scan_sql(least: float = LEAST) -> str:
    """The same over a table ``documents`` in DuckDB's SQL."""
    values = ", ".join(f"('{name}', {len(pairs)}, {pairs!r})" for name, pairs in sorted(template_pairs(TEMPLATES).items()))
    return f"""
with templates(name, n, pairs) as (values {values}),
lines as (
  select doc_id, unnest(string_split(text, chr(10))) as text, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line
  from documents
),
words as (
  select doc_id, line, string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') as words from lines
),
paired as (
  select doc_id, line, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) as pairs
  from words where len(words) > 1
),
scored as (
  select doc_id, line, name, 2 * len(list_intersect(p.pairs, t.pairs)) / (len(p.pairs) + t.n)::double as dice
  from paired p join templates t
    on len(p.pairs) >= t.n * {least / (2 - least)!r} and len(p.pairs) <= t.n * {(2 - least) / least!r}
),
best as (
  select * from scored where dice >= {least} qualify row_number() over (partition by doc_id, line order by dice desc, name) = 1
)
select doc_id, name as license, max(dice) as dice, count(*) as lines, min(line)::int as first_line
from best group by doc_id, name
"""
