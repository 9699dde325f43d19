"""Text columns that stand side by side as one column, while rows are sorted and dealt out.

A row in a shuffle has a word of eight bytes for each column, its texts are filled up to such words, and a compressed block
holds few of them. Rows with fewer and longer columns take about a third less. A packed column sorts as its columns
would one after the other, nulls first, so the smallest row can be found while it is packed.

In a packed column a null is nothing, a text is _TEXT and its characters; _END stands between them. Where a text
has one of these two characters itself, it is written as two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_END, _TEXT = "\x00", "\x01"
#: Applied in this order; undone in the other.
_ESCAPES = ((_TEXT, "\x01\x02"), (_END, "\x01\x01"))
_PARTS = "_parts"


def _escaped(column: str) -> Column:
    text = F.col(f"`{column}`")
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return F.coalesce(F.concat(F.lit(_TEXT), text), F.lit(""))


def _plain(part: Column) -> Column:
    text = F.substr(part, F.lit(2))
    for plain, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return F.when(part != "", text)


def packed(df: DataFrame, columns: Iterable[str]) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """(rows, columns, unpacked): df with each run of texts among ``columns`` as one column, what ``columns`` are now, and a step
    that gives df's columns back, in their order."""
    columns, types = list(columns), dict(df.dtypes)
    joined: dict[str, list[str]] = {}
    now: list[str] = []
    for text, run in groupby(columns, lambda c: types[c] == "string"):
        run = list(run)
        if text and len(run) > 1:
            now.append(f"_packed{len(joined)}")
            joined[now[-1]] = run
        else:
            now += run
    gone = {c for run in joined.values() for c in run}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in gone]
    rows = df.select(*kept, *(F.concat_ws(_END, *map(_escaped, run)).alias(name) for name, run in joined.items()))

    def unpacked(rows: DataFrame) -> DataFrame:
        # Split once a row: Catalyst does not repeat a costly expression that several columns use.
        split = rows.withColumns({f"{name}{_PARTS}": F.split(name, _END) for name in joined})
        place = {c: F.col(f"{name}{_PARTS}")[n] for name, run in joined.items() for n, c in enumerate(run)}
        return split.select(*(_plain(place[c]).alias(c) if c in place else F.col(f"`{c}`") for c in df.columns))

    return rows, now, unpacked
