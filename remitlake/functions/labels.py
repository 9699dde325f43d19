"""Row-level rules: domains, timestamps, validity, ratios, segments and risk labels."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from remitlake import contract as C


def in_domain_or_unknown(column: str, allowed: Iterable[str]) -> Column:
    value = F.col(column)
    return F.when(value.isin(*allowed), value).otherwise(F.lit(C.UNKNOWN))


def has_all(columns: Iterable[str]) -> Column:
    """True when none of the columns is null. Plain conjuncts, so Catalyst can push each one down by itself."""
    return reduce(Column.__and__, (F.col(c).isNotNull() for c in columns))


def is_valid_amount(column: str = "amount") -> Column:
    # Any finite amount. NaN sorts above infinity, so the upper bound also refuses it.
    return (F.col(column) > 0) & (F.col(column) < float("inf"))


def date_time_text(date: str = "transaction_date", time: str = "transaction_time") -> Column:
    return F.concat_ws(" ", F.col(date), F.col(time))


def parsed_timestamp(text: Column) -> Column:
    """A timestamp, or null where the text does not have the pattern (ANSI mode included)."""
    return F.try_to_timestamp(text, F.lit(C.TIMESTAMP_PATTERN))


def flagged(column: str = "is_flagged") -> Column:
    return F.coalesce(F.col(column), F.lit(False))


def equals(column: str, value: str) -> Column:
    """Equality that is false, not null, for a null."""
    return F.col(column).eqNullSafe(F.lit(value))


def percent_of(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 2)


def percent_change(now: Column, before: Column) -> Column:
    return F.round(F.try_divide(now - before, before) * 100, 2)


def segment_of(total_spend: Column, floors=C.SEGMENT_FLOORS, base: str = C.BASE_SEGMENT) -> Column:
    return _first_floor(floors, base, lambda floor: total_spend >= floor)


def risk_of(flagged_ratio: Column, floors=C.RISK_FLOORS, base: str = C.BASE_RISK) -> Column:
    return _first_floor(floors, base, lambda floor: flagged_ratio > floor)


def _first_floor(floors, base, reached) -> Column:
    return F.coalesce(*(F.when(reached(floor), F.lit(name)) for name, floor in floors), F.lit(base))
