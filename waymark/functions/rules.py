"""Decision tables as Column expressions.

A table lists (outcome, ways) in the order in which they are tried. A way is a list of (field, test, words), all of
which must hold; one way that holds is enough, and so is an empty way. The first rule that holds gives the outcome.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.text import matches


def _some(tests: Sequence[Column]) -> Column:
    return reduce(or_, tests, F.lit(False))


def _has(value: Column, words: Sequence[str]) -> Column:
    return _some([value.contains(w) for w in words])


def _like(value: Column, words: Sequence[str]) -> Column:
    return _some([matches(value, w) for w in words])


TESTS: dict[str, Callable[[Column, Sequence[str]], Column]] = {
    "is": lambda value, words: value.isin(*words),
    "has": _has,
    "lacks": lambda value, words: ~_has(value, words),
    "like": _like,
    "unlike": lambda value, words: ~_like(value, words),
}


def holds(ways: Sequence, fields: Mapping[str, Column], tests: Mapping[str, Callable] = TESTS) -> Column:
    """Whether one of the ways is met."""
    return _some([reduce(and_, [tests[t](fields[f], words) for f, t, words in way], F.lit(True)) for way in ways])


def decided(
    rules: Sequence, fields: Mapping[str, Column], outcome: Callable[..., Column] = F.lit, tests: Mapping = TESTS
) -> Column:
    """Outcome of the first rule that holds, null when none does."""
    found = [F.when(holds(ways, fields, tests), outcome(value)) for value, ways in rules]
    return F.coalesce(*found) if found else F.lit(None)
